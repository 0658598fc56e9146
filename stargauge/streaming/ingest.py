"""Pick up new snapshot files as they arrive and fold them into a raw table.

Each source file has a partition of its own in the raw table (snapshot date, then a hash of the file's path), and a ledger
table beside it lists the files that were loaded, with their size and time of change. A batch writes the partitions of its
own files and nothing else; files that the ledger holds unchanged are passed over, also from an empty checkpoint; a file
that was replaced replaces its partition. Data are written before the ledger, so what a crash leaves unlisted is written
again, in the same place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.snapshots import CORRUPT, SOURCE_FILE, feed_path, feed_schema, stamp
from ..sources.tables import PARTITION, append_snapshot, ensure_table

#: Hash of the path of the source file, the inner partition column of an ingested table.
FILE_ID = "file_id"
_SIZE, _CHANGED = "_file_size", "_file_changed"
_LEDGER = T.StructType([
    T.StructField(SOURCE_FILE, T.StringType()), T.StructField(FILE_ID, T.StringType()), T.StructField(PARTITION, T.LongType()),
    T.StructField("bytes", T.LongType()), T.StructField("changed", T.TimestampType()), T.StructField("rows", T.LongType()),
    T.StructField("batch", T.LongType()), T.StructField("loaded", T.TimestampType()),
])


def snapshot_stream(spark: SparkSession, base: str, feed: str, lines: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Streaming rows of one feed with snapshot date, source file, and the file's size and time of change."""
    schema = T.StructType(feed_schema(feed).fields + [T.StructField("date", T.IntegerType(), True)])
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", not lines)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.json(feed_path(base, feed))
    return stamp(rows.withColumns({
        SOURCE_FILE: F.col("_metadata.file_path"),
        _SIZE: F.col("_metadata.file_size"),
        _CHANGED: F.col("_metadata.file_modification_time"),
    }))


def ledger_name(table: str) -> str:
    return f"{table}_files"


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """The files in an ingested table: the last entry of each, if it was listed more than once."""
    last = Window.partitionBy(SOURCE_FILE).orderBy(F.col("loaded").desc(), F.col("batch").desc())
    return spark.table(ledger_name(table)).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def merge_files(batch: DataFrame, table: str, number: int = 0) -> None:
    """Write the rows of the batch's files, each file to its own partition, and list the files in the ledger.

    Files listed with the same size and time of change are left out. Only the partitions written to are replaced: a late
    second file for a date costs no rewrite of the first, and a batch that runs twice leaves every row exactly once. A
    batch without size and time (two columns of ``snapshot_stream``) is loaded whole.
    """
    spark = batch.sparkSession
    for column, kind in ((_SIZE, "long"), (_CHANGED, "timestamp")):
        if column not in batch.columns:
            batch = batch.withColumn(column, F.lit(None).cast(kind))
    rows = batch.withColumn(FILE_ID, F.hex(F.xxhash64(SOURCE_FILE)))
    stored = [f for f in rows.drop(_SIZE, _CHANGED).schema.fields if f.name not in (PARTITION, FILE_ID)]
    keys = [rows.schema[PARTITION], rows.schema[FILE_ID]]
    ensure_table(spark, table, T.StructType(stored + keys), [PARTITION, FILE_ID])
    ensure_table(spark, ledger_name(table), _LEDGER, None)
    spark.catalog.refreshTable(table)
    spark.catalog.refreshTable(ledger_name(table))
    if FILE_ID not in spark.table(table).columns:
        raise ValueError(f"{table} is not partitioned by {FILE_ID}; load it anew with merge_files")

    known = loaded_files(spark, table).select(SOURCE_FILE, F.col("bytes").alias(_SIZE), F.col("changed").alias(_CHANGED))
    fresh = rows.join(known, [SOURCE_FILE, _SIZE, _CHANGED], "left_anti").persist()
    try:
        files = fresh.groupBy(SOURCE_FILE, FILE_ID, PARTITION, F.col(_SIZE).alias("bytes"), F.col(_CHANGED).alias("changed")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        if files.isEmpty():
            return
        append_snapshot(fresh.drop(_SIZE, _CHANGED), table, "overwrite_partition")
        listed = files.withColumns({"batch": F.lit(number).cast("long"), "loaded": F.current_timestamp()})
        append_snapshot(listed.coalesce(1), ledger_name(table), "append")
    finally:
        fresh.unpersist()


def ingest_available(spark: SparkSession, base: str, feed: str, table: str, checkpoint: str, **options) -> StreamingQuery:
    """Process everything that has arrived since the last call, then stop."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_files(batch, table, number)
        spark.catalog.refreshTable(table)  # batches run in a session of their own
        spark.catalog.refreshTable(ledger_name(table))

    return (
        snapshot_stream(spark, base, feed, **options)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
