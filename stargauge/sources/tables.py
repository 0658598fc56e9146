"""Databases and tables: create if absent, append, replace a partition, replace a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PARTITION = "snapshot_date"
_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, partition_by: str | Sequence[str] | None = PARTITION) -> bool:
    """Create an empty declared table unless it exists; says whether it was created."""
    if spark.catalog.tableExists(table):
        return False
    writer = spark.createDataFrame([], schema).write.format("parquet")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)
    return True


def raw_table_schema(feed_schema: T.StructType) -> T.StructType:
    return T.StructType(feed_schema.fields + [T.StructField(PARTITION, T.LongType(), True)])


def append_snapshot(df: DataFrame, table: str, mode: str = "overwrite_partition", partitions: Sequence[dict[str, object]] = ()) -> None:
    """Add snapshot rows to a partitioned raw table.

    ``append`` stacks the rows on what is there. ``overwrite_partition`` replaces
    the snapshot dates present in ``df`` and no others, so a repeated run leaves
    the same rows. ``partitions`` names those being loaded (column to value): they
    are replaced even when ``df`` has no row for them.
    """
    if mode not in ("append", "overwrite_partition"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns)
    if mode == "append":
        rows.write.insertInto(table)
        return
    before = spark.conf.get(_DYNAMIC)
    spark.conf.set(_DYNAMIC, "dynamic")
    try:
        for one in partitions:  # rows of df never come from the partition it replaces
            spec = ", ".join(f"`{c}` = {v!r}" for c, v in one.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_DYNAMIC, before)


def replace_table(
    df: DataFrame, table: str, partition_by: str | None = None, bucket_by: Sequence[str] = (), buckets: int = 32
) -> DataFrame:
    """Replace a table by the rows of ``df`` and return the stored table.

    ``bucket_by`` stores the rows hashed by these columns into ``buckets`` sorted files, so that joins and aggregates on
    them, between tables of as many buckets, read them in place instead of exchanging them.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:  # dealt by the same hash first, each bucket is one file
        writer = df.repartition(buckets, *bucket_by).write.mode("overwrite").format("parquet")
        writer = (writer.partitionBy(partition_by) if partition_by else writer).bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
