"""Dated JSON snapshots: ``<base>/<feed>/date=YYYYMMDD/*.json``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FEEDS
from .arrays import array_objects

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"


def today_utc() -> int:
    """Default run date as an int, yyyymmdd."""
    return int(dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d"))


def feed_path(base: str, feed: str) -> str:
    return f"{base.rstrip('/')}/{feed}"


def feed_schema(feed: str) -> T.StructType:
    """Declared columns of a feed, plus the column that keeps text that could not be parsed."""
    return T.StructType(FEEDS[feed].fields + [T.StructField(CORRUPT, T.StringType(), True)])


def read_snapshots(
    spark: SparkSession, base: str, feed: str, date: int | None = None, lines: bool = False, split: bool = False
) -> DataFrame:
    """Rows of one feed with ``snapshot_date`` taken from the directory.

    A file holds an array of objects or a single object. Spark reads a file of
    that form whole in one task; ``split`` cuts it between objects over many
    tasks (``array_objects``). Files of JSON lines, as ``write_snapshot`` makes
    them, are read with ``lines=True``.
    Unparsable text is kept in ``_corrupt_record``; see ``split_corrupt``. With
    ``split`` that is the one object or the stray text, and the rest of its
    file is kept; otherwise it is the whole array.
    """
    if split:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        parsed = F.array(F.from_json("text", feed_schema(feed), options))  # inline: parsed once, whatever filters follow
        return stamp(array_objects(spark, feed_path(base, feed), date).select(F.inline(parsed), "date"))
    reader = (
        spark.read.schema(feed_schema(feed))
        .option("multiLine", not lines)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    df = reader.json(feed_path(base, feed))
    return at_snapshot(stamp(df), date)


def has_snapshot(spark: SparkSession, base: str, feed: str, date: int) -> bool:
    """Whether the feed has a folder of this date; other failures to look are raised."""
    try:
        spark.read.text(f"{feed_path(base, feed)}/date={date}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def stamp(df: DataFrame) -> DataFrame:
    """Directory date as ``snapshot_date`` (long), replacing any such field of the rows."""
    return df.withColumn("snapshot_date", F.col("date").cast("long")).drop("date")


def at_snapshot(df: DataFrame, date: int | None) -> DataFrame:
    """Rows of one snapshot; every snapshot when no date is given. Prunes partitions."""
    return df if date is None else df.where(F.col("snapshot_date") == F.lit(date).cast("long"))


def one_snapshot(df: DataFrame, date: int | None = None) -> DataFrame:
    """Rows of one snapshot, by default the latest of the table; a table without dates is one snapshot."""
    if "snapshot_date" not in df.columns:
        return df
    if date is not None:
        return at_snapshot(df, date)
    return df.where(F.col("snapshot_date") == df.agg(F.max("snapshot_date")).scalar())


def latest_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the latest snapshot of a stored table partitioned by ``snapshot_date``.

    The date comes from the catalog's list of partitions, so that no row is read
    for it and the scan is pruned to that date when it is planned. Without a
    partition there are no rows.
    """
    listed = F.regexp_extract("partition", r"(?:^|/)snapshot_date=(\d+)(?:/|$)", 1)
    dates = spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(F.nullif(listed, F.lit("")).cast("long")))
    return at_snapshot(spark.table(table), dates.first()[0] or -1)


def stack_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """One table of several dated frames; columns that a frame lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined text with what could be read of it and its snapshot date).

    Both conditions mention every column, so that Spark parses a record the same
    way whatever is selected later; a reader asked for fewer columns would
    overlook errors in the others. The JSON text is only made for corrupt rows.
    """
    fields = [c for c in df.columns if c not in (CORRUPT, "snapshot_date")]
    corrupt, readable = F.col(CORRUPT), F.to_json(F.struct(*fields))
    good = df.where(corrupt.isNull() | readable.isNull()).drop(CORRUPT)
    bad = df.where(corrupt.isNotNull() & readable.isNotNull())
    return good, bad.select(corrupt.alias("corrupt_record"), readable.alias("readable"), "snapshot_date")


def write_snapshot(df: DataFrame, base: str, feed: str, date: int) -> None:
    """Write rows as JSON lines under the feed's dated directory, replacing that date only, also by no rows."""
    df.drop("date").write.mode("overwrite").json(f"{feed_path(base, feed)}/date={date}")
