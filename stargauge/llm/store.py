"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package as ship_package

#: A side of a join is broadcast up to this many rows of a few numbers each; beyond it Spark joins by shuffle.
BROADCAST_ROWS = 500_000
#: Spark's setting by which a query deletes its shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(spark)
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and a lost executor loses nothing.

    The shuffle files behind it are deleted, as nothing reads them again.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a written table that nothing reads again."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the counted ``rows`` are within ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def hash_sample(df: DataFrame, rows: int, wanted: int, *columns: str) -> DataFrame:
    """About ``wanted`` of the ``rows`` rows, those with a small hash of the columns; never more than twice as many.

    A filter, so that no task and no driver sorts or gathers more than the sample.
    """
    part = F.pmod(F.xxhash64(*columns), F.lit(1 << 30))
    return df.where(part < F.lit(max(1, round((1 << 30) * min(1.0, wanted / max(rows, 1)))))).limit(2 * wanted)
