"""Session helpers shared by tests, the benchmark and the jobs."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "stargauge", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only a local session may pick its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stargauge-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def stable(df: DataFrame) -> DataFrame:
    """Pin the rows of ``df`` in reliable storage, so later reads see the same partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application; needless where it is installed on them."""
    sc = spark.sparkContext
    if getattr(sc, "_stargauge_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(top)
    target = os.path.join(tempfile.mkdtemp(prefix="stargauge-"), f"{name}.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, files in os.walk(top):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join(name, os.path.relpath(path, top)))
    sc.addPyFile(target)
    sc._stargauge_shipped = True
