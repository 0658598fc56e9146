"""Distinct counts over any range of snapshots from one stored sketch a snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SNAPSHOT = "snapshot_date"


def distinct_sketches(df: DataFrame, group: Sequence[str], column: str, precision: int = 14) -> DataFrame:
    """(group, ``sketch``, snapshot_date): a HyperLogLog sketch of the non-null values of ``column``, a group and snapshot.

    Sketches are of at most 2^precision bytes, whatever the number of values, and are built before the exchange. A
    group without a value has an empty sketch. Store them with ``append_snapshot``: a reload replaces its date only.
    """
    return df.groupBy(*group, SNAPSHOT).agg(F.hll_sketch_agg(column, precision).alias("sketch")).select(*group, "sketch", SNAPSHOT)


def distinct_over(sketches: DataFrame, group: Sequence[str], since: int | None = None, until: int | None = None, out: str = "distinct") -> DataFrame:
    """(group, ``out``): about how many distinct values a group has in the snapshots from ``since`` to ``until``, both included.

    The sketches of the range are united; the values themselves are not read again, and a value of several snapshots
    counts once. The standard error is ``distinct_error(precision)`` of the count, 0.8 % for the default precision;
    small counts are nearly exact. The bounds prune the partitions of a stored table.
    """
    if since is not None:
        sketches = sketches.where(F.col(SNAPSHOT) >= F.lit(since).cast("long"))
    if until is not None:
        sketches = sketches.where(F.col(SNAPSHOT) <= F.lit(until).cast("long"))
    return sketches.groupBy(*group).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def distinct_error(precision: int = 14) -> float:
    """Relative standard error of a count from united sketches."""
    return 1.04 / 2 ** (precision / 2)
