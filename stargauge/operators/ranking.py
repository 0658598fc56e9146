"""Exact ranks and group totals, one way for groups of every size.

The rows are sorted globally by group and order, which cuts a big group over many tasks, and pinned. A row's rank is
its position in its sorted partition plus an offset: the rows of its group in the partitions before. Offsets are one
row for each group and partition; they join back by key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stable

# Row position inside a partition, in monotonically_increasing_id (documented).
_POSITION_BITS = 33


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[Column],
    rank: str = "rank",
    totals: Mapping[str, Column] | None = None,
    first: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add a gap-free 1-based rank (bigint) per group, and group sums of the ``totals`` expressions.

    ``order_by`` must be a total order within a group. With an empty ``group`` the whole table is numbered. ``first``
    is a step to run on the rows before, such as a deduplication. The sorted rows are written to the checkpoint
    folder when this is called, so that both reads of them see the same partitions, also after an executor is lost.
    """
    totals = dict(totals or {})
    rows = first(df) if first else df
    placed = stable(
        rows.orderBy(*group, *order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _POSITION_BITS))
    )
    pieces = placed.groupBy(*group, "_part").agg(
        F.min("_place").alias("_start"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(expr).alias(name) for name, expr in totals.items()],
    )
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(c).alias(f"_of_{c}") for c in group],
        F.col("_part").alias("_of_part"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_start") + 1).alias("_shift"),
        *[F.sum(name).over(whole).alias(name) for name in totals],
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group] + [F.col("_part") == F.col("_of_part")]
    return placed.join(offsets, same).select(*rows.columns, (F.col("_place") + F.col("_shift")).alias(rank), *totals)


def rank_and_share(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    tiebreak: Sequence[str | Column],
    rank: str = "rank",
    total: str = "total",
    core: str | None = None,
    core_k: int = 10,
    counted: Column | None = None,
    **options,
) -> DataFrame:
    """Rank by ``value`` descending and add the group total, optionally over ``counted`` rows only.

    ``core`` adds a flag for the first ``core_k`` ranks.
    """
    part = F.col(value) if counted is None else F.when(counted, F.col(value))
    order = [F.col(value).desc_nulls_last(), *[F.col(t) if isinstance(t, str) else t for t in tiebreak]]
    out = rank_in_group(df, group, order, rank, {total: part}, **options)
    return out.withColumn(core, F.col(rank) <= core_k) if core else out
