"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import rank_in_group

def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Keep, per key, the row with the largest ``order_by``; nulls come last.

    ``tiebreak`` must make the order total. Spark turns the ``= 1`` filter into a
    group limit before the exchange, so a key that holds a third of the table
    still ships at most one row per input task.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(order_by).desc_nulls_last(), *tiebreak)
    return _first_rows(df, order, 1)


def top_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group, pruned before the exchange as above.

    Spark prunes up to the ``n`` of its own setting; for a larger ``n`` the groups
    are ranked in full, spread over tasks.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return rank_in_group(df, group, order_by, "_place").where(F.col("_place") <= n).drop("_place")
    return _first_rows(df, Window.partitionBy(*group).orderBy(*order_by), n)


def _first_rows(df: DataFrame, order, n: int) -> DataFrame:
    return df.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= n).drop("_place")


def first_existing(df: DataFrame, key: str, name: str, preference: Sequence[str], tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Per key, the row whose ``name`` comes earliest in ``preference``; unlisted names are dropped."""
    place = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(name))
    listed = df.withColumn("_pref", place).where(F.col("_pref") > 0)
    return top_per_group(listed, [key], [F.col("_pref"), *tiebreak], 1).drop("_pref")
