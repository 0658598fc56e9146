"""What sets a group apart from the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import guarded


def _long(features: Sequence[str], *prefixes: str) -> Column:
    """Array of (feature, value per prefix), to be unfolded with ``inline``."""
    return F.array(*[
        F.struct(F.lit(f).alias("feature"), *[F.col(f"{p}{f}").alias(p[:2]) for p in prefixes])
        for f in features
    ])


def group_profile(df: DataFrame, group: str, features: Sequence[str]) -> DataFrame:
    """Per group and feature: group mean, overall mean, difference in percent and z-score.

    Means are taken in wide form (one pass, one row per group) and unfolded after.
    The overall figures are one row, read as a scalar subquery, not joined.
    """
    means = df.groupBy(group).agg(*[F.avg(f).alias(f"_g_{f}") for f in features])
    overall = df.agg(
        F.struct(*[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).alias("o")
    )
    wide = means.withColumn("_o", overall.scalar())
    for f in features:
        wide = wide.withColumn(f"_m_{f}", F.col(f"_o.m_{f}")).withColumn(f"_s_{f}", F.col(f"_o.s_{f}"))
    long = wide.select(group, F.inline(_long(features, "_g_", "_m_", "_s_")))
    gap = F.col("_g") - F.col("_m")
    return long.select(
        group,
        "feature",
        F.col("_g").alias("group_avg"),
        F.col("_m").alias("overall_avg"),
        guarded(F.col("_m"), gap / F.col("_m") * 100).alias("difference_pct"),
        guarded(F.col("_s"), gap / F.col("_s")).alias("z_score"),
    )


def by_distinctness(profile: DataFrame, group: str) -> DataFrame:
    """Features of each group, the most unusual first."""
    return profile.orderBy(group, F.abs("z_score").desc(), "feature")


def group_means(df: DataFrame, group: str, features: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(f).alias(f) for f in features])
