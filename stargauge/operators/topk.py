"""Top-k of a column, and joins against it. The top-k side never exceeds k rows, so it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SUMMARISED = (T.StringType, T.IntegralType, T.DateType)


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per non-null value, unordered."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; equal counts go by value."""
    return value_counts(df, column, "_n").orderBy(F.desc("_n"), column).limit(k).select(column)


def top_counts(df: DataFrame, column: str, k: int, count: str = "n", tracked: int = 100_000, candidates: int = 0) -> DataFrame:
    """The ``k`` most frequent values with their exact counts, without exchanging the others; equal counts go by value.

    A mergeable frequent-item summary (at most ``tracked`` counters a task) names some ``candidates`` (20 a place unless
    given) and bounds the count of every other value by the smallest estimate among them; the candidates alone are
    counted exactly. The answer stands if the k-th of them lies above the bound, or if they are all there is.
    Otherwise, as in a column whose values are all about as frequent, all values are counted. Both passes over ``df``
    run when this is called; the driver sees the candidates only.
    """
    full = value_counts(df, column, count).orderBy(F.desc(count), column).limit(k)
    field = df.schema[column]
    if k < 1 or not isinstance(field.dataType, _SUMMARISED):
        return full
    places = max(candidates or 20 * k, k)
    quoted = column.replace("`", "``")
    named, rows = df.agg(
        F.expr(f"transform(approx_top_k(`{quoted}`, {places}, {max(tracked, places)}), t -> named_struct('v', t.item, 'n', t.count))"),
        F.count(F.col(f"`{quoted}`")),
    ).first()
    if not named:
        return full
    schema = T.StructType([T.StructField(column, field.dataType)])
    wanted = df.sparkSession.createDataFrame([(t.v,) for t in named], schema)
    exact = value_counts(df.select(column).join(F.broadcast(wanted), column, "left_semi"), column, count).collect()
    exact.sort(key=lambda r: -r[1])
    bound = min(t.n for t in named)
    if sum(r[1] for r in exact) != rows and (len(exact) < k or exact[k - 1][1] <= bound):
        return full
    counted = T.StructType([*schema.fields, T.StructField(count, T.LongType())])
    return df.sparkSession.createDataFrame(exact, counted).orderBy(F.desc(count), column).limit(k)


def top_k_semi(df: DataFrame, column: str, k: int, among: DataFrame | None = None) -> DataFrame:
    """Rows whose value is one of the ``k`` most frequent ones (of ``among``, if given)."""
    top = top_values(df if among is None else among, column, k)
    return df.join(F.broadcast(top), column, "left_semi")


def other_bucket(df: DataFrame, column: str, k: int, out: str, other: str = "Other") -> DataFrame:
    """Add ``out``: the value itself for the ``k`` most frequent values, ``other`` for all else and null."""
    top = top_values(df, column, k).withColumnRenamed(column, "_top")
    joined = df.join(F.broadcast(top), F.col(column) == F.col("_top"), "left")
    return joined.withColumn(out, F.coalesce("_top", F.lit(other))).drop("_top")


def n_largest(df: DataFrame, n: int, column: str, tiebreak: Sequence[str]) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), *tiebreak).limit(n)


def distinct_options(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in alphabetic order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
