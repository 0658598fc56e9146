"""Turning a mixed table into numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import ensure_table
from .ranking import rank_in_group

CODES = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("value", T.StringType()), T.StructField("code", T.LongType()),
])


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    """Column names split into number, flag, time, text and list."""
    kinds: dict[str, list[str]] = {k: [] for k in ("number", "flag", "time", "text", "list")}
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, T.NumericType):
            kinds["number"].append(field.name)
        elif isinstance(kind, T.BooleanType):
            kinds["flag"].append(field.name)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            kinds["time"].append(field.name)
        elif isinstance(kind, T.StringType):
            kinds["text"].append(field.name)
        elif isinstance(kind, T.ArrayType):
            kinds["list"].append(field.name)
    return kinds


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes table (column, value, code): 1, 2, ... in alphabetic order per column.

    All columns are coded in one scan. Distinct values are combined before the
    shuffle and numbered by a global sort, whose rows are pinned; the joins of
    ``label_encode`` read the pinned codes and never the table again.
    """
    return rank_in_group(_distinct_values(df, columns), ["column"], [F.col("value")], "code")


def _distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct()


def extend_codes(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """The stored codes of ``columns`` after those values of ``df`` that have none yet were added to ``table``.

    A value keeps its code for good: unseen ones take the numbers behind the
    largest of their column, in alphabetic order among themselves, so that the
    first call gives the codes of ``label_codes``. The table is created if
    absent and only ever appended to, by one job; a call that finds nothing new
    leaves it as it is. One writer at a time.
    """
    spark = df.sparkSession
    ensure_table(spark, table, CODES, partition_by=None)
    known = spark.table(table).where(F.col("column").isin(list(columns)))
    unseen = _distinct_values(df, columns).join(known, ["column", "value"], "left_anti")
    largest = known.groupBy("column").agg(F.max("code").alias("_largest"))  # a row a column, at most
    numbered = rank_in_group(unseen, ["column"], [F.col("value")], "_place").join(F.broadcast(largest), "column", "left")
    code = F.col("_place") + F.coalesce("_largest", F.lit(0))
    numbered.select("column", "value", code.alias("code")).write.insertInto(table)
    return spark.table(table).where(F.col("column").isin(list(columns)))


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_label", code_table: str | None = None) -> DataFrame:
    """Replace text columns by their codes; null becomes 0.

    Codes are numbered anew, or kept from run to run in ``code_table``
    (``extend_codes``). Plain equi-joins: Spark broadcasts a code table that
    turns out small and sorts both sides otherwise.
    """
    if not columns:
        return df
    codes = extend_codes(df, columns, code_table) if code_table else label_codes(df, columns)
    for c in columns:
        own = codes.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        df = (
            df.join(own, F.col(c) == F.col("_v"), "left")
            .withColumn(c + suffix, F.coalesce("_code", F.lit(0)))
            .drop(c, "_v", "_code")
        )
    return df


def encode_numeric(df: DataFrame, key: str, exclude: Sequence[str] = (), code_table: str | None = None) -> DataFrame:
    """The key and one number per other column.

    Numbers and flags keep their value with 0 for null, times become whole
    seconds since 1970, texts and lists become codes (lasting ones with a
    ``code_table``). Identifiers belong in ``exclude``: their codes carry no
    meaning.
    """
    kinds = {k: [c for c in cols if c != key and c not in exclude] for k, cols in columns_by_kind(df).items()}
    text = kinds["text"] + kinds["list"]
    plain = df.select(
        key,
        *[F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) for c in kinds["number"]],
        *[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in kinds["flag"]],
        *[F.coalesce(F.unix_timestamp(F.col(c).cast("timestamp")), F.lit(0)).alias(c) for c in kinds["time"]],
        *kinds["text"],
        *[F.to_json(c).alias(c) for c in kinds["list"]],
    )
    return label_encode(plain, text, code_table=code_table)
