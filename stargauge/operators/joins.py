"""Equi-joins with the naming rules the reports need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_suffixed(left: DataFrame, right: DataFrame, left_on: str, right_on: str, suffix: str) -> DataFrame:
    """Left join on differently named keys; right columns that collide get ``suffix``."""
    renamed = right.select(*[
        F.col(c).alias(c + suffix if c in left.columns else c) for c in right.columns
    ])
    key = right_on + suffix if right_on in left.columns else right_on
    return left.join(renamed, left[left_on] == renamed[key], "left")


def fallback(df: DataFrame, out: str, *columns: str) -> DataFrame:
    """First non-null of several columns; missing columns are skipped."""
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in present(df, columns)]))


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the listed columns the table has, in the listed order."""
    return [c for c in columns if c in df.columns]


def search(df: DataFrame, minimum: dict[str, float] | None = None, **facets: Sequence | None) -> DataFrame:
    """Rows that match any listed value of every facet and reach every minimum; an empty facet is no filter."""
    tests: list[Column] = [F.col(c).isin(list(values)) for c, values in facets.items() if values]
    tests += [F.col(c) >= low for c, low in (minimum or {}).items()]
    for test in tests:
        df = df.where(test)
    return df


def lookup(df: DataFrame, key: str, value, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First row of one key; the value is bound, never spliced into text."""
    found = df.where(F.col(key) == F.lit(value))
    return found.orderBy(*order_by).limit(1) if order_by else found.limit(1)


def drill_down(df: DataFrame, condition: Column, columns: Sequence[str | Column], order_by: Sequence[Column | str], renames: dict[str, str] | None = None) -> DataFrame:
    """Filter, project and sort; then show the columns under report names."""
    return df.where(condition).orderBy(*order_by).select(*columns).withColumnsRenamed(renames or {})
