"""Column expressions for dates, ratios, bands and ordered levels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365

# The two age bandings, right-closed, in years.
AGE_EDGES = [0, 2, 5, 10, 15, 100]
AGE_LABELS = ["0-2 years", "2-5 years", "5-10 years", "10-15 years", "15+ years"]
STAGE_EDGES = [0, 3, 7, 12, 100]
STAGE_LABELS = ["New (0-3y)", "Growing (3-7y)", "Mature (7-12y)", "Legacy (12y+)"]


def as_time(column: Column, kind: str) -> Column:
    """ISO text becomes a timestamp; a column that already holds times is left as it is."""
    return F.try_to_timestamp(column) if kind == "string" else column


def date_literal(day: dt.date | str) -> Column:
    return F.lit(day).cast("date")


def age_days(as_of: dt.date | str, created: Column) -> Column:
    return F.datediff(date_literal(as_of), F.to_date(created)).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null, never an error, on a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def share_pct(part: Column, total: Column, digits: int = 2) -> Column:
    """Rounded percentage. Multiplied first: one division keeps an exact half a half."""
    return F.round(ratio(part.cast("double") * 100, total), digits)


def guarded(denominator: Column, value: Column, otherwise: float = 0.0) -> Column:
    """``value`` where the denominator is positive, a plain default elsewhere."""
    return F.when(denominator > 0, value).otherwise(F.lit(otherwise))


def years(days: Column) -> Column:
    return days / DAYS_PER_YEAR


def whole_years(days: Column) -> Column:
    return F.floor(days / DAYS_PER_YEAR).cast("long")


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval that holds ``value``; null outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs one more edge than labels")
    bands = [
        F.when((value > low) & (value <= high), F.lit(label))
        for low, high, label in zip(edges, edges[1:], labels)
    ]
    return F.coalesce(*bands)


def at_least(value: Column, floor: float) -> Column:
    """The larger of the value and a floor; a missing value becomes the floor."""
    return F.greatest(F.coalesce(value, F.lit(floor)), F.lit(floor))


def level_position(value: Column, levels: Sequence[str]) -> Column:
    """1-based place of a level in its declared order; null for an unknown level."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in levels]), value), F.lit(0))


def count_or_zero(value: Column) -> Column:
    """Whole number for a card: a missing value shows as 0."""
    return F.coalesce(value, F.lit(0)).cast("long")


def lookup_label(key: Column, names: dict[int, str], unknown_prefix: str | None = None) -> Column:
    """Name of an id; an unknown id gives null, or the prefix followed by the id."""
    pairs = [F.lit(x) for item in sorted(names.items()) for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    if unknown_prefix is None:
        return found
    return F.coalesce(found, F.concat(F.lit(unknown_prefix), key.cast("string")))
