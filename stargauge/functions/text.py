"""Column expressions over commit and contributor text. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Commit prefixes in the order they are tried, on lower-cased text.
COMMIT_TYPES: dict[str, str] = {
    "feat": r"^feat[:(]",
    "fix": r"^fix[:(]",
    "docs": r"^docs[:(]",
    "refactor": r"^refactor[:(]",
    "test": r"^test[:(]",
    "chore": r"^chore[:(]",
}
# Automation patterns, and the shape of a usable address. The end
# anchor is \z because Java's $ also matches before a final line break.
BOT_NAME = r"bot|dependabot|renovate|github-actions"
BOT_EMAIL = r"bot|noreply|automated"
EMAIL_SHAPE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
SHORT_MESSAGE = 10
MISSING_LOGIN = "unknown_contributor"


def matches(text: Column, pattern: str) -> Column:
    """Regex search where a null text counts as no match."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def normalise_email(email: Column) -> Column:
    """Lower-case with every kind of outer white space removed, not only blanks."""
    return F.lower(F.regexp_replace(email, r"^[\s\p{Z}]+|[\s\p{Z}]+\z", ""))


def first_match(text: Column, patterns: Mapping[str, str], default: str = "other") -> Column:
    """Name of the first pattern found in ``text``; ``default`` when none is."""
    labels = [F.when(matches(text, p), F.lit(name)) for name, p in patterns.items()]
    return F.coalesce(*labels, F.lit(default))


def commit_type(message: Column, patterns: Mapping[str, str] = COMMIT_TYPES) -> Column:
    return first_match(F.lower(message), patterns)


def is_bot(author: Column, email: Column, name_pattern: str = BOT_NAME, email_pattern: str = BOT_EMAIL) -> Column:
    return matches(F.lower(author), name_pattern) | matches(F.lower(email), email_pattern)


def is_valid_email(email: Column) -> Column:
    return matches(email, EMAIL_SHAPE)


def is_merge(message: Column) -> Column:
    return F.coalesce(F.lower(message).startswith("merge"), F.lit(False))


def commit_quality(bot: Column, valid_email: Column, length: Column) -> Column:
    return (
        F.when(bot, "bot_commit")
        .when(~valid_email, "invalid_email")
        .when(length < SHORT_MESSAGE, "short_message")
        .otherwise("valid")
    )


def contributor_quality(login: Column, contributions: Column, contributor_id: Column) -> Column:
    return (
        F.when(login == MISSING_LOGIN, "missing_login")
        .when(contributions < 1, "invalid_contributions")
        .when(contributor_id.isNull(), "missing_id")
        .otherwise("valid")
    )


def parse_list_text(text: Column) -> Column:
    """Items of a printed list such as ``['a' 'b']`` or ``["a", "b"]``; nothing printed gives an empty list."""
    body = F.regexp_replace(text, r"^\s*\[([\s\S]*)\]\s*\z", "$1")
    parts = F.split(F.translate(body, '"', "'"), r"'\s*,?\s*'")
    items = F.transform(parts, lambda p: F.regexp_replace(p, r"^\s*'*\s*|\s*'*\s*\z", ""))
    kept = F.filter(items, lambda p: (p != "") & (p != "None"))
    empty = F.array().cast("array<string>")
    return F.when(text.isNull() | text.isin("None", "nan", "[]", ""), empty).otherwise(kept)


def list_label(items: Column, fallback: str, first: int | None = None, width: int | None = None) -> Column:
    """Comma-joined display text of a list, with a label for null and an optional cut."""
    shown = F.slice(items, 1, first) if first else items
    label = F.coalesce(F.array_join(shown, ", "), F.lit(fallback))
    return F.substring(label, 1, width) if width else label


def first_json_object(text: Column) -> Column:
    """The first ``{...}`` of a free-text answer, up to its first closing brace; null without one."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*?\}", 0), F.lit(""))


def parse_json_record(text: Column, schema) -> Column:
    """Typed record out of free text; every field is null when the text holds no usable object."""
    return F.from_json(first_json_object(text), schema)
