"""Column expressions that measure README text."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# Our definitions: which words announce a section. Case is ignored, and (?U) makes
# word boundaries know every letter, whichever Java version runs. Every match
# holds one of the stems, a cheap test that spares most texts the pattern.
SECTION_PATTERNS: dict[str, tuple[list[str], str]] = {
    "has_installation": (["install", "setup", "getting started"], r"(?U)\b(install(ation|ing)?|setup|getting started)\b"),
    "has_usage": (["usage", "how to use", "example", "quick"], r"(?U)\b(usage|how to use|examples?|quick ?start)\b"),
    "has_contributing": (["contribut"], r"(?U)\bcontribut(e|ing|ions?|ors?)\b"),
    "has_license": (["licen"], r"(?U)\blicen[cs]e"),
    "has_tests": (["test"], r"(?U)\b(tests?|testing)\b"),
    "has_documentation": (["documentation", "docs"], r"(?U)\b(documentation|docs)\b"),
    "has_badges": (["badge", "shields.io"], r"!\[[^\]]*\]\([^)]*(badge|shields\.io)[^)]*\)"),
}
# The six sections that count towards completeness, with their display names.
COMPLETENESS: dict[str, str] = {
    "has_installation": "Installation",
    "has_usage": "Usage",
    "has_contributing": "Contributing",
    "has_license": "License",
    "has_tests": "Tests",
    "has_documentation": "Documentation",
}
PREVIEW_CHARS = 500


def decode_content(content: Column, encoding: Column) -> Column:
    """Text of an API README body; base64 may hold line breaks."""
    plain = F.decode(F.unbase64(F.regexp_replace(content, r"\s", "")), "UTF-8")
    return F.when(F.lower(encoding) == "base64", plain).otherwise(content)


def text_metrics(text: Column) -> dict[str, Column]:
    """Counts per text. A text without a pattern's fixed part is not searched for the pattern."""
    return {
        "content_length": F.length(text),
        "word_count_estimate": F.regexp_count(text, F.lit(r"\S+")),
        "line_count": F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1,
        "header_count": _count_if_held(text, "#", r"(?m)^#{1,6}\s"),
        "code_block_count": F.floor(_count_if_held(text, "```", r"(?m)^```") / 2).cast("int"),
        "link_count": _count_if_held(text, "](", r"(?<!!)\[[^\]]*\]\([^)]*\)"),
        "image_count": _count_if_held(text, "![", r"!\[[^\]]*\]\([^)]*\)"),
    }


def _count_if_held(text: Column, held: str, pattern: str) -> Column:
    return F.when(~text.contains(held), 0).otherwise(F.regexp_count(text, F.lit(pattern)))


def section_flags(text: Column, patterns: dict[str, tuple[list[str], str]] = SECTION_PATTERNS) -> dict[str, Column]:
    low = F.lower(text)
    flags = {}
    for name, (stems, pattern) in patterns.items():
        held = functools.reduce(operator.or_, [low.contains(stem) for stem in stems])
        flags[name] = F.coalesce(held & low.rlike(pattern), F.lit(False))
    return flags


def sections_present(flags: dict[str, str] = COMPLETENESS) -> Column:
    return sum((F.coalesce(F.col(c), F.lit(False)).cast("int") for c in flags), F.lit(0))


def missing_sections(flags: dict[str, str] = COMPLETENESS) -> Column:
    absent = [F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(label)) for c, label in flags.items()]
    return F.array_compact(F.array(*absent))
