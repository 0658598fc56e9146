"""Structured metadata out of free text.

Two annotators share one record shape. ``KeywordAnnotator`` is a set of Spark
expressions and needs no service; an index from the beginnings of words to its
rules is looked up once a text, and only rules whose words occur are tried. ``annotate_replies`` runs any Python function
(a client of a hosted model, say) over Arrow batches; its replies are parsed
back in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import matches, parse_json_record
from ..schemas import AUDIENCES, CATEGORIES, COMPLEXITY_LEVELS, ENRICHMENT, USE_CASES
from ..sources.tables import ensure_table

FIELDS = [f.name for f in ENRICHMENT.fields]
UNICODE = "(?U)"
_MARK = 3  # letters of a word's beginning by which rules are looked up
ANNOTATIONS = T.StructType(
    [T.StructField("hash", T.StringType()), T.StructField("outcome", T.StringType()), *ENRICHMENT.fields, T.StructField("annotator", T.StringType())]
)

# Our default rules: a category is the first pattern found, lists hold every one found.
CATEGORY_RULES = {
    "AI/ML": r"\bmachine learning\b|\bneural\b|\bdeep learning\b|\bmodels?\b.{0,40}\btrain",
    "DevOps": r"\bkubernetes\b|\bdocker\b|\bci/cd\b|\bdeploy",
    "Databases": r"\bdatabase\b|\bsql\b|\bkey-value\b",
    "Networking": r"\bnetwork|\bproxy\b|\btcp\b|\bdns\b",
    "Graphics": r"\bgraphics\b|\brender|\bopengl\b|\bshader",
    "Embedded": r"\bembedded\b|\bfirmware\b|\barduino\b",
    "System Programming": r"\bcompiler\b|\bkernel\b|\bruntime\b",
    "System Tools": r"\bfilesystem\b|\bmonitor|\bterminal emulator\b",
    "Web Tools": r"\bweb\b|\bfrontend\b|\bhttp\b|\bbrowser\b",
    "CLI Tools": r"\bcommand[- ]line\b|\bcli\b",
}
STACK_RULES = {
    "Python": r"\bpython\b", "JavaScript": r"\bjavascript\b", "TypeScript": r"\btypescript\b",
    "Go": r"\bgolang\b|\bgo (get|install|build)\b", "Rust": r"\brust\b|\bcargo\b", "Java": r"\bjava\b",
    "C++": r"\bc\+\+", "Ruby": r"\bruby\b", "PHP": r"\bphp\b",
}
AUDIENCE_RULES = {
    "sysadmin": r"\bsysadmin|\badministrator", "backend-dev": r"\bbackend\b|\bserver\b",
    "frontend-dev": r"\bfrontend\b|\bcss\b|\breact\b", "ML-engineer": r"\bmachine learning\b|\btraining\b",
    "researcher": r"\bresearch", "IT-ops": r"\boperations\b|\bmonitor", "security-engineer": r"\bsecurity\b|\bencrypt",
    "data-engineer": r"\betl\b|\bdata pipelines?\b|\bspark\b", "general-user": r"\beasy to use\b|\bbeginners?\b",
}
USE_CASE_RULES = {
    "monitoring": r"\bmonitor", "deployment": r"\bdeploy", "data-processing": r"\bdata processing\b|\betl\b",
    "computer-vision": r"\bcomputer vision\b|\bopencv\b", "graphics": r"\bgraphics\b|\brender",
    "caching": r"\bcach(e|ing)\b", "database": r"\bdatabase\b|\bsql\b", "cli-automation": r"\bcli\b|\bcommand[- ]line\b",
    "web-server": r"\bweb server\b|\bhttp server\b", "networking": r"\bnetwork", "devops": r"\bdevops\b|\bci/cd\b",
}


@dataclass(frozen=True)
class KeywordAnnotator:
    """Regex rules over lower-cased text, word boundaries in the Unicode sense; complexity follows from the length."""

    categories: Mapping[str, str] = field(default_factory=lambda: CATEGORY_RULES)
    stack: Mapping[str, str] = field(default_factory=lambda: STACK_RULES)
    audience: Mapping[str, str] = field(default_factory=lambda: AUDIENCE_RULES)
    use_cases: Mapping[str, str] = field(default_factory=lambda: USE_CASE_RULES)
    other: str = "Other"
    length_steps: tuple[int, int] = (2_000, 10_000)

    def marks(self, text: Column) -> Column:
        """Beginnings of words in the text that some rule asks for: one pass over it, whatever the number of rules; null if none asks."""
        wanted = sorted({m for rules in (self.categories, self.stack, self.audience, self.use_cases) for p in rules.values() for m in rule_marks(p) or ()})
        if not wanted:
            return F.lit(None).cast("array<string>")
        words = F.regexp_extract_all(F.lower(text), F.lit(rf"{UNICODE}\b\w{{{_MARK}}}"), F.lit(0))
        return F.array_intersect(words, _strings(wanted))

    def record(self, text: Column, marks: Column | None = None) -> dict[str, Column]:
        """The fields found in a text; with its ``marks``, only the regexes of rules whose words occur are run."""
        low = F.lower(text)

        def holds(pattern: str) -> Column:
            asked = rule_marks(pattern) if marks is not None else None
            found = matches(low, UNICODE + pattern)
            return found if asked is None else F.arrays_overlap(marks, _strings(sorted(asked))) & found

        def all_found(rules: Mapping[str, str]) -> Column:
            return F.array_compact(F.array(*[F.when(holds(p), F.lit(n)) for n, p in rules.items()]))

        score = (
            F.when(F.length(text) < self.length_steps[0], 1)
            .when(F.length(text) < self.length_steps[1], 2)
            .otherwise(3)
        )
        found = {
            "category": F.coalesce(*[F.when(holds(p), F.lit(n)) for n, p in self.categories.items()], F.lit(self.other)),
            "tech_stack": all_found(self.stack),
            "complexity_level": F.element_at(F.array(*[F.lit(x) for x in COMPLEXITY_LEVELS]), score),
            "complexity_score": score.cast("long"),
            "audience": all_found(self.audience),
            "use_cases": all_found(self.use_cases),
        }
        has_text = F.length(text) > 0
        return {name: F.when(has_text, value) for name, value in found.items()}


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _alternatives(pattern: str) -> list[str]:
    """A pattern cut at the bars outside its groups and character classes."""
    out, depth, in_class, i = [""], 0, False, 0
    while i < len(pattern):
        step = pattern[i:i + 2] if pattern[i] == "\\" else pattern[i]
        if step == "[":
            in_class = True
        elif step == "]":
            in_class = False
        elif not in_class and step in "()":
            depth += 1 if step == "(" else -1
        if step == "|" and depth == 0 and not in_class:
            out.append("")
        else:
            out[-1] += step
        i += len(step)
    return out


def rule_marks(pattern: str) -> frozenset[str] | None:
    """Beginnings of words without one of which the pattern cannot match; None if it can match without a known word.

    Known are the first letters of a whole alternative that starts at a word boundary.
    """
    if "(?" in pattern or "\\Q" in pattern:
        return None
    marks = set()
    for alternative in _alternatives(pattern):
        start = re.match(rf"\\b([a-z0-9]{{{_MARK}}})(?![?*{{])", alternative)
        if not start:
            return None
        marks.add(start.group(1))
    return frozenset(marks)


def enrich(df: DataFrame, key: str, text: str, annotator: KeywordAnnotator | None = None) -> DataFrame:
    """One record per row of ``df``; a missing or empty text gives an all-null record."""
    rules = annotator or KeywordAnnotator()
    marked = df.select(key, F.col(text).alias("_text"), rules.marks(F.col(text)).alias("_marks"))
    record = rules.record(F.col("_text"), F.col("_marks"))
    return marked.select(key, *[record[name].alias(name) for name in FIELDS])


def annotate_replies(df: DataFrame, key: str, text: str, annotator: Callable[[str], str | None], outcome: str | None = None) -> DataFrame:
    """As ``enrich``, with ``annotator(text) -> reply`` run in the tasks.

    The reply is free text with a JSON object in it. A failure of the annotator,
    like a missing text or an unusable reply, gives an all-null record; no row is
    lost. ``outcome`` names a column that tells these apart: ``ok``, ``no text``,
    ``failed`` (the annotator raised) or ``unusable``; count it to notice an
    outage. Store the result: a recomputed task calls the annotator again.
    """

    def answer(value: str | None) -> tuple[str | None, bool]:
        if not value:
            return None, False
        try:
            return annotator(value), False
        except Exception:  # noqa: BLE001 - one bad text must not fail the job; it is reported as failed
            return None, True

    @F.pandas_udf("reply string, failed boolean")
    def replies(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([answer(value) for value in batch], columns=["reply", "failed"])

    asked = replies.asNondeterministic()(F.col(text))  # a filter on the outcome must not ask a second time
    answered = df.select(key, F.col(text).alias("_text"), asked.alias("_answer"))
    parsed = answered.withColumn("_record", parse_json_record(F.col("_answer.reply"), ENRICHMENT))
    usable = F.coalesce(*[F.col(f"_record.{name}").cast("string") for name in FIELDS]).isNotNull()
    told = (
        F.when(F.coalesce(F.length("_text"), F.lit(0)) == 0, "no text").when(F.col("_answer.failed"), "failed")
        .when(usable, "ok").otherwise("unusable")
    )
    return parsed.select(
        key, *[F.col(f"_record.{name}").alias(name) for name in FIELDS], *([told.alias(outcome)] if outcome else [])
    )


def annotate_changed(
    df: DataFrame, key: str, text: str, annotator: Callable[[str], str | None], table: str, version: str, outcome: str | None = None
) -> DataFrame:
    """As ``annotate_replies``, asking only about texts that ``version`` of the annotator has not answered yet.

    Answers are stored in ``table`` (created if absent) by the SHA-256 of the
    text and by version, when this is called; equal texts are asked about once.
    An unusable reply counts as an answer, a failure does not: such texts are
    asked about again by the next call and have the outcome ``failed`` till then.
    Every row of ``df`` is returned, null and empty texts with an all-null
    record. Of all texts only the hashes are exchanged to find the new ones.
    """
    spark = df.sparkSession
    ensure_table(spark, table, ANNOTATIONS, partition_by="annotator")
    rows = df.select(key, F.col(text).alias("_text"), F.when(F.length(text) > 0, F.sha2(text, 256)).alias("_hash"))

    def answers() -> DataFrame:
        own = spark.table(table).where(F.col("annotator") == version).drop("annotator")
        return own.withColumnsRenamed({c: f"_{c}" for c in own.columns}).dropDuplicates(["_hash"])

    hashes = rows.select("_hash").where(F.col("_hash").isNotNull()).distinct()
    unseen = rows.select("_hash", "_text").join(hashes.join(answers(), "_hash", "left_anti"), "_hash", "left_semi").dropDuplicates(["_hash"])
    replies = annotate_replies(unseen, "_hash", "_text", annotator, "outcome").where(F.col("outcome") != "failed")
    stored = replies.withColumnRenamed("_hash", "hash").withColumn("annotator", F.lit(version))
    stored.select(*ANNOTATIONS.names).write.insertInto(table)
    told = F.when(F.col("_hash").isNull(), "no text").otherwise(F.coalesce("_outcome", F.lit("failed")))
    return rows.drop("_text").join(answers(), "_hash", "left").select(
        key, *[F.col(f"_{name}").alias(name) for name in FIELDS], *([told.alias(outcome)] if outcome else [])
    )


def vocabulary_report(
    df: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    levels: Sequence[str] = COMPLEXITY_LEVELS,
    audiences: Sequence[str] = AUDIENCES,
    use_cases: Sequence[str] = USE_CASES,
) -> DataFrame:
    """How many records hold a value outside each closed vocabulary."""

    def outside(column: str, allowed: Sequence[str]) -> Column:
        return F.size(F.array_except(column, F.array(*[F.lit(a) for a in allowed]))) > 0

    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(~F.col("category").isin(list(categories))).alias("bad_category"),
        F.count_if(~F.col("complexity_level").isin(list(levels))).alias("bad_level"),
        F.count_if(outside("audience", audiences)).alias("bad_audience"),
        F.count_if(outside("use_cases", use_cases)).alias("bad_use_cases"),
    )
