"""Secret scan: candidate strings, and a random forest that removes false positives.

Candidates are values given to a name (``name = value``), whole and of any length and characters, and runs of token
characters that mix letters with digits or capitals with small letters. The forest sees only numbers: length, how often the character class changes, the
share of the candidate that dictionary words cover, its variety, and what stands in the path and in the words around
it. It is trained on labelled findings.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import hash_sample
from .words import batches, record

#: Names that hold secrets, and words that mark examples; matched within lower-case neighbouring words and paths.
SECRET_NAMES = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "private_key", "credential", "auth")
EXAMPLE_WORDS = ("example", "sample", "dummy", "placeholder", "test", "changeme", "xxxx", "your")
FEATURES = (
    "length", "class_changes", "covered", "distinct_share", "entropy", "digit_share", "capital_share", "longest_letters",
    "hex", "assigned", "quoted", "secret_name", "example_near", "path_depth", "path_example", "words_before",
)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_~.-]{8,}={0,2}")
_ASSIGNED = re.compile(r"([A-Za-z_][A-Za-z0-9_.-]*)[\"'`]?\]?\s*(?:=|:=?|=>)\s*([\"'`]?)$")
#: A name and the sign after it, and the value that follows. Each run is entered once and never given back.
_NAME = re.compile(r"(?<![A-Za-z0-9_.-])[0-9.-]*+([A-Za-z_][A-Za-z0-9_.-]*+)[\"'`]?\]?[^\S\n]*+(?:=>|:=|=(?!=)|:(?!:|//))[^\S\n]*+")
_QUOTED = re.compile(r"\"((?:[^\"\\\n]|\\.)++)\"|'((?:[^'\\\n]|\\.)++)'|`((?:[^`\\\n]|\\.)++)`")
_PLAIN = re.compile(r"[\"'`]?((?:(?![&;,?|][\"'`]?[A-Za-z_][A-Za-z0-9_.-]*+[\"'`]?[=:])\S)++)")
_BRACKETS = {")": "(", "]": "[", "}": "{", ">": "<"}
_NEAR = 48

_FINDING = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("value", pa.string()), ("before", pa.string()), *((k, pa.float64()) for k in FEATURES)])


def dictionary_of(pieces: Iterable[tuple[bytes, bool]], least: int = 4) -> frozenset[str]:
    """Alphabetic pieces of a public vocabulary with ``least`` letters at least."""
    return frozenset(t for t in (b.decode("utf-8", "ignore") for b, _ in pieces) if len(t) >= least and t.isalpha())


def covered_share(value: str, dictionary: frozenset[str], longest: int = 16) -> float:
    """Share of the characters that words of the dictionary cover, the longest word first from left to right."""
    text, at, covered = value.lower(), 0, 0
    while at < len(text):
        size = next((n for n in range(min(longest, len(text) - at), 3, -1) if text[at: at + n] in dictionary), 0)
        covered += size
        at += size or 1
    return covered / max(len(text), 1)


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def finding_features(value: str, before: str, path: str, dictionary: frozenset[str]) -> tuple[float, ...]:
    kinds = [_kind(c) for c in value]
    n, counts = len(value), Counter(value)
    name = _ASSIGNED.search(before)
    near, place = before.lower(), path.lower()
    words = near.split()[-3:]
    return (
        float(n), sum(a != b for a, b in zip(kinds, kinds[1:])) / n, covered_share(value, dictionary), len(counts) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()), kinds.count(2) / n, kinds.count(1) / n,
        float(max(map(len, re.findall(r"[A-Za-z]+", value)), default=0)), float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))),
        float(bool(name)), float(bool(name and name[2])), float(any(s in (name[1].lower() if name else " ".join(words)) for s in SECRET_NAMES)),
        float(any(s in w for w in (*words, value.lower()) for s in EXAMPLE_WORDS)), float(place.count("/")), float(any(s in place for s in EXAMPLE_WORDS)), float(len(words)),
    )


def _unwrapped(value: str) -> str:
    """An unquoted value without the quotes, marks and unopened brackets that end what stands around it."""
    marks, n = Counter(value), len(value)
    while n and (value[n - 1] in "\"'`,;." or (value[n - 1] in _BRACKETS and marks[value[n - 1]] > marks[_BRACKETS[value[n - 1]]])):
        n -= 1
        marks[value[n]] -= 1
    return value[:n]


def _given(text: str) -> Iterator[tuple[int, str, str]]:
    """Start, value and the text before each value given to a name: all between quotes, or else up to a blank or the next name.

    Names within quotes are looked at too (``'{"name": "value"}'``).
    """
    at = 0
    while found := _NAME.search(text, at):
        at = found.end()
        if value := _QUOTED.match(text, at):
            start, whole = value.start(value.lastindex), value[value.lastindex]
        elif value := _PLAIN.match(text, at):
            start, whole, at = value.start(1), _unwrapped(value[1]), value.end()
        else:
            continue
        if whole:
            yield start, whole, text[max(0, found.end(1) - _NEAR): start]


def _candidates(text: str) -> Iterator[tuple[int, str, str]]:
    """Start (code points), value and the text before each candidate; a run that begins a given value is not told apart from it."""
    given = set()
    for start, value, before in _given(text):
        given.add(start)
        yield start, value, before
    for found in _CANDIDATE.finditer(text):
        value = found[0].rstrip(".-")
        before = text[max(0, found.start() - _NEAR): found.start()]
        start = found.start()
        if start in given or "=" in value[1:-2]:
            continue
        letters, digits = any(c.isalpha() for c in value), any(c.isdigit() for c in value)
        small, large = any(c.islower() for c in value[1:]), any(c.isupper() for c in value[1:])
        if len(value) >= 8 and ((digits and (letters or len(value) >= 12)) or (small and large and len(value) >= 16) or (_ASSIGNED.search(before) and len(value) >= 8)):
            yield start, value, before


def find_candidates(docs: DataFrame, dictionary: frozenset[str], id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """doc_id, start, value, before and the FEATURES of every candidate in the whole texts.

    Null and empty texts have none; a null path counts as empty. Repeated rows repeat their findings.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)  # words of a fixed public vocabulary

    def scan(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames):
            rows = []
            for doc, text, path in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                rows += [(doc, start, value, before, *finding_features(value, before, path or "", shared.value)) for start, value, before in _candidates(text or "")]
            yield record(_FINDING, *(list(c) for c in zip(*rows))) if rows else record(_FINDING, *([] for _ in _FINDING))

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(path_col).cast("string").alias("path"))
    hinted = own.where(F.col("text").rlike(r"[A-Za-z0-9+/_~.-]{8}|[=:]"))
    return hinted.mapInArrow(scan, "doc_id long, start long, value string, before string, " + ", ".join(f"{k} double" for k in FEATURES))


def label_by_form(findings: DataFrame) -> DataFrame:
    """Label findings whose form settles the matter, for want of a reviewer; the others are left out.

    1: a key of a published fixed form, or a value of 16 or more characters with digits given to a secret name.
    0: addresses of mail and machines, numbers, version strings, and anything mostly made of dictionary words.
    """
    fixed = F.col("value").rlike(r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})$")
    given = (F.col("assigned") == 1) & (F.col("secret_name") == 1) & (F.col("example_near") == 0) & (F.col("length") >= 16) & (F.col("digit_share") > 0.1) & (F.col("covered") < 0.5)
    plain = F.col("value").rlike(r"^[0-9][0-9.+/_-]*$|^[a-z]+[.][0-9]+$|^mail[0-9]*[.]|[.](?:com|org|net)$") | (F.col("covered") >= 0.8) | (F.col("example_near") == 1)
    return findings.withColumn("label", F.when(fixed | given, 1.0).when(plain, 0.0)).where("label IS NOT NULL")


def train_forest(labelled: DataFrame, sample: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 7) -> RandomForestClassificationModel | None:
    """Fit to a bounded sample: of each label, about ``sample`` findings chosen by hash. None without both labels."""
    counts = dict(labelled.groupBy("label").count().collect())
    if len(counts) < 2:
        return None
    parts = [hash_sample(labelled.where(F.col("label") == x), n, sample, "value", "doc_id", "start") for x, n in sorted(counts.items())]
    rows = reduce(DataFrame.unionByName, parts).select("label", *FEATURES)
    found = rows.toArrow()  # at most four times the sample
    found = found.sort_by([(c, "ascending") for c in found.column_names])
    local = labelled.sparkSession.createDataFrame(found)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(local)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(assembled)


def judge_findings(findings: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, start, length, score (probability of a secret) and is_secret; without a model all stay, with score 1."""
    rows = findings.select("doc_id", "start", F.length("value").cast("long").alias("size"), *FEATURES)
    if model is None:
        scored = rows.withColumn("score", F.lit(1.0))
    else:
        assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
        scored = model.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", F.col("size").alias("length"), "score", (F.col("score") >= threshold).alias("is_secret"))
