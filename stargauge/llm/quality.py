"""Quality verdicts: fixed rules, then gradient-boosted trees over statistics of the whole text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, fit_boosted
from .store import hash_sample
from .words import U64, Words, batches, mix, record, texts_of

#: Features of the trees; sign +1: more of it never lowers quality, -1: never raises it, 0: free.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_a_word": -1, "dup_line_share": -1, "repeat_share": -1, "capitals": -1,
    "exclamations": -1, "digits": 0, "other_marks": 0, "distinct_share": +1, "line_words": 0, "stops_a_word": 0, "beyond_ascii": 0,
}
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS, _REST = b"#*$%&|<>", bytes(range(0x80, 0xC0))
_CAPITALS, _DIGITS, _MARKS = bytes(range(65, 91)), b"0123456789", b"\"'()-/:;?@[]_{}~=+"
WINDOW = 8


def _repeated(words: Words) -> np.ndarray:
    """Words of each text that lie in a run of WINDOW words found twice or more in it."""
    counts, starts, owner = words.counts, words.starts[:-1], words.owner
    if not len(words.ids):
        return np.zeros(len(counts), np.int64)
    value, key = words.hashes()[words.ids], np.zeros(len(words.ids), U64)
    for k in range(WINDOW):  # the run that begins at each word; runs past the end of the text are dropped below
        key = key * U64(0x9E3779B97F4A7C15) + np.concatenate((value[k:], np.zeros(min(k, len(value)), U64)))
    first = np.flatnonzero(np.arange(len(owner)) + WINDOW <= (starts + counts)[owner])
    key = mix(mix(key[first]) + owner[first].astype(U64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    found = first[order[np.concatenate((same, [False])) | np.concatenate(([False], same))]] if len(first) else first
    edges = np.zeros(len(owner) + 1, np.int64)
    np.add.at(edges, found, 1)
    np.add.at(edges, found + WINDOW, -1)
    return np.bincount(owner[np.cumsum(edges[:-1]) > 0], minlength=len(counts))


def text_statistics(texts: Sequence[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of the rules, and the FEATURES of each text as columns of a matrix."""
    words = Words(texts)
    n = words.counts
    letters = np.fromiter((len(w.translate(None, _REST)) for w in words.distinct), np.int64, len(words.distinct))
    chars = np.bincount(words.owner, letters[words.ids], len(n)).astype(np.int64) if len(words.ids) else np.zeros(len(n), np.int64)

    def those(delete: bytes) -> np.ndarray:
        return np.fromiter((len(t) - len(t.translate(None, delete)) for t in texts), np.int64, len(texts))

    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    n_lines = np.fromiter(map(len, lines), np.int64, len(texts))
    dup = n_lines - np.fromiter((len(set(x)) for x in lines), np.int64, len(texts))
    counts = dict(zip(_COUNTS, (n, chars, those(_SYMBOLS), dup, _repeated(words)), strict=True))
    per, letter = np.maximum(n, 1), np.maximum(chars, 1)
    distinct = np.fromiter((len(set(words.ids[a:b].tolist())) for a, b in zip(words.starts, words.starts[1:])), np.int64, len(texts))
    features = {
        "log_words": np.log1p(n), "word_length": chars / per, "symbols_a_word": counts["n_symbols"] / per, "dup_line_share": dup / np.maximum(n_lines, 1),
        "repeat_share": counts["n_repeat_words"] / per, "capitals": those(_CAPITALS) / letter, "exclamations": those(b"!") / per,
        "digits": those(_DIGITS) / letter, "other_marks": those(_MARKS) / per, "distinct_share": distinct / per, "line_words": np.log1p(n / np.maximum(n_lines, 1)),
        "stops_a_word": those(b".,") / per, "beyond_ascii": those(bytes(range(0xC0, 0x100))) / letter,
    }
    return counts, np.stack([features[k] for k in FEATURES], axis=1).astype(np.float64) if len(texts) else np.zeros((0, len(FEATURES)))


def rules_failed(counts: dict[str, np.ndarray], least_words: int = 20, most_repeated: int = 30) -> np.ndarray:
    """Fewer than ``least_words`` words, or more than ``most_repeated`` percent of them in repeated runs."""
    return (counts["n_words"] < least_words) | (100 * counts["n_repeat_words"] > most_repeated * counts["n_words"])


def learn_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Boosted:
    """Fit the trees to labelled documents (1: good).

    The fit takes a bounded sample, about ``sample`` labels chosen by hash; null ids and labels are left out. Without labels of both kinds every text gets the share of good ones (one half without any).
    """
    chosen = labels.select(F.col(id_col).alias("of"), F.col(label_col).cast("int").alias("label")).where("of IS NOT NULL AND label IS NOT NULL")
    chosen = hash_sample(chosen, chosen.count(), sample, "of", "label")
    texts = docs.join(F.broadcast(chosen), docs[id_col] == F.col("of")).select(F.col("of"), "label", docs[text_col].alias("text"))  # <= 2 x sample rows
    schema = pa.schema([("of", pa.int64()), ("label", pa.int32()), *((k, pa.float64()) for k in FEATURES)])

    def statistics(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames):
            _, rows = text_statistics(texts_of(frame.column(2)))
            yield record(schema, frame.column(0).cast(pa.int64()), frame.column(1), *rows.T)

    ddl = "of long, label int, " + ", ".join(f"{k} double" for k in FEATURES)
    found = texts.mapInArrow(statistics, ddl).toArrow().sort_by([(k, "ascending") for k in schema.names])
    rows = np.stack([np.array(found[k]) for k in FEATURES], axis=1).astype(np.float64)
    return fit_boosted(rows, np.array(found["label"], np.float64), list(FEATURES.values()))


def judge_quality(docs: DataFrame, model: Boosted, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the counts of the rules, base_failed, kept and the trees' score (probability of good).

    A null or empty text has no words, so it fails the rules. Equal texts get equal verdicts. An empty table gives
    no row; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), *((k, pa.int64()) for k in _COUNTS), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())])

    def judge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames):
            counts, rows = text_statistics(texts_of(frame.column(1)))
            failed, score = rules_failed(counts), shared.value.probability(rows)
            yield record(schema, frame.column(0), *counts.values(), failed, ~failed & (score >= threshold), score)

    ddl = "doc_id long, " + ", ".join(f"{k} long" for k in _COUNTS) + ", base_failed boolean, kept boolean, score double"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(judge, ddl)
