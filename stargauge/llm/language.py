"""Language of a text from unigrams of pieces, summed over all ways to cut each word into pieces.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is the sum,
over all its segmentations into pieces, of the product of their probabilities (forward algorithm); that of a text is
the product over its words. Piece probabilities are learned by expectation maximisation: expected piece counts over
all segmentations of the labelled words, as Spark jobs over the table of distinct words.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written
from .words import U64, Words, batches, byte_letters, record

UNKNOWN = "und"
#: The model has this many languages at most, which bounds what is broadcast.
MAX_LANGUAGES = 1000
#: Words up to this many bytes are scored many at a time, without scaling; longer ones each by itself, scaled. The sums
#: are the same.
SHORT = 32
#: Numbers of a forward table of short words: what is held at a time, whatever the number of languages.
_CELLS = 1 << 20

_BASE, _END = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
_UNIT = float(1 << 20)  # expected counts are added up as whole numbers of 1/UNIT, so that the order of adding is no matter
_WORD = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])
_EXPECTED = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.int64())])
_FOUND = pa.struct([("lang", pa.string()), ("score", pa.float64())])


def vocabulary_pieces(data: str) -> list[tuple[bytes, bool]]:
    """Bytes of each piece of a BPE tokenizer's JSON, and whether it ends a word."""
    byte = {letter: b for b, letter in byte_letters().items()}
    model = json.loads(data)["model"]
    end = model.get("end_of_word_suffix") or ""
    out = set()
    for text in model["vocab"]:
        last = bool(end) and text.endswith(end)
        body = text[: -len(end)] if last else text
        if body and all(c in byte for c in body):
            out.add((bytes(byte[c] for c in body), last))
    return sorted(out)


class Pieces:
    """The vocabulary as sorted hashes; finds the pieces of all substrings of many words at once."""

    def __init__(self, pieces: Sequence[tuple[bytes, bool]]):
        value = np.zeros(len(pieces), U64)
        for k, (body, last) in enumerate(pieces):
            h = 0
            for b in body:
                h = (h * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
            value[k] = h ^ int(_END) if last else h
        self.order = np.argsort(value)
        self.value = value[self.order]
        self.maybe = np.zeros(1 << 20, bool)  # of the upper bits: most substrings are no piece, and this tells soon
        self.maybe[self.value >> U64(44)] = True
        self.longest = max((len(body) for body, _ in pieces), default=1)
        self.size = len(pieces)

    def lattice(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For words of one length (rows of bytes): begin, end, rows and pieces of the substrings that are pieces."""
        n = letters.shape[1]
        letters = np.ascontiguousarray(letters.T) + U64(1)
        for end in range(1, n + 1):
            value, power = np.zeros(letters.shape[1], U64), 1
            for begin in range(end - 1, max(-1, end - 1 - self.longest), -1):  # grows to the left
                value = value + letters[begin] * U64(power)
                power = power * int(_BASE) & 0xFFFFFFFFFFFFFFFF
                wanted = value ^ _END if end == n else value
                rows = np.flatnonzero(self.maybe[wanted >> U64(44)])
                at = np.searchsorted(self.value, wanted[rows])
                at[at == self.size] = 0
                right = self.value[at] == wanted[rows]
                rows, at = rows[right], at[right]
                if len(rows):
                    yield begin, end, rows, self.order[at]


    def edges(self, word: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and piece of all substrings of a long word that are pieces, by their end."""
        letters = np.frombuffer(word, np.uint8).astype(U64) + U64(1)
        n, power, found = len(letters), 1, []
        value = np.zeros(n + 1, U64)
        for size in range(1, min(self.longest, n) + 1):
            value = value[1:][: n - size + 1] + letters[: n - size + 1] * U64(power)
            power = power * int(_BASE) & 0xFFFFFFFFFFFFFFFF
            wanted = value.copy()
            wanted[-1] ^= _END
            rows = np.flatnonzero(self.maybe[wanted >> U64(44)])
            at = np.searchsorted(self.value, wanted[rows])
            at[at == self.size] = 0
            right = self.value[at] == wanted[rows]
            found.append((rows[right], rows[right] + size, self.order[at[right]]))
        begin, end, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(end, kind="stable")
        return begin[order], end[order], piece[order]


def _by_length(words: Sequence[bytes], languages: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Short words of one length, as rows of bytes, so many that a forward table for the languages stays bounded."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths[lengths <= SHORT]):
        which = np.flatnonzero(lengths == n)
        step = max(1, _CELLS // ((n + 1) * max(1, languages)))
        for at in range(0, len(which), step):
            rows = which[at: at + step]
            yield rows, np.frombuffer(b"".join(words[k] for k in rows), np.uint8).reshape(len(rows), n).astype(U64)


def word_scores(words: Sequence[bytes], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Natural log probability of each word (rows) in each language (columns); ``table`` is piece x language."""
    out = np.zeros((len(words), table.shape[1]))
    for k, word in enumerate(words):
        if len(word) > SHORT:
            out[k] = _long_score(word, pieces, table)
    for rows, letters in _by_length(words, table.shape[1]):
        n = letters.shape[1]
        forward = np.zeros((n + 1, len(rows), table.shape[1]))
        forward[0] = 1
        for begin, end, hit, piece in pieces.lattice(letters):
            forward[end][hit] += forward[begin][hit] * table[piece]
        out[rows] = np.log(np.maximum(forward[n], 1e-300))
    return out


def _long_score(word: bytes, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """As ``word_scores`` for one word of any length: the forward sums of the last positions only, each language scaled."""
    begin, end, piece = pieces.edges(word)
    n, window = len(word), pieces.longest + 1
    value, scale = np.zeros((window, table.shape[1])), np.full((window, table.shape[1]), -np.inf)
    value[0], scale[0] = 1, 0
    first = np.searchsorted(end, np.arange(n + 2))
    for at in range(1, n + 1):
        own = slice(first[at], first[at + 1])
        here = at % window
        from_ = begin[own] % window
        top = scale[from_].max(axis=0, initial=-np.inf)
        top = np.where(np.isfinite(top), top, 0.0)
        sums = (value[from_] * np.exp(scale[from_] - top) * table[piece[own]]).sum(axis=0)
        reached = sums > 0
        value[here] = reached
        scale[here] = np.where(reached, top + np.log(np.where(reached, sums, 1.0)), -np.inf)
    return np.where(np.isfinite(scale[n % window]), scale[n % window], n * np.log(1e-300) / SHORT)


def _long_counts(word: bytes, pieces: Pieces, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, expected uses) of one word of any length in one language, in logarithms; ``own`` are its probabilities."""
    begin, end, piece = pieces.edges(word)
    n = len(word)
    weight = np.log(np.maximum(own[piece], 1e-300))
    forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    forward[0] = backward[n] = 0
    first = np.searchsorted(end, np.arange(n + 2))
    for at in range(1, n + 1):
        e = slice(first[at], first[at + 1])
        forward[at] = np.logaddexp.reduce(forward[begin[e]] + weight[e], initial=-np.inf)
    back = np.argsort(begin, kind="stable")
    last = np.searchsorted(begin[back], np.arange(n + 2))
    for at in range(n - 1, -1, -1):
        e = back[last[at]: last[at + 1]]
        backward[at] = np.logaddexp.reduce(backward[end[e]] + weight[e], initial=-np.inf)
    if not np.isfinite(forward[n]):
        return piece[:0], weight[:0]
    return piece, np.exp(forward[begin] + weight + backward[end] - forward[n])


def expected_counts(words: Sequence[bytes], language: np.ndarray, weight: np.ndarray, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (rows) in each language (columns) over all segmentations of labelled words."""
    total = np.zeros(pieces.size * table.shape[1])
    for k, word in enumerate(words):
        if len(word) > SHORT:
            piece, used = _long_counts(word, pieces, table[:, language[k]])
            np.add.at(total, piece * table.shape[1] + language[k], used * weight[k])
    for rows, letters in _by_length(words):
        n, own = letters.shape[1], language[rows]
        edges = list(pieces.lattice(letters))
        forward, backward = np.zeros((n + 1, len(rows))), np.zeros((n + 1, len(rows)))
        forward[0] = backward[n] = 1
        for begin, end, hit, piece in edges:
            forward[end][hit] += forward[begin][hit] * table[piece, own[hit]]
        for begin, end, hit, piece in sorted(edges, key=lambda e: -e[0]):
            backward[begin][hit] += backward[end][hit] * table[piece, own[hit]]
        share = np.where(forward[n] > 0, weight[rows] / np.maximum(forward[n], 1e-300), 0)
        for begin, end, hit, piece in edges:
            used = forward[begin][hit] * table[piece, own[hit]] * backward[end][hit] * share[hit]
            total += np.bincount(piece * table.shape[1] + own[hit], used, len(total)) if len(hit) > 2000 else 0
            if len(hit) <= 2000:
                np.add.at(total, piece * table.shape[1] + own[hit], used)
    return total.reshape(pieces.size, table.shape[1])


def _words_with_letters(texts: Sequence[str | None]) -> tuple[Words, np.ndarray]:
    """Lower-case words, and which of the distinct ones hold a letter."""
    words = Words((t or "").lower().encode() for t in texts)
    text = (w.decode() for w in words.distinct)
    return words, np.fromiter((t.isalpha() or any(map(str.isalpha, t)) for t in text), bool, len(words.distinct))


class LanguageModel:
    """Piece probabilities of some languages."""

    def __init__(self, languages: Sequence[str], pieces: Sequence[tuple[bytes, bool]], table: np.ndarray):
        self.languages, self.pieces, self.table = list(languages), Pieces(pieces), table

    def scores(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text in each language; whether it has a letter."""
        words, letters = _words_with_letters(texts)
        chosen = np.flatnonzero(letters)
        of_word = word_scores([words.distinct[k] for k in chosen], self.pieces, self.table)
        total = np.zeros((len(texts), len(self.languages)))
        used = letters[words.ids] if len(words.ids) else np.zeros(0, bool)
        place = np.cumsum(letters) - 1
        at, text = place[words.ids[used]] if len(words.ids) else np.zeros(0, np.int64), words.owner[used]
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(text, of_word[at, k], len(texts)) if len(text) else 0
        return total, np.bincount(text, minlength=len(texts)) > 0

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """The most probable language (first in code point order if equal) and its posterior under equal priors."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total, known = self.scores(texts)
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def learn_languages(
    docs: DataFrame, vocabulary: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    sample_docs: int = 4000, rounds: int = 3, prior: float = 0.05,
) -> LanguageModel:
    """Fit the piece probabilities to labelled documents.

    The classifier is fitted on a bounded sample: about ``sample_docs`` documents of each language, those with the
    smallest hash of their id. Rows without a language are not used; null texts have no words. Without any
    labelled row the model has no language and predicts ``und``. More than MAX_LANGUAGES languages raise ValueError.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL")
    found = own.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the model would be too large to broadcast")
    languages, pieces = [r["lang"] for r in found], vocabulary_pieces(vocabulary)
    if not languages:
        return LanguageModel([], pieces, np.zeros((len(pieces), 0)))
    index = {name: k for k, name in enumerate(languages)}
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, sample_docs / r["count"]))])
    part = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = own.where(part < share[F.col("lang")]).select("lang", "text")

    def words(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, size=1 << 23):
            langs, texts = np.array(frame.column(0).to_pylist(), object), frame.column(1).to_pylist()
            for lang in sorted(set(langs)):
                split, letters = _words_with_letters([t for t, x in zip(texts, langs, strict=True) if x == lang])
                times = np.bincount(split.ids, minlength=len(split.distinct))
                keep = np.flatnonzero(letters)
                yield record(_WORD, [lang] * len(keep), [split.distinct[k] for k in keep], times[keep])

    counts = sample.mapInArrow(words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = written(counts, "language-words")
    table = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((pieces, table))  # vocabulary x languages, bounded above

        def expected(frames: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            listed, probability = model.value
            known, total = Pieces(listed), np.zeros((len(listed), probability.shape[1]))
            for frame in frames:
                times = np.array(frame.column(2), np.float64)
                of = np.array([index[x] for x in frame.column(0).to_pylist()], np.int64)
                own_words = frame.column(1).to_pylist()
                if own_words:
                    total += expected_counts(own_words, of, times, known, probability)
            piece, lang = np.nonzero(total > 1 / _UNIT)
            yield record(_EXPECTED, lang.astype(np.int32), piece.astype(np.int32), np.round(total[piece, lang] * _UNIT).astype(np.int64))

        sums = counts.mapInArrow(expected, "lang int, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        table = np.zeros_like(table)  # at most vocabulary x languages rows come back
        table[np.array(sums["piece"]), np.array(sums["lang"])] = np.array(sums["n"]) / _UNIT
        table = (table + prior) / (table.sum(axis=0) + prior * len(pieces))
        model.unpersist()
    return LanguageModel(languages, pieces, table)


def language_of(docs: DataFrame, model: LanguageModel, text: str | Column = "text") -> Column:
    """Struct of lang and score for each text; ``und`` and 0 for null, empty or letterless texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in columns:
            langs, scores = [], []
            for part in batches([pa.record_batch([column], ["text"])], size=1 << 21):
                lang, score = own.predict(part.column(0).to_pylist())
                langs += lang
                scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], fields=list(_FOUND))

    return predict(text)


def identify_languages(docs: DataFrame, model: LanguageModel, lang: str = "lang_pred", score: str = "score", text_col: str = "text") -> DataFrame:
    """Add the predicted language and its posterior to every row; columns of these names are replaced."""
    names = [c for c in docs.columns if c not in (lang, score)]
    with_both = docs.select(*names, language_of(docs, model, text_col).alias("__language"))
    return with_both.select(*names, F.col("__language.lang").alias(lang), F.col("__language.score").alias(score))
