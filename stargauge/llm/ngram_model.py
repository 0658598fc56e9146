"""N-gram language model in a log-frequency Bloom filter.

Counting: tasks send each *segment* (a range of n-gram hashes) their sorted hashes with counts; a segment adds them
up. An n-gram's count c is quantised to level ``1 + floor(log_b c)`` and stored as the events (n-gram, 1) ...
(n-gram, level), each a few bits in one 64-bit word of the segment's filter, whose size follows the number of its
events. A reader probes level after level until one is missing; the last present level gives the expected count.

Scoring interpolates the orders with a Dirichlet prior: ``p(w | h) = (c(h w) + m p(w | shorter h)) / (c(h) + m)``,
ending in ``(c(w) + 1) / (N + V + 1)``, every count from probes.

The segments are broadcast if all of them together fit a stated number of bytes. Beyond it, batches of documents
send each group of segments the hashes they need and get levels and counts back, two exchanges of rows of a few
MB at most; both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .words import U64, Words, batches, mix, record, release, texts_of

#: Hashes that stand for the beginning and the end of a text; no word has them but by a chance of 2^-64.
_BEGIN, _END = U64(0x3C6EF372FE94F82B), U64(0xA54FF53A5F1D36F1)
_BITS_AN_EVENT, _BITS_SET = 12, 5
_MOST_TASKS = 20_000
#: Bytes of text that are scored at a time, segments that are asked together, and hashes looked up at a time.
_STEP, _GROUP, _LOOKED_UP = 1 << 22, 2, 1 << 17

_PART = pa.schema([("segment", pa.int32()), ("order", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
_SEGMENT = pa.schema([
    ("segment", pa.int32()), ("total", pa.int64()), ("distinct", pa.int64()), ("filter", pa.binary()),
    ("words", pa.binary()), ("counts", pa.binary()), ("size", pa.int64()),
])
_SCORE = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])
_BATCH = pa.schema([("batch", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("held", pa.binary()), ("counts", pa.binary()), ("words", pa.binary()), ("numbers", pa.binary())])
_ASK = pa.schema([("part", pa.int32()), ("role", pa.int32()), ("batch", pa.int64()), ("hashes", pa.binary()), ("segment", pa.int32()), ("filter", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])
_DATA = ("segment", "filter", "words", "counts")
_ANSWER = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("levels", pa.binary()), ("bits", pa.binary()), ("known", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


# ---- tokens and n-grams -------------------------------------------------------------------------------------------


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-case words with END; the numbers of the words of each text and its end; where each text starts."""
    words = Words(texts, lower=True)
    starts = words.starts + np.arange(len(words.starts))
    numbers = np.full(starts[-1], len(words.distinct), np.int32)
    inside = np.ones(len(numbers), bool)
    inside[starts[1:] - 1] = False
    numbers[inside] = words.ids
    return np.append(words.hashes(), _END), numbers, starts


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of each text and its end; where each text starts."""
    words, numbers, starts = _numbered(texts)
    return words[numbers], starts


def _earlier(tokens: np.ndarray, place: np.ndarray, back: int) -> np.ndarray:
    """The token ``back`` places before each one, BEGIN before the text."""
    moved = np.concatenate((np.zeros(min(back, len(tokens)), U64), tokens[: max(0, len(tokens) - back)]))
    return np.where(place >= back, moved, _BEGIN)


def _begin(length: int) -> np.ndarray:
    """The hash of ``length`` BEGINs, the history of a first word."""
    value = np.zeros(1, U64)
    for back in range(1, length + 1):
        value = mix(value * U64(3) + _BEGIN + U64(back)) if back > 1 else mix(value + _BEGIN + U64(1))
    return value


def _ngrams(tokens: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """Per n = 1..order, the hash of the n-gram that ends at each token; missing words before the text are BEGIN.

    The history of the n-gram ending at token i is the (n-1)-gram that ends at token i - 1, or BEGINs.
    """
    place = np.arange(len(tokens)) - np.repeat(starts[:-1], np.diff(starts))
    out, value = [], np.zeros(len(tokens), U64)
    for n in range(1, order + 1):
        back = n - 1
        earlier = _earlier(tokens, place, back)
        value = mix(value * U64(3) + earlier + U64(n)) if back else mix(earlier + U64(1))
        out.append(value)
    return out


# ---- the filter ---------------------------------------------------------------------------------------------------


def _event(hashes: np.ndarray, level: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit word of a segment's filter and the bits in it that an event sets."""
    spread = mix(hashes + U64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    at = (spread >> U64(32)) % U64(n_words)
    bits = np.zeros(len(hashes), U64)
    for k in range(_BITS_SET):
        bits |= U64(1) << ((spread >> U64(6 * k)) & U64(63))
    return at.astype(np.int64), bits


def _segment(hashes: np.ndarray, n_segments: int) -> np.ndarray:
    """The segment of each hash: its upper bits, so that sorted hashes have sorted segments."""
    bits = n_segments.bit_length() - 1
    return (hashes >> U64(64 - bits)).astype(np.int32) if bits else np.zeros(len(hashes), np.int32)


def quantise(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9).astype(np.int64)


def expected_count(levels: np.ndarray, base: float) -> np.ndarray:
    """The middle of the whole numbers of a level; 0 for level 0."""
    low, high = np.ceil(base ** (levels - 1) - 1e-9), np.ceil(base**levels - 1e-9) - 1
    return np.where(levels > 0, (low + np.maximum(high, low)) / 2, 0.0)


def build_filter(hashes: np.ndarray, counts: np.ndarray, base: float) -> bytes:
    levels = quantise(counts, base)
    words = max(1, -(-int(levels.sum()) * _BITS_AN_EVENT // 64))
    out = np.zeros(words, U64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        hashes = hashes[levels >= level]
        levels = levels[levels >= level]
        at, bits = _event(hashes, level, words)
        np.bitwise_or.at(out, at, bits)
    return out.tobytes()


class Segments:
    """Filters and exact word counts of some segments in flat arrays, filled from their rows."""

    def __init__(self, sizes: pa.Table, n_segments: int):
        """Empty arrays for segments of these sizes (segment, and bytes of filter, words and counts)."""
        self.n_segments = n_segments
        segment, size = sizes.column("segment").to_numpy(), {}
        for c in ("filter", "words", "counts"):
            size[c] = np.zeros(n_segments, np.int64)
            size[c][segment] = sizes.column(c).to_numpy()
        wide = 8 if size["counts"].sum() > 4 * (size["words"].sum() // 8) else 4
        self.filter = np.zeros(size["filter"].sum() // 8 + 1, U64)
        self.words, self.counts = np.zeros(size["words"].sum() // 8, U64), np.zeros(size["words"].sum() // 8, f"<u{wide}")
        self.size, self.word_size = size["filter"] // 8, size["words"] // 8
        self.start, self.word_start = np.cumsum(self.size) - self.size, np.cumsum(self.word_size) - self.word_size

    @classmethod
    def of(cls, rows: pa.Table, n_segments: int) -> Segments:
        """Those of some rows alone."""
        sizes = [rows.column("segment"), *(pc.binary_length(rows.column(c)) for c in _DATA[1:])]
        return cls(pa.table(sizes, list(_DATA)), n_segments).fill(rows)

    def fill(self, rows: pa.Table) -> Segments:
        """Put the rows of some segments where they belong."""
        for batch in rows.to_batches():
            for k, segment in enumerate(batch.column("segment").to_pylist()):
                bits, words, counts = (batch.column(c)[k].as_buffer() for c in ("filter", "words", "counts"))
                self.filter[self.start[segment]: self.start[segment] + self.size[segment]] = np.frombuffer(bits, U64)
                if n := self.word_size[segment]:
                    at = slice(self.word_start[segment], self.word_start[segment] + n)
                    self.words[at] = np.frombuffer(words, U64)
                    self.counts[at] = np.frombuffer(counts, f"<u{counts.size // n}")
        return self

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The last level of an unbroken run of events found for each n-gram."""
        return np.concatenate([np.zeros(0, np.int8), *(self._levels(hashes[k: k + _LOOKED_UP]) for k in range(0, len(hashes), _LOOKED_UP))])

    def _levels(self, hashes: np.ndarray) -> np.ndarray:
        segment = _segment(hashes, self.n_segments)
        size, start = self.size[segment], self.start[segment]
        out, alive, level = np.zeros(len(hashes), np.int8), np.flatnonzero(size > 0), 1
        while len(alive) and level < 127:
            at, bits = _event(hashes[alive], level, 1 << 32)  # the position below stands for it within each segment's size
            word = (at.astype(U64) % size[alive].astype(U64)).astype(np.int64)
            alive = alive[(self.filter[start[alive] + word] & bits) == bits]
            out[alive] = level
            level += 1
        return out

    def exact(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of single words, 0 where unknown."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, self.counts[at], 0).astype(np.int64)


@dataclass
class NgramModel:
    segments: DataFrame
    n_segments: int
    order: int
    base: float
    prior: float
    total: int
    distinct: int
    size: int


def train_ngrams(docs: DataFrame, order: int = 2, base: float = 1.5, prior: float = 4.0, segment_tokens: int = 1 << 20, text_col: str = "text") -> NgramModel:
    """Count all n-grams of all rows up to ``order`` and keep them in filter segments, a written table.

    Null texts are empty: a text of the end alone. The number of segments grows with the bytes of text.
    """
    own = docs.select(F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_segments = 1 << min(24, max(0, int(size // 6 // segment_tokens)).bit_length())

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 1 << 14, 1 << 23):
            tokens, starts = _tokens(texts_of(frame.column(0)))
            parts = [(k + 1, *np.unique(value, return_counts=True)) for k, value in enumerate(_ngrams(tokens, starts, order))]
            # The history of a first word is no n-gram of a text; a single BEGIN (order 0) is not among the words either.
            texts = np.array([frame.num_rows])
            parts += [(0 if n == 2 else n - 1, _begin(n - 1), texts) for n in range(2, order + 1)]
            for own_order, h, c in parts:
                which, at = np.unique(_segment(h, n_segments), return_index=True)
                ends = [*at[1:], len(h)]
                yield record(_PART, which, [own_order] * len(which), [h[a:b].tobytes() for a, b in zip(at, ends)], [c[a:b].astype(np.int32).tobytes() for a, b in zip(at, ends)])

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(segment: int, parts: dict) -> pa.RecordBatch:
            sums = {}
            for own_order, (hashes, counts) in parts.items():
                h, at = np.unique(np.concatenate(hashes), return_inverse=True)
                sums[own_order] = h, np.bincount(at, np.concatenate(counts).astype(np.float64), len(h)).astype(np.int64)
            words, counts = sums.get(1, (np.zeros(0, U64), np.zeros(0, np.int64)))
            bits = build_filter(np.concatenate([h for h, _ in sums.values()]), np.concatenate([c for _, c in sums.values()]), base)
            narrow = counts.astype("<u4" if counts.max(initial=0) < 1 << 32 else "<u8")
            return record(_SEGMENT, [segment], [int(counts.sum())], [len(words)], [bits], [words.tobytes()], [narrow.tobytes()], [len(bits) + len(words) * (8 + narrow.itemsize)])

        current, parts = None, {}
        for frame in frames:
            for segment, own_order, h, c in zip(*(x.to_pylist() for x in frame.columns), strict=True):
                if segment != current:
                    if current is not None:
                        yield finish(current, parts)
                    current, parts = segment, {}
                hashes, counts = parts.setdefault(own_order, ([], []))
                hashes.append(np.frombuffer(h, U64))
                counts.append(np.frombuffer(c, np.int32))
        if current is not None:
            yield finish(current, parts)

    parts = own.mapInArrow(count, _ddl(_PART)).repartition(min(n_segments, _MOST_TASKS), "segment").sortWithinPartitions("segment")
    segments = written(parts.mapInArrow(add, _ddl(_SEGMENT)), "ngram-segments")
    sums = segments.agg(F.sum("total"), F.sum("distinct"), F.sum("size")).first()
    return NgramModel(segments, n_segments, order, base, prior, *(int(x or 0) for x in sums))


# ---- scoring ------------------------------------------------------------------------------------------------------


def _needed(tokens: np.ndarray, starts: np.ndarray, order: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Per n = 1..order, the distinct hashes of the n-grams and the place of each token's among them; all hashes to ask for."""
    grams = [np.unique(gram, return_inverse=True) for gram in _ngrams(tokens, starts, order)]
    return grams, _distinct(np.concatenate([*(distinct for distinct, _ in grams), *(_begin(n) for n in range(1, order))]))


def _distinct(values: np.ndarray) -> np.ndarray:
    """As np.unique, which looks numbers up in a hash table; sorted runs are only merged here."""
    values = np.sort(values, kind="stable")
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def _planes(values: np.ndarray) -> bytes:
    """The bytes of whole numbers, all first ones first; those of sorted or small numbers are compressed where rows are exchanged."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _of_planes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _scores(ids: pa.Array, held, tokens, starts, model: tuple, ask) -> pa.RecordBatch:
    """Scores of a batch of texts; ``ask`` answers distinct n-gram hashes with levels and exact word counts."""
    order, base, prior, total, distinct = model
    grams, keys = _needed(tokens, starts, order)
    levels, exact = ask(keys)
    count = expected_count(np.arange(128), base)[levels]
    found = [count[np.searchsorted(keys, own)][place] for own, place in grams]
    own, place = grams[0]
    c = exact[np.searchsorted(keys, own)][place]
    p = (found[0] + 1) / (total + distinct + 1)
    for n in range(1, order):
        h = np.append(0.0, found[n - 1])[:-1]  # the history is the shorter n-gram one token earlier
        h[starts[:-1]] = count[np.searchsorted(keys, _begin(n))]
        p = (np.minimum(found[n], h) + prior * p) / (h + prior)
    owner, n = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), len(starts) - 1

    def per_text(x: np.ndarray) -> np.ndarray:
        return np.bincount(owner, x, n) if n else np.zeros(0)

    base_log = np.log10((c + 1) / (total + distinct + 1))
    return record(
        _SCORE, ids, held, np.diff(starts), per_text(c > 0).astype(np.int64), np.full(n, total, np.int64), per_text(base_log), per_text(np.log10(p)),
    )


def score_texts(docs: DataFrame, model: NgramModel, held_out, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = 256 << 20) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score and score.

    ``held_out`` is a Column. The base score uses exact counts with add-one smoothing, ``score`` the model. A null or
    empty text is its end alone; untrained models give every token probability 1. Equal texts score alike.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    numbers = (model.order, model.base, model.prior, model.total, model.distinct)
    if model.size <= broadcast_bytes:
        return _score_by_broadcast(own, model, numbers)
    return _score_by_exchange(own, model, numbers)


def _gathered(model: NgramModel, some: int = 16 << 20) -> Segments:
    """All segments, at most the stated bytes, in one copy: they come ``some`` bytes at a time."""
    data = ("filter", "words", "counts")
    sizes = model.segments.select("segment", *[F.octet_length(c).cast("long").alias(c) for c in data]).orderBy("segment").toArrow()
    out, of = Segments(sizes, model.n_segments), sizes.to_pydict()
    first, held = None, 0
    for k, segment in enumerate(of["segment"]):
        first = segment if first is None else first
        held += sum(of[c][k] for c in data)
        if held >= some or k == len(of["segment"]) - 1:
            out.fill(model.segments.where(F.col("segment").between(first, segment)).select("segment", *data).toArrow())
            first, held = None, 0
    return out


def _score_by_broadcast(own: DataFrame, model: NgramModel, numbers: tuple) -> DataFrame:
    shared = own.sparkSession.sparkContext.broadcast(_gathered(model))
    release()

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = shared.value

        def ask(keys):
            return segments.levels(keys), segments.exact(keys)

        for frame in batches(frames, 1 << 14, _STEP):
            tokens, starts = _tokens(texts_of(frame.column(2)))
            yield _scores(frame.column(0), frame.column(1), tokens, starts, numbers, ask)

    return own.mapInArrow(score, _ddl(_SCORE))


def _score_by_exchange(own: DataFrame, model: NgramModel, numbers: tuple) -> DataFrame:
    order, n_segments = model.order, model.n_segments

    def pack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for frame in batches(frames, 1 << 14, _STEP):
            words, places, starts = _numbered(texts_of(frame.column(2)))
            ids, held = frame.column(0), np.array(frame.column(1))
            columns = np.array(ids.fill_null(0)), np.array(ids.is_null()), held, np.diff(starts), words
            yield record(_BATCH, [number], *([c.tobytes()] for c in columns), [_planes(places)])
            number += 1

    def unpack(counts: bytes, words: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(words, U64)[_of_planes(places, "i4")], np.append(0, np.cumsum(np.frombuffer(counts, np.int64)))

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for k in range(frame.num_rows):
                batch, *packed = (frame.column(c)[k].as_py() for c in ("batch", "counts", "words", "numbers"))
                keys = _needed(*unpack(*packed), order)[1]
                which, at = np.unique(_segment(keys, n_segments) // _GROUP, return_index=True)
                none = [None] * len(which)
                yield record(_ASK, which, [1] * len(which), [batch] * len(which), [_planes(keys[a:b]) for a, b in zip(at, [*at[1:], len(keys)])], none, none, none, none)
                release()

    def answer(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, segments = None, [], None  # the segments of a part come before the questions to it
        for frame in frames:
            part, role = (np.array(frame.column(c)) for c in ("part", "role"))
            cuts = [0, *(np.flatnonzero((np.diff(part) != 0) | (np.diff(role) != 0)) + 1).tolist(), frame.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if part[a] != current:
                    current, rows, segments = part[a], [], None
                some = frame.slice(a, b - a)
                if role[a] == 0:
                    rows.append(some.select(_DATA))
                    continue
                if segments is None:  # without rows nothing of this part was trained
                    segments, rows = Segments.of(pa.Table.from_batches(rows, pa.schema([_ASK.field(c) for c in _DATA])), n_segments), []
                yield replies(some, segments)
            release()

    def replies(asked: pa.RecordBatch, segments: Segments) -> pa.RecordBatch:
        hashes = [_of_planes(x, "u8") for x in asked.column("hashes").to_pylist()]
        ends, keys = np.cumsum([0, *map(len, hashes)]).tolist(), np.concatenate(hashes)
        levels, exact = segments.levels(keys), segments.exact(keys)
        found = [(levels[a:b], exact[a:b]) for a, b in zip(ends, ends[1:])]
        return record(_ANSWER, asked.column("batch"), asked.column("part"), [x.tobytes() for x, _ in found], [np.packbits(y > 0).tobytes() for _, y in found], [_planes(y[y > 0]) for _, y in found])

    def finish(key, packed: pa.Table, answers: pa.Table) -> pa.Table:
        row, found = packed.to_pylist()[0], answers.sort_by("part").select(["levels", "bits", "known"]).to_pylist()

        def told(keys):
            levels, exact = np.frombuffer(b"".join(x["levels"] for x in found), np.int8), np.zeros(len(keys), np.int64)
            bits = [np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=len(x["levels"])) for x in found]
            exact[np.concatenate(bits).view(bool)] = np.concatenate([_of_planes(x["known"], "i8") for x in found])
            return levels, exact

        ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=np.frombuffer(row["nulls"], bool))
        out = _scores(ids, np.frombuffer(row["held"], bool), *unpack(row["counts"], row["words"], row["numbers"]), numbers, told)
        release()
        return pa.Table.from_batches([out])

    packed = written(own.mapInArrow(pack, _ddl(_BATCH)), "token-batches")
    columns = {"part": F.expr(f"segment div {_GROUP}").cast("int"), "role": F.lit(0), "batch": F.lit(None).cast("long"), "hashes": F.lit(None).cast("binary")}
    data = model.segments.select(*(c.alias(name) for name, c in columns.items()), *_DATA)
    asked = packed.select("batch", "counts", "words", "numbers").mapInArrow(ask, _ddl(_ASK)).unionByName(data)
    asked = asked.repartition(min(-(-n_segments // _GROUP), _MOST_TASKS), "part").sortWithinPartitions("part", "role", "segment")
    answers = written(asked.mapInArrow(answer, _ddl(_ANSWER)), "ngram-answers")
    return packed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, _ddl(_SCORE))
