"""Alignment of the tokens of a byte-level and of a sentencepiece tokenizer.

Each tokenizer says which span of the text a token covers: ``tokenizers`` in characters, ``sentencepiece`` in bytes of the
text (its proto; the class ``ImmutableSentencePieceText`` of older releases has the same spans). Spans are coarse: tokens
that share a character all cover it, and byte-fallback tokens cover nothing but for the last. Those ends are refined by the
bytes that the tokens decode to. Where tokens of both end at the same byte, the text is cut into groups.

Neither tokenizer joins anything across a blank that follows a character that is no white space, so texts are cut there
into runs. Each distinct run is encoded and aligned once, many joined by line breaks, and remembered while it is used.
Whether the vocabularies allow that is checked when they are loaded; otherwise texts are taken whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written
from .words import batches, byte_letters, record, release

_BLANK = "▁"
_WORD_END, _ODD_BLANK = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s |\s$")
_PAIR_BITS = 20
_SPAN = attrgetter("id", "begin", "end")

#: Groups with more links than this are unfolded by their distinct ids.
_WIDE = 1 << 16


def byte_ends(lengths: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each token ends, from its span in bytes and the length of what it decodes to.

    A token's end is its span's, unless the next token begins before it (they share a character) or its span is empty
    (a byte of a character whose span the last of its tokens has): then it is the end before plus its own bytes.
    """
    n = len(lengths)
    coarse = begins < ends
    coarse[: n - 1] &= begins[1:] >= ends[: n - 1]
    last = np.maximum.accumulate(np.where(coarse, np.arange(n), -1))  # the last token before with a certain end
    decoded = np.cumsum(lengths)
    return np.where(last >= 0, ends[last] + decoded - decoded[last], decoded)


def links_of(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair of ids, links) of the tokens of ``n`` groups; a pair may come more than once in a group."""
    n_a, n_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    plain = np.flatnonzero(n_a * n_b <= _WIDE)
    sizes = (n_a * n_b)[plain]
    group = np.repeat(plain, sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    i, j = np.divmod(at, n_b[group])
    parts = [(group, (a[from_a[group] + i] << _PAIR_BITS) | b[from_b[group] + j], np.ones(len(group), np.int64))]
    for g in np.flatnonzero(n_a * n_b > _WIDE):
        x, x_times = np.unique(a[from_a[g]:from_a[g] + n_a[g]], return_counts=True)
        y, y_times = np.unique(b[from_b[g]:from_b[g] + n_b[g]], return_counts=True)
        both = ((x[:, None] << _PAIR_BITS) | y[None, :]).ravel()
        parts.append((np.full(len(both), g), both, np.outer(x_times, y_times).ravel()))
    return tuple(np.concatenate(c) for c in zip(*parts))


class _Part:
    """Runs aligned together: figures of each run, and its distinct pairs in ``pairs[begin[k]:begin[k + 1]]``."""

    def __init__(self, n: int):
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, np.int64) for _ in range(4))
        self.begin, self.pairs, self.links = np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.good, self.shown = np.zeros(n, bool), [""] * n


class Aligner:
    """Aligned runs of texts under two tokenizers; remembers some ``limit`` runs.

    ``first`` is the JSON file of a byte-level tokenizer, ``second`` the model of a sentencepiece one that writes a blank
    before each text.
    """

    def __init__(self, first: bytes, second: bytes, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_buffer(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        letters = {c: b for b, c in byte_letters().items()}
        entries = [self.first.id_to_token(i) or "" for i in range(self.first.get_vocab_size())]
        self.first_bytes = [bytes(map(letters.__getitem__, e)) if all(c in letters for c in e) else e.encode() for e in entries]
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(p[1:-1], 16)]) if self.second.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.first_length, self.second_length = (np.array(list(map(len, x))) for x in (self.first_bytes, self.second_bytes))
        self.first_shown, self.second_shown = _shown(len(entries), ";"), _shown(len(pieces), "|")
        #: A's rule cuts at all these places. B has no rule, so no piece of it may reach across them.
        rules = json.loads(first)
        words = {"type": "ByteLevel", "use_regex": True}.items() <= (rules.get("pre_tokenizer") or {}).items()
        whole = [p for i, p in enumerate(pieces) if not self.second.is_byte(i)]
        self.by_runs = words and not rules.get("normalizer") and not any("\n" in p or re.search(f"[^{_BLANK}]{_BLANK}", p) for p in whole)
        self.limit = limit
        self.known: dict[str, int] = {}
        self.all, self.uses = _Part(0), np.zeros(0, np.int64)

    def runs_of(self, text: str) -> list[str]:
        """``text`` cut into runs, each without the blank it begins with; nothing of an empty text."""
        if not text or not self.by_runs:
            return [text] if text else []
        if _ODD_BLANK.search(text) or text[0] == " ":
            return [r[1:] for r in _WORD_END.split(" " + text)]
        return text.split(" ")

    def numbers(self, texts: list[list[str]]) -> list[list[int]]:
        """The numbers of all runs of each text."""
        flat, ends = self.in_a_row(texts).tolist(), np.cumsum(list(map(len, texts)), dtype=np.int64).tolist()
        return [flat[p:q] for p, q in zip([0, *ends], ends)]

    def in_a_row(self, texts: list[list[str]]) -> np.ndarray:
        """The numbers of all runs of the texts in a row, after those not known yet are aligned, many at a time."""
        if len(self.known) > self.limit:
            self._trim()
        new = [r for r in set().union(*texts) if r not in self.known]
        parts, at = [self.all], 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and end - at < 2048 and size < 1 << 20:
                size += len(new[end])
                end += 1
            parts += self._aligned([" " + r for r in new[at:end]])
            at = end
        for run in new:
            self.known[run] = len(self.known)
        if len(parts) > 1:
            self._merge(parts)
        out = np.fromiter(map(self.known.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        used = np.bincount(out, minlength=len(self.known))
        used[: len(self.uses)] += self.uses
        self.uses = used
        return out

    def _trim(self) -> None:
        """Forget the runs that occurred only once, and of the others the rarer ones beyond half the limit."""
        order = np.argsort(-self.uses, kind="stable")[: self.limit // 2]
        keep = np.sort(order[self.uses[order] > 1])
        old, new = self.all, _Part(0)
        names = list(self.known)  # in the order of their numbers
        self.known = {names[k]: i for i, k in enumerate(keep.tolist())}
        for name in ("n_a", "n_b", "n_groups", "n_links", "good"):
            setattr(new, name, getattr(old, name)[keep])
        sizes = np.diff(old.begin)[keep]
        new.begin = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(sizes.sum()) + np.repeat(old.begin[keep] - new.begin[:-1], sizes)
        new.pairs, new.links = old.pairs[at], old.links[at]
        new.shown = [old.shown[k] for k in keep.tolist()]
        self.all, self.uses = new, self.uses[keep]

    def _merge(self, parts: list[_Part]) -> None:
        whole, shown = _Part(0), parts[0].shown
        for name in ("n_a", "n_b", "n_groups", "n_links", "pairs", "links", "good"):
            setattr(whole, name, np.concatenate([getattr(p, name) for p in parts]))
        for part in parts[1:]:
            shown += part.shown
        whole.shown = shown
        whole.begin = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.begin) for p in parts]))])
        self.all = whole

    def _aligned(self, runs: list[str]) -> list[_Part]:
        """Parts of consecutive runs. Runs that a line break before or after would change, or that the tokens do not
        restore, are taken alone."""
        part = self._align(runs) if len(runs) == 1 or all(map(_joinable, runs)) else None
        if part:
            return [part]
        if len(runs) == 1:
            return [_Part(1)]  # not restored: no tokens
        half = len(runs) // 2
        return self._aligned(runs[:half]) + self._aligned(runs[half:])

    def _align(self, runs: list[str]) -> _Part | None:
        text = "\n".join(runs)
        data = text.encode()
        one = self.first.encode(text, add_special_tokens=False)
        a = np.array(one.ids, np.int64)
        # B writes a blank before each text: a line break after that keeps it from joining the first run.
        pieces = self.second.encode("\n" + text, return_type="proto", num_threads=1).pieces[2:]
        fields = np.fromiter(chain.from_iterable(map(_SPAN, pieces)), np.int64, 3 * len(pieces)).reshape(-1, 3)
        b, begins, ends = fields[:, 0].copy(), fields[:, 1] - 1, fields[:, 2] - 1
        joined = b"".join(map(self.first_bytes.__getitem__, a.tolist())), b"".join(map(self.second_bytes.__getitem__, b.tolist()))
        if joined != (data, data):
            return None
        spans = np.fromiter(chain.from_iterable(one.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        n, sizes = len(runs), np.array(list(map(len, runs)))
        if len(data) != len(text):
            heads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            spans = np.append(heads, len(data))[spans]
            sizes = np.array([len(r.encode()) for r in runs])
        a_ends = byte_ends(self.first_length[a], spans[:, 0], spans[:, 1])
        b_ends = byte_ends(self.second_length[b], begins, ends)
        ends_a, cut = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)  # by place in the text
        ends_a[a_ends] = True
        cut[b_ends] = ends_a[b_ends]
        cuts = np.flatnonzero(cut)
        run_ends = np.cumsum(sizes + 1) - 1
        if not (cut[run_ends].all() and cut[run_ends[:-1] + 1].all()):
            return None
        breaks = np.zeros(len(cuts), bool)  # groups that are the line breaks between runs
        before = np.cumsum(cut) - cut  # cuts before each place
        breaks[before[run_ends[:-1] + 1]] = True
        number = np.cumsum(~breaks) - 1
        group_a, group_b = before[a_ends], before[b_ends]
        own_a, own_b = ~breaks[group_a], ~breaks[group_b]
        a, group_a, b, group_b = a[own_a], number[group_a[own_a]], b[own_b], number[group_b[own_b]]
        run_of = np.searchsorted(run_ends, cuts[~breaks])
        part = _Part(n)
        part.good[:] = True
        part.n_a, part.n_b = np.bincount(run_of[group_a], minlength=n), np.bincount(run_of[group_b], minlength=n)
        part.n_groups = np.bincount(run_of, minlength=n)
        group, pair, times = links_of(a, group_a, b, group_b, len(run_of))
        both, where = np.unique((run_of[group] << (2 * _PAIR_BITS)) | pair, return_inverse=True)
        part.links = np.zeros(len(both), np.int64)
        np.add.at(part.links, where, times)
        run, part.pairs = both >> (2 * _PAIR_BITS), both & ((1 << (2 * _PAIR_BITS)) - 1)
        part.begin = np.searchsorted(run, np.arange(n + 1))
        part.n_links = np.diff(np.concatenate([[0], np.cumsum(part.links)])[part.begin])
        part.shown = _printed(self.first_shown[_opens(group_a), a], group_a, self.second_shown[_opens(group_b), b], group_b, run_of, n)
        return part


def _joinable(run: str) -> bool:
    """Whether the tokenizers take the run alike between two line breaks: no white space at its ends but one blank."""
    return not (run[-1].isspace() or run[0] != " " and run[0].isspace() or run[:1] == " " and run[1:2].isspace())


def _shown(n: int, opening: str) -> np.ndarray:
    """Ids below ``n`` as text, behind a comma and behind the mark of the first of a group."""
    return np.array([[f",{i}" for i in range(n)], [f"{opening}{i}" for i in range(n)]], object)


def _opens(group: np.ndarray) -> np.ndarray:
    """1 for the first token of each group of an ordered array, else 0."""
    return (np.diff(group, prepend=-1) != 0).astype(np.int64)


def _printed(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, run_of: np.ndarray, n: int) -> list[str]:
    """The groups of each run as ``a,a|b;a|b,b``, from ids shown with their marks: A's of a group, then B's, group by group."""
    k = np.arange(len(run_of) + 1)
    from_a, from_b = np.searchsorted(group_a, k), np.searchsorted(group_b, k)
    tokens = np.empty(len(a) + len(b), object)
    tokens[np.arange(len(a)) + from_b[group_a]] = a
    tokens[np.arange(len(b)) + from_a[group_b + 1]] = b
    ends = (from_a + from_b)[np.searchsorted(run_of, np.arange(n + 1))].tolist()
    tokens = tokens.tolist()
    return ["".join(tokens[p:q])[1:] for p, q in zip(ends, ends[1:])]


#: A worker's aligner and the models it is of; the runs it knows serve later tasks too.
_OWN: dict[tuple[str, str], Aligner] = {}


def _aligner(names: tuple[str, str], models: Broadcast) -> Aligner:
    if names not in _OWN:
        _OWN.clear()
        _OWN[names] = Aligner(*models.value)
    return _OWN[names]


class _Batch:
    """Texts as numbers of runs: ``run`` numbers every occurrence's run, ``owner`` its text."""

    def __init__(self, aligner: Aligner, texts: pa.Array):
        cut = [aligner.runs_of(t or "") for t in texts.to_pylist()]
        self.run, self.n = aligner.in_a_row(cut), len(cut)
        self.all, self.counts = aligner.all, np.array(list(map(len, cut)), np.int64)
        self.owner = np.repeat(np.arange(self.n), self.counts)
        lone = ~self.all.good[self.run]
        if lone.any():  # a text with a run that is not restored has no tokens
            whole = np.bincount(self.owner[lone], minlength=self.n) == 0
            self.run, self.owner, self.counts = self.run[whole[self.owner]], self.owner[whole[self.owner]], self.counts * whole

    def sums(self, per_run: np.ndarray) -> np.ndarray:
        """Sums of a figure of the runs over each text."""
        return _spread(per_run[self.run], self.counts)

    def digests(self) -> list[str]:
        runs, ends = list(map(self.all.shown.__getitem__, self.run.tolist())), np.cumsum(self.counts).tolist()
        return [hashlib.sha256(";".join(runs[p:q]).encode()).hexdigest() if p < q else "" for p, q in zip([0, *ends], ends)]

    def packed(self) -> dict[str, list]:
        """The distinct runs of the batch, by numbers of its own, with their pairs, and the documents of each pair."""
        used, run = np.unique(self.run, return_inverse=True)
        begin, sizes = self.all.begin[used], np.diff(self.all.begin)[used]
        at = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        pairs, pair_at = np.unique(self.all.pairs[at], return_inverse=True)
        # One row for each text and run of it, then one for each text and pair of it.
        own = _distinct(self.owner * max(1, len(used)) + run)
        text, of = np.divmod(own, max(1, len(used)))
        first = (np.cumsum(sizes) - sizes)[of]
        each = np.arange(sizes[of].sum()) + np.repeat(first - (np.cumsum(sizes[of]) - sizes[of]), sizes[of])
        held = _distinct(np.repeat(text, sizes[of]) * max(1, len(pairs)) + pair_at[each])
        docs = np.bincount(held % max(1, len(pairs)), minlength=len(pairs))
        return {
            "n_runs": self.counts, "runs": run, "sizes": sizes, "pair_at": pair_at, "links": self.all.links[at],
            "pairs": pairs, "docs": docs,
        }


_FIXED = ["n_a", "n_b", "n_groups", "n_links"]
_LISTS = {
    "doc_id": "long", **dict.fromkeys(_FIXED, "long"), "groups_sha256": "string", "n_runs": "int", "runs": "int", "sizes": "int",
    "pair_at": "int", "links": "long", "pairs": "long",
}
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _packing(held: Broadcast, names: tuple[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    lists = pa.schema([(c, pa.list_(_ARROW[t])) for c, t in _LISTS.items()])
    schema = pa.schema([("data", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, options = _aligner(names, held), pa.ipc.IpcWriteOptions(compression="zstd")
        for frame in batches(frames, rows=512, size=1 << 20):
            batch = _Batch(aligner, frame.column(1))
            values = {f: batch.sums(getattr(batch.all, f)) for f in _FIXED} | batch.packed()
            docs = values.pop("docs")
            values |= {"doc_id": frame.column(0), "groups_sha256": batch.digests()}
            columns = [pa.array(values[c]).cast(_ARROW[t]) for c, t in _LISTS.items()]
            row = pa.record_batch([pa.ListArray.from_arrays([0, len(x)], x) for x in columns], schema=lists)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, lists, options=options) as out:
                out.write_batch(row)
            yield record(schema, [sink.getvalue().to_pybytes()], [values["pairs"]], [docs])
        release()

    return run


_OUT = ["doc_id", *_FIXED, "n_best", "count_sum", "groups_sha256"]
_OUT_DDL = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in _OUT)


def _summing(table: Broadcast | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents of packed batches, with the sums of their pairs' counts, taken from a table or from the rows."""
    schema = pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in _OUT])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _OWN.clear()  # all texts are aligned: a worker that lives on need not keep its runs
        release()
        for frame in frames:
            for k in range(frame.num_rows):
                row = pa.ipc.open_stream(frame.column("data")[k].as_buffer()).read_next_batch()
                lists = {f.name: row.column(i)[0].values for i, f in enumerate(row.schema)}
                x = {c: lists[c].to_numpy() for c in ("n_runs", "runs", "sizes", "pair_at", "links", "pairs")}
                if table:
                    keys, n, best = table.value
                    at = np.searchsorted(keys, x["pairs"])
                    counts = best[at], n[at]
                else:
                    order = np.argsort(_values(frame.column("key")[k], pa.int64()))
                    counts = _values(frame.column("best")[k], pa.bool_())[order], _values(frame.column("n")[k], pa.int64())[order]
                sums = []
                for value in counts:
                    per_run = _spread(x["links"] * value[x["pair_at"]], x["sizes"])
                    sums.append(_spread(per_run[x["runs"]], x["n_runs"]))
                yield record(schema, lists["doc_id"], *[lists[f] for f in _FIXED], *sums, lists["groups_sha256"])
        release()

    return run


def _values(cell: pa.ListScalar, kind: pa.DataType) -> np.ndarray:
    """The numbers of a list; none of a null one."""
    return (pa.array([], kind) if cell.values is None else cell.values).to_numpy(zero_copy_only=False)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct numbers; numpy's own ``unique`` hashes them first, which takes longer."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[0] - 1) != 0] if len(values) else values


def _spread(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of these sizes."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(sizes)])])


def count_pairs(packed: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (n is the highest of its first id)."""
    counts = packed.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", _PAIR_BITS)))  # at most as many rows as B has ids
    return counts.agg(F.sum("x.docs").alias("n")).select("pair", "n", (F.col("n") == top).alias("best"))


def align_tokens(docs: DataFrame, models: tuple[bytes, bytes], broadcast_bytes: int = 1 << 26) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    ``models`` are the bytes of the two tokenizer files. Texts that are null, empty or not restored by the bytes of the
    tokens of either have no tokens: zeros and an empty ``groups_sha256``. Repeated rows each count as a document; null ids
    stay null; other columns are not read; an empty table gives no rows. A word of any length is one run.

    Texts are aligned once; what is written is a row for each some 1 MB of texts: its documents as numbers of runs, its
    distinct runs as numbers of pairs, its distinct pairs with their documents. Pair counts are sent to all workers if they
    take at most ``broadcast_bytes`` (they are counted first), else joined to the distinct pairs; both give the same rows.
    """
    names = tuple(hashlib.sha256(m).hexdigest() for m in models)
    held = docs.sparkSession.sparkContext.broadcast(models)  # two vocabulary files of a few MB
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_packing(held, names), "data binary, pairs array<long>, docs array<long>")
    packed = written(found.withColumn("batch", F.monotonically_increasing_id()), "aligned")
    pairs = written(count_pairs(packed), "pairs")
    if pairs.count() * 17 <= broadcast_bytes:
        got = pairs.orderBy("pair").toArrow()
        table = docs.sparkSession.sparkContext.broadcast(tuple(got.column(c).to_numpy() for c in ("pair", "n", "best")))
        return packed.select("data").mapInArrow(_summing(table), _OUT_DDL)
    each = packed.select("batch", F.explode("pairs").alias("pair")).join(pairs, "pair").groupBy("batch")
    given = each.agg(F.collect_list(F.struct("pair", "n", "best")).alias("x"))  # the pairs of one batch, as many as it had
    known = given.select("batch", F.col("x.pair").alias("key"), F.col("x.n").alias("n"), F.col("x.best").alias("best"))
    return packed.select("batch", "data").join(known, "batch", "left").mapInArrow(_summing(None), _OUT_DDL)
