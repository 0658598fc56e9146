"""Jaccard join of shingle sets that skips by relations between sets, and the groups its links make.

Each text is the set of its distinct word shingles. Sets that are equal are one *class*. The shingles of a class are
ordered by how often they occur, rare ones first; two classes that link share one of the first few (the prefix).
The index has a list for each prefix shingle, cut by set size into windows, with the position of the shingle in
each set.

* Index level: the sets of a list fall into blocks of equal size and position. The most that two sets can still
  share after a position decides for whole pairs of blocks at once whether they are skipped.
* Answer level: in each list a few *pivots*, the same ones in the lists of similar sets, are compared with all of
  it. A set whose answer holds a pivot takes over that pivot's component, so it is not compared again with the
  sets found there. The lists with one first pivot make a *neighbourhood*; in it only the sets outside the main
  component are still compared, with sets of other components, by products of set x shingle tables in cells of
  bounded size.

A pair that shares c prefix shingles can share no more than c plus what is left after the longer rest; pairs below
their need are dropped without reading the sets. What passes is compared exactly. The components equal those of all
links: a pair is left out only if both are in one component already or if a bound excludes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .store import small, written
from .words import U64, Words, batches, mix, record, shingle_hashes, texts_of

#: Frequencies are kept for this many hash buckets of shingles: 8 MB, whatever the input. They only order shingles.
_BUCKET_BITS, _SLICE = 20, 1 << 16
#: Sets a side of a cell, about.
_CELL = 1024
#: Bytes of text that a task turns into arrays at a time.
_STEP = 1 << 20

_SLICES = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])
_SETS = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("n", pa.int64()), ("cid", pa.int64()), ("prefix", pa.binary())])
_PREFIX = pa.schema([("token", pa.int64()), ("cid", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])
_FULL = pa.schema([("cid", pa.int64()), ("shingles", pa.binary())])
_ENDS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("common", pa.int64()), ("size_a", pa.int64()), ("size_b", pa.int64())])


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    value, owner = shingle_hashes(Words(texts_of(column), lower=True), size)
    ends = np.searchsorted(owner, np.arange(len(column) + 1))
    for k in range(len(column)):
        yield np.unique(value[ends[k]: ends[k + 1]])


def _class(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    with np.errstate(over="ignore"):
        spread = mix(shingles)
        name = mix(np.array([spread.sum(dtype=U64) + mix(np.bitwise_xor.reduce(spread, keepdims=True))[0] * U64(3) + U64(len(shingles))], U64))
    return int(name.astype(np.int64)[0])


def shingle_frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """Occurrences of the shingles of all texts, by hash bucket."""
    buckets = 1 << _BUCKET_BITS

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int32)
        for frame in batches(frames, size=_STEP):
            value, _ = shingle_hashes(Words(texts_of(frame.column(0)), lower=True), size)
            total += np.bincount((value >> U64(64 - _BUCKET_BITS)).astype(np.int64), minlength=buckets).astype(np.int32)
        if total.any():
            slices = range(buckets // _SLICE)
            yield record(_SLICES, list(slices), [total[k * _SLICE: (k + 1) * _SLICE].tobytes() for k in slices])

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for frame in frames:
            for k, data in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                totals[k] = totals.get(k, 0) + np.frombuffer(data, np.int32).astype(np.int64)
        yield record(_SLICES, list(totals), [x.tobytes() for x in totals.values()])

    ddl = "slice int, counts binary"
    rows = docs.select("text").mapInArrow(count, ddl).repartition(buckets // _SLICE, "slice").mapInArrow(add, ddl).collect()
    total = np.zeros(buckets, np.int64)
    for row in rows:  # 8 MB in all
        total[row["slice"] * _SLICE: (row["slice"] + 1) * _SLICE] = np.frombuffer(row["counts"], np.int64)
    return total


def _prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, version (a hash of the text), n (set size), cid (name of the set, null if empty) and the shingles of its prefix, rare ones first."""
    frequency = docs.sparkSession.sparkContext.broadcast(shingle_frequencies(docs, size))

    def prefixes(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequency.value
        for frame in batches(frames, size=_STEP):
            n, cid, prefix = [], [], []
            for shingles in _sets(frame.column(2), size):
                m = len(shingles)
                keep = m - (percent * m + 99) // 100 + 1 if m else 0
                order = np.lexsort((shingles, often[(shingles >> U64(64 - _BUCKET_BITS)).astype(np.int64)]))[:keep]
                n.append(m)
                cid.append(_class(shingles) if m else None)
                prefix.append(shingles[order].tobytes())
            yield record(_SETS, frame.column(0), frame.column(1), n, cid, prefix)

    return docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(prefixes, "doc_id long, version long, n long, cid long, prefix binary")


def _lists(sets: DataFrame) -> DataFrame:
    """The index: a row for each class and prefix shingle, of shingles that two classes share at least."""

    def unfold(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            tokens = [np.frombuffer(x, np.int64) for x in frame.column(2).to_pylist()]
            if tokens:
                lengths = np.array([len(x) for x in tokens])
                pos = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                yield record(_PREFIX, np.concatenate(tokens), np.repeat(np.array(frame.column(0)), lengths), pos.astype(np.int32), np.repeat(np.array(frame.column(1)), lengths).astype(np.int32))

    def shared(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose shingle is also that of a neighbour; the last row waits for the next batch."""
        held, before = None, None
        for frame in frames:
            if held is not None:
                frame = pa.Table.from_batches([held, frame]).combine_chunks().to_batches()[0]
            if not frame.num_rows:
                continue
            token = np.array(frame.column(0))
            same = token[1:] == token[:-1]
            keep = np.concatenate(([before is not None and token[0] == before], same)) | np.concatenate((same, [False]))
            held, last = frame.slice(frame.num_rows - 1), frame.num_rows - 1
            if last:
                before = token[last - 1]
                yield frame.slice(0, last).filter(pa.array(keep[:last]))
        if held is not None and before is not None and held.column(0)[0].as_py() == before:
            yield held

    ddl = "token long, cid long, pos int, n int"
    rows = sets.select("cid", "n", "prefix").mapInArrow(unfold, ddl)
    return rows.repartition("token").sortWithinPartitions("token").mapInArrow(shared, ddl)


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """All shingles of the wanted classes (``rep``, the id of one of its rows, and ``cid``), from their texts."""
    wanted = written(wanted.select("rep", F.col("cid").alias("wanted")), "wanted")
    reps = small(wanted, wanted.count())
    texts = docs.select("doc_id", "text").join(reps, F.col("doc_id").eqNullSafe(F.col("rep"))).select("wanted", "text")

    def full(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for frame in batches(frames, size=_STEP):
            cid, data = [], []
            for name, shingles in zip(frame.column(0).to_pylist(), _sets(frame.column(1), size), strict=True):
                if name not in seen and len(shingles) and _class(shingles) == name:
                    seen.add(name)
                    cid.append(name)
                    data.append(shingles.tobytes())
            yield record(_FULL, cid, data)

    return texts.mapInArrow(full, "cid long, shingles binary")


def _common_prefix(frames: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of a, b, their sizes and prefixes: the pairs that share enough of their prefixes to link."""
    for frame in batches(frames):
        n, m = (np.array(frame.column(k)) for k in (2, 3))
        left, right = ([np.frombuffer(x, U64) for x in frame.column(k).to_pylist()] for k in (4, 5))
        common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)], np.int64)
        rest = np.maximum(n - np.array([len(x) for x in left], np.int64), m - np.array([len(y) for y in right], np.int64))
        yield frame.select(["a", "b"]).filter(pa.array((100 + percent) * (common + rest) >= percent * (n + m)))


class _Comparer:
    """Exact comparisons of pairs; the shingles of a set are read from its text when a pair first needs them."""

    def __init__(self, docs: DataFrame, sets: DataFrame, classes: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent, self.prefixes, self.full = docs, size, percent, classes, None
        self.classes = written(sets.where("cid IS NOT NULL").groupBy("cid").agg(F.min("doc_id").alias("rep")), "classes")

    def _of(self, rows: DataFrame, pairs: DataFrame) -> DataFrame:
        ends = written(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct(), "pair-ends")
        return rows.join(small(ends, ends.count()), "cid", "left_semi")

    def shingles(self, ids: DataFrame) -> DataFrame:
        """``cid, shingles`` of these classes; texts are read for those not seen before."""
        ids = written(ids, "set-ids")
        new = ids if self.full is None else ids.join(self.full.select("cid"), "cid", "left_anti")
        new = written(_full_sets(self.docs, self.classes.join(new, "cid", "left_semi"), self.size), "full-sets")
        self.full = new if self.full is None else self.full.unionByName(new)
        return self.full.join(small(ids, ids.count()), "cid", "left_semi")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose prefixes do not exclude a link."""
        percent, known = self.percent, self._of(self.prefixes, pairs)
        left = known.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("prefix").alias("p_a"))
        right = known.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("prefix").alias("p_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "p_a", "p_b")
        return both.mapInArrow(lambda frames: _common_prefix(frames, percent), "a long, b long")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """The sizes of the two sets of each pair and of what they share, a written table."""
        pairs = written(self.likely(written(pairs, "pairs")), "likely-pairs")
        full = self.shingles(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
        left = full.select(F.col("cid").alias("a"), F.col("shingles").alias("in_a"))
        right = full.select(F.col("cid").alias("b"), F.col("shingles").alias("in_b"))

        def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in batches(frames):
                first = [np.frombuffer(x, U64) for x in frame.column(2).to_pylist()]
                second = [np.frombuffer(x, U64) for x in frame.column(3).to_pylist()]
                common = []
                for x, y in zip(first, second, strict=True):
                    at = np.searchsorted(y, x)
                    at[at == len(y)] = 0
                    common.append(int((y[at] == x).sum()))
                yield record(_PAIR, frame.column(0), frame.column(1), common, [len(x) for x in first], [len(x) for x in second])

        both = pairs.join(left, "a").join(right, "b").select("a", "b", "in_a", "in_b")
        return written(both.mapInArrow(compare, "a long, b long, common long, size_a long, size_b long").distinct(), "compared")


def _possible(percent: int, n: str, pos: str, m: str, other: str) -> Column:
    """Sets of n and m shingles that first share those at these positions can still link."""
    least, most = F.least(n, m), F.greatest(n, m)
    rest = F.least(F.col(n) - F.col(pos), F.col(m) - F.col(other))
    return (100 * least >= percent * most) & ((100 + percent) * rest >= percent * (F.col(n) + F.col(m)))


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a != b").distinct()


def class_components(docs: DataFrame, sets: DataFrame, size: int, percent: int, pivots: int) -> DataFrame:
    """``node, component`` of the classes that link with another one."""
    classes = sets.where("cid IS NOT NULL").groupBy("cid").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    classes = written(classes, "class-prefixes")
    index = written(_lists(classes), "prefix-lists")
    band = F.floor(F.log("n") / -np.log((percent - 1) / 100)).cast("int") if percent > 1 else F.lit(0)
    lists = index.withColumn("window", F.explode(F.array(band, band + 1)))  # sizes that can link share a window
    comparer, key = _Comparer(docs, sets, classes, size, percent), ["token", "window"]
    linked = F.expr(f"100 * common >= {percent} * (size_a + size_b - common)")

    order = Window.partitionBy(*key).orderBy(F.xxhash64("cid"), "cid")
    chosen = lists.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pivots)
    chosen = chosen.select(*key, "place", F.col("cid").alias("pivot"), F.col("pos").alias("p_pos"), F.col("n").alias("p_n"))
    compared = comparer(_ordered(lists.join(chosen, key).where("cid != pivot").where(_possible(percent, "n", "pos", "p_n", "p_pos")), "cid", "pivot"))
    links = compared.where(linked).select("a", "b")
    found = written(components(links), "class-components")

    # What is left: lists longer than their pivots with sets of more than one component.
    rows = lists.join(found.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    counts = rows.groupBy(*key, "component").agg(F.count(F.lit(1)).alias("rows"))
    kinds = counts.groupBy(*key).agg(F.sum("rows").alias("length"), F.max_by("component", F.struct("rows", "component")).alias("main"), F.max("rows").alias("in_main"))
    open_lists = written(kinds.where((F.col("length") > pivots) & (F.col("in_main") < F.col("length"))), "open-lists")
    if open_lists.isEmpty():
        return found
    first = chosen.where("place = 1").select(*key, "pivot")
    near = rows.join(open_lists.select(*key), key, "left_semi").join(first, key).select("pivot", "cid", "n", "component").distinct()
    near = written(near, "neighbourhoods")
    more = _cells(near, comparer.shingles(near.select("cid").distinct()), percent)
    return components(links.union(more))


def _cells(near: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links of a neighbourhood between two components, one of them not its main one.

    The outside sets and all sets are dealt to parts of about CELL sets; every cell is one part of each.
    """
    def parts(count):
        return F.ceil(count / _CELL).cast("int")

    def own(count):
        return F.pmod(F.hash("cid"), parts(count))

    def all_of(count):
        return F.explode(F.sequence(F.lit(0), parts(count) - 1))

    counts = near.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("rows"))
    kinds = counts.groupBy("pivot").agg(F.sum("rows").alias("length"), F.max_by("component", F.struct("rows", "component")).alias("main"), F.max("rows").alias("in_main"))
    rows = near.join(kinds.where("in_main < length"), "pivot").join(full, "cid")
    outside, columns = F.col("length") - F.col("in_main"), ["pivot", "cid", "component", "shingles"]
    right = rows.select(*columns, F.lit(1).alias("side"), own(F.col("length")).alias("j"), all_of(outside).alias("i"))
    left = rows.where("component != main").select(*columns, F.lit(0).alias("side"), own(outside).alias("i"), all_of(F.col("length")).alias("j"))
    cells = left.unionByName(right).repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")

    def pairs(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for frame in frames:
            for row in zip(*(frame.column(c).to_pylist() for c in ("pivot", "i", "j", "side", "cid", "component", "shingles")), strict=True):
                if row[:3] != current and held:
                    yield _cell_links(held, percent)
                    held = []
                current = row[:3]
                held.append(row[3:])
        if held:
            yield _cell_links(held, percent)

    return cells.mapInArrow(pairs, "a long, b long").distinct()


def _cell_links(rows: list[tuple], percent: int) -> pa.RecordBatch:
    side, cid, component = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    sets = [np.frombuffer(r[3], U64) for r in rows]
    n = np.array([len(s) for s in sets])
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    least, most = np.minimum(n[x][:, None], n[y][None, :]), np.maximum(n[x][:, None], n[y][None, :])
    keep = (component[x][:, None] != component[y][None, :]) & (100 * least >= percent * most)
    if keep.any():
        _, token, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner, shared = np.repeat(np.arange(len(rows)), n), np.flatnonzero(often > 1)
        common = np.zeros(keep.shape, np.float32)
        for k in range(0, len(shared), 1024):  # some columns of the set x shingle table at a time
            column = np.full(len(often), -1)
            column[shared[k: k + 1024]] = np.arange(len(shared[k: k + 1024]))
            use = np.flatnonzero(column[token] >= 0)
            table = np.zeros((len(rows), len(shared[k: k + 1024])), np.float32)
            table[owner[use], column[token[use]]] = 1
            common += table[x] @ table[y].T
        keep &= (100 + percent) * common >= percent * (n[x][:, None] + n[y][None, :])
    a, b = np.nonzero(keep)
    a, b = cid[x[a]], cid[y[b]]
    return record(_ENDS, np.minimum(a, b), np.maximum(a, b))


def jaccard_groups(docs: DataFrame, size: int = 5, percent: int = 80, pivots: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest id reachable by links (its own included).

    Two texts link when ``100 * common >= percent * union`` of their sets of ``size``-word shingles. Words are
    lower-cased (A-Z). A text of fewer words is one shingle; without words or text the set is empty and links with
    nothing. Rows with equal texts link; rows with equal ids are separate rows of one id. A null id is never the
    smallest of a group with other ids; alone, its component is null. An empty table gives no row.
    """
    rows = _grouped(docs, size, percent, pivots, id_col, text_col)
    least = rows.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = rows.join(least, "group", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _grouped(docs: DataFrame, size: int, percent: int, pivots: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, version, n_shingles and group of every row; texts without shingles have no group."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = written(_prefixes(own, size, percent), "shingle-sets")
    found = class_components(own, sets, size, percent, pivots).select(F.col("node").alias("cid"), F.col("component").alias("group"))
    rows = sets.select("doc_id", "version", F.col("n").alias("n_shingles"), "cid")
    return rows.join(found, "cid", "left").withColumn("group", F.coalesce("group", "cid")).drop("cid")


def keep_one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80, pivots: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each linked group the one with the smallest id (then text hash) stays.

    Rows with equal id and text count as one; ids come before null. Texts without words are in no group and stay.
    The columns stay as they are.
    """
    rows = written(_grouped(docs, size, percent, pivots, id_col, text_col).where("group IS NOT NULL"), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")
    stays = rows.groupBy("group").agg(F.min(place).alias("stays"))
    gone = rows.join(stays, "group").where(~place.eqNullSafe(F.col("stays"))).select(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).distinct()
    gone = written(gone, "copies")
    same = docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__version"))
    kept = docs.join(small(gone, gone.count()), same, "left_anti")
    twice = rows.groupBy("doc_id", "version").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates([id_col, text_col]) if twice else kept
