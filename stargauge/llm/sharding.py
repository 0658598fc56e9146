"""Shards of near equal bytes by sampled splitters.

A size-weighted sample of keys is drawn, its quantiles cut the keys into many ranges, and ranges that turn out overfull
are sampled again and subdivided. The ranges' exact totals say where each begins in the whole order, so a row's place,
counted in bytes and in rows, is that of its range plus a running sum inside the range. A shard is an equal stretch of
all bytes in key order.

The splitters only decide how the work is dealt out: the order is total, so any sample leads to the same shards. Equal
texts share the first key and stay together, cut only where a shard ends. Totals are within one row of each other's size:
a shard holds ``total / shards`` bytes, give or take half of the two rows at its ends.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import written

LAW = "bytes"
#: Rows of a range, which one task sorts and adds up; more rows make more ranges.
ROWS_A_RANGE = 1_000_000
_KEYS = ["__key0", "__key1", "__salt"]
_SIGN = np.int64(-(2**63))


def _packed(*keys: np.ndarray) -> np.ndarray:
    """Keys of 64-bit integers as byte strings of the same order."""
    columns = np.stack([np.asarray(k, np.int64) ^ _SIGN for k in keys], axis=1).astype(">u8")  # stacking undoes byte orders
    return np.ascontiguousarray(columns).view(f"S{8 * len(keys)}").ravel()


def _range_of(bounds: list[bytes]) -> Column:
    """How many boundaries are at or before the row's key."""
    if not bounds:
        return F.lit(0)
    ends = np.array(bounds, f"S{8 * len(_KEYS)}")

    @F.pandas_udf("int")
    def place(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="int32")
        return pd.Series(np.searchsorted(ends, _packed(a, b, c), side="right").astype(np.int32))

    return place(*_KEYS)


def _sample(rows: DataFrame, total: int, wanted: int, turn: int) -> list[tuple[bytes, int]]:
    """About ``wanted`` keys, each row drawn with a probability in proportion to its size, with the bytes it stands for.

    The draw is a hash of the key and the turn, so it can be repeated. Expected size ``wanted``, whatever the input.
    """
    unit = F.shiftrightunsigned(F.xxhash64(*_KEYS, F.lit(turn)), 11) / F.lit(float(1 << 53))
    drawn = rows.where(unit < F.col("__size") * F.lit(wanted / total)).select(*_KEYS, "__size").toPandas()
    if drawn.empty:
        return []
    keys = _packed(*[drawn[k].to_numpy() for k in _KEYS])
    order = np.argsort(keys, kind="stable")
    weight = np.maximum(drawn["__size"].to_numpy(np.int64), total // wanted)
    return [(keys[k].ljust(8 * len(_KEYS), b"\0"), int(weight[k])) for k in order]


def _quantiles(sample: list[tuple[bytes, int]], parts: int) -> list[bytes]:
    """The keys at which the sample's weight passes each ``1 / parts`` of the whole."""
    total, seen, cuts = sum(w for _, w in sample), 0, []
    for key, weight in sample:
        if seen * parts // total != (seen + weight) * parts // total and seen:
            cuts.append(key)
        seen += weight
    return cuts


def _filled(rows: DataFrame, bounds: list[bytes]) -> list[tuple[int, int, int, int]]:
    """(range, bytes, rows, largest row) of every range that has rows, in order; one row a range reaches the driver."""
    sums = rows.groupBy(_range_of(bounds).alias("r")).agg(
        F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("__size").alias("most")
    )
    return sorted((x.r, x.bytes, x.n, x.most) for x in sums.collect())


def splitters(rows: DataFrame, ranges: int, sample: int) -> tuple[list[bytes], list[tuple[int, int, int, int]]]:
    """Boundaries between at least ``ranges`` ranges, and what each holds; none but its largest row exceeds 2 shares."""
    total = rows.agg(F.sum("__size")).first()[0] or 0
    if not total:
        return [], []
    limit = 2 * max(1, total // ranges)
    bounds = _quantiles(_sample(rows, total, sample * ranges, 0), ranges)
    turn = 0
    while True:
        held = _filled(rows, bounds)
        over = {r: size for r, size, _, most in held if size - most > limit}
        if not over:
            return bounds, held
        turn += 1
        inside = rows.where(_range_of(bounds).isin(list(over)))
        parts = {r: -(-2 * size // limit) for r, size in over.items()}
        drawn: dict[int, list[tuple[bytes, int]]] = {}
        for key, weight in _sample(inside, sum(over.values()), sample * sum(parts.values()) * turn, turn):
            drawn.setdefault(bisect_right(bounds, key), []).append((key, weight))
        bounds = sorted(set(bounds).union(*[_quantiles(some, parts[r]) for r, some in drawn.items() if r in parts]))


def place_in_shards(
    df: DataFrame, size: Column, keys: tuple[Column, Column], shards: int = 16, ranges: int | None = None, sample: int = 32
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1, equal stretches of all bytes) and ``slot`` (gapless from 0 in a shard).

    ``keys`` are two 64-bit columns that give the order; they must not be null. Rows with equal keys count as
    interchangeable: reruns give equal rows the same shards and slots, in any order among themselves, however many there
    are. ``size`` must be positive. Columns named ``shard`` or ``slot`` are replaced. An empty table gives an empty one.
    The rows are written once, with all columns of ``df``: select what is needed first. ``ranges`` is by default one for
    every ``ROWS_A_RANGE`` rows, 256 at least; about ``sample`` keys and one row for each of them reach the driver.
    """
    plain = df.drop("shard", "slot")
    rows = written(
        plain.select(
            "*", size.cast("long").alias("__size"), keys[0].alias("__key0"), keys[1].alias("__key1"),
            F.xxhash64(F.monotonically_increasing_id()).alias("__salt"),
        ),
        "sharded",
    )
    bounds, held = splitters(rows, ranges or max(256, -(-rows.count() // ROWS_A_RANGE)), sample)
    starts, at, row = [], 0, 0
    for r, size_, n, _ in held:
        starts.append((r, at, row, size_))
        at, row = at + size_, row + n
    spark, total = df.sparkSession, max(1, at)
    begin = spark.createDataFrame([s[:3] for s in starts], "__range int, __bytes long, __rows long")  # one row a range
    in_range = Window.partitionBy("__range").orderBy(*_KEYS)

    def placed(some: DataFrame) -> DataFrame:
        dealt = some.withColumn("__range", _range_of(bounds)).join(F.broadcast(begin), "__range")
        seen = F.sum("__size").over(in_range.rowsBetween(Window.unboundedPreceding, 0))
        return dealt.select(
            "*", (F.col("__rows") + F.row_number().over(in_range) - 1).alias("__row"), seen.alias("__seen")
        ).withColumn("shard", F.expr(f"cast((2 * (__bytes + __seen) - __size) * {shards} div {2 * total} as int)"))

    # The first row of each shard lies in a range in which a shard begins: only those are looked through.
    edges = [r for r, begun, _, held_ in starts if begun * shards // total != (begun + held_) * shards // total or begun == 0]
    near = sorted({x for e in edges for x in _neighbours(e, [s[0] for s in starts])})
    some = placed(rows.where(_range_of(bounds).isin(near))) if near else placed(rows.limit(0))
    first = [(x.shard, x.row) for x in some.groupBy("shard").agg(F.min("__row").alias("row")).collect()]
    opened = spark.createDataFrame(first, "shard int, __first long")  # one row a shard
    return placed(rows).join(F.broadcast(opened), "shard").select(
        *plain.columns, "shard", (F.col("__row") - F.col("__first")).alias("slot")
    )


def _neighbours(r: int, all_: list[int]) -> list[int]:
    """The range, and those beside it: a row at the end of one range may have its middle in the next stretch."""
    k = all_.index(r)
    return all_[max(0, k - 1):k + 2]


def digest_key(value: Column) -> Column:
    """60 bits of the MD5 of a value as text, null like the empty one: a key whose order other systems can repeat."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def shard_documents(docs: DataFrame, shards: int = 16, **options) -> DataFrame:
    """doc_id, size (bytes of the text and 1), text_crc32, law, shard, slot and grown_shard (null) of every document.

    Null texts have no bytes and a CRC of 0, null ids count as empty ones; repeated rows each have a slot; other columns
    are not read. Texts of any length are only measured and hashed: what is shuffled is some 50 bytes a document.
    """
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        digest_key(F.col("text")).alias("__text"),
    )
    dealt = place_in_shards(slim, F.col("size"), (F.col("__text"), digest_key(F.col("doc_id"))), shards, **options)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard")
    )


def write_shards(placed: DataFrame, path: str, rows_a_file: int = 1_000_000) -> None:
    """Write rows that have ``shard`` and ``slot`` under one folder a shard, files in the order of slots."""
    part = F.floor(F.col("slot") / rows_a_file)
    (
        placed.withColumn("__part", part).repartition("shard", "__part").sortWithinPartitions("shard", "slot").drop("__part")
        .write.partitionBy("shard").parquet(path)
    )
