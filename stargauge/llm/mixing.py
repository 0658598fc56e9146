"""Mix sources to target weights: block quotas down a multivariate-hypergeometric tree, disjoint permuted blocks.

1. Every document belongs to a block of its source by a hash; a source has as many blocks as its words fill.
2. A source's target is spent in passes: whole passes take all its blocks, the last one takes blocks in a permuted
   order until the target is met; of the block that crosses the target, documents in hash order.
3. The tree starts with the number of block draws of every source and the number of output shards. Each node halves
   its shards and gives the left half, by a multivariate hypergeometric draw, its exact number of block draws. The
   leaves hold how many blocks of each source a shard gets; together they spend every quota exactly.
4. Each leaf draws its count from its sources' permuted blocks: disjoint, consecutive runs, so that every draw has one
   shard. A document is taken as often as leaves draw its block; shards order their documents by a hash.

All draws are hashes or seeded by the node, so reruns agree. Documents decide by their own hash against the plan of
their block: no row is matched with another row of the same text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import rank_in_group
from .store import small, written
from .words import release


#: Leading bits of a hash that cut a pass over a source into cells.
_CELL_BITS = 10


@F.arrow_udf(T.LongType())
def word_count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Runs of bytes other than ASCII white space; null has none."""
    for column in columns:
        yield pa.array([0 if t is None else len(t.split()) for t in column.cast(pa.binary()).to_pylist()], pa.int64())
        release()


@dataclass
class Mixture:
    """``rows``: every document's source, size, rank and block; ``quotas``: the leaves of the tree; ``draws``: the draws
    of each block, without those of which no document is taken."""

    sources: DataFrame
    rows: DataFrame
    quotas: DataFrame
    draws: DataFrame
    n_blocks: int
    shards: int


def _rank(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col))


def _block(blocks: Column | str) -> Column:
    return F.pmod(F.xxhash64("rank", F.lit(1)), blocks)


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``target``: ``share`` of all sizes by weight, at most ``most`` times a source's size, the excess shared again.

    ``sources`` has source, source_size and weight. Each round caps the sources above their limit and shares what
    they leave by weight among the others, until none is above.
    """
    limit, wanted = F.col("source_size") * most, F.lit(None).cast("double")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > limit
        row = sources.agg(
            F.sum(F.when(over, limit).otherwise(0.0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.sum(over.cast("long"))
        ).first()
        if level is not None and (row[2] or 0) == capped:
            break
        capped = row[2] or 0  # no row: no sum
        level = max(0.0, total * share - (row[0] or 0.0)) / row[1] if row[1] else 0.0
    wanted = F.col("weight") * level
    return sources.withColumn("target", F.when(wanted > limit, limit).otherwise(wanted).cast("double"))


def _halves(quotas: DataFrame, shards: int, total: int, seed: int) -> DataFrame:
    """shard, source_no, quota: the leaves of the splitting tree over ``source_no, quota``."""

    def slots(first: int, last: int) -> int:
        return total * last // shards - total * first // shards

    def split(frame: pd.DataFrame) -> pd.DataFrame:
        first, last = int(frame["first"].iloc[0]), int(frame["last"].iloc[0])
        if last - first == 1:
            return frame
        middle = (first + last) // 2
        frame = frame.sort_values("source_no")
        random = np.random.default_rng([seed, first, last])
        quota = frame["quota"].to_numpy(np.int64)
        left = random.multivariate_hypergeometric(quota, slots(first, middle), method="marginals")
        sides = [frame.assign(first=a, last=b, quota=q) for a, b, q in ((first, middle, left), (middle, last, quota - left))]
        return pd.concat(sides)[lambda x: x["quota"] > 0]

    nodes = quotas.select(F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("last"), "source_no", F.col("quota").cast("long"))
    for _ in range(max(0, shards - 1).bit_length()):
        nodes = nodes.groupBy("first", "last").applyInPandas(split, nodes.schema)
    return nodes.select(F.col("first").alias("shard"), "source_no", "quota")


def _in_order(draws: DataFrame, place: Column) -> DataFrame:
    """Add ``draw``, the number of a draw in its source's order of pass and ``place``, and ``before``, the words before it.

    Places are hashes, so their leading bits cut a pass into cells of like size: sums of the cells, then sums within a
    cell. No task orders all blocks of a source.
    """
    draws = draws.withColumn("place", place).withColumn("cell", F.shiftright("place", 64 - _CELL_BITS))
    cell, upto = ["source_no", "pass", "cell"], Window.partitionBy("source_no").orderBy("pass", "cell")
    sums = draws.groupBy(*cell).agg(F.sum("words").alias("cell_words"), F.count(F.lit(1)).alias("cell_draws"))
    sums = sums.select(*cell, (F.sum("cell_words").over(upto) - F.col("cell_words")).alias("words_before"), (F.sum("cell_draws").over(upto) - F.col("cell_draws")).alias("draws_before"))
    within = Window.partitionBy(*cell).orderBy("place", "block")
    before = F.col("words_before") + F.sum("words").over(within) - F.col("words")
    number = F.col("draws_before") + F.row_number().over(within) - 1
    return draws.join(sums, cell).withColumn("before", before).withColumn("draw", number.cast("long"))


def plan_mixture(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, shards: int = 32,
    block_words: int | None = None, blocks_per_shard: int = 64, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> Mixture:
    """Targets, blocks and draws for all rows of ``docs``.

    Sources in code point order, null last, have the ``weights`` in turn. Null texts have size 0. Rows with equal id
    and text share their fate. An empty table, or one without words, draws nothing.

    The mixture has ``shards`` shards of about ``blocks_per_shard`` blocks, so blocks grow with the table; with
    ``block_words`` blocks hold that many words and there are as many shards as the blocks fill.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"),
        _rank(id_col, text_col, seed).alias("rank"),
    )
    rows = written(rows, "sizes")
    sums = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = rank_in_group(sums, [], [F.col("source").asc_nulls_last()], "source_no")
    turn = F.pmod(F.col("source_no") - 1, F.lit(len(weights)))
    weighted = written(ranked.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)), "weights")
    fixed = block_words is not None
    if not fixed:
        words = weighted.agg(F.sum("source_size")).first()[0] or 0
        block_words = max(1, math.ceil(words * share / (shards * blocks_per_shard)))
    filled = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")
    sources = written(source_targets(weighted, weights, share, most).withColumn("blocks", filled), "targets")
    count = sources.agg(F.count(F.lit(1)), F.sum("blocks")).first()
    named = small(sources.select(F.col("source").alias("s"), "source_no", "source_size", "target", "blocks"), count[0])
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "source_no", "size", "rank", "source_size", "target", _block(F.col("blocks")).alias("block"))

    blocks = written(rows.groupBy("source_no", "block").agg(F.sum("size").alias("words")), "blocks")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    passes = sources.select("source_no", "target", F.explode(F.sequence(F.lit(0).cast("long"), whole)).alias("pass"))
    draws = _in_order(blocks.join(passes, "source_no"), F.xxhash64(F.lit(seed), "source_no", "block", "pass"))
    limit = F.when(F.col("before") + F.col("words") > F.col("target"), F.col("target") - F.col("before"))
    draws = draws.where("before < target").select("source_no", "block", "pass", limit.alias("limit"), "draw")
    draws = written(draws, "draws")
    total = draws.count()
    shards = max(1, -(-total // blocks_per_shard) if fixed else min(shards, total))
    quotas = written(_halves(draws.groupBy("source_no").agg(F.count(F.lit(1)).alias("quota")), shards, total, seed), "quotas")
    upto = Window.partitionBy("source_no").orderBy("shard")
    leaves = quotas.withColumn("until", F.sum("quota").over(upto)).select("shard", "source_no", F.explode(F.sequence(F.col("until") - F.col("quota"), F.col("until") - 1)).alias("draw"))
    draws = written(draws.join(leaves, ["source_no", "draw"]), "shards")

    # Of a crossing block: documents in rank order while they bring the sum nearer to the limit.
    cut = draws.where("limit IS NOT NULL").select("source_no", "block", "limit")
    inside = rows.select("source_no", "block", "rank", "size").join(small(cut, count[0]), ["source_no", "block"])
    by_rank = Window.partitionBy("source_no", "block").orderBy("rank")
    through, own = F.sum("size").over(by_rank), F.sum("size").over(Window.partitionBy("source_no", "block", "rank"))
    inside = inside.select("source_no", "block", "rank", "limit", through.alias("through"), (through - own).alias("before"))
    inside = inside.where((F.col("through") <= F.col("limit")) | (F.col("through") - F.col("limit") < F.col("limit") - F.col("before")))
    last = inside.groupBy("source_no", "block").agg(F.max("rank").alias("last"))
    draws = draws.join(last, ["source_no", "block"], "left").where("limit IS NULL OR last IS NOT NULL")
    draws = draws.groupBy("source_no", "block").agg(F.collect_list(F.struct("pass", "shard", F.when(F.col("limit").isNotNull(), F.col("last")).alias("last"))).alias("draws"))
    return Mixture(sources, rows, quotas, written(draws, "mixture"), count[1] or 0, shards)


def _taken() -> Column:
    """The draws of a row's block that the row is in."""
    return F.filter(F.coalesce("draws", F.array().cast("array<struct<pass: long, shard: long, last: long>>")), lambda d: d["last"].isNull() | (F.col("rank") <= d["last"]))


def mixture_sizes(mixture: Mixture) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, taken (its words times its draws), and the shards
    it is drawn for, in order of the passes, comma-joined."""
    drawn = mixture.rows.join(small(mixture.draws, mixture.n_blocks), ["source_no", "block"], "left")
    drawn = drawn.withColumn("own", F.array_sort(_taken()))
    shards = F.array_join(F.transform("own", lambda d: d["shard"].cast("string")), ",")
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("own")).cast("long").alias("taken"), shards.alias("shards"))


def mix_documents(docs: DataFrame, mixture: Mixture, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: rows of ``docs`` once per draw, dealt to the output shards, shuffled within each.

    Takes the table and arguments the plan was made from; returns its columns.
    """
    names = docs.columns
    row = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), _rank(id_col, text_col, seed).alias("rank"), F.col(source_col).cast("string").alias("source"))
    named = mixture.sources.select(F.col("source").alias("s"), "source_no", "blocks")
    row = row.join(small(named, mixture.n_blocks), F.col("source").eqNullSafe(F.col("s"))).withColumn("block", _block(F.col("blocks")))
    drawn = row.join(small(mixture.draws, mixture.n_blocks), ["source_no", "block"]).withColumn("draw", F.explode(_taken()))
    dealt = drawn.select("row", F.col("draw.shard").alias("shard"), F.xxhash64("rank", "draw.pass").alias("place"))
    return dealt.repartition(max(mixture.shards, 1), "shard").sortWithinPartitions("shard", "place").select("row.*")
