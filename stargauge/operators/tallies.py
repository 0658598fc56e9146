"""Contingency tables, hierarchies, flows, histograms and list counts.

All of them aggregate to the distinct combinations first; whatever comes after
works on that small result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import level_position
from .ranking import rank_in_group
from .topk import top_k_semi, value_counts



def _not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def declared_counts(df: DataFrame, column: str, labels: Sequence[str], count: str = "n") -> DataFrame:
    """Rows per declared label in declared order; a label nobody has shows 0."""
    spark = df.sparkSession
    names = spark.createDataFrame([(i, x) for i, x in enumerate(labels, 1)], f"{column}_ord int, {column} string")
    found = value_counts(df.select(column), column, count)
    return (
        names.join(found, column, "left")
        .select(column, f"{column}_ord", F.coalesce(count, F.lit(0)).alias(count))
        .orderBy(f"{column}_ord")
    )


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None, k: int | None = None) -> DataFrame:
    """Counts of row by column values, the ``k`` most frequent rows only, fullest row first.

    There is a column for every value found among these rows, in alphabetic
    order; at most ``spark.sql.pivotMaxValues``, beyond which this raises.
    Listed ``values`` come first, in their order, with 0 where nobody has them.
    """
    pairs = _not_null(df.select(row, column), [row, column])
    kept = top_k_semi(pairs, row, k) if k else pairs
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = [r[0] for r in kept.select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values, too many for columns")
    values = [*(values or []), *(v for v in found if v not in set(values or []))]
    table = kept.groupBy(row).agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(column) == v).alias(v) for v in values],
    )
    return table.orderBy(F.desc("_total"), row).drop("_total")


def level_profile(df: DataFrame, row: str, level: str, levels: Sequence[str], k: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """Counts of (row, level) for the most frequent rows, by row total and then level order."""
    pairs = _not_null(df.select(row, level), [row, level])
    kept = top_k_semi(pairs, row, k, among) if k else pairs
    counts = kept.groupBy(row, level).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(row).agg(F.sum("n").alias("row_total"))
    return (
        counts.join(totals, row)
        .withColumn("level_ord", level_position(F.col(level), levels))
        .orderBy(F.desc("row_total"), row, F.col("level_ord").asc_nulls_last(), level)
    )


def level_counts(df: DataFrame, level: str, levels: Sequence[str]) -> DataFrame:
    """Rows per known level in level order; unknown levels are dropped, absent ones not shown."""
    return (
        value_counts(df.select(level), level)
        .withColumn("level_ord", level_position(F.col(level), levels))
        .where(F.col("level_ord").isNotNull())
        .orderBy("level_ord")
    )


def level_means(df: DataFrame, level: str, levels: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Count and means per level that occurs, in level order; unknown levels come last."""
    return (
        df.where(F.col(level).isNotNull())
        .groupBy(level)
        .agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in metrics])
        .withColumn("level_ord", level_position(F.col(level), levels))
        .orderBy(F.col("level_ord").asc_nulls_last(), level)
    )


def level_stats(df: DataFrame, level: str, levels: Sequence[str], metric: str) -> DataFrame:
    """Count and mean per declared level; an empty level shows 0 for both."""
    spark = df.sparkSession
    names = spark.createDataFrame([(i, x) for i, x in enumerate(levels, 1)], f"level_ord int, {level} string")
    found = level_means(df.select(level, metric), level, levels, [metric]).drop("level_ord")
    return names.join(found, level, "left").fillna(0, ["n", f"avg_{metric}"]).orderBy("level_ord")


def hierarchy(df: DataFrame, levels: Sequence[str], k: int | None = None, top_of: str | None = None) -> DataFrame:
    """Counts at every depth of a hierarchy: parents are the sums of their children."""
    rows = _not_null(df.select(*levels), levels)
    if k and top_of:
        rows = top_k_semi(rows, top_of, k)
    leaves = rows.groupBy(*levels).agg(F.count(F.lit(1)).alias("_n"))
    depth = len(levels) - sum(F.grouping(c).cast("int") for c in levels)
    sums = leaves.rollup(*levels).agg(F.sum("_n").alias("n"), depth.cast("int").alias("depth"))
    return sums.where(F.col("depth") > 0).orderBy(*[F.col(c).asc_nulls_first() for c in levels])


def flow_pairs(df: DataFrame, source: str, items: str, exclude: Sequence[str] = (), k: int = 8, min_count: int = 2) -> DataFrame:
    """Counts of (source, list item), limited to the ``k`` most frequent items and to lasting pairs."""
    links = _not_null(df.select(source, items), [source, items]).select(source, F.explode(items).alias("item"))
    links = links.where((F.col("item") != "") & ~F.col("item").isin(list(exclude)))
    counts = links.groupBy(source, "item").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("item").agg(F.sum("n").alias("_t")).orderBy(F.desc("_t"), "item").limit(k).select("item")
    return counts.join(F.broadcast(top), "item", "left_semi").where(F.col("n") >= min_count).select(source, "item", "n")


def flow_nodes(pairs: DataFrame, source: str) -> DataFrame:
    """Numbered nodes of a flow: sources A to Z, then items by total, from 0."""
    sources = pairs.select(F.lit(0).alias("side"), F.col(source).alias("node"), F.lit(0).cast("long").alias("total")).distinct()
    items = pairs.groupBy(F.lit(1).alias("side"), F.col("item").alias("node")).agg(F.sum("n").alias("total"))
    numbered = rank_in_group(
        sources.unionByName(items), [], [F.col("side"), F.col("total").desc(), F.col("node")], "node_index"
    )
    return numbered.select("side", "node", (F.col("node_index") - 1).alias("node_index"), "total")


def flow_links(pairs: DataFrame, source: str) -> DataFrame:
    """The pairs as (source index, target index, value)."""
    nodes = flow_nodes(pairs, source)  # numbered once; both joins read the pinned nodes
    left = nodes.where("side = 0").select(F.col("node").alias(source), F.col("node_index").alias("source_index"))
    right = nodes.where("side = 1").select(F.col("node").alias("item"), F.col("node_index").alias("target_index"))
    return pairs.join(left, source).join(right, "item").select("source_index", "target_index", F.col("n").alias("value"))


def list_counts(df: DataFrame, items: str, k: int | None = None) -> DataFrame:
    """How often each list element occurs, most frequent first."""
    each = df.select(F.explode(items).alias("item")).where(F.col("item") != "")
    counts = each.groupBy("item").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "item")
    return counts.limit(k) if k else counts


def histogram(df: DataFrame, column: str, bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the smallest and largest value, per group if asked.

    Only filled bins are returned. A column with one value has a single bin.
    Per group, the spans are combined before the shuffle and joined to the rows
    by key: Spark broadcasts them if they turn out small and splits a big group
    otherwise. Only spans and bins cross an exchange of their own.
    """
    rows = df.select(*by, F.col(column).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    ends = [F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    if by:
        spans = rows.groupBy(*by).agg(*ends)
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]
        spanned = rows.alias("r").join(spans.alias("s"), same).select("r.*", F.lit(1).alias("_n"), "_lo", "_hi")
    else:
        span = rows.agg(*ends).select(F.struct("_lo", "_hi")).scalar()
        spanned = rows.select("_x", F.lit(1).alias("_n"), span.alias("_span")).select("_x", "_n", "_span._lo", "_span._hi")
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.floor(F.try_divide(F.col("_x") - F.col("_lo"), width))
    binned = spanned.select(
        *by, "_n", "_lo", width.alias("_w"),
        F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"),
    )
    sums = binned.groupBy(*by, "bin").agg(F.sum("_n").alias("n"), F.min("_lo").alias("_lo"), F.min("_w").alias("_w"))
    return sums.select(
        *by, "bin", "n",
        (F.col("_lo") + F.col("_w") * F.col("bin")).alias("lower"),
        (F.col("_lo") + F.col("_w") * (F.col("bin") + 1)).alias("upper"),
    )
