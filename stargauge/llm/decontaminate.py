"""Benchmark passages in documents: a prefix-filtered join of shingles with exact verification, DataFrame operations only.

A *window* is ``window`` consecutive words of a benchmark item; a shorter item is one window. A window occurs in a
document only if all its shingles do. So every window is looked up by one shingle alone, its rarest over all
documents (the prefix of a full-containment join has length one), and only occurrences of these shingles become
candidates. The position of the shingle in the window fixes where the window would begin; beginnings before the
first word and ends after the last one are dropped. What is left is compared word by word with the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import BROADCAST_ROWS, small, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Lower-case (A-Z) runs of digits, letters and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def _shingle(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + k) for k in range(size)])


def _windows(items: DataFrame, window: int) -> DataFrame:
    """item, window (its words, joined by a blank) and length; a row for each distinct window of an item."""
    own = items.withColumn("words", plain_words(F.col("text"))).where(F.size("words") > 0)
    own = own.withColumn("length", F.least(F.lit(window), F.size("words")))
    cut = own.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)))
    return cut.select("item", "length", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("window")).distinct()


def find_passages(
    docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, version (xxhash64 of the text), n_words, n_hit (words inside an occurrence) and items
    (sorted item ids as strings).

    Documents without words, and all documents when no item has words, have no hit. Items without words or with a
    null id are never found; items with equal texts are all found. Rows with equal id and text get equal results.
    Other columns are not read. An empty table gives no row.
    """
    bench = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text")).where("item IS NOT NULL")
    pairs = written(_windows(bench, window), "windows")
    windows = pairs.select("window", "length").distinct().withColumn("size", F.least(F.lit(shingle), F.col("length")))
    sizes = [r[0] for r in windows.select("size").distinct().orderBy("size").collect()]  # at most `shingle` numbers

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    split = own.select("doc_id", "version", plain_words(F.col("text")).alias("words"))

    def parts(size: int) -> DataFrame:
        words = windows.where(F.col("size") == size).select("window", "length", F.split("window", " ").alias("words"))
        at = words.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("length") - size)))
        return at.select("window", "length", "offset", _shingle("words", F.col("offset"), size).alias("hash"))

    def matches(size: int, first: bool) -> DataFrame:
        """Positions of the items' shingles; the first call also gives a row at -1 for every document."""
        known = parts(size).select("hash").distinct()
        known = small(known.select(F.col("hash").alias("known")), known.count(), 4 * BROADCAST_ROWS)
        last = F.greatest(F.size("words") - size, F.lit(-1))
        rows = split.select("doc_id", "version", "words", F.explode_outer(F.sequence(F.lit(-1), last)).alias("at"))
        rows = rows.select("doc_id", "version", F.size("words").alias("n_words"), "at", F.when(F.col("at") >= 0, _shingle("words", F.col("at"), size)).alias("hash"))
        found = rows.join(known, F.col("hash") == F.col("known"), "left").where("known IS NOT NULL" + (" OR at = -1" if first else ""))
        return found.select("doc_id", "version", "n_words", "at", F.col("known").alias("hash"))

    all_rows = matches(sizes[0] if sizes else shingle, True)
    for size in sizes[1:]:
        all_rows = all_rows.unionByName(matches(size, False))
    all_rows = written(all_rows, "shingle-matches")
    every, found = all_rows.where("at = -1").select("doc_id", "version", "n_words"), all_rows.where("at >= 0")
    if not sizes:
        return every.select("doc_id", "version", F.col("n_words").cast("long"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))

    pieces = parts(sizes[0])
    for size in sizes[1:]:
        pieces = pieces.unionByName(parts(size))
    rarity = found.groupBy("hash").agg(F.count(F.lit(1)).alias("rows"))
    prefix = pieces.join(rarity, "hash", "left").groupBy("window", "length").agg(
        F.min_by(F.struct("offset", "hash"), F.struct(F.coalesce("rows", F.lit(0)), "hash", "offset")).alias("first")
    )
    prefix = prefix.select("window", "length", "first.offset", "first.hash")
    begin = F.col("at") - F.col("offset")
    candidates = found.join(prefix, "hash").where((begin >= 0) & (begin + F.col("length") <= F.col("n_words")))
    candidates = candidates.select("doc_id", "version", begin.alias("begin"), "length", "window").distinct()
    by_document = written(candidates.groupBy("doc_id", "version").agg(F.collect_list(F.struct("begin", "length", "window")).alias("places")), "candidates")

    same = [F.col("doc_id").eqNullSafe(F.col("d_id")), F.col("version") == F.col("d_version")]
    keys = small(by_document.select(F.col("doc_id").alias("d_id"), F.col("version").alias("d_version")), by_document.count())
    texts = own.join(keys, same, "left_semi").dropDuplicates(["doc_id", "version"])
    named = by_document.select(F.col("doc_id").alias("d_id"), F.col("version").alias("d_version"), "places")
    checked = texts.select("doc_id", "version", plain_words(F.col("text")).alias("words")).join(named, same)
    exact = F.filter("places", lambda p: F.array_join(F.slice("words", p["begin"] + 1, p["length"]), " ") == p["window"])
    occurrences = checked.select("doc_id", "version", exact.alias("places")).where(F.size("places") > 0)
    covered = F.flatten(F.transform("places", lambda p: F.sequence(p["begin"], p["begin"] + p["length"] - 1)))
    occurrences = written(occurrences.select("doc_id", "version", F.size(F.array_distinct(covered)).alias("n_hit"), F.array_distinct(F.transform("places", lambda p: p["window"])).alias("windows")), "occurrences")
    in_items = occurrences.select("doc_id", "version", F.explode("windows").alias("window")).join(pairs.select("window", "item"), "window")
    in_items = in_items.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = occurrences.select(F.col("doc_id").alias("h_id"), F.col("version").alias("h_version"), "n_hit")
    hits = hits.join(in_items, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("version") == F.col("h_version"))).select("h_id", "h_version", "n_hit", "items")
    out = every.join(hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("version") == F.col("h_version")), "left")
    return out.select("doc_id", "version", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no passage of ``items`` occurs; the columns stay as they are."""
    hit = find_passages(docs, items, window, shingle, id_col, text_col).where("n_hit > 0")
    hit = written(hit.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).distinct(), "contaminated")
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__version"))
    return docs.join(small(hit, hit.count()), same, "left_anti")


def passage_report(found: DataFrame) -> DataFrame:
    """Counts and a digest of the found items instead of their list."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
