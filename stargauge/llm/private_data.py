"""Personal data: fixed patterns, then identifiers found by the contexts they share; DataFrame operations only.

The base finds e-mail addresses, IP addresses, card and phone numbers by pattern and check. They are the *seeds*.
Looser forms (``a (at) b.c``, ``10-0-0-1``, numbers without ``+`` or with a wrong check digit) are *candidates*. The
words around an instance make its lexical patterns: the two words before it, and the word before with the word
after. Pattern and instance score each other in turns over their graph: a pattern is worth the mean score of its
instances, damped while few support it; an instance is worth one minus the product of its patterns' doubts, seeds
always one. What reaches the threshold in one round supports patterns in the next like a seed, so that each round goes
one hop further. Then the patterns that reach the threshold extract: every token in their slot that has the shape of
their kind, in whatever form, becomes a candidate too, and the graph is scored again. Candidates that end above the
threshold are added; base spans always stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import small, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: Runs are entered at their first character (or where the last match ended) and never given back, so that long runs
#: cost one step a character and need no stack.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[(\[](?:at|AT)[)\]] ?[{_LABEL}]++(?: ?(?:\.|[(\[](?:dot|DOT)[)\]]) ?[{_LABEL}]++)++",
    "ip": r"(?<![0-9_:-])[0-9]{1,3}(?:[_:-][0-9]{1,3}){3}(?![0-9_:-])",
    "card": BASE["card"],
    "phone": r"(?<![0-9+.()-])(?<![0-9+.()-] )\(?[0-9]{2,4}\)?(?:[ .-]\(?[0-9]{2,4}\)?){2,4}(?![0-9])",
}
#: Tokens that patterns may extract: runs with nine digits, four numbers, or an at sign, up to a blank or closing mark.
_OPEN, _CLOSE = r"""(?<![^\s("'<\[])""", r"""(?=[.,;:!?)\]"'>]*+(?:\s|$))"""
SHAPE = {
    "email": rf"""{_OPEN}[^\s@()\[\]<>"',;:]++@[^\s@()\[\]<>"',;:!?]*[^\W_]{_CLOSE}""",
    "ip": rf"""{_OPEN}[^\s0-9("'<\[]{{0,8}}+[0-9]{{1,3}}+(?:[^\s0-9]{{1,3}}+[0-9]{{1,3}}+){{3}}{_CLOSE}""",
    "card": rf"""{_OPEN}[^\s0-9("'<\[]{{0,8}}+[0-9](?:[^\s0-9]{{0,3}}+[0-9]){{11,}}+{_CLOSE}""",
    "phone": rf"""{_OPEN}[^\s0-9("'<\[]{{0,8}}+[0-9](?:[^\s0-9]{{0,3}}+[0-9]){{8,}}+{_CLOSE}""",
}
_HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]"}
_LOOSE_HINT = {"email": r"[(\[](?:at|AT)[)\]]", "ip": r"[0-9][_:-][0-9]", "card": _HINT["card"], "phone": r"[0-9]\)?[ .-]\(?[0-9]"}
_SHAPE_HINT = {"email": r"@", "ip": r"[0-9][^\s0-9]{1,3}[0-9]", "card": r"[0-9](?:[^\s0-9]{0,3}[0-9]){11}", "phone": r"[0-9](?:[^\s0-9]{0,3}[0-9]){8}"}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Doubling every second digit from the right, the digits of all sum to a multiple of ten."""
    def worth(digit: Column, place: Column) -> Column:
        d = digit.cast("int")
        return F.when(place % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: F.length(F.regexp_replace(part, "^0+", "")).between(0, 3) & (F.substring(F.regexp_replace(part, "^0+", ""), 1, 4).try_cast("int").isNull() | (F.substring(F.regexp_replace(part, "^0+", ""), 1, 4).try_cast("int") <= 255)))
    count = F.length(_digits(value))
    if kind == "phone":
        return count.between(9, 15)
    return F.when(count.between(12, 19), _luhn(_digits(value))).otherwise(False)


def _shaped(kind: str, value: Column) -> Column:
    """Whether a token can be of the kind in another form: the count of its digits, for addresses the size of its parts."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.filter(F.split(value, "[^0-9]+"), lambda part: part != ""), lambda part: part.cast("int") <= 255)
    return F.length(_digits(value)).between(*((12, 19) if kind == "card" else (9, 15)))


def _places(docs: DataFrame, kind: str, pattern: str, hint: str) -> DataFrame:
    """Every match of a pattern: doc_id, version, kind, start, end (code points), value and the text around it.

    Positions are running sums of the lengths of the matches and of the gaps between them.
    """
    found = docs.where(F.col("text").rlike(hint)).select(
        "doc_id", "version", "row", F.regexp_extract_all("text", F.lit(pattern), 0).alias("values"), F.split("text", pattern, -1).alias("gaps")
    )
    rows = found.where(F.size("values") > 0).select("doc_id", "version", "row", "gaps", F.posexplode("values").alias("n", "value"))
    rows = rows.select(
        "doc_id", "version", "row", "n", "value", F.length(F.get("gaps", F.col("n"))).alias("gap"),
        F.substring(F.get("gaps", F.col("n")), -64, 64).alias("before"), F.substring(F.get("gaps", F.col("n") + 1), 1, 64).alias("after"),
    )
    upto = Window.partitionBy("row").orderBy("n")
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return rows.select("doc_id", "version", F.lit(kind).alias("kind"), (end - F.length("value")).alias("start"), end.alias("end"), "value", "before", "after")


def _patterns(before: Column, after: Column, kind: Column) -> Column:
    """Lexical patterns around an instance; words are lower-case, digits count as one."""
    def plain(text: Column) -> Column:
        return F.regexp_replace(F.lower(text), "[0-9]+", "0")

    left = F.filter(F.split(plain(before), r"\s+"), lambda w: w != "")
    right = F.filter(F.split(plain(after), r"\s+"), lambda w: w != "")
    last, earlier, follow = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2)), F.try_element_at(right, F.lit(1))
    found = F.array(
        F.when(earlier.isNotNull(), F.concat_ws(" ", kind, earlier, last, F.lit("_"))),
        F.when(last.isNotNull() & follow.isNotNull(), F.concat_ws(" ", kind, last, F.lit("_"), follow)),
    )
    return F.filter(found, lambda p: p.isNotNull())


def score_graph(instances: DataFrame, rounds: int = 3, support: int = 8, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``kind, value, score`` of the instances that are no seeds, and ``pattern, worth`` of the patterns.

    ``instances`` has kind, value, seed and patterns, a row for each occurrence. A pattern's score is the mean of its
    distinct instances' scores times ``log(1 + found) / log(1 + support)``, one at most; ``found`` counts its instances
    that have the threshold by then, seeds from the start. Instances up to ``rounds`` hops from a seed can be reached.
    Scores are of kind and value, so there are no ties to break.
    """
    edges = instances.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))
    edges = written(edges.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed")), "pattern-graph")
    score = written(edges.groupBy("kind", "value").agg(F.max(F.col("seed").cast("double")).alias("score")), "instance-scores")
    for k in range(rounds):
        scored = edges.join(score, ["kind", "value"])
        damped = F.least(F.lit(1.0), F.log(1 + F.sum((F.col("score") >= threshold).cast("long"))) / F.log(F.lit(1.0 + support)))
        patterns = scored.groupBy("pattern").agg((F.avg("score") * damped).alias("worth"))
        if k == rounds - 1:
            patterns = written(patterns, "pattern-worth")
        doubts = edges.join(patterns, "pattern").groupBy("kind", "value").agg(
            F.max("seed").alias("seed"), F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("worth"))))).alias("doubt")
        )
        score = written(doubts.select("kind", "value", F.when(F.col("seed"), 1.0).otherwise(1 - F.col("doubt")).alias("score")), "instance-scores")
    seeds = edges.where("seed").select("kind", "value")
    return score.join(seeds, ["kind", "value"], "left_anti"), patterns


def _apart_from(rows: DataFrame, taken: DataFrame, alike: bool = False) -> DataFrame:
    """``rows`` that overlap no span of ``taken`` in the same text, or with ``alike`` none of their own kind."""
    other = taken.select(F.col("doc_id").alias("d"), F.col("version").alias("v"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("k"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")) & (F.col("s") < F.col("end")) & (F.col("start") < F.col("e"))
    return rows.join(other, same & (F.col("kind") == F.col("k")) if alike else same, "left_anti")


def find_private_data(docs: DataFrame, threshold: float = 0.8, rounds: int = 3, support: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base and spans, arrays of (start, place, end, kind) in order of start and kind.

    Null and empty texts have no spans. Rows with equal id and text get equal spans. With no seed nothing is added.
    An empty table gives no row; other columns are not read. ``rounds`` of at least 1 score the graph, twice: with the
    candidates of looser forms, and with what the patterns found by then extract.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    hinted = own.where(F.col("text").rlike(r"[0-9@]|[(\[](?:at|AT)[)\]]"))
    hinted = written(hinted.withColumn("row", F.monotonically_increasing_id()), "texts-with-hints")

    base = reduce(DataFrame.unionByName, [_places(hinted, k, BASE[k], _HINT[k]).withColumn("valid", _valid(k, F.col("value"))) for k in KINDS])
    base = written(base, "base-spans")
    seeds = base.where("valid").drop("valid")
    key = ["doc_id", "version"]
    loose = [_places(hinted, k, LOOSE[k], _LOOSE_HINT[k]) for k in KINDS if k != "card"]
    loose.append(base.where("kind = 'card' AND NOT valid").drop("valid"))  # the same form, with a wrong check digit or length
    shaped = written(reduce(DataFrame.unionByName, [_places(hinted, k, SHAPE[k], _SHAPE_HINT[k]).where(_shaped(k, F.col("value"))) for k in KINDS]), "shaped-tokens")
    loose = written(_apart_from(reduce(DataFrame.unionByName, loose), seeds), "loose-spans")
    shaped = _apart_from(_apart_from(shaped, seeds), loose, alike=True)

    def instances(spans: DataFrame, seed: bool) -> DataFrame:
        patterns = _patterns(F.col("before"), F.col("after"), F.col("kind"))
        return spans.select("kind", F.lower("value").alias("value"), F.lit(seed).alias("seed"), patterns.alias("patterns"))

    known = written(instances(seeds, True).unionByName(instances(loose, False)), "instances")
    _, patterns = score_graph(known, rounds, support, threshold)
    sure = patterns.where(F.col("worth") >= threshold).select(F.col("pattern").alias("sure"))
    slots = shaped.withColumn("pattern", F.explode(_patterns(F.col("before"), F.col("after"), F.col("kind"))))
    slots = slots.join(sure, F.col("pattern") == F.col("sure"), "left_semi").drop("pattern")
    extracted = written(slots, "extracted")  # a row for each sure pattern of a token
    scores, _ = score_graph(known.unionByName(instances(extracted, False)), rounds, support, threshold)
    good = scores.where(F.col("score") >= threshold).select(F.col("kind").alias("of"), F.col("value").alias("known"))
    found = loose.unionByName(extracted)
    added = found.join(good, (F.col("kind") == F.col("of")) & (F.lower("value") == F.col("known")), "left_semi")

    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    rows = seeds.select(*key, "kind", "start", "end", F.lit(True).alias("first")).unionByName(added.select(*key, "kind", "start", "end", F.lit(False).alias("first")))
    span = F.struct("start", place.alias("place"), "end", "kind")
    grouped = written(rows.groupBy(*key).agg(
        F.sort_array(F.collect_set(F.when(F.col("first"), span))).alias("base"), F.sort_array(F.collect_set(span)).alias("spans")
    ), "document-spans")
    named = grouped.select(F.col("doc_id").alias("d"), F.col("version").alias("v"), "base", "spans")
    kind = "array<struct<start: bigint, place: bigint, end: bigint, kind: string>>"
    every = own.select("doc_id", "version")
    n_spans = named.agg(F.sum(1 + F.size("base") + F.size("spans"))).first()[0] or 0
    out = every.join(small(named, n_spans), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left")
    return out.select("doc_id", *[F.coalesce(c, F.array().cast(kind)).cast(kind).alias(c) for c in ("base", "spans")])


def span_report(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans, and all spans as text."""
    def written_out(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written_out("base"), 256).alias("base_sha256"), written_out("spans").alias("spans"))
