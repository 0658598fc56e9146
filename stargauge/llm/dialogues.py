"""Repair of conversations whose turns are lost, emptied, cut, repeated or of the wrong role.

Rows of a conversation are kept (no cost), given another role (3) or deleted (4, required for blank and repeated rows);
empty rows may be inserted anywhere (3); a truncated row that stays costs 3. The roles of the result must read
``(s?(ua)+)?`` by their initials. Sought are the cheapest edits, among equals those whose initials (D, I, K, R) are least
in ASCII order.

The search is a depth-first branch and bound with an explicit stack. A node is a number of rows dealt with and what the
roles so far allow next; suffix lower bounds give the least that the rows left can cost; the incumbent is the best whole
answer (cost, audit); a table holds the best prefix found for each node, and a prefix that does not beat it is dropped.
The stack running empty is the proof of optimality.

A conversation may be of any length. All rows are sorted over all tasks, their order numbers are cut into stretches of
``STRETCH``, and each stretch is searched by itself: once if it holds the whole conversation, else from every state to
every state. Stretches are then put together 64 at a time. Equal costs from and to the same states never have audits of
which one begins with the other, so the least part makes the least whole, and the result does not depend on the cuts.
Only SHA-256, which cannot be split, reads a conversation in one piece: as a stream, holding one row.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

#: Rows that are searched together, as a power of two, and how many stretches are put together at a time.
STRETCH_BITS, FAN_BITS = 8, 6

#: Costs of edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# What the roles so far allow: 0 nothing yet, 1 after s, 2 after u, 3 after a. The result may end in 0 or 3.
_STATES, _ENDS = range(4), (0, 3)
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTED = ("u", "u", "a", "u")
_ROLE = {"u": "user", "a": "assistant"}
_FAR = 1 << 60

#: A row as the search sees it: role initial, must it go, is it truncated.
Row = tuple[str, bool, bool]


def suffix_bounds(rows: list[Row], goals: Iterable[int]) -> list[list[int]]:
    """For each number of rows dealt with and each state, the least cost of what is left."""
    goals = set(goals)
    bounds = [[0 if q in goals else _FAR for q in _STATES]]
    _insertions(bounds[0])
    for initial, forced, truncated in reversed(rows):
        after, stay = bounds[-1], TRUNCATED if truncated else 0
        here = [DELETE + after[q] for q in _STATES]
        if not forced:
            for q in _STATES:
                here[q] = min(here[q], REROLE + stay + after[_AFTER[q, _WANTED[q]]])
                if (q, initial) in _AFTER:
                    here[q] = min(here[q], KEEP + stay + after[_AFTER[q, initial]])
        _insertions(here)
        bounds.append(here)
    return bounds[::-1]


def _insertions(costs: list[int]) -> None:
    for _ in _STATES:
        for q in _STATES:
            costs[q] = min(costs[q], INSERT + costs[_AFTER[q, _WANTED[q]]])


def search(rows: list[Row], entry: int, goals: Iterable[int]) -> tuple[int, str] | None:
    """The least (cost, audit) from the state ``entry`` to one of ``goals``; None if there is no way."""
    goals, n = set(goals), len(rows)
    bounds = suffix_bounds(rows, goals)
    incumbent: tuple[int, str] | None = None
    best: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        done, state, cost, audit = stack.pop()
        bound = cost + bounds[done][state]
        if bound >= _FAR:
            continue
        if incumbent and (bound, audit) > (incumbent[0], incumbent[1][: len(audit)]):
            continue  # costs more however it ends, or as much with a later audit
        known = best.get((done, state))
        if known and known <= (cost, audit):
            continue
        best[done, state] = (cost, audit)
        if done == n and state in goals and (incumbent is None or (cost, audit) < incumbent):
            incumbent = (cost, audit)
        branches = [(INSERT, "I", done, _AFTER[state, _WANTED[state]])]
        if done < n:
            initial, forced, truncated = rows[done]
            stay = TRUNCATED if truncated else 0
            branches.append((DELETE, "D", done + 1, state))
            if not forced:
                branches.append((REROLE + stay, "R", done + 1, _AFTER[state, _WANTED[state]]))
                if (state, initial) in _AFTER:
                    branches.append((KEEP + stay, "K", done + 1, _AFTER[state, initial]))
        stack += [
            (at, to, cost + price, audit + letter)
            for price, letter, at, to in sorted(branches, key=lambda b: (b[0] + bounds[b[2]][b[3]], b[1]), reverse=True)
        ]
    return incumbent


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copy (0, or 1 for an added repetition) after the damage that the key decides.

    Of ``crc32(conv_id:turn) % 20``, 0 drops a row, 1 empties its text, 2 removes full stops, exclamation and question
    marks, 3 repeats it, 4 makes it the user's. A null id or turn reads as one space there and stays null; a null role or
    text becomes one space.
    """
    def spoken(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spoken("conv_id"), F.lit(":"), spoken("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spoken("text"), "[.!?]", "")).otherwise(spoken("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(spoken("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy"),
    )


#: Rows are taken by turn, nulls first; rows of one turn by role, then by the text's first characters and a hash of it.
_ORDER = ["conv_id", "turn", "role", "head", "h0", "h1"]


def _text_key() -> list[Column]:
    return [F.substring("text", 1, 64).alias("head"), F.xxhash64("text").alias("h0"), F.xxhash64(F.lit(1), "text").alias("h1")]


def _order(turns: DataFrame) -> DataFrame:
    """Slim rows with ``at``, which numbers all of them in the order of conversations; texts stay behind."""
    body = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    slim = turns.select(
        *_ORDER[:3], *_text_key(),
        F.substring("role", 1, 1).alias("initial"), (F.length(body) == 0).alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.xxhash64(F.monotonically_increasing_id(), "copy").alias("salt"),  # rows equal in all else may be parted
    )
    placed = written(
        slim.orderBy(*_ORDER, "salt").withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33)),
        "turns",
    )
    parts = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # one a task
    before = [(part, sum(n for _, n in parts[:k]) - (part << 33)) for k, (part, _) in enumerate(parts)]
    offsets = placed.sparkSession.createDataFrame(before, "part long, shift long")
    return placed.join(F.broadcast(offsets), "part").withColumn("at", F.col("place") + F.col("shift")).drop("salt", "place", "part", "shift")


def _with_faults(rows: DataFrame) -> DataFrame:
    """The first fault of each row: a blank one, one of a role and text seen earlier, a truncated one."""
    first = rows.groupBy("conv_id", "role", "h0", "h1").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    seen = rows.join(first, "at", "left")
    repeated = ~F.col("blank") & F.col("first").isNull()
    return seen.withColumn("repeated", repeated).withColumn(
        "truncated", F.col("truncated") & ~F.col("blank") & ~repeated
    ).drop("first")


_COUNTS = ["blank", "repeated", "truncated", "illegal", "turns"]
_PIECE = (
    "conv_id long, stretch long, first long, whole boolean, blank long, repeated long, truncated long, illegal long, turns long, "
    "low long, high long, head string, tail string, ways string"
)
_PIECE_FIELDS = ["conv_id", "stretch", "first", "whole", *_COUNTS, "low", "high", "head", "tail", "ways"]
_PIECE_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("stretch", pa.int64()), ("first", pa.int64()), ("whole", pa.bool_()),
    *[(c, pa.int64()) for c in (*_COUNTS, "low", "high")], ("head", pa.string()), ("tail", pa.string()), ("ways", pa.string()),
])


def _pairs(left: str, right: str) -> bool:
    """Whether two neighbouring role initials are out of order."""
    return left + right not in ("su", "ua", "au")


def _streamed(frames: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for frame in frames:
        for at in range(0, frame.num_rows, 1024):
            yield from frame.slice(at, 1024).to_pylist()


def _runs(rows: Iterator[dict], key: Callable[[dict], tuple]) -> Iterator[list[dict]]:
    """Neighbouring rows of one key; the keys have few rows each."""
    run: list[dict] = []
    for row in rows:
        if run and key(row) != key(run[0]):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _piece(run: list[dict], whole: bool) -> dict:
    """What is known of the rows of one conversation in one stretch."""
    rows = [(r["initial"], r["blank"] or r["repeated"], r["truncated"]) for r in run]
    turns = [r["turn"] for r in run if r["turn"] is not None]
    ways: dict[str, tuple[int, str, str]] = {}
    if whole:
        cost, audit = search(rows, 0, _ENDS)
        ways["0*"] = (cost, audit, "")
    else:
        for entry in _STATES:
            for exit_ in _STATES:
                found = search(rows, entry, [exit_])
                if found:
                    ways[f"{entry}{exit_}"] = (*found, str(exit_))
    return {
        "conv_id": run[0]["conv_id"], "stretch": run[0]["at"] >> STRETCH_BITS, "first": run[0]["at"] >> STRETCH_BITS, "whole": whole,
        **{c: sum(r[c] for r in run) for c in _COUNTS[:3]},
        "illegal": sum(_pairs(a[0], b[0]) for a, b in zip(rows, rows[1:])),
        "turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None),
        "head": rows[0][0], "tail": rows[-1][0], "ways": json.dumps(ways),
    }


def _pieces(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One piece a conversation and stretch, from rows in order whose stretches lie whole in one task."""
    def found() -> Iterator[dict]:
        for stretch in _runs(_streamed(frames), lambda r: (r["at"] >> STRETCH_BITS,)):
            own = list(_runs(iter(stretch), lambda r: (r["conv_id"],)))
            for k, run in enumerate(own):
                yield _piece(run, 0 < k < len(own) - 1)

    return _batched(found(), _PIECE_ARROW)


def _join_pieces(a: dict, b: dict) -> dict:
    left, right = json.loads(a["ways"]), json.loads(b["ways"])
    ways: dict[str, tuple] = {}
    for one, (cost, audit, path) in left.items():
        for two, (more, rest, then) in right.items():
            if one[1] == two[0]:
                key, way = one[0] + two[1], (cost + more, audit + rest, path + then)
                if key not in ways or way[:2] < ways[key][:2]:
                    ways[key] = way
    lows = [x["low"] for x in (a, b) if x["low"] is not None]
    highs = [x["high"] for x in (a, b) if x["high"] is not None]
    shared = a["high"] is not None and a["high"] == b["low"]  # rows come by turn
    return {
        "conv_id": a["conv_id"], "stretch": a["stretch"], "first": a["first"], "whole": False,
        **{c: a[c] + b[c] for c in _COUNTS[:3]},
        "illegal": a["illegal"] + b["illegal"] + _pairs(a["tail"], b["head"]),
        "turns": a["turns"] + b["turns"] - shared, "low": min(lows, default=None), "high": max(highs, default=None),
        "head": a["head"], "tail": b["tail"], "ways": json.dumps(ways),
    }


def _together(shift: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            held = None
            for piece in _streamed(frames):
                same = held and held["conv_id"] == piece["conv_id"] and held["first"] >> shift == piece["first"] >> shift
                if held and not same:
                    yield held
                held = _join_pieces(held, piece) if same else piece
            if held:
                yield held

        return _batched(found(), _PIECE_ARROW, 1)

    return run


_ANSWER = "cost long, audit string, path string"
_ANSWER_ARROW = pa.schema([*[f for f in _PIECE_ARROW if f.name != "ways"], ("cost", pa.int64()), ("audit", pa.string()), ("path", pa.string())])


def _answers(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[dict]:
        for piece in _streamed(frames):
            ways = json.loads(piece.pop("ways"))
            cost, audit, path = min(ways[w] for w in ("0*", "00", "03") if w in ways)
            yield piece | {"cost": cost, "audit": audit, "path": path}

    return _batched(found(), _ANSWER_ARROW, 64)


def solve(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces as searched, one answer a conversation) of numbered rows with their faults."""
    stretch = F.shiftright("at", STRETCH_BITS)
    slim = rows.select("conv_id", "turn", "initial", "blank", "repeated", "truncated", "at")
    dealt = slim.repartition(stretch).sortWithinPartitions("at")
    pieces = written(dealt.mapInArrow(_pieces, _PIECE), "pieces")
    open_ = pieces.where(~F.col("whole"))
    last, shift = pieces.agg(F.max("stretch")).first()[0] or 0, 0
    while last >> shift:
        shift += FAN_BITS
        dealt = open_.repartition("conv_id", F.shiftright("first", shift)).sortWithinPartitions("conv_id", "first")
        open_ = written(dealt.mapInArrow(_together(shift), _PIECE), f"pieces-{shift}")
    fields = _PIECE.replace(", ways string", "")
    answers = pieces.where("whole").unionByName(open_).mapInArrow(_answers, f"{fields}, {_ANSWER}")
    return pieces, written(answers, "answers")


_SLICE_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("head", pa.string()), ("h0", pa.int64()), ("h1", pa.int64()),
    ("at", pa.int64()), ("before", pa.string()), ("as", pa.string()), ("after", pa.string()),
])
_SLICE = "conv_id long, turn long, role string, head string, h0 long, h1 long, at long, before string, `as` string, after string"


def _edits(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each row of a stretch leaves in the result: roles inserted before, its own role (null: none), roles after."""
    def found() -> Iterator[dict]:
        for run in _runs(_streamed(frames), lambda r: (r["at"] >> STRETCH_BITS, r["conv_id"])):
            state, k, before, out = run[0]["entry"], 0, "", []
            for letter in run[0]["slice"]:
                if letter == "I":
                    before += _WANTED[state]
                    state = _AFTER[state, _WANTED[state]]
                    continue
                row, role, initial = run[k], None, None
                if letter != "D":
                    initial = row["initial"] if letter == "K" else _WANTED[state]
                    role = row["role"] if letter == "K" else _ROLE[initial]
                    state = _AFTER[state, initial]
                out.append({c: row[c] for c in (*_ORDER, "at")} | {"before": before, "as": role, "after": ""})
                k, before = k + 1, ""
            out[-1]["after"] = before
            yield from (e for e in out if e["as"] is not None or e["before"] or e["after"])

    return _batched(found(), _SLICE_ARROW)


_LINE = "conv_id long, at long, k long, role string, text string"
_LINE_ARROW = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("k", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _lines(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows. Edits come before the texts of the same key, and at most one of them takes a text, as equal rows
    after the first are repetitions."""
    def made() -> Iterator[dict]:
        waiting: list[dict] = []
        key = None

        def line(edit: dict, k: int, role: str, text: str) -> dict:
            return {"conv_id": edit["conv_id"], "at": edit["at"], "k": k, "role": role, "text": text}

        def given(text: str) -> Iterator[dict]:
            for edit in waiting:
                own = [(_ROLE[i], "") for i in edit["before"]]
                own += [] if edit["as"] is None else [(edit["as"], text)]
                own += [(_ROLE[i], "") for i in edit["after"]]
                yield from (line(edit, k, role, words) for k, (role, words) in enumerate(own))
            waiting.clear()

        for row in _streamed(frames):
            here = tuple(row[c] for c in _ORDER)
            if here != key:
                key = here
                yield from given("")
            if row["at"] is not None:
                waiting.append(row)
            elif waiting:
                yield from given(row["text"])
        yield from given("")

    return _batched(made(), _LINE_ARROW, 256)


def repaired_turns(turns: DataFrame, rows: DataFrame, pieces: DataFrame, answers: DataFrame) -> DataFrame:
    """conv_id, at, k, role, text of the repaired conversations; a conversation's rows come together, by (at, k)."""
    whole = answers.where("whole").select("conv_id", "stretch", F.lit(0).alias("entry"), F.col("audit").alias("slice"))
    split = answers.where(~F.col("whole")).select(
        "conv_id", "first", F.posexplode(F.split("path", "")).alias("n", "exit"), "path"
    ).where(F.col("exit") != "").select(
        "conv_id", (F.col("first") + F.col("n")).alias("stretch"), "exit",
        F.when(F.col("n") == 0, "0").otherwise(F.substring("path", F.col("n"), F.lit(1))).alias("entry"),
    )
    way = F.from_json("ways", "map<string, array<string>>")
    taken = split.alias("s").join(
        pieces.where(~F.col("whole")).select("conv_id", "stretch", "ways").alias("p"),
        F.col("s.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("s.stretch") == F.col("p.stretch")),
    ).select(
        "s.conv_id", "s.stretch", F.col("entry").cast("int").alias("entry"),
        F.element_at(F.element_at(way, F.concat("entry", "exit")), 2).alias("slice"),
    )
    slices = whole.unionByName(taken)
    dealt = rows.withColumn("stretch", F.shiftright("at", STRETCH_BITS)).alias("r").join(
        slices.alias("s"), F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.stretch") == F.col("s.stretch")),
    ).select(*[f"r.{c}" for c in (*_ORDER, "initial", "at")], "s.entry", "s.slice")
    # Dealt anew whatever the join was: after a broadcast a stretch may lie in several tasks.
    edits = dealt.repartition(F.shiftright("at", STRETCH_BITS)).sortWithinPartitions("at").mapInArrow(_edits, _SLICE)
    texts = turns.select(*_ORDER[:3], "text", *_text_key())
    both = edits.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    return both.sortWithinPartitions(*_ORDER, F.col("at").asc_nulls_last()).mapInArrow(_lines, _LINE)


_DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _digests(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made() -> Iterator[dict]:
        conv, digest = None, None
        for row in _streamed(frames):
            if digest is None or row["conv_id"] != conv:
                if digest is not None:
                    yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}
                conv, digest = row["conv_id"], hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{row['role']}:{row['text']}".encode())
        if digest is not None:
            yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}

    return _batched(made(), _DIGEST_ARROW)


def repair_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one answer a conversation, its repaired rows) of ``turns`` with conv_id, turn, role, text.

    Answers hold the counts of faults, ``low``, ``high`` and ``turns`` (least, greatest and distinct turns), ``cost`` and
    ``audit``. Null roles and texts must be filled (``damage`` does); null turns come first, null ids are one conversation.
    """
    rows = written(_with_faults(_order(turns)), "faults")
    pieces, answers = solve(rows)
    return answers, repaired_turns(turns, rows, pieces, answers)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest of every conversation after damage and repair.

    A conversation that lost all its rows has zeros, an empty audit and the hash of nothing. Rows of one turn come by role,
    then by text; repeated rows of the input count as repetitions. Texts of any length are only hashed and streamed;
    columns other than the four are not read; an empty table gives no rows.
    """
    answers, repaired = repair_conversations(damage(conversations))
    digests = repaired.mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    counts = {"blank": "blank", "duplicate": "repeated", "truncated": "truncated", "illegal": "illegal", "cost": "cost"}
    known = answers.select(
        F.col("conv_id").alias("__conv"), gaps.alias("gaps"), *[F.col(c).alias(n) for n, c in counts.items()], "audit"
    )
    ids = conversations.select("conv_id").distinct()
    out = ids.join(known, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").alias("a").join(
        digests.alias("d"), F.col("a.conv_id").eqNullSafe(F.col("d.conv_id")), "left"
    )
    return out.select(
        "a.conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *counts)],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
