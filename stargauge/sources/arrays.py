"""JSON array files read by many tasks.

Spark's JSON reader gives a file that holds one array to a single task. Here the text reader, which splits files at
byte ranges, cuts the text at each ``}``. Whether such a brace ends a top-level object depends on what precedes it, so
the files are read twice. First every block of a file reports what it does to the state (inside a string or not, depth
of braces) for either state it may begin in; running figures over one row a block give the state each does begin in.
Then every block puts its objects together. Only the ends of objects that cross a border of blocks are exchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPE = re.compile(rb"\\[\s\S]")
_BETWEEN = " \t\r\n,[]"  # what may stand between the objects of an array
_BLANKS = _BETWEEN.encode()
_EFFECTS = ["file", "start", "date", "size", "bytes", "turns", "change_out", "floor_out", "change_in", "floor_in", "opens", "closes", "loose"]
_PARTS = ["file", "start", "part", "date", "text"]
_WHOLE, _END, _BEGINNING, _MIDDLE = 0, 1, 2, 3


def _braces(piece: bytes) -> tuple[int, int, int]:
    """Quotes of a piece, and its opening braces outside strings if it begins outside one, or else inside one."""
    bare = _ESCAPE.sub(b"", piece) if b"\\" in piece else piece
    if b'"' not in bare:
        return 0, bare.count(b"{"), 0
    parts = bare.split(b'"')
    return len(parts) - 1, sum(p.count(b"{") for p in parts[::2]), sum(p.count(b"{") for p in parts[1::2])


class _Effect:
    """What a block does: a depth d at its start becomes max(d + change, floor), for either string state."""

    def __init__(self, file: str, start: int, date: str | None, size: int, first: bytes):
        self.block = (file, start, date, size)
        self.opens = start == 0 and first.lstrip().startswith(b"[")
        self.bytes, self.quotes, self.last = 0, 0, b""
        self.change, self.floor = [0, 0], [0, 0]

    def add(self, piece: bytes) -> None:
        quotes, *opened = _braces(piece)
        for began in (0, 1):
            before = (self.quotes + began) % 2
            change = opened[before] - (0 if (before + quotes) % 2 else 1)
            self.change[began] += change
            self.floor[began] = max(self.floor[began] + change, 0)
        self.quotes += quotes
        self.bytes += len(piece) + 1
        self.last = piece

    def row(self) -> tuple:
        return (
            *self.block, self.bytes, self.quotes % 2, self.change[0], self.floor[0], self.change[1], self.floor[1],
            self.opens, self.last.rstrip().endswith(b"]"), bool(self.last.strip(_BLANKS)),
        )


def _effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    effect = None
    for batch in batches:
        done = []
        for piece, file, start, date, size in batch.itertuples(index=False, name=None):
            if effect is None or effect.block[:2] != (file, start):
                if effect:
                    done.append(effect.row())
                effect = _Effect(file, start, date, size, piece)
            effect.add(piece)
        if done:
            yield pd.DataFrame(done, columns=_EFFECTS)
    if effect:
        yield pd.DataFrame([effect.row()], columns=_EFFECTS)


class _Objects:
    """Puts the objects of one block together."""

    def __init__(self, file: str, start: int, date: str | None, depth: float, inside: float, cut: bool | None):
        if start > 0 and pd.isna(depth):
            raise RuntimeError("files were split differently in the two passes; set spark.sql.files.minPartitionNum")
        self.file, self.start, self.date = file, start, date
        self.depth, self.inside = (int(depth), int(inside)) if start > 0 else (0, 0)
        self.cut = cut is True
        self.crossing = self.depth > 0 or self.inside == 1
        self.held: list[bytes] = []
        self.ready: list[list] = []

    def add(self, piece: bytes) -> None:
        quotes, *opened = _braces(piece)
        self.depth += opened[self.inside]
        self.inside = (self.inside + quotes) % 2
        self.held.append(piece)
        if self.inside:
            return
        self.depth -= 1
        if self.depth > 0:
            return
        text = b"}".join(self.held)
        if self.depth == 0:
            text += b"}"
        self.depth = 0  # below 0: a brace that closes nothing, or the end of the file
        if text.strip(_BLANKS):
            self.ready.append([self.file, self.start, _END if self.crossing else _WHOLE, self.date, text])
        self.held, self.crossing = [], False

    def taken(self, final: bool = False) -> list[list]:
        """What is complete; the last object of a file cut short waits for the end, where its brace is taken away."""
        if final:
            if self.held:
                part = _MIDDLE if self.crossing else _BEGINNING
                self.ready.append([self.file, self.start, part, self.date, b"}".join(self.held) + b"}"])
            elif self.cut and self.ready:
                self.ready[-1][-1] = self.ready[-1][-1].removesuffix(b"}")
        keep = 1 if self.cut and not final else 0
        out, self.ready = self.ready[: len(self.ready) - keep], self.ready[len(self.ready) - keep:]
        return out


def _objects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    block = None
    for batch in batches:
        done = []
        for piece, *place in batch.itertuples(index=False, name=None):
            if block is None or (block.file, block.start) != (place[0], place[1]):
                if block:
                    done += block.taken(final=True)
                block = _Objects(*place)
            block.add(piece)
        done += block.taken() if block else []
        if done:
            yield pd.DataFrame(done, columns=_PARTS)
    if block:
        rest = block.taken(final=True)
        if rest:
            yield pd.DataFrame(rest, columns=_PARTS)


def array_objects(spark: SparkSession, path: str, date: int | None = None) -> DataFrame:
    """(date, text): every top-level object of the array files below ``path``, files split over tasks.

    The files hold an array of objects, a single object or objects one after another, in ``date=`` folders, and are
    not compressed. Text that is not part of an object is returned too, as is an object that the end of its file cuts
    short; ``[`` stands for an array that is never closed. A JSON parser refuses all three, and nothing else of the
    file. An empty file has no row. Strings may hold braces, quotes and any characters; an object may span blocks.
    Blocks other than the first of their file, and files cut short, have a row in the state that is broadcast:
    some 200 bytes for each ``spark.sql.files.maxPartitionBytes`` read.
    """
    text = spark.read.option("lineSep", "}").text(path)
    if date is not None:
        text = text.where(F.col("date") == date)
    place = F.col("_metadata")
    pieces = text.select(
        F.col("value").cast("binary").alias("piece"), place["file_path"].alias("file"), place["file_block_start"].alias("start"),
        F.col("date").cast("string").alias("date"), place["file_size"].alias("size"),
    )
    effects = pieces.mapInPandas(
        _effects,
        "file string, start long, date string, size long, bytes long, turns int, change_out long, floor_out long, "
        "change_in long, floor_in long, opens boolean, closes boolean, loose boolean",
    )
    of_file = Window.partitionBy("file")
    upto = of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    before = of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # Depth after a block: the sum of changes, raised by the most that a floor before lay above the sum at that point.
    effects = (
        effects.withColumn("inside", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2)
        .withColumn("change", F.when(F.col("inside") == 1, F.col("change_in")).otherwise(F.col("change_out")))
        .withColumn("floor", F.when(F.col("inside") == 1, F.col("floor_in")).otherwise(F.col("floor_out")))
        .withColumn("sum", F.sum("change").over(upto))
        .withColumn("raised", F.greatest(F.lit(0), F.max(F.col("floor") - F.col("sum")).over(before)))
        .withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)) + F.coalesce("raised", F.lit(0)))
        .withColumn("open_end", ~(F.col("size") - F.sum("bytes").over(of_file)).isin(0, 3))  # 3: a byte order mark
        .withColumn("last", F.col("start") == F.max("start").over(of_file))
        .withColumn("cut", F.col("last") & F.col("open_end") & F.col("loose"))
        .withColumn("array", F.max("opens").over(of_file))
    )
    state = effects.where((F.col("start") > 0) | F.col("cut")).select("file", "start", "depth", "inside", "cut")
    unclosed = effects.where(F.col("last") & F.col("array") & ~(F.col("open_end") & F.col("closes")))
    placed = pieces.drop("size").join(F.broadcast(state), ["file", "start"], "left")  # streams the pieces in order
    parts = placed.select("piece", "file", "start", "date", "depth", "inside", "cut").mapInPandas(
        _objects, "file string, start long, part int, date string, text binary"
    ).withColumn("text", F.col("text").cast("string"))
    order = of_file.orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    crossing = (
        parts.where(F.col("part") != _WHOLE)
        .withColumn("begun", F.last(F.when(F.col("part") == _BEGINNING, F.col("start")), ignorenulls=True).over(order))
        .groupBy("file", "begun", "date")
        .agg(F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("ends"))
        .select("date", F.array_join(F.transform("ends", lambda e: e["text"]), "").alias("text"))
    )
    whole = parts.where(F.col("part") == _WHOLE).select("date", "text")
    found = whole.unionByName(crossing).select("date", F.ltrim("text", F.lit(_BETWEEN)).alias("text"))
    return found.unionByName(unclosed.select("date", F.lit("[").alias("text")))
