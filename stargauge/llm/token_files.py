"""Token ids of documents in binary files: one zstandard frame per document under a shared dictionary.

The table folder holds ``dictionary`` (one row: the dictionary and its SHA-256) and ``blocks`` (Parquet rows, each
one block of consecutive documents). A block is a byte string, all numbers little-endian:

====================  =======================================================
magic, version        ``TOKZ``, uint32
dictionary hash       32 bytes, SHA-256
n, width              uint32 documents, uint32 bytes an id (2 or 4)
document ids          n x int64, then n x uint8 (1: the id is null)
lengths               n x uint32, ids of each document
offsets               (n + 1) x uint64, where each document's frame begins
frames                one zstandard frame per document
====================  =======================================================

Blocks carry their first and last id as columns, so a look-up of few documents prunes by Parquet statistics, seeks
by offset and decompresses only the frames it needs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import hash_sample
from .words import batches, byte_letters, record, release

MAGIC, VERSION = b"TOKZ", 1
_HEAD = "<4sI32sII"
#: Documents, and bytes of text about, that a task encodes at a time: their words are Python objects of eight times that size.
_ROWS, _STEP = 512, 1 << 20

_ENCODED = pa.schema([("shard", pa.int32()), ("id", pa.int64()), ("tie", pa.int64()), ("n", pa.int64()), ("frame", pa.binary())])
_BLOCK = pa.schema([
    ("shard", pa.int32()), ("block", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()),
    ("ids_before", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary()),
])
_DIGEST = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
_IDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64()))])
_DDL = {
    "encoded": "shard int, id long, tie long, n long, frame binary",
    "block": "shard int, block long, first_id long, last_id long, ids_before long, n_ids long, data binary",
    "digest": "doc_id long, start long, n_tokens long, ids_crc32 long",
    "ids": "doc_id long, start long, n_tokens long, ids array<long>",
}


#: The normalizer and the word pattern under which a lower-case run of letters is one token of the model.
_LOWERING = ["NFC", "Replace", "Lowercase"]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What that pattern cuts runs into that hold only these characters; "'" may begin a word and "<" a special token.
_PIECES = "[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=-@[-`{-~]+"


class _Runs(dict):
    """Ids of the runs met lately. When full, all become ``old``, and what is met again comes back; ``missed`` lists the others."""

    def __init__(self, old: dict[bytes, bytes]):
        super().__init__()
        self.old, self.missed = old, set()

    def __missing__(self, run: bytes) -> bytes | None:
        ids = self.old.get(run)
        if ids is None:
            self.missed.add(run)
        else:
            self[run] = ids
        return ids


class _Encoder:
    """Ids of texts. The tokenizer drops white space and joins nothing across it, so each distinct run between
    ASCII white space is encoded once and remembered, up to about ``limit`` runs.

    Where the tokenizer lower-cases and takes letters as words, A-Z are lowered and a full stop, comma or
    exclamation mark that ends a run is cut off first, which leaves fewer distinct runs; and runs of plain lower-case
    letters, digits and marks, which no normalizing changes, go piece by piece to the merges of the model directly.
    """

    def __init__(self, data: str, end_id: int, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.limit = Tokenizer.from_str(data), np.uint32(end_id).tobytes(), limit
        self.known = _Runs({})
        config = json.loads(data)
        steps, cuts = ((config.get(k) or {}) for k in ("normalizer", "pre_tokenizer"))
        first, *rest = cuts.get("pretokenizers", [{}])
        self.plain = (
            [x["type"] for x in steps.get("normalizers", [])] == _LOWERING
            and (first.get("pattern") or {}).get("Regex") == _WORD_PATTERN
            and [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in rest] == [("ByteLevel", False, False)]
        )
        self.letters = byte_letters()

    def _ids(self, new: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
        merge, pieces, letters = self.tokenizer.model.tokenize, re.compile(_PIECES).findall, self.letters
        rest = []
        for run in new:
            text = run.decode()
            if not self.plain:
                rest.append(run)
            elif text.isascii() and text.isalpha() and text.islower():  # a-z stand for their own bytes
                yield run, array("I", [t.id for t in merge(text)]).tobytes()
            else:
                parts = pieces(text)
                if sum(map(len, parts)) != len(text):
                    rest.append(run)
                    continue
                ids = array("I")
                for part in parts:
                    ids.extend([t.id for t in merge(part if part.isascii() else part.encode().decode("latin-1").translate(letters))])
                yield run, ids.tobytes()
        encoded = self.tokenizer.encode_batch_fast([run.decode() for run in rest], add_special_tokens=False)
        yield from ((run, array("I", e.ids).tobytes()) for run, e in zip(rest, encoded, strict=True))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if self.plain:
            apart = re.compile(rb"([.,!])(?:(?<=[a-z0-9].)|(?<=\xc3[\x9f-\xb6\xb8-\xbf].))(?=[ \n])").sub  # a mark first: the search skips to marks
            texts = [apart(rb" \1", t if b"<|" in t else t.lower()) for t in texts]  # <|: names of special tokens stay
        split = [text.split() for text in texts]
        runs = list(chain.from_iterable(split))
        found = list(map(self.known.__getitem__, runs))
        missed, self.known.missed = self.known.missed, set()
        if len(self.known) + len(missed) > self.limit // 2:
            self.known = _Runs(dict(self.known))
        known = self.known
        known.update(self._ids(missed))
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = known[runs[k]]
        ends = list(accumulate(map(len, split), initial=0))
        return [b"".join(found[a:b]) + self.end for a, b in zip(ends, ends[1:])]

    def trim(self) -> None:
        """Between tasks, remember half of the limit, the runs met last first."""
        self.known = _Runs(dict(islice(chain(self.known.items(), self.known.old.items()), self.limit // 2)))


@lru_cache(maxsize=1)
def _encoder(data: str, end_id: int) -> _Encoder:
    """One per Python worker, so that what it remembers serves the worker's next task."""
    return _Encoder(data, end_id)


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _frames(frames: Iterator[pa.RecordBatch], encoder: _Encoder, press: zstandard.ZstdCompressor, bounds: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Of ids and texts: the shard, the length and the compressed token ids of each document."""
    for frame in batches(frames, _ROWS, _STEP):
        ids = frame.column(0)
        texts = [b"" if t is None else t for t in frame.column(1).cast(pa.binary()).to_pylist()]
        lists = encoder(texts)
        shard = np.searchsorted(bounds, np.array(ids.fill_null(0)), side="right")
        shard[np.array(ids.is_null())] = 0
        yield record(
            _ENCODED, shard.astype(np.int32), ids, [xxhash.xxh64_intdigest(x) - (1 << 63) for x in lists],
            [len(x) // 4 for x in lists], [press.compress(_narrow(x, width)) for x in lists],
        )


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; from too few samples, their bytes themselves as raw content (possibly none)."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    level: int = 3,
    dictionary_bytes: int = 1 << 16,
    sample_docs: int = 500,
    sample_bytes: int = 16_384,
    docs_per_shard: int = 4096,
    max_shards: int = 10_000,
    block_bytes: int = 1 << 20,
) -> None:
    """Encode every text, append ``end_id`` and write the files in ascending id order.

    ``tokenizer`` is the JSON of a tokenizer whose pre-tokenizer drops white space. The dictionary is trained on
    the id arrays of about ``sample_docs`` documents, chosen by hash, at most ``sample_bytes`` of each; it changes the size of the files, never their content. Documents are dealt to ranges of the id, at most
    ``max_shards``; frames, not texts, cross the exchange, and blocks are cut while a range is streamed.

    Null texts count as empty (the end id alone). Null ids come first. Rows with equal ids are ordered by a hash of
    their token ids. An empty table writes no block. Other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    rows = own.select(F.count(F.lit(1)), F.count("id")).first()
    shards = max(1, min(max_shards, -(-rows[0] // docs_per_shard)))
    cuts: list[int] = []
    if shards > 1 and rows[1]:
        places = [k / shards for k in range(1, shards)]
        cuts = sorted(set(own.select(F.percentile_approx("id", places, max(10_000, 20 * shards))).first()[0]))
    chosen = hash_sample(own, rows[0], sample_docs, "id", "text").select(F.substring("text", 1, 4 * sample_bytes)).collect()
    sample = sorted(r[0] or "" for r in chosen)
    encode = _Encoder(tokenizer, end_id)
    chosen = [_narrow(ids, width)[:sample_bytes] for ids in encode([t.encode() for t in sample])]
    dictionary = train_dictionary(chosen, dictionary_bytes)
    sha = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(bytearray(dictionary), sha.hex())], "dictionary binary, sha256 string").coalesce(1).write.parquet(f"{path}/dictionary")

    common = spark.sparkContext.broadcast((tokenizer, dictionary, np.array(cuts, np.int64)))  # a vocabulary, 64 KB, <= max_shards numbers

    def encoded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, packed, bounds = common.value
        encoder = _encoder(data, end_id)
        press = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(packed), write_content_size=True)
        yield from _frames(frames, encoder, press, bounds, width)
        encoder.trim()
        release()

    def blocks(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before, held, size = None, 0, 0, [], 0

        def cut():
            ids = [x[1] for x in held]
            index = (
                np.array([x or 0 for x in ids], "<i8").tobytes() + np.array([x is None for x in ids], "u1").tobytes()
                + np.array([x[2] for x in held], "<u4").tobytes()
                + np.cumsum([0, *(len(x[3]) for x in held)]).astype("<u8").tobytes()
            )
            data = struct.pack(_HEAD, MAGIC, VERSION, sha, len(held), width) + index + b"".join(x[3] for x in held)
            known = [x for x in ids if x is not None]
            return record(_BLOCK, [shard], [block], known[:1] or [None], known[-1:] or [None], [before], [sum(x[2] for x in held)], [data])

        for frame in frames:
            for row in zip(*(frame.column(c).to_pylist() for c in ("shard", "id", "n", "frame")), strict=True):
                if held and (row[0] != shard or size >= block_bytes):
                    yield cut()
                    before, block = before + sum(x[2] for x in held), block + 1
                    held, size = [], 0
                if row[0] != shard:
                    shard, block, before = row[0], 0, 0
                held.append(row)
                size += len(row[3])
        if held:
            yield cut()

    frames = own.mapInArrow(encoded, _DDL["encoded"])
    ordered = frames.repartition(shards, "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "tie")
    ordered.mapInArrow(blocks, _DDL["block"]).write.option("compression", "none").parquet(f"{path}/blocks")


def _open(data: bytes, sha: bytes):
    """Index of a block: ids, null flags, lengths, offsets, frames, width."""
    magic, version, own, n, width = struct.unpack_from(_HEAD, data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of token ids")
    if own != sha:
        raise ValueError("the block was written under another dictionary")
    at, out = struct.calcsize(_HEAD), []
    for kind, count in (("<i8", n), ("u1", n), ("<u4", n), ("<u8", n + 1)):
        out.append(np.frombuffer(data, kind, count, at))
        at += np.dtype(kind).itemsize * count
    return (*out, memoryview(data)[at:], width)


def _load(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, bytes]:
    found = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, sha = bytes(found["dictionary"]), bytes.fromhex(found["sha256"])
    if hashlib.sha256(dictionary).digest() != sha:
        raise ValueError("the dictionary does not have the hash it was stored with")
    return spark.read.schema(_DDL["block"]).parquet(f"{path}/blocks"), dictionary, sha


def read_token_files(spark: SparkSession, path: str, digest: bool = False, ids: Iterable[int] | None = None) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens and the ids.

    ``digest`` gives the unsigned CRC-32 of the ids as little-endian uint32 instead of the ids. ``ids`` reads only
    the frames of these documents, from blocks whose id range holds one of them.
    """
    blocks, dictionary, sha = _load(spark, path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # <= max_shards rows
    starts = dict(zip((r["shard"] for r in totals), np.cumsum([0, *(r["n"] for r in totals)])[:-1].tolist(), strict=True))
    wanted = None if ids is None else sorted({int(x) for x in ids})
    if wanted is not None:
        inside = [(F.col("first_id") <= x) & (F.col("last_id") >= x) for x in wanted]
        chosen = F.lit(False)
        for one in inside:
            chosen = chosen | one
        blocks = blocks.where(chosen)
    common = spark.sparkContext.broadcast((dictionary, starts))

    def decoded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, first = common.value
        press = zstandard.ZstdDecompressor(dict_data=_dictionary(packed))
        for frame in frames:
            for shard, before, data in zip(*(frame.column(c).to_pylist() for c in ("shard", "ids_before", "data")), strict=True):
                doc, null, lengths, offsets, body, width = _open(data, sha)
                begin = first[shard] + before + np.cumsum(lengths, dtype=np.int64) - lengths
                keep = np.arange(len(doc)) if wanted is None else np.flatnonzero(np.isin(doc, wanted) & (null == 0))
                lists = [
                    np.frombuffer(press.decompress(body[offsets[k]: offsets[k + 1]]), "<u2" if width == 2 else "<u4").astype("<u4") for k in keep
                ]
                if any(len(x) != lengths[k] for x, k in zip(lists, keep, strict=True)):
                    raise ValueError("a frame has another length than the index says")
                out = [zlib.crc32(x.tobytes()) for x in lists] if digest else lists
                yield record(_DIGEST if digest else _IDS, pa.array(doc[keep], pa.int64(), mask=null[keep] == 1), begin[keep], lengths[keep].astype(np.int64), out)

    columns = "doc_id, start, n_tokens, " + ("ids_crc32" if digest else "ids")
    return blocks.select("shard", "ids_before", "data").mapInArrow(decoded, _DDL["digest" if digest else "ids"]).select(*columns.split(", "))
