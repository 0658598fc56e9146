"""Words of whole texts as numpy arrays; small helpers for functions that run inside tasks.

A word is a run of bytes other than the ASCII white space ``\\x20 \\x09-\\x0D``; ``bytes.split()`` cuts exactly
there, and ``bytes.lower()`` changes A-Z only.
"""

from __future__ import annotations

import ctypes
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_ROUNDS = ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(U64, copy=True)
    for shift, factor in _ROUNDS:
        x ^= x >> U64(shift)
        x *= U64(factor)
    x ^= x >> U64(33)
    return x


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null becomes empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


class Words:
    """Words of a batch of texts.

    ``ids`` numbers the words of all texts one after the other, ``starts[i]:starts[i + 1]`` are those of text i,
    ``distinct`` holds the word of each number.
    """

    def __init__(self, texts: Iterable[bytes], lower: bool = False):
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        parts, starts = [], [0]
        for text in texts:
            words = (text.lower() if lower else text).split()
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            starts.append(starts[-1] + len(words))
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.starts = np.array(starts, np.int64)
        number.default_factory = None  # it refers to the dictionary itself, which would stay until Python looks for cycles
        self.distinct = list(number)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each distinct word."""
        digest = xxhash.xxh64_intdigest
        return np.fromiter((digest(w, seed) for w in self.distinct), U64, len(self.distinct))


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of ``size`` words; a shorter text that has words counts as one run."""
    counts, starts = words.counts, words.starts[:-1]
    runs = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    owner = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs - starts, runs)
    short = np.flatnonzero(counts[owner] < size)
    word = words.hashes()
    value = np.full(len(owner), size, U64)
    value[short] = counts[owner[short]].astype(U64)
    for k in range(size):
        step = word[words.ids[np.minimum(at + k, len(words.ids) - 1)]] if len(owner) else value
        step += value
        step += U64(k + 1)
        step = mix(step)
        beyond = short[k >= counts[owner[short]]]
        step[beyond] = value[beyond]
        value = step
    return value, owner


def batches(frames: Iterator[pa.RecordBatch], rows: int = 1 << 14, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``rows`` rows and about ``size`` bytes, so that long texts fit in memory."""
    for frame in frames:
        step = max(1, min(rows, int(frame.num_rows * size / max(frame.nbytes, 1))))
        for at in range(0, frame.num_rows, step):
            yield frame.slice(at, step)
            release()


def release() -> None:
    """Hand freed memory back to the system: a worker keeps its process for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = _libc()
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def _libc():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones themselves, others from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(seen))}
