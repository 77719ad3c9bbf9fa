"""Whole texts as numpy arrays: slices of bounded size, words, and their 64-bit names.

A word is a maximal run of bytes other than 0x20 and 0x09 to 0x0D. Names are hashes of content only, so
equal words, pairs and windows get the same name on every executor without any exchange. They are made
from 8 bytes at a time, each step mixing all bits, and have no algebraic structure that other texts
could share. Names find candidates; what is removed or reused is decided on the words themselves.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

U = np.uint64
#: Bytes of text that are turned into arrays at a time; a longer text is taken in parts.
SLICE = 1_000_000
#: Most bytes of rows that go to Python at a time (a longer row goes alone), and the setting that says so.
BATCH = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of a followed by b."""
    return mix(mix(a ^ U(0x9E3779B97F4A7C15)) + b * U(0xD6E8FEB86659FD93))


def windows(name: np.ndarray, n: int) -> np.ndarray:
    """Names of name[i : i + n] for every i that has so many, from those of 1, 2, 4, .. in a row."""
    m, out, done, width, level = max(len(name) - n + 1, 0), None, 0, 1, name
    while m:
        if n & width:
            out = level[:m] if out is None else combine(out, level[done : done + m])
            done += width
        if done == n:
            return out
        level, width = combine(level[:-width], level[width:]), 2 * width
    return name[:0]


def word_names(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of the words data[at:end]."""
    size = end - at
    out = mix(size.astype(U) + U(0xA24BAED4963EE407))
    eight = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    live = np.flatnonzero(size <= LONG_WORD)
    step = 0
    while len(live):
        left = size[live] - step
        out[live] = combine(out[live], eight[at[live] + step] & _LOW[np.minimum(left, 8)])
        step += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[at[i] : end[i]].data, digest_size=8).digest(), "little")
    return out


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets): runs of rows of about limit bytes; null reads as empty."""
    texts = pc.fill_null(
        texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, ""
    ).cast(pa.large_string())
    if not len(texts):
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


class Words:
    """The words of a slice: names, byte positions, and per document the span [first[d], first[d + 1])."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n = len(data)
        solid = ~_SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        edge = off[:-1][off[:-1] < n]
        begins[edge] = solid[edge]
        at = np.flatnonzero(begins)
        stop = solid.copy()
        stop[:-1] &= ~solid[1:]
        edge = off[1:][(off[1:] > 0)] - 1
        stop[edge] = solid[edge]
        self.at, self.end = at, np.flatnonzero(stop) + 1
        self.first = np.searchsorted(at, off)
        self.count = np.diff(self.first)
        self.data, self.solid = data, solid

    def __len__(self) -> int:
        return len(self.at)

    @cached_property
    def name(self) -> np.ndarray:
        return word_names(self.data, self.at, self.end)

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """All words, a space after each, and where each begins (and the last ends): words [i, j) joined by
        one space are flat[begin[i] : begin[j] - 1]."""
        begin = np.concatenate([[0], np.cumsum(self.end - self.at + 1)])
        letter = np.ones(int(begin[-1]), bool)
        letter[begin[1:] - 1] = False
        out = np.full(len(letter), 0x20, np.uint8)
        out[letter] = self.data[self.solid]
        return out, begin


def units(texts: pa.Array, overlap: int = 0, limit: int = SLICE) -> Iterator[tuple[int, int, int, Words, bool]]:
    """(first row, end row, words before, words, whether the last of its rows): slices of whole texts, and
    the parts of texts that are longer than two slices. A part begins `overlap` words before the end of the
    part before it, so that every run of overlap + 1 words is in one part."""
    for a, b, data, off in slices(texts, limit):
        if b - a > 1 or len(data) <= 2 * limit:
            yield a, b, 0, Words(data, off), True
            continue
        start, base, size = 0, 0, limit
        while True:
            end = min(start + size, len(data))
            while end < len(data):
                gap = np.flatnonzero(_SPACE[data[end : end + 4096]])
                end = end + int(gap[0]) if len(gap) else min(end + 4096, len(data))
                if len(gap):
                    break
            words = Words(data[start:end], np.array([0, end - start]))
            if end < len(data) and len(words) <= overlap:
                size *= 2
                continue
            yield a, b, base, words, end == len(data)
            if end == len(data):
                break
            new = len(words) - overlap
            base, size = base + new, limit
            start = start + int(words.at[new]) if overlap else end


def replaced(columns: list[str], out: tuple[str, ...]) -> list[str]:
    """Of a table's columns those whose names no output has; an output takes the place of the others.
    Names differ as Spark tells them apart, not by case."""
    taken = {c.lower() for c in out}
    return [c for c in columns if c.lower() not in taken]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _release() -> None:
    """Give freed memory back: workers live on, and what they hold counts against the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow, with at most BATCH bytes sent to Python at a time (by default batches are counted
    in rows, and their memory grows with the texts) and memory given back when a task ends. The bound is
    a setting of df's session; a lower one stays."""
    spark = df.sparkSession
    held = spark.conf.get(_BATCH_KEY).lower().rstrip("b")
    if not held.isdigit() or int(held) > BATCH:
        spark.conf.set(_BATCH_KEY, BATCH)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _release()

    return df.mapInArrow(tidy, schema)
