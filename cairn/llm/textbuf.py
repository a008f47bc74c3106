"""Vectorised helpers over Arrow string columns inside tasks.

A text column of an Arrow batch is one contiguous UTF-8 buffer plus row
offsets. The helpers find words and hash byte ranges with a handful of
numpy passes over that buffer, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # only A-Z change

# bytes that belong to a word: everything but space and \t..\r
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# 0-9, a-z and every byte of a non-ASCII character (apply after LOWER)
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective), so that all bits depend on all bits."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Prefix sums of byte values times powers of a base, modulo 2**64.

    ``ranges(start, end)`` gives the hash of any byte range in constant
    time: equal ranges hash equal wherever they stand. ``values`` replace
    the random value of each byte.
    """

    def __init__(self, data: np.ndarray, values: np.ndarray | None = None):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((_BYTE[data] if values is None else values) * _powers(_BASE, len(data)), out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inv = _powers(_INV, len(self.sums))
        return (self.sums[end] - self.sums[start]) * inv[start]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def fixed_ranges(data: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """``PrefixHash(data).ranges(start, start + size)`` for few ranges."""
    out = np.zeros(len(start), np.uint64)
    for k, power in enumerate(_powers(_BASE, size)):
        out += _BYTE[data[start + k]] * power
    return out


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def map_whole(df: DataFrame, run, added: tuple[StructField, ...] = ()) -> DataFrame:
    """``mapInArrow`` over all columns, whatever their names are: ``run`` gets
    and yields columns in the order of ``df`` (named c0, c1, ...), plus the
    fields ``added`` at the end."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    out = plain.mapInArrow(run, StructType([*plain.schema.fields, *added]))
    return out.toDF(*df.columns, *[f.name for f in added])


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (len + 1) of a string column; null: empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    off = off[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def row_chunks(offsets: np.ndarray, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` each; a longer row is alone."""
    n = len(offsets) - 1
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def chunks_of(col: pa.Array, max_bytes: int = 1 << 20):
    """(first row, bytes, offsets) of successive row ranges of a column."""
    data, off = buffer_of(col)
    for a, b in row_chunks(off, max_bytes):
        yield a, data[off[a] : off[b]], off[a : b + 1] - off[a]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
    """Start and end of every word and the row it stands in."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = kind[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[1:-1]
    before[edges[edges < n]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[(edges > 0) & (edges <= n)] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def shingles(word_hash: np.ndarray, row: np.ndarray, n_rows: int, size: int):
    """Hashes of ``size`` consecutive words of a row and their rows; a row
    with fewer words has one, of all its words."""
    n = len(word_hash)
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    out_h, out_r = [], []
    if n >= size:
        h = np.zeros(n - size + 1, dtype=np.uint64)
        for i in range(size):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + word_hash[i : n - size + 1 + i])
        ok = row[: n - size + 1] == row[size - 1 :]
        out_h.append(h[ok])
        out_r.append(row[: n - size + 1][ok])
    for r in np.flatnonzero((count > 0) & (count < size)):
        h = np.uint64(count[r])
        for w in word_hash[first[r] : first[r] + count[r]]:
            h = mix(np.array([h], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w)[0]
        out_h.append(np.array([h], np.uint64))
        out_r.append(np.array([r]))
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, r = np.concatenate(out_h), np.concatenate(out_r)
    order = np.argsort(r, kind="stable")
    return h[order], r[order]
