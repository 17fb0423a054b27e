"""Vectorised text helpers used inside tasks: byte views of Arrow string
columns, word boundaries and 64-bit rolling hashes.

A word is ``[^\\x20\\x09-\\x0D]+``; separators are ASCII, so words can be cut
on the UTF-8 bytes.  Everything works on chunks of bounded bytes (one whole
document at least), so memory does not follow the Arrow batch size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CHUNK_BYTES = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)          # odd multiplier of the rolling hash
_rng = np.random.default_rng(20240110)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_SEP = np.zeros(256, bool)
_SEP[[0x20, 9, 10, 11, 12, 13]] = True
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the multiplier and of its inverse modulo 2**64."""
    global _pow, _inv
    if len(_pow) < n:
        m = max(n, 2 * len(_pow))
        _pow = np.full(m, _MUL, np.uint64)
        _pow[0] = 1
        _pow = np.cumprod(_pow, dtype=np.uint64)
        _inv = np.full(m, np.uint64(pow(int(_MUL), -1, 1 << 64)), np.uint64)
        _inv[0] = 1
        _inv = np.cumprod(_inv, dtype=np.uint64)
    return _pow[:n], _inv[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_chunks(col: pa.Array, limit: int = CHUNK_BYTES):
    """Yield ``(first_row, bytes, offsets)`` pieces of a string column: ``bytes``
    is a uint8 view, ``offsets`` (rows + 1) delimit its rows; null counts as ''."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"") if not pa.types.is_large_binary(col.type) else col.fill_null(b"")
    n = len(col)
    if n == 0:
        return
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word start and end byte positions, and the words' first index per row (rows + 1)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = ~_SEP[data]
    start = w.copy()
    start[1:] &= ~w[:-1]
    end = w.copy()
    end[:-1] &= ~w[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    start[cut] |= w[cut]
    end[cut - 1] |= w[cut - 1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, off)


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums S with hash(data[a:b]) = (S[b] - S[a]) * inverse**a."""
    p, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * p[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [a, b), length included."""
    _, inv = powers(len(prefix))
    return mix64((prefix[b] - prefix[a]) * inv[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) and the first word index per row (rows + 1)."""
    s, e, first = word_bounds(data, off)
    return span_hash(prefix_hash(data, lower=True), s, e), first


def word_counts(col: pa.Array) -> np.ndarray:
    """Words per row; null has none."""
    out = np.zeros(len(col), np.int64)
    for i, data, off in string_chunks(col):
        out[i:i + len(off) - 1] = np.diff(word_bounds(data, off)[2])
    return out


_SEATS = mix64(np.arange(1, 65, dtype=np.uint64) * _MUL) | np.uint64(1)


def sequence_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of ``k`` consecutive entries (len - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        out += words[j:j + n] * _SEATS[j]
    return mix64(out)


def shingle_sets(col: pa.Array, k: int = 5):
    """Yield ``(row, sorted distinct uint64 shingles)``; a text of fewer than k
    words has its whole sequence as one shingle, a text without words none."""
    for i, data, off in string_chunks(col):
        words, first = word_hashes(data, off)
        runs = sequence_hash(words, k)
        for r in range(len(off) - 1):
            a, b = first[r], first[r + 1]
            if b - a >= k:
                yield i + r, np.unique(runs[a:b - k + 1])
            elif b > a:
                yield i + r, sequence_hash(words[a:b], int(b - a))
            else:
                yield i + r, np.zeros(0, np.uint64)


def packed_texts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with its (non-null) text column replaced by ``size`` (bytes) and ``packed``
    (zstd): texts that must be shuffled take less disk and network that way."""
    keep = [c for c in df.columns if c != text_col]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("binary").alias("raw"))

    def pack(batches):
        for b in batches:
            raws = b.column(len(keep)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([len(r) for r in raws], pa.int64()),
                 pa.array([pa.compress(r, "zstd", asbytes=True) if r else b"" for r in raws], pa.binary())], names=[*b.schema.names[:-1], "size", "packed"])

    return rows.mapInArrow(pack, rows.drop("raw").schema.add("size", "long").add("packed", "binary"))


def unpack(size: int, data: bytes) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True) if size else b""
