"""Vectorised word hashing of Arrow text columns (numpy, inside Spark tasks).

Words are ``[^\\x20\\x09-\\x0D]+``. Each word's bytes get a 64-bit polynomial
hash taken from one running sum over the whole block of texts, so no Python
code runs per word. Texts are handled in blocks of bounded size; one text
larger than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C13          # odd, and one less is twice an odd number
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(n, dtype=np.uint64)
    have, step = 1, base
    while have < n:
        k = min(have, n - have)
        out[have:have + k] = out[:k] * _U(step)
        step = step * step % 2**64
        have += k
    return out


_TABLES: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    """Powers up to ``n``; only those of the usual block size are kept."""
    if n > BLOCK_BYTES + 1:
        return _powers(base, n)
    if name not in _TABLES:
        _TABLES[name] = _powers(base, BLOCK_BYTES + 1)
    return _TABLES[name]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows of a
    string column; a block holds ``limit`` bytes at most or one longer row.
    A null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    buffers = column.buffers()
    if len(column) == 0:
        return
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends and, per text, the index of its first word
    (one more entry than texts)."""
    n = len(data)
    inside = np.zeros(n + 1, dtype=bool)
    np.logical_not(_SPACE[data], out=inside[:n])
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1]
    edges = offsets[1:-1]
    edges = edges[edges < n]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    closes = inside[:n] & ~inside[1:]
    inner = edges[edges > 0]
    closes[inner - 1] = inside[inner - 1]
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``fold`` lower-cases A-Z first."""
    n = len(data)
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    values = _BYTE_VALUE[_LOWER] if fold else _BYTE_VALUE
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values[data] * _power_table("base", _BASE, n)[:n], out=total[1:])
    raw = (total[ends] - total[starts]) * _power_table("inverse", _BASE_INVERSE, n)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive word hashes of the block
    (runs that cross from one text into the next are dropped by the caller)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out *= _U(_BASE)
        out += hashes[k:k + n]
    return mix(out)
