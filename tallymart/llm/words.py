"""Words, shingles and their hashes, computed for many texts at once from UTF-8 bytes.

A word is a run of bytes other than U+0020 and U+0009 to U+000D.  Hashes are
polynomials over the bytes (or over word hashes) modulo 2**64 with odd bases, so any
run of words has a hash from two prefix sums, then mixed.  They depend on content only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of tokens: ASCII letters and digits, and all bytes of other characters.
TOKEN_BYTES = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])
BYTE_BASE, WORD_BASE, SECOND_BASE = (
    0x9E3779B97F4A7C15,
    0xD1342543DE82EF95,
    0xA0761D6478BD642F,
)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    held = _powers.get(base)
    if held is None or len(held[0]) <= n:
        size = max(n + 1, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 2**64)):
            row = np.full(size, b, dtype=np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        held = _powers[base] = (both[0], both[1])
    return held


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:], dtype=np.uint64)
    return out


def run_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values from start to end, the same wherever the run lies."""
    _, down = powers(base, len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


@dataclass
class Block:
    """Some texts of a batch: ``first`` is the row of the first one in the batch."""

    first: int
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # text i: data[offsets[i]:offsets[i + 1]]
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i]:bounds[i + 1]

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        sums = prefix(_BYTE_VALUES[self.data], BYTE_BASE)
        return run_hash(sums, self.starts, self.ends, BYTE_BASE)


def blocks(
    column: pa.Array, limit: int = 1 << 20, solid_bytes: np.ndarray = ~_SPACE
) -> Iterator[Block]:
    """Cut a text column into blocks of about ``limit`` bytes; a longer text is a block of its own.

    Words are runs of ``solid_bytes``; by default of all but white space.  A null is empty.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, offsets_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offsets_buffer, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), n)
        part = data[offsets[row] : offsets[to]]
        yield cut(row, part, offsets[row : to + 1] - offsets[row], solid_bytes)
        row = to


def cut(first: int, data: np.ndarray, offsets: np.ndarray, solid_bytes: np.ndarray) -> Block:
    solid = solid_bytes[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = solid[edges]
    last = edges[edges > 0] - 1
    stops[last] = solid[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Block(first, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def shingles(hashes: np.ndarray, k: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of every run of k words; runs across texts are the caller's to leave out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    start = np.arange(n)
    return run_hash(prefix(hashes, base), start, start + k, base)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Least of each w values in a row."""
    if len(values) < w:
        return values[:0]
    out, held = values, 1
    while held * 2 <= w:
        out = np.minimum(out[:-held], out[held:])
        held *= 2
    if held < w:
        out = np.minimum(out[: len(values) - w + 1], out[w - held :])
    return out
