"""Vectorised byte and word kernels used inside Arrow tasks.

Every kernel works on one *block*: the UTF-8 bytes of a run of rows laid end to
end, with the row offsets.  Blocks are cut from Arrow batches at about
``BLOCK_BYTES``, so the temporaries of a task stay bounded whatever the batch
size is; a single text longer than that is one block of its own (whole texts,
never prefixes).  A null text counts as an empty one.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

U64 = np.uint64
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15
#: Odd base of the polynomial hash, and its inverse modulo 2**64.
_BASE = 0xD1342543DE82EF95
_BASE_INV = pow(_BASE, -1, 1 << 64)


def frugal(task):
    """A task function that gives freed memory back to the system at its end.

    Spark keeps Python workers for later tasks; what their allocators hold on to
    would count beside the next stage's.
    """
    def run(batches):
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)
    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (uint64 in, uint64 out)."""
    x = x ^ (x >> U64(30))
    x *= _MIX1
    x ^= x >> U64(27)
    x *= _MIX2
    x ^= x >> U64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random uint64 values."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=U64) + U64(seed << 20)) * U64(_GOLDEN))


#: One random coefficient per byte value; FOLDED treats A-Z as a-z.
EXACT = seeded(256, 11)
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]

#: x20 and x09-x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept between blocks."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        have = np.ones(size, dtype=U64)
        done = 1
        while done < size:
            step = min(done, size - done)
            have[done:done + step] = have[:step] * U64(pow(base, done, 1 << 64))
            done += step
        _powers[base] = have
    return have[:n]


class Block(NamedTuple):
    first: int  # row number of the first row within the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, rows + 1, from 0

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of a string column as blocks of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, body = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield Block(at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at])
        at = end


class Words(NamedTuple):
    start: np.ndarray  # byte positions in the block
    end: np.ndarray
    row: np.ndarray  # row of each word


def words(block: Block, gap: np.ndarray = SPACE, cuts: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes not in ``gap`` (x20 and x09-x0D), cut at row ends.

    ``cuts``: positions inside runs at which a further word begins.
    """
    if not len(block.data):
        z = np.zeros(0, dtype=np.int64)
        return Words(z, z, z)
    inside = ~gap[block.data]
    before = np.empty(len(inside) + 1, dtype=bool)
    before[0] = before[-1] = False
    before[1:-1] = inside[:-1]
    edges = block.offsets[1:-1]
    edges = edges[edges < len(inside)]
    before[edges] = False
    if cuts is not None:
        before[cuts] = False
    start = np.flatnonzero(inside & ~before[:-1])
    after = np.empty(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    after[-1] = False
    cut = edges[edges > 0] - 1
    after[cut] = False
    if cuts is not None:
        after[cuts - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(block.offsets, start, side="right") - 1
    return Words(start, end, row)


def prefix_hash(block: Block, table: np.ndarray) -> np.ndarray:
    """``H[i]``: polynomial hash of the first i bytes of the block."""
    out = np.empty(len(block.data) + 1, dtype=U64)
    out[0] = 0
    coef = table[block.data]
    coef *= powers(_BASE, len(coef))
    np.cumsum(coef, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the byte strings [start, end), independent of their place."""
    inverse = powers(_BASE_INV, len(prefix))
    return mix64((prefix[end] - prefix[start]) * inverse[start])


def word_hashes(block: Block, table: np.ndarray = EXACT) -> tuple[Words, np.ndarray]:
    w = words(block)
    return w, span_hash(prefix_hash(block, table), w.start, w.end)


_GRAM = seeded(64, 29) | U64(1)


def gram_hashes(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all runs of ``n`` consecutive words of one row."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    whole = row[:m] == row[n - 1:]
    out = np.zeros(m, dtype=U64)
    for j in range(n):
        out += hashes[j:j + m] * _GRAM[j]
    return mix64(out[whole]), row[:m][whole]


def row_sums(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sum of ``values`` by row."""
    return np.bincount(row, weights=values, minlength=rows)


def sorted_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs (by one sort)."""
    if not len(values):
        return values, np.zeros(0, dtype=np.int64)
    v = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    return v[first], np.diff(np.append(first, len(v)))
