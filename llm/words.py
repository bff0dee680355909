"""Words of whole Arrow text columns as 64-bit hashes, found with array operations.

A word is a run of bytes other than blank and the control characters 0x09 to
0x0D, with A-Z lower-cased. Nothing here loops over words in Python: a prefix
sum over the bytes gives the polynomial hash of every word at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from llm.common import worker_memory

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text that are handled at once; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling and kept for later calls."""
    kept = worker_memory()
    have = kept.get(("powers", base), np.ones(1, dtype=np.uint64))
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    kept["powers", base] = have[: 2 * PIECE_BYTES]
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of some texts: ``hashes[first[i]:first[i + 1]]`` are those of text i."""

    hashes: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    data: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose text column has about ``limit`` bytes or is one row."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    key = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def words_of(texts: pa.Array) -> Words:
    """The words of every text of a column; null texts have none."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    buffer = texts.buffers()[2]
    if high == low or buffer is None:
        nothing = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), nothing, nothing, np.zeros(0, np.uint8))
    data = _LOWER[np.frombuffer(buffer, dtype=np.uint8)[low:high]]
    offsets = offsets - low
    # Whole texts of about a megabyte at a time: the arrays of eight bytes per byte stay small.
    cuts = np.unique(np.searchsorted(offsets, np.arange(0, len(data), PIECE_BYTES), "right") - 1)
    found = [_pieces(data, offsets[a : b + 1]) for a, b in zip(cuts, [*cuts[1:], n], strict=True)]
    hashes, begin, end = (np.concatenate(x) for x in zip(*found, strict=True))
    return Words(hashes, np.searchsorted(begin, offsets), begin, end, data)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, begin, end) of the words of the texts that lie between ``offsets``."""
    low = int(offsets[0])
    data, offsets = data[low : int(offsets[-1])], offsets - low
    inside = _IS_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    bounds = offsets[:-1][np.diff(offsets) > 0]
    starts[bounds] = inside[bounds]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = bounds[1:] - 1
    ends[last] = inside[last]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)), out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * _powers(INVERSE, len(data))[begin])
    return hashes, begin + low, end + low


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words inside a text, and where each text's runs begin.

    A text with fewer words has one run, all of its words; one without words has none.
    """
    counts = words.count()
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(runs)])
    n = len(words.hashes)
    out = np.zeros(int(first[-1]), dtype=np.uint64)
    if not n:
        return out, first
    rolled = np.zeros(n, dtype=np.uint64)
    multiplier = np.uint64(BASE)
    for k in range(size):
        rolled *= multiplier
        rolled[: max(0, n - k)] += words.hashes[k:]
    owner = np.repeat(np.arange(len(counts)), runs)
    at = words.first[:-1][owner] + (np.arange(len(out)) - first[:-1][owner])
    long = (counts >= size)[owner]
    out[long] = rolled[at[long]]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        value = int(counts[i])
        for h in words.hashes[words.first[i] : words.first[i + 1]].tolist():
            value = (value * BASE + h + 1) % (1 << 64)
        out[first[i]] = value
    return mix(out), first
