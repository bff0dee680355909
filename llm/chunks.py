"""Texts as marked words: chunks that tokenizers never merge across, each different one listed once.

A chunk begins at a blank or line feed that follows a character other than white
space, and reaches to the next one; a text's first chunk begins with a blank put
before the text. Chunks are slices of the column's bytes, found with array operations.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from llm.common import worker_memory

MARKER = "▁"
CUTS = " \n"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# White space beyond ASCII, and the marker, end in these two bytes; other characters that do so only make longer chunks.
_LAST, _BEFORE = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LAST[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_BEFORE[[0x80, 0x81, 0x96, 0x9A, 0xC2]] = True


def vocabulary_file(path: str) -> str:
    """A path as it is; a bare name stands for a file of the public tokenizers."""
    if os.path.sep in path:
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


def kept_by_worker(kind: str, path: str, make):
    """``make(file)``, once per Python worker."""
    kept = worker_memory()
    if (kind, path) not in kept:
        kept[kind, path] = make(vocabulary_file(path))
    return kept[kind, path]


@dataclass
class Chunks:
    """``distinct[place[first[i]:first[i + 1]]]`` are the chunks of text i."""

    distinct: pa.Array
    place: np.ndarray
    first: np.ndarray


def chunked(texts: pa.Array, cuts: str = CUTS, inside: Callable[[np.ndarray], np.ndarray] | None = None) -> Chunks:
    """Chunks of a column of texts, cut before the characters ``cuts`` alone; null and empty texts have none.

    ``inside`` names further places: given the bytes, it tells for all but the first whether a chunk begins there.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    empty = pc.equal(pc.binary_length(texts), 0)
    nothing = pa.scalar("", pa.large_string())
    marked = pc.if_else(empty, nothing, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, nothing))
    n = len(marked)
    offsets = np.frombuffer(marked.buffers()[1], dtype=np.int64)[marked.offset : marked.offset + n + 1] if n else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    if high == low:
        return Chunks(pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.zeros(n + 1, np.int64))
    buffer = marked.buffers()[2].slice(low, high - low)
    data, offsets = np.frombuffer(buffer, dtype=np.uint8), offsets - low
    starts = np.zeros(len(data), dtype=bool)
    for byte in cuts.encode():
        starts |= data == byte
    starts[1:] &= ~_SPACE[data[:-1]]
    starts[2:] &= ~(_LAST[data[1:-1]] & _BEFORE[data[:-2]])
    if inside:
        starts[1:] |= inside(data)
    starts[offsets[:-1][np.diff(offsets) > 0]] = True
    begin = np.flatnonzero(starts)
    bounds = np.append(begin, len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), buffer])
    listed = pieces.dictionary_encode()
    return Chunks(listed.dictionary, np.asarray(listed.indices), np.searchsorted(begin, offsets))


def bounds_of(counts: np.ndarray) -> np.ndarray:
    """Where runs of the given lengths begin, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def gathered(first: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Positions of the elements of the runs ``place``, one run after the other; run k is first[k]:first[k + 1]."""
    counts = (first[1:] - first[:-1])[place]
    ends = np.cumsum(counts)
    return np.repeat(first[:-1][place] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)
