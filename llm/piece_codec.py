"""SentencePiece encoding and decoding by a table of distinct marked words.

Where no piece of the model holds a whitespace marker behind another character, no
piece crosses the place before a marker, so words are segmented independently:
each different marked word of a block goes through the library once and its ids are
put back by position. The same holds for line feeds where no piece has one. A model
without these properties, or with a normalizer that rewrites texts, gets the whole
texts instead.

Decoding puts the bytes of the pieces one after the other. Ids that this does not
cover (control ids inside, bytes that are no UTF-8) go through the library's decoder.

Defined results: null texts are empty, and an empty text has the end id alone;
decoding null ids gives null; ids outside the vocabulary are an error, as in the
library; rows that repeat are kept, and each is coded for itself; keys and all extra columns pass
through (a column named like a new one is replaced); an empty table gives an empty
table. Long texts are blocks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from llm.chunks import CUTS, MARKER, bounds_of, chunked, gathered, kept_by_worker
from llm.words import blocks

MODEL = "piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20


class Codec:
    """A model file with what its pieces allow."""

    def __init__(self, file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        with open(file, "rb") as opened:
            proto = sentencepiece_model_pb2.ModelProto.FromString(opened.read())
        kinds = proto.SentencePiece
        pieces = [p.piece for p in proto.pieces]
        self.end_id = self.model.eos_id()
        self.marker_id = self.model.piece_to_id(MARKER)
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = (
            not rules.precompiled_charsmap and rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
            and not trainer.treat_whitespace_as_suffix and pieces[self.marker_id] == MARKER
            and not any(p.type == kinds.USER_DEFINED for p in proto.pieces)
        )
        crossing = any(MARKER in p.lstrip(MARKER) for p in pieces)
        self.cuts = ("" if not plain or crossing else " " if any("\n" in p for p in pieces) else CUTS)
        self.simple = plain and not proto.denormalizer_spec.precompiled_charsmap
        #: Bytes that each id stands for, and a second time without a marker in front, as at a text's beginning.
        self.bytes = [bytes([int(p.piece[1:-1], 16)]) if p.type == kinds.BYTE else p.piece.replace(MARKER, " ").encode() for p in proto.pieces]
        self.control = np.array([p.type == kinds.CONTROL for p in proto.pieces])
        self.special = self.control | np.array([p.type in (kinds.UNKNOWN, kinds.UNUSED) for p in proto.pieces])
        self.is_byte = np.array([p.type == kinds.BYTE for p in proto.pieces])
        shown = [b"" if s else b for s, b in zip(self.special, self.bytes, strict=True)]
        self.shown = pa.array(shown + [b[1:] if b[:1] == b" " else b for b in shown], pa.large_binary())

    def segmented(self, words: list[str]) -> list[list[int]]:
        """The ids of chunks, each without what a marker before it would add."""
        if not self.cuts:
            return self.model.encode([word[1:] for word in words], num_threads=1)
        # The library puts a marker before what it gets: a chunk's own blank stands for it, before a line feed it is taken off.
        found = self.model.encode([word[1:] if word[0] == " " else word for word in words], num_threads=1)
        return [[self.marker_id] if word == " " else ids if word[0] == " " else ids[1:] for word, ids in zip(words, found, strict=True)]


def codec(path: str) -> Codec:
    return kept_by_worker("pieces", path, Codec)


def encoded(texts: pa.Array, path: str = MODEL, end: bool = True) -> pa.LargeListArray:
    """The ids of every text of a column, with the end id behind them if wanted."""
    own = codec(path)
    chunks = chunked(texts, own.cuts)
    ids = own.segmented(chunks.distinct.cast(pa.large_string()).to_pylist()) + [[own.end_id]]
    counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(counts.sum()))
    place, first = chunks.place.astype(np.int64), chunks.first
    if end:
        place = np.insert(place, first[1:], len(ids) - 1)
        first = first + np.arange(len(first))
    bounds = bounds_of(counts[place])
    return pa.LargeListArray.from_arrays(pa.array(bounds[first]), pa.array(flat[gathered(bounds_of(counts), place)]))


def decoded(lists: pa.Array, path: str = MODEL) -> pa.Array:
    """The text of every list of ids; null for a null list."""
    own = codec(path)
    lists = lists.cast(pa.large_list(pa.int32()))
    n = len(lists)
    known = lists.is_valid()
    sizes = np.asarray(pc.list_value_length(lists).fill_null(0), dtype=np.int64)
    flat = np.asarray(lists.flatten()).astype(np.int64)
    first = bounds_of(sizes)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(own.bytes)):
        raise IndexError("id outside the vocabulary")
    begins = first[:-1][sizes > 0]
    # Ids the fast way does not cover: control ids before the last place, and bytes or control ids at the beginning.
    odd = own.special[flat]
    last = first[1:][sizes > 0] - 1
    odd[last] &= ~own.control[flat[last]]
    odd[begins] |= own.is_byte[flat[begins]]
    slow = set(np.unique(np.searchsorted(first, np.flatnonzero(odd), "right") - 1).tolist()) if odd.any() else set()
    if not own.simple:
        slow = set(range(n))
    shown = flat.copy()
    shown[begins] += len(own.bytes)
    taken = own.shown.take(pa.array(shown))
    places = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.ascontiguousarray(places[first])), taken.buffers()[2] or pa.py_buffer(b"")])
    if slow or not _all_utf8(texts):
        rows: list[str | None] = []
        for k, content in enumerate(texts.to_pylist()):
            try:
                rows.append(own.model.decode(flat[first[k] : first[k + 1]].tolist()) if k in slow else content.decode())
            except UnicodeDecodeError:
                rows.append(own.model.decode(flat[first[k] : first[k + 1]].tolist()))
        out = pa.array(rows, pa.large_string())
    else:
        out = texts.cast(pa.large_string())
    return pc.if_else(known, out, pa.scalar(None, pa.large_string()))


def _all_utf8(texts: pa.Array) -> bool:
    try:
        texts.cast(pa.large_string())
    except pa.ArrowInvalid:
        return False
    return True


def _with(df: DataFrame, source: str, made: dict[str, T.DataType], work) -> DataFrame:
    """``df`` with the columns that ``work`` makes from its column ``source``; they replace columns of their names."""
    taken = {name.lower() for name in made}
    names = [c for c in df.columns if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(name, kind) for name, kind in made.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, source, BLOCK_BYTES) if source == "text" else [batch]:
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + work(part.column(source)), schema.names)

    return df.select(*names).mapInArrow(run, schema)


_IDS = T.ArrayType(T.IntegerType())


def _narrow(array: pa.Array) -> pa.Array:
    return array.cast(pa.list_(pa.int32()) if pa.types.is_large_list(array.type) else pa.string())


def encode(docs: DataFrame, path: str = MODEL, end: bool = True) -> DataFrame:
    """``docs`` with ``ids``, the ids of its column ``text``."""
    return _with(docs, "text", {"ids": _IDS}, lambda texts: [_narrow(encoded(texts, path, end))])


def decode(coded: DataFrame, path: str = MODEL) -> DataFrame:
    """``coded`` with ``decoded``, the text of its column ``ids``."""
    return _with(coded, "ids", {"decoded": T.StringType()}, lambda ids: [_narrow(decoded(ids, path))])


def round_trip(docs: DataFrame, path: str = MODEL, end: bool = True) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, in one pass over the texts."""

    def work(texts: pa.Array) -> list[pa.Array]:
        ids = encoded(texts, path, end)
        return [_narrow(ids), _narrow(decoded(ids, path))]

    return _with(docs, "text", {"ids": _IDS, "decoded": T.StringType()}, work)


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    coded = round_trip(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        _sha256(F.col("decoded")).alias("decoded_sha256"),
    )
