"""Two tokenizers' tokens of the same text, aligned by their byte ends.

Each different marked word of a block of texts is encoded once by both tokenizers. The
ends of the tokens are two sorted lists, merged by merge-path partitioning: binary
searches on equally spaced diagonals of the merge divide it into pieces of equal
work that know nothing of each other. All pieces of a block take their steps
together, whatever the lengths of words and texts. A piece emits the overlaps of its tokens
and whether both end there; stitched one after the other, the closing overlaps
cut the tokens into groups. Groups go back to the texts by the words' positions.

Links are all token pairs that share a group. A block sends each id pair once with the
number of its documents, so frequent pairs are partial sums before the shuffle, and
gets the corpus-wide counts back once per pair; a document's links are kept as counts
per pair.

Defined results: texts that are null or empty, or whose tokens' bytes do not add up to
a blank and the text, have no tokens (zeros, an empty digest); special tokens' names in
texts are plain text; rows that repeat are documents each; null keys stay; extra columns
are not read; an empty table gives an empty result. A long text is a block of its own.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from llm.chunks import CUTS, bounds_of, chunked, gathered, kept_by_worker
from llm.common import stored
from llm.piece_codec import Codec
from llm.words import blocks

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20
#: Steps of a piece of the merge.
STEPS = 64
#: Words above this many bytes are left to the tokenizers library; shorter ones are encoded in one run.
RUN_BYTES = 256


class ByteTokenizer:
    """A byte-level tokenizer of the ``tokenizers`` library, with the bytes of each id."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = Tokenizer.from_file(file)
        self.model.encode_special_tokens = True
        with open(file, encoding="utf-8") as opened:
            rules = json.load(opened)
        byte_of = _byte_letters(ByteLevel.alphabet())
        special = {t["content"] for t in rules["added_tokens"]}
        vocabulary = rules["model"]["vocab"]
        self.bytes = [b""] * self.model.get_vocab_size()
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        before = rules["pre_tokenizer"] or {}
        self.cuts = CUTS if rules["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] else ""
        self.runs = self._runs(rules["model"], special) if self.cuts else None

    def _runs(self, model: dict, special: set[str]):
        """The same merges for long runs of words, where ids follow the order of the merges; else None."""
        import public_tokenizers
        import tiktoken

        ranks = {self.bytes[i]: i for token, i in model["vocab"].items() if token not in special}
        joined = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        made = [model["vocab"].get(a + b) for a, b in joined]
        if None in made or made != sorted(set(made)) or len(made) + 256 != len(ranks) or model.get("ignore_merges"):
            return None
        return tiktoken.Encoding("runs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def segmented(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]


def _byte_letters(letters: list[str]) -> dict[str, int]:
    """Which byte each letter of byte-level vocabularies stands for: printable ones for themselves, the rest in order from 256."""
    shown = {c: ord(c) for c in letters if ord(c) < 256}
    hidden = sorted(set(range(256)) - set(shown.values()))
    return shown | {chr(256 + k): byte for k, byte in enumerate(hidden)}


class PieceTokenizer(Codec):
    runs = None


@dataclass
class Segmented:
    """Ids of listed words one after the other, where those of each word begin, and which words their bytes give again."""

    ids: np.ndarray
    first: np.ndarray
    whole: np.ndarray


def _joined(own, ids: np.ndarray) -> pa.Array:
    if not hasattr(own, "byte_table"):
        own.byte_table = pa.array(own.bytes, pa.large_binary())
    return own.byte_table.take(pa.array(ids))


def segment(own, words: pa.Array) -> Segmented:
    """Encode every listed word once."""
    n = len(words)
    sizes = np.asarray(pc.binary_length(words), dtype=np.int64)
    texts = words.cast(pa.large_string())
    in_run = np.zeros(n, dtype=bool)
    if own.runs is not None and n:
        # Latin letters only, whose classes all engines agree on, and no white space at the end, which would join the next word's.
        plain = np.asarray(pc.match_substring_regex(texts, r"^[\x00-\x{24F}]*[\x21-\x7E\x{A1}-\x{24F}]$").fill_null(False))
        in_run = plain & (sizes <= RUN_BYTES)
    rest = np.flatnonzero(~in_run)
    run = np.flatnonzero(in_run)
    run_ids = np.zeros(0, np.int64)
    if len(run):
        run_ids = np.asarray(own.runs.encode_to_numpy(pc.binary_join(pa.LargeListArray.from_arrays([0, len(run)], texts.take(pa.array(run))), pa.scalar("", pa.large_string()))[0].as_py()), dtype=np.int64)
        lengths = np.fromiter(map(len, own.bytes), dtype=np.int64, count=len(own.bytes))
        ends = np.cumsum(lengths[run_ids])
        wanted = np.cumsum(sizes[run])
        upto = np.searchsorted(ends, wanted) + 1
        if len(run_ids) == 0 or upto[-1] != len(run_ids) or not (ends[np.minimum(upto, len(ends)) - 1] == wanted).all():
            rest, run, run_ids = np.arange(n), run[:0], run_ids[:0]  # a token over a word's end: no run, then
    run_counts = np.diff(np.concatenate([[0], upto])) if len(run) else np.zeros(0, np.int64)
    found = own.segmented(texts.take(pa.array(rest)).to_pylist()) if len(rest) else []
    counts = np.zeros(n, dtype=np.int64)
    counts[run] = run_counts
    counts[rest] = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    rest_ids = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(counts[rest].sum()))
    # Both parts one after the other, then each word's ids from its place there.
    order = np.empty(n, dtype=np.int64)
    order[run], order[rest] = np.arange(len(run)), len(run) + np.arange(len(rest))
    both = np.concatenate([run_ids, rest_ids])
    ids = both[gathered(bounds_of(np.concatenate([run_counts, counts[rest]])), order)]
    first = bounds_of(counts)
    joined = _joined(own, ids)
    places = np.frombuffer(joined.buffers()[1], dtype=np.int64)[: len(ids) + 1][first] if len(ids) else np.zeros(n + 1, np.int64)
    given = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.ascontiguousarray(places)), joined.buffers()[2] or pa.py_buffer(b"")])
    return Segmented(ids, first, np.asarray(pc.equal(given, words)))


def path_cuts(ends_a: np.ndarray, ends_b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Where diagonals ``steps`` apart cross the merge of two sorted lists: so many of A and of B lie before each.

    Equal ends are taken from A first. One binary search per diagonal, all at once.
    """
    total = len(ends_a) + len(ends_b)
    diagonal = np.append(np.arange(0, total, steps), total)
    low, high = np.maximum(diagonal - len(ends_b), 0), np.minimum(diagonal, len(ends_a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        after = np.zeros(len(diagonal), dtype=bool)
        after[open_] = ends_a[middle[open_]] <= ends_b[diagonal[open_] - middle[open_] - 1]
        low = np.where(open_ & after, middle + 1, low)
        high = np.where(open_ & ~after, middle, high)
    return low, diagonal - low


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, both end here) of all overlaps in order, from pieces of ``steps`` steps each."""
    far = np.iinfo(np.int64).max
    a, b = np.append(ends_a, far), np.append(ends_b, far)
    begin_a, begin_b = path_cuts(ends_a, ends_b, steps)
    i, j, stop = begin_a[:-1].copy(), begin_b[:-1].copy(), (begin_a + begin_b)[1:]
    out = np.full((3, len(i), steps), -1, dtype=np.int64)
    for step in range(steps):
        active = i + j < stop
        from_a = active & (a[i] <= b[j])
        from_b = active & ~from_a
        # An end of B that A had as well is behind a closed group; there is nothing left to overlap.
        emits = from_a | (from_b & ~((i > 0) & (a[i - 1] == b[j])))
        out[0, emits, step], out[1, emits, step] = i[emits], j[emits]
        out[2, emits, step] = (a[i[emits]] == b[j[emits]]) & from_a[emits]
        i, j = i + from_a, j + from_b
    out = out.reshape(3, -1)
    out = out[:, out[0] >= 0]
    return out[0], out[1], out[2].astype(bool)


@dataclass
class Aligned:
    """Groups of listed words: ids of A and B one after the other, bounds per group, and where each word's groups begin."""

    a: Segmented
    b: Segmented
    group_a: np.ndarray
    group_b: np.ndarray
    first: np.ndarray
    whole: np.ndarray


def _only(part: Segmented, whole: np.ndarray) -> Segmented:
    """The same with nothing for the other words."""
    if whole.all():
        return part
    counts = np.diff(part.first)
    return Segmented(part.ids[np.repeat(whole, counts)], bounds_of(np.where(whole, counts, 0)), part.whole)


def align_words(words: pa.Array, first: ByteTokenizer, second: PieceTokenizer, steps: int = STEPS) -> Aligned:
    a, b = segment(first, words), segment(second, words)
    whole = a.whole & b.whole
    a, b = _only(a, whole), _only(b, whole)
    ends = []
    for own, part in ((first, a), (second, b)):
        lengths = np.fromiter(map(len, own.bytes), dtype=np.int64, count=len(own.bytes))
        ends.append(np.cumsum(lengths[part.ids]))
    i, j, closes = overlaps(*ends, steps)
    group_a, group_b = np.append(0, i[closes] + 1), np.append(0, j[closes] + 1)
    # Every word ends a group: as many groups lie before a word as end at or before its first token of A.
    return Aligned(a, b, group_a, group_b, np.searchsorted(group_a, a.first), whole)


def _tokenizers(path_a: str, path_b: str) -> tuple[ByteTokenizer, PieceTokenizer, str]:
    first, second = kept_by_worker("aligned a", path_a, ByteTokenizer), kept_by_worker("aligned b", path_b, PieceTokenizer)
    return first, second, "".join(c for c in CUTS if c in first.cuts and c in second.cuts)


@dataclass
class Block:
    """Aligned texts: the words' groups, and the words of each text that has tokens."""

    words: Aligned
    place: np.ndarray
    first: np.ndarray


def align_block(texts: pa.Array, path_a: str = A, path_b: str = B, steps: int = STEPS) -> Block:
    first, second, cuts = _tokenizers(path_a, path_b)
    chunks = chunked(texts, cuts)
    words = align_words(chunks.distinct, first, second, steps)
    counts = np.diff(chunks.first)
    bad = np.zeros(len(counts), dtype=bool)
    if not words.whole.all():
        bad[np.repeat(np.arange(len(counts)), counts)[~words.whole[chunks.place]]] = True
    keep = np.repeat(~bad, counts)
    return Block(words, chunks.place[keep].astype(np.int64), bounds_of(np.where(bad, 0, counts)))


def _per_text(block: Block, per_word: np.ndarray) -> np.ndarray:
    """Sums over the words of each text."""
    return np.diff(bounds_of(per_word[block.place])[block.first])


def align(docs: DataFrame, path_a: str = A, path_b: str = B) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_sizes, b_sizes): the ids of both sides, and how many of them each group has."""

    def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                block = align_block(part.column("text"), path_a, path_b)
                own = block.words
                made = [part.column("doc_id")]
                for side in (own.a, own.b):
                    made.append(lists(side.ids[gathered(side.first, block.place)], bounds_of(np.diff(side.first)[block.place])[block.first]))
                groups, upto = gathered(own.first, block.place), bounds_of(np.diff(own.first)[block.place])[block.first]
                made += [lists(np.diff(own.group_a)[groups], upto), lists(np.diff(own.group_b)[groups], upto)]
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>")


def _text_of(values: pa.Array, bounds: np.ndarray, between: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds), values), pa.scalar(between, pa.large_string()))


def group_digests(block: Block) -> list[str]:
    """sha256 of each text's groups as ``a1,a2|b1;a3|b2``; empty without tokens."""
    own = block.words
    sides = [
        _text_of(pc.cast(pa.array(side.ids), pa.large_string()), bounds, ",")
        for side, bounds in ((own.a, own.group_a), (own.b, own.group_b))
    ]
    groups = pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string()))
    words = _text_of(groups, own.first, ";")
    texts = _text_of(words.take(pa.array(block.place)), block.first, ";")
    return [hashlib.sha256(memoryview(x.as_buffer())).hexdigest() if b > a else "" for x, a, b in zip(texts, block.first[:-1], block.first[1:], strict=True)]


def word_links(own: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs (A id << 32 | B id) word by word, and where each word's begin."""
    n_a, n_b = np.diff(own.group_a), np.diff(own.group_b)
    counts = n_a * n_b
    bounds = bounds_of(counts)
    within = np.arange(int(bounds[-1])) - np.repeat(bounds[:-1], counts)
    wide = np.repeat(n_b, counts)
    at_a = np.repeat(own.group_a[:-1], counts) + within // np.maximum(wide, 1)
    at_b = np.repeat(own.group_b[:-1], counts) + within % np.maximum(wide, 1)
    return (own.a.ids[at_a] << 32) | own.b.ids[at_b], bounds[own.first]


_PER_DOCUMENT = ["n_a", "n_b", "n_groups", "n_links"]
_BLOCK = (
    "doc_ids array<{key}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>,"
    " pairs array<long>, documents array<int>, upto array<long>, places binary, times binary"
)


def _block_row(doc_ids: pa.Array, block: Block) -> dict:
    """What a block keeps: figures per text, its distinct pairs with the number of texts that have them, and each text's pairs."""
    own = block.words
    links, first = word_links(own)
    pairs, of_link = np.unique(links, return_inverse=True)
    n = len(doc_ids)
    per_word = {"n_a": np.diff(own.a.first), "n_b": np.diff(own.b.first), "n_groups": np.diff(own.first), "n_links": np.diff(first)}
    owner = np.repeat(np.arange(n), _per_text(block, per_word["n_links"]))
    seen, times = np.unique(owner * max(1, len(pairs)) + of_link[gathered(first, block.place)], return_counts=True)
    owner, place = np.divmod(seen, max(1, len(pairs)))
    row = {name: _per_text(block, counts) for name, counts in per_word.items()}
    return row | {
        "doc_ids": doc_ids, "digests": group_digests(block), "pairs": pairs, "documents": np.bincount(place, minlength=len(pairs)).astype(np.int32),
        "upto": np.searchsorted(owner, np.arange(n + 1)), "places": place.astype("<i4").tobytes(), "times": times.astype("<i4").tobytes(),
    }


def _counted(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Per text of a block: links that are their A id's most frequent, and the sum of all links' counts."""
    row = block.to_pylist()[0]
    n_pairs = len(row["pairs"])
    count, best = np.zeros(n_pairs, dtype=np.int64), np.zeros(n_pairs, dtype=np.int64)
    at = counts.column("place").to_numpy()
    count[at], best[at] = counts.column("n").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    place, times = np.frombuffer(row["places"], dtype="<i4"), np.frombuffer(row["times"], dtype="<i4").astype(np.int64)
    upto = np.array(row["upto"])
    sums = [np.diff(bounds_of(times * per_pair[place])[upto]) for per_pair in (best, count)]
    named = {"doc_id": row["doc_ids"]} | {n: row[n] for n in _PER_DOCUMENT} | {"n_best": sums[0], "count_sum": sums[1], "groups_sha256": row["digests"]}
    return pa.table({n: pa.array(v, block.schema.field("doc_ids").type.value_type if n == "doc_id" else None if n != "groups_sha256" else pa.string()) for n, v in named.items()})


def statistics(docs: DataFrame, path_a: str = A, path_b: str = B) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                row = _block_row(part.column("doc_id"), align_block(part.column("text"), path_a, path_b))
                lists = {n: pa.array([v]) for n, v in row.items() if not isinstance(v, (bytes, list, pa.Array))}
                lists["doc_ids"] = pa.ListArray.from_arrays(pa.array([0, len(row["doc_ids"])], pa.int32()), row["doc_ids"])
                lists["digests"] = pa.array([row["digests"]], pa.list_(pa.string()))
                lists |= {n: pa.array([row[n]], pa.binary()) for n in ("places", "times")}
                names = [x.split()[0] for x in _BLOCK.split(", ")]
                yield pa.RecordBatch.from_arrays([lists[n] for n in names], names)

    made = docs.select("doc_id", "text").mapInArrow(run, _BLOCK.format(key=key))
    # The ids of the blocks are written with them, so a task that runs again does not change them.
    blocks_ = stored(made.withColumn("block", F.monotonically_increasing_id()), "aligned-blocks")
    asked = blocks_.select("block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("place", "pair")).select(
        "block", "place", F.col("pair.pairs").alias("pair"), F.col("pair.documents").alias("documents")
    )
    counts = pair_counts(asked.select("pair", "documents"))
    replies = asked.join(counts, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")
    result = f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks_.groupBy("block").cogroup(replies.groupBy("of_block")).applyInArrow(_counted, result)


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, n, best) from (pair, documents) sums: documents that have the pair, and whether no pair of its A id has more.

    An A id has at most as many pairs as the other vocabulary has pieces.
    """
    summed = stored(partial.groupBy("pair").agg(F.sum("documents").alias("n")), "pair-counts")
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return summed.withColumn("best", (F.col("n") == F.max("n").over(of_a)).cast("long"))
