"""Benchmark decontamination by greedy string tiling.

Runs of ``SEED`` tokens that a document shares with a benchmark item are found
by a join on their hashes; only such pairs go on. A pair's longest common run of
tokens that are not marked yet is marked, again and again, until none of at
least ``SEED`` tokens is left. Runs are found with Karp-Rabin hashes of falling
length. The marked share of the item's tokens is its coverage; a document whose
coverage of an item reaches the threshold is contaminated, whatever the order of
the passages.

Defined results: null and empty texts and items match nothing; an item with
fewer tokens than a seed is found where all its tokens stand in one run; ties
between equally long runs go to the earlier place in the document, then in the
item; rows that repeat a doc_id are looked at each by itself, and the
best coverage counts; items with equal texts are matched each; a null doc_id is
matched and reported as null; extra columns stay.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.common import fresh, stored
from llm.words import blocks, shingles, words_of

SEED = 5
COVERAGE = 0.6
#: Up to so many bytes of benchmark text, the items travel with the tasks; beyond, seeds are joined by shuffle.
BROADCAST_BYTES = 16 << 20
_PRIME = (1 << 61) - 1
_STEP = 1_000_003


def _runs(tokens: Sequence[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(place, Karp-Rabin hash) of every run of ``length`` free tokens, by rolling."""
    top = pow(_STEP, length, _PRIME)
    value = have = 0
    for i, token in enumerate(tokens):
        if not free[i]:
            value = have = 0
            continue
        value = (value * _STEP + token + 1) % _PRIME
        have += 1
        if have > length:
            value = (value - (tokens[i - length] + 1) * top) % _PRIME
        if have >= length:
            yield i - length + 1, value


def _longest_free(free: list[bool]) -> int:
    run = best = 0
    for is_free in free:
        run = run + 1 if is_free else 0
        best = max(best, run)
    return best


def _share_a_run(document: Sequence[int], free_d: list[bool], item: Sequence[int], free_i: list[bool], length: int) -> bool:
    wanted = {value for _, value in _runs(item, free_i, length)}
    return bool(wanted) and any(value in wanted for _, value in _runs(document, free_d, length))


def tiles(document: Sequence[int], item: Sequence[int], least: int = SEED) -> list[tuple[int, int, int]]:
    """(place in the document, place in the item, length) of the tiles, longest first.

    Where a run of some length is shared, one of every smaller length is, so the
    longest is found by halving, not by going through all lengths.
    """
    least = max(1, min(least, len(item)))
    free_d, free_i = [True] * len(document), [True] * len(item)
    out: list[tuple[int, int, int]] = []
    # The longest match is at most as long as the longest run of document tokens that the item has at all.
    known = set(item)
    most = _longest_free([token in known for token in document])
    while True:
        low, high = least, min(most, _longest_free(free_d), _longest_free(free_i))
        if low > high or not _share_a_run(document, free_d, item, free_i, low):
            return out
        while low < high:
            middle = (low + high + 1) // 2
            if _share_a_run(document, free_d, item, free_i, middle):
                low = middle
            else:
                high = middle - 1
        places = defaultdict(list)
        for j, value in _runs(item, free_i, low):
            places[value].append(j)
        most = low
        for i, value in list(_runs(document, free_d, low)):
            for j in places.get(value, ()):
                if all(free_d[i : i + low]) and all(free_i[j : j + low]) and document[i : i + low] == item[j : j + low]:
                    free_d[i : i + low] = [False] * low
                    free_i[j : j + low] = [False] * low
                    out.append((i, j, low))
                    break
        most -= 1  # all of this length are marked, or only hashes agreed


def _near(words: np.ndarray, hits: np.ndarray, reach: int) -> list[int]:
    """The tokens within ``reach`` of a seed, pieces far from each other parted by a token of their own."""
    keep = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(keep, np.maximum(hits - reach, 0), 1)
    np.add.at(keep, np.minimum(hits + reach + 1, len(words)), -1)
    inside = np.flatnonzero(np.cumsum(keep)[:-1] > 0)
    out: list[int] = []
    for k, i in enumerate(inside.tolist()):
        if k and i != inside[k - 1] + 1:
            out.append(-1)
        out.append(int(words[i]))
    return out


def _item_arrays(texts: pa.Array, size: int) -> tuple[list[list[int]], list[np.ndarray]]:
    """Tokens and seeds of each item."""
    words = words_of(texts)
    seeds, first = shingles(words, size)
    tokens = [words.hashes[a:b].tolist() for a, b in zip(words.first, words.first[1:], strict=False)]
    return tokens, [np.unique(seeds[a:b]) for a, b in zip(first, first[1:], strict=False)]


_RESULT = "doc_id long, item_id long, coverage double, n_tiles int, longest int"


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
    names = [field.split()[0] for field in _RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], names)


def _score(doc_id, tokens: list[int], hits: np.ndarray, item_id, item: list[int], threshold: float, size: int):
    """A result row when the item's coverage reaches the threshold, else None."""
    found = tiles(_near(np.asarray(tokens, dtype=np.uint64), hits, 2 * len(item)), item, size)
    share = sum(n for _, _, n in found) / len(item)
    return (doc_id, item_id, share, len(found), found[0][2]) if found and share >= threshold else None


def _short_runs(words: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Where the whole of a short item stands in a document."""
    n = len(words) - len(item) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    same = np.ones(n, dtype=bool)
    for k, token in enumerate(item):
        same &= words[k : k + n] == token
    return np.flatnonzero(same)


def _matches_by_broadcast(docs: DataFrame, items: list, threshold: float, size: int) -> DataFrame:
    """Every text is read once, against the few items that travel with the task."""
    ids = [r["item_id"] for r in items]
    tokens, seeds = _item_arrays(pa.array([r["text"] for r in items], pa.large_string()), size)
    long = [k for k, t in enumerate(tokens) if len(t) >= size]
    short = [k for k, t in enumerate(tokens) if 0 < len(t) < size]
    value = np.concatenate([seeds[k] for k in long]) if long else np.zeros(0, np.uint64)
    owner = np.concatenate([np.full(len(seeds[k]), k) for k in long]) if long else np.zeros(0, np.int64)
    order = np.argsort(value, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((ids, tokens, short, value[order], owner[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tokens, short, value, owner = shared.value
        # A table of 20 bits sends nearly all runs away before the sorted seeds are searched.
        sieve = np.zeros(1 << 20, dtype=bool)
        sieve[(value >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            for part in blocks(batch, "text"):
                words = words_of(part.column("text"))
                runs, first = shingles(words, size)
                maybe = np.flatnonzero(sieve[(runs >> np.uint64(44)).astype(np.int64)])
                low = np.searchsorted(value, runs[maybe], "left")
                high = np.searchsorted(value, runs[maybe], "right")
                at = defaultdict(list)
                text = np.searchsorted(first, maybe, "right") - 1
                for place, i, a, b in zip(maybe.tolist(), text.tolist(), low.tolist(), high.tolist(), strict=True):
                    for k in owner[a:b].tolist():
                        at[i, k].append(place - int(first[i]))
                spans = words.first
                for k in short:
                    for i in range(len(spans) - 1):
                        places = _short_runs(words.hashes[spans[i] : spans[i + 1]], np.array(tokens[k], dtype=np.uint64))
                        if len(places):
                            at[i, k] += places.tolist()
                doc_ids = part.column("doc_id").to_pylist() if at else []
                found = [
                    _score(doc_ids[i], words.hashes[spans[i] : spans[i + 1]], np.array(hits), ids[k], tokens[k], threshold, size)
                    for (i, k), hits in sorted(at.items())
                ]
                yield _rows([r for r in found if r])

    return docs.mapInArrow(run, _RESULT)


def _matches_by_join(docs: DataFrame, items: DataFrame, threshold: float, size: int) -> DataFrame:
    """The same by a shuffle on seed hashes, for a benchmark of any size."""

    def seeds(column: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in blocks(batch, "text"):
                    words = words_of(part.column("text"))
                    lists = []
                    for k in range(1, size + 1):
                        runs, first = shingles(words, k)
                        count = words.count()
                        lists.append([np.unique(runs[a:b]).view(np.int64) if n >= k and (column == "doc_id" or n == k or k == size) else [] for a, b, n in zip(first, first[1:], count, strict=False)])
                    merged = [np.concatenate([np.asarray(x, dtype=np.int64) for x in group]) for group in zip(*lists, strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(merged, pa.list_(pa.int64()))], ["row", "seeds"])

        return run

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, text, item_id, item in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "item_id", "item")], strict=True):
                tokens, targets = words_of(pa.array([text])).hashes, words_of(pa.array([item])).hashes
                n = min(size, len(targets))
                hits = np.flatnonzero(np.isin(_plain_runs(tokens, n), _plain_runs(targets, n)))
                found.append(_score(doc_id, tokens, hits, item_id, targets.tolist(), threshold, size))
            yield _rows([r for r in found if r])

    numbered = stored(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "texts")
    wanted = stored(items.select("item_id", F.col("text").alias("item"), F.monotonically_increasing_id().alias("item_row")), "items")
    of_docs = numbered.mapInArrow(seeds("doc_id"), "row long, seeds array<long>").select("row", F.explode("seeds").alias("seed"))
    of_items = (
        wanted.select(F.col("item_row").alias("row"), F.col("item").alias("text"))
        .mapInArrow(seeds("item_id"), "row long, seeds array<long>")
        .select(F.col("row").alias("item_row"), F.explode("seeds").alias("seed"))
    )
    pairs = of_docs.join(of_items, "seed").select("row", "item_row").distinct()
    both = pairs.join(numbered, "row").join(wanted, "item_row").select("doc_id", "text", "item_id", "item")
    return both.mapInArrow(compare, _RESULT)


def _plain_runs(tokens: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(0, len(tokens) - n + 1), dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(_STEP) + tokens[k : k + len(out)]
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, size: int = SEED, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest) of every pair whose coverage reaches the threshold."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    held = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    if held <= broadcast_bytes:
        return _matches_by_broadcast(texts, items.collect(), threshold, size)
    return _matches_by_join(texts, items, threshold, size)


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """The documents that do not contain a benchmark item. A contaminated row without key goes as well as one with it."""
    key, gone, flag = fresh(docs, "text_key", "gone_id", "gone_key")
    narrow = docs.select("doc_id", "text")
    hits = stored(matches(narrow, benchmark, threshold).select(F.col("doc_id").alias(gone)).distinct(), "contaminated")
    kept = docs.join(hits.where(F.col(gone).isNotNull()), F.col("doc_id") == F.col(gone), "left_anti")
    if hits.where(F.col(gone).isNull()).isEmpty():
        return kept
    # Rows without a key cannot be told apart by it; they are numbered and looked at by themselves.
    loose = stored(docs.where("doc_id is null").withColumn(key, F.monotonically_increasing_id()), "no-key")
    bad = stored(matches(loose.select(F.col(key).alias("doc_id"), "text"), benchmark, threshold).select(F.col("doc_id").alias(flag)).distinct(), "no-key-hits")
    clean = loose.join(bad, F.col(key) == F.col(flag), "left_anti").select(*docs.columns)
    return kept.where("doc_id is not null").unionByName(clean)
