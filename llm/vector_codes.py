"""Vectors as short codes: per part a codebook learned in rounds, searched by equal averages.

A vector of integers is cut into equal parts, and every part position has a
codebook of its own. The nearest entry is searched outward from the part's component
sum among the entries sorted by theirs: since (sum x - sum c)**2 <= d * |x - c|**2, the
search of a part ends when the squared gap of the sums over the dimension d exceeds the
best squared distance. All parts of an Arrow batch take their steps together.

A round assigns all vectors to the codebooks and moves the entries. Tasks add up
counts and sums per entry before the shuffle, so a vector that repeats in a third of
all rows is one number. Only the codebooks, whose size is set by parameters, pass
through the driver.

Defined results: vectors that are null or hold a null or non-finite component are
dropped; shorter vectors are filled up with zeros to the smallest multiple of the
number of parts that holds the longest; scaled components beyond a long become
its ends, errors too; rows that repeat are kept, and of equal vec_ids the smaller vector
comes first among those the codebooks begin with; null vec_ids come last; with fewer
rows than entries the codebooks have as many entries as there are rows; null labels
are one label; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_LONG = 2**63 - 1
#: Vectors that are searched at once.
ROWS = 4096


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector, label) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.where(F.col("embedding").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )


def whole_numbers(lists: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as a (vector, component) array: of int64 where products of differences fit, else of Python's integers."""
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    flat = np.asarray(lists.flatten(), dtype=np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * scale)
    small = not len(scaled) or np.abs(scaled).max() < _safe(width)
    out = np.zeros((len(sizes), width), dtype=np.int64 if small else object)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[owner, at] = scaled.astype(np.int64) if small else [max(-_LONG - 1, min(_LONG, int(x))) if np.isfinite(x) else (_LONG if x > 0 else -_LONG - 1) for x in scaled]
    return out


def _safe(width: int) -> int:
    """Components below this keep squared gaps of sums, and distances times the dimension, within 62 bits."""
    return (1 << 30) // max(1, width)


def nearest(entries: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, ties to the lower one, and the squared distance."""
    n, d = parts.shape
    if entries.dtype == object or parts.dtype == object:
        entries, parts = entries.astype(object), parts.astype(object)
    totals = entries.sum(axis=1) if d else np.zeros(len(entries), dtype=np.int64)
    order = np.argsort(totals, kind="stable")
    totals, listed = totals[order], entries[order]
    own = parts.sum(axis=1) if d else np.zeros(n, dtype=np.int64)
    right = np.searchsorted(totals, own)
    left = right - 1
    best = np.zeros(n, dtype=parts.dtype)
    found = np.full(n, -1)
    active = np.arange(n)
    while len(active):
        low, high, total = left[active], right[active], own[active]
        has_low, has_high = low >= 0, high < len(totals)
        below, above = total - totals[np.maximum(low, 0)], totals[np.minimum(high, len(totals) - 1)] - total
        go_low = has_low & (~has_high | (below <= above)).astype(bool)
        gap = np.where(go_low, below, above)
        first = found[active] < 0
        more = (has_low | has_high) & (first | (gap * gap <= best[active] * d).astype(bool))
        active, go_low, first = active[more], go_low[more], first[more]
        at = np.where(go_low, left[active], right[active])
        apart = parts[active] - listed[at]
        distance = (apart * apart).sum(axis=1) if d else np.zeros(len(active), dtype=np.int64)
        index, known = order[at], best[active]
        better = first | (distance < known).astype(bool) | ((distance == known).astype(bool) & (index < found[active]))
        best[active[better]], found[active[better]] = distance[better], index[better]
        left[active[go_low]] -= 1
        right[active[~go_low]] += 1
    return found, best


def _assigned(lists: pa.Array, codebooks: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, its vectors, entries, squared distances) for every part position of some vectors."""
    n_parts, _, d = codebooks.shape
    vectors = whole_numbers(lists, n_parts * d)
    for part in range(n_parts):
        own = vectors[:, part * d : (part + 1) * d]
        yield part, own, *nearest(codebooks[part], own)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def initial(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the rows with the smallest vec_ids as a (part, entry, component) array."""
    longest = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // parts) * parts
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    numbers = whole_numbers(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), width)
    return numbers.reshape(len(rows), parts, width // parts).transpose(1, 0, 2)


def moved(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: all vectors are assigned, and every entry that has parts becomes the floor of their mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(codebooks.shape[:2], dtype=np.int64)
        sums = np.zeros(codebooks.shape, dtype=object)
        for batch in _cut(batches):
            for part, own, entry, _ in _assigned(batch.column("vector"), codebooks):
                counts[part] += np.bincount(entry, minlength=len(counts[part]))
                added = np.zeros(sums[part].shape, dtype=own.dtype)
                np.add.at(added, entry, own)
                sums[part] += added
        part, entry = np.nonzero(counts)
        texts = [[str(x) for x in row] for row in sums[part, entry]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(texts, pa.list_(pa.string()))],
            ["part", "entry", "n", "sums"],
        )

    partial = vectors.select("vector").mapInArrow(run, "part int, entry int, n long, sums array<string>")
    components = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(codebooks.shape[2])]
    after = codebooks.copy()
    for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *components).collect():
        part, entry, n, *sums = row
        after[part, entry] = [int(s) // n for s in sums]
    return after


def learned(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    codebooks = initial(vectors, parts, entries)
    for _ in range(rounds if codebooks.shape[1] else 0):
        codebooks = moved(vectors, codebooks)
    return codebooks


def codes(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexed = np.array([f"{k:02x}" for k in range(codebooks.shape[1])], dtype=object)
        for batch in _cut(batches):
            text, error = np.full(batch.num_rows, "", dtype=object), np.zeros(batch.num_rows, dtype=object)
            for _, _, entry, distance in _assigned(batch.column("vector"), codebooks):
                text, error = text + hexed[entry], error + distance
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array([min(int(x), _LONG) for x in error], pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def fingerprint(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in codebooks.reshape(-1).tolist()).encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that takes part."""
    vectors = usable(embeddings)
    codebooks = learned(vectors, parts, entries, rounds)
    coded = stored(codes(vectors, codebooks), "vector-codes") if codebooks.shape[1] else codes(vectors, codebooks)
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    labels = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(codebooks)).alias("codebooks_sha256")
    )


def _round_sql(k: int) -> str:
    """Round k in SQL: assign to the entries c{k-1}, move them to c{k}."""
    return f"""
a{k} AS (
  SELECT x.r, x.p, x.x, min(list_sum(list_transform(list_zip(x.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {ENTRIES} + c.e) AS m
  FROM parts x JOIN c{k - 1} c USING (p) GROUP BY x.r, x.p, x.x
), s{k} AS (
  SELECT p, m % {ENTRIES} AS e, i, sum(x) AS s, count(*) AS n
  FROM (SELECT p, m, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY ALL
), m{k} AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{k} GROUP BY p, e
), c{k} AS (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{k - 1} c LEFT JOIN m{k} m ON c.p = m.p AND c.e = m.e
)"""


SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), size AS (SELECT CAST(ceil(max(len(v)) / {PARTS}) AS BIGINT) AS d FROM kept
), filled AS (SELECT r, list_resize(v, d * {PARTS}, CAST(0 AS BIGINT)) AS v, d FROM kept, size
), parts AS (SELECT r, p, list_slice(v, p * d + 1, p * d + d) AS x FROM filled, range({PARTS}) t(p)
), c0 AS (SELECT p, r AS e, x FROM parts WHERE r < {ENTRIES}
), {",".join(_round_sql(k) for k in range(1, ROUNDS + 2))},
coded AS (
  SELECT r, string_agg(printf('%02x', m % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error
  FROM a{ROUNDS + 1} GROUP BY r
), books AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM c{ROUNDS})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""
