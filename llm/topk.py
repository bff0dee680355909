"""Exact top-k search by columnar branch and bound.

Vectors become integers and lie dimension by dimension. For a query the inner
products are added up over blocks of dimensions, those with the query's largest
components first. What the rest of the dimensions can add is bounded by the product
of the remaining lengths (Cauchy-Schwarz); candidates whose upper bound is under
the k-th best lower bound are dropped, and the survivors are packed together.

Queries and candidates are cut into blocks, and a task gets one block of each, so
memory is bounded whatever their number. The best of each pair of blocks are
merged per query.

Defined results: vectors that are null or hold a null or non-finite component take no
part; missing dimensions of a shorter vector count as 0, and an empty vector has score
0 with every other; every row with a queried vec_id is a query of its own, and rows that repeat it
are among its candidates; ties go to the smaller vec_id; null vec_ids take no part; scores
outside a long become its ends; extra columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

K = 10
SCALE = 1024
EVERY = 100
DIMENSIONS = 16
CANDIDATES, QUERIES = 4096, 1024
_LONG = 2**63 - 1


def whole_numbers(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(1024 * x) of every component as a (dimension, vector) array, of int64 where that is exact."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    flat = np.asarray(lists.flatten(), dtype=np.float64)
    width = max(width or 0, int(sizes.max(initial=0)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if not len(flat) or np.abs(flat).max() < 2.0**40:
        out = np.zeros((width, len(sizes)), dtype=np.int64)
        out[place, owner] = np.floor(flat * SCALE).astype(np.int64)
        return out
    out = np.zeros((width, len(sizes)), dtype=object)
    with np.errstate(over="ignore"):
        out[place, owner] = [int(np.floor(x * SCALE)) if np.isfinite(x * SCALE) else int(x) * SCALE for x in flat]
    return out


def best(query: np.ndarray, table: np.ndarray, squares: np.ndarray, ids: np.ndarray, k: int, step: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best columns of ``table``, ties to the smaller id."""
    alive = np.arange(table.shape[1])
    score = np.zeros(len(alive), dtype=table.dtype)
    rest = squares.sum(axis=0)
    order = np.argsort(-np.abs(query).astype(float), kind="stable")
    for begin in range(0, len(order), step):
        dims = order[begin : begin + step]
        score = score + query[dims] @ table[np.ix_(dims, alive)]
        rest = rest - squares[np.ix_(dims, alive)].sum(axis=0)
        later = query[order[begin + step :]].astype(float)
        if len(alive) > k and len(later) and table.dtype != object:
            reach = np.sqrt(np.maximum(rest.astype(float), 0)) * np.sqrt((later**2).sum())
            exact = score.astype(float)
            slack = 1 + 1e-9 * (np.abs(exact) + reach)
            least = np.partition(exact - reach - slack, len(alive) - k)[len(alive) - k]
            keep = exact + reach + slack >= least
            if not keep.all():
                alive, score, rest = alive[keep], score[keep], rest[keep]
    if table.dtype == object:  # numbers beyond 64 bits: few, exact and slow, so nothing is dropped
        score = np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in score], dtype=object)
        top = sorted(range(len(alive)), key=lambda i: (-score[i], ids[alive[i]]))[:k]
    else:
        top = np.lexsort((ids[alive], -score))[:k]
    return ids[alive[top]], score[top]


def _pair(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if queries.num_rows and candidates.num_rows:
            q, c = whole_numbers(queries.column("vector")), whole_numbers(candidates.column("vector"))
            width = max(len(q), len(c))
            q, c = (np.pad(x, ((0, width - len(x)), (0, 0))) for x in (q, c))
            most = [int(np.abs(x).max(initial=0)) for x in (q, c)]
            if max(most) ** 2 * max(width, 1) >= 2**62:
                q, c = q.astype(object), c.astype(object)
            ids, squares = candidates.column("vec_id").to_numpy(), c * c
            asked = zip(*(queries.column(n).to_pylist() for n in ("vec_id", "content", "home")), strict=True)
            for i, (query_id, content, home) in enumerate(asked):
                # The query's own row may take a place in its own block, so one more is asked for.
                top = [(int(v), int(s)) for v, s in zip(*best(q[:, i], c, squares, ids, k + home), strict=True)]
                own = (query_id, max(-_LONG - 1, min(_LONG, int((q[:, i] * q[:, i]).sum()))))
                if home and own in top:
                    top.remove(own)
                found += [(query_id, content, vec_id, score) for vec_id, score in top[:k]]
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "content", "vec_id", "score"), columns, strict=True)})

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K, candidate_block: int = CANDIDATES, query_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vec_id, vector) rows of both sides; queries are rows of ``vectors`` too.

    Equal queries are asked once and their answers repeated.
    """
    content = F.xxhash64("vec_id", "vector")
    asked = queries.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies")).withColumn("content", content)
    n_candidates = max(1, -(-vectors.select("vec_id").count() // candidate_block))
    n_queries = max(1, -(-queries.select("vec_id").count() // query_block))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = F.pmod(content, F.lit(n_candidates)).cast("int")
    left = asked.select("vec_id", "vector", "content", block(n_queries).alias("q"), spread.alias("at"), every(n_candidates).alias("c"))
    left = left.select("vec_id", "vector", "content", (F.col("at") == F.col("c")).alias("home"), "q", "c")
    right = vectors.select("vec_id", "vector", spread.alias("c"), every(n_queries).alias("q"))
    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(_pair(k), "query_id long, content long, vec_id long, score long")
    place = Window.partitionBy("query_id", "content").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    repeated = asked.where("copies > 1").select(F.col("vec_id").alias("query_id"), "content", "copies")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1))))
    return ranked.join(repeated, ["query_id", "content"], "left").select("query_id", "rank", "vec_id", "score", copies.alias("copy")).drop("copy")


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )


def neighbours(embeddings: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    vectors = usable(embeddings)
    return search(vectors, vectors.where(F.col("vec_id") % every == 0), k)


SQL = f"""
WITH ok AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.r <> c.r WHERE q.vec_id % {EVERY} = 0
), n AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM n WHERE rank <= {K}
"""
