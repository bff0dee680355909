import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from llm import topk


def clip(score):
    return max(-(2**63), min(2**63 - 1, score))


def slow(rows, every, k):
    """All inner products in whole numbers."""
    whole = [(i, [math.floor(x * 1024) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(whole):
        if q % every == 0:
            others = whole[:at] + whole[at + 1 :]
            best = sorted((-clip(sum(a * b for a, b in zip(v, w, strict=False))), i) for i, w in others)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def vectors(n, size, seed):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0, 0.2) for _ in range(size)]) for k in range(n)]


CASES = {
    "plain": vectors(400, 40, 1),
    "ties": [(k, [0.5, -0.25, float(k % 3)]) for k in range(120)],
    "awkward": [*vectors(60, 5, 2), (None, [1.0] * 5), (70, None), (80, []), (90, [1.0, None, 0.0, 0.0, 0.0]), (100, [float("nan")] * 5), (110, [float("inf")] * 5), (40, [9.0] * 5), (41, [1.0, 2.0]), (41, [1.0, 2.0]), (50, [0.5] * 5), (50, [0.5] * 5), (50, [0.5] * 5), (130, []), (130, [])],
    "empty among full": [(0, [1.0, 2.0]), (1, []), (2, [-1.0, -1.0])],
    "repeats": [(k % 20, [0.5, float(k % 2)]) for k in range(80)],
    "few": vectors(4, 3, 3),
    "large": [(k, [2.0**45 * (k % 7 - 3), 1.0, -(2.0 ** (k % 5))]) for k in range(50)],
    "zero": [(k, [0.0, 0.0]) for k in range(30)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block", [4096, 16])
def test_all_products_say_the_same(spark, name, block):
    df = spark.createDataFrame(CASES[name], "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("vector", "q", "c", "score")})
    use = topk.usable(df)
    found = topk.search(use, use.where("vec_id % 10 = 0"), 10, candidate_block=block, query_block=max(2, block // 4))
    expected = slow(CASES[name], 10, 10)
    assert sorted(map(tuple, found.collect())) == expected


def test_sql_says_the_same(spark, folder):
    con = duckdb.connect()
    for name in ("awkward", "repeats", "empty among full"):
        df = spark.createDataFrame([(i, v) for i, v in CASES[name]], "vec_id long, embedding array<double>")
        df.write.parquet(folder(name))
        con.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{folder(name)}/*.parquet')")
        assert sorted(map(tuple, topk.neighbours(df).collect())) == sorted(con.sql(topk.SQL).fetchall()) == slow(CASES[name], 100, 10)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.neighbours(df).collect() == []
