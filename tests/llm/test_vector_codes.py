import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import vector_codes
from cases import SMALL
from tools.check_parity import connect

LONG = 2**63 - 1


def slow(rows, parts=16, entries=64, rounds=2):
    """Every distance in Python's integers."""
    ok = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in ok), default=0) // parts) * parts
    d = width // parts
    whole = [[max(-LONG - 1, min(LONG, math.floor(x * 256))) for x in r[1]] + [0] * (width - len(r[1])) for r in ok]
    cut = [[v[p * d : p * d + d] for p in range(parts)] for v in whole]
    first = sorted(range(len(ok)), key=lambda k: (ok[k][0] is None, ok[k][0] or 0, ok[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p], c, strict=True)), e) for e, c in enumerate(books[p])) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, f in zip(cut, found, strict=True) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, by_label = [], {}
    for r, f in zip(ok, assign(), strict=True):
        error = min(LONG, sum(x for x, _ in f))
        by_label[r[2]] = by_label.get(r[2], 0) + error
        out.append((r[0], "".join(f"{e:02x}" for _, e in f), error, r[2]))
    return sorted(((k, c, e, min(LONG, by_label[lab]), sha) for k, c, e, lab in out), key=str)


def vectors(n, size, seed, scale=0.2):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0, scale) for _ in range(size)], k % 5 if k % 7 else None) for k in range(n)]


STRANGE = [
    (None, [1.0] * 20, 1), (None, [0.5] * 20, None), (500, None, 1), (501, [], 2), (502, [1.0, None], 1), (503, [float("nan")] * 20, 1),
    (504, [float("-inf")] * 20, 1), (3, [9.0] * 20, 1), (3, [0.1] * 20, 1), (3, [0.1] * 20, 1), (4, [0.25] * 7, None),
]
CASES = {
    "plain": vectors(300, 64, 1),
    "awkward": vectors(90, 20, 2) + STRANGE,
    "ties": [(k, [float(k % 3), -float(k % 2), 0.5, 0.5] * 16, k % 2) for k in range(150)],
    "few": vectors(5, 16, 3),
    "large": [(k, [2.0**40 * (k % 11 - 5) + j for j in range(32)], k % 3) for k in range(80)],
    "huge": [(k, [3e38 * (k % 5 - 2), 1.0] * 16, 1) for k in range(70)],
    "empty vectors": [(1, [], 1), (2, [], None)],
}


@pytest.mark.parametrize("name", CASES)
def test_all_distances_say_the_same(spark, name):
    df = spark.createDataFrame(CASES[name], "vec_id long, embedding array<double>, label int").withColumns({c: F.lit("own") for c in ("code", "Error", "vector", "of", "n")})
    assert sorted(map(tuple, vector_codes.compress(df.repartition(3)).collect()), key=str) == slow(CASES[name])


def test_other_sizes(spark):
    df = spark.createDataFrame(CASES["plain"], "vec_id long, embedding array<float>, label int")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in df.collect()]
    assert sorted(map(tuple, vector_codes.compress(df, 4, 300, 3).collect()), key=str) == slow(rows, 4, 300, 3)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(df).collect() == []
    only_bad = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert vector_codes.compress(only_bad).collect() == []


def test_search_stops_early_and_finds_the_lowest_of_equals():
    rng = np.random.default_rng(4)
    for d, spread in [(1, 3), (2, 4), (4, 60), (9, 500)]:
        entries, parts = rng.integers(-spread, spread, (64, d)), rng.integers(-spread, spread, (2000, d))
        apart = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        found, best = vector_codes.nearest(entries, parts)
        assert (found == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()
        assert [x.tolist() for x in vector_codes.nearest(entries.astype(object), parts)] == [found.tolist(), best.tolist()]


def test_sql_says_the_same(spark):
    found = vector_codes.compress(spark.read.parquet(SMALL + "/embeddings.parquet"))
    expected = connect(SMALL).sql(vector_codes.SQL).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
