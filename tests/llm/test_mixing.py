import duckdb
import pytest

from llm import mixing
from cases import awkward, empty, rows_of


def with_sql(df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "source", "text").toArrow())
    columns = "doc_id, size, source_size, target, taken, source, copies"
    return con.execute(f"SELECT {columns} FROM ({mixing.SQL})").fetchall()


@pytest.mark.parametrize("copies", [1, 5])
def test_sql_says_the_same(spark, copies):
    df = awkward(spark, copies)
    ours = rows_of(mixing.report(df))
    assert ours == sorted(with_sql(df), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_targets_fill_the_budget_under_the_caps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("b", 500), ("c", 300), (None, 90), ("e", 0)], "source string, size long")
    found = {r.source: r for r in mixing.source_targets(sizes).collect()}
    total = sum(r.source_size for r in found.values())
    assert sum(r.target for r in found.values()) == pytest.approx(1.5 * total)
    assert all(r.target <= 2 * r.source_size and r.rate <= 2 for r in found.values())
    assert found["a"].target == 20 and found["e"].rate == 0
    level = {s: found[s].target / w for s, w in (("b", 2), ("c", 1), (None, 2))}
    below = [s for s in level if found[s].target < 2 * found[s].source_size]
    assert len({round(level[s], 6) for s in below}) == 1


def test_mix_emits_the_copies_and_keeps_the_columns(spark):
    df = awkward(spark, 3)
    mixed = mixing.mix(df)
    assert mixed.schema == df.schema
    taken = {}
    for r in mixing.report(df).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in taken.items() if n}
    assert rows_of(mixed.select("doc_id", "size")) == rows_of(mixing.mix(df).select("doc_id", "size"))


def test_draws_follow_the_rate(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(mixing.copies(F.lit(1.3), F.col("id")).alias("n"))
    counts = {r.n: r["count"] for r in rows.groupBy("n").count().collect()}
    assert set(counts) == {1, 2} and abs(counts[2] / 20_000 - 0.3) < 0.015


def test_empty(spark):
    assert mixing.report(empty(spark)).collect() == [] and mixing.mix(empty(spark)).collect() == []
