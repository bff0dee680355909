import ast
import os

import corpus_pipeline
from llm import minhash, mixing, sharding, tiling, toxicity
from cases import SMALL, awkward, rows_of


def test_stages_in_turn_are_the_run(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    known = spark.read.parquet(SMALL + "/labels.parquet")
    items = spark.read.parquet(SMALL + "/benchmark.parquet")
    model = toxicity.trained(docs, known)
    bad = {r.doc_id for r in toxicity.scores(docs, model).where("score >= 0.5").collect()}
    one = docs.where(~docs.doc_id.isin(bad)) if bad else docs
    groups = {r.doc_id for r in minhash.near_duplicates(one, 80).where("kept").collect()}
    two = one.where(one.doc_id.isin(groups))
    leaks = {r.doc_id for r in tiling.matches(two, items).collect()}
    three = two.where(~two.doc_id.isin(leaks)) if leaks else two
    copies = {r.doc_id: r.copies for r in mixing.report(three).collect()}
    expected = sorted(k for k, n in copies.items() for _ in range(n))
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in found) == expected and bad and leaks
    shard = {r.doc_id: r.shard for r in sharding.place(docs.select("doc_id")).collect()}
    assert all(r.shard == shard[r.doc_id] for r in found)


def test_stages_keep_the_columns(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "benchmark", "mixture", "shards"]
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL)
        assert after.columns[: len(docs.columns)] == docs.columns
        assert (len(after.columns) == len(docs.columns)) == (name != "shards")
        assert rows_of(stage(spark, docs.where("false"), SMALL)) == []


def test_no_local_checkpoint_and_no_cross_join():
    folder = os.path.dirname(os.path.abspath(minhash.__file__))
    for name in os.listdir(folder):
        if name.endswith(".py"):
            tree = ast.parse(open(os.path.join(folder, name), encoding="utf-8").read())
            called = {n.attr for n in ast.walk(tree) if isinstance(n, ast.Attribute)}
            assert not called & {"localCheckpoint", "crossJoin", "rdd"}, name
