import random

import pytest
from pyspark.sql import functions as F

from llm import toxicity
from cases import awkward, empty, labels, rows_of, sentence

SCORER = toxicity.Scorer(toxicity.Model({"idiot": 4.0, "moron": 4.0, "zurk*": 5.0}))


@pytest.mark.parametrize(
    ("weaker", "stronger"),
    [
        ("he is not an idiot", "he is an idiot"),
        ("the article said idiot", "the article idiot"),
        ("“what an idiot” is a line", "what an idiot is a line"),
        ("idiot", "you idiot"),
        ("the fire may burn", "we will burn you"),
        ("we will not kill anyone", "we will kill everyone"),
        ("an idiot", "idiot idiot"),
        ("a tree", "zurkling"),
    ],
)
def test_clauses(weaker, stronger):
    assert SCORER.clause(weaker) < SCORER.clause(stronger)


def test_targets_count_on_both_sides():
    assert SCORER.clause("you idiot") == SCORER.clause("idiot you") > SCORER.clause("idiot table")


def test_negation_ends_with_the_clause():
    split, joined = SCORER.features("not good. idiot")[0], SCORER.features("not good idiot")[0]
    assert split > joined
    assert SCORER.features("idiotic") == SCORER.features("superidiot") == SCORER.features("") == SCORER.features(None) == (0.0, 0.0)


def corpus(spark, n=600, flip=None):
    rng = random.Random(2)
    docs, marks = [], []
    for k in range(n):
        words = sentence(rng, 60, 2000).split()
        toxic = int(k % 7 == 0)
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(60), "gromp" + "".join(rng.choices("abcdef", k=3)))
        docs.append((k, " ".join(words)))
        marks.append((k, toxic))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(marks, "doc_id long, toxic int").withColumn("quality", F.lit(1))
    return df, known


def test_learned_beginnings_find_held_out_texts(spark):
    docs, known = corpus(spark)
    model = toxicity.trained(docs, known)
    assert "gromp*" in model.insults or "grom*" in model.insults
    found = toxicity.rate(docs, known).join(known, "doc_id").where("held_out").collect()
    assert len(found) > 80 and sum(r.predicted != r.toxic for r in found) <= 1
    other = known.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity.rate(docs, other)) == rows_of(toxicity.rate(docs, known))
    left = toxicity.reject(docs, model)
    assert left.schema == docs.schema and 0.8 * 600 < left.count() < 0.9 * 600


def test_awkward_rows(spark):
    df = awkward(spark)
    for marks in (labels(spark), labels(spark).where("false")):
        found = toxicity.rate(df, marks).collect()
        assert len(found) == df.count() and all(0 <= r.score <= 1 for r in found)
    kept = toxicity.reject(df, toxicity.Model({"idiot": 4.0}))
    assert kept.schema == df.schema and kept.count() == df.count()
    assert toxicity.rate(empty(spark), labels(spark)).collect() == []
