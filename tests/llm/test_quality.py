import math

import regex
from pyspark.sql import functions as F

from llm import quality
from cases import SMALL, awkward, empty, labels, rows_of

TREE = """DecisionTreeClassificationModel
  If (feature 2 <= 0.5)
   If (feature 0 <= 1.25)
    Predict: 0.0
   Else (feature 0 > 1.25)
    Predict: 1.0
  Else (feature 2 > 0.5)
   Predict: 1.0
"""


def test_paths_are_conjunctions():
    low, high = (2, "<=", 0.5), (2, ">", 0.5)
    assert quality.paths(TREE) == [(low,), ((0, "<=", 1.25), low), ((0, ">", 1.25), low), (high,)]


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs, known = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.rate(docs, known).join(known, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found) > 50
    other = known.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    few = docs.where("doc_id < 400")
    assert rows_of(quality.rate(few, other)) == rows_of(quality.rate(few, known))


def slow_statistics(text):
    """The ten figures of a text, counted letter by letter and word by word."""
    text = text or ""
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    lowered = {w for w in regex.split(r"[\x20\x09-\x0D]+", text.lower()) if w}
    share = lambda kind: sum(bool(regex.fullmatch(kind, c)) for c in text) / max(1, len(text))
    n = max(1, len(words))
    return [
        math.log1p(len(words)), len(text) / n, len(lowered) / n, share(r"\p{Lu}"), share(r"[^\p{L}\p{N}\s.,;:!?'\"()-]"), share("[!?]"), share(r"\p{N}"),
        sum(c in ".,;:" for c in text) / n, text.count("\n") / n, math.log1p(len(lowered)),
    ]


def test_scores_equal_the_rules_one_by_one(spark):
    docs, known = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    stats = quality.statistics(docs)
    model = quality.fit(stats, known.selectExpr("doc_id", "quality label"))
    assert model.weights
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in stats.select("*", model.score().alias("p")).collect():
        own = slow_statistics(texts[r.doc_id])
        assert all(abs(r[f"s{k}"] - x) < 1e-9 for k, x in enumerate(own))
        total = model.intercept + sum(w for rule, w in model.weights if all(r[f"s{k}"] <= b if sign == "<=" else r[f"s{k}"] > b for k, sign, b in rule))
        assert abs(r.p - 1 / (1 + math.exp(-total))) < 1e-12


def test_reruns_over_other_partitions_agree(spark):
    docs, known = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    found = [rows_of(quality.rate(d, known).selectExpr("doc_id", "round(score, 6) score", "predicted")) for d in (docs, docs.repartition(3))]
    assert [r[2] for r in found[0]] == [r[2] for r in found[1]]


def test_few_rules_are_kept_and_the_column_adds_them_up(spark):
    rule = ((0, "<=", 1.0), (1, ">", 2.0))
    model = quality.Ensemble(-1.0, [(rule, 3.0)])
    rows = spark.createDataFrame([(0.5, 3.0), (2.0, 3.0)], "s0 double, s1 double").select(model.score().alias("p")).collect()
    assert abs(rows[0].p - 0.880797) < 1e-6 and abs(rows[1].p - 0.268941) < 1e-6


def test_awkward_rows(spark):
    df = awkward(spark)
    for marks in (labels(spark), labels(spark).where("false")):
        found = quality.rate(df, marks).collect()
        assert len(found) == df.count() and all(0 <= r.score <= 1 for r in found)
    assert quality.rate(empty(spark), labels(spark)).collect() == []
