"""Quality by a sparse ensemble of rules.

Statistics of the whole texts are Spark columns. A small forest is grown on the
labelled rows; every path from a root is a rule, a conjunction of thresholds. A
logistic regression with an L1 penalty keeps few of the rules, and those are
compiled into one column expression. Growing and fitting run as Spark jobs over
all labelled rows.

Defined results: a null or empty text has statistics of 0 and is scored like
any other; labels that are null or contradict each other are left out; without
labels of both kinds the score is the share of good labels (0.5 without any);
rows that repeat a key are scored each by itself; extra columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from llm.common import clear_labels, held_out, learned_from, stored
from llm.mixing import word_count

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
TREES, DEPTH = 16, 3
PENALTY = 5e-4
SEED = 11

Condition = tuple[int, str, float]


def _share(pattern: str) -> Column:
    """The share of a text's characters that ``pattern`` (a class, repeated) covers."""
    rest = F.length(F.regexp_replace(F.col("text"), pattern, ""))
    return (F.length("text") - rest) / F.greatest(F.length("text"), F.lit(1))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, s0, s1, ...) from (doc_id, text): sizes, and shares of kinds of characters, words and lines."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    columns = {
        "words": word_count("text"),
        "chars": F.length("text"),
        "different": F.size(F.array_distinct(words)),
        "upper": _share(r"\p{Lu}+"),
        "symbols": _share(r"[^\p{L}\p{N}\s.,;:!?'\"()-]+"),
        "loud": _share("[!?]+"),
        "digits": _share(r"\p{N}+"),
        "ends": F.regexp_count(F.col("text"), F.lit(r"[.,;:]")),
        "lines": F.regexp_count(F.col("text"), F.lit("\n")),
    }
    raw = text.select("doc_id", *[c.alias(name) for name, c in columns.items()])
    per_word = lambda c: F.col(c) / F.greatest(F.col("words"), F.lit(1))
    shown = [
        F.log1p("words"),
        per_word("chars"),
        per_word("different"),
        F.col("upper"),
        F.col("symbols"),
        F.col("loud"),
        F.col("digits"),
        per_word("ends"),
        per_word("lines"),
        F.log1p("different"),
    ]
    return raw.select("doc_id", *[c.cast("double").alias(f"s{k}") for k, c in enumerate(shown)])


def paths(tree: str) -> list[tuple[Condition, ...]]:
    """The rules of a printed tree: the conditions on the way to each node but the root."""
    rules, way = [], []
    for line in tree.splitlines():
        found = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line)
        if found:
            depth = len(found[1])
            way = [step for step in way if step[0] < depth]
            way.append((depth, (int(found[2]), found[3], float(found[4]))))
            rules.append(tuple(sorted({step[1] for step in way})))
    return rules


def rule_column(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for k, sign, bound in rule:
        column = F.col(f"s{k}")
        out = out & (column <= F.lit(bound) if sign == "<=" else column > F.lit(bound))
    return out


#: Parts that labelled rows are dealt out to: so many at least, and one more for every so many rows.
LEAST_PARTS, ROWS_IN_PART = 8, 50_000


@dataclass
class Ensemble:
    intercept: float
    weights: list[tuple[tuple[Condition, ...], float]]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(stats: DataFrame, labels: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """Rules and weights from statistics and (doc_id, label)."""
    names = [c for c in stats.columns if c != "doc_id"]
    rows = stored(
        stats.join(clear_labels(labels), "doc_id").select("doc_id", F.col("label").cast("double").alias("label"), *names), "quality-labelled"
    )
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    good, bad = counts.get(1.0, 0), counts.get(0.0, 0)
    if not good or not bad:
        share = (good + 0.5) / (good + bad + 1) if good or bad else 0.5
        return Ensemble(float(_logit(share)), [])
    # Drawn rows and sums depend on where rows lie, so they are dealt out and ordered by their key and figures.
    rows = rows.repartition(max(LEAST_PARTS, (good + bad) // ROWS_IN_PART), "doc_id").sortWithinPartitions("doc_id", "label", *names)
    vectors = rows.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird").fit(vectors)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree.toDebugString)})
    if not rules:
        return Ensemble(float(_logit(good / (good + bad))), [])
    marked = rows.select("label", array_to_vector(F.array(*[rule_column(r).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60).fit(marked)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]
    return Ensemble(float(lasso.intercept), weights)


def _logit(p: float) -> float:
    return log(p / (1 - p))


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; labels of held-out rows are not seen."""
    stats = stored(statistics(docs), "statistics")
    model = fit(stats, labels.where(learned_from("doc_id", FOLDS, HELD_OUT)).select("doc_id", F.col("quality").alias("label")))
    scored = stats.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
