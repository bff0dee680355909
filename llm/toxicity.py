"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses. The tokens of a clause become tags (insult, harm,
intent, target, negation, reporting, quote) and run through a cascade of
letter-to-letter transducers: negation takes the following insults and harms
out of force, reporting weakens what is only quoted, intent turns a harm into a
threat, and a target makes an insult a directed one. Each tag that comes out has
a weight; a word alone has no score, the clause it stands in decides.

The insult words and word beginnings, and their weights, are learned from
labelled texts, beside the short lists below. A logistic curve over the clause
scores, fitted to the same texts, gives the score of a text. At most about
``LABELLED`` labelled texts, chosen by a hash of the key, are learned from, and the
``ENTRIES`` words and beginnings with the most evidence are kept.

Defined results: null, empty and wordless texts have no clause and get the
curve's lowest score; very long texts are read whole; rows that repeat a key are
scored each by itself; labels that are null, or contradict each other, are left
out; without labels of both kinds the built-in lists and weights decide; extra
columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.common import clear_labels, held_out, learned_from, stored
from llm.mixing import draw

LABELLED = 20_000
THRESHOLD = 0.5
FOLDS, HELD_OUT = 5, 0
#: Lengths of the word beginnings that may become entries.
STEMS = (4, 5, 6)
#: Evidence (natural logarithm of the odds against chance) and share of toxic texts that an entry needs.
EVIDENCE, LEAST_SHARE = 18.0, 0.8
ENTRIES = 2_000

INSULTS = "idiot idiots moron morons stupid loser losers scum pathetic worthless trash disgusting clown imbecile fool dumb bastard jerk creep vermin filth".split()
HARMS = "kill hurt destroy beat burn crush punish shoot stab strangle".split()
INTENTS = "will gonna shall must should going".split()
TARGETS = "you your you're he she they him her them his their people everyone du ihr sie tu vous usted ustedes".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't nicht kein nie pas jamais nunca".split()
REPORTS = "said says wrote writes called calls quoted claimed reported according asked told sagte schrieb disait dijo".split()
QUOTES = "\"“”«»„"

_CLAUSE_END = re.compile(r"[.!?;\n]")
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[" + QUOTES + "]")
_WORD = re.compile(r"[^\W\d_]{3,}")
OTHER, INSULT, HARM, INTENT, TARGET, NEGATION, REPORT, QUOTE = ".ihwtnrq"
#: What comes out: directed insult, threat, and insults and threats that are negated or reported.
WEIGHTS = {INSULT: 1.0, "D": 1.5, "T": 2.0, HARM: 0.2, "N": 0.1, "R": 0.35}


@dataclass(frozen=True)
class Transducer:
    """A letter-to-letter machine: (state, tag) -> (state, tag); ``fade`` says where other tags lead."""

    arcs: dict = field(hash=False)
    fade: dict = field(hash=False)
    start: str = "0"

    def step(self, state: str, tag: str) -> tuple[str, str]:
        return self.arcs.get((state, tag)) or (self.fade.get(state, state), tag)

    def __matmul__(self, after: "Transducer") -> "Composed":
        return Composed(self, after)


class Composed(Transducer):
    """Two machines in a row; a pair of their states is a state, built when it is first met."""

    def __init__(self, one: Transducer, two: Transducer) -> None:
        super().__init__({}, {}, (one.start, two.start))
        object.__setattr__(self, "one", one)
        object.__setattr__(self, "two", two)

    def step(self, state, tag):
        key = (state, tag)
        if key not in self.arcs:
            first, between = self.one.step(state[0], tag)
            second, out = self.two.step(state[1], between)
            self.arcs[key] = ((first, second), out)
        return self.arcs[key]


def _run(machine: Transducer, tags: list[str]) -> list[str]:
    state, out = machine.start, []
    for tag in tags:
        state, tag = machine.step(state, tag)
        out.append(tag)
    return out


def _scope(opens: str, length: int, inside: dict[str, str], start: str = "0") -> Transducer:
    """After ``opens``, for ``length`` tags, the tags of ``inside`` change."""
    states = [str(k) for k in range(length + 1)]
    arcs = {(s, opens): (states[-1], OTHER) for s in states}
    for s in states[1:]:
        arcs |= {(s, a): (states[int(s) - 1], b) for a, b in inside.items()}
    return Transducer(arcs, {s: states[int(s) - 1] for s in states[1:]}, start)


def grammar() -> tuple[Transducer, Transducer]:
    """The cascade that reads forwards, and the one that reads the result backwards for targets behind an insult."""
    negation = _scope(NEGATION, 3, {INSULT: "N", HARM: "N"})
    report = Transducer(
        {("0", REPORT): ("1", OTHER), ("0", QUOTE): ("2", OTHER), ("2", QUOTE): ("0", OTHER), ("1", QUOTE): ("1", OTHER), ("1", INSULT): ("1", "R"), ("1", HARM): ("1", "R"), ("2", INSULT): ("2", "R"), ("2", HARM): ("2", "R")},
        {},
    )
    threat = _scope(INTENT, 4, {HARM: "T"})
    target = Transducer(_scope(TARGET, 4, {INSULT: "D"}).arcs | {(str(s), "T"): (str(s), "T") for s in range(5)}, {str(s): str(s - 1) for s in range(1, 5)})
    keep = {(s, TARGET): ("4", TARGET) for s in "01234"}
    return negation @ report @ threat @ Transducer(target.arcs | keep, target.fade), target


@dataclass
class Model:
    insults: dict[str, float]
    """Words, and word beginnings that end in ``*``, with their weights."""
    curve: tuple[float, float, float] = (-3.0, 2.5, 1.0)


class Scorer:
    """Clause scores of texts under a model."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.forward, self.backward = grammar()
        self.tags = {w: HARM for w in HARMS} | {w: INTENT for w in INTENTS} | {w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS} | {q: QUOTE for q in QUOTES}
        self.words = {w: x for w, x in model.insults.items() if not w.endswith("*")}
        self.stems = {w[:-1]: x for w, x in model.insults.items() if w.endswith("*")}
        self.lengths = sorted({len(w) for w in self.stems})
        self.finder = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *HARMS}:
            self.finder.add_word(w, len(w))
        self.finder.make_automaton()

    def weight(self, token: str) -> float:
        return max([self.words.get(token, 0.0), *(self.stems.get(token[:n], 0.0) for n in self.lengths if len(token) >= n)])

    def clause(self, text: str) -> float:
        tokens = _TOKEN.findall(text)
        weights = [self.weight(t) for t in tokens]
        tags = [self.tags.get(t) or (INSULT if w else OTHER) for t, w in zip(tokens, weights, strict=True)]
        tags = _run(self.forward, tags)
        tags = _run(self.backward, tags[::-1])[::-1]
        return sum(WEIGHTS.get(t, 0.0) * (w or 2.0) for t, w in zip(tags, weights, strict=True))

    def features(self, text: str | None) -> tuple[float, float]:
        """log(1 + sum) and log(1 + largest) of the clause scores of a text."""
        if not text:
            return 0.0, 0.0
        text = text.lower()
        total = most = 0.0
        done = -1
        for end, n in self.finder.iter(text):
            at = end - n + 1
            if at < done or (at and text[at - 1].isalpha()):
                continue
            start = max((m for m in (text.rfind(c, 0, at) for c in ".!?;\n")), default=-1) + 1
            stop = _CLAUSE_END.search(text, end)
            done = stop.start() if stop else len(text)
            score = self.clause(text[max(start, 0) : done])
            total += score
            most = max(most, score)
        return math.log1p(total), math.log1p(most)

    def score(self, features: tuple[float, float]) -> float:
        a, b, c = self.model.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * features[0] + c * features[1]))))


def _entries(text: str | None) -> dict[str, int]:
    """The entries of a text, each with a bit (of 64) for the word before its first place."""
    words = _WORD.findall((text or "").lower())
    found: dict[str, int] = {}
    for before, word in zip(["", *words], words, strict=False):
        if word not in found:
            bit = 1 << (crc32(before.encode()) % 64)
            found[word] = bit
            for n in STEMS:
                if len(word) > n:
                    found.setdefault(word[:n] + "*", bit)
    return found


def _counts(labelled: DataFrame) -> DataFrame:
    """(entry, toxic, clean, places): in how many labelled texts an entry is, and how many
    different words stand before it in toxic ones (up to 64). Added up per task before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean, places = Counter(), Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                found = _entries(text)
                (toxic if label else clean).update(found.keys())
                if label:
                    for entry, bit in found.items():
                        places[entry] |= bit
        names = list(toxic.keys() | clean.keys())
        for k in range(0, len(names), 20_000):
            part = names[k : k + 20_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.string()),
                    pa.array([toxic[x] for x in part], pa.int64()),
                    pa.array([clean[x] for x in part], pa.int64()),
                    pa.array([places[x] - (1 << 64) * (places[x] >> 63) for x in part], pa.int64()),
                ],
                ["entry", "toxic", "clean", "places"],
            )

    rows = labelled.mapInArrow(run, "entry string, toxic long, clean long, places long")
    return rows.groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_count(F.bit_or("places")).alias("places")
    )


def lexicon(labelled: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries that are far more common in toxic texts than chance explains, shortest beginnings first."""
    base = n_toxic / (n_toxic + n_clean)
    # Near copies show an entry behind the same word, so no more texts count than there are different places.
    apart = F.when(F.col("places") >= 48, F.col("toxic")).otherwise(F.least(F.col("toxic"), -64 * F.log(1 - F.col("places") / 64)))
    n = apart + F.col("clean")
    share = F.least(apart / n, F.lit(1 - 1e-9))
    evidence = n * (share * F.log(share / F.lit(base)) + (1 - share) * F.log((1 - share) / F.lit(1 - base)))
    weight = F.log((apart + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    found = (
        _counts(labelled)
        .where((F.col("toxic") > 0) & (apart >= LEAST_SHARE * n))
        .select("entry", "toxic", evidence.alias("evidence"), weight.alias("weight"))
        .where((F.col("evidence") >= EVIDENCE) & (F.col("weight") > 0))
        .orderBy(F.desc("evidence"), "entry")
        .limit(ENTRIES)
        .collect()
    )
    # A beginning that nearly always goes on in one way gives way to the longer entry.
    longest: dict[str, int] = {}
    for row in found:
        word = row["entry"].rstrip("*")
        for n in range(1, len(word) + (not row["entry"].endswith("*"))):
            longest[word[:n]] = max(longest.get(word[:n], 0), row["toxic"])
    found = [r for r in found if not r["entry"].endswith("*") or longest.get(r["entry"][:-1], 0) < 0.9 * r["toxic"]]
    chosen: dict[str, float] = {}
    for row in sorted(found, key=lambda r: (not r["entry"].endswith("*"), len(r["entry"]), r["entry"])):
        word = row["entry"].rstrip("*")
        shorter = max((w for e, w in chosen.items() if e.endswith("*") and word.startswith(e[:-1])), default=None)
        if shorter is None or row["weight"] > shorter + 0.7:
            chosen[row["entry"]] = float(row["weight"])
    return chosen


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    penalty = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - penalty @ beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def _with_features(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The given columns of each row and its features ``total``, ``most`` and ``score``."""
    kept = docs.select(*columns, "text")
    schema = docs.select(*columns).schema.add("score", "double").add("total", "double").add("most", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            features = [scorer.features(t.as_py()) for t in texts]
            arrays = batch.columns[:-1] + [
                pa.array([scorer.score(f) for f in features], pa.float64()),
                pa.array([f[0] for f in features], pa.float64()),
                pa.array([f[1] for f in features], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "score", "total", "most"])

    return kept.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> Model:
    """Learn from labelled rows of (doc_id, text) and (doc_id, label). ``limit`` bounds how many, by a hash of the key."""
    clear = stored(clear_labels(labels), "labels")
    rows = clear.count()
    chosen = clear.where(draw(F.col("doc_id"), "labelled") < F.lit(min(1.0, limit / max(1, rows))))
    # About `limit` keys and labels of 12 bytes each, so this side is bounded by the parameter.
    labelled = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    built_in = {w: 4.0 for w in INSULTS}
    if not n_toxic or not n_clean:
        return Model(built_in)
    learned = lexicon(labelled, n_toxic, n_clean)
    model = Model({w: x for w, x in built_in.items() if w not in learned} | learned)
    seen = _with_features(labelled, model, ["label"]).select("label", "total", "most").toPandas()
    model.curve = _curve(seen[["total", "most"]].to_numpy(), seen["label"].to_numpy(dtype=float))
    return model


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """A model that has seen no label of the held-out rows."""
    return fit(docs, labels.where(learned_from("doc_id", FOLDS, HELD_OUT)).select("doc_id", F.col("toxic").alias("label")))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, total, most) of every row."""
    return _with_features(docs, model, ["doc_id"])


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = scores(docs, trained(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    schema = docs.schema
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            keep = [scorer.score(scorer.features(t.as_py())) < threshold for t in batch.column(place)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
