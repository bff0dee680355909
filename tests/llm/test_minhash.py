import random
import re

import pytest

from llm import minhash
from llm.components import components
from cases import awkward, empty, rows_of, sentence

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def slow(rows, percent):
    """Every pair of sets is compared."""
    sets = {}
    for key, text in rows:
        w = PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(key, []).append(runs)
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    every = [(k, s) for k, many in sets.items() for s in many if k is not None]
    for i, (a, s) in enumerate(every):
        for b, t in every[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    out = []
    for key, text in rows:
        w = PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else bool(w)
        out.append((key, int(n), None, True) if key is None else (key, int(n), root(key), root(key) == key))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def edited(rng, text, share):
    words = text.split()
    for k in range(len(words)):
        if rng.random() < share:
            words[k] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [256, 4])
def test_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    texts = []
    for _ in range(4):
        base = sentence(rng, 300, 5000)
        texts += [base, base.upper()] + [edited(rng, base, rng.choice([0.002, 0.01, 0.02, 0.05])) for _ in range(12)]
    chain = sentence(rng, 200, 5000)
    for _ in range(10):
        chain = edited(rng, chain, 0.008)
        texts.append(chain)
    texts += [sentence(rng, 80, 5000) for _ in range(20)] + ["", None, "two words", "Two  words", "one two three four five"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0]), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(df, 85)) == slow(rows, 85)


def test_one_key_with_several_texts(spark):
    rng = random.Random(8)
    a, b, c = (sentence(rng, 120, 5000) for _ in range(3))
    rows = [(1, a), (1, b), (2, edited(rng, a, 0.004)), (3, edited(rng, b, 0.004)), (9, b), (9, c), (9, None), (9, ""), (7, c), (8, "alone"), (8, None)]
    for shift in (0, 3):
        df = spark.createDataFrame([*rows[shift:], *rows[:shift]], "doc_id long, text string")
        found = rows_of(minhash.near_duplicates(df, 85))
        assert [r for r in found if r[1]] == [r for r in slow(rows, 85) if r[1]]
    assert {r[0]: r[2] for r in found if r[1]} == {1: 1, 2: 1, 3: 1, 9: 1, 7: 1, 8: 8}


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert rows_of(minhash.near_duplicates(df, 85)) == slow(rows, 85)
    kept = minhash.deduplicate(df)
    assert kept.schema == df.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [None, 1, 2, 3, 4, 5, 6, 8, -9]))
    assert minhash.near_duplicates(empty(spark)).collect() == [] and minhash.deduplicate(empty(spark)).collect() == []


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "x"), (None, "z"), (None, "z")], "doc_id long, text string")
    assert rows_of(minhash.deduplicate(df)) == rows_of(spark.createDataFrame([(1, "a b c d e f"), (1, "x"), (None, "z"), (None, "z")], df.schema))


def test_star_rounds_end_at_the_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root(x) for x in touched}
