import random
import time

from hypothesis import given, settings, strategies as st

from llm import tiling
from cases import awkward, empty, rows_of, sentence


def slow_tiles(document, item, least):
    """The longest common run of unmarked tokens, looked for place by place, until none is long enough."""
    least = max(1, min(least, len(item)))
    free_d, free_i, out = [True] * len(document), [True] * len(item), []
    while True:
        best = None
        for i in range(len(document)):
            for j in range(len(item)):
                n = 0
                while i + n < len(document) and j + n < len(item) and free_d[i + n] and free_i[j + n] and document[i + n] == item[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        i, j, n = best
        free_d[i : i + n] = [False] * n
        free_i[j : j + n] = [False] * n
        out.append(best)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=25), st.lists(st.integers(0, 4), min_size=1, max_size=15), st.integers(1, 4))
def test_tiles_equal_the_slow_ones(document, item, least):
    assert tiling.tiles(document, item, least) == slow_tiles(document, item, least)


def test_long_texts_take_little_more_than_their_length():
    rng = random.Random(4)
    item = [rng.randrange(10**6) for _ in range(20_000)]
    for document in (item, item[:9000] + [-2] + item[9000:], [-3] * 50 + item[::-1]):
        begin = time.process_time()
        found = tiling.tiles(document, item)
        assert time.process_time() - begin < 20
        assert sum(n for _, _, n in found) == (20_000 if document[1] == item[1] else 0)


def tables(spark):
    rng = random.Random(3)
    items = [sentence(rng, 40, 3000) for _ in range(6)] + ["only four words here", "", None]
    w = items[1].split()
    texts = {
        1: sentence(rng, 200, 3000),
        2: sentence(rng, 100, 3000) + " " + items[0].upper() + " " + sentence(rng, 50, 3000),
        3: " ".join(w[20:40] + ["between", "them"] + w[:20]),  # passages in another order
        4: " ".join(w[:15]),  # less than the threshold
        5: "before only four words here after",
        6: " ".join(items[2].split()[:30]),
    }
    docs = spark.createDataFrame([*texts.items(), (None, items[3]), (7, None), (8, ""), (2, texts[2])], "doc_id long, text string")
    return docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_matches_by_either_way(spark):
    docs, items = tables(spark)
    found = rows_of(tiling.matches(docs, items).select("doc_id", "item_id", "n_tiles", "longest"))
    expected = [(2, 0, 1, 40), (2, 0, 1, 40), (3, 1, 2, 20), (5, 6, 1, 4), (6, 2, 1, 30), (None, 3, 1, 40)]
    assert found == expected
    joined = tiling.matches(docs, items, broadcast_bytes=0).select("doc_id", "item_id", "n_tiles", "longest")
    assert rows_of(joined) == expected


def test_contaminated_documents_go(spark):
    docs, items = tables(spark)
    left = tiling.decontaminate(docs.unionByName(spark.createDataFrame([(None, "clean one")], docs.schema)), items)
    assert rows_of(left.select("doc_id")) == [(1,), (4,), (7,), (8,), (None,)]


def test_awkward_and_empty(spark):
    _, items = tables(spark)
    df = awkward(spark)
    assert tiling.decontaminate(df, items).schema == df.schema
    assert tiling.decontaminate(df, items).count() == df.count()
    assert tiling.matches(empty(spark), items).collect() == []
    assert tiling.matches(df, items.where("false")).collect() == []
