import re

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from llm.words import blocks, shingles, words_of

PATTERN = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain(text):
    return PATTERN.findall((text or "").encode().translate(UPPER))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \t\n\x0b\x1cé", max_size=40)), max_size=6))
def test_equal_words_have_equal_hashes_and_others_differ(texts):
    found = words_of(pa.array(texts, pa.string()))
    expected = [plain(t) for t in texts]
    assert found.count().tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    assert len(set(zip(flat, found.hashes.tolist(), strict=True))) == len(set(flat)) == len(set(found.hashes.tolist()))
    assert [found.data[a:b].tobytes() for a, b in zip(found.begin, found.end, strict=True)] == flat


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab  ", max_size=30)), max_size=5))
def test_shingles_are_runs_of_words(texts):
    hashes, first = shingles(words_of(pa.array(texts, pa.string())), 3)
    seen = {}
    for text, a, b in zip(texts, first, first[1:], strict=False):
        w = plain(text)
        runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([tuple(w)] if w else [])
        assert b - a == len(runs)
        for run, value in zip(runs, hashes[a:b].tolist(), strict=True):
            assert seen.setdefault(run, value) == value
    assert len(set(seen.values())) == len(seen)


def test_a_slice_of_a_column_and_a_small_block_give_the_same_hashes():
    texts = pa.array(["x", "a b", None, "c d e", ""] * 7)
    whole = words_of(texts).hashes.tolist()
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    parts = [h for part in blocks(batch, "text", 5) for h in words_of(part.column("text")).hashes.tolist()]
    assert parts == whole
    assert words_of(texts.slice(1, 2)).hashes.tolist() == words_of(pa.array(["a b", None])).hashes.tolist()
