import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from llm import alignment
from cases import LONG, SMALL, awkward, empty
from test_piece_codec import TEXTS, noise

FIRST = Tokenizer.from_file(public_tokenizers.path(alignment.A))
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B))


def bytes_a():
    with open(public_tokenizers.path(alignment.A), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    known = {}
    for c in range(0x800):  # what the library puts for the two bytes of a letter, and for a byte of ASCII
        raw = chr(c).encode()
        known |= dict(zip(ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0], raw, strict=True)) if chr(c) else {}
    for c in (0x800, 0x1000, 0x2000, 0x3000, 0x4000, 0x5000, 0x6000, 0x7000, 0x8000, 0x9000, 0xA000, 0xB000, 0xC000, 0xD000, 0xE000, 0xF000, *range(0x10000, 0x110000, 0x10000), 0x40000, 0x80000, 0xC0000, 0x100000):
        known |= dict(zip(ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0], chr(c).encode(), strict=True))
    return {i: bytes(known[c] for c in t) for t, i in vocabulary.items() if t != "<|endoftext|>" and all(c in known for c in t)}


BYTES_A = bytes_a()


def bytes_b(i):
    piece = SECOND.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if SECOND.is_byte(i) else piece.replace("▁", " ").encode()


def slow_groups(text):
    """[(A ids, B ids)] of a text, token by token."""
    if not text:
        return []
    a, b = FIRST.encode(" " + text, add_special_tokens=False).ids, SECOND.encode(text)
    whole = (" " + text).encode()
    if b"".join(map(BYTES_A.__getitem__, a)) != whole or b"".join(map(bytes_b, b)) != whole:
        return []
    ends = []
    for ids, of in ((a, BYTES_A.__getitem__), (b, bytes_b)):
        at, own = 0, []
        for i in ids:
            at += len(of(i))
            own.append(at)
        ends.append(own)
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        x, y = i, j
        while i < len(a) and ends[0][i] <= end:
            i += 1
        while j < len(b) and ends[1][j] <= end:
            j += 1
        groups.append((a[x:i], b[y:j]))
    return groups


def slow(rows):
    count, links = Counter(), []
    for _, text in rows:
        groups = slow_groups(text)
        links.append((groups, [(a, b) for x, y in groups for a in x for b in y]))
        count.update(set(links[-1][1]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (key, _), (groups, pairs) in zip(rows, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            key, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(pairs), sum(count[p] == most[p[0]] for p in pairs),
            sum(count[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


STRANGE = TEXTS + noise(3, 300) + ["▁ marker", "İstanbul GELİ. ß ŉ ǆ", "aaa" * 200 + " b", "don't can't I'LL 've x's", "x" + "y z " * 500]


@pytest.mark.parametrize("kind", ["strange", "awkward", "documents"])
def test_statistics_of_every_document(spark, kind):
    if kind == "strange":
        docs = spark.createDataFrame([*enumerate(STRANGE), (7, "a repeat"), (7, "a repeat"), (None, None), (None, "no key")], "doc_id long, text string")
    elif kind == "awkward":
        docs = awkward(spark, 2)
    else:
        docs = spark.read.parquet(SMALL + "/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = alignment.statistics(docs.repartition(5))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == slow(rows)


def test_small_blocks_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([*enumerate(STRANGE)], "doc_id long, text string")
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 50)
    assert sorted(map(tuple, alignment.statistics(docs.repartition(5)).collect()), key=str) == slow([*enumerate(STRANGE)])


def test_groups_as_spans(spark):
    docs = spark.createDataFrame([*enumerate(STRANGE)], "doc_id long, text string")
    for r in alignment.align(docs).collect():
        groups, i, j = [], 0, 0
        for x, y in zip(r.a_sizes, r.b_sizes, strict=True):
            groups.append((r.a_ids[i : i + x], r.b_ids[j : j + y]))
            i, j = i + x, j + y
        assert groups == slow_groups(STRANGE[r.doc_id]) and i == len(r.a_ids) and j == len(r.b_ids)


def test_words_are_encoded_as_in_the_whole_text():
    own = alignment.ByteTokenizer(public_tokenizers.path(alignment.A))
    assert own.runs is not None and all(own.bytes[i] == b for i, b in BYTES_A.items())
    texts = STRANGE + noise(5, 20_000) + noise(6, 5000, "  \n\x85\xa0  　aé’'sdt1²ªº·×ßǅ͏日​.,!")
    block = alignment.align_block(pa.array(texts))
    ids = block.words.a.ids[alignment.gathered(block.words.a.first, block.place)]
    upto = alignment.bounds_of(np.diff(block.words.a.first)[block.place])[block.first]
    expected = [e.ids for e in FIRST.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    for k, text in enumerate(texts):
        assert ids[upto[k] : upto[k + 1]].tolist() == (expected[k] if text and "▁" not in text else [])


def test_whole_texts_where_words_cannot_be_cut(monkeypatch):
    docs = [t for t in STRANGE if t != LONG]
    monkeypatch.setattr(alignment, "_tokenizers", lambda a, b, f=alignment._tokenizers: (*f(a, b)[:2], ""))
    block = alignment.align_block(pa.array(docs))
    assert alignment.group_digests(block) == [
        hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest() if (g := slow_groups(t)) else "" for t in docs
    ]


def test_pieces_of_the_merge_are_equal_and_independent():
    rng = random.Random(9)
    for case in range(300):
        n = rng.randrange(1, 60)
        total = rng.randrange(n, 4 * n)
        a, b = (np.array(sorted({*rng.sample(range(1, total + 1), rng.randrange(0, n)), total})) for _ in range(2))
        steps = rng.choice([1, 2, 3, 7, 64])
        i, j = alignment.path_cuts(a, b, steps)
        assert (np.diff(i + j)[:-1] == steps).all() and 0 < (i + j)[-1] - (i + j)[-2] <= steps
        at_a, at_b, closes = alignment.overlaps(a, b, steps)
        begins = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
        expected = [(x, y, bool(a[x] == b[y])) for x in range(len(a)) for y in range(len(b)) if begins[0][x] < b[y] and begins[1][y] < a[x]]
        assert list(zip(at_a.tolist(), at_b.tolist(), closes.tolist(), strict=True)) == expected


def test_empty(spark):
    assert alignment.statistics(empty(spark)).collect() == [] and alignment.align(empty(spark)).collect() == []
