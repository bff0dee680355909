import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from llm import chunks, piece_codec
from cases import LONG, SMALL, awkward, empty, rows_of

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_codec.MODEL))
TEXTS = [
    "", " ", "  ", "\n", "\n\n", " \n ", "a", " a", "a ", "a  ", "  a   b \n\n  c\n", "a\nb", "a \nb", "a\n b", "\na", "a▁b", "a▁ b", "a▁  b", " ▁▁ a ▁", "▁", "▁\n▁",
    "x\x00y\tz \t w", "é café au lait à la é  à\n", "a  b　 c   d\x85 e  f", "<unk> <s></s> <0x41> <|endoftext|>", "日本語 の  文章。 次", "😀 \U0010ffff 👩‍👩‍👧", "\r\n\r\n x",
    "12 345  6789", "'s it's 's  's", "\x1c x\x1f y", LONG, "a" * 5000, " " * 3000, "\n" * 999 + "x", "ab " * 2000,
]


def noise(seed, n, alphabet=" \n\t▁ab'é.,1<>s日  \x00 \n"):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randrange(24))) for _ in range(n)]


def test_every_text_is_encoded_and_decoded_as_by_the_library():
    texts = TEXTS + noise(1, 20_000)
    ids = piece_codec.encoded(pa.array(texts))
    expected = [x + [2] for x in LIBRARY.encode(texts, num_threads=1)]
    assert ids.to_pylist() == expected
    assert piece_codec.decoded(ids).to_pylist() == [LIBRARY.decode(x) for x in expected]
    assert piece_codec.encoded(pa.array(texts[:50]), end=False).to_pylist() == [x[:-1] for x in expected[:50]]


def test_any_ids_are_decoded_as_by_the_library():
    rng = random.Random(2)
    some = [0, 1, 2, 3, 13, 35, 198, 172, 258, 259, 264, 28705, 28709, 29351]
    lists = [[rng.choice(some) if rng.random() < 0.7 else rng.randrange(32_000) for _ in range(rng.randrange(9))] for _ in range(5000)]
    assert piece_codec.decoded(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [LIBRARY.decode(x) for x in lists]
    assert piece_codec.decoded(pa.array([None, [264]], pa.list_(pa.int32()))).to_pylist() == [None, "a"]
    with pytest.raises(IndexError):
        piece_codec.decoded(pa.array([[32_000]], pa.list_(pa.int32())))


def test_whole_texts_where_words_cannot_be_cut(monkeypatch):
    own = piece_codec.codec(piece_codec.MODEL)
    assert own.cuts == chunks.CUTS
    expected = [x + [2] for x in LIBRARY.encode(TEXTS, num_threads=1)]
    for cuts in ("", " "):
        monkeypatch.setattr(own, "cuts", cuts)
        assert piece_codec.encoded(pa.array(TEXTS)).to_pylist() == expected


def test_each_distinct_word_is_listed_once():
    found = chunks.chunked(pa.array(["a b a b", None, "", "b\na  a"]))
    assert found.distinct.to_pylist() == [b" a", b" b", b"\na", b"  a"]
    assert found.place.tolist() == [0, 1, 0, 1, 1, 2, 3] and found.first.tolist() == [0, 4, 4, 4, 7]


def slow(docs):
    out = []
    for r in docs.select("doc_id", "text").collect():
        ids = LIBRARY.encode(r.text or "") + [2]
        out.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["awkward", "documents"])
def test_digests(spark, kind):
    docs = awkward(spark, 2) if kind == "awkward" else spark.read.parquet(SMALL + "/documents.parquet")
    found = piece_codec.digests(docs.repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == slow(docs)


def test_tables_keep_their_columns(spark):
    docs = awkward(spark).withColumn("ids", F.lit("other")).withColumn("Decoded", F.lit(1))
    coded = piece_codec.encode(docs)
    assert coded.columns == [*[c for c in docs.columns if c not in ("ids", "Decoded")], "Decoded", "ids"]
    back = piece_codec.decode(coded)
    assert [r.decoded for r in back.collect()] == [r.text or "" for r in docs.collect()]
    both = piece_codec.round_trip(docs)
    assert rows_of(both.select(back.columns)) == rows_of(back)
    assert piece_codec.digests(empty(spark)).collect() == [] and rows_of(piece_codec.encode(empty(spark))) == []
