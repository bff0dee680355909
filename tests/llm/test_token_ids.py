import random
import unicodedata
import zlib
from array import array

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import token_ids
from cases import SMALL, awkward, empty


def expected(df):
    model = Tokenizer.from_file(public_tokenizers.path(token_ids.TOKENIZER))
    rows = [(r.doc_id, [*model.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in df.select("doc_id", "text").collect()]
    return sorted((k is not None, k or 0, ids) for k, ids in rows)


@pytest.mark.parametrize("kind", ["awkward", "documents"])
def test_files_hold_what_the_tokenizer_says(spark, folder, kind):
    df = awkward(spark, 2) if kind == "awkward" else spark.read.parquet(SMALL + "/documents.parquet").where("doc_id < 60")
    token_ids.write(df.repartition(3), folder("ids"))
    found = token_ids.read(spark, folder("ids")).collect()
    slow = expected(df)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (a, k, len(ids), zlib.crc32(array("I", ids).tobytes())) for a, k, ids in slow
    )
    place = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    keys = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    some = next(k for _, k, ids in slow if len(ids) > 5)
    assert sorted(token_ids.read_document(spark, folder("ids"), some)) == sorted(ids for a, k, ids in slow if a and k == some)


def test_pieces_between_blanks_are_encoded_as_the_whole():
    model = Tokenizer.from_file(public_tokenizers.path(token_ids.TOKENIZER))
    for text in ["It's a  test\x1cit\x85s", "é ́x\n̈", "<|startoftext|>a <|endoftext|> b", "\t \x0b\x0c", "’s 's're ÄÖ ﬁ", "", "naïve ÉCOLE école ǆ İi ſ ß ẞ ΣΑΣ σας 日本 e\u0301 ñ.# x2,, ..a"]:
        ids = array("I")
        ids.frombytes(token_ids.encode(pa.array([text]), token_ids.TOKENIZER)[0])
        assert ids.tolist() == [*model.encode(text, add_special_tokens=False).ids, 1]


def test_every_letter_with_signs_behind_it():
    model = Tokenizer.from_file(public_tokenizers.path(token_ids.TOKENIZER))
    letters = [chr(k) for k in range(0x80, 0x110000) if not 0xD800 <= k < 0xE000 and unicodedata.category(chr(k))[0] in "LMN"]
    texts = [t for c in letters for t in (f"GE{c}.", f"{c}!?x {c}, {c}")]
    texts += ["".join(random.Random(k).choices([*".,!-x İ", *letters], k=6)) for k in range(20_000)]
    expected = [array("I", [*e.ids, 1]).tobytes() for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    wrong = [t for t, a, b in zip(texts, token_ids.encode(pa.array(texts), token_ids.TOKENIZER), expected, strict=True) if a != b]
    assert not wrong


def test_long_texts_train_the_dictionary(spark):
    assert len(token_ids.train_dictionary(awkward(spark).where("doc_id = 8").select("doc_id", "text"))) > 1000


def test_one_row_of_a_repeated_key_and_text_is_drawn(spark, monkeypatch):
    df = spark.createDataFrame([(1, "the same text"), (1, "another text")] * 300, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(token_ids.zstandard, "train_dictionary", lambda size, arrays, level: seen.append(len(arrays)) or token_ids.zstandard.ZstdCompressionDict(b"x" * 64))
    token_ids.train_dictionary(df)
    assert seen == [2]


def test_small_segments_and_a_small_memory_change_nothing(spark, folder, monkeypatch):
    df = spark.read.parquet(SMALL + "/documents.parquet").where("doc_id < 25").coalesce(1)
    token_ids.write(df, folder("one"))
    monkeypatch.setattr(token_ids, "SEGMENT", 500)
    monkeypatch.setattr(token_ids, "REMEMBERED", 10)  # on the driver; the function that travels takes it along
    token_ids.write(df, folder("many"))
    kept = ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(token_ids.read(spark, folder("one")).select(*kept).collect()) == sorted(token_ids.read(spark, folder("many")).select(*kept).collect())
    assert spark.read.parquet(folder("many") + "/segments").count() > 10


def test_damage_is_noticed(spark, folder):
    token_ids.write(awkward(spark), folder("ids"))
    spark.read.parquet(folder("ids") + "/segments").withColumn("dict_hash", F.lit("other")).write.parquet(folder("bad") + "/segments")
    spark.read.parquet(folder("ids") + "/dictionary").write.parquet(folder("bad") + "/dictionary")
    with pytest.raises(Exception, match="dictionary other"):
        token_ids.read(spark, folder("bad")).collect()


def test_empty(spark, folder):
    token_ids.write(empty(spark), folder("ids"))
    assert token_ids.read(spark, folder("ids")).collect() == []
