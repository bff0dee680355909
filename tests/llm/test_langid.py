import math

import zstandard
from pyspark.sql import functions as F

from llm import langid
from cases import SMALL, awkward, empty, rows_of


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found) > 200
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_languages_are_not_seen(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit("xx")).otherwise(F.col("lang")))
    assert rows_of(langid.identify(other)) == rows_of(langid.identify(docs))


def slow_choice(text, contents):
    """Every language's dictionary alone: sizes of the pieces added up, the smallest wins, then the first by name."""
    kept = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in (text or "").lower()).split()
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    data = (" " + " ".join(kept) + " ").encode()
    sizes = {}
    for lang, content in contents.items():
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=shared, write_content_size=False, write_checksum=False)
        sizes[lang] = sum(len(press.compress(data[k : k + langid.PIECE])) for k in range(0, len(data), langid.PIECE))
    best = min(sizes.values())
    return min(k for k, n in sizes.items() if n == best), 1 / sum(math.exp(-langid.STEEPNESS * (n - best) / best) for n in sizes.values())


def test_choice_equals_every_dictionary_by_itself(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "text", "lang", "source")
    docs = docs.unionByName(awkward(spark).select("doc_id", "text", "lang", "source").where("doc_id is null or doc_id < 0"))
    contents = langid.samples(docs)
    expected = {r.doc_id: slow_choice(r.text, contents) for r in docs.collect()}
    for r in langid.identify(docs.repartition(5)).collect():
        lang, score = expected[r.doc_id]
        assert r.lang_pred == lang and abs(r.score - score) < 1e-12


def test_letters_decide_whether_there_is_a_language(spark):
    df = awkward(spark)
    found = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(found) == df.select("doc_id").distinct().count()
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (1, 2, 3, -9))
    assert all(found[k].lang_pred in ("en", "de", "fr") for k in (4, 5, 8, None))
    assert not found[None].held_out
    assert langid.identify(empty(spark)).collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.identify(docs).collect()] == ["und", "und"]


def test_candidates_bound_what_is_learned(spark):
    docs = spark.createDataFrame([(k, f"some text {chr(97 + k % 26) * (1 + k // 26)}", "en") for k in range(50)], "doc_id long, text string, lang string")
    assert len(langid.samples(docs, candidates=3)["en"].split(b"some")) == 4


def test_a_language_with_long_texts_only_is_learned(spark):
    short = [(k, "the cat sat on the mat and looked at the rain " * 5, "en") for k in range(30)]
    # Over a quarter of the dictionary each; one hides its letters between signs.
    long = [(100 + k, "der hund lief durch den wald und bellte laut " * 800, "de") for k in range(30)]
    odd = [(200 + k, "7" * 30_000 + " il gatto dorme sul divano tutto il giorno " + "7" * 30_000, "it") for k in range(30)]
    docs = spark.createDataFrame(short + long + odd, "doc_id long, text string, lang string")
    filled = langid.samples(docs)
    assert set(filled) == {"en", "de", "it"} and all(len(x) <= langid.DICTIONARY for x in filled.values())
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert all(found[k] == "de" for k, _, _ in long) and all(found[k] == "it" for k, _, _ in odd)
