"""Language identification by compression.

For each language a raw-content zstandard dictionary is filled with whole texts
of that language. A text's words, without signs and digits, are cut into pieces, all of
them are compressed with each dictionary, and the language with the smallest total is chosen. When
the runner-up is nearly as small the choice is marked as rejected.

What is learned is bounded: at most ``CANDIDATES`` texts per language, chosen by a
hash of the key, of which those that fit fill ``DICTIONARY`` bytes. Of a text of more than a quarter of
that, the letters at ``PLACES`` evenly spaced places are learned, an excerpt of a fixed size; it
is predicted whole like any other.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text when no language could be learned; equal sizes go to the
language first in code point order; rows that repeat a key are looked at each by
itself; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from llm.common import held_out, learned_from
from llm.mixing import draw

FOLDS, HELD_OUT = 3, 1
DICTIONARY = 96 << 10
CANDIDATES = 128
PLACES = 8
PIECE = 2048
LEVEL = 9
#: A choice is rejected when the runner-up is less than this share larger.
MARGIN = 0.01
#: Steepness of the score over the relative difference of the sizes.
STEEPNESS = 60.0
UNKNOWN = "und"
#: ASCII characters other than letters become blanks, which are then joined.
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def plain(text: str) -> bytes:
    """The lower-cased words of a text, without ASCII signs and digits."""
    return b" " + b" ".join(text.lower().encode().translate(_PLAIN).split()) + b" "


def _excerpt(text: Column, size: int) -> Column:
    """A text of up to ``size`` bytes as it is, of a longer one the letters at evenly spaced places, up to ``size`` bytes."""
    letters = F.regexp_replace(text, r"[^\p{L}\p{M}]+", " ")
    # A character has four bytes at most.
    width = size // 4 // PLACES
    step = (F.length(letters) - width) / F.lit(PLACES - 1)
    places = [F.substr(letters, F.floor(step * k).cast("int") + 1, F.lit(width)) for k in range(PLACES)]
    spaced = F.when(F.length(letters) <= width * PLACES, letters).otherwise(F.concat_ws(" ", *places))
    return F.when(F.octet_length(text) <= size, text).otherwise(spaced)


def samples(docs: DataFrame, candidates: int = CANDIDATES, size: int = DICTIONARY) -> dict[str, bytes]:
    """The words of texts of each language, whole or an excerpt, joined up to ``size`` bytes.

    Candidates are ranked inside every task before the shuffle, so a language
    with most of the rows sends no more than ``candidates`` keys per task.
    """
    known = docs.where(learned_from("doc_id", FOLDS, HELD_OUT) & F.col("lang").isNotNull())
    usable = known.where(F.col("text").rlike(r"\p{L}"))
    place = Window.partitionBy("lang").orderBy(draw(F.col("doc_id"), "language"), "doc_id")
    hashed = usable.withColumn("content", F.xxhash64("text"))
    # One text per key, so at most `candidates` rows per language, however often a key repeats.
    one = hashed.groupBy("doc_id", "lang").agg(F.min("content").alias("content"))
    keys = one.withColumn("n", F.row_number().over(place)).where(F.col("n") <= candidates)
    chosen = hashed.join(F.broadcast(keys), ["doc_id", "lang", "content"]).select("lang", "n", "doc_id", _excerpt(F.col("text"), size // 4).alias("text"))
    rows = chosen.groupBy("lang", "n", "doc_id").agg(F.min("text").alias("text")).collect()
    by_lang = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r["lang"], r["n"], r["text"])):
        by_lang[row["lang"]].append(plain(row["text"]))
    filled = {}
    for lang, texts in by_lang.items():
        content, used = [], 0
        for text in dict.fromkeys(texts):
            if used + len(text) < size:
                content.append(text)
                used += len(text)
        filled[lang] = b"".join(content)
    return {lang: content for lang, content in filled.items() if content}


def compressors(contents: dict[str, bytes], level: int = LEVEL) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang in sorted(contents, key=lambda x: x.encode()):
        shared = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=level)
        out.append((lang, zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=False, write_checksum=False)))
    return out


def choose(text: str | None, models: list[tuple[str, zstandard.ZstdCompressor]], piece: int = PIECE) -> tuple[str, float, bool]:
    """(language, score, rejected) of one whole text."""
    if not text or not models or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    data = plain(text)
    pieces = [data[k : k + piece] for k in range(0, len(data), piece)]
    sizes = []
    for lang, model in models:
        compress = model.compress
        sizes.append((sum(len(compress(p)) for p in pieces), len(sizes), lang))
    sizes.sort()
    best = sizes[0][0]
    score = 1 / sum(math.exp(-STEEPNESS * (n - best) / best) for n, _, _ in sizes)
    return sizes[0][2], score, len(sizes) > 1 and (sizes[1][0] - best) / best < MARGIN


def predictions(docs: DataFrame, contents: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of (doc_id, text)."""
    kept = docs.select("doc_id", "text")
    schema = docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = compressors(contents)
        for batch in batches:
            found = [choose(t.as_py(), models) for t in batch.column(1)]
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    found = predictions(docs, samples(docs))
    return found.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")
