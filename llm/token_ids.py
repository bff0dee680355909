"""Token ids of whole documents in compressed segments with an offset index.

Texts are encoded with a tokenizer of the ``tokenizers`` library and closed with
an end id. A zstandard dictionary is trained on serialized id arrays and shared
by all documents; each document is a frame of its own, so one short document is
read without its neighbours. A segment holds consecutive documents: their
frames in one value, their keys, offsets, counts and the place of the first id, and
the hash of the dictionary. Segments are rows of a Parquet table, so any file system
that Spark reaches can hold them and a lost task leaves nothing behind.

Serialized form: one byte for the width (2 or 4), then the ids as little-endian
unsigned integers of that width.

The dictionary is trained on at most ``SAMPLE`` documents, chosen by a hash of the
key, and at most ``SAMPLE_BYTES`` characters of each; it changes sizes, never ids.

Defined results: null texts are empty, and an empty text is its end id; null
keys come first; rows with equal keys are all kept, ordered by length and
content; extra columns are not read; an empty table makes an empty file set.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers.pre_tokenizers import ByteLevel

from llm.chunks import CUTS, chunked
from llm.common import stored, worker_memory
from llm.mixing import draw
from llm.words import blocks

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SAMPLE = 1000
SAMPLE_BYTES = 64 << 10
DICTIONARY = 64 << 10
LEVEL = 3
#: Bytes of frames in a segment; a longer document is a segment of its own.
SEGMENT = 1 << 20
#: Encodings of so many different words are remembered by a worker before it starts anew.
REMEMBERED = 600_000
_LETTER, _SIGN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[k for k in range(128) if chr(k).isalnum()]] = True
_SIGN[[k for k in range(33, 127) if not chr(k).isalnum() and chr(k) != "'"]] = True

#: Beyond the Latin, Greek and Cyrillic blocks, engines may differ in what they take for a letter.
_LAST_LETTER = "\u052F"

_SEGMENTS = "part int, seq long, dict_hash string, before long, first_key long, last_key long, doc_ids array<long>, offsets array<long>, counts array<long>, frames binary"


def tokenizer(path: str):
    kept = worker_memory()
    if ("tokenizer", path) not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if os.path.sep not in path:
            import public_tokenizers

            path, name = public_tokenizers.path(path), path
        else:
            name = path
        kept["tokenizer", name] = Tokenizer.from_file(path)
        kept["pieces", name] = [{}, {}]
        path = name
    return kept["tokenizer", path], kept["pieces", path]


def _between(data: np.ndarray) -> np.ndarray:
    """Places between ASCII letters and signs, where the tokenizer parts anyway.

    An apostrophe may belong to either side, and special tokens are no words: a block that may hold some is not parted.
    """
    if b"<|" in data.tobytes():
        return np.zeros(len(data) - 1, dtype=bool)
    letter, sign = _LETTER[data], _SIGN[data]
    return (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])


def _as_letters(word: str) -> str | None:
    """A word that nothing but its bytes' letters has to be put for, lowered, as the tokenizer's model takes it; else None.

    Letters only are one word to the tokenizer, which lowers it; a normalized one
    stays as it is, so the model can be asked straight away.
    """
    if not word.isalpha():
        return None
    if word.isascii():
        return word.lower()
    if max(word) > _LAST_LETTER or word != word.lower() or not is_normalized("NFC", word):
        return None
    kept = worker_memory().setdefault("byte letters", {})
    for c in set(word) - kept.keys():
        kept[c] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
    return "".join(map(kept.__getitem__, word))


def encode_words(words: list[str], path: str) -> list[bytes]:
    """The ids of different words, as little-endian unsigned 32-bit integers.

    A word goes through the tokenizer once; later blocks of the worker still know it,
    those that keep coming for good.
    """
    model, generations = tokenizer(path)
    if len(generations[0]) > REMEMBERED // 2:
        generations[:] = [{}, generations[0]]
    known, older = generations
    found = list(map(known.get, words))
    rest, ask = [], model.model.tokenize
    for k, ids in enumerate(found):
        if ids is None:
            if words[k] in older:
                found[k] = known[words[k]] = older[words[k]]
            elif (letters := _as_letters(words[k])) is not None:
                found[k] = known[words[k]] = array("I", [token.id for token in ask(letters)]).tobytes()
            else:
                rest.append(k)
    for k in range(0, len(rest), 10_000):
        part = rest[k : k + 10_000]
        for at, ids in zip(part, model.encode_batch_fast([words[at] for at in part], add_special_tokens=False), strict=True):
            found[at] = known[words[at]] = array("I", ids.ids).tobytes()
    return found


def encode(texts: pa.Array, path: str, end_id: int = END_ID) -> list[bytes]:
    """The ids of each text of a column and the end id, as little-endian unsigned 32-bit integers.

    The tokenizer splits at white space before anything else and drops it, so the
    pieces between blanks are encoded by themselves: each different one of the
    column once, and the ids are put back by position.
    """
    chunks = chunked(texts, inside=_between)
    ids = encode_words(pc.utf8_ltrim(chunks.distinct.cast(pa.large_string()), CUTS).to_pylist(), path)
    ids.append(array("I", [end_id]).tobytes())
    table = pa.array(ids, pa.large_binary())
    place = np.insert(chunks.place.astype(np.int64), chunks.first[1:], len(ids) - 1)
    taken = table.take(pa.array(place))
    bounds = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(place) + 1] if len(place) else np.zeros(1, np.int64)
    data = memoryview(taken.buffers()[2]) if len(place) else memoryview(b"")
    ends = bounds[chunks.first + np.arange(len(chunks.first))].tolist()
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def serialize(ids: bytes) -> bytes:
    values = np.frombuffer(ids, dtype="<u4")
    return b"\x02" + values.astype("<u2").tobytes() if not len(values) or values.max() < 1 << 16 else b"\x04" + ids


def deserialize(data: bytes) -> bytes:
    return np.frombuffer(data, dtype="<u2", offset=1).astype("<u4").tobytes() if data[:1] == b"\x02" else data[1:]


def train_dictionary(docs: DataFrame, path: str = TOKENIZER, sample: int = SAMPLE, size: int = DICTIONARY) -> bytes:
    """A dictionary from the id arrays of at most ``sample`` documents; of a longer text ``SAMPLE_BYTES`` characters from a place drawn by its hash."""
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_BYTES + 1, F.lit(1))).cast("int")
    usable = docs.where((F.octet_length("text") > 0) & F.col("doc_id").isNotNull()).withColumn("content", F.xxhash64("text"))
    keys = usable.select("doc_id", "content").distinct().orderBy(draw(F.col("doc_id"), "dictionary"), "doc_id", "content").limit(sample)
    excerpts = usable.join(F.broadcast(keys), ["doc_id", "content"]).select("doc_id", "content", F.expr("text").substr(at + 1, F.lit(SAMPLE_BYTES)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [serialize(x) for x in encode(batch.column("text"), path)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "ids"])

    chosen = excerpts.groupBy("doc_id", "content").agg(F.min("text").alias("text")).select("doc_id", "text")
    arrays = [bytes(r["ids"]) for r in sorted(chosen.mapInArrow(run, "doc_id long, ids binary").collect())]
    try:
        return zstandard.train_dictionary(size, arrays, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few or too short arrays to train on; their content serves as it is
        return b"".join(dict.fromkeys(arrays))[-size:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if len(content) >= 8 else None


def write(docs: DataFrame, target: str, path: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Encode (doc_id, text) and write ``target``/dictionary and ``target``/segments in ascending doc_id order."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    content = train_dictionary(texts, path)
    digest = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(digest, bytearray(content))], "dict_hash string, content binary").coalesce(1).write.parquet(f"{target}/dictionary")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = _dictionary(content)
        if shared:
            shared.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        for batch in batches:
            for part in blocks(batch, "text"):
                ids = encode(part.column("text"), path, end_id)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([press.compress(serialize(x)) for x in ids], pa.binary())],
                    ["doc_id", "n", "frame"],
                )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = before = 0
        for batch in batches:
            sizes = [len(x) for x in batch.column("frame").to_pylist()]
            begin = 0
            while begin < len(sizes):
                stop, held = begin + 1, sizes[begin]
                while stop < len(sizes) and held + sizes[stop] <= SEGMENT:
                    held += sizes[stop]
                    stop += 1
                part = batch.slice(begin, stop - begin)
                counts = part.column("n").to_pylist()
                offsets = np.concatenate([[0], np.cumsum(sizes[begin:stop])]).tolist()
                row = {
                    "part": part.column("part")[0].as_py(), "seq": seq, "dict_hash": digest, "before": before,
                    "first_key": part.column("doc_id")[0].as_py(), "last_key": part.column("doc_id")[-1].as_py(), "doc_ids": part.column("doc_id").to_pylist(),
                    "offsets": offsets, "counts": counts, "frames": b"".join(part.column("frame").to_pylist()),
                }
                yield pa.RecordBatch.from_pylist([row], schema=_segment_schema())
                seq += 1
                before += sum(counts)
                begin = stop

    encoded = stored(texts.mapInArrow(frames, "doc_id long, n long, frame binary"), "frames")
    order = [F.col("doc_id").asc_nulls_first(), F.col("n"), F.xxhash64("frame")]
    (
        encoded.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(segments, _SEGMENTS)
        .write.option("compression", "uncompressed")
        .parquet(f"{target}/segments")
    )


def _segment_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema(
        [("part", pa.int32()), ("seq", pa.int64()), ("dict_hash", pa.string()), ("before", pa.int64()), ("first_key", pa.int64()), ("last_key", pa.int64()), ("doc_ids", longs), ("offsets", longs), ("counts", longs), ("frames", pa.binary())]
    )


def dictionary_of(spark: SparkSession, target: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{target}/dictionary").first()
    return row["dict_hash"], bytes(row["content"])


def read(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, seq, offset) of every document, from the written files alone.

    ``start`` is the number of ids of all documents before; parts are added up
    from one row each, and their number is that of the writer's tasks.
    """
    digest, content = dictionary_of(spark, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_frame = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != digest:
                    raise ValueError(f"segment {row['part']}/{row['seq']} was written with dictionary {row['dict_hash']}")
                frames, offsets = memoryview(row["frames"]), row["offsets"]
                start, counts, sums = row["before"], [], []
                for a, b in zip(offsets, offsets[1:], strict=False):
                    ids = deserialize(open_frame.decompress(frames[a:b]))
                    counts.append(len(ids) // 4)
                    sums.append(zlib.crc32(ids))
                if counts != row["counts"]:
                    raise ValueError(f"segment {row['part']}/{row['seq']} does not hold the ids its index names")
                starts = (start + np.cumsum(counts) - counts).tolist()
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()),
                        pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int64()), pa.array(offsets[:-1], pa.int64()),
                    ],
                    ["doc_id", "in_part", "n_tokens", "ids_crc32", "part", "seq", "offset"],
                )

    segments = spark.read.parquet(f"{target}/segments")
    ends = segments.select("part", (F.col("before") + F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("upto"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.groupBy("part").agg(F.max("upto").alias("held")).select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("first"))
    found = segments.mapInArrow(run, "doc_id long, in_part long, n_tokens long, ids_crc32 long, part int, seq long, offset long")
    return found.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("first") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32", "part", "seq", "offset"
    )


def read_document(spark: SparkSession, target: str, doc_id: int) -> list[list[int]]:
    """The ids of the rows with this key: the index names the segments that can hold it, and one frame of each is opened."""
    _, content = dictionary_of(spark, target)
    rows = (
        spark.read.parquet(f"{target}/segments")
        .where((F.coalesce("first_key", F.lit(doc_id)) <= doc_id) & (F.col("last_key") >= doc_id))
        .select(F.posexplode("doc_ids").alias("i", "doc_id"), "offsets", "frames")
        .where(F.col("doc_id") == doc_id)
        .select(F.expr("substring(frames, int(offsets[i]) + 1, int(offsets[i + 1] - offsets[i]))").alias("frame"))
        .collect()
    )
    open_frame = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
    return [np.frombuffer(deserialize(open_frame.decompress(bytes(r["frame"]))), dtype="<u4").tolist() for r in rows]
