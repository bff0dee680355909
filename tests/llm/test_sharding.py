import hashlib
import os
import zlib
from collections import Counter

import pytest

from llm import sharding
from cases import awkward, empty


def slow_table(names, slots):
    """Each shard's whole permutation is written down, then the shards take turns."""
    number = lambda label, s: int.from_bytes(hashlib.blake2b(f"{label}:{s}".encode(), digest_size=8).digest(), "big")
    wishes = []
    for s in names:
        offset, skip = number("offset", s) % slots, number("skip", s) % (slots - 1) + 1
        wishes.append([(offset + j * skip) % slots for j in range(slots)])
    taken = {}
    while True:
        for i, wish in enumerate(wishes):
            slot = next(w for w in wish if w not in taken)
            taken[slot] = i
            if len(taken) == slots:
                return [taken[k] for k in range(slots)]


@pytest.mark.parametrize(("n", "slots"), [(1, 7), (3, 101), (7, 251)])
def test_table_equals_the_slow_one(n, slots):
    assert sharding.lookup_table(sharding.shard_names(n), slots) == slow_table(sharding.shard_names(n), slots)


def test_shares_are_even_and_a_lost_shard_moves_little():
    names = sharding.shard_names(16)
    full, less = sharding.lookup_table(names, 4099), sharding.lookup_table(names[:-1], 4099)
    sizes = Counter(full).values()
    assert max(sizes) - min(sizes) <= 1
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != 15)
    assert moved < 0.1 * 4099


def test_refused_tables():
    for names, slots in (([], 7), (["a", "a"], 7), (["a"], 9), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(names, slots)


def test_placement(spark, folder):
    df = awkward(spark, 2)
    placed = sharding.place(df)
    assert placed.columns[: len(df.columns)] == df.columns and len(placed.columns) == len(df.columns) + 2
    slot, shard = placed.columns[-2:]
    table = sharding.lookup_table(sharding.shard_names())
    rows = placed.collect()
    assert len(rows) == df.count() and all(table[r[slot]] == r[shard] for r in rows)
    assert all(len({r[shard] for r in rows if r.doc_id == k}) == 1 for k in {r.doc_id for r in rows})
    sharding.write_shards(placed, folder("shards"), parts=2, slot=slot, shard=shard)
    assert spark.read.parquet(folder("shards")).count() == len(rows)
    assert sharding.place(empty(spark)).collect() == []


def test_a_large_table_is_joined_without_a_hint(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BROADCAST_SLOTS", 10)
    few = sharding.place(awkward(spark).select("doc_id"), shards=["a", "b"], slots=101)
    assert few.count() == awkward(spark).count()


@pytest.mark.parametrize("kind", ["awkward", "empty"])
def test_shard_files_hold_every_row(spark, folder, kind):
    df = awkward(spark, 3) if kind == "awkward" else empty(spark)
    names = [f"s{k}" for k in range(5)]
    found = sharding.shard_files(df, folder("shards"), names).collect()
    table = sharding.lookup_table(names)
    assert all(r.shard == table[r.slot] for r in found)
    expected = [(r.doc_id, None, None) if r.text is None else (r.doc_id, len(r.text.encode()), zlib.crc32(r.text.encode())) for r in df.collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.text_crc32) for r in found), key=str) == sorted(expected, key=str)
    if found:
        assert {f.split("=")[1] for f in os.listdir(folder("shards")) if "=" in f} == {str(r.shard) for r in found}
