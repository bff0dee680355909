"""Near-duplicate groups by MinHash.

Each text becomes the set of its distinct five-word shingles. Equal sets are
one class and go on as one representative. Many universal hash minima per set are
cut into bands; sets that agree in a band form candidate clusters. Inside a
cluster the signatures choose the pairs that can be similar enough, those are
confirmed on the full sets, and components are built from the confirmed links.

No pair is emitted before it is confirmed: a cluster is cut into blocks of
bounded size, a task gets two blocks, and of the links between them it
returns a spanning forest. Pairs that are connected already are not
compared again, which leaves the components as they are.

A pair at the similarity limit is missed by all bands with probability
``(1 - s**ROWS)**BANDS`` (7e-6 at 0.8, 3e-8 at 0.85), and by the signature filter,
set 4.5 standard deviations below the limit, with 4e-6.

Defined results: a text without words (or null) has an empty set and is
linked with nothing; a text with fewer words than a shingle is one shingle;
rows that repeat a key are the same document, whose texts are linked through it; a null key takes part in no
link, has no component and is kept; extra columns stay; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.common import fresh, stored
from llm.components import components
from llm.words import blocks, shingles, words_of

SHINGLE = 5
ROWS = 5
BANDS = 30
SEED = 20_240_607
#: Nodes in a block of a candidate cluster.
BLOCK = 256


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of n hash functions modulo 2**64."""
    numbers = np.random.default_rng(SEED)
    a = numbers.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)
    return a, numbers.integers(0, 1 << 64, n, dtype=np.uint64)


def minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set, in pieces that stay in the cache."""
    out = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(values), 256):
        piece = values[None, k : k + 256] * a[:, None]
        piece += b[:, None]
        np.minimum(out, piece.min(axis=1), out=out)
    return out


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in blocks(batch, "text"):
        hashes, first = shingles(words_of(part.column("text")), size)
        yield part, [np.unique(hashes[i:j]) for i, j in zip(first, first[1:], strict=False)]


def _fingerprint(sets: list[np.ndarray]) -> list[pa.Array]:
    """128 bits of each whole set, and its size."""
    weigh = _family(2)[0]
    f1 = np.array([int((s * weigh[0]).sum()) for s in sets], dtype=np.uint64)
    f2 = np.array([int(((s ^ (s >> np.uint64(29))) * weigh[1]).sum()) for s in sets], dtype=np.uint64)
    return [pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array([len(s) for s in sets], pa.int64())]


def signatures(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """(doc_id, f1, f2, n_shingles, sig) per row of (doc_id, text).

    ``f1`` and ``f2`` are a 128-bit fingerprint of the whole set; ``sig`` has 16 bits of each minimum, band by band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _family(rows * bands)
        for batch in batches:
            for part, sets in _sets(batch, size):
                low = np.stack([minima(s, a, b) for s in sets])
                short = (low ^ (low >> np.uint64(32))).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *_fingerprint(sets),
                        pa.array([x.tobytes() for x in short], pa.binary()),
                    ],
                    ["doc_id", *SET, "sig"],
                )

    return docs.mapInArrow(run, "doc_id long, f1 long, f2 long, n_shingles long, sig binary")


SET = ["f1", "f2", "n_shingles"]


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set that is not empty: its number, its smallest doc_id and its signature.

    Copies are folded inside each task before the shuffle.
    """
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy(*SET).agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig"))
    return classes.withColumn("node", F.monotonically_increasing_id())


def _same_set(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by the set's fingerprint; the left side's columns of it stay."""
    named = right.withColumnsRenamed({name: f"_{name}" for name in SET})
    joined = left.join(named, [F.col(name) == F.col(f"_{name}") for name in SET], how)
    return joined.drop(*[f"_{name}" for name in SET])


def _candidate_links(classes: DataFrame, rows_in_band: int, bands: int) -> DataFrame:
    """Links from each member of a band's bucket to the bucket's smallest member.

    A band's key is made from the bits of its minima that the signature holds; where those
    agree by chance, a pair more is looked at. The heads are written before they are joined, so Spark can split the rows of a large bucket.
    """
    width = 2 * rows_in_band
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda band: F.xxhash64(F.substr("sig", band * width + 1, F.lit(width))))
    rows = classes.select("node", F.posexplode(keys).alias("band", "key"))
    heads = stored(rows.groupBy("band", "key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "heads")
    return rows.join(heads, ["band", "key"]).where("node != head").select(F.col("node").alias("u"), F.col("head").alias("v")).distinct()


def _full_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(f1, f2, n_shingles, full): the whole sets of the texts whose doc_id stands for a candidate, made again from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _sets(batch, size):
                yield pa.RecordBatch.from_arrays(
                    [*_fingerprint(sets), pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())], [*SET, "full"]
                )

    wanted = docs.join(nodes.select(F.col("rep").alias("doc_id")).distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    return wanted.mapInArrow(run, "f1 long, f2 long, n_shingles long, full binary").dropDuplicates(SET)


def _confirm(members: DataFrame, pairs: DataFrame, percent: int, hashes: int) -> DataFrame:
    """Confirmed links (u, v) between the blocks named in ``pairs``.

    ``members``: (cluster, block, node, label, sig, full); ``pairs``: (cluster, b1, b2).
    """
    limit = percent / 100
    least = int(np.floor((limit - 4.5 * np.sqrt(limit * (1 - limit) / hashes)) * hashes))

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        order = np.argsort(node, kind="stable")
        order = order[np.concatenate([[True], np.diff(node[order]) != 0])]
        node = node[order]
        label = table.column("label").to_numpy()[order]
        left = table.column("block").to_numpy()[order] == table.column("b1").to_numpy()[order]
        within = bool((table.column("b1").to_numpy() == table.column("b2").to_numpy()).all())
        sig = np.stack([np.frombuffer(x, dtype="<u2") for x in table.column("sig").to_pylist()])[order]
        full = table.column("full").to_pylist()
        full = [np.frombuffer(full[i], dtype=np.uint64) for i in order]
        parent = list(range(len(node)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        seen: dict[int, int] = {}
        for i, one in enumerate(label.tolist()):
            parent[root(i)] = root(seen.setdefault(one, i))
        found = []
        for i in range(len(node) - 1):
            other = np.arange(i + 1, len(node))
            if not within:
                other = other[left[other] != left[i]]
            same = (sig[other] == sig[i]).sum(axis=1)
            keep = same >= least
            found += [(-int(s), i, int(j)) for s, j in zip(same[keep], other[keep], strict=True)]
        links = []
        for _, i, j in sorted(found):
            a, b = root(i), root(j)
            m, n = len(full[i]), len(full[j])
            if a == b or 100 * min(m, n) < percent * max(m, n):
                continue
            common = len(np.intersect1d(full[i], full[j], assume_unique=True))
            if 100 * common >= percent * (m + n - common):
                parent[max(a, b)] = min(a, b)
                links.append((int(node[i]), int(node[j])))
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    sided = pairs.select("cluster", "b1", "b2", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("block"))
    return members.join(sided, ["cluster", "block"]).groupBy("cluster", "b1", "b2").applyInArrow(run, "u long, v long")


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes (node, cluster) with ``label``: the component by the links so far, itself where it has none."""
    parts = components(links)
    return nodes.join(parts, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("label"))


def _blocks_by_label(labelled: DataFrame) -> DataFrame:
    """Blocks of a cluster: large labels get blocks of their own, the others share mixed ones.

    Adds ``block`` and ``pure`` (the label of such a block, else NULL). Block numbers
    are hashes of (label, number), so no list of a cluster's labels is needed.
    """
    large = labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n_label")).where(F.col("n_label") >= BLOCK // 2)
    split = labelled.join(large, ["cluster", "label"], "left")
    mixed = split.where("n_label is null").groupBy("cluster").agg(F.count(F.lit(1)).alias("n_mixed"))
    number = lambda n: F.pmod(F.xxhash64("node"), F.ceil(n / F.lit(BLOCK)))
    return split.join(mixed, "cluster", "left").select(
        "node",
        "cluster",
        "label",
        F.when(F.col("n_label").isNotNull(), F.xxhash64("label", number(F.col("n_label"))))
        .otherwise(number(F.col("n_mixed")))
        .alias("block"),
        F.when(F.col("n_label").isNotNull(), F.col("label")).alias("pure"),
    )


def near_duplicates(
    docs: DataFrame, percent: int = 80, size: int = SHINGLE, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Links are pairs of sets with ``100 * |intersection| >= percent * |union|``; the
    component is the smallest doc_id that links lead to.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(signatures(texts, size, rows, bands), "signatures")
    classes = stored(_classes(signed), "classes")
    of_rows = stored(
        _same_set(signed.select("doc_id", *SET, F.col("doc_id").isNotNull().alias("keyed")), classes.select(*SET, "node", "rep"), "left").select(
            "doc_id", "n_shingles", F.when(F.col("keyed"), F.col("node")).alias("node"), F.when(F.col("keyed"), F.col("rep")).alias("rep")
        ),
        "rows",
    )
    candidates = stored(_candidate_links(classes, rows, bands), "candidates")
    nodes = stored(components(candidates).withColumnRenamed("component", "cluster"), "clusters")
    sets = _full_sets(texts, classes.join(nodes, "node", "left_semi"), size)
    data = stored(_same_set(nodes.join(classes.select(*SET, "node", "sig"), "node"), sets).select("node", "cluster", "full", "sig"), "candidate-sets")
    # First every block against the one of the cluster's smallest node.
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("n"))
    home = F.when(F.col("node") == F.col("cluster"), F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), F.col("n")))
    members = data.join(sizes, "cluster").select("cluster", home.cast("long").alias("block"), "node", F.col("node").alias("label"), "sig", "full")
    first = sizes.select("cluster", F.lit(0).cast("long").alias("b1"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("b2"))
    links = stored(_confirm(members, first, percent, rows * bands), "links")
    # Then, in clusters of several blocks, all blocks against each other, but for those that are one component.
    several = sizes.where("n > 1").select("cluster")
    if not several.isEmpty():
        placed = stored(_blocks_by_label(_labels(nodes.join(several, "cluster", "left_semi"), links)), "blocks")
        kinds = placed.select("cluster", "block", "pure").distinct()
        pairs = (
            kinds.select("cluster", F.col("block").alias("b1"), F.col("pure").alias("p1"))
            .join(kinds.select("cluster", F.col("block").alias("b2"), F.col("pure").alias("p2")), "cluster")
            .where("b1 <= b2 and not coalesce(p1 = p2, false)")
            .select("cluster", "b1", "b2")
        )
        more = placed.select("cluster", "block", "node", "label").join(data.select("node", "sig", "full"), "node")
        links = links.union(stored(_confirm(more, pairs, percent, rows * bands), "links"))
    # A key with several texts is one document, which links their sets.
    several_sets = of_rows.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("most")).where("v < most").drop("most")
    found = components(links.union(of_rows.join(several_sets, "doc_id").where("node != v").select(F.col("node").alias("u"), "v").distinct()))
    least = found.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    of_nodes = found.join(least, "component").select("node", "component_id")
    component = F.coalesce("component_id", "rep", "doc_id")
    return of_rows.join(of_nodes, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The documents without near copies: of each group the one with the smallest key stays.

    Rows that repeat a key and a text leave one row.
    """
    found = stored(near_duplicates(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), percent), "near-duplicates")
    (gone,) = fresh(docs, "gone")
    kept = docs.join(found.where("not kept").select(F.col("doc_id").alias(gone)).distinct(), F.col(key) == F.col(gone), "left_anti")
    if found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    (salt,) = fresh(kept, "salt")
    return kept.withColumn(salt, F.when(F.col(key).isNull(), F.monotonically_increasing_id())).dropDuplicates([key, text, salt]).drop(salt)
