"""MinHash near-dedup with sequential Bayesian verification.

A text's set holds the hashes of its distinct k-word shingles. Documents with
equal sets form one node, so copies cost nothing further. Nodes that agree in
a band of their MinHash signature are candidates; a candidate pair's
signatures are compared batch by batch and the pair is dropped as soon as the
posterior probability (uniform prior) that its similarity reaches the
threshold falls below ``MISS``. Survivors are verified exactly on full sets.

No bucket is expanded into all pairs. First every node is compared with the
smallest node of each of its buckets; links found join nodes into components.
After that only buckets that still hold several components are looked at, once:
inside a task the signatures of nodes in different components are compared
batch by batch, survivors are verified on the full sets right there, and a
link joins their components, so a bucket of n like nodes costs few
verifications while every plausible pair of nodes in different components is
verified. Only links leave the task, never candidates. Buckets are cut into
blocks of about ``BLOCK`` nodes and ``BLOCK_SHINGLES`` shingles, dealt in
pairs of blocks.
With 28 bands of 4 rows a pair at similarity 0.8 shares no band with
probability (1 - 0.8**4)**28 < 1e-6.

Defined cases: null texts, empty texts and texts without words have an empty
set and link with nothing; a text with fewer than k words has its whole
sequence as its one shingle; rows without doc_id link with nothing, their
component is null and they are kept; rows with the same doc_id count as one
document; repeated rows get the same result each; an empty table gives no
rows; other columns are not read (``keep_one`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import (
    components, lower, materialise, mix, prefix_hashes, read, shingle_hashes, span_hash, text_chunks, words)

SHINGLE = 5
THRESHOLD = 80  # per cent
BANDS, ROWS = 28, 4
#: Signature length; one byte of each minimum is kept for the comparison.
HASHES, BATCH = 256, 32
#: Chance of dropping a pair that reaches the threshold, per comparison step.
MISS = 1e-4
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20

_A = mix(np.arange(1, HASHES + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_B = mix(np.arange(1001, HASHES + 1001, dtype=np.uint64)).astype(np.uint32)


def sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, offs in text_chunks(column):
        data = lower(data)
        starts, ends, first = words(data, offs)
        w = span_hash(prefix_hashes(data), starts, ends)
        for a, b in zip(first[:-1], first[1:]):
            yield np.unique(shingle_hashes(w[a:b], k))


def node_of(s: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of HASHES keyed permutations of the set, in slices that bound the memory."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        h = _A[:, None] * x[None, at:at + 1024] + _B[:, None]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        np.minimum(low, h.min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One key per band of ROWS minima."""
    m = low[:BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    h = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for r in range(ROWS):
        h = mix(h ^ (m[:, r] + np.uint64(r + 1)))
    return h.view(np.int64)


def sketch(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, node, band keys and signature bytes of every document; one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, node, keys, sig = [], [], [], []
            for s in sets(b.column(1), k):
                low = signature(s)
                n.append(len(s))
                node.append(node_of(s))
                keys.append(band_keys(low) if len(s) else None)
                sig.append(low.astype(np.uint8).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "node", "bands", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, node bigint, bands array<bigint>, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


@cache
def least_agreeing(n: int) -> int:
    """Fewest agreements of n hashes with P(similarity >= threshold | agreements) >= MISS.

    With a uniform prior the posterior after m of n agreements is
    Beta(m + 1, n - m + 1), whose tail above t is P(Binomial(n + 1, t) <= m).
    Unequal minima agree in one byte once in 256 cases, which raises t.
    """
    t, below = THRESHOLD / 100, 0.0
    t += (1 - t) / 256
    for m in range(n + 1):
        below += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        if below >= MISS:
            return m
    return n


def agreeing(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of y whose signature stays plausible against x batch by batch, and their agreements."""
    left, same = np.arange(len(y)), np.zeros(len(y), np.int64)
    for at in range(0, HASHES, BATCH):
        same = same + (y[left, at:at + BATCH] == x[at:at + BATCH]).sum(axis=1)
        keep = same >= least_agreeing(min(at + BATCH, HASHES))
        left, same = left[keep], same[keep]
    return left, same


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the sequential comparison of their signatures does not drop."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = _matrix(b.column(2)), _matrix(b.column(3))
                left, same = np.arange(len(x)), np.zeros(len(x), np.int64)
                for at in range(0, HASHES, BATCH):
                    same = same + (x[left, at:at + BATCH] == y[left, at:at + BATCH]).sum(axis=1)
                    keep = same >= least_agreeing(min(at + BATCH, HASHES))
                    left, same = left[keep], same[keep]
                yield b.select(["a", "b"]).take(pa.array(left))

    sig = nodes.select("node", "n_shingles", "sig")
    joined = pairs.join(sig.toDF("a", "na", "sa"), "a").join(sig.toDF("b", "nb", "sb"), "b")
    # The intersection is at most the smaller set, the union at least the larger.
    near = joined.where(f"100 * least(na, nb) >= {THRESHOLD} * greatest(na, nb)")
    return near.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def links_inside(rows: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Links (a, b) between nodes of different components that share a bucket; enough of them to join the components.

    A pair that shares several bands is looked at in the first of them only.
    Buckets are dealt in pairs of blocks, so a group holds at most about two
    blocks.
    """
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        comp = np.unique(table.column("comp").to_numpy(), return_inverse=True)[1].reshape(-1)
        size, sig = table.column("n_shingles").to_numpy(), _matrix(table.column("sig").combine_chunks())
        whole = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("whole")]
        side, i, j = table.column("part").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        here = int(np.flatnonzero((bands == table.column("band")[0].as_py()).all(axis=0))[0])
        most = np.bincount(comp).argmax()
        # From each node outside the most frequent component: that component and the nodes that come later.
        index, rest = np.arange(len(node)), np.flatnonzero(comp != most)
        first = comp == most
        out = ([], [])
        for x in rest.tolist():
            other = (comp != comp[x]) & (first | (index > x)) & (100 * np.minimum(size, size[x]) >= THRESHOLD * np.maximum(size, size[x]))
            y = np.flatnonzero(other & (side != side[x]) if i != j else other)
            y = y[~(bands[y, :here] == bands[x, :here]).any(axis=1)]
            near, same = agreeing(sig[x], sig[y])
            for z in y[near[np.argsort(-same, kind="stable")]].tolist():
                if comp[z] != comp[x]:
                    both = len(np.intersect1d(whole[x], whole[z], assume_unique=True))
                    if 100 * both >= THRESHOLD * (size[x] + size[z] - both):
                        out[0].append(min(int(node[z]), int(node[x])))
                        out[1].append(max(int(node[z]), int(node[x])))
                        comp[comp == comp[z]] = comp[x]
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    load = rows.join(nodes.select("node", "n_shingles"), "node").groupBy("band").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    parts = load.select("band", F.expr(f"cast(ceil(greatest(n / {BLOCK}, total / {BLOCK_SHINGLES})) as int)").alias("parts"))
    held = rows.select("band", "node", "comp").join(parts, "band").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    held = held.withColumn("with", F.explode(F.expr("sequence(0, parts - 1)")))
    held = held.withColumn("i", F.least("part", "with")).withColumn("j", F.greatest("part", "with"))
    full = texts_of(rows.select("node").distinct(), nodes, docs, k).mapInArrow(_sets(k), "node bigint, whole binary")
    own = nodes.select("node", "n_shingles", "bands", "sig").join(full, "node")
    return held.select("band", "node", "comp", "part", "i", "j").join(own, "node").groupBy(
        "band", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets(b.column(1), k)], pa.binary())], ["node", "whole"])

    return run


def texts_of(needed: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(node, text) of the rows ``needed`` (node): the whole text of one document each."""
    # A doc_id with several texts may bring the wrong one: the set decides.
    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [node_of(s) == n for s, n in zip(sets(b.column(1), k), b.column(0).to_pylist())]
            yield b.filter(pa.array(own, pa.bool_()))

    texts = docs.select("doc_id", "text").join(needed.join(nodes.select("node", "doc_id"), "node"), "doc_id")
    return texts.select("node", "text").mapInArrow(right, "node bigint, text string").groupBy("node").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The pairs whose full sets reach the threshold, from the whole texts of one document per node."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit, kept = [], {}
            for side, text in ((0, 2), (1, 3)):
                ids = b.column(side).to_numpy()
                new, at = np.unique(ids, return_index=True)
                kept.update(zip(new.tolist(), sets(b.column(text).take(pa.array(at)), k)))
            for i, j in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x, y = kept[i], kept[j]
                both = len(np.intersect1d(x, y, assume_unique=True))
                hit.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
            yield b.filter(pa.array(hit, pa.bool_())).select(["a", "b"])

    texts = materialise(texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), nodes, docs, k))
    return pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb").mapInArrow(
        check, "a bigint, b bigint")


def link(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    sketches = materialise(sketch(docs, k))
    nodes = materialise(sketches.where("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    every = nodes.select("node", F.explode("bands").alias("band"))
    shared = every.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1")
    rows = materialise(every.join(shared, "band"))
    pairs = rows.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    seen = materialise(plausible(pairs, nodes))
    links = materialise(verified(seen, nodes, docs, k))
    comps = components(links)
    # A bucket of two is settled by its first comparison.
    own = rows.where("n > 2").select("band", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = own.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("band")
    new = materialise(links_inside(materialise(own.join(mixed, "band")), nodes, docs, k))
    if not new.isEmpty():
        links = links.unionByName(new)
        comps = components(links)
    # The same doc_id is one document: its nodes belong together.
    same = sketches.where("node is not null and doc_id is not null").select("doc_id", "node").distinct()
    twice = same.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a")
    twice = materialise(same.join(twice, "doc_id").where("node <> a").select("a", F.col("node").alias("b")))
    if not twice.isEmpty():
        comps = components(links.unionByName(twice))
    whole = nodes.select("node", "doc_id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = whole.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_node = whole.join(names, "comp").select("node", "component_id")
    return sketches.join(by_node, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, all columns, of one document per group; rows without doc_id stay."""
    keep = link(docs, k).where("kept and doc_id is not null").select(F.col("doc_id").alias("keep_id")).distinct()
    row = docs.select(F.struct("*").alias("row"), "doc_id")
    named = row.join(keep, F.col("doc_id") == F.col("keep_id"), "left_semi")
    # Of rows that repeat a doc_id the one with the smallest text hash stays.
    one = named.selectExpr("row", "row_number() over (partition by doc_id order by xxhash64(row.text)) as nth").where("nth = 1")
    return one.select("row").unionByName(row.where("doc_id is null").select("row")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "documents"), k=4)
