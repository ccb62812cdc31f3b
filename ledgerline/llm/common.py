"""Shared helpers of the training-data operators.

Text kernels work on one Arrow string column at a time: the UTF-8 bytes of many
documents in one ``uint8`` array plus row offsets, so numpy passes run over
megabytes instead of single values. ``text_chunks`` bounds the bytes handled
at once; only a single text longer than the bound makes a larger chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.session import ensure_checkpoint_dir, table_path

CHUNK_BYTES = 1 << 20
#: Most rows and bytes of one Arrow batch, which the JVM and the Python worker each hold whole.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}

#: Odd multiplier of the polynomial hashes (mod 2**64) and its inverse.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches; a smaller bound that is set stays. Results do not depend on it."""
    for key, most in BATCH.items():
        if not 0 < int(spark.conf.get(key).rstrip("bB")) <= most:
            spark.conf.set(key, most)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def materialise(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()``: the files are on storage all executors
    share, so a lost executor only repeats its own tasks.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def remainder(column: str, modulus: int):
    """crc32 of the column as text, modulo ``modulus`` (null stays null)."""
    return F.crc32(F.col(column).cast("string")) % modulus


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive row ranges; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64, count=n + 1, offset=8 * column.offset)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1)
        yield a, b, raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n at least (kept per worker)."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, b in enumerate((BASE, BASE_INV)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            p = np.multiply.accumulate(p)
            if len(_POWERS) > i:
                _POWERS[i] = p
            else:
                _POWERS.append(p)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """p with p[j] - p[i] = sum of code(byte t) * BASE**t for i <= t < j (mod 2**64)."""
    up, _ = powers(len(data) + 1)
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:len(data)], out=p[1:])
    return p


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of the bytes start:end; the length takes part."""
    _, down = powers(len(p))
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64))


#: The white space of the word rule [^\x20\x09-\x0D]+.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII letters A-Z lower-cased."""
    return _LOWER[data]


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document (plus the end) its first word's index."""
    solid = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    inner = offs[1:-1]
    before[inner[inner < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def shingle_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows over word hashes ``w``; a shorter non-empty text is one window."""
    if len(w) == 0:
        return w
    n = min(k, len(w))
    up, _ = powers(k + 1)
    windows = len(w) - n + 1
    h = reduce(lambda x, i: x + mix(w[i:i + windows]) * up[i + 1], range(n), np.zeros(windows, np.uint64))
    return mix(h + np.uint64(n))


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, comp) of every node on an edge; comp is the smallest node reachable.

    Alternates large-star and small-star steps: each step is two shuffles by
    node with map-side combined minima, no node's neighbours are ever gathered
    in one value, and the number of rounds grows with the logarithm of the
    longest chain. Every round is written to the shared checkpoint folder.
    """
    e = materialise(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct())
    while True:
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.*")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        e = materialise(joined.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct())
        # Done when every node points to one node and that one points nowhere.
        ends = e.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
        again = ends.where("n > 1").select("u").limit(1).unionByName(
            e.select(F.col("v").alias("u")).join(e.select("u"), "u", "left_semi").limit(1))
        if again.isEmpty():
            break
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        roots.select("node", F.col("node").alias("comp")))
