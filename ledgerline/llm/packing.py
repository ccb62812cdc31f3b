"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``CAPACITY`` tokens. The plan depends
only on how many pieces of each length exist - a table of at most ``CAPACITY``
rows whatever the corpus - so Spark counts lengths and the driver solves the
counted problem: for a bin opened with the longest piece left, a bitset
subset-sum over the available lengths finds the fullest feasible completion,
which is removed as often as the counts allow. Every step uses up at least
one length or halves its count, so the number of distinct bin patterns is
bounded by ``CAPACITY`` times a logarithm, not by the corpus.

Pieces get their places without gathering any group: pieces of one length are
numbered through (length, salt) counts, and a piece's number falls into the
interval of one pattern, which gives sequence and offset by arithmetic.

Defined cases: null and empty texts are one piece holding the closing id;
repeated rows are packed each; rows with a null doc_id are packed too; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import materialise, read
from ledgerline.llm.subwords import END_ID, encoder

CAPACITY = 4096
#: Salts that split the pieces of one length for numbering.
SALTS = 64


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for b in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, ids in zip(b.column(0).to_pylist(), encode(texts)):
                ids += END_ID
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    doc.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """Lengths (with multiplicity) whose sum is the largest not above ``room``.

    Bit s of ``reach`` says that sum s can be made; each added batch of equal
    pieces (sizes 1, 2, 4, ... of its count) shifts and ors the bitset. The
    states after each batch are kept to walk the chosen sum back. Long pieces
    come first and the search stops as soon as the room is filled exactly.
    """
    full, mask = 1 << room, (1 << (room + 1)) - 1
    reach, steps = 1, []
    for size in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, batch = min(int(counts[size]), room // size), 1
        while left:
            take = min(batch, left)
            left -= take
            batch *= 2
            after = (reach | reach << take * size) & mask
            if after != reach:
                steps.append((reach, size, take))
                reach = after
        if reach & full:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, size, take in reversed(steps):
        if not before >> total & 1:
            total -= take * size
            chosen[size] = chosen.get(size, 0) + take
    return chosen


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, lengths per bin) patterns that use up ``counts`` (indexed by length)."""
    counts = counts.copy()
    out = []
    for first in range(capacity, 0, -1):
        while counts[first]:
            counts[first] -= 1
            chosen = fullest(counts, capacity - first)
            counts[first] += 1
            chosen[first] = chosen.get(first, 0) + 1
            times = min(int(counts[size]) // n for size, n in chosen.items())
            for size, n in chosen.items():
                counts[size] -= times * n
            out.append((times, chosen))
    return out


def places(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Per pattern and length: length, first piece number, pieces per bin, first bin, offset in the bin."""
    used: dict[int, int] = {}
    rows, bin_no = [], 0
    for times, chosen in patterns:
        offset = 0
        for size in sorted(chosen, reverse=True):
            n = chosen[size]
            rows.append((size, used.get(size, 0), n, bin_no, offset))
            used[size] = used.get(size, 0) + times * n
            offset += n * size
        bin_no += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def numbered(parts: DataFrame) -> DataFrame:
    """Adds ``number``: pieces of one length counted from 0, split by salt so that no length is one task."""
    n = max(SALTS, parts.rdd.getNumPartitions())
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = per_salt.selectExpr(
        "length", "salt", "sum(n) over (partition by length order by salt) - n as base")
    ranked = salted.selectExpr(
        "*", "row_number() over (partition by length, salt order by doc_id, piece, ids_crc32) - 1 as r")
    return ranked.join(before, ["length", "salt"]).withColumn("number", F.col("base") + F.col("r")).drop("salt", "base", "r")


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to the (materialised) pieces."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `capacity` rows
        counts[r.length] = r.n
    table = places(plan(counts, capacity))
    fields = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 44 | table[:, 1]
        for b in batches:
            size, number = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            row = table[np.searchsorted(keys, size << 44 | number, side="right") - 1] if len(size) else table[:0]
            nth = number - row[:, 1]
            per_bin = np.maximum(row[:, 2], 1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(row[:, 3] + nth // per_bin), pa.array(row[:, 4] + nth % per_bin * size)],
                [*fields, "sequence_id", "offset"])

    return numbered(parts).select(*fields, "number").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return place(materialise(pieces(docs, capacity)), capacity)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
