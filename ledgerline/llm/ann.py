"""Approximate nearest neighbours by collision-counting hashing.

Every vector is hashed by single random projections whose values are kept as
sorted arrays. A query opens a window around its own value in every array; the
windows are widened round by round (virtual rehashing: the same arrays serve
every radius), and a vector that lies in enough windows - its collision count
reaches the threshold - is verified by its exact distance. A round is the last
when the k-th verified distance lies within the round's radius. Where a share
``VERIFIED`` of the block has been verified before that - as where many copies
collide - counting on costs more than measuring, and all the block's other
vectors are verified too: such a query is answered exactly on the block.

Vectors are dealt into blocks of about ``BLOCK`` rows by a hash of their id and
queries into chunks; each (block, chunk) is one independent unit that returns
its best k per query, and the best k over all blocks are the answer. Memory
per task is bounded by the block, whatever the table's size.

Defined cases: vectors that are null, zero or hold null or non-finite
components and rows without vec_id take no part; vectors of different length
are not compared; repeated rows are one vector, and rows that share a query's
vec_id are not its candidates; with fewer than k candidates all are returned;
ties go to the smaller vec_id; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import materialise, read
from ledgerline.llm.vectors import matrix, usable

NEAREST = 10
BLOCK, CHUNK = 8192, 512
PROJECTIONS = 160
#: Verified share of a block from which the rest of it is verified as well.
VERIFIED = 0.2
#: Window half-width per unit of radius, and the share of windows that makes a candidate.
HALF_WIDTH, COLLIDING = 0.8, 0.51
FIRST_RADIUS, GROWTH = 0.05, 1.25
SEED = 9


def search_block(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int = NEAREST):
    """Yields (query row, positions in x, distances) of the nearest found, by collision counting."""
    n, d = x.shape
    axes = np.random.default_rng(SEED).standard_normal((d, PROJECTIONS))
    values = (x @ axes).T
    order = np.argsort(values, axis=1, kind="stable")
    values = np.take_along_axis(values, order, axis=1)
    order = order.astype(np.int32)
    centres = queries @ axes
    scale = float(np.median(np.linalg.norm(x, axis=1)))
    enough, many = int(np.ceil(COLLIDING * PROJECTIONS)), max(4 * k, int(VERIFIED * n))
    # The radii are the same for all queries, so each array is searched once for all windows of all rounds.
    widest = max(float(np.abs(values).max() + np.abs(centres).max()), 1e-300)
    first = FIRST_RADIUS * scale
    rounds = max(1, int(np.ceil(np.log(max(widest / (HALF_WIDTH * first), 1.0)) / np.log(GROWTH))) + 2)
    radii = first * GROWTH ** np.arange(rounds)
    begin = [np.searchsorted(v, c[:, None] - HALF_WIDTH * radii) for v, c in zip(values, centres.T)]
    end = [np.searchsorted(v, c[:, None] + HALF_WIDTH * radii, side="right") for v, c in zip(values, centres.T)]
    begin, end = np.stack(begin, axis=2), np.stack(end, axis=2)  # query, round, projection
    for q in range(len(queries)):
        count = np.zeros(n, np.int64)
        done = ids == query_ids[q]
        left = right = begin[q, 0]
        found, dist = np.zeros(0, np.int64), np.zeros(0)
        for r, radius in enumerate(radii):
            new_left, new_right = begin[q, r], end[q, r]
            grown = np.flatnonzero(new_left < left).tolist()
            slices = [order[i, new_left[i]:left[i]] for i in grown]
            grown = np.flatnonzero(right < new_right).tolist()
            slices += [order[i, right[i]:new_right[i]] for i in grown]
            left, right = new_left, new_right
            if slices:
                count += np.bincount(np.concatenate(slices), minlength=n)
            fresh = np.flatnonzero((count >= enough) & ~done)
            exact = len(found) + len(fresh) >= many
            if exact:
                fresh = np.flatnonzero(~done)
            if len(fresh):
                done[fresh] = True
                diff = x[fresh] - queries[q]
                found = np.concatenate([found, fresh])
                dist = np.concatenate([dist, np.sqrt((diff * diff).sum(axis=1))])
            if exact or len(found) >= k and np.partition(dist, k - 1)[k - 1] <= radius:
                break
        best = np.lexsort((ids[found], dist))[:k]
        yield q, found[best], dist[best]


def search(vectors: DataFrame, every: int = 100, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose vec_id is divisible by ``every``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            d = left.column("d")[0].as_py()
            x, ids = matrix(left.column("embedding"), d), left.column("vec_id").to_numpy()
            queries, query_ids = matrix(right.column("embedding"), d), right.column("vec_id").to_numpy()
            for q, at, dist in search_block(x, ids, queries, query_ids, k):
                out[0].extend([int(query_ids[q])] * len(at))
                out[1].extend(ids[at].tolist())
                out[2].extend(dist.tolist())
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})

    rows = vectors.where(usable() & F.col("vec_id").isNotNull()).select("vec_id", "embedding", F.size("embedding").alias("d")).distinct()
    rows = materialise(rows)
    queries = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-rows.count() // BLOCK))
    chunks = max(1, -(-queries.count() // CHUNK))
    h = F.xxhash64("vec_id", "embedding")
    left = rows.withColumn("block", F.pmod(h, F.lit(blocks))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = queries.withColumn("chunk", F.pmod(h, F.lit(chunks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    found = left.groupBy("d", "block", "chunk").cogroup(right.groupBy("d", "block", "chunk")).applyInArrow(
        run, "query_id bigint, vec_id bigint, score double")
    # Rows of one vec_id with different vectors: the nearest counts.
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return found.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score, vec_id) as int) as rank",
                            "vec_id", "score").where(F.col("rank") <= k)


def op9_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"))
