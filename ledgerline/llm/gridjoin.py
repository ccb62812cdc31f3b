"""Embedding near-dedup by an epsilon grid order join.

Unit vectors at cosine c are at Euclidean distance sqrt(2 - 2c). Vectors are
projected on their leading principal directions, cells of that width are laid
over the projections, and the vectors are range-sorted by (label, cells) - the
epsilon grid order. The sequence is cut into blocks; two blocks are joined
only if the boxes around their projections come closer than epsilon, found by
an equi-join on the cells of the first direction that a block covers. Inside a
task the two sequence intervals are joined recursively: provably distant
halves are skipped, small ones are compared by one matrix product in double
precision, and what lies near the threshold is decided by the plain formula.

Identical vectors of one label form one node first. A task returns one row per
vector with links and a spanning forest of its links, never the links
themselves, so a dense cluster costs arithmetic but no rows.

Defined cases: vectors that are null, zero or hold null or non-finite
components, rows with a null label and rows without vec_id link with nothing
(0 links, their own component, kept); vectors of different length do not link;
repeated rows are separate vectors; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import components, materialise, read
from ledgerline.llm.vectors import matrix, principal, usable

COSINE = 0.98
DIMS = 8
ORDER_DIMS = 4
BLOCK = 1024
LEAF = 256


def in_grid_order(nodes: DataFrame, axes: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """Adds d and the cells of the leading projections."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column(0).to_numpy()
            cells = np.zeros((b.num_rows, ORDER_DIMS), np.int32)
            for d in np.unique(size).tolist():
                x = matrix(b.column(4).filter(pa.array(size == d)), d)
                at = x / np.linalg.norm(x, axis=1, keepdims=True) @ axes[d][:, :ORDER_DIMS]
                cells[size == d, :at.shape[1]] = np.floor(at / epsilon)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(cells[:, i]) for i in range(ORDER_DIMS))],
                ["d", "label", "node", "n", "embedding", *(f"c{i}" for i in range(ORDER_DIMS))])

    return nodes.select(F.size("embedding").alias("d"), "label", "node", "n", "embedding").mapInArrow(
        run, "d int, label int, node bigint, n bigint, embedding array<float>, " + ", ".join(f"c{i} int" for i in range(ORDER_DIMS)))


def in_blocks(ordered: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """Sorted rows with their block's id; blocks are runs of at most BLOCK rows of one label and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held, last = TaskContext.get().partitionId() << 32, 0, None
        for b in batches:
            ids, key = [], list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            for k in key:
                if held == BLOCK or k != last:
                    block, held, last = block + 1, 0, k
                held += 1
                ids.append(block)
            low = np.zeros((b.num_rows, DIMS))
            size = b.column(0).to_numpy()
            for d in np.unique(size).tolist():
                x = matrix(b.column(4).filter(pa.array(size == d)), d)
                at = x / np.linalg.norm(x, axis=1, keepdims=True) @ axes[d]
                low[size == d, :at.shape[1]] = at
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *b.columns[:5], pa.array(list(low), pa.list_(pa.float64()))],
                ["block", "d", "label", "node", "n", "embedding", "at"])

    keys = ["label", "d", *(f"c{i}" for i in range(ORDER_DIMS)), "node"]
    return ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        run, "block bigint, d int, label int, node bigint, n bigint, embedding array<float>, at array<double>")


def block_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(x, y) of blocks whose boxes come within epsilon, x <= y."""
    box = blocks.groupBy("block", "label", "d").agg(
        *(F.min(F.col("at")[i]).alias(f"l{i}") for i in range(DIMS)), *(F.max(F.col("at")[i]).alias(f"h{i}") for i in range(DIMS)))
    cell = F.expr(f"sequence(cast(floor(l0 / {epsilon}) as int), cast(floor(h0 / {epsilon}) as int))")
    near = F.expr(f"sequence(cast(floor(l0 / {epsilon}) as int) - 1, cast(floor(h0 / {epsilon}) as int) + 1)")
    x = box.select(F.col("block").alias("x"), "label", "d", F.explode(cell).alias("cell"), *(
        F.col(f"{s}{i}").alias(f"x{s}{i}") for s in "lh" for i in range(DIMS)))
    y = box.select(F.col("block").alias("y"), "label", "d", F.explode(near).alias("cell"), *(
        F.col(f"{s}{i}").alias(f"y{s}{i}") for s in "lh" for i in range(DIMS)))
    gap = " + ".join(f"pow(greatest(xl{i} - yh{i}, yl{i} - xh{i}, 0), 2)" for i in range(DIMS))
    return x.join(y, ["label", "d", "cell"]).where(f"x <= y and {gap} <= {epsilon * epsilon}").select("x", "y").distinct()


def join_blocks(u: np.ndarray, raw: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, epsilon: float) -> Iterator[tuple]:
    """(rows, rows) of linked pairs between the sequence intervals x and y, block by small block."""
    work = [(x, y)]
    while work:
        x, y = work.pop()
        a, b = at[x], at[y]
        gap = np.maximum(np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)), 0)
        if gap @ gap > epsilon * epsilon:
            continue
        if max(len(x), len(y)) > LEAF:
            if len(x) == len(y) and x[0] == y[0]:
                m = len(x) // 2
                work += [(x[:m], x[:m]), (x[m:], x[m:]), (x[:m], x[m:])]
            elif len(x) >= len(y):
                work += [(x[:len(x) // 2], y), (x[len(x) // 2:], y)]
            else:
                work += [(x, y[:len(y) // 2]), (x, y[len(y) // 2:])]
            continue
        cosine = u[x] @ u[y].T
        i, j = np.nonzero(cosine >= COSINE - 1e-9)
        i, j, c = x[i], y[j], cosine[i, j]
        edge = np.flatnonzero(c < COSINE + 1e-9)
        if len(edge):
            p, q = raw[i[edge]], raw[j[edge]]
            c[edge] = (p * q).sum(1) / (np.sqrt((p * p).sum(1)) * np.sqrt((q * q).sum(1)))
        keep = (c >= COSINE) & ((i < j) if x[0] == y[0] else True)
        if keep.any():
            yield i[keep], j[keep]


def linked(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(a, b, n): links of node a in a pair of blocks (b null), and forest edges a - b (n 0)."""
    def run(table: pa.Table) -> pa.Table:
        d = table.column("d")[0].as_py()
        side = table.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        raw = matrix(table.column("embedding"), d)[order]
        at = matrix(table.column("at"), DIMS)[order]
        node, n = table.column("node").to_numpy()[order], table.column("n").to_numpy()[order]
        u = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        rows = np.arange(len(raw))
        x, y = rows[side[order] == 0], rows[side[order] == 1]
        count, root = np.zeros(len(raw), np.int64), rows.copy()
        edges = []
        for i, j in join_blocks(u, raw, at, x, y if len(y) else x, epsilon):
            np.add.at(count, i, n[j])
            np.add.at(count, j, n[i])
            # Links that still join two trees; the roots are then settled at once.
            while True:
                r, s = root[i], root[j]
                open_ = np.flatnonzero(r != s)
                if not len(open_):
                    break
                high, low = np.maximum(r, s)[open_], np.minimum(r, s)[open_]
                first, pick = np.unique(high, return_index=True)
                edges += zip(node[i[open_[pick]]].tolist(), node[j[open_[pick]]].tolist())
                to = rows.copy()
                to[first] = low[pick]
                while (to[to] != to).any():
                    to = to[to]
                root = to[root]
        hit = np.flatnonzero(count)
        return pa.table({
            "a": pa.array([*node[hit].tolist(), *(e[0] for e in edges)], pa.int64()),
            "b": pa.array([None] * len(hit) + [e[1] for e in edges], pa.int64()),
            "n": pa.array([*count[hit].tolist(), *[0] * len(edges)], pa.int64())})

    pairs = materialise(block_pairs(blocks, epsilon))
    sides = pairs.select("x", "y", F.col("x").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.where("x <> y").select("x", "y", F.col("y").alias("block"), F.lit(1).alias("side")))
    return sides.join(blocks, "block").select("x", "y", "side", "d", "node", "n", "embedding", "at").groupBy("x", "y").applyInArrow(
        run, "a bigint, b bigint, n bigint")


def link(table: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    epsilon = float(np.sqrt(2 - 2 * COSINE)) + 1e-6
    takes_part = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = table.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    rows = rows.withColumn("node", F.when(takes_part, F.xxhash64("label", "embedding")))
    nodes = materialise(rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("low")))
    axes = principal(nodes, DIMS)
    blocks = materialise(in_blocks(in_grid_order(nodes, axes, epsilon), axes))
    found = materialise(linked(blocks, epsilon))
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    comps = components(found.where("b is not null"))
    whole = nodes.select("node", "n", "low").join(comps, "node", "left").join(counts.withColumnRenamed("a", "node"), "node", "left")
    whole = materialise(whole.selectExpr("node", "low", "coalesce(comp, node) as comp", "coalesce(links, 0) + n - 1 as links"))
    names = whole.groupBy("comp").agg(F.min("low").alias("component_id"))
    by_node = whole.join(names, "comp").select("node", "links", "component_id")
    return rows.select("vec_id", "node").join(by_node, "node", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "embeddings"))
