"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to). A flow network routes words from patterns to source quotas: a pattern
offers its words once at no cost, again at cost 1, a third time at cost 3
(convex, so repetition is spread before it is deepened), and a source takes at
most its quota. Successive shortest paths give the cheapest routing of as many
words as possible. Each pattern's flow is then realised by whole passes over
its documents plus a seeded selection for the rest.

Only a pattern table of at most ``MAX_PATTERNS`` rows (one per distinct set of
sources, counted and summed by Spark) reaches the driver. Where there are more
and each holds one source, the flow has a closed form - every source its quota,
three passes at most - and Spark computes it without the driver; more patterns
that may overlap raise an error instead of being cut. Documents are selected without gathering a
source: seeded keys are cut into ranges, range sums give each pattern's
boundary range, and only boundary ranges are summed row by row.

Defined cases: a null text has size 0; a null source is a source of its own,
weighed last; size-0 documents are never taken; repeated rows are separate
documents; an empty table gives no rows; without any words nothing is taken.
"""

from __future__ import annotations

import heapq
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import materialise, read
from ledgerline.operators.order import dense_index

SEED = 20_240_229
MAX_REPEATS = 3
MAX_PATTERNS = 100_000
#: Leading bits of the seeded key that name a range.
RANGE_BITS = 12
#: Cost of a word's first, second, third pass.
PASS_COSTS = (0, 1, 3)
_WORD = "[^\\x20\\x09-\\x0D]+"


def size_of(text: str = "text"):
    """Number of words of a text: starts of runs that are not white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of the total by weight; what is above ``most`` times a size goes to the others by weight."""
    rest, whole = float(sum(sizes)), float(sum(weights))
    capped = set()
    # A source is capped if the level (rest / whole) is above most * size / weight; each one capped raises the level.
    for i in sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i]):
        if not rest * weights[i] / whole > most * sizes[i]:
            break
        capped.add(i)
        rest, whole = rest - most * sizes[i], whole - weights[i]
    return [most * sizes[i] if i in capped else rest * weights[i] / whole for i in range(len(sizes))]


def route(patterns: list[tuple[int, tuple[int, ...]]], quotas: list[int]) -> list[dict[int, int]]:
    """Cheapest largest flow: for each (words, sources) pattern its words to each source.

    A pattern whose only source no other pattern has is a path of its own, the
    only one to that source, and is filled at once. The others: successive
    shortest paths with Dijkstra on reduced costs.
    """
    users = Counter(s for _, sources in patterns for s in sources)
    flows: list[dict[int, int]] = [{} for _ in patterns]
    shared = []
    for i, (words, sources) in enumerate(patterns):
        if len(sources) == 1 and users[sources[0]] == 1:
            flows[i] = {s: f for s in sources if (f := min(words * len(PASS_COSTS), quotas[s]))}
        elif sources:
            shared.append(i)
    used = sorted({s for i in shared for s in patterns[i][1]})
    number = {s: k for k, s in enumerate(used)}
    found = _shortest_paths([(patterns[i][0], tuple(number[s] for s in patterns[i][1])) for i in shared], [quotas[s] for s in used])
    for i, flow in zip(shared, found):
        flows[i] = {used[k]: f for k, f in flow.items()}
    return flows


def _shortest_paths(patterns: list[tuple[int, tuple[int, ...]]], quotas: list[int]) -> list[dict[int, int]]:
    """``route`` by successive shortest paths; nodes: 0 is the start, then patterns, then sources, then the end."""
    n, m = len(patterns), len(quotas)
    end = n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(end + 1)]  # arcs: to, capacity, cost, index of the reverse

    def arc(a: int, b: int, capacity: int, cost: int) -> None:
        graph[a].append([b, capacity, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for i, (words, sources) in enumerate(patterns):
        for cost in PASS_COSTS:
            arc(0, 1 + i, words, cost)
        for s in sources:
            arc(1 + i, 1 + n + s, words * len(PASS_COSTS), 0)
    for s, quota in enumerate(quotas):
        arc(1 + n + s, end, quota, 0)
    potential = [0] * (end + 1)
    while True:
        far = float("inf")
        dist, by = [far] * (end + 1), [None] * (end + 1)
        dist[0], queue = 0, [(0, 0)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for k, (b, capacity, cost, _) in enumerate(graph[a]):
                if capacity and d + cost + potential[a] - potential[b] < dist[b]:
                    dist[b] = d + cost + potential[a] - potential[b]
                    by[b] = (a, k)
                    heapq.heappush(queue, (dist[b], b))
        if by[end] is None:
            break
        reached = max(d for d in dist if d < far)
        potential = [p + min(d, reached) for p, d in zip(potential, dist)]
        path, b = [], end
        while b:
            path.append(by[b])
            b = by[b][0]
        amount = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= amount
            graph[graph[a][k][0]][graph[a][k][3]][1] += amount
    return [{b - 1 - n: graph[b][back][1] for b, _, cost, back in graph[1 + i] if n < b < end and graph[b][back][1]}
            for i in range(n)]


def _keyed(docs: DataFrame, sources=None) -> DataFrame:
    member = F.array("source") if sources is None else F.array_sort(F.array_distinct(sources))
    return docs.withColumn("mix", F.struct(
        member.alias("pattern"), size_of().alias("size"), F.xxhash64(F.lit(SEED), "doc_id", "text").alias("key")))


def _routed(patterns: DataFrame, most: float) -> DataFrame:
    """The plan of at most MAX_PATTERNS patterns by the flow network, on the driver."""
    spark, found = patterns.sparkSession, patterns.collect()
    found.sort(key=lambda r: [(s is None, s or "") for s in r.pattern])
    names = sorted({s for r in found for s in r.pattern}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    patterns = [(int(r.words), tuple(number[s] for s in r.pattern)) for r in found]
    sizes = [0] * len(names)
    for w, p in patterns:
        for i in p:
            sizes[i] += w
    goal = targets(sizes, [1.0 + i % 3 for i in range(len(names))], most) if names else []
    flow = [sum(f.values()) for f in route(patterns, [round(g) for g in goal])]
    # As Arrow: a list of rows is read by Python workers of their own kind, which executors keep beside the others.
    rows = [(r.pattern, sum(sizes[i] for i in p), float(sum(goal[i] for i in p)), f // w if w else 0, f % w if w else 0)
            for r, (w, p), f in zip(found, patterns, flow)]
    kinds = [pa.list_(pa.string()), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    return spark.createDataFrame(
        pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["pattern", "source_size", "target", "passes", "rest"]),
        "pattern array<string>, source_size bigint, target double, passes bigint, rest bigint")


def _levelled(patterns: DataFrame, most: float) -> DataFrame:
    """The plan of any number of patterns of one source each: the flow's closed form, computed by Spark.

    Sources are numbered in order; a few sums at a time give the level at which
    words per weight are shared among the sources below their limit.
    """
    if not patterns.where("size(pattern) <> 1").isEmpty():
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns that may overlap")
    numbered = dense_index(patterns.selectExpr("pattern", "words", "pattern[0] is null as last", "pattern[0] as source"), ["last", "source"], "nth")
    table = materialise(numbered.selectExpr("pattern", "words", "cast(1 + nth % 3 as double) as weight"))
    total = float(table.agg(F.sum("words")).first()[0] or 0)
    rest, whole, capped = total, 0.0, -1
    level = 0.0
    over = lambda: F.lit(level) * F.col("weight") > most * F.col("words")
    while True:
        sums = table.agg(F.sum(F.when(over(), F.col("words"))).alias("words"), F.sum(F.when(~over(), F.col("weight"))).alias("weight"),
                         F.count_if(over()).alias("capped")).first()
        if sums.capped == capped:
            break
        rest, whole, capped = total - most * (sums.words or 0), sums.weight or 0.0, sums.capped
        if not whole:
            break
        level = rest / whole
    share = F.col("words") * F.lit(float(most)) if not whole else F.when(over(), F.col("words") * F.lit(float(most))).otherwise(
        F.lit(rest) * F.col("weight") / F.lit(whole))
    return materialise(table.withColumn("target", share).withColumn(
        "flow", F.least(F.col("words") * len(PASS_COSTS), F.bround("target").cast("bigint"))).selectExpr(
        "pattern", "words as source_size", "target", "if(words > 0, flow div words, 0) as passes", "if(words > 0, flow % words, 0) as rest"))


def rules(rows: DataFrame, most: float = MAX_REPEATS) -> tuple[DataFrame, bool]:
    """One row per membership pattern: source_size, target, passes over all its documents and who is taken once more.

    With it goes whether these are at most MAX_PATTERNS rows, which may be broadcast.

    ``rows`` has pattern, size and key. Taken once more are the documents with
    key <= cut (a seeded prefix that fits into what whole passes leave over)
    and those with their key in tops (documents of which the first two fit
    best into the gap that the prefix leaves and the last is nearest to it). Rows that are equal in doc_id and text share a
    key and are treated alike.
    """
    patterns = materialise(rows.groupBy("pattern").agg(F.sum("size").alias("words")))
    few = patterns.limit(MAX_PATTERNS + 1).count() <= MAX_PATTERNS
    plan = _routed(patterns, most) if few else _levelled(patterns, most)

    def _with(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        return with_pattern(rows, table, few, how)

    # Ranges of the key in order; only the range that holds a pattern's boundary is summed key by key.
    slots = rows.withColumn("slot", F.shiftright("key", 64 - RANGE_BITS))
    base = slots.groupBy("pattern", "slot").agg(F.sum("size").alias("words")).selectExpr(
        "pattern", "slot", "words", "sum(words) over (partition by pattern order by slot) - words as base")
    edge = _with(base, plan).where("base <= rest and base + words > rest").select("pattern", "slot", "base", "rest")
    inside = _with(slots.withColumnRenamed("slot", "s"), edge).where("s = slot")
    inside = inside.groupBy("pattern", "key", "base", "rest").agg(F.sum("size").alias("size")).selectExpr(
        "*", "base + sum(size) over (partition by pattern order by key) as upto")
    fits = F.expr("upto <= rest")
    cut = inside.groupBy("pattern").agg(
        F.max(F.when(fits, F.col("key"))).alias("in_edge"),
        F.min(F.col("rest") - F.when(fits, F.col("upto")).otherwise(F.col("base"))).alias("gap"))
    # Nothing lies below the lowest range: its cut stays null, which takes nobody.
    below = edge.where(f"rest > 0 and slot > {-1 << RANGE_BITS - 1}").select(
        "pattern", F.expr(f"shiftleft(slot, {64 - RANGE_BITS}) - 1").alias("below"))
    plan = _with(_with(plan, cut, "left"), below, "left").selectExpr(
        "pattern", "source_size", "target", "passes", "coalesce(in_edge, below) as cut", "coalesce(gap, 0) as gap")
    plan = plan.withColumn("tops", F.expr("cast(array() as array<bigint>)"))
    for nearest in (False, False, True):
        open_gaps = plan.where("gap > 0").select("pattern", "cut", "gap", "tops")
        near = _with(rows, open_gaps).where("coalesce(key > cut, true) and size > 0 and not array_contains(tops, key)")
        near = near.groupBy("pattern", "key", "gap").agg(F.sum("size").alias("size")).where(
            "abs(gap - size) < gap" if nearest else "size <= gap")
        top = near.groupBy("pattern").agg(F.min_by(F.struct("key", "size"), F.struct(
            F.abs(F.col("gap") - F.col("size")), "key")).alias("top"))
        plan = materialise(_with(plan, top, "left").selectExpr(
            "pattern", "source_size", "target", "passes", "cut", "gap - coalesce(top.size, 0) as gap",
            "if(top is null, tops, array_append(tops, top.key)) as tops"))
    return plan.drop("gap"), few


def with_pattern(rows: DataFrame, table: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Join with a table of at most one row per pattern, broadcast if these are few (at most MAX_PATTERNS)."""
    table = table.withColumnRenamed("pattern", "of")
    return rows.join(F.broadcast(table) if few else table, F.col("pattern").eqNullSafe(F.col("of")), how).drop("of")


_EXTRA = "size > 0 and (coalesce(key <= cut, false) or array_contains(tops, key))"


def mix(docs: DataFrame, sources=None, most: float = MAX_REPEATS) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs``.

    ``sources`` gives each row's array of source names (default: its one
    ``source``, null included); source_size and target are summed over them.
    """
    rows = materialise(_keyed(docs, sources).select("doc_id", "mix.*"))
    return with_pattern(rows, *rules(rows, most)).selectExpr(
        "doc_id", "size", "source_size", "target",
        f"size * (passes + case when {_EXTRA} then 1 else 0 end) as taken")


def take(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, all columns."""
    columns = docs.columns
    rows = _keyed(docs.select(F.struct("*").alias("row"), "doc_id", "text", "source")).select("row", "mix.*")
    rule = rules(materialise(rows.select("pattern", "size", "key")))
    times = f"cast(case when size > 0 then passes else 0 end + case when {_EXTRA} then 1 else 0 end as int)"
    return with_pattern(rows, *rule).selectExpr("row", f"explode(array_repeat(0, {times})) as nth").select(
        *[F.col("row")[c].alias(c) for c in columns])


def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))
