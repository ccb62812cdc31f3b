"""Benchmark decontamination through a distributed positional inverted index.

``index`` cuts the corpus into shards of whole documents (some megabytes of
text) and stores for every shard and term the sorted list of its positions,
delta-coded, with one more row for the shard's documents. No list is longer
than its shard, so a term that is in every document has many bounded lists.

``matches`` looks test windows up: document frequencies of the test terms
order the terms of each distinct window from the rarest; only shards with a
list of the rarest term are looked at, and in them the lists are intersected,
each adjusted by the term's offset in the window, from the rarest on until
nothing is left. What is left are exact phrases. Proximity matches need all
terms of a window, in any order, within ``within`` consecutive words of one
document; they are sought around the rarest term's positions.

A shard's group holds the lists of the terms it needs (at most the shard) and
at most about ``WINDOWS`` windows; more distinct windows are dealt to blocks.

Defined cases: null, empty and wordless texts have no words, no hit and no
items; an item without words, or without item_id, is not looked for; items
that repeat count once; rows of documents that repeat, also without doc_id,
get their row each; empty tables give no rows or no hits; other columns are
not read. A single text larger than a shard makes a larger shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import lower, materialise, read, text_chunks
from ledgerline.llm.spans import SHARD_BYTES, distinct, gathered, numbers, runs, strings, varints

#: Words of a window; a proximity match lies within this many words.
LENGTH, WITHIN = 10, 20
WINDOWS = 50_000

_WORD = np.ones(256, bool)
_WORD[:0x30] = _WORD[0x3A:0x61] = _WORD[0x7B:0x80] = False

#: shard, term, n and positions; the row without a term holds the shard's documents.
_INDEX = ("shard bigint, term string, n bigint, at binary, "
          "docs array<struct<row:int, doc_id:bigint, first:bigint, n_words:bigint>>")
_DOCS = pa.list_(pa.struct([("row", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_words", pa.int64())]))
_ROWS = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("at", pa.binary()), ("docs", _DOCS)])


def coded(values: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted lists, one after the other, as gaps; ``heads`` marks the first value of each, which is kept as it is."""
    gap = np.diff(values, prepend=0)
    gap[heads] = values[heads]
    return varints(gap)


def decoded(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists and the number of the list of each; ``ends`` are the ends of the lists in ``raw``."""
    gap, stop = numbers(raw)
    size = np.diff(np.searchsorted(stop, ends, "right"), prepend=0)
    first = np.cumsum(size) - size
    total = np.cumsum(gap)
    return total - np.repeat(total[first] - gap[first], size), np.repeat(np.arange(len(ends)), size)


def index(docs: DataFrame) -> DataFrame:
    """The positional index of ``docs`` as a written table; one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = (TaskContext.get().partitionId() + 1) << 32
        for batch in gathered(batches):
            ids = batch.column(0)
            for a, b, data, offs in text_chunks(batch.column(1), SHARD_BYTES):
                data, shard = lower(data), shard + 1
                starts, ends, first = runs(_WORD[data], offs)
                listed = pa.StructArray.from_arrays(
                    [pa.array(np.arange(b - a, dtype=np.int32)), ids.slice(a, b - a).cast(pa.int64()),
                     pa.array(first[:-1].astype(np.int64)), pa.array(np.diff(first).astype(np.int64))], fields=list(_DOCS.value_type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard]), pa.array([None], pa.string()), pa.array([len(starts)], pa.int64()), pa.array([b""], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), listed).cast(_DOCS)], schema=_ROWS)
                if not len(starts):
                    continue
                at, _, number = distinct(data, starts, ends)
                order = np.argsort(number, kind="stable")
                n = np.bincount(number, minlength=len(at))
                begin = np.cumsum(n) - n
                heads = np.zeros(len(order), bool)
                heads[begin] = True
                raw, stop = coded(order, heads)
                cuts = np.concatenate([[0], stop[begin + n - 1]]).astype(np.int32)
                lists = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
                terms = strings(data, starts[at], ends[at])
                for i in range(0, len(at), 10_000):
                    m = min(10_000, len(at) - i)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, shard)), terms.slice(i, m), pa.array(n[i:i + m]), lists.slice(i, m), pa.nulls(m, _DOCS)], schema=_ROWS)

    return materialise(docs.select("doc_id", "text").mapInArrow(run, _INDEX))


def windows(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """(item_id, words): every window of each item, once; an item of fewer words is one window."""
    words = items.select("item_id", F.regexp_extract_all(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")).alias("w")).where("item_id is not null and size(w) > 0")
    return words.select("item_id", F.explode(F.expr(
        f"transform(sequence(0, greatest(size(w) - {length}, 0)), i -> slice(w, i + 1, {length}))")).alias("words")).distinct()


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the stretches start:end, as disjoint stretches."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    head = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return starts[head], np.concatenate([reach[head[1:] - 1], reach[-1:]])


class Lists:
    """The position lists of a shard in one sorted array of (list, position)."""

    def __init__(self, values: np.ndarray, of: np.ndarray, n: int):
        self.keys = (of << 40) | values
        self.begin = np.searchsorted(self.keys, np.arange(n) << 40)
        self.size = np.diff(np.append(self.begin, len(values)))

    def has(self, of: np.ndarray, position: np.ndarray) -> np.ndarray:
        want = (of << 40) | np.maximum(position, 0)
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return (self.keys[at] == want) & (position >= 0)

    def between(self, of: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Is a position of the list in begin:end?"""
        at = np.searchsorted(self.keys, (of << 40) | begin)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] < ((of << 40) | end))

    def expand(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry of ``of`` the positions of that list: (entry, position)."""
        size = self.size[of]
        entry = np.repeat(np.arange(len(of)), size)
        nth = np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size)
        return entry, self.keys[self.begin[of][entry] + nth] & ((1 << 40) - 1)


#: Candidate positions looked at together.
STEP = 1 << 20


def phrases(lists: Lists, of: np.ndarray, places: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of all phrases; window w has the terms head[w]:head[w + 1] of (list, offset), the rarest first.

    Each list in turn is adjusted by its term's offset and intersected with what the lists before it left.
    """
    window, at = lists.expand(of[head[:-1]])
    start = at - places[head[:-1]][window]
    nth = 1
    while True:
        more = head[window] + nth < head[window + 1]
        if not more.any():
            return window, start
        i = np.minimum(head[window] + nth, len(of) - 1)
        ok = ~more | lists.has(of[i], start + places[i])
        window, start, nth = window[ok], start[ok], nth + 1


def proximities(lists: Lists, of: np.ndarray, head: np.ndarray, first: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, document) with all terms of the window, in any order, within ``within`` words of the document."""
    window, at = lists.expand(of[head[:-1]])
    row = np.searchsorted(first, at, "right") - 1
    low, high = np.maximum(at - within + 1, first[row]), np.minimum(at + within, first[row + 1])
    for nth in range(1, int(np.diff(head).max(initial=0))):
        i = head[window] + nth
        inside = i < head[window + 1]
        i = np.minimum(i, len(of) - 1)
        ok = ~inside | lists.between(of[i], low, high)
        window, at, row, low, high = (x[ok] for x in (window, at, row, low, high))
    # What is left has all terms near the rarest one; the stretches that hold it are tried one by one.
    hit = np.zeros(len(window), bool)
    for back in range(within):
        begin = at - back
        ok = begin >= low
        end = np.minimum(begin + within, high)
        for nth in range(1, int(np.diff(head).max(initial=0))):
            if not ok.any():
                break
            i = head[window] + nth
            inside = i < head[window + 1]
            i = np.minimum(i, len(of) - 1)
            ok &= ~inside | lists.between(of[i], np.maximum(begin, 0), end)
        hit |= ok
    found = np.unique(np.stack([window[hit], row[hit]]), axis=1)
    return found[0], found[1]


_FOUND = "shard bigint, row int, window bigint, near boolean, begin bigint, until bigint"


def _found(shard: int, row, window=None, near=None, begin=None, until=None) -> pa.Table:
    n = len(row)
    columns = zip((window, near, begin, until), (pa.int64(), pa.bool_(), pa.int64(), pa.int64()))
    return pa.Table.from_arrays(
        [pa.array(np.full(n, shard), pa.int64()), pa.array(row, pa.int32()), *(pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in columns)],
        ["shard", "row", "window", "near", "begin", "until"])


def matches(idx: DataFrame, asked: DataFrame, within: int = WITHIN) -> DataFrame:
    """Matches of the windows ``asked`` (window, words) in the index.

    Rows with ``window`` and near = false or true name a window that occurs
    in a document as a phrase or in proximity; rows without it hold disjoint
    stretches begin:until of the document's words under phrases.
    """
    terms = asked.select("window", F.posexplode("words").alias("o", "term"))
    lists = idx.where("term is not null")
    # Written tables: their sizes are known, so Spark joins small ones with the index in place and shuffles large ones.
    vocabulary = materialise(terms.select("term").distinct())
    weight = materialise(lists.join(vocabulary, "term").groupBy("term").agg(F.sum("n").alias("df"))).withColumn(
        "id", F.monotonically_increasing_id())
    weight = materialise(weight)
    # Windows with a term that the corpus lacks end here; the others get their terms from the rarest on.
    ordered = terms.join(weight, "term", "left").groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct("df", "id", "o"))).alias("parts"), F.min(F.col("df").isNotNull()).alias("whole"))
    ordered = materialise(ordered.where("whole").select(
        "window", F.expr("parts.id").alias("ids"), F.expr("parts.o").alias("places")))
    blocks = max(1, -(-ordered.count() // WINDOWS))
    ordered = ordered.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)).cast("int"))
    rarest = materialise(ordered.withColumn("id", F.expr("ids[0]")).join(weight.select("id", "term"), "id").select("term", "block", "window", "ids", "places"))
    alive = rarest.join(lists.select("term", "shard"), "term").select("shard", "block", "window", "ids", "places")
    needed = materialise(ordered.select("block", F.explode("ids").alias("id")).distinct().join(weight, "id").select("term", "block", "id"))
    fetched = lists.select("shard", "term", "at").join(needed, "term").select("shard", "block", "id", "at", F.lit(None).cast("array<bigint>").alias("first"))
    heads = idx.where("term is null").select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("binary").alias("at"), F.expr("concat(docs.first, array(n))").alias("first"))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        none = _found(0, [])
        if not len(left):
            return none
        shard, ids = key[0].as_py(), right.column("id").combine_chunks()
        document = next(x for x, i in zip(right.column("first"), ids) if not i.is_valid)
        first = document.values.to_numpy()
        right = right.filter(ids.is_valid())
        known, order = np.unique(right.column("id").to_numpy(), return_index=True)
        raw = right.column("at").combine_chunks().take(pa.array(order))
        raw = [x.as_buffer() for x in raw]
        lists = Lists(*decoded(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw])), len(known))
        # Windows of which this shard lacks a term are over.
        window, term, place = (left.column(c).combine_chunks() for c in ("window", "ids", "places"))
        size = np.diff(term.offsets.to_numpy())
        of, place = np.searchsorted(known, term.flatten().to_numpy()), place.flatten().to_numpy().astype(np.int64)
        there = known[np.minimum(of, len(known) - 1)] == term.flatten().to_numpy()
        head = np.concatenate([[0], np.cumsum(size)])
        whole = np.logical_and.reduceat(there, head[:-1])
        kept = np.repeat(whole, size)
        of, place, window, size = of[kept], place[kept], window.to_numpy()[whole], size[whole]
        out, spans = [none], []
        # So many windows at a time that their rarest lists stay within STEP positions.
        head = np.concatenate([[0], np.cumsum(size)])
        load = np.cumsum(lists.size[of[head[:-1]]]) // STEP
        for w in np.split(np.arange(len(size)), np.flatnonzero(np.diff(load)) + 1):
            if not len(w):
                continue
            a, b = head[w[0]], head[w[-1] + 1]
            part = head[w[0]:w[-1] + 2] - a
            n, begin = phrases(lists, of[a:b], place[a:b], part)
            row = np.searchsorted(first, begin, "right") - 1
            inside = (begin >= 0) & (begin + size[w][n] <= first[np.minimum(row + 1, len(first) - 1)])
            n, begin, row = n[inside], begin[inside], row[inside]
            spans.append((begin, begin + size[w][n]))
            near, home = proximities(lists, of[a:b], part, first, within)
            for rows, windows, close in ((row, n, False), (home, near, True)):
                pair = np.unique(np.stack([rows, windows]), axis=1)
                out.append(_found(shard, pair[0], window[w][pair[1]], np.full(pair.shape[1], close)))
        begin, until = (np.concatenate(x) for x in zip(*spans)) if spans else (np.zeros(0, np.int64),) * 2
        if len(begin):
            # No phrase leaves its document, so stretches are joined with the document's number in front.
            row = np.searchsorted(first, begin, "right") - 1
            begin, until = _spans(begin + row, until + row)  # one word of distance between documents
            row = np.searchsorted(first + np.arange(len(first)), begin, "right") - 1
            out.append(_found(shard, row, begin=begin - row, until=until - row))
        return pa.concat_tables(out)

    held = fetched.unionByName(heads).withColumnsRenamed({"shard": "of_shard", "block": "of_block"})
    return alive.groupBy("shard", "block").cogroup(held.groupBy("of_shard", "of_block")).applyInArrow(run, _FOUND)


def contaminated(docs: DataFrame, items: DataFrame, length: int = LENGTH, within: int = WITHIN) -> DataFrame:
    """One row per document: its words, those under an item's window, and the items found (exactly, or near only)."""
    idx = index(docs)
    named = materialise(windows(items, length))
    distinct_windows = named.select("words").distinct()
    asked = materialise(distinct_windows.select(F.monotonically_increasing_id().alias("window"), "words"))
    found = materialise(matches(idx, asked, within))
    # Stretches of different blocks may overlap: each adds what lies beyond the furthest end before it.
    hits = found.where("window is null").selectExpr(
        "shard", "row", "begin", "until",
        "max(until) over (partition by shard, row order by begin, until rows between unbounded preceding and 1 preceding) as reach")
    hits = hits.groupBy("shard", "row").agg(F.expr("sum(greatest(until - greatest(begin, coalesce(reach, begin)), 0))").alias("n_hit"))
    owners = asked.join(named, "words").select("window", "item_id")
    of = found.where("window is not null").join(owners, "window").groupBy("shard", "row", "item_id").agg(F.min("near").alias("near"))
    of = of.groupBy("shard", "row").agg(
        F.array_sort(F.expr("collect_list(cast(item_id as string)) filter (where not near)")).alias("items"),
        F.expr("count_if(near)").alias("n_near_items"))
    rows = idx.where("term is null").select("shard", F.explode("docs").alias("d")).select("shard", "d.row", "d.doc_id", "d.n_words")
    out = rows.join(hits, ["shard", "row"], "left").join(of, ["shard", "row"], "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
