"""Suffix-array dedup of byte strings: which bytes lie in a LENGTH-byte string that occurs again.

Sorting every suffix of a corpus would move many times its size. Suffixes are
therefore bucketed by content first: of the GRAM-byte strings inside a
LENGTH-byte string, the one with the smallest hash (leftmost of equals) is its
anchor. Equal strings have equal anchors at equal distance, so they always
meet in one bucket, and neighbouring positions mostly share their anchor. A
*span* is the run of positions with one anchor, with all bytes they cover.

- An anchor that occurs once proves all its positions unique.
- An anchor whose spans all agree (two independent 64-bit hashes) proves all
  its positions repeated.
- Only the different spans of the remaining anchors are sorted: their suffixes
  go through a merge sort whose comparisons find the common extension by
  binary search over prefix polynomial hashes; neighbours with LENGTH common
  bytes, verified byte by byte, are repeats.

Work is dealt by anchor. An anchor with more than ``BLOCK`` different spans is
split by the hash of each LENGTH-byte string, which keeps equal strings
together and no task unbounded. Equal spans are counted before they are sent.

Defined cases: a null text is empty; texts shorter than LENGTH bytes have
nothing to remove; repeated rows are repeats of each other, so all of a long
enough text that occurs twice goes; rows with a null doc_id take part; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import materialise, mix, prefix_hashes, read, span_hash, text_chunks

LENGTH = 200
GRAM = 64
REACH = LENGTH - GRAM + 1  # gram positions inside one string
BLOCK = 4096
#: Suffixes sorted at once.
SORTED_AT_ONCE = 1 << 19


def _window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every full window, by running minima from both sides of each block of w."""
    n = len(x)
    if n < w:
        return x[:0]
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first and last position, anchor position, anchor hash and span hash of every span of a chunk."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    p = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = span_hash(p, at, at + GRAM)
    low = _window_minima(gram & np.uint64(0xFFFFFFFF00000000) | at.astype(np.uint64), REACH)
    # Positions whose string ends inside its own text.
    left = np.maximum(np.diff(offs) - LENGTH + 1, 0)
    total = int(left.sum())
    first_of = np.repeat(np.cumsum(left) - left, left)
    row = np.repeat(np.arange(len(left)), left)
    pos = np.arange(total) - first_of + offs[row]
    anchor = (low[pos] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(new)
    if not len(start):
        return row, pos, pos, anchor, gram[:0], gram[:0]
    end = np.append(start[1:], total) - 1
    lo, hi, a = pos[start], pos[end], anchor[start]
    whole = mix(span_hash(p, lo, hi + LENGTH) + (a - lo).astype(np.uint64))
    return row[start], lo, hi, a, gram[a], whole


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def anchors(docs: DataFrame) -> DataFrame:
    """(k, t, anchor, span, n): distinct anchors and spans of every text with their count there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_chunks(b.column(2)):
                row, _, _, _, gram, whole = spans(data, offs)
                order = np.lexsort((whole, gram, row))
                row, gram, whole = row[order], gram[order], whole[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(row))).astype(np.int32)
                own = pa.array(i + row[at])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(own), b.column(1).take(own), _i64(gram[at]), _i64(whole[at]), pa.array(n)],
                    ["k", "t", "anchor", "span", "n"])

    return docs.mapInArrow(run, "k bigint, t bigint, anchor bigint, span bigint, n int")


def mixed_spans(texts: DataFrame) -> DataFrame:
    """(anchor, span, ahead, bytes) of the spans of each text's listed anchors; ``ahead`` is the anchor's distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            for i, j, data, offs in text_chunks(b.column(0)):
                row, lo, hi, a, gram, whole = spans(data, offs)
                part = lists.slice(i, j - i)
                size = np.diff(part.offsets.to_numpy())
                listed = part.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                hit = np.isin(_pair(row, gram), _pair(np.repeat(np.arange(j - i), size), listed))
                raw, at = data.tobytes(), np.flatnonzero(hit)
                yield pa.RecordBatch.from_arrays(
                    [_i64(gram[at]), _i64(whole[at]), pa.array((a[at] - lo[at]).astype(np.int32)),
                     pa.array([raw[x:y] for x, y in zip(lo[at].tolist(), (hi[at] + LENGTH).tolist())], pa.binary())],
                    ["anchor", "span", "ahead", "bytes"])

    return texts.mapInArrow(run, "anchor bigint, span bigint, ahead int, bytes binary")


def _pair(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(h ^ mix(row.astype(np.uint64) + np.uint64(1)))


def common_extension(p: np.ndarray, down: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Common prefix length, LENGTH at most, of the suffixes at x and y, by binary search over prefix hashes."""
    lo, hi = np.zeros(len(x), np.int64), np.full(len(x), LENGTH)
    px, py, dx, dy = p[x], p[y], down[x], down[y]
    for _ in range(LENGTH.bit_length()):
        mid = (lo + hi + 1) >> 1
        same = (p[x + mid] - px) * dx == (p[y + mid] - py) * dy
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def sort_suffixes(data: np.ndarray, at: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sort of the LENGTH-byte suffixes ``at`` inside each (contiguous) segment.

    All runs of one width are merged together: every suffix finds its rank in
    the neighbour run by binary search, each comparison being one common
    extension and one byte. Returns the order and, for each suffix but the
    last in that order, the verified common extension with the next.
    """
    from ledgerline.llm.common import powers

    p, (_, down) = prefix_hashes(data), powers(len(data) + 1)
    byte = np.append(data, 0)
    n = len(at)
    order = np.arange(n)
    start = np.searchsorted(segment, segment)  # first index of the own segment
    stop = np.searchsorted(segment, segment, side="right")
    width, widest = 1, int((stop - start).max()) if n else 0
    while width < widest:
        i = np.flatnonzero(stop - start > width)
        run = (i - start[i]) // width
        lo = np.minimum(start[i] + (run ^ 1) * width, stop[i])
        hi = np.minimum(lo + width, stop[i])
        base, own = lo.copy(), i - start[i] - run * width
        x, right = at[order[i]], (run & 1).astype(bool)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            y = at[order[mid]]
            ext = common_extension(p, down, x[live], y)
            less = np.where(ext == LENGTH, right[live], byte[np.minimum(y + ext, len(data))] < byte[np.minimum(x[live] + ext, len(data))])
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        after = order.copy()
        after[start[i] + (run >> 1) * 2 * width + own + lo - base] = order[i]
        order = after
        width *= 2
    x, y = at[order[:-1]], at[order[1:]]
    ext = common_extension(p, down, x, y)
    ext[segment[:-1] != segment[1:]] = 0
    # Collisions: whatever the hashes call equal is compared byte by byte.
    claimed = np.flatnonzero(ext == LENGTH)
    for c in np.array_split(claimed, max(1, len(claimed) // 4096)):
        span = np.arange(LENGTH)
        real = (data[x[c, None] + span] == data[y[c, None] + span]).all(axis=1)
        ext[c[~real]] = LENGTH - 1
    return order, ext


def repeats(rows: list[tuple[int, int, int, int, int, bytes]]) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """For whole buckets of (anchor, part, span, ahead, n, bytes): anchor, span and its repeated byte intervals."""
    for at in _groups(rows):
        part = rows[at[0]:at[1]]
        sizes = np.array([len(r[5]) for r in part])
        data = np.frombuffer(b"".join(r[5] for r in part), np.uint8)
        begin = np.cumsum(sizes) - sizes
        count = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(part)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        pos = begin[owner] + offset
        ahead = np.array([r[3] for r in part])
        twice = np.array([r[4] for r in part]) > 1
        # Only positions with equal distance to one anchor can be equal.
        key = _pair(ahead[owner] - offset, np.array([r[0] for r in part], np.int64).view(np.uint64)[owner])
        parts = np.array([r[1] for r in part])
        if (parts >= 0).any():
            p = prefix_hashes(data)
            h = span_hash(p, pos, pos + LENGTH)
            of = np.array([r[6] for r in part])[owner]
            use = (parts[owner] < 0) | (h % np.maximum(of, 1).astype(np.uint64) == np.maximum(parts[owner], 0).astype(np.uint64))
            owner, offset, pos, key = owner[use], offset[use], pos[use], key[use]
        by = np.argsort(key, kind="stable")
        owner, offset, pos, key = owner[by], offset[by], pos[by], key[by]
        order, ext = sort_suffixes(data, pos, key)
        hit = twice[owner]
        pairs = np.flatnonzero(ext == LENGTH)
        hit[order[pairs]] = True
        hit[order[pairs + 1]] = True
        owner, offset = owner[hit], offset[hit]
        by = np.lexsort((offset, owner))
        owner, offset = owner[by], offset[by]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
        cut = np.flatnonzero(new)
        last = np.append(cut[1:], len(owner)) - 1
        found: dict[int, tuple[list[int], list[int]]] = {}
        for o, a, b in zip(owner[cut].tolist(), offset[cut].tolist(), offset[last].tolist() if len(owner) else []):
            a_list, b_list = found.setdefault(o, ([], []))
            a_list.append(a)
            b_list.append(b + LENGTH)
        for o, (a_list, b_list) in found.items():
            yield part[o][0], part[o][2], a_list, b_list


def _groups(rows: list) -> Iterator[tuple[int, int]]:
    """Cuts between buckets, so that about SORTED_AT_ONCE suffixes are sorted at once."""
    begin, size = 0, 0
    for i, r in enumerate(rows):
        if size >= SORTED_AT_ONCE and r[:2] != rows[i - 1][:2]:
            yield begin, i
            begin, size = i, 0
        size += len(r[5]) - LENGTH + 1
    if begin < len(rows):
        yield begin, len(rows)


def sort_buckets(distinct: DataFrame) -> DataFrame:
    """(anchor, span, starts, ends) of the different spans that hold repeated strings."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spans of a large bucket go to every part that one of their strings belongs to.
        for b in batches:
            of = b.column(5).to_numpy()
            take, part = [], []
            for i in range(b.num_rows):
                if of[i] <= 1:
                    take.append(i)
                    part.append(-1)
                else:
                    data = np.frombuffer(b.column(4)[i].as_py(), np.uint8)
                    pos = np.arange(len(data) - LENGTH + 1)
                    h = np.unique(span_hash(prefix_hashes(data), pos, pos + LENGTH) % np.uint64(of[i]))
                    take += [i] * len(h)
                    part += h.tolist()
            t = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(t), pa.array(part, pa.int64()), *(b.column(c).take(t) for c in (1, 2, 3, 4, 5))],
                ["anchor", "part", "span", "ahead", "n", "bytes", "of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out(done: list[tuple]) -> pa.RecordBatch:
            found = list(zip(*repeats(done))) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()),
                 pa.array(found[2], pa.list_(pa.int32())), pa.array(found[3], pa.list_(pa.int32()))],
                ["anchor", "span", "starts", "ends"])

        size = 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if size >= SORTED_AT_ONCE and r[:2] != rows[-1][:2]:
                    yield out(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[5]) - LENGTH + 1
        if rows:
            yield out(rows)

    parts = distinct.mapInArrow(split, "anchor bigint, part bigint, span bigint, ahead int, n bigint, bytes binary, of bigint")
    dealt = parts.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return dealt.mapInArrow(run, "anchor bigint, span bigint, starts array<int>, ends array<int>").groupBy("anchor", "span").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))


def cut(texts: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 from each text and its list of repeated spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, gone, runs, digest = [], [], [], []
            lists = b.column(2)
            for i, j, data, offs in text_chunks(b.column(1)):
                part = lists.slice(i, j - i)
                listed = part.is_valid().to_pylist()
                if any(listed):
                    row, lo, hi, _, gram, whole = spans(data, offs)
                    first = np.searchsorted(row, np.arange(j - i + 1))
                for d in range(j - i):
                    own = data[offs[d]:offs[d + 1]]
                    mark = None
                    if listed[d]:
                        mark = np.zeros(len(own) + 1, np.int32)
                        known = {(x["anchor"], x["span"]): (x["starts"], x["ends"]) for x in part[d].as_py()}
                        f = slice(first[d], first[d + 1])
                        for a, z, g, w in zip((lo[f] - offs[d]).tolist(), (hi[f] - offs[d]).tolist(),
                                              gram[f].view(np.int64).tolist(), whole[f].view(np.int64).tolist()):
                            if (g, w) in known:
                                starts, ends = known[g, w]
                                if starts is None:
                                    starts, ends = [0], [z + LENGTH - a]
                                for s, e in zip(starts, ends):
                                    mark[a + s] += 1
                                    mark[a + e] -= 1
                        mark = np.cumsum(mark[:-1]) > 0
                        edges = np.diff(mark.astype(np.int8), prepend=0)
                    size.append(len(own))
                    gone.append(int(mark.sum()) if mark is not None else 0)
                    runs.append(int((edges == 1).sum()) if mark is not None else 0)
                    digest.append(hashlib.sha256((own if mark is None else own[~mark]).tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return texts.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def dedup(docs: DataFrame) -> DataFrame:
    # What is removed depends on the text alone: doc_id and a text hash only name it.
    texts = docs.select(
        F.coalesce("doc_id", F.lit(-1)).alias("k"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"),
        F.coalesce("text", F.lit("")).alias("text"), "doc_id")
    found = anchors(texts.select("k", "t", "text"))
    shared = found.groupBy("anchor").agg(
        F.sum("n").alias("n"), F.min("span").alias("low"), F.max("span").alias("high")).where("n > 1").selectExpr(
        "anchor", "low = high as pure")
    known = materialise(found.select("k", "t", "anchor", "span").join(shared, "anchor"))
    wanted = known.where("not pure").groupBy("k", "t").agg(F.collect_set("anchor").alias("listed"))
    distinct = mixed_spans(texts.select("k", "t", "text").join(wanted, ["k", "t"]).select("text", "listed"))
    distinct = materialise(distinct.groupBy("anchor", "span", "ahead", "bytes").agg(F.count("*").alias("n")))
    parts = distinct.groupBy("anchor").agg(F.ceil(F.count("*") / BLOCK).cast("bigint").alias("of"))
    sorted_spans = sort_buckets(distinct.join(parts, "anchor").select("anchor", "span", "ahead", "n", "bytes", "of"))
    marks = known.where("pure").selectExpr(
        "k", "t", "anchor", "span", "cast(null as array<int>) as starts", "cast(null as array<int>) as ends").unionByName(
        known.where("not pure").drop("pure").join(sorted_spans, ["anchor", "span"]).select("k", "t", "anchor", "span", "starts", "ends"))
    lists = marks.groupBy("k", "t").agg(F.collect_list(F.struct("anchor", "span", "starts", "ends")).alias("found"))
    return cut(texts.join(lists, ["k", "t"], "left").select("doc_id", "text", "found"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"))
