"""Spelling variant grouping: words one edit apart, found by dynamic programming over sorted lists.

Two words one edit apart share their first half or their last half (of the
shorter word's length m: m // 2 signs in front, or m - m // 2 at the end), so
each word is dealt to the lists of its halves, those at the end with the word
reversed. In a list, sorted, every word of length m is compared with all words
of length m and m + 1: the scan goes depth by depth through the ranges of
words that share a prefix. The three cells of the banded edit matrix that
belong to a prefix are worked out once per query and range and reused by all
words of the range (adjacent common prefixes, LCP, tell where ranges split);
a range whose cells all exceed one edit is skipped with all words in it. All
queries of a list advance together in numpy.

Lists are dealt to buckets of about ``BUCKET`` rows by hash. A list of more
than ``BLOCK`` words is cut in parts by hash, and each pair of parts (queries
of one, words of the other) is scanned on its own, so no task holds an
unbounded list. A task returns per word the number of its near words and the
best of them, not the pairs. Forms are followed by pointer doubling: n at
least doubles along a chain, so few rounds end it.

Defined cases: null and empty texts have no words; a null doc_id is read as
the empty text in the typing rule; rows that repeat are counted each; an empty
table gives no rows; other columns are not read. A run of letters of any
length is one word; two words merge only if 64-bit hashes of unlike runs agree
within one shard of some megabytes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import lower, materialise, read, text_chunks
from ledgerline.llm.spans import SHARD_BYTES, distinct, gathered, runs, strings

#: Shortest word in code points and fewest occurrences.
SHORTEST, LEAST = 5, 3
#: One run in SLIPS, told by its crc32, loses a code point.
SLIPS = 97
BUCKET, BLOCK, QUERIES = 40_000, 20_000, 4096

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: The first byte of U+00C0 to U+00FF in UTF-8; the second one is any continuation byte.
_LEAD = 0xC3


@cache
def zeros_appended(n: int) -> np.ndarray:
    """Tables (4 x 256) of the linear map from crc32(a) to its share in crc32(a + n bytes)."""
    if n == 0:
        v = np.arange(256, dtype=np.uint32)
        return np.stack([v << np.uint32(8 * k) for k in range(4)])
    t = zeros_appended(n - 1)
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    return (t >> np.uint32(8)) ^ step[t & np.uint32(255)]


def joined_crc(heads: np.ndarray, tails: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of head + tail from the crc32 of both and the tail's length (array by array)."""
    out = np.zeros(len(heads), np.uint32)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            t, h = zeros_appended(int(size[part[0]])), heads[part]
            x = t[0][h & np.uint32(255)] ^ t[1][(h >> np.uint32(8)) & np.uint32(255)]
            x ^= t[2][(h >> np.uint32(16)) & np.uint32(255)] ^ t[3][h >> np.uint32(24)]
            out[part] = x ^ tails[part]
    return out


#: Tails of at most this many bytes go through the tables.
_TABLED = 64


def shard_words(ids: list, column: pa.Array, shortest: int, slips: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words of at least ``shortest`` code points with their counts, from the texts of one shard."""
    for a, b, data, offs in text_chunks(column, SHARD_BYTES):
        data = lower(data)
        solid = _LETTER[data] | (data == _LEAD)
        solid[1:] |= data[:-1] == _LEAD
        starts, ends, first = runs(solid, offs)
        if not len(starts):
            continue
        at, _, number = distinct(data, starts, ends)
        own = strings(data, starts[at], ends[at])
        raw = [s.encode() for s in own.to_pylist()]
        tails = np.array([zlib.crc32(s) for s in raw], np.uint32)
        size = (ends - starts)[at]
        text_of = np.repeat(np.arange(b - a), np.diff(first))
        names = [b"%s:" % (b"" if d is None else str(d).encode()) for d in ids[a:b]]
        heads = np.array([zlib.crc32(s) for s in names], np.uint32)
        short = size[number] <= _TABLED
        h = np.zeros(len(number), np.uint32)
        h[short] = joined_crc(heads[text_of[short]], tails[number[short]], size[number[short]])
        for i in np.flatnonzero(~short).tolist():
            h[i] = zlib.crc32(raw[number[i]], int(heads[text_of[i]]))
        slipped = np.flatnonzero(h % np.uint32(slips) == 0)
        count = np.bincount(number, minlength=len(at)) - np.bincount(number[slipped], minlength=len(at))
        points = size - np.array([s.count(b"\xc3") for s in raw])
        keep = np.flatnonzero((count > 0) & (points >= shortest))
        yield own.take(pa.array(keep)), count[keep]
        rest = Counter()
        for i in slipped.tolist():
            w = raw[number[i]].decode()
            if len(w) > shortest:
                cut = int(h[i]) % len(w)
                rest[w[:cut] + w[cut + 1:]] += 1
        yield pa.array(list(rest), pa.string()), np.array(list(rest.values()), np.int64)


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, slips: int = SLIPS) -> DataFrame:
    """(word, n): all words with their occurrences; counted per shard before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches):
            for words, n in shard_words(b.column(0).to_pylist(), b.column(1), shortest, slips):
                yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])

    counts = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def matrix(words: list[bytes], width: int) -> np.ndarray:
    """One row of ``width`` bytes per word, padded with 0 (below every letter)."""
    return np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width) if words else np.zeros((0, width), np.uint8)


def scan(queries: np.ndarray, query_list: np.ndarray, words: np.ndarray, sizes: np.ndarray, word_list: np.ndarray,
         shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) exactly one edit apart, within equal lists.

    ``queries`` (n x m) and ``words`` (n x m + 1, padded) are byte matrices;
    both are sorted by list, words then by themselves; all words of a list
    share their first ``shared`` bytes.
    """
    m = queries.shape[1]
    lcp = np.zeros(len(words), np.int64)
    if len(words) > 1:
        unlike = words[1:] != words[:-1]
        lcp[1:] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), m + 1)
        lcp[1:][word_list[1:] != word_list[:-1]] = -1
    padded = np.full((len(queries), m + 3), 255, np.uint8)
    padded[:, 1:m + 1] = queries
    out = []
    for base in range(0, len(queries), QUERIES):
        q = np.arange(base, min(base + QUERIES, len(queries)))
        lo = np.searchsorted(word_list, query_list[q], "left")
        hi = np.searchsorted(word_list, query_list[q], "right")
        live = hi > lo
        q, lo, hi = q[live], lo[live], hi[live]
        # Cells (depth, depth - 1), (depth, depth), (depth, depth + 1) of the edit matrix, 2 for more than one.
        left, mid, right = np.ones(len(q), np.uint8), np.zeros(len(q), np.uint8), np.ones(len(q), np.uint8)
        for d in range(shared, m + 2):
            ended = sizes[lo] == d
            if d >= m:
                near = ended & ((mid if d == m else left) == 1)
                out.append(np.stack([q[near], lo[near]]))
            lo = lo + ended
            live = lo < hi
            q, lo, hi, left, mid, right = (x[live] for x in (q, lo, hi, left, mid, right))
            if d > m or not len(q):
                break
            splits = np.flatnonzero(lcp <= d)
            a, b = np.searchsorted(splits, lo, "right"), np.searchsorted(splits, hi, "left")
            children = b - a + 1
            of = np.repeat(np.arange(len(q)), children)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(children) - children, children)
            # Each range splits where the next sign changes; the first part starts at lo, the last ends at hi.
            start = np.where(nth == 0, lo[of], splits[np.minimum(a[of] + nth - 1, max(len(splits) - 1, 0))] if len(splits) else lo[of])
            end = np.where(nth == children[of] - 1, hi[of], splits[np.minimum(a[of] + nth, max(len(splits) - 1, 0))] if len(splits) else hi[of])
            sign, own = words[start, d], padded[q[of]]
            x, y, z = left[of], mid[of], right[of]
            left = np.minimum(x + (sign != own[:, d]), y + 1)
            mid = np.minimum(np.minimum(y + (sign != own[:, d + 1]), z + 1), left + 1)
            right = np.minimum(z + (sign != own[:, d + 2]), mid + 1) if d + 2 <= m else np.full(len(of), 2, np.uint8)
            if d + 1 > m:
                mid = np.full(len(of), 2, np.uint8)
            near = np.minimum(np.minimum(left, mid), right) <= 1
            q, lo, hi = q[of][near], start[near], end[near]
            left, mid, right = (np.minimum(c[near], 2).astype(np.uint8) for c in (left, mid, right))
    pairs = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


_NEAR = "word string, n_near bigint, form_n bigint, form string"


def bucket_near(table: pa.Table) -> pa.Table:
    """For each word of a bucket of lists: how many near words it has there and the best of them."""
    word, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
    raw = np.array([w.encode("latin-1") for w in word.to_pylist()], object)
    m_of, back = table.column("m").to_numpy(), table.column("back").to_numpy(zero_copy_only=False)
    role = table.column("role").to_numpy()
    keys = np.array([f"{h}/{i}/{j}" for h, i, j in zip(
        table.column("half").to_pylist(), table.column("i").to_pylist(), table.column("j").to_pylist())])
    ask, found = [], []
    for m, reverse in sorted(set(zip(m_of.tolist(), back.tolist()))):
        rows = np.flatnonzero((m_of == m) & (back == reverse))
        own = [w[::-1] for w in raw[rows]] if reverse else raw[rows].tolist()
        wide, size = matrix(own, m + 1), np.array([len(w) for w in own])
        lists = np.unique(keys[rows], return_inverse=True)[1].reshape(-1)
        asking = np.flatnonzero((size == m) & (role[rows] & 1 > 0))
        asking = asking[np.argsort(lists[asking], kind="stable")]
        listed = np.flatnonzero(role[rows] & 2 > 0)
        listed = listed[np.lexsort((wide[listed].copy().view(f"S{m + 1}").reshape(-1), lists[listed]))]
        if not len(asking) or not len(listed):
            continue
        half = m // 2
        q, w = scan(wide[asking][:, :m], lists[asking], wide[listed], size[listed], lists[listed], m - half if reverse else half)
        q, w = asking[q], listed[w]
        if reverse:  # words that share their first half as well were found there
            front = matrix([x[:half] for x in raw[rows]], half)
            fresh = (front[q] != front[w]).any(axis=1)
            q, w = q[fresh], w[fresh]
        # Pairs of one length are found from both sides, the others from the shorter word only.
        longer = size[w] > m
        ask += [rows[q], rows[w[longer]]]
        found += [rows[w], rows[q[longer]]]
    ask = np.concatenate(ask) if ask else np.zeros(0, np.int64)
    found = np.concatenate(found) if found else ask
    rank = np.argsort(np.argsort(raw, kind="stable"), kind="stable")
    name = np.unique(word.to_numpy(zero_copy_only=False), return_inverse=True)[1].reshape(-1)
    order = np.lexsort((rank[found], -n[found], name[ask]))
    ask, found = ask[order], found[order]
    head = np.flatnonzero(np.diff(name[ask], prepend=-1)) if len(ask) else ask
    return pa.table({"word": word.take(pa.array(ask[head])), "n_near": np.diff(np.append(head, len(ask))),
                     "form_n": n[found[head]], "form": word.take(pa.array(found[head]))})


def near_words(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, n_near, form_n, form): near words counted, and the one of largest n, for words that have any."""
    size = F.length("word")
    halves = words.withColumn("m", F.explode(F.array(size, size - 1))).where(F.col("m") >= shortest).withColumn(
        "back", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("half", F.expr(
            "if(back, right(word, cast(m - floor(m / 2) as int)), left(word, cast(floor(m / 2) as int)))"))
    halves = materialise(halves)
    lists = halves.groupBy("m", "back", "half").agg(F.count("*").alias("n_words"), F.min(F.length("word")).alias("least"))
    # A list without a word of its own length asks nothing, one of a single word finds nothing.
    lists = lists.where("n_words > 1 and least = m")
    sums = lists.agg(F.sum("n_words")).first()[0] or 0
    rows = halves.join(lists, ["m", "back", "half"]).withColumn("parts", F.ceil(F.col("n_words") / BLOCK).cast("int")).withColumn(
        "part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    # In each pair of parts (i, j) the words of i ask (1) and those of j are listed (2).
    rows = rows.withColumn("at", F.explode(F.expr(
        "if(parts = 1, array(struct(0 as i, 0 as j, 3 as role)), concat("
        "transform(sequence(0, parts - 1), x -> struct(part as i, x as j, 1 as role)),"
        "transform(sequence(0, parts - 1), x -> struct(x as i, part as j, 2 as role))))"))).select(
        "word", "n", "m", "back", "half", "at.*")
    buckets = max(1, -(-int(sums) // BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("m", "back", "half", "i", "j"), F.lit(buckets)))
    near = rows.groupBy("bucket").applyInArrow(bucket_near, _NEAR)
    best = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.expr("min(struct(-form_n as k, form))").alias("best"))
    return best.select("word", "n_near", F.expr("-best.k").alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of (word, form): the last word reached by following forms."""
    ptr = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        hop = ptr.toDF("via", "further")
        ptr2 = materialise(ptr.join(hop, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if ptr2.where("moved").isEmpty():
            return ptr2.select("word", "root")
        ptr = ptr2.select("word", "root")


def group(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, slips: int = SLIPS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the corpus."""
    words = materialise(vocabulary(docs, shortest, least, slips))
    near = near_words(words, shortest)
    rows = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr("if(form_n >= 2 * n, form, null)").alias("form"), F.expr("if(form_n >= 2 * n, form_n, null)").alias("form_n")))
    named = roots(rows.where("form is not null"))
    return rows.join(named, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(read(spark, sf_dir, "documents"))
