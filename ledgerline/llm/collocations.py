"""Phrase collocation mining with weighted acyclic automata.

1. Words are counted per language.
2. A first pass over the pairs of neighbouring words adds up their counts by
   hash (sorted and delta-coded per shard and hash range, so a few bytes per
   distinct pair) and marks the pairs whose sum reaches the least count in a
   bit array of fixed size (``BITS``). No frequent phrase holds an unmarked
   pair; a pair marked by chance costs work, never a result.
3. Every shard of the corpus sorts its windows of up to ``LONGEST`` words in
   marked pairs and builds from them, in order, an acyclic automaton: one state
   per distinct prefix (language, then words), its weight the number of windows
   that pass, so the weight of a path is the phrase's count in the shard.
   States are not merged at the end of paths, as their weights differ.
4. Automata are cut by prefix range (a hash of language and first two words)
   and united range by range, level by level: equal (parent, word) arcs become
   one and weights are summed; a state below the least count is cut off with
   all that follows it. Single words come from step 1.
5. The paths left are the candidates. Both parts of every cut are looked up
   by walking the automaton of the part's own range.

A state meets one row per shard at most, however frequent the phrase, and the
number of ranges grows with the corpus, so no task holds an unbounded group.
Scores use DECIMAL(38) products, which are exact.

Defined cases: null and empty texts have no words; a null lang is ``und``;
rows that repeat are counted each; an empty table gives no rows; doc_id and
other columns are not read. Words of one language merge only if their 64-bit
hashes agree within one shard of some megabytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.common import lower, materialise, mix, prefix_hashes, read, span_hash, text_chunks
from ledgerline.llm.spans import distinct, gathered, numbers, runs, strings, varints

LONGEST, LEAST, TOP, UNKNOWN = 5, 100, 2000, "und"
#: A phrase goes if a longer candidate around it reaches this per cent of its count.
COVERED = 100
SCORE = ("(cast(a as decimal(19, 0)) * cast(n as decimal(19, 0)) * cast(1000 as decimal(4, 0))) div "
         "(cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
#: Bits of the array that marks frequent pairs, two per pair: 16 MB at any corpus size.
BITS = 1 << 27
#: Text bytes of a shard; a word takes some hundred bytes of working memory.
SHARD = 2 << 20
#: Word occurrences per range.
RANGE_WORDS = 2 << 20
#: Rows of a language are ranked in this many parts before they are ranked together.
PARTS = 64

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_SOLID = ~_BREAK
_SOLID[[0x20, 0x09]] = False


class Shard:
    """The words of some texts: distinct ones as strings, and the sequence of them by number."""

    def __init__(self, langs: list, a: int, b: int, data: np.ndarray, offs: np.ndarray):
        data = lower(data)
        starts, ends, first = runs(_SOLID[data], offs)
        names = [UNKNOWN if x is None else x for x in langs[a:b]]
        self.langs = sorted(set(names))
        of = {x: i for i, x in enumerate(self.langs)}
        text = np.repeat(np.arange(b - a), np.diff(first))
        #: Two words follow each other in a piece if this number is the same.
        self.piece = np.cumsum(_BREAK[data])[starts] + text if len(starts) else starts
        self.lang = np.array([of[x] for x in names], np.int64)[text]
        if len(starts):
            at, hashes, self.number = distinct(data, starts, ends)
            self.words = strings(data, starts[at], ends[at])
            self.hashes = hashes
        else:
            self.number, self.words, self.hashes = starts, pa.array([], pa.string()), np.zeros(0, np.uint64)
        #: A number for each distinct (language, word) and, per word occurrence, which one it is.
        self.pairs, self.pair = np.unique(self.lang * len(self.words) + self.number, return_inverse=True)
        self.pair = self.pair.reshape(-1)
        width = max(1, len(self.words))
        self.pair_lang, self.pair_word = self.pairs // width, self.pairs % width
        codes = np.array([lang_code(x) for x in self.langs], np.uint64)
        self.keys = word_keys(codes[self.pair_lang], self.hashes[self.pair_word]) if len(self.pairs) else np.zeros(0, np.uint64)


def lang_code(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def word_keys(codes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The key of a word in its language."""
    return mix(hashes ^ codes)


def prefix_range(first: np.ndarray, second: np.ndarray | None, ranges: int) -> np.ndarray:
    """The range (of a power of two) of phrases that begin with words of these keys."""
    h = mix(first) if second is None else mix(pair_hash(first, second))
    return (h >> np.uint64(40)).astype(np.int64) % ranges


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Shards of batches of (lang, text)."""
    for batch in gathered(batches, limit=SHARD):
        langs = batch.column(0).to_pylist()
        for a, b, data, offs in text_chunks(batch.column(1), SHARD):
            yield Shard(langs, a, b, data, offs)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, key, n) of every word of the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in shards(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.langs, pa.string()).take(pa.array(s.pair_lang)), s.words.take(pa.array(s.pair_word)),
                 pa.array(s.keys.view(np.int64)), pa.array(np.bincount(s.pair, minlength=len(s.pairs)), pa.int64())],
                ["lang", "word", "key", "n"])

    counts = docs.select("lang", "text").mapInArrow(run, "lang string, word string, key bigint, n bigint")
    return counts.groupBy("lang", "word").agg(F.first("key").alias("key"), F.sum("n").alias("n"))


def pair_keys(s: Shard) -> np.ndarray:
    """A hash of each word occurrence and the one after it; 0 at the end of a piece."""
    own = s.keys[s.pair]
    out = np.zeros(len(own), np.uint64)
    out[:-1] = pair_hash(own[:-1], own[1:])
    out[:-1][s.piece[:-1] != s.piece[1:]] = 0
    return out


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(3) + mix(second)) | np.uint64(1)


def key_bits(total: int) -> int:
    """Bits of a pair's key: a key is shared by fewer than one pair in 16."""
    return min(60, max(32, int(total).bit_length() + 4))


def frequent_pairs(docs: DataFrame, total: int, least: int, ranges: int) -> DataFrame:
    """(key): the top bits of the hashes of word pairs whose counts add up to ``least``."""
    width = key_bits(total)
    drop, each = np.uint64(64 - width), -(-(1 << width) // ranges)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in shards(batches):
            keys = pair_keys(s)
            kinds, n = np.unique((keys[keys > 0] >> drop).astype(np.int64), return_counts=True)
            if not len(kinds):
                continue
            part = kinds // each
            heads = np.flatnonzero(np.diff(part, prepend=-1))
            gap = np.diff(kinds, prepend=0)
            gap[heads] = kinds[heads]
            (raw, stop), (raw_n, stop_n) = varints(gap), varints(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[heads]), *(_slices(r, e[np.append(heads[1:], len(kinds)) - 1]) for r, e in ((raw, stop), (raw_n, stop_n)))],
                ["range", "gaps", "counts"])

    def add(table: pa.Table) -> pa.Table:
        gaps, sizes = _numbers(table.column("gaps"))
        n, _ = _numbers(table.column("counts"))
        keys = np.cumsum(gaps)
        first = np.cumsum(sizes) - sizes
        keys -= np.repeat(keys[first] - gaps[first], sizes)
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        head = np.flatnonzero(np.diff(keys, prepend=-1))
        return pa.table({"key": keys[head[np.add.reduceat(n, head) >= least]]})

    coded = docs.select("lang", "text").mapInArrow(count, "range bigint, gaps binary, counts binary")
    return coded.groupBy("range").applyInArrow(add, "key bigint")


def _slices(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    cuts = np.concatenate([[0], ends]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a column of ``varints``, and how many each row has."""
    raw = [x.as_buffer() for x in column]
    values, stop = numbers(np.frombuffer(b"".join(raw), np.uint8))
    return values, np.diff(np.searchsorted(stop, np.cumsum([len(x) for x in raw]), "right"), prepend=0)


def _bits(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.uint64))
    return h & np.uint64(size - 1), (h >> np.uint64(32)) & np.uint64(size - 1)


def marks(keys: DataFrame) -> np.ndarray:
    """The bit array of the keys, built by the executors; at most BITS / 64 numbers reach the driver."""
    size = BITS

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bit = np.unique(np.concatenate(_bits(b.column(0).to_numpy(), size))).astype(np.int64)
            cell = bit >> 6
            heads = np.flatnonzero(np.diff(cell, prepend=-1))
            value = np.bitwise_or.reduceat(np.uint64(1) << (bit & 63).astype(np.uint64), heads) if len(heads) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(cell[heads]), pa.array(value.view(np.int64))], ["cell", "bits"])

    cells = keys.mapInArrow(bits, "cell bigint, bits bigint").groupBy("cell").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out.view(np.uint64)


def marked(array: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for bit in _bits(keys, 64 * len(array)):
        out &= (array[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


#: An automaton in preorder: of every state its depth (0 for the language), the label of the arc to it (a place in
#: ``labels``) and its weight, both as ``varints``.
_AUTOMATON = "range bigint, labels array<string>, depth binary, label binary, weight binary"


def automaton(windows: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States (depth, label, weight) in preorder from sorted distinct windows (rows padded with -1).

    Built in order: a window adds the states that its predecessor does not share.
    """
    wide = windows.shape[1]
    unlike = np.ones((len(windows), wide), bool)
    unlike[1:] = windows[1:] != windows[:-1]
    shared = np.where(unlike.any(axis=1), unlike.argmax(axis=1), wide)
    depths = np.arange(wide)
    new = (depths >= shared[:, None]) & (depths < sizes[:, None])
    weight = np.zeros(windows.shape, np.int64)
    for d in range(wide):
        # Windows that pass depth d, summed over the stretch of rows that share the prefix.
        passing = np.where(sizes > d, weights, 0)
        heads = np.flatnonzero(shared <= d)
        weight[heads, d] = np.add.reduceat(passing, heads)
    row, depth = np.nonzero(new)
    return depth.astype(np.uint8), windows[row, depth], weight[row, depth]


def shard_automata(s: Shard, follows: np.ndarray, longest: int, ranges: int) -> Iterator[tuple]:
    """(range, labels, depth, label, weight) of the shard's windows of two words and more.

    ``follows`` marks the word occurrences that a window may join with the next one.
    """
    at = np.flatnonzero(follows)
    if not len(at):
        return
    size, more = np.full(len(at), 2), np.ones(len(at), bool)
    for k in range(2, longest):
        more &= follows[np.minimum(at + k - 1, len(follows) - 1)]
        size += more
    windows = np.full((len(at), longest + 1), -1, np.int64)
    windows[:, 0] = s.lang[at]
    for k in range(longest):
        has = size > k
        windows[has, k + 1] = s.number[at[has] + k]
    part = prefix_range(s.keys[s.pair[at]], s.keys[s.pair[at + 1]], ranges)
    packed = [windows[:, i] + 1 if i + 1 > longest else (windows[:, i] + 1 << 32) | (windows[:, i + 1] + 1) for i in range(0, longest + 1, 2)]
    order = np.lexsort((*packed[::-1], part))
    head = np.zeros(len(order), bool)
    head[0] = True
    for column in (part, *packed):
        head[1:] |= column[order[1:]] != column[order[:-1]]
    head = np.flatnonzero(head)
    weights = np.diff(np.append(head, len(order)))
    order = order[head]
    part, windows, size = part[order], windows[order], size[order] + 1
    cuts = np.flatnonzero(np.diff(part)) + 1
    for rows in np.split(np.arange(len(part)), cuts):
        depth, label, weight = automaton(windows[rows], size[rows], weights[rows])
        lang = depth == 0
        own, place = np.unique(label[~lang], return_inverse=True)
        number = np.empty(len(label), np.int64)
        number[~lang] = place.reshape(-1)
        number[lang] = label[lang] + len(own)
        labels = pa.concat_arrays([s.words.take(pa.array(own)), pa.array(s.langs, pa.string())])
        yield int(part[rows[0]]), labels, depth, number, weight


def _row(part: int, labels: pa.Array, depth: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[pa.Array]:
    return [pa.array([part], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(labels)], pa.int32()), labels.cast(pa.string())),
            *(pa.array([x.tobytes()], pa.binary()) for x in (depth, varints(label)[0], varints(weight)[0]))]


_NAMES = ["range", "labels", "depth", "label", "weight"]


class Automaton:
    """One automaton read back; states in preorder, with parents."""

    def __init__(self, labels: pa.Array, depth: pa.Buffer, label: pa.Buffer, weight: pa.Buffer):
        self.labels, self.depth = labels, np.frombuffer(depth, np.uint8)
        self.label, self.weight = (numbers(np.frombuffer(x, np.uint8))[0] for x in (label, weight))
        self.parent = np.full(len(self.depth), -1)
        for d in range(1, int(self.depth.max(initial=0)) + 1):
            above, here = np.flatnonzero(self.depth == d - 1), np.flatnonzero(self.depth == d)
            self.parent[here] = above[np.searchsorted(above, here) - 1]


def rows_of(table: pa.Table) -> Iterator[Automaton]:
    for labels, *rest in zip(*(table.column(c) for c in _NAMES[1:])):
        yield Automaton(labels.values, *(x.as_buffer() for x in rest))


def united(parts: list[Automaton], words: list[tuple[str, str, int]], least: int):
    """Labels, depth, label and weight of the union; states below ``least`` and what follows them are left out.

    Weights of single words are taken from ``words`` (lang, word, count) only.
    """
    langs, own, n_of = (list(x) for x in zip(*words)) if words else ([], [], [])
    held = [p.labels for p in parts] + [pa.array(langs, pa.string()), pa.array(own, pa.string())]
    every = pc.dictionary_encode(pa.concat_arrays([x.cast(pa.string()) for x in held]))
    names, places = every.dictionary, np.split(every.indices.to_numpy().astype(np.int64), np.cumsum([len(x) for x in held])[:-1])
    number, singles = places[:-2], list(zip(places[-2].tolist(), places[-1].tolist(), n_of))
    deepest = max([1, *(int(p.depth.max(initial=0)) for p in parts)])
    label, parent, weight = [], [], []  # of each level
    state = [np.full(len(p.depth), -1) for p in parts]
    for d in range(deepest + 1):
        at = [np.flatnonzero(p.depth == d) for p in parts]
        if d:
            at = [a[s[p.parent[a]] >= 0] for a, s, p in zip(at, state, parts)]
        arcs = [(s[p.parent[a]] if d else np.zeros(len(a), np.int64)) * len(names) + m[p.label[a]]
                for a, s, p, m in zip(at, state, parts, number)]
        counts = [p.weight[a] for a, p in zip(at, parts)]
        if d == 0:
            arcs.append(np.array([x[0] for x in singles], np.int64))
            counts.append(np.zeros(len(singles), np.int64))
        if d == 1:
            counts = [np.zeros(len(c), np.int64) for c in counts]
            of = {int(x): i for i, x in enumerate(label[0])}
            arcs.append(np.array([of[x[0]] * len(names) + x[1] for x in singles], np.int64))
            counts.append(np.array([x[2] for x in singles], np.int64))
        kinds, which = np.unique(np.concatenate(arcs), return_inverse=True)
        total = np.zeros(len(kinds), np.int64)
        np.add.at(total, which.reshape(-1), np.concatenate(counts))
        keep = total >= least if d > 1 else np.ones(len(kinds), bool)
        place = np.where(keep, np.cumsum(keep) - 1, -1)
        label.append(kinds[keep] % max(1, len(names)))
        parent.append(kinds[keep] // max(1, len(names)))
        weight.append(total[keep])
        begin = 0
        for a, s in zip(at, state):
            s[a] = place[which.reshape(-1)[begin:begin + len(a)]]
            begin += len(a)
    # Preorder: sort all states by their path of places.
    paths = np.full((sum(map(len, label)), deepest + 1), -1, np.int64)
    begin, above = 0, None
    for d, (l, p) in enumerate(zip(label, parent)):
        here = paths[begin:begin + len(l)]
        if d:
            here[:, :d] = above[p][:, :d]
        here[:, d] = np.arange(len(l))
        above, begin = here, begin + len(l)
    order = np.lexsort(paths.T[::-1])
    depth = np.repeat(np.arange(deepest + 1), [len(x) for x in label]).astype(np.uint8)
    used, place = np.unique(np.concatenate(label), return_inverse=True)
    return names.take(pa.array(used)), depth[order], place.reshape(-1)[order], np.concatenate(weight)[order]


def count_automata(docs: DataFrame, counts: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, int]:
    """One automaton per prefix range with the count of every phrase of up to ``longest`` words and ``least`` occurrences."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    ranges = 8
    while ranges * RANGE_WORDS < total:
        ranges *= 2
    frequent = counts.where(F.col("n") >= least)
    drop = np.uint64(64 - key_bits(total))
    array = docs.sparkSession.sparkContext.broadcast(marks(frequent_pairs(docs, total, least, ranges)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in shards(batches):
            keys = pair_keys(s)
            for row in shard_automata(s, (keys > 0) & marked(array.value, keys >> drop), longest, ranges):
                yield pa.RecordBatch.from_arrays(_row(*row), _NAMES)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("key").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(prefix_range(key, None, ranges)), b.column("lang"), b.column("word"), b.column("n")],
                                             ["of", "lang", "word", "n"])

    def unite(key, left: pa.Table, right: pa.Table) -> pa.Table:
        words = list(zip(*(right.column(c).to_pylist() for c in ("lang", "word", "n"))))
        part = next(k.as_py() for k in key if k.is_valid)
        return pa.Table.from_arrays(_row(part, *united(list(rows_of(left)), words, least)), _NAMES)

    pieces = docs.select("lang", "text").mapInArrow(build, _AUTOMATON)
    singles = frequent.select("lang", "word", "key", "n").mapInArrow(place, "of bigint, lang string, word string, n bigint")
    return materialise(pieces.groupBy("range").cogroup(singles.groupBy("of")).applyInArrow(unite, _AUTOMATON)), ranges


def phrases(automata: DataFrame) -> DataFrame:
    """(lang, phrase, size, a): every path of two words and more, spelt out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in rows_of(pa.Table.from_batches([b])):
                names = x.labels.to_pylist()
                path, lang = [""] * len(x.depth), [""] * len(x.depth)
                for i, (d, l, p) in enumerate(zip(x.depth.tolist(), x.label.tolist(), x.parent.tolist())):
                    lang[i] = lang[p] if d else names[l]
                    path[i] = (path[p] + " " + names[l]) if d > 1 else names[l] if d else ""
                at = np.flatnonzero(x.depth >= 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang, pa.string()).take(pa.array(at)), pa.array(path, pa.string()).take(pa.array(at)),
                     pa.array(x.depth[at], pa.int32()), pa.array(x.weight[at])], ["lang", "phrase", "size", "a"])

    return automata.mapInArrow(run, "lang string, phrase string, size int, a bigint")


def counts_of(parts: DataFrame, automata: DataFrame, ranges: int) -> DataFrame:
    """(lang, part, f) of the distinct rows (lang, part) that the automata count, each walked in its range's automaton."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            words = [x.split(" ", 2) for x in b.column("part").to_pylist()]
            codes = np.array([lang_code(x) for x in b.column("lang").to_pylist()], np.uint64)
            first, second = (word_keys(codes, _hashes([w[i] if len(w) > i else "" for w in words])) for i in (0, 1))
            one = np.array([len(w) == 1 for w in words])
            of = np.where(one, prefix_range(first, None, ranges), prefix_range(first, second, ranges))
            yield pa.RecordBatch.from_arrays([pa.array(of), b.column("lang"), b.column("part")], ["of", "lang", "part"])

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"lang": pa.array([], pa.string()), "part": pa.array([], pa.string()), "f": pa.array([], pa.int64())})
        (x,) = rows_of(left)
        number = {w: i for i, w in enumerate(x.labels.to_pylist())}
        langs, parts = right.column("lang").to_pylist(), right.column("part").to_pylist()
        width = len(number) + 1
        steps = [[number.get(w, -1) for w in (lang, *part.split(" "))] for lang, part in zip(langs, parts)]
        arcs = (x.parent + 1) * width + x.label
        order = np.argsort(arcs, kind="stable")
        arcs = arcs[order]
        at, size = np.full(len(steps), -1), np.array([len(s) for s in steps])
        ok = np.ones(len(steps), bool)
        for d in range(int(size.max())):
            i = np.flatnonzero(ok & (size > d))
            want = (at[i] + 1) * width + np.array([steps[k][d] for k in i.tolist()], np.int64)
            place = np.minimum(np.searchsorted(arcs, want), len(arcs) - 1)
            hit = (arcs[place] == want) & (np.array([steps[k][d] for k in i.tolist()]) >= 0)
            at[i], ok[i] = np.where(hit, order[place], -1), hit
        i = np.flatnonzero(ok)
        return pa.table({"lang": pa.array(langs, pa.string()).take(pa.array(i)), "part": pa.array(parts, pa.string()).take(pa.array(i)),
                         "f": x.weight[at[i]]})

    dealt = parts.distinct().mapInArrow(place, "of bigint, lang string, part string")
    return automata.groupBy("range").cogroup(dealt.groupBy("of")).applyInArrow(walk, "lang string, part string, f bigint")


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return span_hash(prefix_hashes(np.frombuffer(b"".join(raw), np.uint8)), np.concatenate([[0], ends[:-1]]), ends)


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """Each language's first ``top`` phrases by score."""
    counts = materialise(word_counts(docs))
    automata, ranges = count_automata(docs, counts, longest, least)
    found = materialise(phrases(automata))
    words = F.split("phrase", " ")
    # A phrase inside a longer one that is as frequent goes.
    inner = found.where("size > 2").select("lang", "a", "size", words.alias("w")).select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(0, size - m), i -> array_join(slice(w, i + 1, m), ' '))))")).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = found.join(inner, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {covered} * a").drop("longer")
    cuts = materialise(left.withColumn("w", words).withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
        F.expr("array_join(slice(w, k + 1, size), ' ')").alias("tail")))
    parts = cuts.select("lang", F.col("head").alias("part")).unionByName(cuts.select("lang", F.col("tail").alias("part")))
    known = materialise(counts_of(parts, automata, ranges))
    whole = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    scored = cuts.join(known.toDF("lang", "head", "l"), ["lang", "head"]).join(known.toDF("lang", "tail", "r"), ["lang", "tail"])
    scored = scored.join(whole, "lang").withColumn("score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn(
        "part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for within in ("lang, part", "lang"):  # a language's rows meet only after each part kept its first ones
        ranked = ranked.withColumn("rank", F.expr(f"row_number() over (partition by {within} order by score desc, a desc, phrase)")).where(
            F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read(spark, sf_dir, "documents"))
