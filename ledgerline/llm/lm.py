"""LM scoring: corpus word counts for the base score, a causal attention model for the score.

Encoding: every text is cut into words and every word into ids of a public byte-level tokenizer once. Each task deals
its documents into buckets of about ``BUCKET`` bytes and writes, per document, its ids and the place of each of its words
among the bucket's distinct words, and those words with their hashes (64 bit) and training counts. No text is shuffled.

Base: a bucket's distinct words join the corpus counts and come back to the bucket, so neither
the vocabulary nor the counts are ever broadcast or collected.

Model: the ids' counts over all training words give the classes and, for the ids that share a class, the trees inside
(``attention``): every id is predicted from the ids before it, first its class, then the id in its class, and each has
its own place in both. Every id of every training document is predicted once in
training: a document is cut into windows of ids, one after the other, and the last is padded. Training is
data-parallel and streams over the documents, nothing more is written for it: the documents are dealt into
``ROUNDS`` parts, each task runs Adam over the windows of its documents of one part from the common
parameters, and the results are averaged by Spark before the next part: the common ones by windows, what an id or an
inner node has for itself by the tokens that touched it, and only such rows leave a task. The parameters (a few thousand
numbers and two rows per id of the vocabulary), the classes and the trees are all that is sent to the tasks.

Defined cases: a null text counts as empty; an empty text has the end token
only; rows with a null doc_id are scored, learnt from and not held out;
repeated rows are learnt from and scored each; without any training token N
and V are 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import attention as A
from ledgerline.llm.common import lower, materialise, mix, prefix_hashes, read, remainder, span_hash, text_chunks, words
from ledgerline.llm.wordpieces import END_TOKEN, VOCABULARY, spans_ids

#: Bytes of text in a bucket; more make fewer rows of words and larger groups. Results do not depend on it.
BUCKET = 16 << 20
#: Bytes handled at once in a bucket; a token takes some 200 bytes of working memory.
CHUNK = 1 << 20
#: Ids beyond the vocabulary in a window: before a text and after its end.
START_ID, PADDING = VOCABULARY, VOCABULARY + 1
#: A text whose words are one id each gives one training window per so many words, and one for the rest with its end.
WORDS_PER_WINDOW = A.LENGTH
#: Parts of the training documents, learnt one after the other from common parameters.
ROUNDS = 2
#: Bytes of text per training task; more make more tasks.
TASK = 16 << 20
#: Words whose ids a worker keeps; it starts anew beyond that.
LEXICON = 1_000_000
#: The end of a text as a word; no word hashes to it but by a 64-bit collision.
END = np.uint64(0x656E640000000001)
#: Rows of documents (up to places), of a bucket's words (bucket, word, at, n) and of ids (at, n).
ENCODED = pa.schema([("bucket", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("part", pa.int32()),
                     ("size", pa.int64()), ("ids", pa.binary()), ("places", pa.binary()), ("word", pa.int64()), ("at", pa.int32()), ("n", pa.int64())])


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, word starts and ends, word hashes and first word of each text."""
    data = lower(data)
    starts, ends, first = words(data, offs)
    return data, starts, ends, span_hash(prefix_hashes(data), starts, ends), first


class Lexicon:
    """Different words and their ids; every word is encoded once, when it first comes. Row 0 is the end of a text, the
    words have the ``rows`` after it.

    The tables have room to grow, so that a chunk costs no copy of what is there; hashes that came lately are kept apart
    until they are an eighth of the others.
    """

    def __init__(self) -> None:
        self.known = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]  # sorted hashes and their rows
        self.ids, self.begin, self.size = np.zeros(1 << 12, np.int32), np.zeros(1 << 10, np.int32), np.zeros(1 << 10, np.int32)
        self.ids[0], self.size[0], self.rows, self.used = END_TOKEN, 1, 0, 1

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        table = getattr(self, name)
        if at + len(values) > len(table):
            table = np.concatenate([table[:at], np.zeros(max(at, len(values)) + len(values), np.int32)])
            setattr(self, name, table)
        table[at:at + len(values)] = values

    def rows_of(self, kind: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row of each of the sorted different words ``kind``, which lie at starts:ends."""
        row = np.full(len(kind), -1, np.int32)
        for word, own in self.known:
            if len(word):
                at = np.minimum(np.searchsorted(word, kind), len(word) - 1)
                row = np.where(word[at] == kind, own[at], row)
        new = np.flatnonzero(row < 0)
        if len(new):
            ids, size = spans_ids(data, starts[new], ends[new])
            self._put("ids", self.used, ids)
            self._put("size", self.rows + 1, size)
            self._put("begin", self.rows + 1, self.used + np.cumsum(size) - size)
            row[new] = self.rows + 1 + np.arange(len(new), dtype=np.int32)
            self.rows, self.used = self.rows + len(new), self.used + len(ids)
            self._keep(1, kind[new], row[new])
            if len(self.known[1][0]) > len(self.known[0][0]) // 8:
                self._keep(0, *self.known[1])
                self.known[1] = (kind[:0], row[:0])
        return row

    def _keep(self, i: int, kind: np.ndarray, row: np.ndarray) -> None:
        word, own = self.known[i]
        at = np.searchsorted(word, kind)
        self.known[i] = np.insert(word, at, kind), np.insert(own, at, row)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and how many each has."""
        return self.ids[:self.used], self.size[:self.rows + 1]

    def ids_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given rows, one after the other, and how many each row has."""
        length = self.size[rows]
        end = np.cumsum(length, dtype=np.int64)
        at = np.repeat(self.begin[rows] - (end - length), length)
        at += np.arange(len(at))
        return self.ids[at], length


_LEXICON: list[Lexicon] = []


def worker_lexicon() -> Lexicon:
    """The worker's lexicon, which goes on from one task to the next; its rows hold until the next call."""
    if not _LEXICON or _LEXICON[0].rows > LEXICON:
        _LEXICON[:] = [Lexicon()]
    return _LEXICON[0]


def text_ids(rows: np.ndarray, first: np.ndarray, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, word after word, each text closed by the end id; text d has the words first[d]:first[d + 1]
    and gets the ids bound[d]:bound[d + 1]."""
    ids, length = lexicon.ids_of(np.insert(rows, first[1:], 0))
    # Ids before each piece; text d starts at piece first[d] + d.
    return ids, np.concatenate([[0], np.cumsum(length, dtype=np.int64)])[first + np.arange(len(first))]


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted different hashes, a place of each, and which of them each hash is: np.unique by hashing."""
    coded = pa.array(h).dictionary_encode()
    of, kind = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    place = np.empty(len(kind), np.int64)
    place[of[::-1]] = np.arange(len(h) - 1, -1, -1)
    order = np.argsort(kind)
    rank = np.empty(len(kind), np.int32)
    rank[order] = np.arange(len(kind), dtype=np.int32)
    return kind[order], place[order], rank[of]


def packed(values: np.ndarray, bound: np.ndarray) -> pa.Array:
    """values[bound[i]:bound[i + 1]] as the bytes of row i."""
    offsets = (bound * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bound) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array | pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values and bounds that ``packed`` was given."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column, width = column.cast(pa.large_binary()), np.dtype(kind).itemsize
    _, offsets, data = column.buffers()
    bound = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, kind, (bound[-1] - bound[0]) // width, bound[0]) if bound[-1] > bound[0] else np.zeros(0, kind)
    return values, (bound - bound[0]) // width


def batch_of(many: int, **columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    """``many`` rows of ENCODED, null in the columns that are not given."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name]).cast(f.type) if f.name in columns else pa.nulls(many, f.type) for f in ENCODED], schema=ENCODED)


def bucket_rows(bucket: int, chunks: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The rows of a bucket's documents, and those of its distinct words with the end of a text as the last."""
    kind, of = np.unique(np.concatenate([c[0] for c in chunks]), return_inverse=True)
    place, n, a = of.astype(np.int32), np.zeros(len(kind) + 1, np.int64), 0
    for own, many, word, first, docs in chunks:
        at = place[a:a + len(own)]
        a += len(own)
        n[at] += many
        n[-1] += int((~docs["held_out"]).sum())
        yield batch_of(len(first) - 1, bucket=np.full(len(first) - 1, bucket), places=packed(at[word], first), **docs)
    yield batch_of(len(n), bucket=np.full(len(n), bucket), word=np.append(kind, END).view(np.int64), at=np.arange(len(n)), n=n)


def encoded(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, held_out) as rows of ENCODED: ids of each text as 16-bit numbers, ``places`` of its words
    among the bucket's distinct words as 32-bit numbers; of each of those its hash, place and training count; of each
    id its training count over words and ends of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, chunks, held_bytes = np.zeros(VOCABULARY, np.int64), [], 0
        bucket = row = TaskContext.get().partitionId() << 32
        for b in batches:
            held = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for i, j, data, offs in text_chunks(b.column("text"), CHUNK):
                lexicon = worker_lexicon()
                data, starts, ends, h, first = word_hashes(data, offs)
                kind, at, of = distinct(h)
                rows = lexicon.rows_of(kind, data, starts[at], ends[at])
                n = np.bincount(of[np.repeat(~held[i:j], np.diff(first))], minlength=len(kind))
                found, size = lexicon.ids_of(rows)
                ids += np.bincount(found, np.repeat(n, size), VOCABULARY).astype(np.int64)
                ids[END_TOKEN] += int((~held[i:j]).sum())
                token, bound = text_ids(rows[of], first, lexicon)
                chunks.append((kind, n, of, first, {
                    "row": np.arange(row, row + j - i), "doc_id": b.column("doc_id").slice(i, j - i), "held_out": held[i:j],
                    "part": b.column("part").slice(i, j - i), "size": np.diff(offs), "ids": packed(token.astype(np.uint16), bound)}))
                row += j - i
                held_bytes += len(data)
                if held_bytes >= BUCKET:
                    yield from bucket_rows(bucket, chunks)
                    bucket, chunks, held_bytes = bucket + 1, [], 0
        if chunks:
            yield from bucket_rows(bucket, chunks)
        used = np.flatnonzero(ids)
        if len(used):
            yield batch_of(len(used), at=used, n=ids[used])

    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).cast("int").alias("part")
    return docs.select("doc_id", "text", "held_out", part).mapInArrow(
        run, "bucket bigint, row bigint, doc_id bigint, held_out boolean, part int, size bigint, ids binary, places binary, word bigint, at int, n bigint")


def id_chunks(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, bounds) of consecutive rows whose texts had CHUNK bytes; a longer text is alone."""
    ids, bound = unpacked(b.column("ids"), np.uint16)
    offs = np.concatenate([[0], np.cumsum(b.column("size").to_numpy())])
    i = 0
    while i < b.num_rows:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + CHUNK, side="right")) - 1)
        yield i, j, ids[bound[i]:bound[j]], bound[i:j + 1] - bound[i]
        i = j


def cut_windows(ids: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Rows of LENGTH + 1 ids: each text's ids in order, LENGTH a row after the id before them. START_ID leads
    a text, PADDING fills up its last row."""
    size = np.diff(bound)
    many = -(-size // A.LENGTH)
    text = np.repeat(np.arange(len(size)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    place = nth[:, None] * A.LENGTH + np.arange(A.LENGTH + 1)
    inside = place <= size[text, None]
    out = np.where(inside, ids[np.where(inside, bound[text, None] + place - 1, 0)], PADDING)
    out[nth == 0, 0] = START_ID
    return out


def windows(docs: DataFrame) -> DataFrame:
    """(ids): the training windows as a table; every id of every training document is predicted in one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, ids, bound in id_chunks(b):
                yield pa.RecordBatch.from_arrays([pa.array(cut_windows(ids, bound).tolist(), pa.list_(pa.int32()))], ["ids"])

    return encoded(docs).where("ids is not null and not held_out").select("ids", "size").mapInArrow(run, "ids array<int>")


def classes_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every id, log share of every id in its class, and class counts, from the ids' corpus counts."""
    own = np.argsort(-ids, kind="stable")[:A.OWN]
    of = A.OWN + (mix(np.arange(VOCABULARY, dtype=np.uint64)) % np.uint64(A.CLASSES - A.OWN)).astype(np.int64)
    of[own] = np.arange(A.OWN)
    smooth = ids + 0.01
    whole = np.bincount(of, smooth, A.CLASSES)
    return of, np.log(smooth / whole[of]), np.bincount(of, ids, A.CLASSES)


def fit(docs: DataFrame, chars: int, of: np.ndarray, class_counts: np.ndarray) -> np.ndarray:
    """Common parameters learnt from every training document."""
    return learnt(encoded(docs), chars, of, class_counts, A.Tree(np.ones(VOCABULARY), of))[0]


def learnt(table: DataFrame, size: int, of: np.ndarray, class_counts: np.ndarray, tree: A.Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data-parallel training on every encoded training document: local steps from common parameters, averaged by Spark
    after each part of the documents. Common parameters, then the tables of the ids' own inputs and of inner nodes."""
    wide = A.WIDTH + 1
    flat, own = A.initial(class_counts), A.Ids(tree)
    inputs, nodes = own.inputs.table, own.nodes.table
    common = -(-A.SIZE // wide)  # rows of WIDTH + 1 numbers: common ones, inputs, nodes
    classes = np.append(of, [A.START, -1])  # START_ID, PADDING
    for nth in range(ROUNDS):
        def run(batches: Iterator[pa.RecordBatch], flat=flat, inputs=inputs, nodes=nodes) -> Iterator[pa.RecordBatch]:
            learner, seen = None, 0
            for b in batches:
                for _, _, ids, bound in id_chunks(b):
                    learner = learner or A.Learner(flat, own=A.Ids(tree, inputs, nodes))
                    w = cut_windows(ids, bound)
                    learner.learn(classes[w], w)
                    seen += len(w)
            if seen:
                begin = 0
                for rows, weight in ((np.pad(learner.flat, (0, common * wide - A.SIZE)).reshape(common, wide), np.full(common, seen)),
                                     (np.pad(learner.own.inputs.table, ((0, 0), (0, 1))), learner.own.inputs.seen),
                                     (learner.own.nodes.table, learner.own.nodes.seen)):
                    at = np.flatnonzero(weight)
                    sums = rows[at].astype(np.float64) * weight[at, None]
                    yield pa.RecordBatch.from_arrays([pa.array((begin + at).astype(np.int32)), *(pa.array(x) for x in sums.T), pa.array(weight[at])],
                                                     ["i", *(f"v{k}" for k in range(wide)), "w"])
                    begin += len(rows)

        texts = table.where("ids is not null and not held_out").where(F.col("part") == nth).select("ids", "size").coalesce(max(1, -(-size // TASK)))
        numbers = ", ".join(f"v{k} double" for k in range(wide))
        means = texts.mapInArrow(run, f"i int, {numbers}, w bigint").groupBy("i").agg(
            *[(F.sum(f"v{k}") / F.sum("w")).alias(f"v{k}") for k in range(wide)]).toArrow()  # two rows per id at most
        if means.num_rows:
            at = means.column("i").to_numpy()
            rows = np.zeros((common + len(inputs) + len(nodes), wide))
            rows[common:common + len(inputs), :A.WIDTH], rows[common + len(inputs):] = inputs, nodes
            rows[at] = np.stack([means.column(f"v{k}").to_numpy() for k in range(wide)], axis=1)
            flat = rows[:common].ravel()[:A.SIZE]
            inputs = rows[common:common + len(inputs), :A.WIDTH].astype(np.float32)
            nodes = rows[common + len(inputs):].astype(np.float32)
    return flat, inputs, nodes


def base_sums(table: DataFrame, known: DataFrame) -> DataFrame:
    """(row, n_tokens, n_known, logs) of every document, from the corpus counts c of its bucket's words; logs is the sum
    of log10(c + 1). A row without row number gives the training words that are counted at this bucket."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c = np.zeros(right.num_rows, np.int64)
        c[right.column("at").to_numpy()] = right.column("c").to_numpy()
        word, first = unpacked(left.column("places"), np.int32)
        log, size = np.log10(c + 1), np.diff(first)
        of = np.repeat(np.arange(len(size)), size)
        sums, seen = (np.bincount(of, x[word], len(size)) for x in (log, c > 0))
        own = right.column("own").to_numpy(zero_copy_only=False).astype(bool) & (right.column("c").to_numpy() > 0)
        row = left.column("row").to_numpy()
        return pa.table({
            "row": pa.array(np.append(row, 0), mask=np.arange(len(row) + 1) == len(row)),
            "n_tokens": pa.array(np.append(size + 1, 0)),
            "n_known": pa.array(np.append(seen.astype(np.int64) + int(c[-1] > 0), 0)),
            "logs": pa.array(np.append(sums + log[-1], 0.0)),
            "kinds": pa.array(np.append(np.zeros(len(row), np.int64), own.sum()))})

    left = table.where("ids is not null").select("bucket", "row", "places")
    return left.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(run, "row bigint, n_tokens bigint, n_known bigint, logs double, kinds bigint")


def model_scores(table: DataFrame, flat: np.ndarray, of: np.ndarray, tree: A.Tree, inputs: np.ndarray, nodes: np.ndarray) -> DataFrame:
    """(row, doc_id, held_out, score) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, own, ten = A.unpack(flat), A.Ids(tree, inputs, nodes), np.log(10)
        tables = A.look_up(p, own, of)
        for b in batches:
            out = [np.zeros(0)]
            for _, _, token, bound in id_chunks(b):
                logs = A.score(p, of[token], bound, own=own, ids=token, tables=tables)
                run_sum = np.concatenate([[0], np.cumsum(logs)])
                out.append((run_sum[bound[1:]] - run_sum[bound[:-1]]) / ten)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), b.column("held_out"), pa.array(np.concatenate(out))],
                                             ["row", "doc_id", "held_out", "score"])

    docs = table.where("ids is not null").select("row", "doc_id", "held_out", "size", "ids")
    return docs.mapInArrow(run, "row bigint, doc_id bigint, held_out boolean, score double")


def language_model(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"))
    table = materialise(encoded(rows), compression="zstd")
    both = table.agg(F.sum("size").alias("size"), F.sum(F.expr("if(word is null, 0, n)")).alias("total")).first()
    ids = np.zeros(VOCABULARY, np.int64)
    for r in table.where("bucket is null").groupBy("at").agg(F.sum("n").alias("n")).collect():  # VOCABULARY rows at most
        ids[r.at] = r.n
    # Each word is counted as one kind at the first of its buckets.
    known = table.where("word is not null").selectExpr(
        "bucket", "at", "sum(n) over (partition by word) AS c", "min(bucket) over (partition by word) = bucket AS own")
    base = materialise(base_sums(table, known))
    total, kinds = int(both.total or 0), int(base.agg(F.sum("kinds").alias("n")).first().n or 0)
    of, _, class_counts = classes_of(ids)
    tree = A.Tree(ids + 0.01, of)
    flat, inputs, nodes = learnt(table, both.size or 0, of, class_counts, tree)
    return model_scores(table, flat, of, tree, inputs, nodes).join(base.where("row is not null").hint("merge"), "row").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(total + kinds + 1)))).alias("base_score"), "score")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(read(spark, sf_dir, "documents"))
