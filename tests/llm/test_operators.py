"""Each operator against a brute-force version on small tables that hold the odd cases."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import ann, attention, gridjoin, lm, mixing, neardup, packing, pii, quality, secrets, substrings, wordpieces
from ledgerline.llm.subwords import encoder, tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node long"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdeé"), 4)) for _ in range(n))


def texts():
    base = prose(1, 120)
    near = base.replace(base.split(" ")[7], "Changed", 1)
    rows = [base, base.upper(), near, prose(2, 90) + "\n" + base[:300] + prose(3, 40), "", None, "one", "One", "a b c",
            "x" * 900, "the the the " * 200, prose(4, 300), prose(4, 300), "  \t\n ", base + " " + prose(5, 8)]
    out = [(i, t, "en", "ab"[i % 2] if i % 5 else None, None, 0.5, 7) for i, t in enumerate(rows)]
    return out + [out[0], (None, "no id " + prose(6, 60), None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substrings(docs, none, monkeypatch):
    data = [(r[0], (r[1] or "").encode()) for r in texts()]
    count = Counter(b[i:i + 200] for _, b in data for i in range(len(b) - 199))
    want = []
    for d, b in data:
        mark = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                mark[i:i + 200] = True
        runs = int((np.diff(mark.astype(int), prepend=0) == 1).sum())
        want.append((d, len(b), int(mark.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~mark].tobytes()).hexdigest()))
    for block in (4096, 1):  # 1: every bucket is split by content
        monkeypatch.setattr(substrings, "BLOCK", block)
        assert sorted(map(tuple, substrings.dedup(docs).collect()), key=str) == sorted(want, key=str)
    assert substrings.dedup(none).count() == 0


def test_substrings_of_many_equal_rows(spark):
    text = prose(9, 200)
    rows = [(None, text)] * 300 + [(1, prose(8, 80)), (2, text[:500])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.dedup(docs).collect()
    size = len(text.encode())
    assert sum(r.doc_id is None and r.n_bytes == r.n_removed == size and r.n_spans == 1 for r in got) == 300
    assert {r.doc_id: r.n_removed for r in got if r.doc_id is not None} == {1: 0, 2: len(text[:500].encode())}


def test_suffix_sort_matches_plain_sort():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(97, 99, 700), np.tile([97, 98], 300)]).astype(np.uint8)
    at = np.concatenate([rng.permutation(1000)[:300], rng.permutation(1000)[:50]])
    seg = np.repeat([0, 1], [300, 50])
    order, ext = substrings.sort_suffixes(data, at, seg)
    raw = data.tobytes()
    cut = [raw[i:i + 200] for i in at]
    assert [cut[i] for i in order] == sorted(cut[:300]) + sorted(cut[300:])
    for i, (x, y) in enumerate(zip(order, order[1:])):
        same = next((k for k in range(200) if cut[x][k] != cut[y][k]), 200)
        assert ext[i] == (same if seg[x] == seg[y] else 0)


def linked_by_hand(rows, k):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    comp = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return {d: (len(s), comp[d], comp[d] == d) for d, s in sets.items()}


def test_near_dedup(spark, docs, none, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 2)  # also the block pairs
    got = neardup.link(docs, 4).collect()
    want = linked_by_hand([r[:2] for r in texts() if r[0] is not None], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == want
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] and len(got) == len(texts())
    assert neardup.link(none, 4).count() == 0


def test_near_dedup_when_the_best_partners_were_already_rejected(spark):
    # F has 88 of 100 words with X and with Y, X and Y share 89; by signatures F looks best to both.
    w = [f"s27754w{i}" for i in range(200)]
    core, fx, fy, xy, own = w[:80], w[80:88], w[90:98], w[100:109], iter(w[120:])
    sets = [part + [next(own) for _ in range(100 - len(part))] for part in (core + fx + fy, core + fx + xy, core + fy + xy)]
    rows = [(i, " ".join(s)) for i, s in enumerate(sets)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.link(
        spark.createDataFrame(rows, "doc_id long, text string"), 1).collect()}
    assert got == linked_by_hand(rows, 1) == {0: (100, 0, True), 1: (100, 1, True), 2: (100, 1, False)}


def test_least_agreeing_is_safe():
    assert neardup.least_agreeing(256) < 0.8 * 256 and neardup.least_agreeing(32) >= 12


def test_packing(docs, none):
    got = packing.pack(docs).collect()
    ids = {r[0]: tokenizer().encode(r[1] or "", add_special_tokens=False).ids + [1] for r in texts()}
    seen = Counter()
    for r in got:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
    assert seen[0] == 2 * len(ids[0]) and all(seen[d] == len(x) for d, x in ids.items() if d != 0)
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert packing.pack(none).count() == 0


def test_fullest_bin():
    counts = np.zeros(101, np.int64)
    counts[[60, 45, 33, 7]] = [1, 2, 3, 1]
    best = packing.fullest(counts, 100)
    assert sum(k * v for k, v in best.items()) == 100 and all(v <= counts[k] for k, v in best.items())


def test_encoder_equals_tokenizer():
    odd = ["It's don't", "<|endoftext|> x", "İstanbul ﬁ ½ ² ñ", "tab\tand\x85nel", "漢字 12.5%!", "", "a_b'c"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder()(odd)] == [
        tokenizer().encode(t, add_special_tokens=False).ids for t in odd]


def test_mixing(docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(texts()) and all(r.taken <= 3 * r["size"] for r in got)
    assert sum(r["size"] for r in got) == sum(len(WORD.findall(r[1] or "")) for r in texts())
    assert got == mixing.mix(docs).collect() or sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(none).count() == 0
    assert mixing.take(docs).columns == docs.columns


def test_mixing_at_the_lowest_key_range(spark):
    from pyspark.sql import functions as F

    def lowest(text):
        ids = spark.range(40_000).withColumn("key", F.xxhash64(F.lit(mixing.SEED), "id", F.lit(text)))
        return [r.id for r in ids.where(F.shiftright("key", 64 - mixing.RANGE_BITS) == -1 << mixing.RANGE_BITS - 1).limit(5).collect()]

    # Capped: all three times. Not capped: twice, and of the rest of 6 words the nearest document of 10.
    for text, other, want in (("w", 1000, 15), (" ".join("w" * 10), 109, 110)):
        ids = lowest(text)
        assert len(ids) == 5
        rows = [(-1, " ".join("w" * other), "a")] + [(i, text, "c") for i in ids]
        got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
        assert sum(r.taken for r in got if r.doc_id >= 0) == want


def test_targets_and_route():
    assert mixing.targets([10, 100, 100], [3, 1, 1]) == [30, 90, 90]
    # One word pool in both sources, one in the first only: the shared pool is left for the second.
    flow = mixing.route([(10, (0, 1)), (10, (0,))], [10, 10])
    assert flow == [{1: 10}, {0: 10}]


def _reshared(sizes, weights, most):
    """Targets by the words of the rule: share by weight, stop at the limit, share the excess again."""
    out, capped = [0.0] * len(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = sum(sizes) - sum(most * sizes[i] for i in capped)
        for i in range(len(sizes)):
            out[i] = most * sizes[i] if i in capped else rest * weights[i] / sum(weights[j] for j in free)
        over = {i for i in free if out[i] > most * sizes[i]}
        if not over:
            return out
        capped |= over


def test_targets_by_level_are_those_of_resharing():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 40):
        for _ in range(50):
            sizes = (rng.pareto(0.5, n) * 10).astype(np.int64).tolist()
            weights = [1.0 + i % 3 for i in range(n)]
            assert mixing.targets(sizes, weights) == pytest.approx(_reshared(sizes, weights, 3), rel=1e-9)


def test_route_of_sole_sources_is_that_of_shortest_paths():
    rng = np.random.default_rng(5)
    for _ in range(100):
        quotas = rng.integers(0, 60, 6).tolist()
        patterns = [(int(rng.integers(0, 20)), tuple(sorted(rng.choice(6, rng.integers(1, 4), replace=False).tolist()))) for _ in range(5)]
        got, plain = mixing.route(patterns, quotas), mixing._shortest_paths(patterns, quotas)
        cost = lambda flows: sum(
            sum(c * min(max(sum(f.values()) - k * w, 0), w) for k, c in enumerate(mixing.PASS_COSTS)) for f, (w, _) in zip(flows, patterns))
        assert sum(sum(f.values()) for f in got) == sum(sum(f.values()) for f in plain) and cost(got) == cost(plain)
        for s in range(6):
            assert sum(f.get(s, 0) for f in got) <= quotas[s]
    many = 100_000
    flow = mixing.route([(10, (i,)) for i in range(many)], [i % 50 for i in range(many)])
    assert all(sum(f.values()) == min(30, i % 50) for i, f in enumerate(flow))


def test_mixing_of_more_sources_than_reach_the_driver(spark, docs, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(0, 30)), "hot" if i % 3 == 0 else None if i % 50 == 1 else f"s{rng.integers(0, 150)}") for i in range(1500)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for table in (odd, docs):
        monkeypatch.setattr(mixing, "MAX_PATTERNS", 100_000)
        want, taken = (sorted(map(str, f(table).collect())) for f in (mixing.mix, mixing.take))
        monkeypatch.setattr(mixing, "MAX_PATTERNS", 1)
        assert sorted(map(str, mixing.mix(table).collect())) == want
        assert sorted(map(str, mixing.take(table).collect())) == taken


def test_secrets(spark, docs):
    import base64
    import gzip

    blob = base64.b64encode(gzip.compress(b"key file: password=abcdef123")).decode()
    rows = [(1, "token:token:abcdef secret = 'abc123'"), (2, "password%3Dabcdef99 " + blob), (3, None), (4, "AKIA" + "A" * 16)]
    got = {r.doc_id: r for r in secrets.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_assign == 1 and got[1].spans == "assign:19:35"
    assert got[2].n_assign == 0 and got[2].spans == f"assign:0:19,assign:20:{20 + len(blob)}"
    assert got[3].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest() and got[4].n_access == 1
    assert "abcdef99" not in secrets.redacted(rows[1][1])
    assert secrets.redact(docs).count() == len(texts())


def test_secrets_in_nested_members_and_wrapped_blobs():
    import base64
    import bz2
    import gzip
    import lzma

    import zstandard

    zstd = zstandard.ZstdCompressor().compress
    plain, token = b"first line " * 9, b"key file: password=abcdef123"
    lines = base64.encodebytes(gzip.compress(np.random.default_rng(1).bytes(300) + gzip.compress(token)) + gzip.compress(token)).decode()
    blobs = [base64.b64encode(b).decode() for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstd) for b in (
        gzip.compress(pack(token)), pack(pack(pack(token))), pack(plain) + pack(token), pack(plain) + token)]
    blobs += [base64.b64encode(b).decode() for b in (b"token=abcdef", b"x token=abcdef")]
    blobs.append(lines.rstrip())
    blobs.append(base64.encodebytes(b"some words to fill the first line of the blob, token=abcdef").decode().rstrip())
    for blob in blobs:
        text = f"see {blob} end"
        assert (4, 0, 4 + len(blob)) in secrets.spans(text)[1], blob
        assert secrets.redacted(text) == "see [SECRET] end"
    assert secrets.spans("plain words\nof_some_identifier_that_is_long\nand no secret")[1] == []


def test_secrets_among_bytes_that_are_no_text(monkeypatch):
    import base64
    import gzip
    import io
    import tarfile

    token = b"password=abcdef123"
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w:gz") as tar:
        info = tarfile.TarInfo("key.txt")
        info.size = len(token)
        tar.addfile(info, io.BytesIO(token))
    noise = np.random.default_rng(2).bytes(5000)
    blobs = [packed.getvalue(), noise + b" " + token, token.decode().encode("utf-16"), token.decode().encode("utf-16-be"),
             gzip.compress(noise + base64.b64encode(token))]
    for blob in blobs:
        blob = base64.b64encode(blob).decode()
        assert (4, 0, 4 + len(blob)) in secrets.spans(f"see {blob} end")[1]
    # A window that is no text does not end the layer.
    monkeypatch.setattr(secrets, "WINDOW", 4096)
    monkeypatch.setattr(secrets, "OVERLAP", 64)
    blob = base64.b64encode(gzip.compress(b"text " * 2000 + noise + b" " + token)).decode()
    assert (0, 0, len(blob)) in secrets.spans(blob)[1]


def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 12)).astype(np.float32)
    x[1], x[2], x[30:40] = x[0], 2 * x[0], x[30] + 0.02 * rng.normal(size=(10, 12))
    rows = [(i, x[i].tolist(), i % 2 if i > 2 else 0) for i in range(60)] + [
        (100, None, 0), (101, [0.0] * 12, 0), (102, [float("nan")] + [1.0] * 11, 0), (103, x[0].tolist(), None), (None, x[0].tolist(), 0)]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_grid_join(spark, monkeypatch):
    monkeypatch.setattr(gridjoin, "BLOCK", 8)
    monkeypatch.setattr(gridjoin, "LEAF", 4)
    x, table = vectors(spark)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = np.array([i % 2 if i > 2 else 0 for i in range(60)])
    hit = (u @ u.T >= 0.98) & (label[:, None] == label) & ~np.eye(60, dtype=bool)
    got = {r.vec_id: r for r in gridjoin.link(table).collect()}
    assert [got[i].n_links for i in range(60)] == hit.sum(1).tolist()
    assert got[2].component_id == 0 and got[39].component_id == 31 and not got[2].kept
    assert all(got[i].n_links == 0 and got[i].kept for i in (100, 101, 102, 103))


def test_nearest_neighbours(spark):
    x, table = vectors(spark)
    got = ann.search(table, every=10).collect()
    found = 0
    for q in range(0, 60, 10):
        dist = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        dist[q] = np.inf
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11)) and all(r.score == dist[r.vec_id] for r in mine if r.vec_id < 60)
        found += len({r.vec_id for r in mine} & set(np.argsort(dist, kind="stable")[:11]))
    assert found >= 0.85 * 60


@pytest.mark.parametrize("d", [32, 64])
def test_nearest_neighbours_where_a_third_are_copies(spark, d):
    rng = np.random.default_rng(d)
    copy = rng.standard_normal(d)
    x = rng.standard_normal((4000, d))
    x[1::3] = copy
    # Ten neighbours of the first query at nine tenths of the copies' distance from it.
    for i in range(10):
        step = rng.standard_normal(d)
        x[3 * i + 2] = x[0] + step / np.linalg.norm(step) * 0.9 * np.linalg.norm(copy - x[0])
    queries = np.arange(0, 4000, 100)
    found = hits = 0
    for q, at, dist in ann.search_block(x, np.arange(4000), x[queries], queries):
        real = np.sqrt(((x - x[queries[q]]) ** 2).sum(axis=1))
        real[queries[q]] = np.inf
        bound = np.sort(real)[9]
        assert np.allclose(dist, real[at])
        found, hits = found + 10, hits + int((dist <= bound + 1e-12).sum())
    assert hits >= 0.95 * found


def test_nearest_neighbours_ties_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>, d int, block int"
    assert ann.search(spark.createDataFrame([], schema)).count() == 0
    rows = [(i, [1.0, float(i % 2)], 0, 0) for i in range(30)] + [(30, None, 0, 0), (31, [0.0, 0.0], 0, 0), (None, [1.0, 0.0], 0, 0)]
    got = ann.search(spark.createDataFrame(rows, schema), every=10).collect()
    for q in (0, 10, 20):
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [i for i in range(0, 24, 2) if i != q][:10]


def test_pii(spark):
    t = "Bob.4@mail.example.com BOB.4@mail.example.com 4111 1111 1111 1111 4111111111111112 Frau Anna Schmidt 49.37.233.206 +1 (168) 555-5254"
    got = pii.surrogates(spark.createDataFrame([(1, t), (2, None), (3, "clean 12"), (None, "Frau Anna Schmidt")], "doc_id long, text string")).collect()
    new = next(r for r in got if r.doc_id == 1).text
    a, b = re.findall(r"\S+@\S+", new)
    assert a == b and a.lower() != "bob.4@mail.example.com" and "4111111111111112" in new
    for gone in ("4111 1111 1111 1111", "49.37.233.206", "Anna", "555-5254"):
        assert gone not in new
    name = re.search(r"Frau \w+ \w+", new).group()
    assert next(r for r in got if r.doc_id is None).text == name
    assert {r.doc_id: r.text for r in got}[3] == "clean 12" and {r.doc_id: r.text for r in got}[2] is None


def test_pii_whole_names(spark):
    names = ["Mr John Henry Smith", "Mr. McDonald", "Mr O'Brien", "Dr. Ada Byron King", "Prof Jones", "Herr Dr. Schmidt", "Mr J. R. Ewing",
             "Mrs Mary-Jane van", "Mr John Smith"]
    got = pii.surrogates(spark.createDataFrame([(i, f"met {n}, today") for i, n in enumerate(names)], "doc_id long, text string")).collect()
    text = {r.doc_id: r.text for r in got}
    for i, n in enumerate(names):
        for word in re.findall(r"[A-Z][A-Za-z']{2,}", n):
            assert word in ("Mrs", "Prof", "Herr") or word not in text[i], (n, text[i])
        assert text[i].startswith("met " + re.match(r"(?:Mrs|Mr|Dr|Prof|Herr Dr)\.? ", n).group()) and text[i].endswith(", today")
    assert all(r.kinds == "name" for r in got)


def test_pii_phone_cores_are_what_is_shown(spark):
    rows = [(f"+1 ({200 + i}) 555-{1000 + i}", f"+1{200 + i}555{1000 + i}") for i in range(50)]
    rows = spark.createDataFrame(rows, "v string, w string")
    entity, same = (pii.canonical(c, "'phone'") for c in "vw")
    made = pii.core("'phone'", entity, "0")
    got = rows.selectExpr(f"{made} as made", f"{pii.dressed('v', chr(39) + 'phone' + chr(39), made)} as shown", f"{entity} = {same} as one").collect()
    for r in got:
        assert r.one and r.made.startswith("+1") and re.sub("[^+0-9]", "", r.shown) == r.made
        assert re.fullmatch(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", r.shown)


def test_pii_collisions_are_resolved(spark):
    found = spark.createDataFrame([("phone", f"{i:03d}") for i in range(60)], "kind string, entity string")
    again = {r.entity: r.attempt for r in pii.retried(found).collect()}
    assert all(v > 0 for v in again.values())


def test_language_model(spark, docs):
    got = [r for r in lm.language_model(docs).collect()]
    tokens = [(r[0], WORD.findall((r[1] or "").translate(LOWER)) + [None]) for r in texts()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, t in tokens if not held(d) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d), len(t), sum(c[w] > 0 for w in t), n) for d, t in tokens)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    base = {str(d): sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t) for d, t in tokens}
    assert all(abs(r.base_score - base[str(r.doc_id)]) < 1e-6 * abs(base[str(r.doc_id)]) and r.score < 0 for r in got)


def test_word_ids_do_not_depend_on_neighbours():
    words = [w.encode() for w in ["it's", "a\u00a0b", "\u2003", "x" * 700, "漢字" * 90, "plain", "\x1c", "12.5%", "naïve", "\ufffd", "y"]]
    for these in (words, words[::-1], words[:1], words[3:4], []):
        ids, count = wordpieces.word_ids(these)
        alone = [wordpieces.word_ids([w])[0].tolist() for w in these]
        assert ids.tolist() == [x for a in alone for x in a] and count.tolist() == [len(a) for a in alone]
        bpe = wordpieces._bpe()[0]
        assert bpe.decode(ids.tolist()) == "".join(" " + w.decode() for w in these)


def test_attention_gradient_and_windows():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in attention.unpack(attention.initial(np.ones(attention.CLASSES))).items()}
    x, y = rng.integers(0, attention.CLASSES, (2, 2, attention.LENGTH))
    _, g = attention.loss_and_gradient(p, x, y)
    for k in ("q", "embed", "o"):
        i = (x[0, 0], 1) if k == "embed" else (1, 2)
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[k][i] += 1e-4
        down[k][i] -= 1e-4
        slope = (attention.loss_and_gradient(up, x, y)[0] - attention.loss_and_gradient(down, x, y)[0]) / 2e-4
        assert abs(slope - g[k][i]) < 1e-5
    ids, first = rng.integers(0, attention.CLASSES, 150), np.array([0, 0, 5, 120, 150])
    whole = attention.score(attention.unpack(attention.pack(p)), ids, first)
    alone = attention.score(attention.unpack(attention.pack(p)), ids[5:120], np.array([0, 115]))
    assert np.allclose(whole[5:120], alone, atol=1e-5) and (whole < 0).all()


def _plain_log_share(p, before, target):
    """Log share of class ``target`` after the input classes ``before``, one sum at a time in double precision."""
    p = {k: v.astype(np.float64) for k, v in p.items()}
    h = [p["embed"][c] + p["place"][i] for i, c in enumerate(before)]
    q = h[-1] @ p["q"]
    a = [q @ (x @ p["k"]) / math.sqrt(attention.WIDTH) for x in h]
    a = [math.exp(x - max(a)) for x in a]
    mixed = sum(w * (x @ p["v"]) for w, x in zip(a, h)) / sum(a)
    z = (h[-1] + mixed @ p["o"]) @ p["out"] + p["bias"]
    return z[target] - np.logaddexp.reduce(z)


def test_attention_scores_are_those_of_the_plain_model():
    rng = np.random.default_rng(1)
    p = attention.unpack(attention.initial(np.arange(attention.CLASSES)))
    ids = rng.integers(0, attention.CLASSES, 100)
    for scale in (1, 4):  # the larger weights need the guarded exponentials
        scaled = {k: v * np.float32(scale) for k, v in p.items()}
        got = attention.score(scaled, ids, np.array([0, 3, 100]))
        for first, end in ((0, 3), (3, 100)):
            inputs = [attention.START, *ids[first:end].tolist()]
            for t in range(end - first):
                begin = max(0, -(-(t + 1 - attention.LENGTH) // attention.STRIDE)) * attention.STRIDE
                want = _plain_log_share(scaled, inputs[begin:t + 1], ids[first + t])
                assert abs(got[first + t] - want) < 1e-3 * max(1.0, abs(want))


def test_padding_is_not_learnt_from():
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in attention.unpack(attention.initial(np.ones(attention.CLASSES))).items()}
    w = rng.integers(0, attention.CLASSES, (3, 9))
    padded = np.concatenate([w, np.full((3, 6), -1)], axis=1)
    (loss, g), (same, h) = (attention.loss_and_gradient(p, x[:, :-1], x[:, 1:]) for x in (w, padded))
    assert abs(loss - same) < 1e-9
    assert all(np.allclose(g[k], h[k], atol=1e-9) for k in g)


def test_every_training_text_gives_windows(spark):
    rows = [(0, "", False), (1, "one", False), (2, "word " * 40, False), (3, "word " * 3000, False), (4, "word", True), (5, None, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    got = [r.ids for r in lm.windows(docs).collect()]
    assert all(len(w) == attention.LENGTH + 1 for w in got)
    assert len(got) == 1 + 1 + 1 + 1 + 3000 // lm.WORDS_PER_WINDOW + 1
    assert got.count([lm.START_ID, lm.END_TOKEN] + [lm.PADDING] * (attention.LENGTH - 1)) == 2


def test_lexicon_keeps_every_word_once():
    texts = [b"b a b", b"c a", b"", b"d c e"]
    lexicon, seen = lm.Lexicon(), []
    for t in texts:
        data, starts, ends, h, _ = lm.word_hashes(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        kind, at, of = np.unique(h, return_index=True, return_inverse=True)
        seen += lexicon.rows_of(kind, data, starts[at], ends[at])[of].tolist() if len(h) else []
    assert lexicon.rows == 5 and len(set(seen)) == 5
    ids, size = lexicon.tables()
    begin = np.cumsum(size) - size
    got = [ids[begin[r]:begin[r] + size[r]].tolist() for r in seen]
    assert got == [wordpieces.word_ids([w])[0].tolist() for t in texts for w in t.split()]


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(15)] + [(3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(texts()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert quality.classify(none, labels).count() == 0
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in quality.op1_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_ascii_texts_are_cut_as_any_other():
    from ledgerline.llm import subwords

    rng = np.random.default_rng(3)
    signs = [chr(i) for i in range(128) if not 0x1C <= i <= 0x1F] + ["'s", "'re", "__", " ", "12"]
    for _ in range(3000):
        text = "".join(rng.choice(signs, rng.integers(0, 30))).lower()
        assert subwords._ASCII_PIECE.findall(text) == subwords._PIECE.findall(text)


def test_cuts_follow_the_pattern():
    """op3: pieces are cut in numpy as the pattern cuts them; a piece goes to the tokenizer once, in whatever group it comes."""
    import random

    from ledgerline.llm import subwords

    rng = random.Random(3)
    signs = "ab'strevmld '''s 12,_.-\t\nßéÀĳ–…‘’\x01\x7f×"
    these = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(2000)]
    these += ["'s", "'", "x'", "'l", "'ll'llama", "''ve", "1'm2", "'re're", "'d\n't", "", " "]
    these += [chr(x) for x in range(0x2100) if not subwords._UNSURE.search(chr(x))]
    for t in these:
        text = t.lower() + "\n"
        assert len(text) == len(t) + 1
        start, end = subwords.cuts(np.frombuffer(text.encode("utf-32-le"), "<u4"))
        assert [text[a:b] for a, b in zip(start.tolist(), end.tolist())] == subwords._PIECE.findall(text)
    plain, encode = tokenizer(), subwords.Encoder()
    want = [plain.encode(t, add_special_tokens=False).ids for t in these]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(these)] == want
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(these[::-1])] == want[::-1]
    assert len(encode.piece) == len(np.unique(encode.piece)) == len(encode.size)


def test_every_id_of_every_training_text_is_learnt(spark):
    """op8: windows hold each id of each training text once, in order, and training sees a change of any one word."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["alpha", "be", "gamma's", "delta", "0.5"], n)) for n in (0, 1, 47, 48, 49, 2000)] + ["漢字 " * 70, None]
    docs = spark.createDataFrame([(i, t, i == 4) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean").coalesce(1)
    got, n = [r.ids for r in lm.windows(docs).collect()], attention.LENGTH
    at = 0
    for t in [t or "" for i, t in enumerate(texts) if i != 4]:
        ids = [*wordpieces.word_ids([w.encode() for w in t.split()])[0].tolist(), lm.END_TOKEN]
        mine = got[at:at - (-len(ids) // n)]
        at += len(mine)
        assert [w[0] for w in mine] == [lm.START_ID] + ids[n - 1::n][:len(mine) - 1]
        assert [x for w in mine for x in w[1:]] == ids + [lm.PADDING] * (n * len(mine) - len(ids))
    assert at == len(got)
    counts = np.ones(lm.VOCABULARY, np.int64)
    of, _, class_counts = lm.classes_of(counts)
    flats = []
    for i in (None, 700, 1500):
        words = ["alpha", "be"] * 1000
        if i is not None:
            words[i] = "gamma"
        flats.append(lm.fit(spark.createDataFrame([(1, " ".join(words), False)], docs.schema), 9000, of, class_counts))
    assert not np.allclose(flats[0], flats[1]) and not np.allclose(flats[0], flats[2]) and not np.allclose(flats[1], flats[2])
    assert np.array_equal(lm.fit(docs.limit(0), 0, of, class_counts), attention.initial(class_counts))


def test_pipeline_stages_hold_one_python_worker_per_task(spark, docs, monkeypatch):
    """pipeline: executors keep every Python worker that was started, with its caches."""
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(15)], "doc_id long, quality int, toxic int")
    fit, plans = quality.fit, []
    monkeypatch.setattr(quality, "fit", lambda f, y: plans.append(quality.sums(f, y)._jdf.queryExecution().toString()) or fit(f, y))
    quality.keep_good(docs, labels)
    physical = plans[0].split("== Physical Plan ==")[1]
    kinds = re.findall(r"MapInArrow|BroadcastHashJoin|Exchange hashpartitioning", physical)
    assert kinds.count("MapInArrow") == 2 and kinds[1] == "Exchange hashpartitioning" and kinds.index("MapInArrow") == 0
    patterns = spark.createDataFrame([(["a"], 10), ([None], 4)], "pattern array<string>, words bigint")
    flow = mixing._routed(patterns, 3.0)
    assert "PythonRDD" not in flow._jdf.queryExecution().toRdd().toDebugString()
    assert sorted((r.pattern[0] or "", r.source_size, round(3 * r.target, 6)) for r in flow.collect()) == [("", 4, 28.0), ("a", 10, 14.0)]


def test_words_of_any_kind_have_the_ids_of_each_alone():
    """op8: spans of one text give the ids that ``word_ids`` gives; the lexicon keeps them over many chunks, without a copy for each."""
    rng = np.random.default_rng(6)
    kinds = ["a", "don't", "0.5", "x" * 127, "y" * 128, "z" * 300, "é", "漢字", "a\x1cb", "\x1f", "u\u00a0v", "\ufffd", "<|x|>", "\x00\x7f"]
    words = [w.encode() for w in kinds + ["".join(rng.choice(list("abcé9'"), rng.integers(1, 9))) for _ in range(400)]]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    alone = [wordpieces.word_ids([w])[0].tolist() for w in words]
    ids, size = wordpieces.spans_ids(data, starts, ends)
    assert ids.tolist() == [x for a in alone for x in a] and size.tolist() == [len(a) for a in alone]
    assert [len(x) for x in wordpieces.spans_ids(data, starts[:0], ends[:0])] == [0, 0]
    lexicon, grown = lm.Lexicon(), 0
    for at in range(0, len(words), 9):
        h = lm.word_hashes(data[starts[at]:ends[min(at + 9, len(words)) - 1]], np.array([0, ends[min(at + 9, len(words)) - 1] - starts[at]]))
        kind, place, of = lm.distinct(h[3])
        before = lexicon.ids
        rows = lexicon.rows_of(kind, h[0], h[1][place], h[2][place])[of]
        grown += lexicon.ids is not before
        lowered = [wordpieces.word_ids([w.decode().translate(LOWER).encode()])[0].tolist() for w in words[at:at + 9]]
        assert lexicon.ids_of(rows)[0].tolist() == [x for a in lowered for x in a]
    assert grown == 0
    h = rng.integers(0, 50, 300).astype(np.uint64) << np.uint64(58)
    for got, want in zip(lm.distinct(h), np.unique(h, return_index=True, return_inverse=True)):
        assert np.array_equal(got, want)
    assert [len(x) for x in lm.distinct(h[:0])] == [0, 0, 0]


def test_texts_are_encoded_once(spark, tmp_path):
    """op8: training and both scores read the ids and word places that the first pass wrote; no text is read again or shuffled."""
    texts = ["", None, "One two one", "漢字 two b", "x" * 300, " ".join(f"w{i}" for i in range(3000))] * 3
    rows = [(None if i == 4 else i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    plan = lm.language_model(docs)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and str(tmp_path / "documents") not in plan and "llm-" in plan
    got = lm.encoded(docs.selectExpr("doc_id", "text", "doc_id = 3 as held_out").na.fill(False)).collect()
    seen = [r for r in got if r.ids is not None]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in seen) == sorted((d is None, d or 0) for d, _ in rows)
    assert len({r.row for r in got if r.row is not None}) == len(seen)
    words = {(r.bucket, r.at): r.word for r in got if r.word is not None}
    of, spelt, counts, ids = {}, {}, Counter(), Counter()
    for r in seen:
        text = (texts[4] if r.doc_id is None else texts[r.doc_id]) or ""
        tokens = WORD.findall(text.translate(LOWER))
        want = [x for w in tokens for x in wordpieces.word_ids([w.encode()])[0].tolist()] + [lm.END_TOKEN]
        assert np.frombuffer(r.ids, np.uint16).tolist() == want and r.size == len(text.encode())
        hashes = [words[r.bucket, at] for at in np.frombuffer(r.places, np.int32).tolist()]
        assert len(hashes) == len(tokens)
        for w, h in zip(tokens, hashes):
            assert of.setdefault(w, h) == h and spelt.setdefault(h, w) == w
        if not r.held_out:
            counts.update([*hashes, int(lm.END.view(np.int64))])
            ids.update(want)
    found = Counter()
    for r in got:
        if r.word is not None:
            found[r.word] += r.n
    assert +found == counts
    total = Counter()
    for r in got:
        if r.bucket is None:
            total[r.at] += r.n
    assert total == ids


def _plain_id_share(p, before, target, own, given, asked):
    """Log share of class ``target`` after the input classes ``before``, then of the id ``asked`` in it, with the own
    rows of the ids ``given``, one sum at a time in double precision."""
    p = {k: v.astype(np.float64) for k, v in p.items()}
    h = [p["embed"][c] + p["place"][i] + own.inputs.table[t] for i, (c, t) in enumerate(zip(before, given))]
    q = h[-1] @ p["q"]
    a = [q @ (x @ p["k"]) / math.sqrt(attention.WIDTH) for x in h]
    a = [math.exp(x - max(a)) for x in a]
    h = h[-1] + (sum(w * (x @ p["v"]) for w, x in zip(a, h)) / sum(a)) @ p["o"]
    z = h @ p["out"] + p["bias"]
    path = range(own.begin[asked], own.begin[asked] + own.size[asked])
    sides = [own.side[i] * (own.nodes.table[own.node[i]] @ np.append(h, 1)) for i in path]
    return z[target] - np.logaddexp.reduce(z), -sum(np.logaddexp(0, -s) for s in sides)


def _ids(seed, kind=np.float64):
    """A small model in which 200 ids share the classes, with random weights of their own."""
    rng = np.random.default_rng(seed)
    of = rng.integers(0, attention.CLASSES, 200)
    own = attention.Ids(attention.Tree(rng.integers(0, 30, 200) + 0.01, of))
    own.inputs.table = np.where(own.many[:, None], rng.normal(0, 0.3, own.inputs.table.shape), 0).astype(kind)
    own.nodes.table = (own.nodes.table + rng.normal(0, 0.3, own.nodes.table.shape)).astype(kind)
    return rng, of, own


def test_shares_of_ids_in_their_class_depend_on_context_and_sum_to_one():
    rng, of, own = _ids(3)
    every = np.flatnonzero(own.many[:-2])
    assert set(every.tolist()) == {i for i in range(200) if (of == of[i]).sum() > 1}
    shares = []
    for _ in range(2):
        h = np.append(rng.normal(size=attention.WIDTH), 1.0)
        got = np.exp(own.log_shares(np.tile(h, (len(every), 1)), every))
        assert np.allclose(np.bincount(of[every], got)[np.unique(of[every])], 1)
        shares.append(got)
    assert not np.allclose(*shares)
    counts = rng.integers(0, 5, 200) + 0.01
    fresh = attention.Ids(attention.Tree(counts, of))
    got = np.exp(fresh.log_shares(np.tile(h, (len(every), 1)).astype(np.float32), every))
    assert np.allclose(got, (counts / np.bincount(of, counts, attention.CLASSES)[of])[every], rtol=1e-4)
    alone = attention.Tree(np.ones(5), np.arange(5))
    assert len(alone.odds) == 0 and not attention.Ids(alone).many.any()


def test_gradient_of_the_ids():
    rng, of, own = _ids(4)
    p = {k: v.astype(np.float64) for k, v in attention.unpack(attention.initial(np.ones(attention.CLASSES))).items()}
    ids = rng.integers(0, 200, (2, 10))
    ids[:, 0], ids[1, 8:] = 200, 201
    classes = np.append(of, [attention.START, -1])[ids]

    def loss():
        """Of classes and ids."""
        total, real = attention.loss_and_gradient(p, classes[:, :-1], classes[:, 1:], own, ids)[0], (classes[:, 1:] >= 0).sum()
        logs = [_plain_id_share(p, row[:t].tolist(), row[t], own, given[:t], given[t])[1]
                for row, given in zip(classes, ids) for t in range(1, 10) if row[t] >= 0]
        return total - sum(logs) / real

    _, g = attention.loss_and_gradient(p, classes[:, :-1], classes[:, 1:], own, ids)
    for table, (rows, down, seen), k in ((own.inputs.table, g["inputs"], 3), (own.nodes.table, g["nodes"], 8), (own.nodes.table, g["nodes"], 2)):
        assert (np.diff(rows) > 0).all() and len(rows) == len(down) == len(seen)
        for at in (0, len(rows) // 2, len(rows) - 1):
            before = table[rows[at], k]
            table[rows[at], k] = before + 1e-4
            up = loss()
            table[rows[at], k] = before - 1e-4
            slope = (up - loss()) / 2e-4
            table[rows[at], k] = before
            assert abs(slope - down[at, k]) < 1e-6
    for name, at in (("embed", (classes[0, 3], 1)), ("out", (2, 5)), ("v", (1, 1)), ("q", (2, 0)), ("place", (1, 4))):
        before = p[name][at]
        p[name][at] = before + 1e-4
        up = loss()
        p[name][at] = before - 1e-4
        slope = (up - loss()) / 2e-4
        p[name][at] = before
        assert abs(slope - g[name][at]) < 1e-6
    assert g["inputs"][2].sum() == own.many[ids[:, :-1]].sum()


def test_scores_of_ids_are_those_of_the_plain_model():
    rng, of, own = _ids(5, np.float32)
    p = attention.unpack(attention.initial(np.arange(attention.CLASSES)))
    ids = rng.integers(0, 200, 100)
    got = attention.score(p, of[ids], np.array([0, 3, 100]), own=own, ids=ids, tables=attention.look_up(p, own, of))
    for first, end in ((0, 3), (3, 100)):
        given = [200, *ids[first:end].tolist()]
        inputs = [attention.START, *of[ids[first:end]].tolist()]
        for t in range(end - first):
            begin = max(0, -(-(t + 1 - attention.LENGTH) // attention.STRIDE)) * attention.STRIDE
            want = sum(_plain_id_share(p, inputs[begin:t + 1], of[ids[first + t]], own, given[begin:t + 1], ids[first + t]))
            assert abs(got[first + t] - want) < 1e-3 * max(1.0, abs(want))


def test_ids_that_share_a_class_are_told_apart_by_context(spark):
    """op8: of two equally frequent ids of one class, the one that always follows a word scores better after it."""
    words = [w for w in (a + b for a in "bcdfghlmnprst" for b in ("an", "ad", "at", "en", "ed", "in", "it", "on", "op", "up", "ar", "ill", "ore"))
             if len(wordpieces.word_ids([w.encode()])[0]) == 1]
    ids = wordpieces.word_ids([w.encode() for w in words])[0]
    common, rest = words[:attention.OWN], list(range(attention.OWN, len(words)))
    counts = np.zeros(lm.VOCABULARY, np.int64)
    counts[ids[:attention.OWN]], counts[lm.END_TOKEN] = 9, 9
    of = lm.classes_of(counts)[0]
    x, y = next((words[i], words[j]) for i in rest for j in rest if i < j and of[ids[i]] == of[ids[j]])
    rng = np.random.default_rng(7)
    pair = [[common[0], x], [common[1], y]]
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2][:300]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    # Every common word comes more often than x and y, so these share a class.
    rows = [(i, " ".join([*common] * 3 + [w for k in range(20) for w in [*rng.choice(common, 3).tolist(), *(pair[(i + k // 10) % 2] if k % 10 == 0 else [])]]))
            for i in train]
    usual, swapped = (" ".join([common[0], a, common[1], b] * 20) for a, b in ((x, y), (y, x)))
    docs = spark.createDataFrame([*rows, (held[0], usual), (held[1], swapped)], "doc_id long, text string")
    seen = Counter(w for _, t in rows for w in t.split())
    assert seen[x] == seen[y] == 300 < min(seen[w] for w in common)
    got = {r.doc_id: r for r in lm.language_model(docs).collect()}
    assert abs(got[held[0]].base_score - got[held[1]].base_score) < 1e-6
    # The texts have the same classes in the same order, so a model of classes alone scores them alike.
    assert got[held[0]].score > got[held[1]].score + 1
