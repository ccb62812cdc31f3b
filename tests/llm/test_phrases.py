"""Spelling variants, benchmark passages and collocations against brute force, on tables that hold the odd cases."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import collocations, decontam, spans, spelling

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Columns beyond the table's own carry names that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, shard long, n long, part string"


def rows_of(texts, langs=("en",)):
    return [(i, t, langs[i % len(langs)], None, None, "x", 1, 2, "y") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- spelling ---------------------------------------------------------------------------------------------------------

def vocabulary(rows):
    n = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row[1] or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(rows):
    n = vocabulary(rows)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: f if f and n[f] >= 2 * n[w] else None for w, f in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def variants(seed=3, stems=40):
    """Words with their edits at the ends and within, doubled letters, letters beyond ASCII, ties."""
    rng = random.Random(seed)
    out = []
    for _ in range(stems):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        for _ in range(rng.randint(1, 8)):
            i, c = rng.randrange(len(w) + 1), rng.choice("abéÀ×")
            v = rng.choice([w, w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
            out += [v] * rng.choice([2, 3, 3, 6, 7, 24])
    rng.shuffle(out)
    return out


def spelling_rows():
    words = variants()
    texts = [" ".join(words[i:i + 37]) for i in range(0, len(words), 37)]
    texts += [None, "", "  1234 ..", "ALLES alles Alles", "z" * 3000 + " " + ("z" * 3000 + " ") * 2 + ("z" * 2999 + " ") * 4,
              "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaaa aaaaaaa aaaaaaa"]
    rows = rows_of(texts)
    return rows + [rows[0], rows[0], (None, texts[1], "en", None, None, None, None, None, None)]


def test_spelling(spark, none, monkeypatch):
    rows = spelling_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    want = grouped(rows)
    assert any(r[1] for r in want) and any(r[4] > 2 for r in want) and any(r[2] not in (r[0], r[1]) for r in want)
    assert set(map(tuple, spelling.group(docs).collect())) == want
    assert spelling.group(none).count() == 0
    # Every list of more than two words is cut in parts; many small buckets; queries in small steps.
    monkeypatch.setattr(spelling, "BLOCK", 2)
    monkeypatch.setattr(spelling, "BUCKET", 50)
    got = list(map(tuple, spelling.group(docs).collect()))
    assert set(got) == want and len(got) == len(want)


def test_scan_is_the_edit_distance(monkeypatch):
    monkeypatch.setattr(spelling, "QUERIES", 7)
    rng = random.Random(5)
    words = sorted({"ab" + "".join(rng.choice("ab") for _ in range(rng.randint(3, 5))) for _ in range(60)})
    for m in (5, 6):
        ask = [w for w in words if len(w) == m]
        listed = [w for w in words if len(w) in (m, m + 1)]
        q, w = spelling.scan(spelling.matrix([x.encode() for x in ask], m), np.zeros(len(ask), np.int64),
                             spelling.matrix([x.encode() for x in listed], m + 1), np.array([len(x) for x in listed]),
                             np.zeros(len(listed), np.int64), 2)
        assert sorted((ask[i], listed[j]) for i, j in zip(q, w)) == sorted((a, b) for a in ask for b in listed if one_edit(a, b))


def test_joined_crc():
    heads, tails = [b"", b"7:", b"123456789:", b"\xc3\xa9"], [b"", b"a", b"words", b"\xc3\x80" * 30]
    pairs = [(h, t) for h in heads for t in tails]
    got = spelling.joined_crc(np.array([zlib.crc32(h) for h, _ in pairs], np.uint32), np.array([zlib.crc32(t) for _, t in pairs], np.uint32),
                              np.array([len(t) for _, t in pairs]))
    assert got.tolist() == [zlib.crc32(h + t) for h, t in pairs]


# --- benchmark passages -----------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows_of(items, length=10):
    out = {}
    for item, text in items:
        w = TERM.findall((text or "").translate(LOWER))
        for i in range(max(len(w) - length, 0) + 1 if w else 0):
            if item is not None:
                out.setdefault(tuple(w[i:i + length]), set()).add(item)
    return out


def contaminated(rows, items, within=20):
    wins, out = windows_of(items), []
    for row in rows:
        w = TERM.findall((row[1] or "").translate(LOWER))
        hit, found, near = set(), set(), set()
        for win, owners in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= owners
            if any(set(win) <= set(w[i:i + within]) for i in range(len(w))):
                near |= owners
        names = ",".join(sorted(map(str, found)))
        out.append((row[0], len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit), len(near - found)))
    return sorted(out, key=str)


def passage(seed, n, signs="abcdé"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(signs) for _ in range(3)) for _ in range(n))


def benchmark_rows():
    a, b = passage(1, 25), passage(2, 10)
    return [(1, a), (2, b), (10, a), (3, "one two"), (4, ""), (5, None), (6, "the the the the the the the the the the the"), (7, "solo"),
            (None, passage(3, 12)), (2, b), (8, passage(4, 12, "abc"))]


def benchmark_documents():
    a, b, c = passage(1, 25), passage(2, 10), passage(4, 12, "abc")
    jumbled = c.split(" ")
    random.Random(1).shuffle(jumbled)
    texts = [a, a.upper().replace(" ", "-- "), "x " + b + " y " + b, " ".join(a.split(" ")[3:17]), " ".join(a.split(" ")[:9]),
             passage(9, 300) + " ONE, two; " + passage(8, 20), "one", "two", None, "", " .,; ", "the " * 40, "the " * 9, "solo",
             passage(3, 12), " ".join(jumbled), " ".join(b.split(" ")[:5]) + " gap gap " + " ".join(b.split(" ")[5:]),
             " ".join(x + " gap gap gap" for x in b.split(" ")), "one", "two words"]
    rows = rows_of(texts)
    return rows + [rows[0], (None, "one two", None, None, None, None, None, None, None), (None, "one two", None, None, None, None, None, None, None)]


def test_decontamination(spark, none, monkeypatch):
    rows, items = benchmark_documents(), benchmark_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contaminated(rows, items)
    assert sum(r[5] for r in want) > 8 and sum(r[6] for r in want) >= 2
    for block in (50_000, 3):  # 3: windows are dealt to blocks, whose stretches overlap
        monkeypatch.setattr(decontam, "WINDOWS", block)
        assert sorted(map(tuple, decontam.contaminated(docs, bench).collect()), key=str) == want
    assert decontam.contaminated(none, bench).count() == 0
    clean = decontam.contaminated(docs, bench.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.contaminated or r.n_near_items for r in clean)


def test_positions_come_back():
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.choice(10 ** int(rng.integers(3, 8)), int(rng.integers(1, 60)), replace=False)) for _ in range(50)]
    heads = np.zeros(sum(map(len, lists)), bool)
    heads[np.cumsum([0] + [len(x) for x in lists[:-1]])] = True
    raw, ends = decontam.coded(np.concatenate(lists), heads)
    values, of = decontam.decoded(raw, ends[np.cumsum([len(x) for x in lists]) - 1])
    assert [values[of == i].tolist() for i in range(len(lists))] == [x.tolist() for x in lists]


# --- collocations -----------------------------------------------------------------------------------------------------

def mined(rows, longest, least, top):
    f, n = Counter(), Counter()
    for row in rows:
        lang = "und" if row[2] is None else row[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (row[1] or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[(lang, *w[i:i + k])] += 1
    found = {k: v for k, v in f.items() if len(k) > 2 and v >= least}
    gone = {(k[0], *k[1 + i:1 + i + m]) for k, v in found.items() for m in range(2, len(k) - 1) for i in range(len(k) - m)
            if 100 * v >= 100 * f[(k[0], *k[1 + i:1 + i + m])]}
    by = {}
    for k, a in found.items():
        if k not in gone:
            lang, w = k[0], k[1:]
            score, cut = min((1000 * a * n[lang] // (f[(lang, *w[:c])] * f[(lang, *w[c:])]), c) for c in range(1, len(w)))
            by.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:cut])], f[(lang, *w[cut:])]))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -score)
            for lang, v in by.items() for i, (score, a, p, left, right) in enumerate(sorted(v)[:top], 1)}


def collocation_rows():
    rng = random.Random(11)
    texts = []
    for _ in range(120):
        words = [rng.choice(["a", "b", "c", "été", "New York", "in spite of", "r&d", "to be or not to be", "en", "rare%d" % rng.randrange(900)])
                 for _ in range(rng.randint(0, 60))]
        texts.append("".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "]) for w in words))
    texts += [None, "", " \t", "...", "a " * 500, "a b a b", "x" * 5000]
    rows = rows_of(texts, ("en", None, "de", "und"))
    return rows + [rows[3]] * 4


def test_collocations(spark, none, monkeypatch):
    rows = collocation_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for longest, least, top in ((5, 8, 2000), (3, 20, 4)):
        want = mined(rows, longest, least, top)
        assert len(want) > 8
        assert set(map(tuple, collocations.mine(docs, longest, least, top).collect())) == want
    assert collocations.mine(none).count() == 0
    # Marks full of chance hits, small shards, many ranges: the same rows.
    monkeypatch.setattr(collocations, "BITS", 64)
    monkeypatch.setattr(collocations, "RANGE_WORDS", 100)
    assert set(map(tuple, collocations.mine(docs, 5, 8, 2000).collect())) == mined(rows, 5, 8, 2000)


def test_automaton_weights_are_prefix_counts():
    rng = np.random.default_rng(2)
    windows = np.full((300, 4), -1)
    sizes = rng.integers(2, 5, 300)
    for i, s in enumerate(sizes):
        windows[i, :s] = rng.integers(0, 3, s)
    windows, weights = np.unique(windows, axis=0, return_counts=True)
    sizes = (windows >= 0).sum(axis=1)
    depth, label, weight = collocations.automaton(windows, sizes, weights)
    path, got = [], {}
    for d, x, n in zip(depth.tolist(), label.tolist(), weight.tolist()):
        path = [*path[:d], x]
        got[tuple(path)] = n
    want = Counter()
    for w, s, n in zip(windows.tolist(), sizes.tolist(), weights.tolist()):
        for d in range(1, s + 1):
            want[tuple(w[:d])] += n
    assert got == want


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(3 * 10 ** 12, 10 ** 14, 5 * 10 ** 12, 7 * 10 ** 12)], "a long, n long, l long, r long")
    got = row.selectExpr(collocations.SCORE).first()[0]
    assert got == 1000 * 3 * 10 ** 12 * 10 ** 14 // (5 * 10 ** 12 * 7 * 10 ** 12)


def test_gathered_batches_keep_rows():
    import pyarrow as pa
    parts = [pa.RecordBatch.from_pydict({"id": [i], "text": ["x" * i]}) for i in range(50)]
    whole = list(spans.gathered(iter(parts), limit=100))
    assert 1 < len(whole) < 50 and [x for b in whole for x in b.column(0).to_pylist()] == list(range(50))
    assert list(spans.gathered(iter([]))) == []
