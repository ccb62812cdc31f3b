"""Inputs that once ended a run: deep escapes, URL-safe blobs, very long domains, full surrogate spaces."""

import base64
import random
import re
import zlib

from ledgerline.llm import pii, secrets


def test_thousands_of_escape_levels():
    text = "x password" + "%" + "25" * 5000 + "3Dabcdef99 y"
    base, every = secrets.spans(text)
    assert (2, 0, len(text) - 2) in every and not any(k == 0 for _, k, _ in base)
    assert secrets.redacted("a password%25253Dabcdef99 b") == "a [SECRET] b"


def test_mixed_escapes_map_back_to_the_text():
    """Every finding of a layer names the stretch of the whole text that its escapes cover, traced back step by step."""
    rng = random.Random(7)

    def back(steps, a, b):
        for _, starts, places in reversed(steps):
            i = max(k for k, x in enumerate(starts) if x <= a)
            j = max(k for k, x in enumerate(starts) if x <= max(a, b - 1))
            a = places[i][0] + (0 if places[i][2] else a - starts[i])
            b = places[j][1] if places[j][2] else places[j][0] + b - starts[j]
        return a, b

    deep = 0
    for _ in range(100):
        text = "key token=abcdef123 and secret: zyxwvu98"
        for _ in range(rng.randint(1, 4)):
            text = "".join(rng.choice([c, c, c, "%%%02X" % ord(c), "\\u%04x" % ord(c), "&#%d;" % ord(c)]) for c in text)
        want, steps, layer = set(secrets.scan(text)), [], text
        while (step := secrets.unescape(layer)) and step[0] != layer:
            steps, layer = [*steps, step], step[0]
            want |= {(x, kind, y) for a, kind, b in secrets.scan(layer) for x, y in [back(steps, a, b)]}
        deep += len(steps) > 2
        assert want <= set(secrets.spans(text)[1])
    assert deep > 20


def test_url_safe_blobs():
    rng = random.Random(3)
    missed = 0
    for i in range(200):
        noise = "".join(rng.choice("abcdefghijklmnop \n") for _ in range(rng.randint(10, 60)))
        blob = base64.urlsafe_b64encode(zlib.compress(f"{noise} password=abc{i:05d}xyz {noise}".encode())).decode()
        every = secrets.spans(f"see {blob.rstrip('=')} there")[1]
        missed += not any(k == 0 for _, k, _ in every)
    assert missed == 0


def test_base_findings_by_an_independent_scan():
    """Leftmost, non-overlapping matches, read sign by sign."""
    rng = random.Random(5)
    alphabet = ["password", "TOKEN", "api_key", "apikey", "secret", "=", ":", '"', "'", " ", "abc123", "AKIA", "ABCDEFGHIJKLMNOP1234",
                "0123456789abcdef01234567", "deadbeef", "-", "é", "\n", "."]
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

    def run_of(text, i, signs):
        j = i
        while j < len(text) and text[j] in signs:
            j += 1
        return j

    def assign(text, i):
        low = "".join(c.lower() if c.isascii() else c for c in text[i:i + 8])
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low.startswith(word):
                j = i + len(word)
                j += j < len(text) and text[j] in "\"'"
                j = run_of(text, j, " ")
                if j < len(text) and text[j] in ":=":
                    k = run_of(text, j + 1, " ")
                    k += k < len(text) and text[k] in "\"'"
                    end = run_of(text, k, value)
                    if end > k:
                        return k, end
        return None

    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))
        want, i = [], 0
        while i < len(text):
            hit = assign(text, i)
            if hit:
                want += [(i, 0, hit[1])] if hit[1] - hit[0] >= 6 else []
                i = hit[1]
            else:
                i += 1
        for kind, head, signs, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20), (2, "", "0123456789abcdef", 24)):
            i = 0
            while i < len(text):
                end = run_of(text, i + len(head), signs) if text.startswith(head, i) else i
                if end > i + len(head):
                    want += [(i, kind, end)] if end - i >= least else []
                    i = end
                else:
                    i += 1
        assert sorted(secrets.scan(text)) == sorted(want), text


def test_address_pattern_finds_what_its_plain_form_finds():
    plain = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
    own, rng = re.compile(pii._EMAIL), random.Random(2)
    for _ in range(20_000):
        text = "a@" + "".join(rng.choice(["b", "com", "1x", ".", ".", "-", " ", "@", "x1"]) for _ in range(rng.randint(2, 12)))
        assert own.findall(text) == plain.findall(text), text


def test_surrogates_of_one_sign_names_and_long_domains(spark):
    rows = [(i, f"write to _@d{i}.com or hr@d{i}.com.") for i in range(300)]
    rows += [(1000, "long a@" + "x." * 20_000 + "org end"), (1001, "b@c.com.1x and b@c.com1 and b@c.d-e.fr.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.surrogates(docs).collect()}
    mails = [m for i in range(300) for m in re.findall(r"\S+@\S+?(?=\.? |\.$)", got[i])]
    assert len(mails) == 600 and len(set(mails)) == 600 and not any("@d" in m for m in mails)
    assert got[1000].startswith("long ") and got[1000].endswith(" end") and "x.x" not in got[1000]
    assert "b@c" not in got[1001] and ".1x and" in got[1001] and got[1001].endswith(".")
