"""Entity decoding against the standard library's, which has the same rules."""

import html
from html.entities import html5

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.entities import html_unescape, html_unescape_all


def decoded(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.d for r in rows.select("i", html_unescape("t").alias("d")).orderBy("i").collect()]


def test_every_name_alone_and_inside_a_longer_one(spark):
    texts = [f"a&{k}{end}" for k in html5 for end in ("", "x", ";", " ", "&amp;")]
    assert decoded(spark, texts) == [html.unescape(t) for t in texts]


def test_every_code_point(spark):
    points = [n for n in range(0x110010) if n < 0x3000 or n % 97 == 0 or n & 0xFFFF > 0xFFF0 or 0xD7F0 < n < 0xE010 or 0xFDC0 < n < 0xFE00]
    got = spark.createDataFrame([(n,) for n in points], "n int").select("n", *[
        html_unescape(F.format_string(form, "n")).alias(name) for name, form in (("dec", "&#%d;"), ("hex", "&#x%X"), ("low", "&#X0000%x;"))])
    for r in got.collect():
        assert r.dec == r.hex == r.low == html.unescape(f"&#{r.n};"), r.n


def test_odd_texts(spark):
    texts = [None, "", "&", "&&amp;", "&#", "&#;", "&#x;", "&#xg", "&#99999999999999999999;", "&#x110000;", "&#xFFFFFFFFFFFFFFFFF", "&#000065",
             "&notit;", "&notin;", "&am", "&amp", "a & b", "&amp;amp;", "&\t;", "&ampamp", "&" + "x" * 40 + ";", "&lt" + "é" * 40, "&😀;", "&#x1F600;",
             "no reference", "&NewLine;&Tab;", "&CounterClockwiseContourIntegral;", "&nbsp" * 3, "x" * 100_000 + "&lt;"]
    assert decoded(spark, texts) == [t if t is None else html.unescape(t) for t in texts]
    arrays = spark.createDataFrame([(1, texts), (2, None), (3, [])], "i int, a array<string>").orderBy("i")
    got = [r.d for r in arrays.select(html_unescape_all("a").alias("d")).collect()]
    assert got == [[t if t is None else html.unescape(t) for t in texts], None, []]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="&#xX;0123456789abcdegilmnopqrtu \n<", max_size=30), min_size=20, max_size=60))
def test_texts_of_pieces(spark, texts):
    assert decoded(spark, texts) == [html.unescape(t) for t in texts]


def test_no_python_worker(spark):
    plan = spark.createDataFrame([("a&lt;",)], "t string").select(html_unescape("t"))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
