"""Scalar rules: tables of cases, and agreement with plain Python on random input."""

import html
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfline.functions import fields, numbers, text

CASES = {
    "text": (lambda c: text.normalize_text(c), "string", [
        (None, ""), ("", ""), ("  a \t\n b  ", "a b"), ("a <b> c", "a  c"), ("&lt;b&gt;x", "<b>x"),
        ("Tom &amp; Jerry", "Tom & Jerry"), (" x　", "x"), ("&amp;lt;", "&lt;"),
        ("Ấm trà \"Cổ\" &amp; Bát <b>gốm", "Ấm trà \"Cổ\" & Bát gốm"),
        ("x &#8217; &hellip; &notit; &#128; &#xD800; &#0;", "x ’ … ¬it; € � �"),
    ]),
    "slug": (text.normalize_slug, "string", [
        (None, ""), ("", ""), ("Ấm trà", "am-tra"), ("ĐỒ / Gỗ", "do-go"), ("!!!", "unknown"),
        ("/a/b/", "ab"), ("  --x__y--  ", "x__y"), ("Bình O'Hara", "binh-ohara"),
    ]),
    "name_slug": (text.generate_slug, "string", [(None, "unknown"), ("", "unknown"), ("Gốm sứ", "gom-su")]),
    "url": (fields.normalize_url, "string", [
        (None, ""), (" ", ""), ("x/y", "/x/y"), ("/x", "/x"), ("https://a/b", "https://a/b"), ("ftp://a", "/ftp://a"),
    ]),
    "price": (numbers.normalize_price, "string", [
        (None, None), ("", None), ("84,500đ", 84500.0), ("130.500 VND", 130.5), ("2.418.000đ", None),
        ("-5", 5.0), ("invalid", None), ("$1,234.50", 1234.5), ("5.", 5.0), (".", None),
    ]),
    "price_vi": (lambda c: numbers.parse_price_text(c, "vi"), "string", [
        ("130.500 VND", 130500.0), ("2.418.000đ", 2418000.0), ("4.5", 4.5), ("84,500đ", 84500.0),
    ]),
    "percent": (numbers.normalize_percentage, "string", [
        ("25%", 25.0), (" 25.5 % ", 25.5), ("101", None), ("-1", None), ("nan", None), ("N/A", None), ("1d", None),
    ]),
    "rating": (numbers.normalize_rating, "string", [
        ("4.5", 4.5), (" 5 ", 5.0), ("5.1", None), ("1e0", 1.0), ("1_0e-1", 1.0), ("1f", None), ("inf", None),
    ]),
    "integer": (numbers.normalize_integer, "string", [
        (None, 0), ("1,234", 1234), ("123.7", 123), ("-10", 0), ("abc", 0), ("inf", 0), ("1e3", 1000),
    ]),
    "boolean": (fields.normalize_boolean, "string", [
        (None, False), ("TRUE", True), ("1", True), ("Yes", True), (" yes", False), ("off", False), ("Active", True),
    ]),
    "sku": (fields.normalize_sku, "string", [
        (None, ""), (" abc-1_2 ", "ABC-1_2"), ("Số: q 4", "SQ4"),
    ]),
    "stock": (fields.normalize_availability, "string", [
        (None, "unknown"), ("In_Stock", "in_stock"), ("currently unavailable", "in_stock"), ("unavailable", "out_of_stock"),
        ("limitedavailability", "unknown"), ("Còn hàng", "in_stock"), ("đã hết hàng", "out_of_stock"), ("Đặt trước", "pre_order"),
    ]),
    "images": (fields.normalize_images, "string", [
        (None, []), ("", []), ('["a", "", null, "/b"]', ["/a", "/b"]), ("http://x/y", ["http://x/y"]),
        ('{"a": 1}', ['/{"a": 1}']), ("[]", []), ("  ", []),
    ]),
    "valid": (fields.is_valid_url, "string", [
        (None, False), ("/x", True), ("http://a", True), ("HTTPS://a/b", True), ("http:///x", False), ("ftp://a", False), ("a.b", False),
    ]),
    "last_segment": (fields.slug_from_url, "string", [
        ("https://s/a/b", "b"), ("https://s/a/b/?q=/z#f", "b"), ("https://s", "unknown"), ("invalid-url", "invalid-url"),
        ("/a b/c d", "c d"), ("https://s/a;p=1", "a"), (None, "unknown"),
    ]),
    "first_int": (numbers.first_int, "string", [("(1,234 reviews)", 1234), ("none", None), ("0", 0)]),
    "first_number": (numbers.first_number, "string", [("about 4.5 of 5", 4.5), ("5.", 5.0), ("x", None)]),
    "badge": (fields.badge_label, "string", [
        ("NEW sale", "new"), ("Giảm giá", "sale"), ("Bán chạy", "bestseller"), ("Nổi bật", "featured"), ("x", None),
    ]),
    "escape": (fields.sql_escape, "string", [(None, "''"), ("a'b", "'a''b'")]),
    "shown_float": (numbers.python_float_text, "double", [
        (84500.0, "84500.0"), (12345678.0, "12345678.0"), (4.25, "4.25"), (0.0, "0.0"), (0.1, "0.1"), (-2.5, "-2.5"),
    ]),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    rule, kind, cases = CASES[name]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], f"i int, x {kind}")
    got = {r.i: r.y for r in df.select("i", rule(F.col("x")).alias("y")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


@pytest.mark.parametrize("link,want", [
    ("/a", "https://s/a"), ("//h/a", "https://h/a"), ("a", "https://s/x/a"), ("?q", "https://s/x/y?q"),
    ("http://o/", "http://o/"), ("", "https://s/x/y"), ("#f", "https://s/x/y#f"),
])
def test_join_url(spark, link, want):
    row = spark.range(1).select(fields.join_url(F.lit("https://s/x/y"), F.lit(link)).alias("u"))
    assert row.first().u == want


def test_numbers_by_type(spark):
    df = spark.createDataFrame([(1.5, 2), (-1.0, -3), (float("nan"), 0)], "d double, n int")
    got = df.select(
        numbers.normalize_price(F.col("d"), text=False).alias("p"),
        numbers.normalize_integer(F.col("n"), text=False).alias("i"),
        fields.normalize_boolean(F.col("n"), "number").alias("b"),
    ).collect()
    assert [tuple(r) for r in got] == [(1.5, 2, True), (None, 0, True), (None, 0, False)]


def test_unescape_agrees_with_python(spark):
    rng = random.Random(7)
    names = [*html.entities.html5][::9] if hasattr(html, "entities") else []
    bits = ["&", ";", "#", "x", "amp", "lt", "copy", "not", "in", "128", "8217", "D800", "1F600", "0", " ",
            "&#", "&#x", "é", "99999999999", "11", "65534", *names]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = [
        (r.t, r.u, html.unescape(r.t)) for r in df.select("t", text.unescape(F.col("t")).alias("u")).collect()
        if r.u != html.unescape(r.t)
    ]
    assert wrong == []


def test_slug_is_worked_out_once(spark):
    df = spark.createDataFrame([(w + f"Ấ{w} -{w}b-" + w * 2 + "c!",) for w in text.WHITESPACE] + [("-!-",)], "t string")
    out = df.select(text.normalize_slug(F.col("t")).alias("s"))
    assert {r.s for r in out.collect()} == {"a-b-c", "unknown"}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1 and plan.count("regexp_replace(") == 2


def test_slug_agrees_with_python(spark):
    rng = random.Random(8)
    alphabet = text.FOLD_FROM + "abcXYZ012 _-/!?.,\t ßéñ中ÇØ²"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(3000)]

    def plain(s):
        s = s.strip().lower().strip("/ ").translate(str.maketrans(text.FOLD_FROM, text.FOLD_TO))
        return re.sub(r"[-\s]+", "-", re.sub(r"[^\w\s-]", "", s)).strip("-") or "unknown"

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = [
        (r.t, r.s) for r in df.select("t", text.normalize_slug(F.col("t")).alias("s")).collect() if r.s != plain(r.t)
    ]
    assert wrong == []


def test_fold_quotes(spark):
    row = spark.range(1).select(text.normalize_text(F.lit("“a” ‘b’"), fold_quotes=True).alias("t"))
    assert row.first().t == "\"a\" 'b'"


def test_images_round_trip(spark):
    urls = ["/a", "http://b/c"]
    row = spark.range(1).select(fields.normalize_images(F.lit(json.dumps(urls))).alias("u")).first()
    assert row.u == urls


def test_links_like_the_standard_library(spark):
    from itertools import product
    from urllib.parse import urljoin

    bases = ["https://s.example", "https://s.example/", "https://s.example/a/b/c", "https://s.example/a/b/", "http://s.example/a?x=1/2#f"]
    links = ["".join(p) for p in product(["", "/", "../", "./", "x/"], ["", "..", ".", "../..", "y/../z", "y//z", "a.b", "..c"], ["", "/", "/.", "/..", "?q=../1", "#/../f"])]
    links = [x for x in links if x and not x.startswith("//")]
    rows = spark.createDataFrame([*product(bases, links)], "base string, link string")
    out = rows.select("*", fields.join_url(F.col("base"), F.col("link")).alias("out")).collect()
    wrong = [(r.base, r.link, r.out, urljoin(r.base, r.link)) for r in out if r.out != urljoin(r.base, r.link)]
    assert not wrong, wrong[:5]
