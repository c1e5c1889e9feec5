"""Golden values and properties of the column functions."""

from datetime import datetime
from decimal import Decimal
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelftrack import functions as fn
from shelftrack.plans.analytics import percentage_change


def evaluate(spark, column, values, kind="string"):
    """The column function over one column of values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["r"] for r in df.select("i", column(F.col("v")).alias("r")).orderBy("i").collect()]


PRICES = {
    "1.299,00 RSD": "1299.00", "1,299.00": "1299.00", "1.299": "1299", "12,5": "125",
    "1.299,00 din.": "129900", "1.299.00": "1.299", "1,234,50": "1.234", ",50": "0.5",
    "abc": None, "": None, "None": None, None: None, "12.345.678,90": "12345678.90",
    "1,2.3,45": None, "...": None, "RSD": None, "99\n": "99",
}


def test_parse_price(spark):
    got = evaluate(spark, fn.parse_price, list(PRICES))
    assert got == [None if v is None else Decimal(v).quantize(Decimal("0.0001")) for v in PRICES.values()]


def brute_price(text):
    """The rule, step by step."""
    kept = "".join(c for c in text if c in "0123456789.,")
    for mark, other in ((",", "."), (".", ",")):
        if len(kept) > 2 and kept[-3] == mark and kept[-2:].isdigit():
            parts = kept.split(mark)
            number = parts[0].replace(other, "") + "." + parts[1]
            break
    else:
        number = kept.replace(",", "").replace(".", "")
    if number in ("", ".") or number.count(".") > 1 or "," in number:
        return None
    return float(number)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,. xR", max_size=12), min_size=50, max_size=200))
def test_parse_price_like_the_rule(spark, texts):
    # Parts with separators of the other kind are not numbers on either side.
    plain = [t for t in texts if (brute_price(t) is not None)]
    got = evaluate(spark, fn.parse_price, plain)
    assert [round(float(g), 4) for g in got] == [round(brute_price(t) + 1e-9, 4) for t in plain]


DESCRIPTIONS = [
    "Roman.\nIzdavač: Primer Knjiga Strana: 320 Povez: broš\nPismo: Latinica\n"
    "ISBN: 978-86-0000-123-4 Godina izdanja: 2019",
    "ИСБН 86-7000-12X\nБрој страна / 210 /\nПисмо: ћирилица\n1987",
    "Strana u boji: 16 Broj strana: 48, format 1800x900",
    None,
    "broj strana: 99 isbn 867000123x IZDAVAČ: Test DOO\nostalo",
    "ISBN 978 pismo latinica i ćirilica, šifra 45201990",
]


@pytest.mark.parametrize(
    "column, expected",
    [
        (fn.extract_isbn, ["978-86-0000-123-4", "86-7000-12X", None, None, "867000123x", "978"]),
        (lambda c: fn.validate_isbn(fn.extract_isbn(c)), ["9788600001234", None, None, None, "867000123x", None]),
        (lambda c: fn.cut_publisher(fn.extract_publisher(c)), ["Primer Knjiga", None, None, None, "Test DOO", None]),
        (fn.page_numbers, [320, 210, 48, None, None, None]),
        (fn.script_type, ["Latinica", "Ćirilica", None, None, None, "Latinica"]),
        (fn.publication_year, [2019, 1987, 1800, None, None, 2019]),
    ],
)
def test_descriptions(spark, column, expected):
    assert evaluate(spark, column, DESCRIPTIONS) == expected


def brute_initcap(text):
    out, inside = [], False
    for c in text:
        out.append(c.lower() if inside else c.upper())
        inside = c.isalnum()
    return "".join(out)


def test_initcap_words(spark):
    texts = ["o'reilly-media d.o.o.", "ČAČAK 3d 'šabac'", "ĐURO x\tyY", "", "laguna", "a  b", "МИКРО-књига"]
    assert evaluate(spark, fn.initcap_words, texts) == [brute_initcap(t) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZčĆđ ŠžљЊ.-'\"&(1 9", max_size=20), min_size=50, max_size=100))
def test_initcap_words_like_the_rule(spark, texts):
    assert evaluate(spark, fn.initcap_words, texts) == [brute_initcap(t) for t in texts]


def test_clean_author(spark):
    values = [None, "", "  ", "A. B, C ,", " X ", "none", "None"]
    kept = ["Nepoznat Autor"] * 3 + ["A. B, C ,", "X"]
    assert evaluate(spark, fn.clean_author, values) == kept + ["Nepoznat Autor"] * 2
    assert evaluate(spark, lambda c: fn.clean_author(c, strict=True), values) == kept + ["none", "None"]


def test_split_list(spark):
    assert evaluate(spark, fn.split_list, ["A. B, C ,", "X", "", None]) == [["A. B", "C", ""], ["X"], None, None]


def test_keys(spark):
    assert evaluate(spark, fn.book_key, [" http://a "]) == evaluate(spark, fn.book_key, ["http://a"])
    df = spark.createDataFrame([("a", None), ("a", "_dbt_utils_surrogate_key_null_"), ("a", "")], "x string, y string")
    keys = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    assert keys[0] == keys[1] != keys[2]


def test_strip_and_missing(spark):
    assert evaluate(spark, fn.strip_space, ["  a b\t\n", None]) == ["a b", None]
    assert evaluate(spark, fn.null_if_missing, ["NaN", "None", "nan", "nanny", "", None]) == [None, None, None, "nanny", None, None]


LINKS = [
    ("a/b.html", "http://x.rs/s/p.html?q#f"), ("../c", "http://x.rs/s/t/p"), ("../../../c", "http://x.rs/s/t/p"),
    ("/z", "https://y.rs"), ("?p=2", "http://x.rs/l?p=1"), ("#k", "http://x.rs/l?p=1#z"), ("//cdn.rs/1", "https://y.rs/"),
    ("http://q.rs", "https://y.rs/"), ("", "http://e.rs/a"), ("d", "http://e.rs"), ("./d/./e/..", "http://e.rs/a/b"),
    ("mailto:a@b.rs", "http://e.rs/a"), ("/a/../b?x=../y", "http://e.rs/q"),
]


def test_resolve_link(spark):
    df = spark.createDataFrame(LINKS, "l string, p string").select("l", "p", fn.resolve_link("l", "p").alias("r"))
    for row in df.collect():
        assert row["r"] == urljoin(row["p"], row["l"]), (row["l"], row["p"])


def test_hosts(spark):
    urls = ["https://www.Site.rs/x", "http://site.rs:8080?x", "http://user@m.site.rs#f", "nota url", None, "http://localhost/"]
    assert evaluate(spark, fn.publisher_from_url, urls) == ["site", "site", "site", None, None, "localhost"]
    on = evaluate(spark, lambda c: fn.on_hosts(c, ["site.rs"]), urls + ["http://badsite.rs/"])
    assert on == [True, True, True, False, None, False, False]


def test_absolutize_and_valid_link(spark):
    links = ["/a", "b", "http://c.rs/d", None]
    assert evaluate(spark, lambda c: fn.absolutize(c, "https://s.rs/"), links) == ["https://s.rs/a", "https://s.rs/b", "http://c.rs/d", None]
    assert evaluate(spark, fn.valid_link, ["HTTPS://x", "http://", "ftp://x", "http:/x"]) == [True, False, False, False]


def test_local_time(spark):
    times = [datetime(2024, 1, 1, 22, 30), datetime(2024, 1, 1, 23, 30), datetime(2024, 7, 1, 22, 30)]
    texts = [t.strftime("%Y-%m-%d %H:%M:%S") for t in times]
    days = evaluate(spark, lambda c: fn.local_day(c.cast("timestamp")).cast("string"), texts)
    assert days == ["2024-01-01", "2024-01-02", "2024-07-02"]


def test_seconds_between(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:00", "2024-01-01 00:01:30.250000"), ("None", "2024-01-01")], "a string, b string"
    )
    assert [r[0] for r in df.select(fn.seconds_between("a", "b")).collect()] == [90.25, None]


def test_percentage_change(spark):
    df = spark.createDataFrame([(100.0, 150.0), (0.0, 5.0)], "a double, b double")
    assert [r[0] for r in df.select(percentage_change("a", "b")).collect()] == [50.0, None]
