"""Text, name and link expressions, against the Python standard library and hand-made cases."""

import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from pagefolio.functions import links, names, text

ALPHABET = list("aAbBzZ019 _-./%+()\t\n'&éÉßñÇǆǅΣσςдЖªⅷ中  \x1c\x85") + [
    "%20", "%C3%A9", "%zz", "logo", "Logo", "ORIG", "-12x34-1", ".png", ".JPEG", "by ", " By",
]


def samples(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def applied(spark, values, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, s string").repartition(8)
    got = {r.i: r.r for r in df.select("i", expression(F.col("s")).alias("r")).collect()}
    return [got[i] for i in range(len(values))]


@pytest.mark.parametrize(
    "expression, python",
    [
        (text.strip, str.strip),
        (text.collapse_blanks, lambda s: __import__("re").sub(r"\s+", " ", s)),
        (text.is_blank, lambda s: not s.strip()),
        (text.word_count, lambda s: len(s.split())),
        (names.url_decoded, urllib.parse.unquote),
        (names.title_case, str.title),
    ],
)
def test_like_python(spark, expression, python):
    values = samples(4000)
    wrong = [
        (v, g, python(v)) for v, g in zip(values, applied(spark, values, expression)) if g != python(v)
    ]
    assert not wrong, wrong[:5]


def test_cleaner_b(spark):
    cases = {
        "/w/acme-corp-1024x343-1.png": "Acme Corp",
        "a_b_2021.JPG": "A B",
        "logo.svg": "Logo.Svg",
        "x/Big--Co__2.webp?v=2": "Big Co .Webp?V=2",
        "o'neil-3d.jpeg": "O'Neild",
        "a.png.png": "A.Png",
        "x/-_.png": "",
        "/dir/": "",
        "a.png\n": "A",
    }
    assert applied(spark, list(cases), names.name_from_file) == list(cases.values())


def test_cleaner_a(spark):
    cases = {
        "https://cdn.x.com/5f3a_66ab_Acme%20Corp%20logo.png": "Acme Corp",
        "5f3a_one%20Big%20Co.png": "Big Co",
        "/i/one.png": "",
        "https://a.com/x": "",
        "/i/x%20Logotype%20ORIG%20(12).svg": "Logotype",
        "/i/x noun-circle-arrow-right-up-2892975-FFFFFF.svg": "",
        "/i/x 12ab  y.z": "y",
        "/i/x%2520y%2520z.png": "",
        "/i/a b%2520c.png": "b c",
        "a+b c.d": "c",
    }
    assert applied(spark, list(cases), names.name_from_address) == list(cases.values())


def test_client_name(spark):
    values = ["/i/one.png", "/i/x  y.png", "-1.png", None]
    a = applied(spark, values, lambda s: names.client_name(s, F.lit("A")))
    b = applied(spark, values, lambda s: names.client_name(s, F.lit("B")))
    assert a == [None, "y", None, None]
    assert b == ["One", "X  Y", None, None]


def test_absolute(spark):
    cases = {
        "/y": "https://b/y", "y": "https://b/y", "//y/": "https://b/y/", "http://z/": "http://z/",
        "#top": "https://b/#top", "mailto:x": "https://b/mailto:x", "": "https://b/",
        "HTTP://z": "https://b/HTTP://z",
    }
    for base in ("https://b", "https://b//"):
        got = applied(spark, list(cases), lambda s: links.absolute(s, F.lit(base)))
        assert got == list(cases.values())


def test_requested(spark):
    cases = {
        "https://b#top": "https://b/", "https://b": "https://b/", "http://b?x=1#y": "http://b/?x=1",
        "https://b/p#q": "https://b/p", "https://b/p": "https://b/p", "mailto:x": "mailto:x",
    }
    assert applied(spark, list(cases), links.requested) == list(cases.values())
