"""Selectors on small hand-written pages."""

import random

import pytest
from pyspark.sql import functions as F

from pagefolio.functions.news import field_value
from pagefolio.functions.selectors import (
    alt,
    cond,
    matched,
    pick_constant,
    pick_node,
    selector,
    tags,
    text_of,
)
from pagefolio.operators.explode import elements, explode_html, text_nodes


def docs(spark, html):
    return explode_html(spark.createDataFrame([(1, html)], "page_id long, html string"))


def found(spark, html, *alts):
    nodes = matched(F.col("nodes"), selector(*alts))
    texts = F.transform(nodes, lambda n: text_of(F.col("text"), n))
    return docs(spark, html).select(texts.alias("t")).first().t


HTML = (
    '<body><section class="s dblue-bg hero"><p>1</p><div><p>2</p></div></section>'
    '<section class="dblue-bg s"><p class="intro-text">3</p></section>'
    '<div class="intro"><p>4<p>5</p></div><a href="">6</a><a>7</a><img src="/Logo.png"></body>'
)


@pytest.mark.parametrize(
    "alts, expected",
    [
        (tags("p"), ["1", "2", "3", "45", "5"]),
        ([alt(class_eq="dblue-bg s")], ["3"]),
        ([alt(class_eq="s")], []),
        ([alt("section", classes=["s", "dblue-bg"])], ["12", "3"]),
        ([alt(classes=["intro"])], ["45"]),
        ([alt(class_sub=["intro"])], ["3", "45"]),
        ([alt("p", class_sub=["nope", "ro-te"])], ["3"]),
        ([alt("p", within=cond("section", ["hero"]))], ["1", "2"]),
        ([alt("p", child_of=cond("section"))], ["1", "3"]),
        ([alt("p", within=cond("p"))], ["5"]),
        ([alt("section", child_of=cond("body"), classes=["hero"])], ["12"]),
        ([alt("body", child_of=cond("html"))], []),
        ([alt("p", within=cond(classes=["intro"])), *tags("a", "p")], ["1", "2", "3", "45", "5", "6", "7"]),
        ([alt("a", attr="href")], ["6"]),
        ([alt("img", attr="src", attr_sub="logo")], []),
        ([alt("img", attr="src", attr_sub="Logo")], [""]),
        ([alt("a", string_pattern="[67]")], ["6", "7"]),
    ],
)
def test_matched(spark, alts, expected):
    assert found(spark, HTML, *alts) == expected


def picked(spark, html, **fields):
    node = pick_node(F.col("nodes"), pick_constant(**fields))
    return docs(spark, html).select(text_of(F.col("text"), node).alias("t")).first().t


def test_pick(spark):
    words = lambda n: " ".join("w" * n)
    intro = [alt("p", within=cond(classes=["intro"]))]
    for n, expected in [(20, "first"), (21, words(21))]:
        html = f'<p>first</p><div class="intro"><p>{words(n)}</p></div>'
        assert picked(spark, html, match=intro, min_words=20, fallback=tags("p")) == expected
    assert picked(spark, "<i>x</i>", match=intro, min_words=20, fallback=tags("p")) is None
    boxes = '<div class="b"><i>x</i></div><div class="b"><p>y</p><p>z</p></div>'
    box = [alt("div", ["b"])]
    assert picked(spark, boxes, match=tags("p"), container=box) is None
    assert picked(spark, boxes, match=[alt("p", within=cond("div", ["b"]))]) == "y"
    assert picked(spark, boxes, match=tags("p"), nth=1) == "z"
    assert picked(spark, boxes, match=tags("p"), nth=2) is None
    assert picked(spark, "<h2>a</h2><h1>b</h1>", match=tags("h1", "h2")) == "a"


def test_field_from_strings(spark):
    def value(html, **fields):
        p = pick_constant(**fields)
        column = field_value(F.col("text"), F.col("nodes"), F.col("strings"), p)
        return docs(spark, html).select(column.alias("v")).first().v

    label = {"string_pattern": "Published By:", "remove": "Published By:", "split_on": " on "}
    line = "<i>x</i> Published By: Traci Hopkins on September 25, 2025 on top"
    assert value(line, **label, split_part=0) == "Traci Hopkins"
    assert value(line, **label, split_part=1) == "September 25, 2025"
    assert value("<i>Published By: Ann</i>", **label, split_part=1, default="N/A") == "N/A"
    assert value("<!-- By x --><p>By y</p>", string_pattern="(?i)By ", remove="By") == "x"
    assert value("<p>Standby power</p>", string_pattern="(?i)By ", remove="By") == "Standby power"
    assert value("<p>none</p>", string_pattern="By", default="N/A") == "N/A"


def test_row_views(spark):
    d = docs(spark, '<p class="a b">x<b>y</b></p>')
    rows = elements(d, "page_id", with_text=True).orderBy("node_id").collect()
    assert [(r.tag, r.classes, r.element_text, r.last_id) for r in rows] == [
        ("p", ["a", "b"], "xy", 1), ("b", None, "y", 1),
    ]
    strings = text_nodes(d, "page_id").orderBy("pos").collect()
    assert [(s.parent_id, s.kind, s.text) for s in strings] == [(0, "text", "x"), (1, "text", "y")]


def test_containers_against_parents(spark):
    """Id ranges give what walking up the parents gives, on random badly nested pages."""
    rng = random.Random(11)
    pieces = ['<div class="a">', '<div class="b">', '<section class="a b">', "<p>", "<p>", "x ",
              "</div>", "</section>", "</p>", "<br>"]
    pages = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    d = explode_html(spark.createDataFrame(list(enumerate(pages)), "k int, html string").repartition(8))
    nodes = F.col("nodes")
    ids = lambda alts: F.transform(matched(nodes, selector(*alts)), lambda n: n["id"])
    within = [alt("p", within=cond(classes=["a"]))]
    either = [*within, alt("br", within=cond("div", class_eq="b")), alt("p", child_of=cond("p"))]
    boxed = pick_constant(match=tags("p"), container=[alt("div", ["b"])], nth=1)
    rows = d.select(
        "k",
        F.transform(nodes, lambda n: F.struct(n["id"], n["parent"], n["tag"], n["class_attr"])).alias("shape"),
        ids(within).alias("within"),
        ids(either).alias("either"),
        pick_node(nodes, boxed)["id"].alias("boxed"),
    ).collect()
    hits = 0
    for row in rows:
        def above(node):
            while node.parent >= 0:
                node = row.shape[node.parent]
                yield node

        in_a = [n.id for n in row.shape if n.tag == "p"
                and any("a" in (m.class_attr or "").split() for m in above(n))]
        others = [n.id for n in row.shape
                  if n.tag == "br" and any((m.tag, m.class_attr) == ("div", "b") for m in above(n))
                  or n.tag == "p" and n.parent >= 0 and row.shape[n.parent].tag == "p"]
        box = next((n for n in row.shape if (n.tag, n.class_attr) == ("div", "b")), None)
        in_box = [n.id for n in row.shape if n.tag == "p" and box and any(m is box for m in above(n))]
        assert row.within == in_a
        assert row.either == sorted({*in_a, *others})
        assert row.boxed == (in_box[1] if len(in_box) > 1 else None)
        hits += len(in_a) + len(in_box)
    assert len(rows) == 400 and hits > 1000
