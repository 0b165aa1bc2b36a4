"""The page reader: nesting, strings, texts, and the shortcuts against the standard parser."""

import random
from html.parser import HTMLParser

import pyarrow as pa
import pytest

from pagefolio.functions.html import PageReader, read_pages


def read(html, reader=None):
    reader = reader or PageReader()
    reader.read(html)
    text, nodes, strings = (a.to_pylist()[-1] for a in reader.arrays())
    for node in nodes or []:
        node["text"] = text[node["start"] : node["start"] + node["len"]]
    return nodes, strings


def texts(html, tag):
    return [n["text"] for n in read(html)[0] if n["tag"] == tag]


@pytest.mark.parametrize(
    "html, tag, expected",
    [
        ("<p> a <b>b</b> c</p>", "p", ["abc"]),
        ("<p>a<p>b</p>c", "p", ["abc", "b"]),
        ("<div>x<script>y</script><!--z--><style>w</style></div>", "div", ["x"]),
        ("<div>a</p>b</span></div>c", "div", ["ab"]),
        ("<div><p>a</div>b</p>c", "p", ["a"]),
        ("<p>a<br>b<img src=x>c</p>", "p", ["abc"]),
        ("<p>a<br/>b</br>c</p>", "p", ["abc"]),
        ("<p/>a<p>b</p>", "p", ["", "b"]),
        ("<P>&amp;&lt;&#65;&#x42;&copy;&#150;</P>", "p", ["&<AB©–"]),
        ("<p>&#xD800;&#99999999999;&nope;.</p>", "p", ["��&nope."]),
        ("<p>a<template>b<i>c</i></template>d</p>", "p", ["ad"]),
        ("<p>a<![CDATA[ b ]]>c</p>", "p", ["abc"]),
        ("<p>a<![oops b]>c</p>", "p", ["ac"]),
        ("<p> a </p>", "p", ["a"]),
        ("", "p", []),
        ("no tags", "p", []),
    ],
)
def test_text(html, tag, expected):
    assert texts(html, tag) == expected


def test_ranges_and_parents():
    nodes, _ = read("<a><b><c></c></b><d></d></a><e></e>")
    shape = [(n["tag"], n["id"], n["last"], n["parent"]) for n in nodes]
    assert shape == [("a", 0, 3, -1), ("b", 1, 2, 0), ("c", 2, 2, 1), ("d", 3, 3, 0), ("e", 4, 4, -1)]


def test_attributes():
    nodes, _ = read("<a HREF='/x&amp;y' download class=' b \n a ' href=z><i class=''>")
    assert dict(nodes[0]["attrs"]) == {"href": "z", "download": ""}
    assert [n["class_attr"] for n in nodes] == ["b a", ""]
    assert read("<a title=x>")[0][0]["class_attr"] is None


def test_own_string():
    html = "<a><b>x</b></a><a>x<b>y</b></a><a><img></a><a>\n \n</a><a><!--c--></a><a></a>"
    nodes = read(html)[0]
    own = [None if n["own_at"] is None else nodes[n["own_at"]]["own_string"] for n in nodes if n["tag"] == "a"]
    assert own == ["x", None, None, "\n", "c", None]


def test_nested_tags_do_not_repeat_their_string():
    nodes, _ = read("<b>" * 5000 + "x" * 1000)
    assert sum(len(n["own_string"] or "") for n in nodes) == 1000
    assert {n["own_at"] for n in nodes} == {4999}


def test_strings_keep_blanks_where_they_count():
    _, strings = read("<!DOCTYPE html><p> \t </p><pre> \n\n </pre><p> a\n</p><script>s</script>")
    assert [(s["kind"], s["text"]) for s in strings] == [
        ("doctype", "html"), ("text", " "), ("text", " \n\n "), ("text", " a\n"), ("script", "s"),
    ]


def test_words():
    nodes, _ = read("<div>one two<b>three</b> four <i> </i></div>")
    # The strings are joined without a gap: "one twothreefour".
    assert [(n["tag"], n["words"]) for n in nodes] == [("div", 2), ("b", 1), ("i", 0)]


def test_null_and_chunks():
    pages = ["<p>a</p>", None, "", "<p>b" + "x" * 5_000_000, "<i>c</i>"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(pages)], names=["k", "html"])
    rows = [r for b in read_pages(iter([batch]), "html") for r in b.to_pylist()]
    assert [r["k"] for r in rows] == [0, 1, 2, 3, 4]
    assert [r["nodes"] and len(r["nodes"]) for r in rows] == [1, None, [], 1, 1]
    assert rows[3]["text"] == pages[3][3:]


def test_pruning():
    reader = PageReader(["src", "nope"], with_strings=False)
    reader.read('<p class="c" id="i" src="s" style="x">a<b>b</b></p>')
    text, nodes = (a.to_pylist()[0] for a in reader.arrays())
    assert text == "ab"
    assert [(n["class_attr"], dict(n["attrs"]), n["own_string"]) for n in nodes] == [
        ("c", {"src": "s"}, None), (None, {}, "b"),
    ]


class StandardReader(PageReader):
    """The reader without its shortcuts."""

    updatepos = HTMLParser.updatepos

    def parse_starttag(self, i):
        return HTMLParser.parse_starttag(self, i)

    def parse_endtag(self, i):
        return HTMLParser.parse_endtag(self, i)


PIECES = [
    "<p>", "</p>", '<b class="x  y" id=q>', "</b>", "<br>", "<br/>", "<div/>", " ", "\n ", "a b",
    "&amp;", "&bad;", "&#65;", "<!-- c -->", "<script>", "</script>", "<style>x", "</style>",
    "<pre>", "</pre>", "<template>", "</template>", "<![CDATA[q]]>", "<?pi?>", "<!DOCTYPE html>",
    '<a href="/x" TITLE="A&amp;B">', "<A HREF='y'>", "</a >", '<img src="a>b" alt>', "<", ">", "&",
    '<a href="x" href="z">', '<p\n class="t" >', "</P>", '<i data-x="<p>">', "<textarea>", "</textarea>",
    "<![if x]>", "</", "<!", '<a href="x"class="y">', "<p/ >",
]


def test_shortcuts_change_nothing():
    rng = random.Random(7)
    for _ in range(4_000):
        html = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 20)))
        assert read(html) == read(html, StandardReader()), html
