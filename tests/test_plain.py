"""Plain pages read all at once give the columns that the event reader gives."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pagefolio.checks.tables import table
from pagefolio.functions import html as page_reader
from pagefolio.functions.html import SPECIAL_TAGS, VOID_TAGS, PageReader, document_columns
from pagefolio.functions.plain import plain_pages
from pagefolio.functions.selectors import (
    PICK_DDL,
    alt,
    cond,
    pick,
    pick_constant,
    pick_node,
    tags,
)
from pagefolio.operators.explode import explode_html

TEXTS = [" ", "\n ", "a b", " x", "", "é  é ", "\x1c", "12", "\t\x0b", "\r\n", "　𝄞 y", "<br>",
         '<IMG src="q" title="é">']
STARTS = ["", ' class="a  b"', ' href="x" class="c" ID="1" id="2"', '  \n data-x=""', " "]
PIECES = ["<p>", "</p>", '<b class=" x  y">', "</b>", "<br>", "</br>", " ", "a b", "<i a='1'>", "</i >",
          "<pre>", "</pre>", "<br/>", "&amp;", ">", "<", "<!-- c -->", "<script>", "</script>", "<x:y>", "\x00"]


def balanced(rng, depth=0):
    out = []
    for _ in range(rng.randint(0, 4)):
        if rng.random() < 0.45:
            out.append(rng.choice(TEXTS))
        elif depth < 6:
            name = rng.choice(["p", "div", "B", "section", "h-1"])
            out.append(f"<{name}{rng.choice(STARTS)}>{balanced(rng, depth + 1)}</{name.lower()}>")
    return "".join(out)


def by_events(pages, attrs, with_strings):
    reader = PageReader(attrs, with_strings)
    for html in pages:
        reader.read(html)
    return reader.arrays()


@pytest.mark.parametrize("attrs, with_strings", [(None, True), (["id", "href"], False), ([], True)])
def test_same_columns(attrs, with_strings):
    rng = random.Random(5)
    n_plain = 0
    for round_ in range(150):
        pages = [
            balanced(rng) if rng.random() < 0.8 else "".join(rng.choices(PIECES, k=rng.randint(0, 8)))
            for _ in range(rng.randint(0, 30))
        ]
        pages = [None if rng.random() < 0.05 else html for html in pages]
        array = pa.array(pages, pa.string() if round_ % 2 else pa.large_string()).slice(round_ % 3)
        pages = pages[round_ % 3 :]
        n_plain += len(plain_pages(array, attrs, with_strings, VOID_TAGS, SPECIAL_TAGS)[0])
        found, expected = document_columns(array, attrs, with_strings), by_events(pages, attrs, with_strings)
        for a, b in zip(found, expected, strict=True):
            a.validate(full=True)
            assert a.type == b.type
            for html, x, y in zip(pages, a.to_pylist(), b.to_pylist(), strict=True):
                assert x == y, html
    assert n_plain > 1000


def test_plain_pages_need_no_events(monkeypatch):
    class Stopped(PageReader):
        def read(self, html):
            raise AssertionError(html)

    monkeypatch.setattr(page_reader, "PageReader", Stopped)
    pages = [f'<html><body><div class="dates"><p>{i}/1</p>\n<p>é {i}</p></div></body></html>' for i in range(50)]
    text, nodes = document_columns(pa.array(pages), None, False)
    assert text.to_pylist() == [f"{i}/1é {i}" for i in range(50)]
    assert [n["own_string"] for n in nodes[7].as_py()] == [None, None, None, "7/1", "é 7"]
    with pytest.raises(AssertionError):
        document_columns(pa.array(["<p>a &amp; b</p>"]), None, False)


def test_deep_and_wide_pages():
    pages = ["<b>" * 400 + " x " + "</b>" * 400, "<p>a</p>" * 5000, "<div>" + "<br>" * 300 + "</div>"]
    for a, b in zip(document_columns(pa.array(pages), None, True), by_events(pages, None, True), strict=True):
        assert a.to_pylist() == b.to_pylist()


def test_constant_picks_choose_as_columns_do(spark):
    rng = random.Random(3)
    pages = [balanced(rng) for _ in range(300)] + [None, ""]
    box = [alt("div", ["a"])]
    picks = [
        pick(tags("p")),
        pick(tags("p"), nth=2),
        pick(tags("p", "b"), container=box, nth=1),
        pick(tags("p"), container=[alt("nope")], fallback=tags("div")),
        pick([alt("p", within=cond("div", ["b", "a"])), alt("b", child_of=cond("p"))], min_words=1),
        pick([alt(class_eq="c", attr="href", attr_sub="x")], container=tags("section")),
        pick([alt(class_sub=["b", "z"], string_pattern="[a-z0-9]")], fallback=tags("h-1")),
        pick([alt(classes=["a b"]), alt("img", attr="title"), alt("br", within=cond(classes=[]))], nth=1),
        pick(None, fallback=tags("p")),
    ]
    docs = explode_html(spark.createDataFrame(list(enumerate(pages)), "k int, html string").repartition(4))
    rules = spark.createDataFrame([(picks,)], f"picks array<{PICK_DDL}>")
    as_rules = docs.crossJoin(rules).select(
        "k", F.transform("picks", lambda p: pick_node(F.col("nodes"), p)["id"]).alias("ids")
    )
    as_constants = docs.select(
        "k", F.array(*[pick_node(F.col("nodes"), pick_constant(**p))["id"] for p in picks]).alias("ids")
    )
    expected = {r.k: r.ids for r in as_rules.collect()}
    assert {r.k: r.ids for r in as_constants.collect()} == expected
    for i in range(len(picks)):
        chosen = [ids[i] for ids in expected.values()]
        assert any(c is not None for c in chosen) and None in chosen, picks[i]


def test_large_row_groups_are_dealt_out(spark, tmp_path):
    """Two row groups, cut into more partitions than there are cores, of which two hold all rows."""
    n = 400_000
    rng = random.Random(1)
    keys = [rng.getrandbits(60) for _ in range(n)]
    lines = pa.table({"k": keys, "v": list(range(n))})
    pq.write_table(lines, tmp_path / "lines.parquet", row_group_size=n // 2)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(100_000))
    try:
        rows = table(spark, str(tmp_path), "lines", "k", "v")
        counts = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set(setting, before)
    assert sum(counts) == n and len(counts) > 8 and max(counts) < n // 8
