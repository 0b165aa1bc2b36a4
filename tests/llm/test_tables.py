"""Operators on pages and embeddings, registered queries, and the pipeline."""

import collections
import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pagefolio.llm import neighbour_graph, page_text, queries, url_filter

SF = "/root/testdata/sf0.001"


# -- URLs ----------------------------------------------------------------------------------------------
URLS = [
    "https://Example.ORG/es/x?y", "http://a.example.org/en/12#z", "https://x.com/fr/1", "https://com/de/", "https://notcom/de/",
    "https://x.net/p", "no scheme", None, "", "://", "https://x.org", "https://x.org?/", "ftp://a://b/c", "https://x.com/de", "HTTPS://É.com/fr/",
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if c < "\x80" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda f: len(f[0])) if fits else (None, None))


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[5]), (3, URLS[3])]
    table = spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id long, url string, host string")
    got = url_filter.url_verdicts(table).collect()
    assert len(got) == len(rows)
    for row in got:
        url = next(u for i, u in rows if i == row.page_id)
        host, path, rule, verdict = plain_url(url)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
        assert (row.log_odds is None) == (rule is not None)
    assert url_filter.url_verdicts(table.filter("false")).count() == 0


def test_segmenter():
    counts = np.zeros(url_filter.WORD_BUCKETS)
    for word, n in (("cheap", 50), ("pills", 40), ("free", 30), ("bets", 20), ("pill", 5), ("cheappills", 1)):
        counts[url_filter.bucket(word, len(counts))] += n
    split = url_filter.Segmenter(counts).split
    assert split("cheappills") == ["cheap", "pills"] and split("freebetspills") == ["free", "bets", "pills"]
    assert split("") == [] and split("x" * 300)


def test_learned_verdicts(spark):
    """Words of blocked addresses block other hosts, also inside concatenated names."""
    rows = [f"https://casino{i}.com/de/win" for i in range(40)] + [f"https://garden{i}.com/fr/plants" for i in range(40)]
    rows += ["https://x.net/win", "https://y.net/plants"]
    table = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(table).collect()}
    assert (got[80], got[81]) == ("block", "allow")


@pytest.mark.parametrize("broadcast", [True, False])
def test_words_of_many_urls(spark, monkeypatch, broadcast):
    """A piece is a word only if it was counted itself, however many other tokens there are."""
    if not broadcast:
        monkeypatch.setattr(url_filter, "fits_broadcast", lambda df: False)
    n = (1 << 18) + 40_000
    urls = spark.range(n).selectExpr("id AS row", "'a.org' AS host", "concat('/en/', id, '/', translate(hex(id * 7919), '0123456789', 'qwrtzpsdfg')) AS path")
    hosts = ["cheap-pills.net", "cheappills.com", "vubosyhk.net", "example.org", "12345678901.net", "x" * 30 + ".net"]
    rows = [(n + i, host, "/vubosyhk/2024" if i == 2 else "") for i, host in enumerate(hosts)]
    table = urls.unionByName(spark.createDataFrame(rows, "row long, host string, path string"))
    found = url_filter.url_words(table).filter(f"row >= {n}").collect()
    assert {r.row - n: r.words for r in found} == {
        0: ["h:cheap", "h:pills", "h:net"], 1: ["h:cheap", "h:pills", "h:com"],
        2: ["h:vubosyhk", "h:net", "p:vubosyhk"], 3: ["h:example", "h:org"],
        4: ["h:12345678901", "h:net"], 5: ["h:" + "x" * 6, "h:" + "x" * 24, "h:net"],
    }
    tokens = url_filter.url_tokens(table)
    assert tokens.filter("counted").select("name").distinct().count() > 1 << 18
    assert tokens.filter("counted and name rlike '^[0-9]+$'").count() == 0


def test_hashed_counts_know_too_much():
    """Why words are counted exactly: with as many tokens as buckets, names of no known word fall apart."""
    counts = np.zeros(url_filter.WORD_BUCKETS)
    for i in range(4 * len(counts)):
        counts[url_filter.bucket(str(i), len(counts))] += 1
    assert url_filter.Segmenter(counts).split("vubosyhk") != ["vubosyhk"]
    assert url_filter.Segmenter({str(i): 1 for i in range(1000)}).split("vubosyhk") == ["vubosyhk"]


# -- pages ---------------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="ad banner">Buy &amp; save.</div>
<article><h1>Head&nbsp;line</h1><p>One &lt;b&gt; <b>bold
 text<br>goes on.</b><p>Two.</p><!-- <p>no</p> --><aside>Side.</aside><div class="cookie-notice">Accept.</div><ul><li>i<li>j</ul>
<form><p>Name</p><input></form></article><section class="comments"><p>Reader says this is a long enough comment to look like text.</p></section>
<footer>&copy; x</footer>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<p"), (5, "u", "a < b & c"), (1, "u", PAGE),
            (6, "u", "<div>" * 5000 + "x" + "</b>" * 50), (7, "u", "<script>never ends <p>x"), (8, "u", "<article>" + "<p>word word.</p>" * 3000)]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = page_text.main_texts(table, page_text.train(table))
    assert got.count() == len(rows)
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[1] == "Head line\nOne <b> bold text goes on.\nTwo.\ni\nj"
    assert texts[2] == texts[3] == texts[7] == ""
    assert texts[8].count("\n") == 2999
    assert all(r.n_chars == len(r.text) for r in got.collect())
    none = table.filter("false")
    assert page_text.main_texts(none, page_text.train(none)).count() == 0


def test_viterbi():
    rng = np.random.default_rng(0)
    for _ in range(50):
        scores, moves = rng.normal(size=6), rng.normal(size=(2, 2))
        paths = np.array(np.meshgrid(*[[0, 1]] * 6)).reshape(6, -1).T
        value = [p @ scores + sum(moves[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths]
        assert page_text.viterbi(scores, moves).tolist() == paths[int(np.argmax(value))].tolist()


# -- embeddings ------------------------------------------------------------------------------------------
def test_embeddings(spark):
    rng = np.random.default_rng(1)
    rows = []
    for size in (1, 2, 5, 40):
        centre = rng.normal(size=16)
        rows += [(centre + rng.normal(size=16) * 0.12).tolist() for _ in range(size)]
    rows += [rng.normal(size=16).tolist() for _ in range(150)]
    rows += [rows[0], rows[0], [2 * x for x in rows[0]], None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    order = rng.permutation(len(rows))
    table = spark.createDataFrame(
        [(int(i), rows[k], 1) for i, k in enumerate(order)], "vec_id long, embedding array<double>, u int"
    ).repartition(4)
    units = [neighbour_graph.usable(rows[k]) for k in order]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    links = collections.Counter()
    for i, x in enumerate(units):
        for j, y in enumerate(units[:i]):
            if x is not None and y is not None and len(x) == len(y) and x @ y >= 0.95:
                links.update((i, j))
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbour_graph.embedding_groups(table).collect()}
    assert got == {i: (links[i], top(i), top(i) == i) for i in range(len(rows))}
    assert neighbour_graph.embedding_groups(table.filter("false")).count() == 0


def test_bridge_between_dense_groups(spark):
    """Two groups larger than any list, joined by a single link that is the weakest of both its ends."""
    rng = np.random.default_rng(2)
    angles = np.radians([0, *-rng.uniform(1, 4, 400), 17.5, *17.5 + rng.uniform(1, 4, 400)])
    x = np.column_stack([np.cos(angles), np.sin(angles), rng.normal(size=(len(angles), 14)) * 0.001])
    x[[0, 401], 2:] = 0
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    assert linked[:401, 401:].sum() == 1 and linked[0, 401]
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in neighbour_graph.embedding_groups(table).collect())
    assert got == [(i, int(linked[i].sum()) - 1, 0) for i in range(len(x))]


def test_lists_are_cut_at_their_own_length():
    ids = np.arange(100)
    codes = [neighbour_graph.rounded(np.array([1.0, 0.001 * i])).tobytes() for i in ids]
    columns = [np.zeros(100, np.int64), ids, codes, np.full(100, -2.0, np.float32), np.where(ids == 7, 80, 10)]
    found = list(neighbour_graph._compared(pa.table([pa.array(c) for c in columns], ["c", "u", "code", "worst", "k"])))
    assert collections.Counter(found[0].column("u").to_pylist()) == {i: 80 if i == 7 else 10 for i in range(100)}


# -- queries -------------------------------------------------------------------------------------------
@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLES[name]).select(*df.columns).fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline(spark, tmp_path):
    """Every stage works on what its predecessor kept; the result is that of ``run``."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == columns
        now = [r.doc_id for r in docs.collect()]
        assert len(now) == len(set(now)) and set(now) <= kept
        kept = set(now)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == kept and kept
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(packed.select(*pieces).collect()) == sorted(corpus_pipeline.run(spark, SF).select(*pieces).collect())
