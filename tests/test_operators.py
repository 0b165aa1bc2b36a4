"""Candidates, crawls, lists and shared evaluation, also with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from pagefolio.functions.selectors import alt, pick, tags
from pagefolio.operators import extract
from pagefolio.operators.choose import choose_candidate, is_served
from pagefolio.operators.lists import joined, ordered_distinct, ordered_list
from pagefolio.operators.prune import expected_false_positives, filter_shape, only_needed
from pagefolio.plans.profile import company_profiles
from pagefolio.sources import pages as pages_source
from pagefolio.sources import scratch
from pagefolio.sources.pages import latest_crawl, spread, with_status
from pagefolio.sources.rules import rules_table
from pagefolio.sources.sites import ARTICLE, TEXT_LINK


def test_is_served(spark):
    values = [200, 301, 399, 400, 404, 599, 600, None]
    df = spark.createDataFrame([(v,) for v in values], "s int").select(is_served(F.col("s")).alias("r"))
    assert [r.r for r in df.collect()] == [True, True, True, False, False, False, True, None]


def test_choose_candidate(spark):
    rng = random.Random(5)
    rows = []
    for key in range(300):
        for priority in range(rng.randint(1, 4)):
            status = rng.choice([200, 204, 404, 503, None])
            page = None if status is None else key * 10 + priority
            rows.append((key, priority, status, page, key % 2 == 0))
    df = spark.createDataFrame(
        rows, "key int, priority int, status int, page_id int, check_status boolean"
    ).repartition(8)
    got = {r.key: (r.priority, r.page_id) for r in choose_candidate(df, "key").collect()}
    for key in range(300):
        mine = [r for r in rows if r[0] == key]
        best = next((r for r in mine if r[2] == 200), mine[-1])
        served = best[2] is not None and (best[2] < 400 or not best[4])
        assert got[key] == (best[1], best[3] if served else None)


def test_latest_crawl(spark):
    # One URL holds most of the rows.
    rows = [(i, "https://a/" if i % 3 else f"https://b/{i}", 200 if i != 998 else 404) for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, status int").repartition(8)
    urls = spark.createDataFrame([("https://a/",)] * 5 + [("https://b/3",), ("https://c",)], "url string")
    got = {r.url: (r.page_id, r.status) for r in latest_crawl(pages, urls).collect()}
    assert got == {"https://a/": (998, 404), "https://b/3": (3, 200)}
    assert with_status(pages.drop("status")).first().status == 200


def test_page_identity(spark):
    """Roots without a slash, null statuses and one id for two addresses, in any order of the rows."""
    rows = [
        (1, "https://a", "<p>old a</p>", 200), (7, "https://a", "<p>a</p>", None),
        (7, "https://b/", "<p>b</p>", 200), (8, "https://c?x", "<p>c</p>", None), (9, "https://d/", "<p>d</p>", 404),
    ]
    rules = rules_table(spark, [
        {"company_id": c, "company": c, "output": "description", "part": 0, "priority": 0,
         "url": f"https://{c}" + ("?x" if c == "c" else ""), "check_status": True, "pick": pick(tags("p"))}
        for c in "abcd"
    ])
    for seed in range(2):
        mixed = random.Random(seed).sample(rows, len(rows))
        crawl = spark.createDataFrame(mixed, "page_id long, url string, html string, status int")
        got = {r.company: r.description for r in company_profiles(crawl, rules).collect()}
        assert got == {"a": "a", "b": "b", "c": "c", "d": None}
    only = company_profiles(crawl, rules, company_ids="a").collect()
    assert [r.company for r in only] == ["a"]
    scratch.remove_written(spark)


def test_only_needed(spark):
    rows = spark.range(20_000).withColumn("x", F.col("id") * 7)
    wanted = spark.range(0, 40_000, 1000).withColumnRenamed("id", "k")
    found = only_needed(rows, F.col("id"), wanted, F.col("k"))
    ids = {r.id for r in found.collect()}
    assert found.columns == rows.columns and ids >= set(range(0, 20_000, 1000)) and len(ids) < 100


def test_filter_fits_the_number_of_keys(spark):
    # By arithmetic: fifty million wanted ids let about 1 % of the others pass, in 60 MB.
    blocks, hashes = filter_shape(50_000_000)
    assert blocks * 4096 < 64 * 2**20 and expected_false_positives(50_000_000, blocks, hashes) < 0.015
    blocks, hashes = filter_shape(500_000_000)
    assert blocks * 4096 <= 128 * 2**20 and expected_false_positives(500_000_000, blocks, hashes) < 0.5
    # Measured: 30,000 wanted among 300,000.
    rows = spark.range(300_000)
    wanted = spark.range(0, 300_000, 10).withColumnRenamed("id", "k")
    ids = {r.id for r in only_needed(rows, F.col("id"), wanted, F.col("k")).collect()}
    others = len(ids) - 30_000
    assert ids >= set(range(0, 300_000, 10)) and others < 0.02 * 270_000


def test_html_is_pruned_before_its_shuffle(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(pages_source, "PUSHED_KEYS", 0)
    path = str(tmp_path / "pages")
    crawl_of(spark, {f"https://a/{i}": "<p>x</p>" for i in range(50)}).write.parquet(path)
    pages = spark.read.parquet(path)
    wanted = spark.createDataFrame([(3, "https://a/3")], "page_id long, page_url string")
    html = pages_source.fetch(pages, wanted)
    plan = html._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and html.count() == 1
    # What goes over the exchange has passed the filter.
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(page_id" in line)
    assert any("BroadcastHashJoin" in line and "prune_part" in line for line in lines[exchange : exchange + 5])


def test_documents_are_not_shuffled(spark, monkeypatch):
    for limit in (scratch.BROADCAST_BYTES, 0):
        monkeypatch.setattr(scratch, "BROADCAST_BYTES", limit)
        seen = []
        monkeypatch.setattr(extract, "written", lambda df, name: seen.append((name, df)) or scratch.written(df, name))
        pages = crawl_of(spark, {"https://a/": "<p>x</p>"})
        rules = rules_table(spark, [
            {"company_id": "1", "company": "c", "output": "description", "part": 0, "priority": 0,
             "url": "https://a/", "check_status": True, "pick": pick(tags("p"))}
        ])
        company_profiles(pages, rules).collect()
        results = dict(seen)["results"]._jdf.queryExecution().executedPlan().toString().splitlines()
        reader = next(i for i, line in enumerate(results) if "MapInArrow" in line)
        above = [line for line in results[:reader] if "Exchange" in line or "Sort " in line]
        assert above and not any("nodes" in line for line in above)


def test_lists(spark):
    rows = [(1, 3, "a"), (1, 1, "b"), (1, 2, "a"), (2, 1, "c"), (1, 4, "b")]
    df = spark.createDataFrame(rows, "g int, pos int, name string").repartition(4)
    everything = ordered_list(df, ["g"], "name", "pos")
    assert {r.g: r.names for r in everything.collect()} == {1: ["b", "a", "a", "b"], 2: ["c"]}
    distinct = ordered_list(ordered_distinct(df, ["g"], "name", "pos"), ["g"], "name", "pos")
    shown = distinct.select("g", joined(F.col("names"), F.lit(None)).alias("s"))
    assert {r.g: r.s for r in shown.collect()} == {1: "b,a", 2: "c"}


def test_spread(spark):
    small = spark.range(10).coalesce(1)
    assert spread(small, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    large = spark.range(0, 100, 1, 40)
    assert spread(large, "id") is large


def crawl_of(spark, pages):
    rows = [(i, url, html, 200) for i, (url, html) in enumerate(pages.items())]
    return spark.createDataFrame(rows, "page_id long, url string, html string, status int")


@pytest.mark.parametrize("is_small", [True, False])
def test_many_specs_and_a_hot_article(spark, monkeypatch, is_small):
    """200 companies read one page by different rules, and most link to one article."""
    if not is_small:
        monkeypatch.setattr(scratch, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(pages_source, "PUSHED_KEYS", 0)
    page = "".join(f'<p class="c{i}">text {i}</p>' for i in range(200)) + '<a href="/n">News</a>'
    pages = crawl_of(spark, {"https://a/": page, "https://a/n": "<h1>T</h1><time>May</time>"})
    rows = []
    for i in range(200):
        base = {"company_id": str(i), "company": f"c{i}", "part": 0, "priority": 0, "check_status": True}
        rows.append({
            **base, "output": "description", "url": "https://a/", "pick": pick([alt("p", [f"c{i}"])])
        })
        rows.append({
            **base, "output": "news", "url": "https://a" if i % 3 else "https://gone/",
            "pick": pick(TEXT_LINK), "base_url": "https://a", "no_link_text": "No news",
            "fields": ARTICLE, "layout": "N5",
        })
    got = {int(r.company_id): r for r in company_profiles(pages, rules_table(spark, rows)).collect()}
    assert len(got) == 200
    for i, row in got.items():
        assert row.description == f"text {i}"
        assert row.clients is None and row.client_names is None
        news = "url: https://a/n\n\ntitle: T\ndate: May\nauthor: N/A\nsummary: N/A\n"
        assert row.news == (news if i % 3 else None)


def test_size_checked(spark, monkeypatch):
    df = spark.createDataFrame([("x" * 100,)], "s string")
    plan = lambda: spark.range(5).join(scratch.size_checked(df), F.col("s") == F.col("id"))
    assert "Broadcast" in plan()._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", 50)
    assert "SortMergeJoin" in plan()._jdf.queryExecution().executedPlan().toString()


def test_written(spark):
    df = spark.createDataFrame([(1, None)], "a int, b array<struct<c:string>>")
    table = scratch.written(df, "t")
    assert table.schema.simpleString() == df.schema.simpleString()
    assert table.collect() == df.collect()
    assert scratch.shared_folder(spark) in table.inputFiles()[0]


def test_empty_fields(spark):
    """No pick for a field gives null; an empty page gives the defaults."""
    pages = crawl_of(spark, {"https://a/": None, "https://b/": ""})
    rows = [
        {"company_id": c, "company": c, "output": "description", "part": 0, "priority": 0,
         "url": f"https://{c}/", "check_status": True, "pick": pick(tags("p"), default="none")}
        for c in "ab"
    ]
    got = company_profiles(pages, rules_table(spark, rows)).collect()
    assert [r.description for r in got] == ["none", "none"]


def test_pushed_keys(spark, tmp_path):
    path = str(tmp_path / "pages")
    crawl_of(spark, {f"https://a/{i}": "<p>x</p>" for i in range(50)}).write.parquet(path)
    pages = pages_source.read_pages_table(spark, path)
    assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    urls = spark.createDataFrame([("https://a/7",), ("https://a/9",)], "url string")
    crawl = latest_crawl(pages, urls)
    assert {r.page_id for r in crawl.collect()} == {7, 9}
    plan = crawl._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(url" in plan and "html" not in plan
    html = pages_source.fetch(pages, crawl.select("page_id", "page_url"))
    assert "PushedFilters: [In(page_id" in html._jdf.queryExecution().executedPlan().toString()
    assert html.count() == 2
