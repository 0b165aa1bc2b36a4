"""The crawl index: the same pages as a scan of the crawl, without its shuffle."""

import uuid


from pagefolio.functions.selectors import pick, tags
from pagefolio.plans.profile import company_profiles
from pagefolio.sources import pages as pages_source
from pagefolio.sources.crawl_index import latest_from_index, register_crawl_index, write_crawl_index
from pagefolio.sources.pages import latest_crawl
from pagefolio.sources.rules import rules_table


def crawl(spark):
    # One URL holds most rows; a root without its slash; null statuses.
    rows = [(i, "https://a/" if i % 3 else f"https://b/{i}", "<p>x</p>", 200 if i != 998 else 404) for i in range(1000)]
    rows += [(2000, "https://c", "<p>c</p>", None), (5, "https://d/", "<p>old d</p>", 200), (6, "https://d/", "<p>d</p>", None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, status int").repartition(8)


def test_same_as_a_scan(spark, monkeypatch):
    pages = crawl(spark)
    name = f"crawl_{uuid.uuid4().hex[:8]}"
    write_crawl_index(pages, name, buckets=16)
    index = spark.table(name)
    wanted = spark.createDataFrame([("https://a/",)] * 5 + [("https://b/3",), ("https://c/",), ("https://d/",), ("https://e",)], "url string")
    for keys in (1000, 0):
        monkeypatch.setattr(pages_source, "PUSHED_KEYS", keys)
        got = sorted(tuple(r) for r in latest_from_index(index, wanted).select("url", "page_id", "page_url", "status").collect())
        want = sorted(tuple(r) for r in latest_crawl(pages, wanted).select("url", "page_id", "page_url", "status").collect())
        assert got == want and len(got) == 4


def test_no_exchange_of_the_crawl(spark, monkeypatch):
    """A second run reads the index where it lies: only the wanted URLs are dealt to its buckets."""
    monkeypatch.setattr(pages_source, "PUSHED_KEYS", 0)
    name = f"crawl_{uuid.uuid4().hex[:8]}"
    write_crawl_index(crawl(spark), name, buckets=8)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type
    other = f"again_{uuid.uuid4().hex[:8]}"
    register_crawl_index(spark, other, location, buckets=8)
    wanted = spark.createDataFrame([(f"https://b/{i}",) for i in range(0, 900, 3)], "url string")
    with_adaptive_off = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = latest_from_index(spark.table(other), wanted)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 300
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_adaptive_off)
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and other in line)
    assert "SelectedBucketsCount: 8 out of 8" in scan
    # One exchange, of the wanted URLs; none above the index scan.
    assert plan.count("Exchange hashpartitioning(url") == 1
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and other in line)
    assert not any("Exchange" in line for line in lines[at - 2 : at])


def test_profiles_with_the_index(spark):
    pages = crawl(spark)
    rules = rules_table(spark, [
        {"company_id": c, "company": c, "output": "description", "part": 0, "priority": 0,
         "url": url, "check_status": True, "pick": pick(tags("p"))}
        for c, url in (("a", "https://a/"), ("c", "https://c"), ("d", "https://d"))
    ])
    name = f"crawl_{uuid.uuid4().hex[:8]}"
    write_crawl_index(pages, name, buckets=4)
    plain = {r.company: r.description for r in company_profiles(pages, rules).collect()}
    indexed = {r.company: r.description for r in company_profiles(pages, rules, crawl_index=spark.table(name)).collect()}
    assert plain == indexed == {"a": None, "c": "c", "d": "d"}
