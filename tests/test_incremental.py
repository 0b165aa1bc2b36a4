"""Incremental runs: pages whose HTML did not change are not parsed again."""

from pyspark.sql import functions as F

from pagefolio.functions.selectors import pick, tags
from pagefolio.operators import extract
from pagefolio.plans.profile import company_profiles
from pagefolio.sources.rules import rules_table


def test_unchanged_pages_are_not_parsed_again(spark, tmp_path, monkeypatch):
    parsed = []
    original = extract.explode_html

    def counting(html, **kwargs):
        parsed.append(html.count())
        return original(html, **kwargs)

    monkeypatch.setattr(extract, "explode_html", counting)
    rows = [(i, f"https://{c}/", f"<p>{c} text</p>", 200) for i, c in enumerate("abcd")]
    rows.append((9, "https://b/", "<p>b copy</p>", 200))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, status int")
    rules = rules_table(spark, [
        {"company_id": c, "company": c, "output": "description", "part": 0, "priority": 0,
         "url": f"https://{c}/", "check_status": True, "pick": pick(tags("p"))}
        for c in "abcde"
    ])
    store = str(tmp_path / "results")
    plain = {r.company: r.description for r in company_profiles(pages, rules).collect()}
    parsed.clear()
    first = {r.company: r.description for r in company_profiles(pages, rules, results_store=store).collect()}
    assert first == plain and parsed[0] == 4
    parsed.clear()
    again = {r.company: r.description for r in company_profiles(pages, rules, results_store=store).collect()}
    assert again == plain and parsed[0] == 0
    changed = pages.withColumn("html", F.when(F.col("page_id") == 2, F.lit("<p>c new</p>")).otherwise(F.col("html")))
    parsed.clear()
    third = {r.company: r.description for r in company_profiles(changed, rules, results_store=store).collect()}
    assert third == {**plain, "c": "c new"} and parsed[0] == 1
