"""Specs meet their pages without passing through Python, or with the page where they are many."""

import pytest
from pagefolio.functions.selectors import pick, tags
from pagefolio.operators import extract
from pagefolio.plans.profile import company_profiles
from pagefolio.sources.rules import rules_table


@pytest.mark.parametrize("per_row", [64, 1])
def test_few_specs_stay_out_of_the_rows_of_pages(spark, monkeypatch, per_row):
    kinds = []
    original = extract.explode_html

    def noting(html, **kwargs):
        kinds.append(html.schema["specs"].dataType.simpleString()[:13])
        return original(html, **kwargs)

    monkeypatch.setattr(extract, "explode_html", noting)
    monkeypatch.setattr(extract, "SPECS_PER_ROW", per_row)
    rows = [(1, "https://a/", "<p>one</p><i>two</i>", 200), (2, "https://b/", None, 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, status int")
    rules = rules_table(spark, [
        {"company_id": f"{c}{tag}", "company": None, "output": "description", "part": 0, "priority": 0,
         "url": f"https://{c}/", "check_status": True, "pick": pick(tags(tag), default="none")}
        for c in "abc" for tag in ("p", "i", "b")
    ])
    got = {r.company_id: r.description for r in company_profiles(pages, rules).collect()}
    assert got == {
        "ap": "one", "ai": "two", "ab": "none", "bp": "none", "bi": "none", "bb": "none",
        "cp": None, "ci": None, "cb": None,
    }
    assert kinds[0] == ("array<string>" if per_row == 64 else "array<struct<")
