"""Company profiles: rules and crawled pages in, one row per company out.

The plan for any number of sites:

1. Look up the rules' addresses in the pages table without reading HTML, and choose one
   candidate page per rule.
2. Read and explode the chosen pages, each once, and evaluate the rules on them.
3. Look up, read and explode the articles that the listings lead to, each once.
4. Bring the outputs of a company together in one aggregation.

Between the steps tables of the size of the rules are written to the shared folder. What is
joined to the HTML column is measured first: it is broadcast if it is small, so that the HTML is
not shuffled, and shuffled with it otherwise.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefolio.functions.links import absolute, requested
from pagefolio.functions.news import FIELDS, layout
from pagefolio.operators.choose import choose_candidate, is_served
from pagefolio.operators.extract import evaluated_articles, evaluated_outputs
from pagefolio.operators.lists import joined
from pagefolio.sources.crawl_index import latest_from_index
from pagefolio.sources.pages import latest_crawl
from pagefolio.sources.rules import SPEC_DDL
from pagefolio.sources.scratch import written

COMPANY = ["company_id", "company"]


def of_companies(rules: DataFrame, company_ids: Iterable[str] | DataFrame | None) -> DataFrame:
    """The rules of the given company ids, or all. An unknown id has no rules and no result.

    Many ids are best given as a DataFrame with a column ``company_id``; it may repeat them.
    """
    if company_ids is None:
        return rules
    if isinstance(company_ids, DataFrame):
        return rules.join(company_ids.select("company_id"), "company_id", "left_semi")
    ids = [company_ids] if isinstance(company_ids, str) else list(company_ids)
    return rules.filter(F.col("company_id").isin(ids))


def prepared(rules: DataFrame) -> DataFrame:
    """Rules with their selectors folded into ``page_spec`` and ``article_spec``, each with a key.

    Sites that share a layout share their specs. As texts these take next to no room in a
    written table, and the keys stand for them wherever rows are moved.
    """
    return (
        rules.withColumn("request_url", requested(F.col("url")))
        .withColumn("page_spec", F.to_json(F.struct("output", "pick", "cleaner")))
        .withColumn("article_spec", F.to_json(F.struct("gate", "fields")))
        .drop("pick", "cleaner", "gate", "fields")
        .withColumn("page_key", F.md5("page_spec"))
        .withColumn("article_key", F.md5("article_spec"))
    )


def specs_of(rules: DataFrame, kind: str) -> DataFrame:
    """``spec_key, spec``: the distinct specs of a kind (``page`` or ``article``)."""
    texts = rules.select(F.col(f"{kind}_key").alias("spec_key"), f"{kind}_spec").distinct()
    return texts.select("spec_key", F.from_json(f"{kind}_spec", SPEC_DDL[kind]).alias("spec"))


def newest(pages: DataFrame, urls: DataFrame, index: DataFrame | None) -> DataFrame:
    """The newest crawl of the wanted URLs, from the crawl index if there is one."""
    return latest_crawl(pages, urls) if index is None else latest_from_index(index, urls)


def choose_pages(rules: DataFrame, pages: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Every output of every company with the page that serves it; ``page_id`` may be null."""
    crawl = newest(pages, rules.select(F.col("request_url").alias("url")), index)
    candidates = rules.drop("page_spec", "article_spec").join(
        crawl.withColumnRenamed("url", "request_url"), "request_url", "left"
    )
    return choose_candidate(candidates, *COMPANY, "output", "part")


def read_outputs(chosen: DataFrame, rules: DataFrame, pages: DataFrame, store: str | None = None) -> DataFrame:
    """Descriptions, client names and listing links."""
    wanted = chosen.filter("output != 'article'").withColumnRenamed("page_key", "spec_key")
    return evaluated_outputs(wanted, specs_of(rules, "page"), pages, store and f"{store}/outputs")


def wanted_articles(chosen: DataFrame, outputs: DataFrame, pages: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The article of every company: at a fixed address, or behind the link of its listing."""
    columns = [*COMPANY, "article_url", "article_key", "layout", "page_id", "page_url"]
    fixed = (
        chosen.filter("output = 'article' and page_id is not null")
        .withColumn("article_url", F.col("url"))
        .select(*columns)
    )
    links = (
        outputs.filter("output = 'news' and href is not null")
        .withColumn("article_url", absolute(F.col("href"), F.col("base_url")))
        .withColumn("request_url", requested(F.col("article_url")))
        .drop("page_id", "page_url")
    )
    crawl = newest(pages, links.select(F.col("request_url").alias("url")), index)
    served = crawl.filter(is_served(F.col("status"))).select(
        F.col("url").alias("request_url"), "page_id", "page_url"
    )
    linked = links.join(served, "request_url", "left").select(*columns)
    return linked.unionByName(fixed)


def news_items(articles: DataFrame, rules: DataFrame, pages: DataFrame, store: str | None = None) -> DataFrame:
    """``news`` and ``news_fields`` of every company with an article."""
    wanted = articles.withColumnRenamed("article_key", "spec_key")
    read = evaluated_articles(wanted, specs_of(rules, "article"), pages, store and f"{store}/articles")
    fields = F.struct(
        F.col("article_url").alias("url"), *[F.col(f"fields.{f}").alias(f) for f in FIELDS]
    )
    return read.withColumn("news_fields", fields).select(
        *COMPANY, layout(F.col("news_fields"), F.col("layout")).alias("news"), "news_fields"
    )


def assemble(rules: DataFrame, outputs: DataFrame, news: DataFrame) -> DataFrame:
    """One row per company from its outputs."""
    # Every rule sends a row, so that a company without a single page still has a profile.
    rows = (
        rules.select(*COMPANY)
        .unionByName(
            outputs.select(
                *COMPANY,
                "output",
                "part",
                "text",
                "names",
                "distinct_names",
                "empty_value",
                F.col("page_id").isNotNull().alias("found"),
                F.when(
                    (F.col("output") == "news") & F.col("page_id").isNotNull() & F.col("href").isNull(),
                    F.col("no_link_text"),
                ).alias("news"),
            ),
            allowMissingColumns=True,
        )
        .unionByName(news, allowMissingColumns=True)
    )
    is_clients = F.col("output") == "clients"
    parts = F.array_sort(F.collect_list(F.when(is_clients, F.struct("part", "names"))))
    together = rows.groupBy(*COMPANY).agg(
        F.max(F.when(F.col("output") == "description", F.col("text"))).alias("description"),
        F.flatten(
            F.transform(parts, lambda p: F.coalesce(p["names"], F.array().cast("array<string>")))
        ).alias("all_names"),
        F.bool_or(F.when(is_clients & (F.col("part") == 0), F.col("found"))).alias("found"),
        F.bool_or("distinct_names").alias("distinct_names"),
        F.max("empty_value").alias("empty_value"),
        # The text and its fields come from one row: one with fields, if there is one.
        F.max(
            F.when(
                F.col("news").isNotNull() | F.col("news_fields").isNotNull(),
                F.struct(F.col("news_fields").isNotNull(), "news_fields", "news"),
            )
        ).alias("item"),
    )
    names = F.when(F.col("distinct_names"), F.array_distinct("all_names")).otherwise(
        F.col("all_names")
    )
    return together.withColumn("client_names", F.when(F.col("found"), names)).select(
        *COMPANY,
        "description",
        F.when(F.col("found"), joined(F.col("client_names"), F.col("empty_value"))).alias("clients"),
        "client_names",
        "item.news",
        "item.news_fields",
    )


def stamped(profiles: DataFrame, run_date: datetime.date | None = None) -> DataFrame:
    """Add the run date and the source name, by which the result is partitioned."""
    day = F.current_date() if run_date is None else F.lit(run_date)
    return profiles.withColumn("updt_date", day).withColumn("filename", F.col("company"))


def company_profiles(
    pages: DataFrame,
    rules: DataFrame,
    company_ids: Iterable[str] | DataFrame | None = None,
    run_date: datetime.date | None = None,
    crawl_index: DataFrame | None = None,
    results_store: str | None = None,
) -> DataFrame:
    """Profiles of all companies in ``rules``, or of those with the given ids.

    ``pages``: ``page_id, url, html`` and, if known, ``status``. The URL is the address as
    requested, without fragment; a root may lack its slash. A page is known by ``page_id`` and
    ``url`` together, and a null status counts as 200. Steps 1 and 2 run when this is called.
    ``crawl_index`` (``sources.crawl_index``, written from the same pages) spares the shuffle of the
    crawl's URLs when pages are chosen. ``results_store`` (a shared folder) makes runs incremental:
    a page whose HTML is unchanged since a run that stored there is not parsed again.
    """
    rules = written(prepared(of_companies(rules, company_ids)), "rules")
    chosen = written(choose_pages(rules, pages, crawl_index), "chosen")
    outputs = written(read_outputs(chosen, rules, pages, results_store), "outputs")
    articles = written(wanted_articles(chosen, outputs, pages, crawl_index), "articles")
    news = news_items(articles, rules, pages, results_store)
    return stamped(assemble(rules, outputs, news), run_date)
