"""Queries that run whole profile jobs on sites rendered from the tables."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagefolio.checks.roundtrip import capital
from pagefolio.checks.tables import el, page, table
from pagefolio.functions.selectors import pick
from pagefolio.functions.news import NEWS_FIELDS_DDL
from pagefolio.plans.profile import company_profiles, of_companies, stamped
from pagefolio.plans.sink import read_profiles, write_profiles
from pagefolio.sources.rules import rule, rules_table
from pagefolio.sources.scratch import shared_folder, written
from pagefolio.sources.sites import ARTICLE, SITES, TEXT_LINK, site_rows

# -- listings and articles ---------------------------------------------------------------------
LISTING = {
    "company": "listing", "output": "news", "part": 0, "priority": 0, "check_status": True,
    "pick": pick(TEXT_LINK), "no_link_text": "No news found.", "fields": ARTICLE, "layout": "N5",
}


def listing_to_article(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as listings whose first link leads to the page of their customer.

    Urgent orders have no listing page, status O links to a page that was not crawled, status P
    has no link, and the pages of customers with a negative balance answer with an error.
    """
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customers = table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    site = F.concat(F.lit("https://o"), F.col("o_orderkey"), F.lit(".example"))
    rules = (
        orders.select("o_orderkey", site.alias("site"), rule(LISTING).alias("rule"))
        .select("o_orderkey", "site", "rule.*")
        .withColumn("company_id", F.col("o_orderkey").cast("string"))
        .withColumn("base_url", F.col("site"))
        .withColumn("url", F.concat("site", F.lit("/news")))
        .drop("o_orderkey", "site")
    )
    status = F.col("o_orderstatus")
    link = F.when(
        status == "F",
        el("a", "Customer", href=F.concat(F.lit("https://c.example/"), F.col("o_custkey"), F.lit("#top"))),
    ).when(status == "O", el("a", "Order", href="//order"))
    listings = orders.filter("o_orderpriority != '1-URGENT'").select(
        F.col("o_orderkey").alias("page_id"),
        F.concat(site, F.lit("/news")).alias("url"),
        page(el("a", el("img", src="x"), href="/picture"), link).alias("html"),
        F.lit(200).alias("status"),
    )
    articles = customers.select(
        (-1 - F.col("c_custkey")).alias("page_id"),
        F.concat(F.lit("https://c.example/"), F.col("c_custkey")).alias("url"),
        page(
            el("h2", F.col("c_name")),
            F.when(F.col("c_mktsegment") != "BUILDING", el("time", F.col("c_mktsegment"))),
            el("p", "Balance ", F.col("c_acctbal").cast("int")),
        ).alias("html"),
        F.when(F.col("c_acctbal") < 0, 500).otherwise(200).alias("status"),
    )
    profiles = company_profiles(written(listings.unionByName(articles), "crawl"), rules)
    return profiles.select("company_id", "news", "news_fields.title", "news_fields.url")


# -- the known sites, one copy per supplier ----------------------------------------------------
# Parts and orders of a supplier: fixed shares of the key ranges.
PARTS, ORDERS = 20, 150
KEYWORDS = ["logo", "Logo", "client", "partner", "customer", "stripe"]


def supplier_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The rules of all suppliers; each follows one of the known sites at its own address."""
    rows = [
        {**row, "company_id": str(i)}
        for i, site in enumerate(SITES)
        for row in site_rows(site, None)
    ]
    templates = rules_table(spark, rows).withColumnRenamed("company_id", "template")
    suppliers = table(spark, sf, "supplier", "s_suppkey", "s_name")
    keyed = suppliers.withColumn("template", (F.col("s_suppkey") % len(SITES)).cast("string"))
    address = F.concat(F.lit("https://s"), F.col("s_suppkey"), F.lit(".example"))

    def moved(url: str) -> Column:
        path = F.regexp_extract(F.col(url), "^https://[^/]+(.*)$", 1)
        return F.when(F.col(url).isNotNull(), F.concat(address, path))

    return (
        keyed.join(templates, "template")
        .withColumn("company_id", F.col("s_suppkey").cast("string"))
        .withColumn("company", F.col("s_name"))
        .withColumn("url", moved("url"))
        .withColumn("base_url", moved("base_url"))
    )


def supplier_images(spark: SparkSession, sf: str) -> DataFrame:
    """The image elements of each supplier: three plain ones in a box, then one per keyword."""
    parts = table(spark, sf, "part", "p_partkey", "p_name")
    number = (F.col("p_partkey") % PARTS).cast("int")
    file = F.replace("p_name", F.lit(" "), F.lit("-"))
    keyword = F.get(F.array(*map(F.lit, KEYWORDS)), number - 3)
    source = F.when(
        keyword.isNotNull(), F.concat(F.lit("/"), keyword, F.lit("/"), file, F.lit(".png"))
    ).otherwise(F.concat(F.lit("/up/"), file, F.lit("-300x200.png")))
    image = F.struct(number.alias("i"), el("img", src=source).alias("img"))
    lists = parts.groupBy(F.floor(F.col("p_partkey") / PARTS).alias("s_suppkey")).agg(
        F.array_sort(F.collect_list(image)).alias("images")
    )

    def shown(condition) -> Column:
        kept = F.filter("images", condition)
        return F.array_join(F.transform(kept, lambda i: i["img"]), "\n")

    return lists.select(
        "s_suppkey",
        shown(lambda i: i["i"] < 3).alias("boxed"),
        shown(lambda i: i["i"] >= 3).alias("others"),
    )


def supplier_pages(spark: SparkSession, sf: str, rules: DataFrame) -> DataFrame:
    """A crawl of all suppliers' sites, with an older copy of every page.

    Every order is an article page of its supplier; listings and fixed addresses lead to the one
    with the smallest key. Nation 7 was not crawled. Where a rule has several candidate pages, the first one is missing
    for even nations. Articles of orders with status F are missing.
    """
    suppliers = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    orders = table(
        spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        "o_orderpriority",
    )
    of_supplier = orders.withColumn("s_suppkey", F.floor(F.col("o_orderkey") / ORDERS))
    first_orders = of_supplier.groupBy("s_suppkey").agg(
        F.min_by(F.struct(*orders.columns), "o_orderkey").alias("o")
    ).select("s_suppkey", "o.*")
    several = Window.partitionBy("s_suppkey", "output", "part")
    fixed = (
        rules.select("s_suppkey", "url", "output", "part", "priority")
        .withColumn("is_spare", (F.max("priority").over(several) > 0) & (F.col("priority") == 0))
        .groupBy("s_suppkey", "url")
        .agg(
            F.bool_or("is_spare").alias("is_spare"),
            F.bool_or(F.col("output") == "article").alias("is_article"),
            F.lit(False).alias("is_linked"),
        )
    )
    linked = suppliers.select(
        "s_suppkey",
        F.explode(
            F.array(
                *[
                    F.concat(F.lit("https://s"), F.col("s_suppkey"), F.lit(f".example/{name}"))
                    for name in ("n/1", "go")
                ]
            )
        ).alias("url"),
        F.lit(False).alias("is_spare"),
        F.lit(True).alias("is_article"),
        F.lit(True).alias("is_linked"),
    )
    in_site = Window.partitionBy("s_suppkey").orderBy("url")
    rows = (
        fixed.unionByName(linked)
        .withColumn("n", F.row_number().over(in_site))
        .join(suppliers, "s_suppkey")
        .join(supplier_images(spark, sf), "s_suppkey", "left")
        .join(first_orders, "s_suppkey", "left")
    )
    path = F.regexp_extract("url", "^https://[^/]+(.*)$", 1)
    filler = F.when(F.col("s_acctbal") >= 0, F.repeat(F.lit("word "), 31))

    def long(label: str) -> Column:
        return el("p", label, " ", path, " ", filler, "end")

    listing = page(
        el("nav", el("a", el("img", src="/nav.png"), href="/x"), el("a", "News", href="/n/1")),
        el("p", "First ", F.col("s_name")),
        el("section", el("p", "Solar ", F.col("s_name")), class_="s dblue-bg"),
        el("section", el("p", " "), el("p", "Gas ", F.col("s_name")), class_="a-one-col-text-block-b"),
        el("div", el("p", "Fibre ", F.col("s_name")), class_="elementor-widget-container text-block"),
        el("div", long("Why"), class_="why-chargepoint"),
        el("div", long("Company"), class_="company mission"),
        el("div", long("Content"), class_="content"),
        el(
            "section",
            el(
                "div",
                F.col("boxed"),
                class_="logo-carousel partner clients partners trusted-by success-stories",
            ),
            F.col("others"),
            class_="s less-padding",
        ),
        el("a", "go to article", href="/go"),
    )
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    order, customer = F.col("o_orderkey"), F.concat(F.lit("C"), F.col("o_custkey"))
    article = page(
        el("section", el("h1", "Order ", order), class_="half-bottom"),
        el("article", el("h2", "Teaser ", order), el("time", day), el("p", "Sum ", F.col("o_orderstatus"))),
        el("div", el("p", "a"), el("p", "b"), el("p", "on ", day), class_="div-block-25"),
        *[el("p", str(i)) for i in (5, 6, 7)],
        el("p", "Eighth ", order),
        el("i", "Topics: ", F.col("o_orderpriority")),
        el("i", "Published By: ", customer, " on ", day),
        el("i", "By  the ", customer),
    )
    status = (
        F.when(F.col("is_spare") & (F.col("s_nationkey") % 2 == 0), 404)
        .when(F.col("is_linked") & (F.col("o_orderstatus") == "F"), 503)
        .otherwise(200)
    )
    current = rows.filter("s_nationkey != 7").select(
        ((F.col("s_suppkey") * 100 + F.col("n")) * 2 + 1).alias("page_id"),
        "url",
        F.when(F.col("is_article"), article).otherwise(listing).alias("html"),
        status.alias("status"),
    )
    older = current.select(
        (F.col("page_id") - 1).alias("page_id"), "url", F.lit("<p>old</p>").alias("html"),
        F.lit(200).alias("status"),
    )
    others = of_supplier.select(
        (-1 - F.col("o_orderkey")).alias("page_id"),
        F.concat(F.lit("https://s"), "s_suppkey", F.lit(".example/order/"), "o_orderkey").alias("url"),
        article.alias("html"),
        F.lit(200).alias("status"),
    )
    return current.unionByName(older).unionByName(others)


def supplier_profiles(spark: SparkSession, sf: str) -> DataFrame:
    rules = supplier_rules(spark, sf)
    pages = written(supplier_pages(spark, sf, rules), "crawl")
    rule_columns = rules.drop("s_suppkey", "s_name", "template")
    return company_profiles(pages, rule_columns, run_date=datetime.date(2025, 9, 1))


def company_profile(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_profiles(spark, sf).select(
        "company_id",
        "company",
        "description",
        "clients",
        F.size("client_names").alias("n_names"),
        "news",
        "news_fields.summary",
    )


def profile_write_read(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles written by date and company and read back."""
    path = f"{shared_folder(spark)}/profiles-{uuid.uuid4().hex}"
    write_profiles(supplier_profiles(spark, sf), path)
    return read_profiles(spark, path).select(
        "company_id", "description", "clients", "news", "updt_date", "filename"
    )


def profile_csv_read(spark: SparkSession, sf: str) -> DataFrame:
    """The three texts written as CSV by date and company and read back."""
    path = f"{shared_folder(spark)}/profiles-csv-{uuid.uuid4().hex}"
    write_profiles(supplier_profiles(spark, sf), path, "csv")
    return read_profiles(spark, path, "csv").drop("company_id")


def profile_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of one source per nation and day, written in two runs, some ids in both.

    The first run writes the even ids with another text, the second the odd ones and every fourth
    one again. ``company`` is the nation, so that very many ids share a source.
    """
    suppliers = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey").select(
        F.col("s_suppkey").cast("string").alias("company_id"),
        F.concat(F.lit("nation "), F.col("s_nationkey")).alias("company"),
        F.col("s_name").alias("description"),
        (F.col("s_suppkey") % 4).alias("part"),
    )
    profiles = stamped(suppliers, datetime.date(2025, 9, 1))
    for name in ("clients", "news"):
        profiles = profiles.withColumn(name, F.lit(None).cast("string"))
    profiles = profiles.withColumn("client_names", F.lit(None).cast("array<string>"))
    profiles = profiles.withColumn("news_fields", F.lit(None).cast(NEWS_FIELDS_DDL))
    first = profiles.filter("part % 2 = 0").withColumn("description", F.concat(F.lit("old "), "description"))
    path = f"{shared_folder(spark)}/profiles-rerun-{uuid.uuid4().hex}"
    write_profiles(first.drop("part"), path, buckets=4)
    write_profiles(profiles.filter("part % 2 = 1 or part = 0").drop("part"), path, buckets=4)
    return read_profiles(spark, path).select("company_id", "filename", "description", "updt_date")


def site_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of the suppliers whose key is among the customers' nations; other ids do nothing."""
    ids = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_nationkey").cast("string").alias("company_id")
    )
    rules = of_companies(supplier_rules(spark, sf), ids)
    return rules.groupBy("company_id", "company").agg(F.count("*").alias("n_rules"))


def dispatch_by_list(spark: SparkSession, sf: str) -> DataFrame:
    """Rules by the ids of the known sites, one site per supplier, for a list of ids.

    Sites have several ids, one, or none (null). The list names two of one site, one of another and
    one that nobody has.
    """
    ids = [(str(i), company_id) for i, site in enumerate(SITES) for company_id in site["ids"]]
    known = spark.createDataFrame(ids, "template string, company_id string")
    rules = supplier_rules(spark, sf).drop("company_id").join(F.broadcast(known), "template")
    found = of_companies(rules, ["18533", "6134", "400", "nobody"])
    return found.groupBy("company_id", "s_suppkey").agg(F.count("*").alias("n_rules"))


QUERIES = {
    "listing_to_article": listing_to_article,
    "site_dispatch": site_dispatch,
    "dispatch_by_list": dispatch_by_list,
    "company_profile": company_profile,
    "profile_write_read": profile_write_read,
    "profile_csv_read": profile_csv_read,
    "profile_rerun": profile_rerun,
}

# -- SQL ---------------------------------------------------------------------------------------
NL = "chr(10)"

# Per site: which paragraph is the description, which images are clients, the cleaner, the value
# for no clients, the news layout, the number of rules.
SITE_FACTS = """
    (VALUES
      (0, 'SolarKal', 'solar', 'all', 'N2', 3), (1, 'H2scan', 'gas', 'box', 'N3', 3),
      (2, 'EOCharging', 'content', 'lcp', 'N5', 3), (3, 'Prewave', 'content', 'lcpu', 'N4', 3),
      (4, 'ChargePoint', 'why', 'lcp', 'N5', 3), (5, 'EasyMil', 'content', 'box lcp', 'N5', 3),
      (6, 'EverstreamAnalytics', 'content', 'box lLc', 'N5', 4),
      (7, 'AltusPower', 'content', 'box lL', 'N5', 4),
      (8, 'CharmIndustrial', 'company', 'lLs', 'N5', 5),
      (9, 'AllSpace', 'content', 'box lcp', 'N5', 5), (10, 'CabanEnergy', 'content', 'box lLc', 'N5', 7),
      (11, 'BioBTX', 'content', 'box lLc', 'N5', 5), (12, 'InfinitedFiber', 'fibre', 'all', 'N1', 3),
      (13, 'Iogen', 'fibre', 'all', 'N1', 3), (14, 'Hydrogenious', 'fibre', 'all', 'N1', 3)
    ) AS f(template, site, paragraph, images, layout, n_rules)"""

ABOUT_PATH = """CASE site WHEN 'EOCharging' THEN '/about-us/' WHEN 'Prewave' THEN '/about-us/'
      WHEN 'ChargePoint' THEN '/about/' WHEN 'EasyMil' THEN '/about-us/'
      WHEN 'EverstreamAnalytics' THEN '/company/about-everstream/' WHEN 'AltusPower' THEN '/about-us'
      WHEN 'CharmIndustrial' THEN CASE WHEN s_nationkey % 2 = 0 THEN '/' ELSE '/company' END
      WHEN 'AllSpace' THEN CASE WHEN s_nationkey % 2 = 0 THEN '/' ELSE '/about-us' END
      WHEN 'CabanEnergy' THEN '/en' WHEN 'BioBTX' THEN '/about-us/' END"""

ARTICLE_PATH = """CASE site
      WHEN 'SolarKal' THEN '/blog/solar-hedge-against-rising-energy-costs'
      WHEN 'H2scan' THEN '/news/can-you-afford-not-to-transformer-downtime'
      WHEN 'AltusPower' THEN '/go' WHEN 'InfinitedFiber' THEN '/news/' WHEN 'Iogen' THEN '/news/'
      WHEN 'Hydrogenious' THEN '/news/' ELSE '/n/1' END"""

SUPPLIER_PROFILES = f"""
  WITH suppliers AS (
    SELECT s.*, f.*, 's' || s_suppkey AS key, o.*,
           strftime(o_orderdate, '%B %-d, %Y') AS day,
           site IN ('SolarKal', 'H2scan', 'InfinitedFiber', 'Iogen', 'Hydrogenious') AS is_direct
    FROM supplier s JOIN {SITE_FACTS} ON s_suppkey % 15 = template
    LEFT JOIN (SELECT *, o_orderkey // {ORDERS} AS supplier FROM orders
               QUALIFY row_number() OVER (PARTITION BY supplier ORDER BY o_orderkey) = 1) o
      ON supplier = s_suppkey),
  images AS (
    SELECT s_suppkey, images = 'all' AS is_a, p_partkey, i,
           CASE WHEN images = 'all'
                THEN split_part(p_name, ' ', 2) || CASE WHEN i BETWEEN 3 AND 8 THEN '' ELSE ' 300x200' END
                ELSE {capital("p_name")} END AS name
    FROM (SELECT *, p_partkey % {PARTS} AS i FROM part) JOIN suppliers ON p_partkey // {PARTS} = s_suppkey
    WHERE images = 'all'
       OR i < 3 AND images LIKE '%box%' OR i = 3 AND images LIKE '%l%'
       OR i = 4 AND images LIKE '%L%' OR i = 5 AND images LIKE '%c%'
       OR i = 6 AND images LIKE '%p%' OR i = 7 AND images LIKE '%u%' OR i = 8 AND images LIKE '%s%'),
  firsts AS (
    SELECT s_suppkey, name, min(p_partkey) AS pos FROM images
    GROUP BY s_suppkey, name, CASE WHEN is_a THEN p_partkey END),
  clients AS (
    SELECT s_suppkey, string_agg(name, ',' ORDER BY pos) AS clients, CAST(count(*) AS INTEGER) AS n_names
    FROM firsts GROUP BY s_suppkey),
  news AS (
    SELECT s_suppkey,
           'url: https://s' || s_suppkey || '.example' || {ARTICLE_PATH} || {NL} || {NL} ||
           CASE WHEN o_orderstatus = 'F' AND NOT is_direct THEN ''
           ELSE CASE layout
             WHEN 'N1' THEN 'heading: Teaser ' || o_orderkey || {NL} || {NL} || 'date: ' || day
                         || {NL} || {NL} || 'summary: Sum ' || o_orderstatus || {NL} || {NL}
             WHEN 'N2' THEN 'heading: Order ' || o_orderkey || {NL} || {NL} || 'date: on ' || day
                         || {NL} || {NL} || 'summary : Eighth ' || o_orderkey || {NL} || {NL}
             WHEN 'N3' THEN 'topic: ' || o_orderpriority || {NL} || {NL} || 'author: C' || o_custkey
                         || {NL} || 'date: ' || day || {NL} || {NL} || 'title: Order ' || o_orderkey
                         || {NL} || {NL} || 'summary: Sum ' || o_orderstatus || {NL} || {NL}
             WHEN 'N4' THEN 'title: Order ' || o_orderkey || {NL} || {NL} || 'author: the C' || o_custkey
                         || {NL} || 'date: ' || day || {NL} || {NL} || 'summary: Sum ' || o_orderstatus
                         || {NL} || {NL}
             ELSE 'title: Order ' || o_orderkey || {NL} || 'date: '
                         || CASE WHEN site = 'EOCharging' AND o_orderkey BETWEEN 1000 AND 9999
                                 THEN 'Order ' || o_orderkey ELSE day END
                         || {NL} || 'author: ' || CASE WHEN site = 'EOCharging' THEN 'the C' ELSE 'By  the C' END
                         || o_custkey || {NL} || 'summary: Sum ' || o_orderstatus || {NL} END END AS news,
           CASE WHEN o_orderstatus = 'F' AND NOT is_direct THEN NULL
                WHEN layout = 'N2' THEN 'Eighth ' || o_orderkey
                ELSE 'Sum ' || o_orderstatus END AS summary
    FROM suppliers),
  profiles AS (
    SELECT CAST(s.s_suppkey AS VARCHAR) AS company_id, s_name AS company,
           CASE WHEN paragraph = 'solar' THEN 'Solar ' || s_name
                WHEN paragraph = 'gas' THEN 'Gas ' || s_name
                WHEN paragraph = 'fibre' THEN 'Fibre ' || s_name
                WHEN s_acctbal < 0 THEN 'First ' || s_name
                ELSE upper(paragraph[1]) || paragraph[2:] || ' ' || {ABOUT_PATH} || ' '
                     || repeat('word ', 31) || 'end' END AS description,
           clients, n_names, news, summary, s_nationkey = 7 AS is_missing
    FROM suppliers s LEFT JOIN clients USING (s_suppkey) LEFT JOIN news USING (s_suppkey))"""


def unless_missing(*columns: str) -> str:
    return ", ".join(f"CASE WHEN NOT is_missing THEN {c} END AS {c}" for c in columns)


ORACLES = {
    "listing_to_article": f"""
        WITH n AS (
          SELECT *, CASE o_orderstatus WHEN 'F' THEN 'https://c.example/' || o_custkey || '#top'
                      WHEN 'O' THEN 'https://o' || o_orderkey || '.example/order' END AS url
          FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderstatus = 'F' AND c_acctbal >= 0)
        SELECT CAST(o_orderkey AS VARCHAR) AS company_id,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN c_name END AS title,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN url END AS url,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                    WHEN url IS NULL THEN 'No news found.'
                    ELSE 'url: ' || url || {NL} || {NL} || CASE WHEN c_name IS NULL THEN '' ELSE
                         'title: ' || c_name || {NL} || 'date: '
                         || CASE WHEN c_mktsegment = 'BUILDING' THEN 'N/A' ELSE c_mktsegment END || {NL}
                         || 'author: N/A' || {NL} || 'summary: Balance ' || CAST(trunc(c_acctbal) AS INTEGER)
                         || {NL} END END AS news
        FROM n""",
    "site_dispatch": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS company_id, s_name AS company,
               CAST(n_rules AS BIGINT) AS n_rules
        FROM supplier JOIN {SITE_FACTS} ON s_suppkey % 15 = template
        WHERE s_suppkey IN (SELECT c_nationkey FROM customer)""",
    "dispatch_by_list": f"""
        SELECT company_id, s_suppkey, CAST(n_rules AS BIGINT) AS n_rules
        FROM supplier JOIN {SITE_FACTS} ON s_suppkey % 15 = template
        JOIN (VALUES (4, '18533'), (4, '6134'), (10, '400')) AS i(site_number, company_id)
          ON site_number = template""",
    "company_profile": f"""{SUPPLIER_PROFILES}
        SELECT company_id, company, {unless_missing("description", "clients", "n_names", "news", "summary")}
        FROM profiles""",
    "profile_write_read": f"""{SUPPLIER_PROFILES}
        SELECT company_id, {unless_missing("description", "clients", "news")},
               DATE '2025-09-01' AS updt_date, company AS filename
        FROM profiles""",
    "profile_csv_read": f"""{SUPPLIER_PROFILES}
        SELECT {unless_missing("description", "clients", "news")},
               DATE '2025-09-01' AS updt_date, company AS filename
        FROM profiles""",
    "profile_rerun": """
        SELECT CAST(s_suppkey AS VARCHAR) AS company_id, 'nation ' || s_nationkey AS filename,
               CASE WHEN s_suppkey % 4 = 2 THEN 'old ' ELSE '' END || s_name AS description,
               DATE '2025-09-01' AS updt_date
        FROM supplier""",
}
