"""Queries that render table rows as HTML, read the HTML and report what was found.

The SQL computes the same answers from the table columns, without any HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefolio.checks.tables import el, page, rendered, table
from pagefolio.functions.names import client_name
from pagefolio.functions.news import FIELDS, field_value, layout
from pagefolio.functions.selectors import (
    alt,
    cond,
    first,
    matched,
    pick,
    pick_constant,
    pick_node,
    selector,
    tags,
    text_of,
)
from pagefolio.operators.choose import choose_candidate
from pagefolio.operators.extract import image_names
from pagefolio.operators.lists import joined, ordered_distinct, ordered_list
from pagefolio.sources.sites import BY_BLANK, BY_SPACE, YEAR


def text_found(*alts: dict) -> Column:
    node = first(matched(F.col("nodes"), selector(*alts)))
    return text_of(F.col("text"), node)


def text_picked(**fields) -> Column:
    return text_of(F.col("text"), pick_node(F.col("nodes"), pick_constant(**fields)))


def field(p: dict) -> Column:
    return field_value(F.col("text"), F.col("nodes"), F.col("strings"), pick_constant(**p))


# -- text fields -----------------------------------------------------------------------------
def text_regex_author(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    by_line = F.when(F.col("c_mktsegment") != "BUILDING", el("i", "\n  By ", F.col("c_name"), " "))
    html = page(el("p", "Nearby", el("b", "x")), by_line, el("i", "By  the way"))
    return rendered(rows, html, "c_custkey", with_strings=True).select(
        "c_custkey",
        field(pick(string_pattern=BY_SPACE, remove="By", default="N/A")).alias("author_name"),
        field(pick(string_pattern=BY_BLANK, default="N/A")).alias("author_line"),
        field(pick(string_pattern="Written by", default="N/A")).alias("no_author"),
    )


def published_by_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(
        spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        "o_orderpriority",
    )
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey)
    day = F.concat(F.lit(" on "), F.date_format("o_orderdate", "MMMM d, yyyy"))
    line = F.concat(
        F.lit("Published By: "),
        F.col("c_name"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(day),
        F.when(F.col("o_orderstatus") == "F", " on top").otherwise(""),
    )
    html = page(el("div", "Topics: ", F.col("o_orderpriority"), " "), el("div", line))
    label = {"string_pattern": "Published By:", "remove": "Published By:", "split_on": " on "}
    return rendered(rows, html, "o_orderkey", with_strings=True).select(
        "o_orderkey",
        field(pick(string_pattern="Topics:", remove="Topics:", default="N/A")).alias("topic"),
        field(pick(**label, split_part=0, default="N/A")).alias("author"),
        field(pick(**label, split_part=1, default="N/A")).alias("date"),
    )


def year_text_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    key = F.format_string("Order 1%05d and A1998", "o_orderkey")
    day = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "MMMM d, yyyy"))
    html = page(el("p", key), el("p", " ", day, " "), el("p", "since"))
    return rendered(rows, html, "o_orderkey", with_strings=True).select(
        "o_orderkey", field(pick(string_pattern=YEAR, default="N/A")).alias("date")
    )


def time_tag_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    shown = el("time", " ", el("b", F.date_format("o_orderdate", "d.M.yyyy")), datetime=day)
    html = page(F.when(F.col("o_orderstatus") != "F", shown), el("p", day))
    return rendered(rows, html, "o_orderkey", with_strings=True).select(
        "o_orderkey", field(pick(tags("time"), default="N/A")).alias("date")
    )


# -- selectors -------------------------------------------------------------------------------
def part_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One page per part, with its type and brand as classes."""
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type")
    number = F.regexp_replace("p_brand", "Brand#", "")
    classes = F.concat(F.lit("  "), F.col("p_type"), F.lit("\n brand-"), number)
    html = page(el("div", "plain"), el("div", el("p", F.col("p_name")), class_=classes))
    return rendered(rows, html, "p_partkey")


def class_exact(spark: SparkSession, sf: str) -> DataFrame:
    return part_docs(spark, sf).select(
        "p_partkey",
        text_found(alt("div", class_eq="SMALL brand-4")).alias("small"),
        text_found(alt("div", class_eq="ECONOMY brand-2"), alt("div", class_eq="brand-2 ECONOMY"))
        .alias("economy"),
    )


def class_token(spark: SparkSession, sf: str) -> DataFrame:
    return part_docs(spark, sf).select(
        "p_partkey",
        text_found(alt("div", classes=["brand-1"])).alias("brand_1"),
        text_found(alt("div", classes=["brand-3", "ECONOMY"])).alias("both"),
        text_found(alt("p", within=cond(classes=["SMALL"]))).alias("inner"),
    )


def class_substring(spark: SparkSession, sf: str) -> DataFrame:
    return part_docs(spark, sf).select(
        "p_partkey",
        text_found(alt("div", class_sub=["brand-1"])).alias("brand_1x"),
        text_found(alt("p", within=cond("div", class_sub=["CON", "MALL"]))).alias("either"),
        text_found(alt("section", class_sub=["CON"]), alt(class_sub=["D-1"])).alias("none"),
    )


def attribute_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute present, even if empty, and attribute contains; case matters."""
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_size")
    source = F.concat(F.lit("/"), F.col("p_type"), F.lit("/"), F.col("p_size"))
    html = page(
        el("a", "no address"),
        F.when(F.col("p_size") > 10, el("a", F.col("p_name"), href="")),
        el("a", "second", href=source),
        el("i", F.when(F.col("p_size") > 25, el("img", src=source))),
    )
    image = first(
        matched(
            F.col("nodes"),
            selector(
                alt("img", attr="src", attr_sub="SMALL"),
                alt("img", attr="src", attr_sub="economy"),
                alt("img", attr="src", attr_sub="STAN"),
            ),
        )
    )
    return rendered(rows, html, "p_partkey").select(
        "p_partkey",
        text_found(alt("a", attr="href")).alias("linked"),
        F.try_element_at(image["attrs"], F.lit("src")).alias("source"),
    )


def link_with_text(spark: SparkSession, sf: str) -> DataFrame:
    """First link whose only content is one string, and a preferred link with a fallback."""
    rows = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    key = F.col("o_orderkey")
    html = page(
        el("a", el("img", src="x.png"), href="/picture"),
        el("a", el("b", "two"), " strings", href="/two"),
        el("a", "\n \n", href="/blank"),
        el("div", el("a", el("b", "one"), href=F.concat(F.lit("/one/"), key))),
        F.when(
            F.col("o_orderstatus") == "O",
            el("a", "GO to article now", href=F.concat(F.lit("/go/"), F.col("o_custkey"))),
        ),
    )
    any_text = pick_constant(match=[alt("a", attr="href", string_pattern=r"(?d).+")])
    go_first = pick_constant(
        match=[alt("a", attr="href", string_pattern="(?i)Go to article")],
        fallback=[alt("a", attr="href")],
    )

    def href(p: Column) -> Column:
        return F.try_element_at(pick_node(F.col("nodes"), p)["attrs"], F.lit("href"))

    return rendered(rows, html, "o_orderkey").select(
        "o_orderkey", href(any_text).alias("first_text_link"), href(go_first).alias("go_link")
    )


# -- containers and positions ----------------------------------------------------------------
def box_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One page per order with two boxes; the status says which of them hold paragraphs."""
    rows = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    html = page(
        el("p", "outside"),
        el(
            "div",
            F.when(status == "F", el("i", el("p", "one ", key))),
            F.when(status == "F", el("p", "more ", key)),
            class_="box a",
        ),
        F.when(
            status != "P", el("div", el("p", "two ", F.col("o_custkey")), class_="b box")
        ),
    )
    return rendered(rows, html, "o_orderkey")


BOX = [alt("div", classes=["box"])]


def first_container_only(spark: SparkSession, sf: str) -> DataFrame:
    return box_docs(spark, sf).select(
        "o_orderkey",
        text_picked(match=tags("p"), container=BOX).alias("in_first_box"),
        F.coalesce(text_picked(match=tags("p"), container=BOX), F.lit("")).alias("or_empty"),
    )


def all_containers(spark: SparkSession, sf: str) -> DataFrame:
    within = [alt("p", within=cond("div", ["box"]))]
    return box_docs(spark, sf).select(
        "o_orderkey",
        text_found(*within).alias("in_any_box"),
        text_picked(match=within, fallback=tags("p")).alias("or_first"),
    )


def nth_paragraph(spark: SparkSession, sf: str) -> DataFrame:
    """Third paragraph of a box and eighth of the page; a line has as many as its number."""
    rows = table(
        spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    numbers = F.sequence(F.lit(1), F.col("l_linenumber")).cast("array<string>")

    def paragraphs(key: str) -> Column:
        # As one text with what stands between two numbers: a function per number costs more.
        between = F.concat(F.lit("</p>\n<p>"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("/"))
        shown = el("p", F.col(key), "/", F.call_function("array_join", numbers, between))
        return F.when(numbers.isNotNull(), shown)

    html = page(
        el("div", paragraphs("l_partkey"), class_="dates"),
        el("div", paragraphs("l_suppkey"), class_="dates"),
    )
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    return rendered(rows, html, *keys).select(
        *keys,
        text_picked(match=tags("p"), container=[alt("div", classes=["dates"])], nth=2)
        .alias("third_in_box"),
        text_picked(match=tags("p"), nth=7).alias("eighth_on_page"),
    )


def word_minimum(spark: SparkSession, sf: str) -> DataFrame:
    """First paragraph with more than three words, counted after tags are dropped."""
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_size")
    name, kind = F.col("p_name"), F.col("p_type")
    html = page(
        el("p", " ", name, "  ", kind, " "),
        el("p", F.when(F.col("p_size") > 20, "a  b c\n"), el("b", name), " ", kind),
        el("p", name, " ", kind, " last"),
    )
    return rendered(rows, html, "p_partkey").select(
        "p_partkey", text_picked(match=tags("p"), min_words=3, fallback=tags("p")).alias("words")
    )


# -- names -----------------------------------------------------------------------------------
def logo_names_b(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_size")
    file = F.replace("p_name", F.lit(" "), F.lit("-"))
    size = F.concat(F.lit("-"), F.col("p_size"), F.lit("x343"))
    source = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("/up/2024/"), file, size, F.lit("-1.PNG")))
        .when(F.col("p_type") == "ECONOMY", F.concat(F.lit("_"), file, F.lit("_2021__inc.svg")))
        .when(F.col("p_type") == "STANDARD", F.concat(file, F.lit(".webp?v="), F.col("p_size")))
        .otherwise(F.concat(F.lit("https://x.example/"), F.upper(file), F.lit("-3.jpeg")))
    )
    names = image_names(
        matched(F.col("nodes"), selector(alt("img", attr="src"))), F.lit("B")
    )
    docs = rendered(rows, page(el("img", src=source)), "p_partkey")
    return docs.select("p_partkey", F.array_join(names, "|").alias("name"))


def logo_names_a(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_size")
    name = F.replace("p_name", F.lit(" "), F.lit("%20"))
    source = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("/i/5f3a_"), name, F.lit("_Logo.png")))
        .when(F.col("p_type") == "ECONOMY", F.concat(F.lit("5f_3a_"), name, F.lit("-%zz+orig.svg")))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit("/i/66ab_66ab_"), name, F.lit("(12).x")))
        .otherwise(F.concat(F.lit("https://cdn.example/one"), F.col("p_size"), F.lit(".png")))
    )
    images = matched(F.col("nodes"), selector(alt("img", attr="src")))
    name = client_name(F.try_element_at(first(images)["attrs"], F.lit("src")), F.lit("A"))
    docs = rendered(rows, page(el("img", src=source)), "p_partkey")
    return docs.select("p_partkey", name.alias("name"))


# A client page shows the parts of one block of keys, so that no page grows with the data.
BLOCK = 50


def client_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One page of part images per block of part keys, in key order."""
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_type")
    image = el("img", src=F.concat(F.lit("/p/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".png")))
    shown = F.when(F.col("p_type") != "PROMO", image).otherwise(el("i", F.col("p_name")))
    pages = (
        rows.select(F.floor(F.col("p_partkey") / BLOCK).alias("block"), "p_partkey", shown.alias("image"))
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "image"))).alias("images"))
    )
    html = page(F.array_join(F.transform("images", lambda i: i["image"]), "\n"))
    return rendered(pages, html, "block")


def block_names(docs: DataFrame) -> DataFrame:
    images = matched(F.col("nodes"), selector(alt("img", attr="src", attr_sub="/p/")))
    return docs.select("block", image_names(images, F.lit("B")).alias("names"))


def client_list_distinct(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array_distinct("names")
    return block_names(client_docs(spark, sf)).select(
        "block",
        joined(names, F.lit(None)).alias("clients"),
        F.size(names).alias("n_clients"),
    )


def client_list_all(spark: SparkSession, sf: str) -> DataFrame:
    return block_names(client_docs(spark, sf)).select(
        "block",
        joined(F.col("names"), F.lit("")).alias("clients"),
        joined(F.filter("names", lambda n: n == "none"), F.lit("")).alias("no_clients"),
    )


def brand_first_names(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct names of a brand with their first position, for groups of any size."""
    rows = table(spark, sf, "part", "p_partkey", "p_brand", "p_name")
    image = el("img", src=F.concat(F.lit("/p/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".png")))
    images = matched(F.col("nodes"), selector(*tags("img")))
    names = rendered(rows, page(image), "p_partkey", "p_brand").select(
        "p_brand", "p_partkey", F.explode(image_names(images, F.lit("B"))).alias("name")
    )
    return ordered_distinct(names, ["p_brand"], "name", "p_partkey")


def two_page_union(spark: SparkSession, sf: str) -> DataFrame:
    """Images of two pages per block, first page first, each name once."""
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_size")
    image = el("img", src=F.concat(F.lit("/p/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".png")))
    # Large parts are on the first page, all parts on the second.
    first_page = rows.filter("p_size > 40").withColumn("priority", F.lit(0))
    both = first_page.unionByName(rows.withColumn("priority", F.lit(1)))
    images = matched(F.col("nodes"), selector(*tags("img")))
    names = rendered(both, page(image), "p_partkey", "priority").select(
        F.floor(F.col("p_partkey") / BLOCK).alias("block"),
        F.struct("priority", "p_partkey").alias("pos"),
        F.explode(image_names(images, F.lit("B"))).alias("name"),
    )
    names = ordered_list(ordered_distinct(names, ["block"], "name", "pos"), ["block"], "name", "pos")
    return names.select("block", joined(F.col("names"), F.lit(None)).alias("clients"))


# -- candidate pages -------------------------------------------------------------------------
def url_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as candidate pages of their customer; the status column stands for the response."""
    orders = table(
        spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    status = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("int"))
        .when(F.col("o_orderstatus") == "F", F.when(F.col("o_orderpriority") > "4", 200).otherwise(404))
        .when(F.col("o_orderstatus") == "O", 503)
        .otherwise(204)
    )
    candidates = orders.select(
        "o_custkey",
        F.col("o_orderkey").alias("priority"),
        F.col("o_orderkey").alias("page_id"),
        status.alias("status"),
        (F.col("o_custkey") % 3 > 0).alias("check_status"),
    ).withColumn("page_id", F.when(F.col("status").isNotNull(), F.col("page_id")))
    return choose_candidate(candidates, "o_custkey").select(
        "o_custkey", F.col("priority").alias("candidate"), "status", "page_id"
    )


# -- news layouts ----------------------------------------------------------------------------
LABEL = {"string_pattern": "Published By:", "remove": "Published By:", "split_on": " on "}
LAYOUT_FIELDS = {
    "N1": {
        "title": pick(tags("h2"), tags("article"), default=""),
        "date": pick(tags("time"), tags("article"), default=""),
        "summary": pick(tags("p"), tags("article"), default=""),
    },
    "N2": {
        "title": pick(tags("h2")),
        "date": pick(tags("time")),
        "summary": pick(tags("p"), nth=1),
    },
    "N3": {
        "topic": pick(string_pattern="Topics:", remove="Topics:", default="N/A"),
        "title": pick(tags("h1", "h2"), default="N/A"),
        "date": pick(**LABEL, split_part=1, default="N/A"),
        "author": pick(**LABEL, split_part=0, default="N/A"),
        "summary": pick(tags("p"), default="N/A"),
    },
    "N4": {
        "title": pick(tags("h1", "h2"), default="N/A"),
        "date": pick(tags("time"), default="N/A"),
        "author": pick(string_pattern=BY_SPACE, remove="By", default="N/A"),
        "summary": pick(tags("p"), default="N/A"),
    },
    "N5": {
        "title": pick(tags("h1", "h2"), default="N/A"),
        "date": pick(string_pattern=YEAR, default="N/A"),
        "author": pick(string_pattern=BY_BLANK, default="N/A"),
        "summary": pick(tags("p"), default="N/A"),
    },
}


def news_layout(name: str):
    """Orders as articles, shown in one layout. Status P: no time; status F: no heading."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = table(
            spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
            "o_orderpriority",
        )
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        day = F.date_format("o_orderdate", "MMMM d, yyyy")
        line = F.concat(F.lit("Published By: C"), F.col("o_custkey"), F.lit(" on "), day)
        html = page(
            el("div", "Topics: ", F.col("o_orderpriority")),
            el("div", line),
            el(
                "article",
                F.when(status != "F", el("h2", "Order ", key)),
                F.when(status != "P", el("time", day)),
                el("p", "Status ", el("b", status)),
                el("p", "Second ", key),
            ),
        )
        fields = LAYOUT_FIELDS[name]
        url = F.concat(F.lit("https://o.example/"), key)
        values = [
            (field(fields[f]) if f in fields else F.lit(None).cast("string")).alias(f)
            for f in FIELDS
        ]
        docs = rendered(rows, html, "o_orderkey", with_strings=True).withColumn(
            "fields", F.struct(url.alias("url"), *values)
        )
        return docs.select("o_orderkey", layout(F.col("fields"), F.lit(name)).alias("news"))

    return query


QUERIES = {
    "text_regex_author": text_regex_author,
    "published_by_split": published_by_split,
    "year_text_date": year_text_date,
    "time_tag_date": time_tag_date,
    "class_exact": class_exact,
    "class_token": class_token,
    "class_substring": class_substring,
    "attribute_tests": attribute_tests,
    "link_with_text": link_with_text,
    "first_container_only": first_container_only,
    "all_containers": all_containers,
    "nth_paragraph": nth_paragraph,
    "word_minimum": word_minimum,
    "logo_names_b": logo_names_b,
    "logo_names_a": logo_names_a,
    "client_list_distinct": client_list_distinct,
    "client_list_all": client_list_all,
    "brand_first_names": brand_first_names,
    "two_page_union": two_page_union,
    "url_fallback": url_fallback,
    **{f"news_layout_{n.lower()}": news_layout(n) for n in LAYOUT_FIELDS},
}


# -- SQL ---------------------------------------------------------------------------------------
def capital(text: str) -> str:
    """SQL for words with capitals, from lower-case words with single spaces."""
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


DAY = "strftime(o_orderdate, '%B %-d, %Y')"
CLASSES = "p_type || ' brand-' || replace(p_brand, 'Brand#', '')"
BLOCK_SQL = f"CAST(p_partkey // {BLOCK} AS BIGINT)"
TITLE = "CASE WHEN o_orderstatus <> 'F' THEN 'Order ' || o_orderkey END"
TIME = f"CASE WHEN o_orderstatus <> 'P' THEN {DAY} END"
URL = "'url: https://o.example/' || o_orderkey || chr(10) || chr(10)"
SUMMARY = "'Status' || o_orderstatus"


def news_sql(*lines: str) -> str:
    text = " || ".join([URL, *lines])
    return f"SELECT o_orderkey, {text} AS news FROM orders"


def line(label: str, value: str, ends: int) -> str:
    return f"'{label}' || {value}" + " || chr(10)" * ends


def maybe(label: str, value: str, ends: int) -> str:
    return f"coalesce({line(label, value, ends)}, '')"


ORACLES = {
    "text_regex_author": """
        SELECT c_custkey,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE 'the way' END AS author_name,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN 'By ' || c_name ELSE 'By  the way' END
                 AS author_line,
               'N/A' AS no_author
        FROM customer""",
    "published_by_split": f"""
        SELECT o_orderkey, o_orderpriority AS topic, c_name AS author,
               CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE {DAY} END AS date
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "year_text_date": f"""
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE {DAY} END AS date
        FROM orders""",
    "time_tag_date": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'N/A'
                                ELSE strftime(o_orderdate, '%-d.%-m.%Y') END AS date
        FROM orders""",
    "class_exact": f"""
        SELECT p_partkey, CASE WHEN {CLASSES} = 'SMALL brand-4' THEN p_name END AS small,
               CASE WHEN {CLASSES} = 'ECONOMY brand-2' THEN p_name END AS economy
        FROM part""",
    "class_token": """
        SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN p_name END AS brand_1,
               CASE WHEN p_brand = 'Brand#3' AND p_type = 'ECONOMY' THEN p_name END AS "both",
               CASE WHEN p_type = 'SMALL' THEN p_name END AS "inner"
        FROM part""",
    "class_substring": """
        SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#1%' THEN p_name END AS brand_1x,
               CASE WHEN p_type LIKE '%CON%' OR p_type LIKE '%MALL%' THEN p_name END AS either,
               CAST(NULL AS VARCHAR) AS "none"
        FROM part""",
    "attribute_tests": """
        SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name ELSE 'second' END AS linked,
               CASE WHEN p_size > 25 AND (p_type LIKE '%SMALL%' OR p_type LIKE '%STAN%')
                    THEN '/' || p_type || '/' || p_size END AS source
        FROM part""",
    "link_with_text": """
        SELECT o_orderkey, '/one/' || o_orderkey AS first_text_link,
               CASE WHEN o_orderstatus = 'O' THEN '/go/' || o_custkey ELSE '/picture' END AS go_link
        FROM orders""",
    "first_container_only": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'one' || ' ' || o_orderkey END
                 AS in_first_box,
               CASE WHEN o_orderstatus = 'F' THEN 'one' || ' ' || o_orderkey ELSE '' END AS or_empty
        FROM orders""",
    "all_containers": """
        WITH t AS (
          SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'one ' || o_orderkey
                                                WHEN 'O' THEN 'two ' || o_custkey END AS in_any_box
          FROM orders)
        SELECT o_orderkey, in_any_box, coalesce(in_any_box, 'outside') AS or_first FROM t""",
    "nth_paragraph": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
               CASE WHEN l_linenumber >= 3 THEN l_partkey || '/3' END AS third_in_box,
               CASE WHEN 2 * l_linenumber >= 8 THEN l_suppkey || '/' || (8 - l_linenumber) END
                 AS eighth_on_page
        FROM lineitem""",
    "word_minimum": """
        SELECT p_partkey,
               CASE WHEN p_size > 20 THEN 'a  b c' || p_name || p_type
                    ELSE p_name || ' ' || p_type || ' last' END AS words
        FROM part""",
    "logo_names_b": f"""
        SELECT p_partkey, CASE p_type
                 WHEN 'SMALL' THEN {capital("p_name")}
                 WHEN 'ECONOMY' THEN {capital("p_name")} || ' Inc.Svg'
                 WHEN 'STANDARD' THEN {capital("p_name")} || '.Webp?V=' || p_size
                 ELSE {capital("p_name")} END AS name
        FROM part""",
    "logo_names_a": """
        SELECT p_partkey, CASE p_type
                 WHEN 'SMALL' THEN p_name
                 WHEN 'ECONOMY' THEN split_part(p_name, ' ', 2) || ' %zz+'
                 WHEN 'STANDARD' THEN p_name END AS name
        FROM part""",
    "client_list_distinct": f"""
        WITH images AS (
          SELECT {BLOCK_SQL} AS block, p_name, min(p_partkey) AS pos
          FROM part WHERE p_type <> 'PROMO' GROUP BY 1, 2),
        lists AS (
          SELECT block, string_agg({capital("p_name")}, ',' ORDER BY pos) AS clients, count(*) AS n
          FROM images GROUP BY block)
        SELECT block, clients, CAST(coalesce(n, 0) AS INTEGER) AS n_clients
        FROM (SELECT DISTINCT {BLOCK_SQL} AS block FROM part) LEFT JOIN lists USING (block)""",
    "client_list_all": f"""
        SELECT {BLOCK_SQL} AS block,
               coalesce(string_agg({capital("p_name")}, ',' ORDER BY p_partkey)
                          FILTER (WHERE p_type <> 'PROMO'), '') AS clients,
               '' AS no_clients
        FROM part GROUP BY 1""",
    "brand_first_names": f"""
        SELECT p_brand, {capital("p_name")} AS name, min(p_partkey) AS p_partkey
        FROM part GROUP BY 1, 2""",
    "two_page_union": f"""
        WITH both_pages AS (
          SELECT {BLOCK_SQL} AS block, 0 AS priority, p_partkey, p_name FROM part WHERE p_size > 40
          UNION ALL SELECT {BLOCK_SQL}, 1, p_partkey, p_name FROM part),
        firsts AS (
          SELECT block, p_name, min((priority, p_partkey)) AS pos FROM both_pages GROUP BY 1, 2)
        SELECT block, string_agg({capital("p_name")}, ',' ORDER BY pos) AS clients
        FROM firsts GROUP BY block""",
    "url_fallback": """
        WITH c AS (
          SELECT o_custkey, o_orderkey,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                      WHEN o_orderstatus = 'F' AND o_orderpriority > '4' THEN 200
                      WHEN o_orderstatus = 'F' THEN 404
                      WHEN o_orderstatus = 'O' THEN 503 ELSE 204 END AS status
          FROM orders),
        pick AS (
          SELECT o_custkey, coalesce(min(o_orderkey) FILTER (WHERE status = 200), max(o_orderkey))
                   AS candidate
          FROM c GROUP BY 1)
        SELECT o_custkey, candidate, status,
               CASE WHEN status < 400 OR o_custkey % 3 = 0 THEN
                    CASE WHEN status IS NOT NULL THEN candidate END END AS page_id
        FROM pick JOIN c USING (o_custkey) WHERE c.o_orderkey = pick.candidate""",
    "news_layout_n1": news_sql(
        line("heading: ", f"coalesce({TITLE}, '')", 2),
        line("date: ", f"coalesce({TIME}, '')", 2),
        line("summary: ", SUMMARY, 2),
    ),
    "news_layout_n2": news_sql(
        maybe("heading: ", TITLE, 2),
        maybe("date: ", TIME, 2),
        line("summary : ", "'Second ' || o_orderkey", 2),
    ),
    "news_layout_n3": news_sql(
        line("topic: ", "o_orderpriority", 2),
        line("author: ", "'C' || o_custkey", 1),
        line("date: ", DAY, 2),
        line("title: ", f"coalesce({TITLE}, 'N/A')", 2),
        line("summary: ", SUMMARY, 2),
    ),
    "news_layout_n4": news_sql(
        line("title: ", f"coalesce({TITLE}, 'N/A')", 2),
        line("author: ", "'N/A'", 1),
        line("date: ", f"coalesce({TIME}, 'N/A')", 2),
        line("summary: ", SUMMARY, 2),
    ),
    "news_layout_n5": news_sql(
        line("title: ", f"coalesce({TITLE}, 'N/A')", 1),
        line("date: ", f"'Published By: C' || o_custkey || ' on ' || {DAY}", 1),
        line("author: ", "'N/A'", 1),
        line("summary: ", SUMMARY, 1),
    ),
}
