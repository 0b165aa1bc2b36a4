"""Access to the given tables, and rendering of rows as HTML by Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefolio.operators.explode import explode_html
from pagefolio.sources.pages import evened, spread


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """The wanted columns of a table, in at least one partition per core.

    Narrow rows are also dealt out anew if their partitions are uneven: as HTML they take far longer.
    """
    rows = spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)
    dealt = spread(rows, columns[0])
    return evened(rows, *columns) if dealt is rows and "html" not in columns else dealt


def page_docs(
    spark: SparkSession, sf: str, *columns: str, with_strings: bool = False
) -> DataFrame:
    """The documents of all crawled pages."""
    pages = table(spark, sf, "pages", "page_id", *columns, "html")
    return explode_html(pages, with_strings=with_strings)


def rendered(rows: DataFrame, html: Column, *keys: str, with_strings: bool = False) -> DataFrame:
    """Documents of pages that are rendered from table rows, one page per row."""
    return explode_html(rows.select(*keys, html.alias("html")), with_strings=with_strings)


def el(name: str, *content: Column | str, **attrs: Column | str) -> Column:
    """HTML of one element. ``class_`` stands for ``class``; null content shows nothing."""

    def shown(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else F.coalesce(value.cast("string"), F.lit(""))

    pieces = [F.lit(f"<{name}")]
    for key, value in attrs.items():
        pieces += [F.lit(f' {key.rstrip("_")}="'), shown(value), F.lit('"')]
    pieces.append(F.lit(">"))
    if content:
        pieces += [shown(c) for c in content] + [F.lit(f"</{name}>")]
    return F.concat(*pieces)


def page(*content: Column | str) -> Column:
    return el("html", el("body", *content))
