"""News fields and their text layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefolio.functions.selectors import Constant, pick_node, pick_string, text_of
from pagefolio.functions.text import strip

FIELDS = ("topic", "title", "date", "author", "summary")
NEWS_FIELDS_DDL = f"struct<url:string,{','.join(f'{f}:string' for f in FIELDS)}>"

# The text form of a news item. Each part is left out when its field is null.
LAYOUTS = {
    "N1": [("url", "url: {}\n\n"), ("title", "heading: {}\n\n"), ("date", "date: {}\n\n"),
           ("summary", "summary: {}\n\n")],
    "N2": [("url", "url: {}\n\n"), ("title", "heading: {}\n\n"), ("date", "date: {}\n\n"),
           ("summary", "summary : {}\n\n")],
    "N3": [("url", "url: {}\n\n"), ("topic", "topic: {}\n\n"), ("author", "author: {}\n"),
           ("date", "date: {}\n\n"), ("title", "title: {}\n\n"), ("summary", "summary: {}\n\n")],
    "N4": [("url", "url: {}\n\n"), ("title", "title: {}\n\n"), ("author", "author: {}\n"),
           ("date", "date: {}\n\n"), ("summary", "summary: {}\n\n")],
    "N5": [("url", "url: {}\n\n"), ("title", "title: {}\n"), ("date", "date: {}\n"),
           ("author", "author: {}\n"), ("summary", "summary: {}\n")],
}


def field_from_string(found: Column, p: Column | Constant) -> Column:
    """A found string as a field: label removed, one part of a split, stripped."""
    bare = strip(
        F.when(p["remove"].isNull(), found).otherwise(F.replace(found, p["remove"], F.lit("")))
    )
    parts = F.split(bare, F.concat(F.lit(r"\Q"), p["split_on"], F.lit(r"\E")))
    part = strip(F.get(parts, p["split_part"]))
    return F.when(p["split_on"].isNull(), bare).otherwise(part)


def field_value(text: Column, nodes: Column, strings: Column, p: Column | Constant) -> Column:
    """One field of a page by its pick, or the pick's default."""
    value = F.when(
        p["string_pattern"].isNotNull(), field_from_string(pick_string(strings, p), p)
    ).otherwise(text_of(text, pick_node(nodes, p)))
    return F.coalesce(value, p["default"])


def layout(fields: Column, name: Column) -> Column:
    """The text of a news item in the layout called ``name``."""
    text = F.lit(None).cast("string")
    for key, parts in LAYOUTS.items():
        lines = []
        for field, form in parts:
            before, after = form.split("{}")
            lines.append(
                F.coalesce(F.concat(F.lit(before), fields[field], F.lit(after)), F.lit(""))
            )
        text = F.when(name == key, F.concat(*lines)).otherwise(text)
    return text
