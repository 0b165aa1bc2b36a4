"""Pages to documents, and the row-per-element and row-per-string views of documents."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefolio.functions import html as page_reader
from pagefolio.functions import plain as plain_reader
from pagefolio.functions.html import DOC_DDL, STRINGS_DDL, read_pages
from pagefolio.functions.selectors import own_string, text_of

# Ships the page readers with their tasks, so that workers need not have the package installed.
cloudpickle.register_pickle_by_value(page_reader)
cloudpickle.register_pickle_by_value(plain_reader)


def explode_html(
    pages: DataFrame,
    html_col: str = "html",
    attrs: list[str] | None = None,
    with_strings: bool = True,
) -> DataFrame:
    """Replace ``html_col`` by ``text``, ``nodes`` and ``strings``; keep the other columns.

    Neither filters nor column pruning pass through the Python stage, so callers narrow
    ``pages`` to the wanted rows and columns first, and may name the attributes to keep (besides
    the class) and leave out the strings. A null page gives a null document.
    """
    kept = [f for f in pages.schema.fields if f.name != html_col]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [DOC_DDL]
    if with_strings:
        columns.append(STRINGS_DDL)
    return pages.mapInArrow(
        lambda batches: read_pages(batches, html_col, attrs, with_strings), ", ".join(columns)
    )


def elements(docs: DataFrame, *keys: str, with_text: bool = False) -> DataFrame:
    """One row per element: ``keys``, the node columns and, if asked for, the element's text.

    Texts of nested elements repeat each other, so ``with_text`` is best combined with a
    filter on the tags of interest.
    """
    nodes = F.transform(
        "nodes", lambda n: F.struct(n.alias("node"), own_string(F.col("nodes"), n).alias("own_string"))
    )
    rows = docs.select(*keys, *(["text"] if with_text else []), F.inline(nodes))
    columns = [
        F.col("node.id").alias("node_id"),
        F.col("node.last").alias("last_id"),
        F.col("node.parent").alias("parent_id"),
        "node.tag",
        "node.class_attr",
        F.split("node.class_attr", " ").alias("classes"),
        "node.attrs",
        "own_string",
        "node.words",
    ]
    if with_text:
        columns.append(text_of(F.col("text"), F.col("node")).alias("element_text"))
    return rows.select(*keys, *columns)


def text_nodes(docs: DataFrame, *keys: str) -> DataFrame:
    """One row per string, numbered in document order."""
    rows = docs.select(*keys, F.posexplode("strings").alias("pos", "string"))
    return rows.select(
        *keys, "pos", F.col("string.parent").alias("parent_id"), "string.kind", "string.text"
    )
