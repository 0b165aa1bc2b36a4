"""Evaluation of rules on documents: one narrow projection per page and rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefolio.functions.names import client_name
from pagefolio.functions.news import FIELDS, field_value
from pagefolio.functions.selectors import (
    chosen_node,
    in_container,
    matched,
    matched_sets,
    text_of,
)
from pagefolio.functions.text import let
from pagefolio.operators.explode import explode_html
from pagefolio.sources.pages import few_keys, fetch
from pagefolio.sources.scratch import fits_broadcast, size_checked, written


def image_names(images: Column, cleaner: Column) -> Column:
    """Cleaned names of image elements in document order, repeats included."""
    names = F.transform(
        images, lambda n: client_name(F.try_element_at(n["attrs"], F.lit("src")), cleaner)
    )
    return F.filter(names, lambda name: name.isNotNull())


def page_values(spec: Column) -> Column:
    """``text, names, href`` by a spec ``(output, pick, cleaner)``, from a document's columns."""
    nodes, output, p = F.col("nodes"), spec["output"], spec["pick"]

    def values(sets: Column) -> Column:
        # Client lists need all matches of a pick, the other outputs need one.
        node = F.when(output != "clients", chosen_node(nodes, sets, p))
        images = F.when(output == "clients", in_container(sets, p))
        return let(
            node,
            lambda node: F.struct(
                F.when(
                    output == "description", F.coalesce(text_of(F.col("text"), node), p["default"])
                ).alias("text"),
                image_names(images, spec["cleaner"]).alias("names"),
                F.when(output == "news", F.try_element_at(node["attrs"], F.lit("href"))).alias("href"),
            ),
        )

    return let(matched_sets(nodes, p), values)


def article_values(spec: Column) -> Column:
    """``fields`` by a spec ``(gate, fields)``, from a document's columns."""
    text, nodes, strings = F.col("text"), F.col("nodes"), F.col("strings")
    is_open = spec["gate"].isNull() | (F.size(matched(nodes, spec["gate"])) > 0)
    picks = F.array(*[spec["fields"][name] for name in FIELDS])
    values = F.transform(
        picks, lambda p: F.when(p.isNotNull(), field_value(text, nodes, strings, p))
    )
    fields = let(
        values, lambda v: F.struct(*[F.get(v, F.lit(i)).alias(f) for i, f in enumerate(FIELDS)])
    )
    return F.struct(F.when(is_open & F.col("nodes").isNotNull(), fields).alias("fields"))


def page_attrs(spec: Column) -> Column:
    """Names of the attributes that a page spec looks at."""
    p = spec["pick"]
    return F.concat(F.array(F.lit("src"), F.lit("href")), _attrs(p))


def article_attrs(spec: Column) -> Column:
    """Names of the attributes that an article spec looks at."""
    picks = F.array(*[spec["fields"][name] for name in FIELDS])
    return F.concat(_alt_attrs(spec["gate"]), F.flatten(F.transform(picks, _attrs)))


def _attrs(p: Column) -> Column:
    return F.concat(*[_alt_attrs(p[part]) for part in ("match", "container", "fallback")])


def _alt_attrs(alts: Column) -> Column:
    return F.coalesce(F.transform(alts, lambda a: a["attr"]), F.array().cast("array<string>"))


# Specs per row of a page, about. A page with more of them is read in several rows.
SPECS_PER_ROW = 64
PAGE = ["page_id", "page_url"]


def page_digests(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``page_id, page_url, html_sha`` of the wanted pages: the digest of their HTML, copies included.

    Reads the HTML but keeps only 64 characters of it; a change of any copy changes the digest.
    """
    html = fetch(pages, wanted.select(*PAGE).distinct())
    return html.groupBy(*PAGE).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.sha2(F.coalesce("html", F.lit("")), 256))), ","), 256).alias("html_sha")
    )


def _stored(spark, store: str) -> DataFrame | None:
    try:
        return spark.read.parquet(store)
    except Exception as error:  # a store that was never written
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def evaluated(
    wanted: DataFrame, specs: DataFrame, pages: DataFrame, values, attrs, with_strings: bool, store: str | None = None
) -> DataFrame:
    """``wanted`` with the values of its ``spec_key`` on its page.

    A page is read once, however many rows point to it, and a spec is evaluated once per page;
    the rows then only pick up the narrow result. ``specs`` has ``spec_key`` and ``spec``;
    ``attrs`` gives the attributes that a spec looks at.

    Specs meet their pages without a shuffle or sort of documents, and a spec that most pages share is
    no key of theirs. Few and small specs are broadcast in one map, where a document looks up those of its
    page: nested values are slow to shuffle and to pass through Python with every page. Otherwise specs
    meet their pages before any HTML is read and travel along in the row of the page.

    With ``store`` (a folder shared by the cluster) runs are incremental: results are kept by page,
    digest of its HTML and spec key, and a pair found there is not evaluated again, so a run over an
    unchanged crawl explodes no page; a page whose HTML changed is read again. New results are
    appended to the store. ``spec_key`` must name the spec's content (the digest of its JSON).
    """
    specs = written(specs, "specs")
    n_specs = specs.count()
    rows = -(-n_specs // SPECS_PER_ROW) or 1
    in_map = n_specs <= SPECS_PER_ROW and fits_broadcast(specs)
    found = wanted.filter("page_id is not null")
    pairs = found.select(*PAGE, "spec_key").distinct()
    reused = None
    if store:
        keyed = written(pairs.join(page_digests(pages, pairs), PAGE), "keyed")
        kept = _stored(wanted.sparkSession, store)
        if kept is not None:
            keys = [*PAGE, "html_sha", "spec_key"]
            reused = written(kept.join(keyed, keys, "left_semi").dropDuplicates(keys), "reused")
            pairs = keyed.join(reused.select(*keys), keys, "left_anti")
        pairs = pairs.select(*PAGE, "spec_key")
    if in_map:
        groups = (
            pairs.join(F.broadcast(specs.select("spec_key")), "spec_key", "left_semi")
            .groupBy(*PAGE)
            .agg(F.collect_list("spec_key").alias("specs"))
        )
    else:
        groups = (
            pairs.join(size_checked(specs), "spec_key")
            .groupBy(*PAGE, F.pmod(F.xxhash64("spec_key"), F.lit(rows)).alias("group"))
            .agg(F.collect_list(F.struct("spec_key", "spec")).alias("specs"))
            .drop("group")
        )
    names = specs.select(F.explode(attrs(F.col("spec"))).alias("name")).filter("name is not null")
    docs = explode_html(
        fetch(pages, written(groups, "groups")), attrs=few_keys(names, "name"), with_strings=with_strings
    )
    if in_map:
        known = specs.filter("spec_key is not null").agg(
            F.map_from_entries(F.collect_list(F.struct("spec_key", "spec"))).alias("known")
        )
        docs = docs.crossJoin(F.broadcast(known)).withColumn(
            "specs",
            F.transform("specs", lambda k: F.struct(k.alias("spec_key"), F.try_element_at("known", k).alias("spec"))),
        )
    results = docs.select(
        *PAGE,
        F.explode(
            F.transform(
                "specs",
                lambda s: F.struct(s["spec_key"].alias("spec_key"), values(s["spec"]).alias("found")),
            )
        ).alias("result"),
    ).select(*PAGE, "result.*")
    # A page that is stored in copies gives one result, the same for any order of the rows. It is
    # written, so that adaptive execution can split a page that very many rows point to.
    results = results.groupBy(*PAGE, "spec_key").agg(F.max("found").alias("found"))
    results = written(results.select(*PAGE, "spec_key", "found.*"), "results")
    if store:
        results.join(keyed, [*PAGE, "spec_key"]).write.mode("append").parquet(store)
        if reused is not None:
            results = results.unionByName(reused.select(results.columns))
    # Rows without a page stay out of the join, where they would all share one key.
    missing = wanted.filter("page_id is null")
    return found.join(results, [*PAGE, "spec_key"], "left").unionByName(
        missing, allowMissingColumns=True
    )


def evaluated_outputs(wanted: DataFrame, specs: DataFrame, pages: DataFrame, store: str | None = None) -> DataFrame:
    return evaluated(wanted, specs, pages, page_values, page_attrs, with_strings=False, store=store)


def evaluated_articles(wanted: DataFrame, specs: DataFrame, pages: DataFrame, store: str | None = None) -> DataFrame:
    return evaluated(wanted, specs, pages, article_values, article_attrs, with_strings=True, store=store)
