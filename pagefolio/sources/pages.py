"""The crawled pages table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefolio.functions.links import requested
from pagefolio.operators.prune import only_needed
from pagefolio.sources.scratch import fits_broadcast, size_checked


def read_pages_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``page_id, url, html, status`` from storage; see ``with_status``."""
    return with_status(spread(spark.read.format(fmt).load(path), "page_id"))


def with_status(pages: DataFrame) -> DataFrame:
    """Pages with a status: a page that was crawled without noting one counts as 200."""
    if "status" not in pages.columns:
        return pages.withColumn("status", F.lit(200))
    return pages.withColumn("status", F.coalesce("status", F.lit(200)))


# A scan of more partitions than this is never dealt out anew.
SPREAD_PARTITIONS = 64


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small scan with fewer partitions than cores one partition per core.

    Reading HTML is CPU-bound. A small table often sits in a single row group, which would keep
    all but one core idle. A large table passes unchanged: for smaller tasks lower
    ``spark.sql.files.maxPartitionBytes``, which moves nothing. Call it on a plain scan, before
    anything else.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, SPREAD_PARTITIONS):
        return df
    return df.repartition(cores, *keys)


def evened(df: DataFrame, *keys: str) -> DataFrame:
    """Deal out a scan anew in which one partition holds more than a quarter of a core's share of the rows.

    A file is cut by bytes but read by row groups, so a few large groups leave most partitions empty,
    and few large tasks end with idle cores. Rows are counted without reading a column, from the
    metadata of the files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    counts = df.select(F.spark_partition_id().alias("part")).groupBy("part").count()
    rows = counts.agg(F.sum("count").alias("all"), F.max("count").alias("most")).first()
    if not rows.all or 4 * cores * rows.most <= rows.all:
        return df
    return df.repartition(4 * cores, *keys)


# Up to this many keys are given to the scan as a filter, so that it can skip row groups.
PUSHED_KEYS = 1000
ROOT = re.compile(r"(https?://[^/?]+)/((?:\?.*)?)", re.DOTALL)


def few_keys(df: DataFrame, key: str) -> list | None:
    """The distinct values of ``key`` if they are at most ``PUSHED_KEYS``, else None."""
    keys = [row[0] for row in df.select(key).distinct().limit(PUSHED_KEYS + 1).collect()]
    return keys if len(keys) <= PUSHED_KEYS else None


def spellings(urls: list[str]) -> list[str]:
    """Requested addresses, and those of roots also without their slash."""
    roots = (ROOT.fullmatch(url) for url in urls if url)
    return [*urls, *(m[1] + m[2] for m in roots if m)]


def latest_crawl(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """``url, page_id, page_url, status`` of the newest row (largest ``page_id``) of each wanted URL.

    ``url`` is the requested address and ``page_url`` its spelling in the table, where a root may
    lack its slash. Reads no HTML. ``urls`` has one column ``url`` and may repeat values. The crawl
    is folded to one row per URL before it meets the wanted ones, so a URL that was crawled very often
    is reduced before the shuffle.
    """
    narrow = with_status(pages).select(F.col("url").alias("page_url"), "page_id", "status")
    keys = few_keys(urls, "url")
    if keys is not None:
        narrow = narrow.filter(F.col("page_url").isin(spellings(keys)))
    newest = (
        narrow.withColumn("url", requested(F.col("page_url")))
        .groupBy("url")
        .agg(F.max(F.struct("page_id", "page_url", "status")).alias("newest"))
        .select("url", "newest.*")
    )
    if keys is not None:
        return newest.filter(F.col("url").isin(keys))
    return newest.join(size_checked(urls.distinct()), "url", "left_semi")


def fetch(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """HTML of the wanted pages, with the columns of ``wanted`` (``page_id, page_url`` and others).

    Where ``wanted`` is too large to be broadcast, its page ids go ahead as a filter of fixed size,
    so that HTML of other pages is not shuffled.
    """
    found = pages.select("page_id", F.col("url").alias("page_url"), "html")
    keys = few_keys(wanted, "page_id")
    if keys is not None:
        found = found.filter(F.col("page_id").isin(keys))
    small = fits_broadcast(wanted)
    if not small:
        found = only_needed(found, F.col("page_id"), wanted, F.col("page_id"))
    return found.join(F.broadcast(wanted) if small else wanted.hint("merge"), ["page_id", "page_url"])
