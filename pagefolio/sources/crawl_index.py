"""An index of the newest crawl of every requested address, written once and joined in place.

The index holds ``url, page_id, page_url, status``: for each requested address (``url``) the
newest row of the crawl (largest ``page_id``), as ``latest_crawl`` chooses it. It is a table
bucketed and sorted by ``url``, so that later runs find their addresses without shuffling the
crawl: the wanted addresses are dealt to the index's buckets and the join reads each bucket where
it lies (no exchange on the index side); a list of up to ``PUSHED_KEYS`` addresses also prunes
buckets. Writing it is one aggregation of the narrow columns of the crawl (no HTML), folded
map-side, so a URL crawled very often costs one row per partition.

The table lives in the catalog of the session, its files in the warehouse (shared by the
cluster). ``register_crawl_index`` makes a written index known to another session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefolio.functions.links import requested
from pagefolio.sources.pages import PUSHED_KEYS, few_keys, with_status

# Buckets of the index: at least the shuffle partitions of the runs that join it.
INDEX_BUCKETS = 200
INDEX_DDL = "url string, page_id long, page_url string, status int"


def write_crawl_index(pages: DataFrame, name: str, buckets: int = INDEX_BUCKETS) -> None:
    """Write (or replace) the index of ``pages`` as the table ``name``."""
    narrow = with_status(pages).select(F.col("url").alias("page_url"), "page_id", "status")
    newest = (
        narrow.withColumn("url", requested(F.col("page_url")))
        .groupBy("url")
        .agg(F.max(F.struct("page_id", "page_url", "status")).alias("newest"))
        .select("url", "newest.page_id", "newest.page_url", F.col("newest.status").cast("int").alias("status"))
    )
    newest.write.mode("overwrite").bucketBy(buckets, "url").sortBy("url").saveAsTable(name)


def register_crawl_index(spark: SparkSession, name: str, location: str, buckets: int = INDEX_BUCKETS) -> None:
    """Make an index written by another session at ``location`` a table of this one."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({INDEX_DDL}) USING parquet "
        f"CLUSTERED BY (url) SORTED BY (url) INTO {buckets} BUCKETS LOCATION '{location}'"
    )


def latest_from_index(index: DataFrame, urls: DataFrame) -> DataFrame:
    """``url, page_id, page_url, status`` of the wanted ``urls`` (one column ``url``, repeats allowed)."""
    keys = few_keys(urls, "url")
    if keys is not None:
        return index.filter(F.col("url").isin(keys))
    return index.join(urls.distinct(), "url", "left_semi")


__all__ = ["INDEX_BUCKETS", "PUSHED_KEYS", "latest_from_index", "register_crawl_index", "write_crawl_index"]
