"""Which crawled page serves a rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_served(status: Column) -> Column:
    """Not a client or server error."""
    return (status < 400) | (status >= 600)


def choose_candidate(candidates: DataFrame, *keys: str) -> DataFrame:
    """One candidate page per ``keys``: the first with status 200, else the last one.

    Expects ``priority``, ``status`` and ``page_id``. The chosen page must be served unless
    its ``check_status`` is false; where it is not, ``page_id`` becomes null and the row
    stays. Only the best row per task and key is shuffled.
    """
    is_ok = F.coalesce(F.col("status") == 200, F.lit(False))
    order = [
        is_ok.desc(),
        F.when(is_ok, F.col("priority")).otherwise(-F.col("priority")),
        F.col("page_id").desc(),
    ]
    best = Window.partitionBy(*keys).orderBy(*order)
    usable = is_served(F.col("status")) | ~F.coalesce(F.col("check_status"), F.lit(True))
    return (
        candidates.withColumn("rank", F.row_number().over(best))
        .filter("rank = 1")
        .withColumn("page_id", F.when(usable, F.col("page_id")))
        .drop("rank")
    )
