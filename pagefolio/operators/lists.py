"""Ordered lists of names, one per group.

These are for lists whose items are rows. Each joined list is one cell, so its length is
bounded by what one cell may hold; repeated values are removed before any list is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_distinct(rows: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """First occurrence of every value per group. Repeats are folded before the shuffle."""
    return rows.groupBy(*keys, value).agg(F.min(position).alias(position))


def ordered_list(rows: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """``names``: the values of a group in order of ``position``."""
    items = F.array_sort(F.collect_list(F.struct(position, value)))
    return rows.groupBy(*keys).agg(F.transform(items, lambda i: i[value]).alias("names"))


def joined(names: Column, empty_value: Column) -> Column:
    """Names as one comma-separated string, or ``empty_value`` where there are none."""
    return F.when(F.size(names) > 0, F.array_join(names, ",")).otherwise(empty_value)
