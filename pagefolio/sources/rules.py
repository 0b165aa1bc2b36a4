"""The rules table: what to read from which page of which site.

One row per company, output and candidate page:

``output``    ``description``, ``clients``, ``news`` (a listing whose first link leads to the
              article) or ``article`` (the article itself, at a fixed address)
``part``      several pages that together give one output are parts 0, 1, ...; only part 0
              must be there
``priority``  candidate pages of one part, best first
``pick``      the value to read: text of the description, link of the listing; for clients
              its ``match`` and ``container`` name the images
``fields``    the values to read from the article
``gate``      if set, the article's fields are read only where this matches something

A new site is a set of rows, not code.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefolio.functions.news import FIELDS
from pagefolio.functions.selectors import ALT_DDL, PICK_DDL

FIELDS_DDL = f"struct<{','.join(f'{f}:{PICK_DDL}' for f in FIELDS)}>"
RULE_DDL = (
    "struct<company_id:string,company:string,output:string,part:int,priority:int,url:string,"
    f"check_status:boolean,pick:{PICK_DDL},cleaner:string,distinct_names:boolean,"
    f"empty_value:string,base_url:string,no_link_text:string,gate:{ALT_DDL},"
    f"fields:{FIELDS_DDL},layout:string>"
)
# What is evaluated on a page, and on an article.
SPEC_DDL = {
    "page": f"struct<output:string,pick:{PICK_DDL},cleaner:string>",
    "article": f"struct<gate:{ALT_DDL},fields:{FIELDS_DDL}>",
}


def rule(row: dict) -> Column:
    """One rule as a constant column, for rules that are derived from a table of sites."""
    return F.from_json(F.lit(json.dumps(row)), RULE_DDL)


def rules_table(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """Rules written in Python as a table whose size Spark knows."""
    texts = pa.table({"rule": pa.array([json.dumps(r) for r in rows], pa.string())})
    return spark.createDataFrame(texts).select(F.from_json("rule", RULE_DDL).alias("r")).select("r.*")
