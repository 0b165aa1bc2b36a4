"""The partitioned output."""

import datetime

import pytest
from pyspark.sql import functions as F

from pagefolio.plans import sink
from pagefolio.plans.profile import stamped
from pagefolio.plans.sink import (
    PROFILE_DDL,
    ConcurrentRunError,
    _commit,
    latest_manifest,
    read_profiles,
    vacuum,
    write_profiles,
)

DAY, NEXT = datetime.date(2025, 9, 1), datetime.date(2025, 9, 2)
ROWS = [
    ("1", "A", "text\n\"quoted\", more", "x,y", ["x", "y"], "url: u\n\n", None, DAY, "A"),
    ("2", "B", None, "", [], None, ("u", None, "t", "d", "a", "s"), DAY, "B"),
]


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "profiles")
    df = spark.createDataFrame(ROWS, PROFILE_DDL)
    write_profiles(df, path)
    assert sorted(read_profiles(spark, path).collect()) == sorted(df.collect())
    changed = df.filter("company = 'A'").withColumn("description", F.lit("new"))
    write_profiles(changed, path)
    write_profiles(changed.withColumn("updt_date", F.lit(NEXT)), path)
    got = {(r.company, r.updt_date): r.description for r in read_profiles(spark, path).collect()}
    assert got == {("A", DAY): "new", ("A", NEXT): "new", ("B", DAY): None}
    only = read_profiles(spark, path).filter("filename = 'B'")
    assert "filename" in only._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_profiles(spark.createDataFrame(ROWS, PROFILE_DDL), path, "csv")
    read = read_profiles(spark, path, "csv")
    got = {r.filename: (r.description, r.clients, r.news) for r in read.collect()}
    assert {r.updt_date for r in read.collect()} == {DAY}
    assert got == {"A": ("text\n\"quoted\", more", "x,y", "url: u\n\n"), "B": (None, "", None)}


def test_stamp(spark):
    df = spark.createDataFrame([("1", "A")], "company_id string, company string")
    row = stamped(df).first()
    assert row.filename == "A"
    assert row.updt_date == df.select(F.current_date()).first()[0]


def renamed(df, company_id, text):
    return df.filter("company = 'A'").withColumns({"company_id": F.lit(company_id), "description": F.lit(text)})


@pytest.mark.parametrize("buckets", [None, 1, 3])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_leaves_other_companies(spark, tmp_path, buckets, fmt):
    """Two ids of one source and day, an id with leading zeros, and a second run for one of them."""
    path = str(tmp_path / "profiles")
    df = spark.createDataFrame(ROWS, PROFILE_DDL)
    write_profiles(renamed(df, "18533", "one"), path, fmt, buckets)
    write_profiles(renamed(df, "06134", "two"), path, fmt, buckets)
    write_profiles(renamed(df, "18533", "three").unionByName(df.filter("company = 'B'")), path, fmt, buckets)
    got = {r.company_id: (r.filename, r.description) for r in read_profiles(spark, path, fmt).collect()}
    assert got == {"18533": ("A", "three"), "06134": ("A", "two"), "2": ("B", None)}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_runs_with_other_layouts(spark, tmp_path, fmt):
    """Default, then 4 buckets, then 8, then default again: one row per key, the newest text."""
    path = str(tmp_path / "profiles")
    df = spark.createDataFrame(ROWS, PROFILE_DDL)
    ids = [str(i) for i in range(12)]
    for run, buckets in enumerate([None, 4, 8, None, 8]):
        chosen = ids[run::2] if run else ids
        batch = spark.createDataFrame([(i,) for i in chosen], "cid string").crossJoin(df.filter("company = 'A'")).withColumns(
            {"company_id": F.col("cid"), "description": F.lit(f"run {run}")}).drop("cid")
        write_profiles(batch, path, fmt, buckets)
        got = [(r.company_id, r.description) for r in read_profiles(spark, path, fmt).collect()]
        assert len(got) == len({k for k, _ in got}) == len(ids)
    got = dict((r.company_id, r.description) for r in read_profiles(spark, path, fmt).collect())
    newest = {i: f"run {max(r for r in range(5) if i in (ids[r::2] if r else ids))}" for i in ids}
    assert got == newest


def test_failed_run_leaves_last_version(spark, tmp_path):
    path = str(tmp_path / "profiles")
    df = spark.createDataFrame(ROWS, PROFILE_DDL)
    assert write_profiles(df, path, buckets=2) == 1
    before = sorted(read_profiles(spark, path).collect())
    broken = df.withColumn("description", F.when(F.col("company") == "A", F.raise_error("lost")).otherwise("x"))
    with pytest.raises(Exception):
        write_profiles(broken, path, buckets=2)
    # A run stopped after some of its files: its folder is named by no manifest.
    df.withColumn("bucket", F.lit(0)).write.partitionBy("updt_date", "bucket").parquet(f"{path}/data/v-0000000002-stopped")
    assert sorted(read_profiles(spark, path).collect()) == before
    assert vacuum(spark, path) == ["data/v-0000000002-stopped"]
    assert sorted(read_profiles(spark, path).collect()) == before


def test_concurrent_commit(spark, tmp_path):
    """Two runs that read the same version: the second commit fails instead of mixing."""
    path = str(tmp_path / "profiles")
    df = spark.createDataFrame(ROWS, PROFILE_DDL)
    write_profiles(df, path)
    first = latest_manifest(spark, path)
    _commit(spark, path, {**first, "version": 2})
    with pytest.raises(ConcurrentRunError):
        _commit(spark, path, {**first, "version": 2})
    with pytest.raises(ValueError):
        write_profiles(df, path, "csv")


def companies(spark, ids, text):
    one = spark.createDataFrame(ROWS, PROFILE_DDL).filter("company = 'A'")
    rows = spark.createDataFrame([(str(i),) for i in ids], "cid string").crossJoin(one)
    return rows.withColumns(
        {"company_id": F.col("cid"), "filename": F.concat(F.lit("A, "), "cid"), "description": F.lit(text)}
    ).drop("cid")


@pytest.fixture(autouse=True)
def ten_folders(request, monkeypatch):
    if "folders" in request.node.name:
        monkeypatch.setattr(sink, "COMPANY_FOLDERS", 10)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_very_many_companies_share_folders(spark, tmp_path, fmt):
    """More companies than folders are allowed: the run deals them out itself, later runs keep that."""
    path = str(tmp_path / "profiles")
    sink.write_profiles(companies(spark, range(30), "one"), path, fmt)
    manifest = latest_manifest(spark, path)
    assert manifest["partition_columns"] == ["updt_date", "bucket"] and manifest["buckets"] == 3
    assert len(manifest["folders"]) <= 3
    write_profiles(companies(spark, [4, 30], "two"), path, fmt)
    assert latest_manifest(spark, path)["buckets"] == 3
    got = {r.company_id: (r.filename, r.description) for r in read_profiles(spark, path, fmt).collect()}
    assert got == {str(i): (f"A, {i}", "two" if i in (4, 30) else "one") for i in range(31)}


def test_few_companies_keep_their_folders(spark, tmp_path):
    """A folder for each up to the limit, counted over all runs; beyond it the table moves."""
    path = str(tmp_path / "profiles")
    write_profiles(companies(spark, range(6), "one"), path)
    write_profiles(companies(spark, [2], "two"), path)
    manifest = latest_manifest(spark, path)
    assert manifest["partition_columns"] == sink.KEY and len(manifest["folders"]) == 6
    assert manifest["folders"][-1].endswith("/updt_date=2025-09-01/filename=A, 2/company_id=2")
    write_profiles(companies(spark, range(5, 12), "three"), path)
    assert latest_manifest(spark, path)["buckets"] == 2
    got = {r.company_id: r.description for r in read_profiles(spark, path).collect()}
    assert got == {str(i): "three" if i >= 5 else "two" if i == 2 else "one" for i in range(12)}
