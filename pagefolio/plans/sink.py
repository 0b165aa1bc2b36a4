"""Writing and reading back profiles."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from pagefolio.functions.news import NEWS_FIELDS_DDL
from pagefolio.sources.scratch import written

# What tells one row from another; a row written again replaces the old one.
KEY = ["updt_date", "filename", "company_id"]
# Formats without nested types get the three texts and the key columns only.
FLAT_FORMATS = frozenset(["csv", "excel", "com.crealytics.spark.excel"])

# Texts span lines, hold quotes and end in line breaks, all of which must survive. Null is
# \\N and "" an empty cell. Use the same options to read the files.
CSV_OPTIONS = {
    "header": True,
    "multiLine": True,
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# A table of more companies than this has no folder for each of them, unless asked for, but one for
# about so many of them.
COMPANY_FOLDERS = 1000


class ConcurrentRunError(RuntimeError):
    """Another run committed a version of the table after this run read it."""


MANIFESTS = "_manifests"
DATA = "data"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target, jvm


def latest_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the newest version at ``path``; None for a table without versions."""
    fs, root, jvm = _hadoop(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(root):
        return None
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    versions = sorted(n for n in names if n.startswith("v-") and n.endswith(".json"))
    if not versions:
        return None
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/{versions[-1]}"))
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    """Create the manifest file of a new version; fails if that version exists already."""
    name = f"{path}/{MANIFESTS}/v-{manifest['version']:010d}.json"
    fs, target, _ = _hadoop(spark, name)
    try:
        stream = fs.create(target, False)
    except Exception as error:
        if "exists" in str(error).lower():
            raise ConcurrentRunError(f"version {manifest['version']} of {path} was written by another run") from error
        raise
    try:
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        stream.close()


def _leaf_folders(spark: SparkSession, folder: str, partitions: list[str]) -> list[str]:
    """Partition folders under ``folder``, relative to it. Lists folders only, not their files."""
    fs, root, jvm = _hadoop(spark, folder)
    if not fs.exists(root):
        return []
    prefix = fs.makeQualified(root).toString().rstrip("/") + "/"
    literal = re.sub(r"([\\{}\[\]*?,^])", r"\\\1", prefix)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(literal + "/".join(f"{c}=*" for c in partitions)))
    return sorted(status.getPath().toString().removeprefix(prefix) for status in found)


def write_profiles(
    profiles: DataFrame, path: str, fmt: str = "parquet", buckets: int | None = None, **options
) -> int:
    """Write profiles as a new version of the table at ``path``; returns the version.

    The table is a set of partition folders named by a manifest per version
    (``_manifests/v-NNNNNNNNNN.json``: format, bucket count, partition columns, live folders). A
    run writes its rows into a folder of its own, then commits the next manifest; readers follow
    the newest manifest only, so a run that fails or is stopped leaves the last version whole, and
    two runs that commit the same version cannot both succeed (the second raises
    ``ConcurrentRunError`` and may run again).

    By default every date, source and company id is a partition, so a run for one company
    supersedes only that company's folder. With ``buckets``, the number of folders per date,
    companies are dealt out by a hash of their id, and the rows that stay in the touched folders are
    written again with the new ones. A table that would get more than ``COMPANY_FOLDERS`` company
    folders is dealt out by itself, about that many companies to a folder and date: a folder and a
    file for each would cost the driver more than all the rows. Later default runs keep its bucket
    count. A run with another layout than the table's (default against ``buckets``, or another
    bucket count) moves every live row to the new layout in the same version, so one row per key
    remains whatever the runs' layouts were. A table has one format; another one raises
    ``ValueError``.
    """
    spark = profiles.sparkSession
    current = latest_manifest(spark, path)
    if current and current["format"] != fmt:
        raise ValueError(f"{path} holds {current['format']}, not {fmt}")
    if fmt in FLAT_FORMATS:
        profiles = profiles.select("description", "clients", "news", *KEY)
    if fmt == "csv":
        options = {**CSV_OPTIONS, **options}
    new = written(profiles, "profiles")
    dealt = not buckets
    buckets = buckets or _needed_buckets(spark, path, new, current, options)
    dealt = dealt and bool(buckets)
    partitions = ["updt_date", "bucket"] if buckets else list(KEY)
    new = bucketed(new, buckets) if buckets else new
    version = (current["version"] if current else 0) + 1
    run = f"{DATA}/v-{version:010d}-{uuid.uuid4().hex}"

    live = []
    rows = new
    if current:
        old = _read_version(spark, path, current, new.schema.fieldNames(), options, new.schema)
        same_key = [old[c].eqNullSafe(new[c]) for c in KEY]
        if current["buckets"] == (buckets or 0):
            # Same layout: the rows of touched folders without a new key are written again.
            touched = new.select(*partitions).distinct()
            if buckets:
                stay = old.join(touched, partitions, "left_semi")
                stay = stay.join(new, same_key, "left_anti")
                rows = new.unionByName(written(stay.select(new.columns), "survivors"))
            live = current["folders"]
        else:
            # Another layout: every live row moves; a new key replaces the old row.
            stay = old.drop("bucket").join(new, same_key, "left_anti")
            stay = bucketed(stay, buckets) if buckets else stay
            rows = new.unionByName(written(stay.select(new.columns), "survivors"))
    if buckets:
        # One task per folder, so that a folder is one file; a company's rows lie together in it.
        rows = rows.repartition(*partitions).sortWithinPartitions(*partitions, "filename", "company_id")
    rows.write.format(fmt).options(**options).partitionBy(*partitions).save(f"{path}/{run}")
    written_folders = _leaf_folders(spark, f"{path}/{run}", partitions)
    touched_names = set(written_folders)
    kept = [f for f in live if f.split("/", 2)[2] not in touched_names]
    manifest = {
        "version": version, "format": fmt, "buckets": buckets or 0, "dealt": dealt,
        "partition_columns": partitions,
        "folders": kept + [f"{run}/{f}" for f in written_folders],
    }
    _commit(spark, path, manifest)
    return version


def _needed_buckets(
    spark: SparkSession, path: str, new: DataFrame, current: dict | None, options: dict
) -> int | None:
    """Buckets of a table that is given none; None where every company has its folder."""
    if current and current.get("dealt"):
        return current["buckets"]
    companies = new.select(*KEY).distinct().count()
    if current and current["buckets"]:
        companies += _read_version(spark, path, current, new.schema.fieldNames(), options, new.schema).count()
    elif current:
        companies += len(current["folders"])
    return -(-companies // COMPANY_FOLDERS) if companies > COMPANY_FOLDERS else None


def bucketed(profiles: DataFrame, buckets: int) -> DataFrame:
    return profiles.withColumn("bucket", F.pmod(F.xxhash64("company_id"), F.lit(buckets)).cast("int"))


def _versioned(spark: SparkSession, path: str, manifest: dict, schema: StructType, options: dict) -> DataFrame:
    """The live rows of one version in ``schema``: its folders, read per run folder."""
    by_run: dict[str, list[str]] = {}
    for folder in manifest["folders"]:
        parts = folder.split("/", 2)
        by_run.setdefault(f"{parts[0]}/{parts[1]}", []).append(folder)
    frames = []
    for run, folders in sorted(by_run.items()):
        read = spark.read.format(manifest["format"]).options(**options).option("basePath", f"{path}/{run}")
        frames.append(read.schema(schema).load([f"{path}/{f}" for f in folders]).select(*schema.fieldNames()))
    rows = spark.createDataFrame([], schema)
    for frame in frames:
        rows = rows.unionByName(frame)
    return rows


def _read_version(spark: SparkSession, path: str, manifest: dict, columns: list[str], options: dict, schema: StructType) -> DataFrame:
    if "bucket" not in schema.fieldNames():
        schema = StructType(list(schema.fields)).add("bucket", IntegerType())
    return _versioned(spark, path, manifest, schema, options)


def read_profiles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest version of written profiles, with the partition columns in their own types.

    A folder without manifests is read as plain partitioned files.
    """
    ddl, options = (FLAT_DDL, CSV_OPTIONS) if fmt == "csv" else (PROFILE_DDL, {})
    names = StructType.fromDDL(ddl).names
    manifest = latest_manifest(spark, path)
    if manifest is None:
        rows = spark.read.format(fmt).options(**options).schema(ddl).load(path)
        return rows.select(*names)
    schema = StructType.fromDDL(ddl + (", bucket int" if manifest["buckets"] else ""))
    return _versioned(spark, path, manifest, schema, options).select(*names)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove run folders that the newest version does not name; returns them.

    Call it when no run is writing: a run that has not committed yet owns an unnamed folder.
    """
    manifest = latest_manifest(spark, path)
    if manifest is None:
        return []
    named = {"/".join(f.split("/", 2)[:2]) for f in manifest["folders"]}
    fs, root, _ = _hadoop(spark, f"{path}/{DATA}")
    removed = []
    for status in fs.listStatus(root):
        name = f"{DATA}/{status.getPath().getName()}"
        if name not in named:
            fs.delete(status.getPath(), True)
            removed.append(name)
    return removed


PROFILE_DDL = (
    "company_id string, company string, description string, clients string, "
    f"client_names array<string>, news string, news_fields {NEWS_FIELDS_DDL}, "
    "updt_date date, filename string"
)
FLAT_DDL = (
    "description string, clients string, news string, updt_date date, filename string, company_id string"
)
