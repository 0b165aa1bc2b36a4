"""Intermediate tables in the folder shared by the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local sessions may do without the setting."""
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="pagefolio-"))
    return context.getCheckpointDir()


_WRITTEN: list[str] = []


def remove_written(spark: SparkSession) -> None:
    """Remove the intermediate tables of this driver. Call it once results are stored elsewhere."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, and what is read several
    times is computed once.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of at most this many bytes, written as JSON, are broadcast. In memory they take a few
# times as much.
BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the rows of ``df`` measure small.

    File sizes say little about repetitive nested columns, so the rows themselves are
    measured. ``df`` should be cheap to compute, such as a projection of a written table.
    """
    size = df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    return size <= BROADCAST_BYTES


def size_checked(df: DataFrame) -> DataFrame:
    """``df`` as the smaller side of a join: broadcast if its rows measure small, else sorted."""
    return F.broadcast(df) if fits_broadcast(df) else df.hint("merge")
