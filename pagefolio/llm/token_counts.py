"""Token counts of texts through a cache keyed by digests of content and tokenizer.

A count is a function of the text and of the tokenizer, so both are reduced to digests: the
SHA-256 of the text's UTF-8 bytes after normalisation (null is the empty text; nothing else is
changed, since any other rewriting could change the count) and the SHA-256 of the tokenizer's file
with the library, its version and the call options. The cache is a Parquet table partitioned by the
tokenizer digest, so a run reads only the counts of its own tokenizer. A run

1. joins the distinct content digests of its rows with the stored counts,
2. takes one text for each digest that is missing (copies fold map-side, before any shuffle),
3. encodes only those, in Arrow batches of a few hundred rows,
4. appends them to the cache and joins the counts back to every row.

A second run over the same texts encodes nothing; a text seen under another tokenizer is encoded
again. Runs that append the same digest at once store equal counts twice, which the read folds.
The cache folder must be shared by the cluster (the warehouse by default); appends are Spark
jobs, so a lost executor repeats its tasks and a failed run stores nothing.

Cases: null or empty text counts 0 tokens and 0 bytes; a very long text is encoded whole, in one
call; repeated rows and equal texts each get the row of their document, encoded once; an empty
table gives no rows and stores nothing; null ``doc_id`` rows are counted like others; other
columns of ``docs`` are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefolio.llm.text import slices

# The call whose results are counted: no begin or end of sentence, the model's own treatment of
# special strings in the text, no truncation.
OPTIONS = "sentencepiece.encode(out_type=int, add_bos=False, add_eos=False)"
LIMIT = 4096


def tokenizer_digest(model_path: str) -> str:
    """The digest of the model file, the library and its version, and the call options."""
    digest = hashlib.sha256()
    with open(model_path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    digest.update(f"|sentencepiece {sentencepiece.__version__}|{OPTIONS}".encode())
    return digest.hexdigest()


def default_cache(spark: SparkSession) -> str:
    """The cache table in the warehouse, which the cluster shares."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/token_count_cache"


def _encoder(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                ids = model.encode(texts, add_bos=False, add_eos=False, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array([len(x) for x in ids], pa.int64())], ["digest", "n_tokens"]
                )

    return run


def _stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    empty = spark.createDataFrame([], "digest string, n_tokens long")
    try:
        table = spark.read.parquet(cache)
    except Exception as error:  # a cache that was never written
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return empty
        raise
    return table.filter(F.col("tokenizer") == version).select("digest", "n_tokens")


def token_counts(docs: DataFrame, model_path: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs (doc_id, text)``.

    ``over_limit`` is ``n_tokens > limit``. New counts are appended to ``cache``.
    """
    spark = docs.sparkSession
    cache = cache or default_cache(spark)
    version = tokenizer_digest(model_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("digest", F.sha2(F.col("text"), 256))

    stored = _stored(spark, cache, version)
    missing = rows.select("digest").distinct().join(stored, "digest", "left_anti")
    # One text per missing digest: copies of a text fold in each partition before the shuffle.
    texts = rows.select("digest", "text").dropDuplicates(["digest"]).join(missing, "digest", "left_semi")
    new = texts.mapInArrow(_encoder(model_path), "digest string, n_tokens long")
    new.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)

    counts = _stored(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counted = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").join(
        counts, "digest", "left"
    )
    return counted.select(
        "doc_id", "n_bytes", F.col("n_tokens").cast("long"), (F.col("n_tokens") > limit).alias("over_limit"),
    )
