"""Ranked lexical search: the best documents of each query item, by presence-mask grouping.

Every document that shares a term with an item has a *mask*: the set of the item's terms it holds,
a bitmap of 64-bit words. Documents with the same mask share an upper bound of their score (each
term at its largest weighted part over all documents) and a lower bound (each at its smallest).
The ``limit``-th largest lower bound over an item's documents is a score that the final list
surely reaches, so only masks whose upper bound reaches it can hold a result: masks are taken in
descending order of their maximum until the next one cannot change the list. The exact score is
summed in the same aggregate that forms the mask; only documents of the masks taken enter the
ranking, and the best ``limit`` per item are kept.

All of it is Spark expressions: term extraction, document frequencies, masks, bounds and the top
rows of each item. What moves:

* a document's terms are counted in its own row (sorted, then run lengths); only its distinct item
  terms leave the partition, dealt out by document once; the sums per item and document are then
  folded where they lie, and document frequencies are a partial aggregate, so a term in every
  document costs one row per partition;
* only postings of item terms meet the items; the item terms are broadcast if they measure small
  (``scratch.size_checked``), else joined by sort-merge, where adaptive skew splitting takes hot terms;
* the bound of the ``limit``-th document per item and the final top rows are row-number windows with
  a limit, which Spark computes per partition before the shuffle (window group limit), so an item
  that matches every document sends ``limit`` rows per partition.

Cases: a null text has no terms and counts in neither ``N`` nor ``L``; a null ``item_id`` is an
item like the others; repeated document rows are separate documents (both may rank); an empty
table of documents or items gives no rows; equal scores rank by ascending ``doc_id``, null last.
Other columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagefolio.sources.scratch import size_checked, written

# Fixed values of the contract: the term pattern, the A-Z folding, and the integer scoring.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
K1_THOUSANDTHS = 1000  # tf saturation: (1000000000 * tf) div (1000 * tf + 8 * m)
LIMIT = 10


# Every ASCII character outside the term class becomes a space; A-Z become a-z. Splitting at single
# spaces then gives the maximal matches of TERM, and no regular expression runs over the texts.
SEPARATORS = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum())
FOLD_FROM, FOLD_TO = UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS)


def terms(text: F.Column) -> F.Column:
    """The terms of a text, A-Z in lower case; an empty array for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), FOLD_FROM, FOLD_TO)
    return F.array_remove(F.split(spaced, " "), "")


def _part(tf: str, m: str) -> F.Column:
    """The saturated term frequency, a 64-bit integer division."""
    return F.expr(f"(1000000000L * {tf}) div ({K1_THOUSANDTHS}L * {tf} + 8L * {m})")


def ranked(docs: DataFrame, items: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``limit`` best documents per item with a positive score.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``.
    """
    # Items are known by a number of their own, so that a null id joins and groups like any other.
    keyed = written(items.select("item_id", "text", F.monotonically_increasing_id().alias("_item")), "search_item_keys")
    ids = keyed.select("_item", "item_id")
    # Item terms with their repeats and their bit in the item's mask.
    q = keyed.select("_item", F.explode(terms(F.col("text"))).alias("_term"))
    q = q.groupBy("_item", "_term").agg(F.count("*").alias("_q"))
    q = q.withColumn("_bit", F.dense_rank().over(Window.partitionBy("_item").orderBy("_term")) - 1)
    q = written(q, "search_items")
    words = (q.agg(F.max("_bit")).first()[0] or 0) // 64 + 1
    wanted = size_checked(q.select("_term", F.lit(True).alias("_wanted")).distinct())

    # One pass over the texts. A document's terms are sorted and counted in its own row (run
    # lengths of the sorted array), so a document gives a header row (null term, its length) and
    # one row per distinct term. Only those of item terms leave the partition, dealt out by
    # document once; weights and the sums per item and document then happen where they lie.
    d = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                    F.array_sort(terms(F.col("text"))).alias("_sorted"))
    d = d.withColumn("_starts", F.expr(
        "filter(transform(_sorted, (x, i) -> IF(i = 0 OR x != try_element_at(_sorted, i), i, -1)), i -> i >= 0)"))
    counted = F.expr(
        "transform(_starts, (b, j) -> named_struct('_term', try_element_at(_sorted, b + 1), "
        "'_tf', CAST(coalesce(try_element_at(_starts, j + 2), size(_sorted)) - b AS BIGINT)))"
    )
    header = F.array(F.struct(F.lit(None).cast("string").alias("_term"), F.lit(0).cast("long").alias("_tf")))
    tokens = (
        d.select("_row", "_doc", F.size("_sorted").cast("long").alias("_n"), F.explode(F.concat(header, counted)).alias("_p"))
        .filter("_n > 0")
        .select("_row", "_doc", "_n", "_p._term", "_p._tf")
        .join(wanted, "_term", "left")
        .filter(F.col("_term").isNull() | F.col("_wanted"))
        .drop("_wanted")
    )
    postings = written(tokens.repartition("_row"), "search_postings")
    totals = postings.filter("_term is null").agg(F.count("*").alias("_big_n"), F.sum("_n").alias("_big_l"))
    postings = postings.filter("_term is not null")
    df = postings.groupBy("_term").agg(F.count("*").alias("_df"))
    # Weights: floor(1000 * ln((2N + 2) / (2 df + 1))) in doubles; m = 25 + (75 n N) div L.
    weighted = (
        postings.join(size_checked(df), "_term").crossJoin(F.broadcast(totals))
        .withColumn("_w", F.floor(1000 * F.log((2 * F.col("_big_n") + 2).cast("double") / (2 * F.col("_df") + 1))).cast("long"))
        .withColumn("_m", F.expr("25L + (75L * _n * _big_n) div _big_l"))
        .withColumn("_part", _part("_tf", "_m"))
        .withColumn("_weighted", F.col("_w") * F.col("_part"))
        .select("_row", "_doc", "_term", "_weighted")
    )
    bounds = weighted.groupBy("_term").agg(F.max("_weighted").alias("_hi"), F.min("_weighted").alias("_lo"))
    terms_ = written(q.join(bounds, "_term").select(
        "_item", "_term", "_q", "_bit", (F.col("_q") * F.col("_hi")).alias("_hi"), (F.col("_q") * F.col("_lo")).alias("_lo")
    ), "search_terms")

    # The mask: one 64-bit word per 64 item terms; bits of distinct terms add up like an or. A
    # document's bounds, the sums over its terms of q * w * part at their largest and smallest over
    # all documents, are those of its mask; they are summed in the same aggregate as its score.
    mask = [f"_w{j}" for j in range(words)]
    hits = (
        weighted.repartition("_row").join(size_checked(terms_), "_term")
        .groupBy("_item", "_row", "_doc")
        .agg(
            F.sum(F.col("_q") * F.col("_weighted")).alias("_score"),
            F.sum("_hi").alias("_hi"), F.sum("_lo").alias("_lo"),
            *[F.sum(F.when(F.col("_bit").between(64 * j, 64 * j + 63), F.expr("shiftleft(1L, _bit % 64)"))
                    .otherwise(F.lit(0).cast("long"))).alias(w) for j, w in enumerate(mask)],
        )
    )
    # The limit-th largest lower bound per item, which the final list surely reaches: a window with a
    # group limit, so each partition sends at most ``limit`` rows per item.
    by_lo = Window.partitionBy("_item").orderBy(F.desc("_lo"))
    floor_ = written(
        hits.select("_item", "_lo").withColumn("_r", F.row_number().over(by_lo)).filter(F.col("_r") <= limit)
        .groupBy("_item").agg(F.count("*").alias("_k"), F.min("_lo").alias("_lo"))
        .select("_item", F.when(F.col("_k") == limit, F.col("_lo")).otherwise(F.lit(0)).alias("_floor")),
        "search_floors",
    )
    # Masks by descending maximum: those whose maximum reaches the floor are taken, the rest can
    # change nothing. Only their documents are kept, grouped by mask.
    taken = written(
        hits.join(F.broadcast(floor_), "_item", "left")
        .filter((F.col("_hi") > 0) & (F.col("_hi") >= F.coalesce("_floor", F.lit(0))))
        .drop("_floor", "_lo"),
        "search_taken",
    )
    masks = taken.groupBy("_item", *mask).agg(F.max("_hi").alias("_max"))
    by_max = Window.partitionBy("_item").orderBy(F.desc("_max"), *mask)
    live = taken.join(masks.withColumn("_order", F.row_number().over(by_max)), ["_item", *mask])
    best = Window.partitionBy("_item").orderBy(F.desc("_score"), F.asc_nulls_last("_doc"), F.asc("_row"))
    top = (
        live.filter("_score > 0")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= limit)
    )
    return top.join(size_checked(ids), "_item").select(
        "item_id", F.col("rank").cast("int"), F.col("_doc").alias("doc_id"), F.col("_score").alias("score"),
    )
