"""URL filters: fixed host rules first, a classifier over segmented host names for the rest.

A host such as ``cheappills.example.com`` hides its words. A unigram model splits each label by
Viterbi search, and multinomial naive Bayes scores the words of host and path together.

Nothing here is labelled by hand. Word counts come from all URLs, and the classifier learns from
the URLs on which a rule decides. Word counts are exact and stay a Spark table, whatever its size:
the substrings of each distinct name are joined with it, so a piece is known only if that very word
was counted. Tokens of digits only are no words. The classifier is a table of hashed counts, twice
``CLASS_BUCKETS`` numbers.

Null URLs and URLs without ``://`` have an empty host and path and no words; the class that is
more common among the rules decides on them, and ``allow`` if there is none.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefolio.llm.text import slices
from pagefolio.sources.scratch import fits_broadcast, written

# Host and path prefix of each rule, and its verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Numbers of a table of hashed counts, for a segmenter of a closed list of words.
WORD_BUCKETS = 1 << 18
CLASS_BUCKETS = 1 << 16
# Letters of a piece that the segmenter considers at a time, and of a known word at least.
MAX_PIECE, MIN_PIECE = 24, 3
# Tasks to which one key of a large join is dealt.
SALTS = 8
# Rows of a batch that Python hands back.
BATCH_ROWS = 20_000
TOKEN = re.compile(r"[^\W_]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, prefix, verdict in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        one = F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, one).otherwise(found)
    return found


def bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % buckets


class Segmenter:
    """Most probable split of a concatenated name under a unigram model.

    A piece that is a known word costs its log probability. An unknown piece costs more per
    letter than any known word, so names made of known words are split into them and other names
    stay whole. Names longer than ``MAX_PIECE`` letters have no piece longer than that.
    ``counts`` holds the words with their counts, ``total`` being the sum over all words of the
    table, or is an array of hashed counts.
    """

    def __init__(self, counts: dict[str, int] | np.ndarray, total: float | None = None):
        self.counts = counts
        self.total = math.log((sum(counts.values() if isinstance(counts, dict) else counts) if total is None else total) + 1.0)
        self.memory: dict[str, list[str]] = {}

    def count(self, piece: str) -> float:
        if isinstance(self.counts, dict):
            return self.counts.get(piece, 0)
        return self.counts[bucket(piece, len(self.counts))]

    def cost(self, piece: str, whole: bool) -> float:
        # The name itself is a word of its own URL, which says nothing about its parts.
        n = 0 if whole or len(piece) < MIN_PIECE else self.count(piece)
        return self.total - math.log(n) if n else self.total + 2.0 * len(piece)

    def split(self, name: str) -> list[str]:
        found = self.memory.get(name)
        if found is None:
            found = self._viterbi(name)
            if len(self.memory) < 100_000:
                self.memory[name] = found
        return found

    def _viterbi(self, name: str) -> list[str]:
        n = len(name)
        best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - MAX_PIECE), end):
                cost = best[start] + self.cost(name[start:end], end - start == n)
                if cost < best[end]:
                    best[end], back[end] = cost, start
        pieces, end = [], n
        while end:
            pieces.append(name[back[end] : end])
            end = back[end]
        return pieces[::-1]


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, BATCH_ROWS)):
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)], schema.names)


def _joined(left: DataFrame, right: DataFrame, key: str, spread: list[str], how: str) -> DataFrame:
    """``left`` with ``right``, a written table with one row per key.

    Unless ``right`` measures small, a frequent key of ``left`` is dealt out by the columns ``spread``.
    """
    if fits_broadcast(right):
        return left.join(F.broadcast(right), key, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    both = left.withColumn("salt", salt).join(right.withColumn("salt", salts).hint("merge"), [key, "salt"], how)
    return both.drop("salt")


def url_tokens(urls: DataFrame) -> DataFrame:
    """``row, at, side, name, counted``: tokens of host (``h``) and path (``p``) in lower case, in order.

    ``counted`` marks the first of equal tokens of a URL, unless it is digits only.
    """
    schema = pa.schema([("row", pa.int64()), ("at", pa.int32()), ("side", pa.string()), ("name", pa.string()), ("counted", pa.bool_())])

    def tokens(part: pa.RecordBatch) -> Iterator[tuple]:
        for row, host, path in zip(*(part.column(c).to_pylist() for c in ("row", "host", "path")), strict=True):
            seen: set[str] = set()
            sides = ((side, m[0].lower()) for side, text in (("h", host), ("p", path)) for m in TOKEN.finditer(text))
            for at, (side, name) in enumerate(sides):
                yield row, at, side, name, name not in seen and not name.isdigit()
                seen.add(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield from _in_batches(tokens(part), schema)

    return urls.select("row", "host", "path").mapInArrow(run, "row long, at int, side string, name string, counted boolean")


def name_pieces(words: DataFrame) -> DataFrame:
    """``name, pieces`` of the names in ``words (name, n)`` that hold other words of that table.

    Names whose best split is the name itself are left out.
    """
    total = words.agg(F.sum("n")).first()[0] or 0

    def substrings(part: pa.RecordBatch) -> Iterator[tuple]:
        for name in part.column(0).to_pylist():
            n = len(name)
            for size in range(MIN_PIECE, min(MAX_PIECE, n - 1) + 1):
                for piece in {name[i : i + size] for i in range(n - size + 1)}:
                    if not piece.isdigit():
                        yield name, piece

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.string()), ("piece", pa.string())])
        for batch in batches:
            for part in slices(batch):
                yield from _in_batches(substrings(part), schema)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, pieces = [], []
            for part in slices(batch):
                for name, known in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found = Segmenter({k["piece"]: k["n"] for k in known}, total).split(name)
                    if len(found) > 1:
                        names.append(name)
                        pieces.append(found)
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(pieces, pa.list_(pa.string()))], ["name", "pieces"])

    known = words.filter(F.length("name").between(MIN_PIECE, MAX_PIECE)).select(F.col("name").alias("piece"), "n")
    held = _joined(words.select("name").mapInArrow(cut, "name string, piece string"), known, "piece", ["name"], "inner")
    lists = held.groupBy("name").agg(F.collect_list(F.struct("piece", "n")).alias("known"))
    return lists.mapInArrow(segment, "name string, pieces array<string>")


def url_words(urls: DataFrame) -> DataFrame:
    """``row, words`` of the rows of ``urls (row, host, path)`` that hold words, marked by where they stand."""
    tokens = written(url_tokens(urls), "tokens")
    words = written(tokens.filter("counted").groupBy("name").agg(F.count("*").alias("n")), "words")
    pieces = written(name_pieces(words), "pieces")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = Segmenter({}, 0)
        for batch in batches:
            marked = []
            for part in slices(batch):
                for side, name, found in zip(*(part.column(c).to_pylist() for c in ("side", "name", "pieces")), strict=True):
                    marked.append([f"{side}:{w}" for w in found or plain.split(name) if side == "h" or not w.isdigit()])
            yield pa.record_batch([*batch.columns[:2], pa.array(marked, pa.list_(pa.string()))], ["row", "at", "marked"])

    both = _joined(tokens.drop("counted"), pieces, "name", ["row", "at"], "left")
    marked = both.select("row", "at", "side", "name", "pieces").mapInArrow(mark, "row long, at int, marked array<string>")
    # In order, so that sums over a row's words are the same in every run.
    lists = marked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "marked"))).alias("found"))
    return lists.select("row", F.flatten(F.col("found.marked")).alias("words"))


def class_counts(urls: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """URLs and hashed word counts per verdict, from the rows on which a rule decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros((2, CLASS_BUCKETS), np.int64)
        rows = np.zeros(2, np.int64)
        for batch in batches:
            for part in slices(batch):
                for verdict, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    side = int(verdict == "block")
                    rows[side] += 1
                    for word in found or ():
                        words[side, bucket(word, CLASS_BUCKETS)] += 1
        for side in (0, 1):
            used = np.flatnonzero(words[side])
            yield pa.record_batch(
                [
                    pa.array(np.full(len(used) + 1, side, np.int32)),
                    pa.array(np.append(used, -1)),
                    pa.array(np.append(words[side][used], rows[side])),
                ],
                ["side", "bucket", "n"],
            )

    decided = urls.filter("verdict is not null").select("verdict", "words")
    parts = decided.mapInArrow(run, "side int, bucket long, n long")
    documents, words = np.zeros(2), np.zeros((2, CLASS_BUCKETS))
    for row in parts.groupBy("side", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        if row["bucket"] < 0:
            documents[row["side"]] = row["n"]
        else:
            words[row["side"], row["bucket"]] = row["n"]
    return documents, words


def log_odds(documents: np.ndarray, words: np.ndarray) -> tuple[float, np.ndarray]:
    """Prior and per-bucket log odds of ``block`` against ``allow``, add-one smoothed."""
    prior = math.log((documents[1] + 1) / (documents[0] + 1))
    share = (words + 1) / (words.sum(axis=1, keepdims=True) + words.shape[1])
    return prior, np.log(share[1] / share[0])


def url_verdicts(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, log_odds`` of every row of ``pages``.

    ``log_odds`` is the classifier's and null where a rule decides.
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = written(
        split.withColumn("found", longest_rule(F.col("host"), F.col("path"))).select(
            "page_id", "host", "path", "found.rule", "found.verdict", F.monotonically_increasing_id().alias("row")
        ),
        "urls",
    )
    worded = written(urls.join(url_words(urls), "row", "left").drop("row"), "worded")
    prior, odds = log_odds(*class_counts(worded))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                verdicts = part.column("verdict").to_pylist()
                scores: list[float | None] = []
                for i, words in enumerate(part.column("words").to_pylist()):
                    if verdicts[i] is not None:
                        scores.append(None)
                        continue
                    scores.append(prior + sum(odds[bucket(w, CLASS_BUCKETS)] for w in words or ()))
                    verdicts[i] = "block" if scores[i] > 0 else "allow"
                yield pa.record_batch(
                    [*part.columns[:4], pa.array(verdicts, pa.string()), pa.array(scores, pa.float64())],
                    [*part.schema.names[:4], "verdict", "log_odds"],
                )

    return worded.select("page_id", "host", "path", "rule", "verdict", "words").mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string, log_odds double"
    )
