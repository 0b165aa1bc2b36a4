"""Scoring of texts by a bigram model in Elias-Fano tries.

The model is interpolated with a Dirichlet prior: the probability of a word after a context is
``(c(context word) + PRIOR * p(word)) / (c(context) + PRIOR)``, with ``p`` the add-one unigram
probability. Its logarithm is a part that needs the word's counts and contexts, and a part that
needs the count of the context alone. So both parts are known where the word's own counts are, and
the model is never gathered in one place:

* Words are dealt out to shards by hash. Each task sends the tokens of its documents to their shards
  once, in packed arrays: word, context, document.
* A shard counts its training tokens, builds a trie of its words and their contexts in a memory-mapped
  file, looks up all its tokens in it, and returns sums per document, packed by groups of documents.
* The sums of a group of documents meet in one place, where they are added up.

Words that make up more than ``1 / HOT_SHARES`` of all tokens are spread over all shards by their
context. There are fewer than ``HOT_SHARES`` of them, and their counts are known from a first pass.
The number of shards follows the number of tokens.

The tokens of a text are its words, A to Z in lower case, and one end. Null and empty texts are the
end alone. Repeated rows count and are scored each. Words are known by 56 bits of their hash and
contexts by 40 within a word; counts of the first pass are of the words themselves.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefolio.llm.elias_fano import CONTEXT_BITS, BigramTrie
from pagefolio.llm.text import lower_ascii, slices, words
from pagefolio.sources.scratch import written

PRIOR = 100.0
HOT_SHARES = 2000
SHARD_TOKENS = 1_000_000
# Characters of text whose tokens are packed together, and words counted before they are sent on.
CHUNK_CHARS = 3_000_000
COUNTED_WORDS = 400_000
END = ""
_WORD_MASK = np.uint64((1 << 56) - 1)
_CONTEXT_MASK = np.uint64((1 << CONTEXT_BITS) - 1)


def word_key(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


END_KEY = word_key(END)
# The context of a first word; no word holds a space.
START_KEY = word_key(" ")


def tokens(text: str | None) -> list[str]:
    return [*words(lower_ascii(text)), END] if text else [END]


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, count`` of all tokens of ``docs (text)``; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "count"]
            )

        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    counts.update(tokens(text))
                if len(counts) > COUNTED_WORDS:
                    yield sent()
                    counts.clear()
        yield sent()

    rows = docs.select("text").mapInArrow(run, "word string, count long")
    return rows.groupBy("word").agg(F.sum("count").alias("count"))


def _packed(word: np.ndarray, context: np.ndarray, doc: np.ndarray, keys: np.ndarray, learned: np.ndarray) -> bytes:
    """Tokens of a chunk that go to one shard, sorted by word; ``doc`` counts within the chunk."""
    begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    used, local = np.unique(doc, return_inverse=True)
    planes = np.ascontiguousarray(context.view(np.uint8).reshape(-1, 8)[:, : CONTEXT_BITS // 8].T)
    parts = [
        np.array([len(word), len(begin), len(used)], "<i8"), word[begin], np.diff(np.append(begin, len(word))).astype("<i4"),
        keys[used], learned[used].astype(np.uint8), local.astype("<i4" if len(used) > 65535 else "<u2"), planes,
    ]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, context, document key and whether the document is learned from, per token."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = 24
    n, n_words, n_docs = np.frombuffer(raw, "<i8", 3)

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    word = np.repeat(take("<u8", n_words), take("<i4", n_words))
    keys, learned = take("<i8", n_docs), take("u1", n_docs).astype(bool)
    local = take("<i4" if n_docs > 65535 else "<u2", n)
    context = np.zeros((n, 8), np.uint8)
    context[:, : CONTEXT_BITS // 8] = take("u1", n * (CONTEXT_BITS // 8)).reshape(-1, n).T
    return word, context.view("<u8").ravel(), keys[local], learned[local]


SENT_DDL = "shard int, blob binary, key long, doc_id long, learned boolean, n_tokens long"
# Either the sums of some documents of a group, or what else is known of one document.
SUMS_DDL = "group long, sums binary, key long, doc_id long, learned boolean, n_tokens long"
TOTALS_DDL = "doc_id long, learned boolean, n_tokens long, n_known long, base double, model double"
GROUP_DOCS = 1024
# Sums of a document: its place in the group, known tokens, base and model. The model's probabilities are
# rounded to a byte anyway, so four bytes do for their sums.
SUMS = {"at": "<i2", "n_known": "<i4", "base": "<f8", "model": "<f4"}
# Documents with sums that a task holds before it sends them on.
HELD_DOCS = 2_000_000


def sent_tokens(docs: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """Packed tokens by shard, and a row for each document, from ``docs (key, doc_id, learned, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        chunk: list[tuple] = []
        chars = 0

        def sent() -> pa.RecordBatch:
            nonlocal memory
            lists = [tokens(text) for *_, text in chunk]
            if len(memory) > 500_000:
                memory = {}
            for word in set().union(*lists).difference(memory):
                memory[word] = word_key(word)
            sizes = np.array([len(x) for x in lists])
            full = np.fromiter((k for x in lists for k in map(memory.__getitem__, x)), np.uint64, int(sizes.sum()))
            before = np.roll(full, 1)
            before[np.append(0, np.cumsum(sizes)[:-1])] = START_KEY
            word = full & _WORD_MASK
            mixed = np.where(np.isin(word, hot), word ^ before * np.uint64(0x9E3779B97F4A7C15), word)
            shard = (mixed % np.uint64(shards)).astype(np.int32)
            doc = np.repeat(np.arange(len(lists)), sizes)
            order = np.lexsort((word, shard))
            word, context, doc, shard = word[order], (before & _CONTEXT_MASK)[order], doc[order], shard[order]
            keys, learned = np.array([c[0] for c in chunk], np.int64), np.array([c[2] for c in chunk], bool)
            cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            blobs = [
                _packed(word[a:b], context[a:b], doc[a:b], keys, learned)
                for a, b in zip(cut, np.append(cut[1:], len(shard)), strict=True)
            ]
            none, m = [None] * len(blobs), len(chunk)
            return pa.record_batch(
                [
                    pa.array([*shard[cut].tolist(), *(keys % shards).tolist()], pa.int32()),
                    pa.array([*blobs, *[None] * m], pa.binary()),
                    pa.array([*none, *keys.tolist()], pa.int64()),
                    pa.array([*none, *(c[1] for c in chunk)], pa.int64()),
                    pa.array([*none, *learned.tolist()], pa.bool_()),
                    pa.array([*none, *sizes.tolist()], pa.int64()),
                ],
                ["shard", "blob", "key", "doc_id", "learned", "n_tokens"],
            )

        for batch in batches:
            for part in slices(batch):
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    chunk.append(row)
                    chars += len(row[3] or "")
                if chars > CHUNK_CHARS or len(chunk) > 50_000:
                    yield sent()
                    chunk, chars = [], 0
        if chunk:
            yield sent()

    return docs.select("key", "doc_id", "learned", "text").mapInArrow(run, SENT_DDL)


def shard_sums(blobs: list[bytes], total: int, distinct: int, hot: dict[int, int]) -> tuple:
    """Document keys, known tokens, base and model sums over the tokens of one shard."""
    word, context, key, learned = (np.concatenate(c) for c in zip(*map(_unpacked, blobs), strict=True))
    order = np.lexsort((context, word))
    word, context, key, learned = word[order], context[order], key[order], learned[order]
    first = np.append(True, (word[1:] != word[:-1]) | (context[1:] != context[:-1]))
    count = np.add.reduceat(learned.astype(np.int64), np.flatnonzero(first))
    pair_word, pair_context = word[first], context[first]
    pair, here = np.cumsum(first) - 1, count > 0

    def word_counts(words: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return np.array([hot.get(int(w), int(s)) for w, s in zip(words, sums, strict=True)], np.int64)

    def value(in_context: np.ndarray, of_word: np.ndarray) -> np.ndarray:
        return np.log10(in_context + PRIOR * (of_word + 1) / (total + distinct + 1))

    trie = BigramTrie.build(pair_word[here], pair_context[here], count[here], word_counts, value)
    known, stored = trie.look_up(pair_word, pair_context)
    # Words that the trie lacks have no training token here; a hot word may have some in other shards.
    missing = np.isnan(stored)
    if missing.any():
        known[missing] = [hot.get(int(w), 0) for w in pair_word[missing]]
        stored[missing] = value(np.zeros(missing.sum()), known[missing])
    # A token is looked at as a word after its context, and as the context of the next unless it is the end.
    after = np.where(pair_word == np.uint64(END_KEY) & _WORD_MASK, 0.0, np.log10(known + PRIOR))
    docs, of = np.unique(key, return_inverse=True)
    known, base, model = known[pair], np.log10(known + 1.0)[pair], (stored - after)[pair]
    n = len(docs)
    return docs, np.bincount(of, known > 0, n), np.bincount(of, base, n), np.bincount(of, model, n)


def packed_sums(parts: list[tuple]) -> pa.RecordBatch:
    """The sums of several shards, added up per document and packed by groups of documents."""
    docs, of = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n_known, base, model = (np.bincount(of, np.concatenate([p[k] for p in parts]), len(docs)) for k in (1, 2, 3))
    columns = {"at": docs % GROUP_DOCS, "n_known": n_known, "base": base, "model": model}
    group = docs // GROUP_DOCS
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    compress = zstandard.ZstdCompressor(level=1).compress
    packed = [
        compress(b"".join(columns[name][a:b].astype(kind).tobytes() for name, kind in SUMS.items()))
        for a, b in zip(cut, np.append(cut[1:], len(docs)), strict=True)
    ]
    m = len(cut)
    return pa.record_batch(
        [
            pa.array(group[cut]), pa.array(packed, pa.binary()), pa.nulls(m, pa.int64()),
            pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()),
        ],
        ["group", "sums", "key", "doc_id", "learned", "n_tokens"],
    )


def unpacked_sums(blob: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = len(raw) // sum(np.dtype(kind).itemsize for kind in SUMS.values()), 0, {}
    for name, kind in SUMS.items():
        out[name] = np.frombuffer(raw, kind, n, at)
        at += out[name].nbytes
    return out


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from the rows of its group, which come one group after another."""
    names = ("n_known", "base", "model")
    group, docs, total = None, [], {name: np.zeros(GROUP_DOCS) for name in names}

    def closed() -> pa.RecordBatch:
        at = np.array([key % GROUP_DOCS for key, *_ in docs], int)
        columns = list(zip(*docs, strict=True))[1:]
        types = [pa.int64(), pa.bool_(), pa.int64()]
        return pa.record_batch(
            [
                *(pa.array(c, t) for c, t in zip(columns, types, strict=True)),
                *(pa.array(total[name][at].astype(t)) for name, t in zip(names, (np.int64, float, float), strict=True)),
            ],
            ["doc_id", "learned", "n_tokens", "n_known", "base", "model"],
        )

    for batch in batches:
        for new, sums, *doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if new != group:
                if docs:
                    yield closed()
                group, docs, total = new, [], {name: np.zeros(GROUP_DOCS) for name in names}
            if sums is None:
                docs.append(doc)
            else:
                part = unpacked_sums(sums)
                for name in names:
                    total[name][part["at"]] += part[name]
    if docs:
        yield closed()


def scored_texts(docs: DataFrame, learned) -> DataFrame:
    """``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    ``learned`` is a condition on ``docs``: the rows that the model learns from.
    """
    train = docs.filter(learned)
    counted = written(vocabulary(train), "vocabulary")
    sizes = counted.agg(
        F.sum("count").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == END, F.col("count"))).alias("docs")
    ).first()
    total, distinct, train_docs = sizes["n"] or 0, sizes["v"], sizes["docs"] or 0
    common = counted.filter((F.col("count") > total / HOT_SHARES) | (F.col("word") == END)).collect()
    hot = {word_key(r["word"]) & int(_WORD_MASK): r["count"] for r in common}
    hot.setdefault(END_KEY & int(_WORD_MASK), 0)
    hot_keys = np.array(sorted(hot), np.uint64)
    shards = max(16, math.ceil(total / SHARD_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, blobs, held = None, [], []
        for batch in batches:
            infos = batch.filter(pa.compute.is_valid(batch.column("key")))
            if infos.num_rows:
                group = pa.array(infos.column("key").to_numpy() // GROUP_DOCS)
                yield pa.record_batch(
                    [group, pa.nulls(infos.num_rows, pa.binary()), *infos.columns[2:]],
                    ["group", "sums", "key", "doc_id", "learned", "n_tokens"],
                )
            for number, blob in zip(batch.column("shard").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if blob is None:
                    continue
                if number != shard and blobs:
                    held.append(shard_sums(blobs, total, distinct, hot))
                    blobs = []
                    if sum(len(part[0]) for part in held) > HELD_DOCS:
                        yield packed_sums(held)
                        held = []
                shard = number
                blobs.append(blob)
        if blobs:
            held.append(shard_sums(blobs, total, distinct, hot))
        if held:
            yield packed_sums(held)

    rows = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", F.coalesce(learned, F.lit(False)).alias("learned"), "text")
    sums = sent_tokens(rows, shards, hot_keys).repartition("shard").sortWithinPartitions("shard").mapInArrow(run, SUMS_DDL)
    by_doc = sums.repartition("group").sortWithinPartitions("group").mapInArrow(totals, TOTALS_DDL)
    return by_doc.select(
        "doc_id",
        "learned",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"),
        (F.col("model") - math.log10(train_docs + PRIOR)).alias("score"),
    )
