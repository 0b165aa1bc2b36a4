"""Near duplicates by MinHash bands with sequential Bayesian verification.

Documents are sets of word shingles. Documents with equal sets form a class, and only one
representative of each class goes on. Signatures of ``HASHES`` minima are cut into bands;
representatives that agree on a band are candidates. A candidate pair's signatures are compared
batch by batch, and the pair is dropped as soon as the posterior probability that its similarity
reaches the threshold falls below ``MISS``. Survivors are verified on their full sets, so every
reported link is exact.

Large groups of near copies share their bands, and their pairs are never listed. In two rounds the
members of each band are compared with one pivot, and links merge components. What is left are
pairs between different components of a band. Bands of at most ``SMALL_BAND`` members list them.
Members of larger bands are brought together in families and compared block by block, each block
against those it may still link with; a block returns only links that join components. So no pair
that could join two components stays unchecked.

A band of 6 of 240 minima, 40 times, misses a pair of similarity 0.8 with probability 5e-6. Shorter
bands would miss less, but pairs of unrelated texts that share one would grow with the square of the
input: at similarity 0.05, six minima agree with probability 6e-7 in any of the bands.

Null, empty and blank texts have no shingles and link with nothing. Repeated rows with one
``doc_id`` are one document if their sets agree; otherwise each set counts on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagefolio.llm.batches import ARROW_ROWS, small_batches  # noqa: F401
from pagefolio.llm.components import components
from pagefolio.llm.text import lower_ascii, slices, words
from pagefolio.operators.prune import only_needed
from pagefolio.sources.scratch import size_checked, written

HASHES, BAND_ROWS, BATCH = 240, 6, 24
THRESHOLD = 80  # percent
MISS = 1e-7
PIVOT_ROUNDS, PIVOTS = 2, 2
# Members up to which a band lists its pairs, and members of a block beyond that.
SMALL_BAND, BLOCK = 24, 400

# Hashes of words that a task remembers.
WORDS_KEPT = 50_000

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 2**31, (HASHES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _RANDOM.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, size: int, memory: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words, or of all words if fewer."""
    found = words(lower_ascii(text)) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    for word in set(found).difference(memory):
        memory[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
    codes = np.fromiter(map(memory.__getitem__, found), np.uint64, len(found))
    size = min(size, len(codes))
    n = len(codes) - size + 1
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ codes[i : i + n]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of 32 bits."""
    low = hashes.astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for start in range(0, len(low), 2048):
        np.minimum(out, (low[start : start + 2048] * _FACTORS + _TERMS).min(axis=1), out=out)
    return out


# Sets are kept as sorted hashes of 48 bits: two different shingles of a pair of sets of 1,000 share one
# with a probability below 1e-8.
KEPT_BYTES = 6


def packed_hashes(hashes: np.ndarray) -> bytes:
    low = np.unique(hashes & np.uint64(2 ** (8 * KEPT_BYTES) - 1)).astype("<u8")
    return low.view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES].tobytes()


def unpacked_hashes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEPT_BYTES, 8), np.uint8)
    out[:, :KEPT_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT_BYTES)
    return out.view("<u8").ravel()


SETS_DDL = "doc_id long, n_shingles long, set_key long, sig binary, bands array<long>, hashes binary"


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """Set, key of the set, signature and band keys of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    hashes = shingle_hashes(text, size, memory)
                    if not len(hashes):
                        rows.append((doc_id, 0, None, None, None, None))
                        continue
                    key = xxhash.xxh64_intdigest(hashes.tobytes()) - 2**63
                    sig = signature(hashes)
                    bands = [
                        xxhash.xxh64_intdigest(sig[i : i + BAND_ROWS].tobytes(), seed=i) - 2**63
                        for i in range(0, HASHES, BAND_ROWS)
                    ]
                    # Bands need whole minima; for comparing them, 16 bits tell them apart.
                    short = sig.astype("<u2").tobytes()
                    rows.append((doc_id, len(hashes), key, short, bands, packed_hashes(hashes)))
                if len(memory) > WORDS_KEPT:
                    memory = {}
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    ["doc_id", "n_shingles", "set_key", "sig", "bands", "hashes"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SETS_DDL)


def least_matches(threshold: float = THRESHOLD / 100, miss: float = MISS) -> list[tuple[int, int]]:
    """``(n, m)``: after ``n`` compared minima a pair with fewer than ``m`` matches is dropped.

    With a uniform prior, the similarity after ``m`` matches of ``n`` has a Beta(m + 1, n - m + 1)
    posterior; it exceeds ``t`` with the probability that a Binomial(n + 1, t) is at most ``m``.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def may_link(left: bytes, right: bytes, least: list[tuple[int, int]]) -> bool:
    """Whether no batch of minima rules the pair out."""
    same = np.frombuffer(left, "<u2") == np.frombuffer(right, "<u2")
    matches = 0
    for n, m in least:
        matches += int(same[n - BATCH : n].sum())
        if matches < m:
            return False
    return True


def _filtered(pairs: DataFrame, keep, ddl: str) -> DataFrame:
    """Rows of ``pairs (a, b, left, right)`` for which ``keep(left, right)`` holds, as ``a, b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 512):
                both = zip(part.column("left").to_pylist(), part.column("right").to_pylist(), strict=True)
                mask = pa.array([keep(x, y) for x, y in both], pa.bool_())
                yield pa.record_batch([part.column("a"), part.column("b")], ["a", "b"]).filter(mask)

    return pairs.select("a", "b", "left", "right").mapInArrow(run, ddl)


def _values_of(rows: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """The columns of the wanted nodes, one row each."""
    found = only_needed(rows.select("node", *columns), F.col("node"), nodes, F.col("node"))
    # The filter lets a few others pass; repeated rows of one document and set are one node.
    # An inner join: a semi join would be moved below the filter, to all rows.
    found = found.join(nodes.select("node").distinct(), "node").dropDuplicates(["node"])
    return written(found, "values")


def _with(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``pairs (a, b)`` with the column of both nodes as ``left`` and ``right``."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    # Repeated rows of one document and set are one node.
    values = _values_of(rows, nodes, column)
    left = values.select(F.col("node").alias("a"), F.col(column).alias("left"))
    right = values.select(F.col("node").alias("b"), F.col(column).alias("right"))
    return pairs.join(left, "a").join(right, "b")


def verified(pairs: DataFrame, rows: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The ``pairs (a, b)`` whose sets have at least ``threshold`` percent in common."""
    least = least_matches(threshold / 100)

    def linked(left: bytes, right: bytes) -> bool:
        x, y = unpacked_hashes(left), unpacked_hashes(right)
        if 100 * min(len(x), len(y)) < threshold * max(len(x), len(y)):
            return False
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= threshold * (len(x) + len(y) - common)

    ddl = "a long, b long"
    survivors = _filtered(_with(pairs, rows, "sig"), lambda x, y: may_link(x, y, least), ddl)
    return _filtered(_with(written(survivors, "survivors"), rows, "hashes"), linked, ddl)


def mixed_bands(active: DataFrame, round_: int) -> DataFrame:
    """``band, key, n, p, p_label`` of the bands with members of several components.

    ``p`` is the member with the smallest hash of the round, the pivot. Counts and minima are
    aggregated before they are shuffled.
    """
    if not round_:
        # All members are still their own components, and their ids are hashes.
        first = active.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("p"))
        return first.filter("n > 1").withColumn("p_label", F.col("p"))
    pivot = F.min(F.struct(F.xxhash64("node", F.lit(round_)), "node", "label"))
    bands = active.groupBy("band", "key").agg(
        F.count("*").alias("n"), pivot.alias("pivot"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    return bands.filter("low <> high").select(
        "band", "key", "n", F.col("pivot.node").alias("p"), F.col("pivot.label").alias("p_label")
    )


def best_pivots(members: DataFrame) -> DataFrame:
    """``a, b``: every member with the ``PIVOTS`` pivots that it shares most bands with.

    Rounds only save work, so other pivots can wait; a member has one in each of its bands at most.
    """
    shared = members.groupBy("node", "p").agg(F.count("*").alias("n"))
    order = Window.partitionBy("node").orderBy(F.desc("n"), "p")
    best = shared.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PIVOTS)
    return best.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b"))


def members_of(active: DataFrame, bands: DataFrame) -> DataFrame:
    """The members of the given bands; those of other bands are left out before the shuffle."""
    return only_needed(active, F.col("key"), bands, F.col("key")).join(bands, ["band", "key"])


def relabelled(active: DataFrame, links: DataFrame) -> DataFrame:
    """``active`` with the components that ``links (a, b)`` lead to."""
    labels = written(components(links), "labels").withColumnRenamed("id", "node")
    return active.drop("label").join(labels, "node", "left").select(
        "band", "key", "node", F.coalesce("component", "node").alias("label")
    )


def linked_components(rows: DataFrame, classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``id, component`` of the classes that link with another one, by their nodes.

    ``rows`` has the column ``node``, which is a class's node in the row of its representative only.
    """
    active = written(
        rows.select("node", "bands")
        .join(classes.select("node"), "node", "left_semi")
        .dropDuplicates(["node"])
        .select("node", F.posexplode("bands").alias("band", "key")),
        "bands",
    ).withColumn("label", F.col("node"))
    links = None
    for round_ in range(PIVOT_ROUNDS):
        mixed = written(mixed_bands(active, round_), "mixed")
        members = written(members_of(active, mixed), "members")
        pairs = best_pivots(members.filter("label <> p_label"))
        found = written(verified(written(pairs.distinct(), "pairs"), rows, threshold), "found")
        links = found if links is None else links.unionByName(found)
        active = written(relabelled(members, links), "bands")
    mixed = written(mixed_bands(active, PIVOT_ROUNDS), "mixed")
    open_rows = members_of(active, mixed)
    small = open_rows.filter(F.col("n") <= SMALL_BAND)
    one = small.select("band", "key", F.col("node").alias("a"), F.col("label").alias("la"))
    two = small.select("band", "key", F.col("node").alias("b"), F.col("label").alias("lb"))
    pairs = one.join(two, ["band", "key"]).filter("a < b and la <> lb").select("a", "b").distinct()
    links = links.unionByName(written(verified(written(pairs, "pairs"), rows, threshold), "found"))
    large = written(open_rows.filter(F.col("n") > SMALL_BAND).select("node", "label", "p").distinct(), "large")
    if large.limit(1).count():
        links = links.unionByName(written(links_in_families(large, rows, threshold), "found"))
    return written(components(links), "labels")


def links_in_families(large: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """Links between different labels among the members ``(node, label, p)`` of large bands.

    Bands with common members are a family. Most of its members may share one label; those need no
    comparison with each other, but only with the rest. So the rest is dealt out to the first
    blocks of the family and the others to the blocks after them, and every first block meets every
    block. A pair of blocks is a work of fixed size.
    """
    families = components(large.select(F.col("node").alias("a"), F.col("p").alias("b")))
    members = written(
        large.select("node", "label").distinct().join(families.withColumnRenamed("id", "node"), "node"), "members"
    )
    sizes = members.groupBy("component", "label").agg(F.count("*").alias("n"))
    plans = sizes.groupBy("component").agg(
        F.max(F.struct("n", "label")).alias("most"), (F.sum("n") - F.max("n")).alias("others")
    ).select(
        "component",
        F.col("most.label").alias("most"),
        F.greatest(F.lit(1), F.ceil(F.col("others") / BLOCK)).alias("firsts"),
        F.ceil(F.col("most.n") / BLOCK).alias("rest"),
    )
    values = _values_of(rows, members.select("node"), "sig", "hashes")
    place = F.xxhash64("node", F.lit(5))
    dealt = (
        members.join(plans, "component")
        .join(values, "node")
        .withColumn(
            "block",
            F.when(F.col("label") == F.col("most"), F.col("firsts") + F.pmod(place, "rest")).otherwise(F.pmod(place, "firsts")),
        )
        .withColumn(
            "other",
            F.explode(
                F.when(F.col("block") >= F.col("firsts"), F.sequence(F.lit(0), F.col("firsts") - 1)).otherwise(
                    F.sequence(F.lit(0), F.col("firsts") + F.col("rest") - 1)
                )
            ),
        )
        .select(
            "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "node", "label", "sig", "hashes",
        )
    )
    least = least_matches(threshold / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            keys = np.column_stack([table[k].to_numpy() for k in ("component", "low", "high")])
            new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            for start, end in zip(new[:-1], new[1:], strict=True):
                yield _block_links(table.slice(start, end - start), threshold, least)
            rest = table.slice(new[-1])
        if rest is not None and rest.num_rows:
            yield _block_links(rest, threshold, least)

    keys = ["component", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _block_links(table: pa.Table, threshold: int, least: list[tuple[int, int]]) -> pa.RecordBatch:
    """Links between two blocks, or within one, that join different labels; each joins two for good."""
    block, nodes, labels = (table[c].to_numpy() for c in ("block", "node", "label"))
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    found: list[tuple[int, int]] = []
    if len(left) and len(right):
        sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u2").reshape(-1, HASHES)
        alive = labels[left][:, None] != labels[right][None, :]
        if low == high:
            alive &= nodes[left][:, None] < nodes[right][None, :]
        matches = np.zeros(alive.shape, np.int16)
        for n, m in least:
            for h in range(n - BATCH, n):
                matches += sigs[left, h][:, None] == sigs[right, h][None, :]
            alive &= matches >= m
        left, right, alive = left[alive.any(axis=1)], right[alive.any(axis=0)], alive[alive.any(axis=1)][:, alive.any(axis=0)]
        if alive.any():
            sets = table["hashes"].to_pylist()
            x, y = [unpacked_hashes(sets[i]) for i in left], [unpacked_hashes(sets[i]) for i in right]
            common = common_counts(x, y)
            sizes = np.array([len(v) for v in x])[:, None] + np.array([len(v) for v in y])[None, :]
            linked = alive & (100 * common >= threshold * (sizes - common))
            root: dict[int, int] = {}

            def top(label: int) -> int:
                while root.get(label, label) != label:
                    label = root[label]
                return label

            for i, j in zip(*np.nonzero(linked), strict=True):
                one, two = top(int(labels[left[i]])), top(int(labels[right[j]]))
                if one != two:
                    root[one] = two
                    found.append((int(nodes[left[i]]), int(nodes[right[j]])))
    columns = list(zip(*found, strict=True)) or [(), ()]
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def common_counts(x: list[np.ndarray], y: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all sets of ``x`` with all of ``y``, as a product of 0-1 matrices.

    Only hashes that occur on both sides take part, some columns at a time.
    """
    out = np.zeros((len(x), len(y)), np.int64)
    both = np.intersect1d(np.concatenate(x), np.concatenate(y))
    sides = []
    for sets in (x, y):
        of = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(both, flat), max(len(both) - 1, 0))
        known = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        sides.append((of[known], at[known]))
    for start in range(0, len(both), columns):
        width = min(columns, len(both) - start)
        parts = []
        for (of, at), sets in zip(sides, (x, y), strict=True):
            inside = (at >= start) & (at < start + width)
            part = np.zeros((len(sets), width), np.float32)
            part[of[inside], at[inside] - start] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def near_duplicate_groups(docs: DataFrame, size: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept`` of every row of ``docs``.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id that
    links lead to; a document is kept if that is its own.
    """
    with small_batches(docs.sparkSession):
        found = written(shingle_sets(docs, size), "sets")
    # A class is a node; the row of its smallest id has the same node, other rows of the class do not.
    node = F.xxhash64("set_key", F.coalesce("doc_id", F.lit(-1)))
    classes = written(
        found.filter("set_key is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("set_key", F.col("doc_id").alias("rep"), node.alias("node")),
        "classes",
    )
    rows = found.filter("set_key is not null").withColumn("node", node)
    with small_batches(docs.sparkSession):
        labels = linked_components(rows, classes, threshold)
    linked = classes.join(labels.withColumnRenamed("id", "node"), "node")
    smallest = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = linked.join(smallest, "component").select("set_key", "component_id")
    class_labels = written(
        classes.join(by_class, "set_key", "left").select(
            "set_key", "rep", F.coalesce("component_id", "rep").alias("component")
        ),
        "class_labels",
    )
    # A set that very many documents share is one key here: both sides are plain scans, so that
    # adaptive execution can split it.
    return (
        found.select("doc_id", "n_shingles", "set_key")
        .join(class_labels, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("rep", "doc_id").alias("class_id"),
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, size: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``docs``.

    Rows are told apart by their place in the input, which is written first: repeated rows and
    rows without ``doc_id`` are documents of their own, so of two equal rows one stays, and a row
    without id that copies another leaves with it. Of a group the row first in the input stays.
    """
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "dedup_rows")
    groups = near_duplicate_groups(rows.select(F.col(key).alias("doc_id"), "text"), size, threshold)
    kept = written(groups.filter("kept").select(F.col("doc_id").alias(key)), "kept")
    # The kept keys are broadcast if they measure small, so that texts stay where they are; else
    # both sides are sorted by key.
    return rows.join(size_checked(kept), key, "left_semi").drop(key)
