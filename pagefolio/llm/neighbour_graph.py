"""Near duplicates of embeddings by NN-descent, the iterative refinement of a neighbour graph.

Equal vectors form a class, and one representative of each goes on. The first graph joins vectors
that lie near each other when sorted by random hyperplane signatures. Each round then compares the
neighbours of every vector with each other, and keeps the best ``k`` for each, until hardly any list
changes. Vectors whose whole list lies above the threshold are saturated; their lists double, until
that finds no new group. A full list may still hide a link to another group, so at the end the
saturated vectors of different groups are compared exactly, block by block; blocks whose centres lie
too far apart for any link are passed over. Rounds use rounded vectors of one byte per component;
links are confirmed in double precision.

The graph finds which vectors belong together; the links of each vector are then counted among
all members of its group, block by block, so a list never limits them. An audit compares the links of
``AUDIT`` vectors, chosen by hash, with those found by brute force over all rows; while less than
``RECALL`` are found, refinement goes on with other hyperplanes and longer lists, and after ``ATTEMPTS``
times it fails.

Vectors that are null, zero, or have null or non-finite components link with nothing; nor do
vectors of different lengths. Rows without an id link like others and have no ``component_id`` of
their own unless a row with an id shares their group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefolio.llm.components import components
from pagefolio.sources.scratch import written

THRESHOLD = 0.95
# Rounding to bytes moves a cosine by less than this.
SLACK = 0.02
K = 10
# Neighbours by which a vector enters the lists of others, on average at most.
REVERSE = 20
TABLES, BITS, WINDOW = 6, 16, 8
# Lists double at most ``ENLARGEMENTS`` times; what they then leave out is found by the exact comparison.
ROUNDS, ENLARGEMENTS, ATTEMPTS = 8, 4, 8
AUDIT, RECALL = 512, 0.97
BLOCK = 512
# Blocks whose centres are compared at a time.
TILE = 2048


def usable(vector: list | None) -> np.ndarray | None:
    """The vector at length 1 in double precision, or None if it links with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    x = np.array(vector, float)
    if not np.isfinite(x).all() or not x.any():
        return None
    # Scaled first, so that neither very large nor very small components lose the length.
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def rounded(x: np.ndarray) -> np.ndarray:
    return np.rint(x * (127 / np.abs(x).max())).astype(np.int8)


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, key, unit, code``; the last three are null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units, codes = [], [], []
            for vector in batch.column(1).to_pylist():
                x = usable(vector)
                keys.append(None if x is None else np.array(vector, float).tobytes())
                units.append(None if x is None else x.tobytes())
                codes.append(None if x is None else rounded(x).tobytes())
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, pa.binary()) for c in (keys, units, codes))],
                ["vec_id", "key", "unit", "code"],
            )

    rows = embeddings.select("vec_id", "embedding").mapInArrow(run, "vec_id long, key binary, unit binary, code binary")
    return rows.withColumn("key", F.md5("key"))


def _codes(column: pa.Array) -> np.ndarray:
    """Rounded vectors of one length as rows of length 1."""
    x = np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(len(column), -1).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def first_graph(vectors: DataFrame, seed: int) -> DataFrame:
    """``u, v, sim``: the best neighbours in the order of each table's signatures."""
    rows = None
    for table in range(TABLES):

        def sign(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = []
                for code in batch.column(1).to_pylist():
                    x = np.frombuffer(code, np.int8).astype(float)
                    planes = _planes(seed, table, len(x))
                    at = planes @ x
                    bits = 0
                    for bit in at[:-1] > 0:
                        bits = bits << 1 | int(bit)
                    place.append((len(x) << 32) + (bits << 16) + int(np.clip(at[-1] / 127 / 8 * 32768 + 32768, 0, 65535)))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(place, pa.int64())], ["u", "code", "place"])

        one = vectors.select("u", "code").mapInArrow(sign, "u long, code binary, place long").withColumn("table", F.lit(table))
        rows = one if rows is None else rows.unionByName(one)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            width = pa.compute.binary_length(table["code"]).to_numpy() + 100_000 * table["table"].to_numpy()
            cuts = np.flatnonzero(np.diff(width)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(width)], strict=True):
                part = table.slice(start, end - start).combine_chunks()
                ids, x = part["u"].to_numpy(), _codes(part["code"])
                found = []
                for step in range(1, min(WINDOW, len(ids) - 1) + 1):
                    sims = np.einsum("ij,ij->i", x[:-step], x[step:])
                    found += [(ids[:-step], ids[step:], sims), (ids[step:], ids[:-step], sims)]
                if found:
                    u, v, s = (np.concatenate(c) for c in zip(*found, strict=True))
                    yield _best(u, v, s, K)

    placed = rows.repartitionByRange("table", "place").sortWithinPartitions("table", "place")
    return placed.select("u", "code", "table").mapInArrow(near, "u long, v long, sim float")


_PLANES: dict = {}


def _planes(seed: int, table: int, size: int) -> np.ndarray:
    key = (seed, table, size)
    if key not in _PLANES:
        _PLANES[key] = np.random.default_rng(key).standard_normal((BITS + 1, size))
    return _PLANES[key]


def _best(u: np.ndarray, v: np.ndarray, s: np.ndarray, k: int | np.ndarray) -> pa.RecordBatch:
    """At most ``k`` rows of each ``u``, those with the largest ``s``; ``k`` may be given for each row."""
    order = np.lexsort((v, -s, u))
    k = k[order] if isinstance(k, np.ndarray) else k
    u, v, s = u[order], v[order], s[order]
    begin = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, int)
    rank = np.arange(len(u)) - np.repeat(begin, np.diff(np.append(begin, len(u))))
    keep = rank < k
    return pa.record_batch([pa.array(u[keep]), pa.array(v[keep]), pa.array(s[keep].astype(np.float32))], ["u", "v", "sim"])


def best_lists(edges: DataFrame, sizes: DataFrame | None = None, k: int = K) -> DataFrame:
    """The best ``k`` neighbours of every ``u``, or as many as ``sizes (u, k)`` says."""
    lists = edges.filter("u <> v").groupBy("u").agg(
        F.array_sort(F.collect_set(F.struct((-F.col("sim")).alias("s"), "v"))).alias("found")
    )
    if sizes is None:
        lists = lists.withColumn("k", F.lit(k))
    else:
        lists = lists.join(sizes, "u", "left").withColumn("k", F.coalesce("k", F.lit(k)))
    cut = F.explode(F.slice("found", F.lit(1), F.col("k")))
    return lists.select("u", "k", cut.alias("e")).select("u", F.col("e.v").alias("v"), (-F.col("e.s")).alias("sim"), "k")


def refined(graph: DataFrame, vectors: DataFrame, round_: int) -> DataFrame:
    """``u, v, sim`` found by comparing the neighbours of every vector with each other."""
    # A vector that is near very many enters their lists by chance, so that no list of work grows
    # with the input.
    popular = graph.groupBy("v").agg(F.count("*").alias("n"))
    chance = F.pmod(F.xxhash64("u", "v", F.lit(round_)), F.lit(1 << 20)) / float(1 << 20)
    used = graph.join(popular, "v").filter(chance * F.col("n") < REVERSE).select("u", "v")
    last = graph.groupBy("u").agg(
        F.when(F.count("*") >= F.max("k"), F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"), F.max("k").alias("k")
    )
    members = (
        used.select(F.col("u").alias("c"), F.col("v").alias("u"))
        .unionByName(used.select(F.col("v").alias("c"), "u"))
        .unionByName(vectors.select(F.col("u").alias("c"), "u"))
        .distinct()
        .join(vectors.select("u", "code").join(last, "u", "left"), "u")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Groups may go on in the next batch; their rows wait for it.
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            c = table["c"].to_numpy()
            if not len(c):
                continue
            full = int(np.searchsorted(c, c[-1]))
            rest = table.slice(full)
            yield from _compared(table.slice(0, full))
        if rest is not None:
            yield from _compared(rest)

    ordered = members.select(
        "c", "u", "code", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst"), F.coalesce("k", F.lit(K)).alias("k")
    )
    return ordered.repartition("c").sortWithinPartitions("c").mapInArrow(compare, "u long, v long, sim float")


def _compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    table = table.combine_chunks()
    c, ids, worst, k = (table[name].to_numpy() for name in ("c", "u", "worst", "k"))
    codes = table["code"].to_pylist()
    begin = np.append(np.flatnonzero(np.append(True, c[1:] != c[:-1])), len(c))
    found: list = [[], [], [], []]
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        if b - a < 2:
            continue
        if len({len(x) for x in codes[a:b]}) > 1:
            continue
        x = np.frombuffer(b"".join(codes[a:b]), np.int8).reshape(b - a, -1).astype(np.float32)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sims = x @ x.T
        np.fill_diagonal(sims, -3.0)
        i, j = np.nonzero(sims > worst[a:b, None])
        found[0].append(ids[a:b][i])
        found[1].append(ids[a:b][j])
        found[2].append(sims[i, j])
        found[3].append(k[a:b][i])
    if found[0]:
        yield _best(*(np.concatenate(f) for f in found))


def confirmed(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` of the pairs whose cosine in double precision reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True)
            keep = [len(x) == len(y) and np.frombuffer(x) @ np.frombuffer(y) >= threshold for x, y in both]
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = vectors.select(F.col("u").alias("a"), F.col("unit").alias("left"))
    right = vectors.select(F.col("u").alias("b"), F.col("unit").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def descended(graph: DataFrame, vectors: DataFrame, rows: int, sizes: DataFrame | None, start: int) -> DataFrame:
    """Rounds of refinement until under one list entry in a hundred changes."""
    for round_ in range(start, start + ROUNDS):
        found = graph.select("u", "v", "sim").unionByName(refined(graph, vectors, round_))
        better = written(best_lists(found, sizes), "graph")
        changed = better.join(graph.select("u", "v"), ["u", "v"], "left_anti").count()
        graph = better
        if changed <= 0.01 * rows * K:
            break
    return graph


def links_in_groups(labels: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``u, others``: vectors, copies included, that link with each representative in its group.

    Members are dealt out to blocks of about ``BLOCK``; every pair of blocks of a group is a task's
    work of fixed size, and only counts leave it.
    """
    sizes = labels.groupBy("component").agg(F.count("*").alias("n"))
    dealt = (
        labels.withColumnRenamed("id", "u")
        .join(sizes, "component")
        .join(vectors.select("u", "unit", "copies"), "u")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK))
        .withColumn("block", F.pmod(F.xxhash64("u"), "blocks"))
    )
    # Each member meets its own block and every other block of its group.
    sides = dealt.select(
        "component", "u", "unit", "copies", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "component",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "u", "unit", "copies", "block",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            keys = np.column_stack([table[k].to_numpy() for k in ("component", "low", "high")])
            new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            for a, b in zip(new[:-1], new[1:], strict=True):
                yield _counted(table.slice(a, b - a), threshold)
            rest = table.slice(new[-1])
        if rest is not None and rest.num_rows:
            yield _counted(rest, threshold)

    keys = ["component", "low", "high"]
    parts = sides.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(count, "u long, others long")
    return parts.groupBy("u").agg(F.sum("others").alias("others"))


def _counted(table: pa.Table, threshold: float) -> pa.RecordBatch:
    ids, copies, block = (table[c].to_numpy() for c in ("u", "copies", "block"))
    units = table["unit"].to_pylist()
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    total = np.zeros(len(ids), np.int64)
    lengths = np.array([len(x) for x in units])
    for length in np.unique(lengths):
        left, right = np.flatnonzero((lengths == length) & (block == low)), np.flatnonzero((lengths == length) & (block == high))
        if not len(left) or not len(right):
            continue
        x = np.stack([np.frombuffer(units[i]) for i in left])
        y = np.stack([np.frombuffer(units[i]) for i in right])
        linked = x @ y.T >= threshold
        if low == high:
            np.fill_diagonal(linked, False)
            total[left] += linked @ copies[right]
        else:
            total[left] += linked @ copies[right]
            total[right] += linked.T @ copies[left]
    return pa.record_batch([pa.array(ids), pa.array(total)], ["u", "others"])


def _by_key(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """One table for each run of equal keys, which may go on in the next batch."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if not table.num_rows:
            continue
        keys = np.column_stack([table[k].to_numpy() for k in names])
        new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        for a, b in zip(new[:-1], new[1:], strict=True):
            yield table.slice(a, b - a)
        rest = table.slice(new[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _units(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(x) for x in column.to_pylist()])


def links_between(saturated: DataFrame, labels: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: a link for every two blocks of ``saturated (u)`` in different components that any link joins.

    A vector whose list is not full holds all its links, so only links between two full lists can be
    missing. Blocks of about ``BLOCK`` members of one component have a centre and the largest angle of a
    member to it; two blocks are compared whole unless these angles rule a link out.
    """
    labelled = saturated.select("u").join(labels.withColumnRenamed("id", "u"), "u", "left").withColumn("component", F.coalesce("component", "u"))
    sizes = labelled.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    members = written(
        labelled.join(sizes, "component").join(vectors.select("u", "unit"), "u")
        .select("component", F.pmod(F.xxhash64("u"), "blocks").alias("block"), "u", "unit"),
        "members",
    )

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, ["component", "block"]):
            x = _units(table["unit"])
            middle = x.sum(axis=0)
            middle = middle / np.linalg.norm(middle) if np.linalg.norm(middle) > 1e-9 else x[0]
            radius = float(np.arccos(np.clip(x @ middle, -1, 1)).max())
            yield pa.record_batch(
                [table["component"][:1].combine_chunks(), table["block"][:1].combine_chunks(), pa.array([middle.tobytes()]), pa.array([radius])],
                ["component", "block", "centre", "radius"],
            )

    blocks = members.repartition("component", "block").sortWithinPartitions("component", "block").mapInArrow(
        centre, "component long, block long, centre binary, radius double"
    )
    blocks = written(blocks.withColumn("id", F.monotonically_increasing_id()), "blocks")
    tiles = -(-blocks.count() // TILE)
    dealt = blocks.withColumn("tile", F.pmod(F.xxhash64("id"), F.lit(max(tiles, 1))))
    sides = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(max(tiles, 1) - 1)))).select(
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "id", "component", "centre", "radius"
    )
    reach = float(np.arccos(threshold)) + 1e-6

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, ["low", "high"]):
            low, high = table["low"][0].as_py(), table["high"][0].as_py()
            ids, component, radius, tile = (table[c].to_numpy() for c in ("id", "component", "radius", "tile"))
            lengths = pa.compute.binary_length(table["centre"]).to_numpy()
            for length in np.unique(lengths):
                left, right = np.flatnonzero((lengths == length) & (tile == low)), np.flatnonzero((lengths == length) & (tile == high))
                if not len(left) or not len(right):
                    continue
                angle = np.arccos(np.clip(_units(table["centre"].take(left)) @ _units(table["centre"].take(right)).T, -1, 1))
                close = (angle <= radius[left][:, None] + radius[right] + reach) & (component[left][:, None] != component[right])
                if low == high:
                    close &= ids[left][:, None] < ids[right]
                i, j = np.nonzero(close)
                yield pa.record_batch([pa.array(ids[left][i]), pa.array(ids[right][j])], ["left", "right"])

    pairs = sides.repartition("low", "high").sortWithinPartitions("low", "high").mapInArrow(near, "left long, right long")
    pairs = written(pairs.withColumn("pair", F.monotonically_increasing_id()), "pairs")
    both = pairs.select("pair", F.col("left").alias("id"), F.lit(0).alias("side")).unionByName(
        pairs.select("pair", F.col("right").alias("id"), F.lit(1).alias("side"))
    )
    rows = both.join(blocks.select("id", "component", "block"), "id").join(members, ["component", "block"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, ["pair"]):
            side, ids = table["side"].to_numpy(), table["u"].to_numpy()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            i, j = np.nonzero(_units(table["unit"].take(left)) @ _units(table["unit"].take(right)).T >= threshold)
            # One link joins the components; the others are counted within them.
            yield pa.record_batch([pa.array(ids[left][i[:1]]), pa.array(ids[right][j[:1]])], ["a", "b"])

    ordered = rows.select("pair", "side", "u", "unit").repartition("pair").sortWithinPartitions("pair")
    return ordered.mapInArrow(compare, "a long, b long")


def audited_recall(vectors: DataFrame, links: DataFrame, threshold: float) -> float:
    """Share of the links of ``AUDIT`` representatives, chosen by hash, that were found.

    Only their vectors and counts come to the driver.
    """
    chosen = vectors.select("u", "unit").orderBy(F.xxhash64("u", F.lit(3))).limit(AUDIT).collect()
    if not chosen:
        return 1.0
    ids = [r["u"] for r in chosen]
    queries = [bytes(r["unit"]) for r in chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries), np.int64)
        sizes = np.array([len(q) for q in queries])
        for batch in batches:
            own, units, copies = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            lengths = np.array([len(x) for x in units])
            for length in np.unique(lengths):
                rows, of = np.flatnonzero(lengths == length), np.flatnonzero(sizes == length)
                if len(of):
                    x = np.frombuffer(b"".join(units[i] for i in rows)).reshape(len(rows), -1)
                    q = np.frombuffer(b"".join(queries[i] for i in of)).reshape(len(of), -1)
                    linked = (q @ x.T >= threshold) & (np.array(ids)[of][:, None] != own[rows])
                    total[of] += linked @ copies[rows]
        yield pa.record_batch([pa.array(ids), pa.array(total)], ["u", "true_links"])

    true = vectors.select("u", "unit", "copies").mapInArrow(run, "u long, true_links long")
    row = (
        true.groupBy("u").agg(F.sum("true_links").alias("true_links"))
        .join(links, "u", "left")
        .agg(F.sum("true_links"), F.sum(F.least("true_links", F.coalesce("others", F.lit(0)))))
        .first()
    )
    return 1.0 if not row[0] else (row[1] or 0) / row[0]


def embedding_groups(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``embeddings``."""
    rows = written(unit_vectors(embeddings), "vectors")
    classes = written(
        rows.filter("key is not null").groupBy("key").agg(
            F.min("vec_id").alias("first"), F.count("*").alias("copies"),
            F.first("unit").alias("unit"), F.first("code").alias("code"),
        ).withColumn("u", F.coalesce("first", F.xxhash64("key"))),
        "classes",
    )
    vectors = classes.select("u", "unit", "code", "copies")
    n = vectors.count()
    graph = labels = others = bridges = None
    sizes, start = None, 0
    for attempt in range(ATTEMPTS):
        edges = first_graph(vectors, attempt)
        if graph is not None:
            edges = edges.unionByName(graph.select("u", "v", "sim"))
        graph = descended(written(best_lists(edges, sizes), "graph"), vectors, n, sizes, start)
        start += ROUNDS
        pairs = graph.filter(F.col("sim") >= threshold - SLACK).select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
        links = written(confirmed(pairs.distinct(), vectors, threshold), "links")
        if bridges is not None:
            links = links.unionByName(bridges)
        before, labels = labels, written(components(links), "labels")
        same = before is not None and not (
            before.select("component").distinct().exceptAll(labels.select("component").distinct()).limit(1).count()
            or labels.join(before, ["id", "component"], "left_anti").limit(1).count()
        )
        full = graph.groupBy("u").agg(F.count("*").alias("n"), F.max("k").alias("k"), F.min("sim").alias("worst"))
        saturated = written(full.filter((F.col("n") >= F.col("k")) & (F.col("worst") >= threshold - SLACK)).select("u", (F.col("k") * 2).alias("k")), "sizes")
        hidden = saturated.limit(1).count() > 0
        settled = same or not hidden or attempt >= ENLARGEMENTS
        if settled and hidden:
            between = written(links_between(saturated, labels, vectors, threshold), "between")
            if between.limit(1).count():
                bridges = between if bridges is None else bridges.unionByName(between)
                labels = written(components(links.unionByName(between)), "labels")
        others = written(links_in_groups(labels, vectors, threshold), "others")
        recall = audited_recall(vectors, others, threshold)
        if settled and recall >= RECALL:
            break
        if attempt < ENLARGEMENTS:
            kept = graph.select("u", "k").distinct().join(saturated.select("u"), "u", "left_anti")
            sizes = written(saturated.unionByName(kept), "sizes")
    else:
        raise RuntimeError(f"only {recall:.3f} of the audited links were found")
    by_class = written(
        classes.select("key", "u", "copies")
        .join(labels.withColumnRenamed("id", "u"), "u", "left")
        .join(others, "u", "left")
        .select("key", F.coalesce("component", "u").alias("component_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")),
        "by_class",
    )
    return rows.select("vec_id", "key").join(by_class, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
    )
