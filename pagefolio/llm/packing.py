"""Packing token sequences into as few bins as possible, by minimum bin slack.

A bin is anchored at the longest piece that is left. Subset sums of the lengths that are left, as
a bitset with one bit per token, then show the fullest feasible combination for the rest of the
bin, which is taken out. Only lengths matter, and there are at most ``capacity`` of them: the
search runs on the histogram of lengths, and a combination that can be taken ``k`` times is taken
``k`` times at once. So the plan is as small for a billion pieces as for a thousand, while every
piece is counted.

Pieces then find their place by their rank among the pieces of their length. Ranks are counted in
salted groups, so a length that a third of all pieces share is no task of its own.

A null or empty text is a document of one token, the end mark. Repeated rows are packed each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagefolio.llm.text import slices
from pagefolio.sources.scratch import written

CAPACITY = 4096
END_ID = 1
# Rows of a salted group in which ranks are counted.
GROUP_ROWS = 200_000

# In these texts the tokenizer's steps do not reach across words, so a word's ids do not depend on
# its neighbours: printable ASCII, line breaks, tabs and the letters of Latin-1. Other texts are
# given to the tokenizer whole.
PLAIN = re.compile(r"[\t\n\r\x20-\x7EÀ-ÖØ-öø-ÿ]*")
# The pieces into which the tokenizer's own pattern splits such texts.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
MEMORY_WORDS = 400_000


class Encoder:
    """Ids of texts as little-endian 32-bit bytes; remembers the ids of words."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.memory: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, found: Iterable[str]) -> None:
        """Encodes words joined by spaces, which the tokenizer drops; far cheaper than one by one."""
        new = list(found)
        for i in range(0, len(new), 512):
            part = new[i : i + 512]
            code = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            raw = np.array(code.ids, "<u4").tobytes()
            cuts = (4 * np.searchsorted(np.array(code.word_ids), np.arange(len(part) + 1))).tolist()
            for word, begin, end in zip(part, cuts, cuts[1:], strict=False):
                self.memory[word] = raw[begin:end]

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [
            PIECE.findall(text.lower()) if "<|" not in text and PLAIN.fullmatch(text) else None for text in texts
        ]
        if len(self.memory) > MEMORY_WORDS:
            self.memory = {}
        wanted = set().union(*(p for p in pieces if p))
        self.learn(wanted.difference(self.memory))
        get = self.memory.__getitem__
        return [
            self.whole(text) if found is None else b"".join(map(get, found))
            for text, found in zip(texts, pieces, strict=True)
        ]


PIECES_DDL = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, row, piece, start, length, ids_crc32`` and, if asked for, ``ids``, per piece.

    A document is its ids and the end mark; only documents of more than ``capacity`` ids are cut.
    ``row`` tells repeated rows apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, step = Encoder(tokenizer), np.array([END_ID], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            for part in slices(batch):
                codes = encoder.encode([t or "" for t in part.column(2).to_pylist()])
                rows = []
                for doc_id, row, code in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), codes, strict=True):
                    code += end
                    for i, at in enumerate(range(0, len(code), step)):
                        one = code[at : at + step]
                        rows.append((doc_id, row, i, at // 4, len(one) // 4, zlib.crc32(one), one))
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns[:6], types, strict=True)]
                names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    ids = [np.frombuffer(c, "<u4").astype(np.int32) for c in columns[6]]
                    arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.record_batch(arrays, names)

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(run, PIECES_DDL + (", ids array<int>" if with_ids else ""))


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """``(length, number)`` of the combination that fills ``room`` best.

    Bit ``s`` of a sum set tells that some combination of the lengths seen so far has sum
    ``s``. A length with ``c`` pieces enters as blocks of 1, 2, 4 ... pieces. The search ends as
    soon as the room can be filled entirely.
    """
    mask, sums, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        left = min(counts[length], room // length)
        block = 1
        while left:
            n = min(block, left)
            left -= n
            block *= 2
            steps.append((length, n, sums))
            sums |= sums << length * n & mask
        if sums >> room:
            break
    total = sums.bit_length() - 1
    taken: dict[int, int] = {}
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            total -= length * n
            taken[length] = taken.get(length, 0) + n
    return sorted(taken.items(), reverse=True)


def bin_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(number of bins, [(length, pieces of it in each bin)])`` in the order of their making.

    Each entry uses up at least one length or leaves too few pieces of it for another bin, so
    there are few entries however many pieces there are.
    """
    counts = {length: n for length, n in histogram.items() if n}
    lengths, plan = sorted(counts, reverse=True), []
    while lengths:
        anchor = lengths[0]
        counts[anchor] -= 1
        rest = fullest([x for x in lengths if counts[x] and x <= capacity - anchor], counts, capacity - anchor)
        counts[anchor] += 1
        pattern = dict(rest)
        pattern[anchor] = pattern.get(anchor, 0) + 1
        times = min(counts[length] // n for length, n in pattern.items())
        for length, n in pattern.items():
            counts[length] -= n * times
        plan.append((times, sorted(pattern.items(), reverse=True)))
        lengths = [x for x in lengths if counts[x]]
    return plan


class Places:
    """Bin and offset of a piece by its length and its rank among the pieces of that length.

    Segments of ranks that one entry of the plan uses are sorted by length and rank, so one
    binary search finds the segment of each piece.
    """

    SHIFT = 1 << 48

    def __init__(self, plan: list[tuple[int, list[tuple[int, int]]]]):
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for times, pattern in plan:
            offset = 0
            for length, n in pattern:
                first = used.get(length, 0)
                rows.append((length * self.SHIFT + first, n, sequence, offset, length))
                used[length] = first + n * times
                offset += length * n
            sequence += times
        self.sequences = sequence
        self.table = np.array(sorted(rows), np.int64).reshape(-1, 5)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length * self.SHIFT + rank
        start, n, sequence, offset, size = self.table[np.searchsorted(self.table[:, 0], key, "right") - 1].T
        within = key - start
        return sequence + within // n, offset + within % n * size


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` has ``row, piece, length`` and any other columns, and should be cheap to read
    twice, such as a written table.
    """
    salted = pieces.withColumn(
        "salt", F.pmod(F.xxhash64("row", "piece"), F.lit(1 << 20)).cast("int")
    )
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    total = sum(histogram.values())
    groups = max(1, -(-total // GROUP_ROWS))
    places = Places(bin_patterns(histogram, capacity))

    # Rank within a salted group, plus the pieces of that length in the groups before it.
    salted = salted.withColumn("salt", F.col("salt") % groups)
    sizes = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("length", "salt").orderBy("row", "piece")
    ranked = (
        salted.withColumn("place", F.row_number().over(within) - 1)
        .join(firsts, ["length", "salt"])
        .withColumn("rank", F.col("first") + F.col("place"))
        .select(*pieces.columns, "rank")
    )
    at = pieces.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at).to_numpy()
            sequence, offset = places.find(length, batch.column(batch.num_columns - 1).to_numpy())
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, pieces.schema.add("sequence_id", "long").add("offset", "long"))


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document: what it is and where it lies."""
    pieces = written(token_pieces(docs, tokenizer, capacity), "pieces")
    return packed(pieces, capacity).drop("row")
