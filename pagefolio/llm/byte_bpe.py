"""Byte-level BPE by recursive queries of an in-process DuckDB, one database per task.

Texts are split by the tokenizer's pattern. The distinct words that a task has not met yet become
rows with a list of their tokens, at first one per byte. A recursive query contracts each word's
leftmost pair of minimum rank, joins the new token and its neighbours with the merge table and goes
on with the words that changed, until none does. Aggregations put the words' ids together for each
document and decode them again from the bytes of the tokens.

The merge table has a row for every way to put two tokens together to a third, so it is bounded by
the vocabulary. A word that is itself a token is that token. Words over ``LONG_BYTES`` bytes, of
which one may be a whole text, contract all occurrences of their minimum pair at once where the
new token takes part in no pair of lower rank; the result is the same, in far fewer rounds.

Null and empty texts have no ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

LONG_BYTES = 64
# Characters of text in a chunk, and words remembered between chunks.
CHUNK_CHARS = 1_500_000
LEARN_WORDS = 20_000
MEMORY_WORDS = 700_000
# Above all ids: the rank of a pair that is no token, and the token after a word's last.
NONE = (1 << 24) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, which are their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_rows(ranks: dict[bytes, int]) -> np.ndarray:
    """``left, right, merged, alone``: every pair of tokens that together are a token.

    ``alone`` is 1 if no pair with the merged token has a lower rank than the token.
    """
    rows = []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                rows.append((left, right, rank))
    table = np.array(rows, np.int64).reshape(-1, 3)
    lowest = np.full(max(ranks.values()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, table[:, 0], table[:, 2])
    np.minimum.at(lowest, table[:, 1], table[:, 2])
    return np.column_stack([table, lowest[table[:, 2]] > table[:, 2]])


# One row per word: x has its tokens and a last NONE, each as rank << 32 | position << 24 | id, with
# the rank of the pair it makes with the token before it and the position of its first byte. So the
# minimum m is the word's pair of minimum rank, the first of several. A round puts the pair's token in
# its place and joins only the two pairs that are new with the merge table. A word's last row, which
# has no pair left, is its result.
CONTRACT = f"""
WITH RECURSIVE bpe(w, x, m) AS (
  SELECT w, x, list_min(x) FROM start
  UNION ALL (
  WITH best AS (
    SELECT w, x, m >> 32 AS merged, list_position(x, m) AS i FROM bpe WHERE m < {NONE << 32}
  ), near AS (
    SELECT w, x, merged, i, x[i - 2] & {NONE} AS before, x[i - 1] & {0xFF << 24} AS p, x[i + 1] & {(1 << 32) - 1} AS after
    FROM best
  ), put AS (
    SELECT w, list_concat(x[:i - 2], [
      (coalesce(a.merged, {NONE}) << 32) + p + near.merged, (coalesce(b.merged, {NONE}) << 32) + after], x[i + 2:]) AS x
    FROM near LEFT JOIN merges a ON a.pair = (before << 24) + near.merged
    LEFT JOIN merges b ON b.pair = (near.merged << 24) + (after & {NONE})
  )
  SELECT w, x, list_min(x) FROM put)
)
SELECT w, v >> 24 & 255 AS p, v & {NONE} AS t FROM (SELECT w, unnest(x[:-2]) AS v FROM bpe WHERE m >= {NONE << 32})
"""
# One row per token. All occurrences of the minimum pair that do not overlap are contracted: of a run of
# overlapping ones the first, third and so on. Only the first where that could change the result.
# Rows have keys and replace each other, so a long word takes no more room than its bytes; contracted
# positions stay with id -1.
CONTRACT_LONG = """
WITH RECURSIVE bpe(w, p, t) USING KEY (w, p) AS (
  SELECT w, p, t FROM start_long
  UNION ALL (
  WITH x AS (
    SELECT w, p, t, row_number() OVER v AS k, lead(t) OVER v AS nt, lead(p) OVER v AS np
    FROM bpe WHERE t >= 0 WINDOW v AS (PARTITION BY w ORDER BY p)
  ), pairs AS (
    SELECT x.*, m.merged, m.alone FROM x JOIN merges m ON m.pair = (x.t << 24) + x.nt
    QUALIFY m.merged = min(m.merged) OVER (PARTITION BY x.w)
  ), runs AS (
    SELECT *, k - row_number() OVER (PARTITION BY w ORDER BY k) AS run, row_number() OVER (PARTITION BY w ORDER BY k) AS nth
    FROM pairs
  ), chosen AS (
    SELECT w, p, np, merged FROM runs
    QUALIFY (row_number() OVER (PARTITION BY w, run ORDER BY k) & 1) = 1 AND (alone = 1 OR nth = 1)
  ), active AS (SELECT DISTINCT w FROM chosen)
  SELECT x.w, x.p, CASE WHEN gone.np IS NOT NULL THEN -1 ELSE coalesce(chosen.merged, x.t) END
  FROM x JOIN active USING (w) LEFT JOIN chosen ON x.w = chosen.w AND x.p = chosen.p
  LEFT JOIN chosen gone ON x.w = gone.w AND x.p = gone.np)
)
SELECT w, p, t FROM bpe WHERE t >= 0
"""
KEEP = """
INSERT INTO known
SELECT w, count(*), string_agg(id_hex, '' ORDER BY p), string_agg(hex, '' ORDER BY p)
FROM ({}) JOIN tokens USING (t) GROUP BY w
"""
DOCUMENTS = """
SELECT d, CAST(sum(n) AS BIGINT) AS n, string_agg(ids, '' ORDER BY p) AS ids, string_agg(bytes, '' ORDER BY p) AS bytes
FROM occurrences JOIN known USING (w) GROUP BY d ORDER BY d
"""
# One sort of all rows in place of one for each group and column. A single thread adds rows in the
# order it reads them; SQL does not promise that, so ``documents`` compares what is decoded.
KEEP_SORTED = """
INSERT INTO known
SELECT w, count(*), string_agg(id_hex, ''), string_agg(hex, '')
FROM (SELECT w, id_hex, hex FROM ({}) JOIN tokens USING (t) ORDER BY w, p) GROUP BY w
"""
# No sort where rows are in order already, if joins keep the order of the side written first. Only
# the words of a chunk are put in the join's table.
AS_READ = "SET disabled_optimizers = 'join_order,build_side_probe_side'"
AS_PLANNED = "SET disabled_optimizers = ''"
KEEP_AS_READ = """
INSERT INTO known
SELECT w, count(*), string_agg(id_hex, ''), string_agg(hex, '') FROM ({}) JOIN tokens USING (t) GROUP BY w
"""
DOCUMENTS_AS_READ = """
SELECT d, CAST(sum(n) AS BIGINT) AS n, string_agg(ids, '') AS ids, string_agg(bytes, '') AS bytes
FROM occurrences JOIN (SELECT * FROM known WHERE w IN (SELECT w FROM occurrences)) k USING (w) GROUP BY d ORDER BY d
"""
DIGESTS = """
SELECT d, n, sha256(unhex(ids)) AS ids_sha256, sha256(unhex(bytes)) AS decoded_sha256 FROM ({})
"""


class Bpe:
    """A tokenizer in a database of its own."""

    def __init__(self, ranks: dict[bytes, int], merges: np.ndarray, pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.strict = False
        pairs = dict(zip((merges[:, 0] << 24) + merges[:, 1], merges[:, 2], strict=True))
        self.byte_ranks = np.array([[pairs.get((a << 24) + b, NONE) for b in self.byte_ids] for a in self.byte_ids], np.int64)
        self.db = db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        db.execute("SET enable_progress_bar = false")
        db.register("m", pa.table([pa.array(c) for c in merges.T], ["l", "r", "merged", "alone"]))
        db.execute("CREATE TABLE merges AS SELECT (l << 24) + r AS pair, merged, alone FROM m")
        ids = np.array(list(ranks.values()), "<u4")
        rows = [list(ranks.values()), [i.tobytes().hex() for i in ids], [t.hex() for t in ranks]]
        db.register("k", pa.table(rows, ["t", "id_hex", "hex"]))
        db.execute("CREATE TABLE tokens AS SELECT * FROM k")
        db.unregister("m")
        db.unregister("k")
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = defaultdict(count().__next__)
        self.db.execute("CREATE OR REPLACE TABLE known (w BIGINT, n BIGINT, ids VARCHAR, bytes VARCHAR)")

    def positions(self, words: list[tuple[int, bytes]]) -> pa.Table:
        sizes = np.array([len(code) for _, code in words], np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        w = np.repeat(np.array([w for w, _ in words], np.int64), sizes)
        p = np.arange(total) - np.repeat(ends - sizes, sizes)
        t = self.byte_ids[np.frombuffer(b"".join(code for _, code in words), np.uint8)]
        return pa.table([pa.array(w), pa.array(p), pa.array(t)], ["w", "p", "t"])

    def lists(self, words: list[tuple[int, bytes]]) -> pa.Table:
        sizes = np.array([len(code) for _, code in words], np.int64)
        ends = np.cumsum(sizes)
        codes = np.frombuffer(b"".join(code for _, code in words), np.uint8)
        ranks = np.full(len(codes), NONE)
        ranks[1:] = self.byte_ranks[codes[:-1], codes[1:]]
        ranks[ends - sizes] = NONE
        p = np.arange(len(codes)) - np.repeat(ends - sizes, sizes)
        x = np.insert((ranks << 32) + (p << 24) + self.byte_ids[codes], ends, (NONE << 32) + NONE)
        starts = np.append(0, ends + np.arange(1, len(ends) + 1))
        w = pa.array([w for w, _ in words], pa.int64())
        return pa.table([w, pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x))], ["w", "x"])

    def learn(self, words: list[tuple[int, str]]) -> None:
        """Brings new words to their fixpoint and keeps their ids and bytes."""
        codes = [(w, word.encode("utf-8", "surrogatepass")) for w, word in words]
        single = [(w, self.ranks[code]) for w, code in codes if code in self.ranks]
        rest = [(w, code) for w, code in codes if code not in self.ranks]
        parts = {
            "single": pa.table([pa.array(c, pa.int64()) for c in zip(*single, strict=True)] if single else [pa.array([], pa.int64())] * 2, ["w", "t"]),
            "start": self.lists([(w, c) for w, c in rest if len(c) <= LONG_BYTES]),
            "start_long": self.positions([(w, c) for w, c in rest if len(c) > LONG_BYTES]),
        }
        sources = {"single": "SELECT w, 0 AS p, t FROM single", "start": CONTRACT, "start_long": CONTRACT_LONG}
        self.db.execute("SET preserve_insertion_order = false")
        for name, rows in parts.items():
            if rows.num_rows:
                self.db.register(name, rows)
                as_read = not self.strict and name != "start_long"  # whose rows are in no order
                keep = KEEP if self.strict else KEEP_AS_READ if as_read else KEEP_SORTED
                self.db.execute(AS_READ if as_read else AS_PLANNED)
                self.db.execute(keep.format(sources[name]))
                self.db.unregister(name)

    def documents(self, texts: list[str], digests: bool = True) -> pa.Table:
        """Digests, or ids and bytes, of each text that has a word; ``d`` is the text's place."""
        if len(self.words) > MEMORY_WORDS:
            self.forget()
        found = [self.pattern.findall(text) for text in texts]
        sizes = [len(words) for words in found]
        before = len(self.words)
        # A word that is not known yet gets the next number.
        w = np.fromiter(map(self.words.__getitem__, chain.from_iterable(found)), np.int64, sum(sizes))
        new = [(self.words[word], word) for word in islice(reversed(self.words), len(self.words) - before)]
        for start in range(0, len(new), LEARN_WORDS):
            self.learn(new[start : start + LEARN_WORDS])
        occurrences = pa.table(
            [pa.array(np.repeat(np.arange(len(texts)), sizes)), pa.array(np.arange(len(w))), pa.array(w)],
            ["d", "p", "w"],
        )
        self.db.register("occurrences", occurrences)
        form = DIGESTS if digests else "{}"
        self.db.execute(AS_PLANNED if self.strict else AS_READ)
        rows = self.db.sql(form.format(DOCUMENTS if self.strict else DOCUMENTS_AS_READ)).to_arrow_table()
        self.db.unregister("occurrences")
        decoded = rows.column("decoded_sha256" if digests else "bytes").to_pylist()
        for d, value in zip(rows.column("d").to_pylist(), decoded, strict=True):
            data = texts[d].encode("utf-8", "surrogatepass")
            if value != (hashlib.sha256(data).hexdigest() if digests else data.hex()):
                if self.strict:
                    raise ValueError("a text was not decoded as it was")
                self.strict = True
                self.forget()
                return self.documents(texts, digests)
        return rows


EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
DIGESTS_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS_DDL = "doc_id long, ids array<long>, decoded binary"


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of a batch in parts of about ``CHUNK_CHARS`` characters, at least one row."""
    start, texts, chars = 0, [], 0
    for i, text in enumerate(batch.column(1)):
        texts.append(text.as_py() or "")
        chars += len(texts[-1])
        if chars >= CHUNK_CHARS:
            yield batch.column(0).slice(start, len(texts)), texts
            start, texts, chars = i + 1, [], 0
    if texts:
        yield batch.column(0).slice(start, len(texts)), texts


def encoded(docs: DataFrame, ranks_path: str, pattern: str, digests: bool = False) -> DataFrame:
    """``doc_id, ids, decoded`` of every row of ``docs``; ``decoded`` comes from the ids alone.

    With ``digests``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``. The hashes are of the ids
    as little-endian unsigned 32-bit integers and of the decoded bytes, in lowercase hex.
    """
    ranks = read_ranks(ranks_path)
    merges = merge_rows(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or Bpe(ranks, merges, pattern)
            for ids, texts in chunks(batch):
                found = bpe.documents(texts, digests).to_pydict()
                at = {d: i for i, d in enumerate(found["d"])}
                places = [at.get(i) for i in range(len(texts))]

                def column(name: str, default, of=found, where=places) -> list:
                    return [default if i is None else of[name][i] for i in where]

                if digests:
                    yield pa.record_batch(
                        [
                            ids,
                            pa.array(column("n", 0), pa.int64()),
                            pa.array(column("ids_sha256", EMPTY_SHA256), pa.string()),
                            pa.array(column("decoded_sha256", EMPTY_SHA256), pa.string()),
                        ],
                        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                    )
                else:
                    codes = [np.frombuffer(bytes.fromhex(c), "<u4").astype(np.int64) for c in column("ids", "")]
                    data = [bytes.fromhex(c) for c in column("bytes", "")]
                    yield pa.record_batch(
                        [ids, pa.array(codes, pa.list_(pa.int64())), pa.array(data, pa.binary())],
                        ["doc_id", "ids", "decoded"],
                    )

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS_DDL if digests else TOKENS_DDL)
