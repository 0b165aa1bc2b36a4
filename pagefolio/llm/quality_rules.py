"""Quality rules as a cascade that stops at the first rule a document fails.

A document is kept if it passes every rule, so the order of the rules changes the cost and never
the verdict. The order is learned: on a bounded sample of documents each rule's time and share of
rejections are measured, and rules run by rejections per second, most first.

Null and empty texts have no words and fail ``few_words``.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefolio.llm.text import slices, words

SYMBOLS = re.compile(r"[#*$%&|<>]")
# A letter is a character of the Unicode category L (as \pL in SQL): not ½, ² or Ⅷ.
LETTER = regex.compile(r"\p{L}")
WINDOW = 8
# Documents on which costs are measured; it bounds the sample at every input size.
SAMPLE_ROWS = 400


class Measures:
    """What the rules look at, computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return words(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(SYMBOLS.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if words(line)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of eight words that occur twice or more, the first included."""
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        windows = list(zip(*(self.words[i:] for i in range(WINDOW)), strict=False))
        if len(set(windows)) == n:
            return 0
        first: dict[tuple, int] = {}
        starts = set()
        for i, window in enumerate(windows):
            j = first.setdefault(window, i)
            if j != i:
                starts.update((i, j))
        covered = end = 0
        for i in sorted(starts):
            covered += i + WINDOW - max(i, end)
            end = i + WINDOW
        return covered

    @cached_property
    def n_echoes(self) -> int:
        """Words equal to the word before them."""
        return sum(map(str.__eq__, self.words, self.words[1:]))

    @cached_property
    def n_lettered(self) -> int:
        """Words that hold a letter."""
        return sum(1 for word in self.words if LETTER.search(word))

    @cached_property
    def n_shouted(self) -> int:
        """Words of two or more characters whose letters are all capitals."""
        return sum(1 for word in self.words if len(word) > 1 and word.isupper())


# The rules by name; true means that the document fails.
RULES: dict[str, Callable[[Measures], bool]] = {
    "few_words": lambda m: m.n_words < 20,
    "repeated_windows": lambda m: 100 * m.n_repeat_words > 30 * m.n_words,
    "symbols": lambda m: 10 * m.n_symbols > 3 * m.n_words,
    "word_length": lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words,
    "repeated_lines": lambda m: 2 * m.n_dup_lines > len(m.lines),
    "echoes": lambda m: 10 * m.n_echoes > 3 * m.n_words,
    "no_letters": lambda m: 10 * m.n_lettered < 6 * m.n_words,
    "shouting": lambda m: 2 * m.n_shouted > m.n_words,
}
BASE_RULES = ("few_words", "repeated_windows")


def measured(docs: DataFrame, rules: Iterable[str], sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """``rule, seconds, rejected, seen`` of each rule on a sample of at most ``sample_rows``.

    The sample is the rows with the smallest hashes, so it is spread over the whole table.
    Each rule is timed on fresh measures, that is with what it needs and others may share.
    """
    names = list(rules)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name in names:
                begin = time.perf_counter()
                rejected = sum(RULES[name](Measures(text)) for text in frame["text"])
                rows.append((name, time.perf_counter() - begin, rejected, len(frame)))
            yield pd.DataFrame(rows, columns=["rule", "seconds", "rejected", "seen"])

    sample = docs.select("text").orderBy(F.xxhash64("text")).limit(sample_rows)
    stats = sample.mapInPandas(run, "rule string, seconds double, rejected long, seen long")
    return [row.asDict() for row in stats.groupBy("rule").agg(
        F.sum("seconds").alias("seconds"),
        F.sum("rejected").alias("rejected"),
        F.sum("seen").alias("seen"),
    ).collect()]


def cascade_order(stats: Iterable[dict], rules: Iterable[str]) -> list[str]:
    """Rules by rejections per second, most first; ties and unmeasured rules by name."""
    rate = {s["rule"]: s["rejected"] / max(s["seconds"], 1e-9) for s in stats}
    return sorted(rules, key=lambda name: (-rate.get(name, 0.0), name))


OUTPUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
OUTPUT_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean"
)


def passes(measures: Measures, order: list[str]) -> bool:
    return not any(RULES[name](measures) for name in order)


def quality_report(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Measures and verdict of every document, one row per row of ``docs``.

    Base failures are known from the measures and never reach the cascade of the other rules.
    """
    others = [name for name in RULES if name not in BASE_RULES]
    if order is None:
        order = cascade_order(measured(docs, others), others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc_id, text in zip(*(part.column(i).to_pylist() for i in (0, 1)), strict=True):
                    m = Measures(text)
                    failed = any(RULES[name](m) for name in BASE_RULES)
                    rows.append((
                        doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines,
                        m.n_repeat_words, failed, not failed and passes(m, order),
                    ))
                columns = zip(*rows, strict=True)
                yield pa.record_batch(
                    [pa.array(c, f.type) for c, f in zip(columns, OUTPUT, strict=True)], OUTPUT
                )

    return docs.select("doc_id", "text").mapInArrow(run, OUTPUT_DDL)


def kept_documents(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass every rule, with all their columns.

    Here nothing but the verdict is wanted, so all rules take part in the cascade and most
    rejected documents cost one or two of them.
    """
    if order is None:
        order = cascade_order(measured(docs, RULES), RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                yield part.filter(pa.array([passes(Measures(t), order) for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
