"""Text helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

# A word is a run of characters other than the six ASCII white space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Rows of a batch that are Python objects at the same time.
SLICE_ROWS = 256


def words(text: str | None) -> list[str]:
    """Words of a text; none of null."""
    return WORD.findall(text) if text else []


def lower_ascii(text: str) -> str:
    """``text`` with A to Z in lower case and all else as it is."""
    # str.lower is many times faster and agrees wherever there are no other capitals.
    return text.lower() if text.isascii() else text.translate(UPPER_TO_LOWER)


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that few of its texts are Python strings at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
