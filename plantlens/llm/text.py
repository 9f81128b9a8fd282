"""Tokens of raw UTF-8 text, as the operators define them.

Texts travel as Arrow binary, so splitting and A-Z lower-casing are byte
operations: ``bytes.split()`` cuts exactly at [\\x20\\x09-\\x0D] and
``bytes.lower()`` changes exactly A-Z.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

# A-Z to a-z; every other ASCII character but 0-9 and a-z to a space.
ITEM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
ITEM_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def raw(column: pa.Array) -> list[bytes]:
    """A string column as bytes; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def item_words(text: bytes) -> list[bytes]:
    """Lower-cased words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+."""
    return text.translate(ITEM_BYTES).split()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``size`` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.slice(start, stop - start)
