"""Tokens attributed to the sections of a document by their character offsets.

A whole document is encoded once. Each token covers the characters its bytes come from, so
tokens that share one character overlap there. Sections are intervals of characters; here
the lines of a text, each with the line feed that ends it. A token belongs to the section it
overlaps most, on a tie to the earlier one; tokens that touch several sections are counted
as crossing for the one they are given to.

An empty or null text has one empty section without tokens. A text that ends in a line feed
has no section after it. Rows are independent, whatever repeats; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.llm.bpe import BytePairEncoder, encoder, vocabulary_text
from gustmill.llm.tables import text_of

SCHEMA = (
    "doc_id bigint, section bigint, start_char bigint, end_char bigint, "
    "n_tokens bigint, n_crossing bigint, doc_tokens bigint"
)
#: Rows that leave a task at a time.
ROWS_AT_ONCE = 20_000


def token_spans(bpe: BytePairEncoder, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """First character and end of every token, and the characters of the text."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    ids = np.frombuffer(bpe.encode_packed(text), dtype="<u4")
    ends = np.cumsum(bpe.widths[ids])
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    if not len(ids):
        none = np.zeros(0, dtype=np.int64)
        return none, none, len(text)
    begins = np.concatenate(([0], ends[:-1]))
    return character[begins], character[ends - 1] + 1, len(text)


def line_starts(text: str) -> np.ndarray:
    """First character of every line."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    starts = np.flatnonzero(points == 10) + 1
    return np.concatenate(([0], starts[starts < len(points)])).astype(np.int64)


def attribute(
    begins: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens given to each section, and those of them that touch another one too."""
    low = np.searchsorted(starts, begins, "right") - 1
    high = np.searchsorted(starts, ends - 1, "right") - 1
    owner = low.copy()
    crossing = np.flatnonzero(low != high)
    stops = np.append(starts[1:], length)
    for t in crossing.tolist():
        places = np.arange(low[t], high[t] + 1)
        shared = np.minimum(stops[places], ends[t]) - np.maximum(starts[places], begins[t])
        owner[t] = places[int(np.argmax(shared))]
    n = len(starts)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def section_token_counts(df: DataFrame, path: str) -> DataFrame:
    vocabulary = df.sparkSession.sparkContext.broadcast(vocabulary_text(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary.value)
        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def batch_of(parts: list[list]) -> pa.RecordBatch:
            ids = np.concatenate([np.full(len(p[1]), k) for k, p in enumerate(parts)])
            keys = pa.array([p[0] for p in parts], pa.int64()).take(pa.array(ids.astype(np.int64)))
            rest = [pa.array(np.concatenate([p[k] for p in parts]).astype(np.int64)) for k in range(1, 7)]
            return pa.record_batch([keys, *rest], names)

        for batch in batches:
            parts, rows = [], 0
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                begins, ends, length = token_spans(bpe, text)
                starts = line_starts(text)
                given, crossing = attribute(begins, ends, starts, length)
                n = len(starts)
                parts.append(
                    [key, np.arange(n), starts, np.append(starts[1:], length), given, crossing, np.full(n, len(begins))]
                )
                rows += n
                if rows >= ROWS_AT_ONCE:
                    yield batch_of(parts)
                    parts, rows = [], 0
            if parts:
                yield batch_of(parts)

    return df.select(F.col("doc_id").cast("bigint"), text_of().alias("text")).mapInArrow(work, SCHEMA)
