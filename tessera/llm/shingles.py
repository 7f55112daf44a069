"""Vectorised shingle hashes for Arrow batches: word hashes come from Spark
(``xxhash64``), numpy combines them. No loop over documents or words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.llm.text import lower_words

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: Column) -> Column:
    return F.transform(lower_words(text), lambda w: F.xxhash64(w))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every bit of ``x``."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values as uint64, offsets) of an Arrow list column; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    return values.view(np.uint64), offsets - offsets[0]


def row_chunks(offsets: np.ndarray, max_values: int, max_rows: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_rows`` rows and about ``max_values`` values
    (a longer row stands alone), so working memory is bounded by the longest
    document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_values, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + max_rows, n)
        yield lo, hi
        lo = hi


def shingles(values: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles in text order and their offsets
    by row. A row of fewer words (but at least one) has one shingle."""
    with np.errstate(over="ignore"):
        lengths = np.diff(offsets)
        count = np.where(lengths >= width, lengths - width + 1, (lengths > 0).astype(np.int64))
        out_offsets = np.concatenate([[0], np.cumsum(count)])
        row = np.repeat(np.arange(len(lengths)), count)
        start = offsets[:-1][row] + np.arange(out_offsets[-1]) - out_offsets[:-1][row]
        acc = np.zeros(len(start), np.uint64)
        short = lengths[row] < width
        for i in range(width):
            at = np.minimum(start + i, len(values) - 1)
            inside = ~short | (i < lengths[row])
            acc = np.where(inside, mix64(acc * GOLDEN + values[at] + np.uint64(i + 1)), acc) if len(acc) else acc
        return acc, out_offsets


def row_sets(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of each row's distinct hashes, sorted by row."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return row[first], hashes[first], np.diff(np.append(first, len(row)))


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
