"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str) -> list[bytes]:
    """The matches of :data:`WORD`, as UTF-8 (``bytes.split`` knows exactly this white space)."""
    return text.encode().split()


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes at most in each.

    A single longer value gets a slice of its own. Memory then follows the bytes
    of text, not the number of rows.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Values of a text column; NULL counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; NULL for a NULL id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string")) % folds


def is_fold(doc_id: Column | str, folds: int, number: int) -> Column:
    """Whether an id is in a fold; false for a NULL id."""
    return F.coalesce(fold(doc_id, folds) == number, F.lit(False))


def thinned(df: DataFrame, key: Column | str, rows: int, limit: int, seed: int = 17) -> DataFrame:
    """A repeatable sample of about ``limit`` of the ``rows`` rows, chosen by a hash of ``key``.

    For fitting models only. The hash picks the rows where they are scanned: no sort,
    no shuffle. All rows stay when there are no more than ``limit``.
    """
    if rows <= limit:
        return df
    c = F.col(key) if isinstance(key, str) else key
    unit = F.xxhash64(c, F.lit(seed)).cast("double") / float(2**64) + 0.5
    return df.filter(unit < limit / rows)


def mix64(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit hashes (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))
