"""What the vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, not all zero, and has finite components only."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as the rows of a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def orthonormal(size: int, rows: int, seed: int) -> np.ndarray:
    """The first rows of a random rotation."""
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return (q * np.sign(np.diag(r))).T[:rows]


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal values in the first ``keys`` columns, one table for each run.

    The batches are sorted by those columns, which are whole numbers.
    """
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        starts = np.flatnonzero(np.r_[True, (columns[:, 1:] != columns[:, :-1]).any(axis=0)])
        if kept and any(kept[-1].column(i)[-1].as_py() != columns[i, 0] for i in range(keys)):
            yield pa.Table.from_batches(kept)
            kept = []
        ends = [*starts[1:], batch.num_rows]
        for a, b in zip(starts[:-1], ends[:-1]):
            yield pa.Table.from_batches([*kept, batch.slice(a, b - a)])
            kept = []
        kept.append(batch.slice(starts[-1], ends[-1] - starts[-1]))
    if kept:
        yield pa.Table.from_batches(kept)


def packs(batches: Iterator[pa.RecordBatch], keys: int, rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows in tables of about ``rows`` rows that divide no run of `runs`, with the number of each row's run."""
    kept: list[pa.RecordBatch] = []
    held, wanted = 0, rows

    def numbered(table: pa.Table) -> np.ndarray:
        columns = [table.column(i).to_numpy() for i in range(keys)]
        return np.cumsum(np.r_[0, np.any([c[1:] != c[:-1] for c in columns], axis=0)])

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        held += batch.num_rows
        if held < wanted:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        run = numbered(table)
        whole = int(np.searchsorted(run, run[-1]))  # the last run may go on
        if whole:
            yield table.slice(0, whole), run[:whole]
        kept = table.slice(whole).to_batches()
        held = table.num_rows - whole
        wanted = max(rows, 2 * held)
    if kept:
        table = pa.Table.from_batches(kept).combine_chunks()
        yield table, numbered(table)
