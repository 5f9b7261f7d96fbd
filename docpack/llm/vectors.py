"""Tables of vectors: which rows count, and blocks of them that numpy takes at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20


def whole(vector: str) -> Column:
    """Vectors that are there, are not empty and hold finite numbers only."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, finite), F.lit(False))


def usable(rows: DataFrame, vector: str, zero: bool = True) -> tuple[DataFrame, int, float]:
    """Rows with whole vectors of the table's dimension, that dimension, and the greatest squared length.

    The dimension is the commonest length (of those, the greatest); rows of other lengths are left out, as they have no product with
    the rest. ``zero=False`` leaves out vectors of zeros too. A table without vectors has dimension 0.
    """
    good = rows.where(whole(vector))
    square = F.aggregate(F.col(vector), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    good = good if zero else good.where(F.exists(F.col(vector), lambda x: x != 0))
    found = good.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"), F.max(square).alias("most")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not found:
        return good, 0, 0.0
    return good.where(F.size(vector) == found[0]["d"]), found[0]["d"], found[0]["most"]


def matrix(column: pa.ListArray) -> np.ndarray:
    """A column of vectors of one dimension, none null, as rows."""
    values = column.flatten()
    return values.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The same rows in tables of ``rows`` rows; the last has the rest."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held.append(part)
            n, batch = n + part.num_rows, batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def rows_a_block(dimension: int, most: int = 4096) -> int:
    return max(1, min(most, BLOCK_BYTES // (8 * max(dimension, 1))))


def first_block() -> int:
    """A number for the first block of this task: blocks of other tasks have others."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return (task.partitionId() if task else 0) << 32
