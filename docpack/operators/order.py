"""The first rows of a table by the order of some columns, without bringing them to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpack.session import written


def first_rows(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by columns ``by`` (nulls first), in no order. Of rows that are equal in them at the cut some are taken.

    Only these columns are sorted, over ranges. Counts of ranges say in which one the cut lies, and that range says where: all rows
    up to that value are taken where they are. A range has about as many rows as others, but for rows that are equal.
    """
    if n <= 0:
        return rows.limit(0)
    place = F.struct(*by)
    keys = rows.select(*by)
    parts = max(8, keys.sparkSession.sparkContext.defaultParallelism * 4)
    dealt = written(keys.groupBy(*by).agg(F.count("*").alias("__n")).repartitionByRange(parts, *[F.asc_nulls_first(c) for c in by]).withColumn("__at", F.spark_partition_id()), "order-keys")
    counts = sorted((r["__at"], r["n"]) for r in dealt.groupBy("__at").agg(F.sum("__n").alias("n")).collect())  # one row for each range
    before = 0
    for at, own in counts:
        if before + own >= n:
            break
        before += own
    else:
        return rows
    return _up_to(rows, place, dealt.where(F.col("__at") == at), by, n - before)


def _up_to(rows: DataFrame, place, inside: DataFrame, by: list[str], n: int) -> DataFrame:
    """The rows before the value that the ``n``-th row of a range has, and as many of that value as are left to take."""
    from pyspark.sql import Window as W

    running = F.sum("__n").over(W.partitionBy("__at").orderBy(*[F.asc_nulls_first(c) for c in by]))
    last = inside.withColumn("__up_to", running).where((F.col("__up_to") >= n) & (F.col("__up_to") - F.col("__n") < n)).first()
    value = F.struct(*[F.lit(last[c]).cast(rows.schema[c].dataType).alias(c) for c in by])
    if last["__up_to"] == n:
        return rows.where(place <= value)
    return rows.where(place < value).unionByName(rows.where(place == value).limit(n - (last["__up_to"] - last["__n"])))
