"""Counts, sizes and rates of transfers; byte-based parts; run logs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docpack.model import KEY
from docpack.session import written


def index_type_sets(docs: DataFrame) -> DataFrame:
    return docs.groupBy("index").agg(F.array_sort(F.collect_set("type")).alias("types"))


def export_summary(packets: DataFrame) -> DataFrame:
    return packets.agg(F.count("*").alias("packets"), F.countDistinct(*KEY).alias("docs"), F.sum(F.octet_length("payload")).cast("long").alias("bytes"))


def doc_count(docs: DataFrame, name: str = "docs") -> DataFrame:
    return docs.groupBy("index").agg(F.count("*").alias(name))


def bytes_per_second(log: DataFrame) -> DataFrame:
    """``second, bytes`` of a transfer log ``ts, bytes``."""
    return log.groupBy(F.unix_timestamp(F.date_trunc("second", "ts")).alias("second")).agg(F.sum("bytes").cast("long").alias("bytes"))


def overall_rate(log: DataFrame) -> DataFrame:
    """Total bytes by whole seconds since the earliest start; all of them where no second has passed."""
    took = F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))
    total = F.sum("bytes").cast("long")
    return log.agg(total.alias("bytes"), took.alias("seconds"), F.when(took == 0, total.cast("double")).otherwise(total / took).alias("rate"))


def remaining_time(planned: Column, done: Column, rate: Column) -> Column:
    """Whole seconds, rounded half up; 0 where nearly nothing moves."""
    return F.when(rate < 0.001, F.lit(0)).otherwise(F.floor((planned - done) / rate + 0.5)).cast("long")


def recent_rate(log: DataFrame, seconds: int = 5) -> DataFrame:
    """Bytes of the last seconds by their number, for each second with bytes.

    Seconds are dealt into stretches of an hour, with the last of the stretch before repeated, so no task holds the whole log.
    """
    per = bytes_per_second(log)
    stretch = F.floor(F.col("second") / 3600)
    late = F.floor((F.col("second") + seconds - 1) / 3600)
    dealt = per.withColumn("stretch", F.explode(F.array_distinct(F.array(stretch, late))))
    w = W.partitionBy("stretch").orderBy("second").rangeBetween(-(seconds - 1), 0)
    return dealt.withColumn("rate", F.sum("bytes").over(w) / F.lit(seconds)).where(stretch == F.col("stretch")).select("second", "bytes", "rate")


def sum_transfers(transfers: DataFrame) -> DataFrame:
    return transfers.agg(F.sum("planned").cast("long").alias("planned"), F.sum("done").cast("long").alias("done"))


def rotate_parts(rows: DataFrame, group: str, order: str, size: str, most: int) -> DataFrame:
    """``group, order, part``: another part begins after the bytes of a part exceed ``most``.

    The counter starts anew with each part, so this is a fold in order; the group is what one archive writer sees. Only
    the three columns travel.
    """

    def fold(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable")
        part, held, out = 0, 0, []
        for n in g[size].fillna(0):
            if held > most:
                part, held = part + 1, 0
            out.append(part)
            held += int(n)
        return g[[group, order]].assign(part=out)

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select(group, order, size).groupBy(group).applyInPandas(fold, f"`{group}` {types[group]}, `{order}` {types[order]}, part int")


def batch_numbers(rows: DataFrame, size: int = 1000, by: str = "index", order: str = "id") -> DataFrame:
    """Numbers of batches of ``size`` rows of each index, in order.

    Rows are dealt into ranges of (index, key), so that no task orders one index; a row's number is its place in its range
    after the index's rows of the ranges before.
    """
    dealt = written(rows.repartitionByRange(by, order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(F.col(by).alias("_by"), F.col("_range").alias("_at")).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_before", F.sum("_n").over(W.partitionBy("_by").orderBy("_at")) - F.col("_n"))  # as many rows as ranges and indices
    placed = dealt.join(counts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_at")))
    place = F.col("_before") + F.row_number().over(W.partitionBy(by, "_range").orderBy(order)) - 1
    return placed.withColumn("batch", F.floor(place / size).cast("long")).select(*rows.columns, "batch")


def active_runs(started: DataFrame, finished: DataFrame) -> DataFrame:
    """Started runs that no finished run equals in all its attributes."""
    same = [started[c].eqNullSafe(finished[c]) for c in started.columns]
    return started.join(finished, same, "left_anti")
