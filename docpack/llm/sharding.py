"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number from a hash of (record key, shard); a record goes to the shard whose number, weighed, is the
least. Another shard only adds one more draw, so records move into it or stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from docpack.llm.text import hash_bucket, key_hash
from docpack.session import spread


def rendezvous(key, shards: dict[int, float]):
    """The shard of a key: least ``-ln(u) / weight``, u from (0, 1) by a hash of key and shard. A null key is one key."""
    draws = [F.struct((-F.log((key_hash(key, str(s)) + 0.5) / float(1 << 60)) / F.lit(float(w))).alias("draw"), F.lit(s).alias("shard")) for s, w in shards.items() if w > 0]
    return draws[0]["shard"] if len(draws) == 1 else F.least(*draws)["shard"]


def shard(docs: DataFrame, key: str = "doc_id", shards: dict[int, float] | int = 8, grown: dict[int, float] | int | None = None) -> DataFrame:
    """``docs`` with ``shard``, ``slot`` (gapless from 0 in the shard, by a hash of the row) and ``grown_shard``.

    ``shards`` maps shard numbers to weights (a count means equal weights). Slots need no task that holds a whole shard:
    counts per (shard, hash bucket) say where each bucket's slots begin. Null keys are one key and so share a shard, but rows of one key
    are dealt over the buckets by their other columns (but maps), so a key with very many rows is no hot task unless the rows are equal too;
    an empty table gives an empty result; columns of these three names are replaced.
    """
    weighed = lambda x: dict.fromkeys(range(x), 1.0) if isinstance(x, int) else x
    docs = docs.drop("shard", "slot", "grown_shard")
    buckets = spread(docs.sparkSession)
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, MapType)])
    h = key_hash("slot", F.col(key), whole)
    dealt = docs.withColumns(
        {
            "shard": rendezvous(F.col(key), weighed(shards)),
            "grown_shard": rendezvous(F.col(key), weighed(grown)) if grown else F.lit(None).cast("int"),
            "__dp_hash": h,
            "__dp_bucket": hash_bucket(h, buckets),
        }
    )
    counts = dealt.groupBy("shard", "__dp_bucket").agg(F.count("*").alias("__dp_n"))
    before = W.partitionBy("shard").orderBy("__dp_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "__dp_bucket", F.coalesce(F.sum("__dp_n").over(before), F.lit(0)).alias("__dp_start"))
    own = W.partitionBy("shard", "__dp_bucket").orderBy("__dp_hash", F.col(key).cast("string"))
    placed = dealt.join(starts, ["shard", "__dp_bucket"]).withColumn("slot", F.col("__dp_start") + F.row_number().over(own) - 1)
    return placed.select(*docs.columns, "shard", "slot", "grown_shard")


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return shard(light, "doc_id", 8, 9).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
