import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from docpack.llm import mixing, sharding
from tests.llm.helpers import all_null, awkward, nothing

SF = "/root/testdata/sf0.001"


def test_targets_are_shared_and_stop_at_three_times(spark):
    rows = mixing.op1_mixing(spark, SF).collect()
    total = sum(r["size"] for r in rows)
    by = {}
    taken = Counter()
    largest = Counter()
    for r in rows:
        key = (r["source_size"], r["target"])
        by[key] = key
        taken[key] += r["taken"]
        largest[key] = max(largest[key], r["size"])
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
    assert abs(sum(t for _, t in by) - total) < 1
    for size, target in by:
        assert target <= 3 * size + 1e-6
        assert abs(taken[size, target] - target) <= largest[size, target]


def test_mix_is_the_same_again_and_for_other_partitions(spark):
    first = sorted(map(tuple, mixing.op1_mixing(spark, SF).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        assert sorted(map(tuple, mixing.op1_mixing(spark, SF).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_the_cut_is_found_by_parting_ranges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = sorted(map(tuple, mixing.mix_sizes(docs).collect()))
    assert sorted(map(tuple, mixing.mix_sizes(docs, few=3).collect())) == first


def test_mix_of_awkward_tables(spark):
    docs = awkward(spark)
    out = mixing.mix_sizes(docs)
    assert out.count() == docs.count()
    assert {r["mix_size"] for r in out.where("key IN (2, 3)").collect()} == {0}
    assert mixing.mix_sizes(nothing(spark)).count() == 0 and mixing.mixed_rows(nothing(spark)).count() == 0
    assert [r["mix_copies"] for r in mixing.mix_sizes(all_null(spark)).collect()] == [0, 0, 0]
    clashing = docs.withColumns({c: F.lit(f"own {c}") for c in ("mix_note", "mix_hash", "row", "own", "last", "copies", "round")})
    rows = mixing.mixed_rows(clashing)
    assert rows.columns == clashing.columns and rows.count() == out.agg(F.sum("mix_copies")).first()[0]
    assert {(r["mix_size"], r["mix_note"], r["row"]) for r in rows.collect()} == {("own mix_size", "own mix_note", "own row")}


def test_rows_without_key_queue_by_their_texts(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("a b c d"), F.col("id")).alias("text"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"))
    rows = mixing.mix_sizes(docs).groupBy("mix_total", "mix_target").agg(F.sum(F.col("mix_copies") * F.col("mix_size")).alias("taken")).collect()
    assert len(rows) == 2 and all(abs(r["taken"] - r["mix_target"]) <= 5 for r in rows)


def test_a_flood_of_equal_rows_is_cut_inside(spark):
    flood = [(1, "a b c d e", "x", n) for n in range(600)] + [(k, "w " * 5, "y" if k % 2 else "z", k) for k in range(2, 302)]
    docs = spark.createDataFrame(flood, "doc_id long, text string, source string, note int").repartition(7)
    for seed in ("mix-0", "mix-1", "mix-2"):
        out = mixing.mix_sizes(docs, seed=seed)
        sources = out.groupBy("mix_total", "mix_target").agg(F.sum(F.col("mix_copies") * F.col("mix_size")).alias("taken"), F.max("mix_copies").alias("most")).collect()
        assert sum(r["taken"] for r in sources) > 0 and all(abs(r["taken"] - r["mix_target"]) <= 5 * max(1, len(sources)) and r["most"] <= 3 for r in sources), sources
        rows = mixing.mixed_rows(docs, seed=seed)
        assert rows.columns == docs.columns
        assert rows.where("doc_id = 1").count() == out.where("key = 1").agg(F.sum("mix_copies")).first()[0]
        assert rows.count() == out.agg(F.sum("mix_copies")).first()[0]
    again = sorted(map(tuple, mixing.mix_sizes(docs.repartition(3)).collect()))
    assert again == sorted(map(tuple, mixing.mix_sizes(docs).collect()))


def test_mixed_rows_in_order_of_finish(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = {r["key"]: r for r in mixing.mix_sizes(docs).collect()}
    seen, words = Counter(), defaultdict(int)
    last = 0.0
    for r in mixing.mixed_rows(docs, ordered=True).select("doc_id", "source").collect():
        own = sizes[r["doc_id"]]
        words[r["source"]] += own["mix_size"]
        finish = words[r["source"]] / own["mix_target"]
        assert finish >= last - 1e-9
        last = finish
        seen[r["doc_id"]] += 1
    assert seen == Counter({k: r["mix_copies"] for k, r in sizes.items() if r["mix_copies"]})


def h60(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:15], 16)


def test_shards_against_brute_force(spark):
    rows = sharding.op3_sharding(spark, SF).collect()
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    slots = defaultdict(list)
    for r in rows:
        draws = [-math.log((h60(str(r["doc_id"]), str(s)) + 0.5) / 2**60) for s in range(9)]
        assert r["shard"] == min(range(8), key=draws.__getitem__)
        assert r["grown_shard"] == min(range(9), key=draws.__getitem__) and r["grown_shard"] in (r["shard"], 8)
        assert r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["law"] == "key"
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(text)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_and_awkward_tables(spark):
    n = Counter(r["shard"] for r in sharding.shard(spark.range(4000).withColumnRenamed("id", "doc_id"), "doc_id", {0: 1.0, 1: 3.0, 2: 0.0}).collect())
    assert 0.65 < n[1] / 4000 < 0.85 and n[2] == 0
    out = sharding.shard(awkward(spark), "doc_id", 4, 5)
    assert out.count() == awkward(spark).count()
    assert out.where("doc_id IS NULL").select("shard").distinct().count() == 1
    assert sharding.shard(nothing(spark)).count() == 0


def test_rows_of_one_key_are_dealt_over_buckets(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").alias("note"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    out = sharding.shard(docs, "doc_id", 8, 9)
    rows = out.collect()
    assert len({r["shard"] for r in rows}) == 1 and sorted(r["slot"] for r in rows) == list(range(3000))
    order = [r["note"] for r in sorted(rows, key=lambda r: r["slot"])]
    assert order != sorted(order) and [r["slot"] for r in sharding.shard(docs.repartition(5), "doc_id", 8, 9).orderBy("note").collect()] == [r["slot"] for r in out.orderBy("note").collect()]
