import pytest
from pyspark.sql import functions as F

from docpack import session
from docpack.functions import names, predicates
from docpack.model import KEY
from docpack.operators import reshape, stats
from docpack.sources import formats


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("parts", [("index1", "test1", "https://www.google.de", "_source"), ("a b~*-_.!", "Jörg😀", "#%+/", None), ("", "x", None, "f")])
def test_entry_names_agree_with_the_source(spark, parts):
    got = one(spark, names.encode_entry_name(*[F.lit(p).cast("string") for p in parts]))
    assert got == formats.encode_name(*parts)
    back = spark.range(1).select(F.lit(got).alias("n")).select(*[c.alias(k) for k, c in names.decode_entry_name(F.col("n")).items()]).first()
    assert list(back) == [p or "null" for p in parts] == formats.decode_name(got)


def test_names_of_five_parts(spark):
    assert one(spark, names.decode_entry_name(F.lit("a/b/c/d/e"))["id"]) is None and formats.decode_name("a/b/c/d/e") is None
    assert formats.decode_name("a//b") == ["a", "b", None, None]


def test_uri_queries():
    with pytest.raises(ValueError, match="use a Column"):
        predicates.uri_query("a:b OR c")


def test_phrases(spark):
    assert one(spark, predicates.match_phrase(F.lit("Of, the\nWORLD"), "of THE world"))
    assert not one(spark, predicates.match_phrase(F.lit("often the world"), "of the"))


def test_types_by_index(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("c", "x")], "index string, type string")
    keep = rows.where(predicates.of_types(F.col("index"), F.col("type"), {"a": {"x"}, "b": set()}))
    assert sorted(map(tuple, keep.collect())) == [("a", "x"), ("b", "z")]


def test_rename_uses_old_names_for_types(spark):
    rows = spark.createDataFrame([("i", "t", "1"), ("i", "u", "2"), ("j", "t", "3")], "index string, type string, id string")
    spec = {"i": "new", "i/t": "first", "new/u": "wrong"}
    want = [("j", "t", "3"), ("new", "first", "1"), ("new", "u", "2")]
    assert sorted(map(tuple, reshape.rename(rows, spec).collect())) == want
    table = spark.createDataFrame(list(spec.items()), "key string, value string")
    assert sorted(map(tuple, reshape.rename_join(rows, table).collect())) == want


def test_other_fields_become_the_source(spark):
    packets = spark.createDataFrame([("i", "t", "1", f, p, k, "a") for k, (f, p) in enumerate([("_parent", "p"), (".hidden", "x"), ("title", "T"), ("_version", "4")])], "index string, type string, id string, field string, payload string, seq long, archive string")
    row = reshape.route_fields(reshape.assemble(reshape.coordinate_runs(packets))).first()
    assert (row["_parent"], row["_version"], row["_source"], row["fields"]) == ("p", 4, '{"title":"T"}', {"title": "T"})


def test_first_of_equal_versions_stays(spark):
    rows = spark.createDataFrame([("i", "t", "1", v, s) for v, s in ((1, 0), (3, 1), (3, 2), (2, 3))], "index string, type string, id string, _version long, seq long")
    assert [r["seq"] for r in reshape.highest_version(rows).collect()] == [1]


def test_rates(spark):
    log = spark.createDataFrame([(t, b) for t, b in ((0, 10), (0, 5), (3, 10), (3599, 7), (3602, 8))], "s long, bytes long").select(F.timestamp_seconds("s").alias("ts"), "bytes")
    assert {r["second"]: r["rate"] for r in stats.recent_rate(log).collect()} == {0: 3.0, 3: 5.0, 3599: 1.4, 3602: 3.0}
    assert stats.overall_rate(log.where("unix_timestamp(ts) = 0")).first()["rate"] == 15.0
    assert one(spark, stats.remaining_time(F.lit(100), F.lit(0), F.lit(0.0001))) == 0


def test_rotation_restarts_its_counter(spark):
    rows = spark.createDataFrame([("g", k, n) for k, n in enumerate([60, 50, 10, 100, 1, 5])], "g string, k long, n long")
    assert [r["part"] for r in stats.rotate_parts(rows, "g", "k", "n", 100).orderBy("k").collect()] == [0, 0, 1, 1, 2, 2]


def test_batches_across_ranges(spark):
    keys = [(g, f"{k:04d}") for g, n in (("a", 350), ("b", 7), (None, 20)) for k in range(n)]
    rows = spark.createDataFrame(keys, "index string, id string").repartition(5)
    found = {(r["index"], r["id"]): r["batch"] for r in stats.batch_numbers(rows, 10).collect()}
    assert found == {(g, k): int(k) // 10 for g, k in keys}
    assert stats.batch_numbers(rows.where("false"), 10).count() == 0


def test_cleaning_up(spark):
    kept = session.written(spark.range(3), "kept")
    path = session.run_folder(spark, "another")
    spark.range(3).write.parquet(f"{path}/x")
    assert session.clean_up(spark, "another") and not session.clean_up(spark, "another")
    assert kept.count() == 3


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "index string, type string, id string, field string, payload string, seq long, archive string")
    assert reshape.assemble(reshape.coordinate_runs(none)).count() == 0
    assert stats.export_summary(none).first()["packets"] == 0
    assert reshape.last_writer(none.select(*KEY, "seq")).count() == 0
