"""The store: layouts, versions, resharding, deltas, broken writes and the feed of changes."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from docpack.model import DOC
from docpack.model import struct as schema_of
from docpack.operators import store
from docpack.plans import jobs
from docpack.session import new_path
from docpack.streaming import streams


def table(spark, rows):
    """(id, version, source) of one index, or (index, id, version, source)."""
    rows = [r if len(r) == 4 else ("i", *r) for r in rows]
    return spark.createDataFrame([(i, "t", k, None, None, None, v, s, None) for i, k, v, s in rows], schema_of(DOC))


def state(spark, root, index="i"):
    rows = store.scan(spark, root, [index]).collect()
    found = {r["id"]: (r["_version"], r["_source"]) for r in rows}
    assert len(found) == len(rows)  # no id twice
    return found


def some(first, last, source, version=None):
    return [(str(k), version, source) for k in range(first, last)]


def test_linear_buckets():
    for old in range(1, 20):
        for h in range(500):
            assert 0 <= store.linear_bucket(h, old) < old
            if store.linear_bucket(h, old) != store.linear_bucket(h, old + 1):
                assert store.linear_bucket(h, old + 1) == old  # rows move into the new bucket only
        assert len({store.linear_bucket(h, old) for h in range(500) if store.linear_bucket(h, old + 1) == old}) == 1  # and from one
        for new in range(1, 20):
            moved = {store.linear_bucket(h, new) for h in range(2000) if store.linear_bucket(h, old) != store.linear_bucket(h, new)}
            assert moved <= store.changed_buckets(old, new) <= set(range(new))


def test_buckets_are_linear(spark):
    counts = {"a": 5, "b": 8, "c": 1}
    rows = table(spark, [(i, str(k), None, "") for i in "abcd" for k in range(60)])
    for r in store.bucketed(rows, counts).withColumn("h", F.hash("id")).collect():
        n = counts.get(r["index"], store.SHARDS)
        assert r["bucket"] == store.linear_bucket(r["h"], n)


@pytest.mark.parametrize("old, new", [(4, 7), (7, 4), (1, 6), (6, 1), (4, 5), (5, 5)])
def test_other_numbers_of_shards(spark, old, new):
    root = new_path(spark, "root")
    store.upsert(table(spark, [*some(0, 40, "a"), *[("j", str(k), None, "j") for k in range(9)]]), root, shards=old)
    store.append(table(spark, some(38, 44, "b")), root, "w", 0)
    store.upsert(table(spark, some(0, 3, "c")), root, shards=new)
    want = {str(k): (None, "c" if k < 3 else "a" if k < 38 else "b") for k in range(44)}
    assert state(spark, root) == want and len(state(spark, root, "j")) == 9
    assert store.layout(spark, root).counts == {"i": new, "j": old}
    for r in store.in_buckets(spark, root).withColumn("h", F.hash("id")).where("index = 'i'").collect():
        assert r["bucket"] == store.linear_bucket(r["h"], new)
    store.reshard(spark, root, {"i": old, "j": 2})
    assert state(spark, root) == want and store.layout(spark, root).counts == {"i": old, "j": 2}
    store.upsert(table(spark, some(43, 50, "d")), root)  # the layout's number stays
    assert state(spark, root) == want | {str(k): (None, "d") for k in range(43, 50)}


def test_one_more_shard_writes_two_buckets(spark):
    root = new_path(spark, "root")
    store.upsert(table(spark, some(0, 200, "a")), root, shards=8)
    store.reshard(spark, root, {"i": 9})
    own = store.layout(spark, root).buckets["i"]
    assert len(set(own.values())) == 2 and sorted(b for b, g in own.items() if g == max(own.values())) == ["0", "8"]


def test_settings_of_an_import_change_the_shards(spark):
    path, root = new_path(spark, "archive"), new_path(spark, "store")
    jobs.export(table(spark, some(0, 20, "{}")), path, "a.tar", meta=spark.createDataFrame([("i", "_settings", None, '{"index.number_of_shards":"4"}')], "index string, kind string, name string, body string"))
    jobs.import_(spark, path, root)
    jobs.import_(spark, path, root, settings={"i": '{"index.number_of_shards":"7"}'})
    assert len(state(spark, root)) == 20 and store.layout(spark, root).counts == {"i": 7}


def apply(now, doc):
    """What a store makes of one document after the other."""
    k, v, s = doc
    if k not in now or v is None or now[k][0] is None or v > now[k][0]:
        now[k] = (v, s)


@pytest.mark.parametrize("seed", range(3))
def test_versions_over_deltas_and_upserts(spark, seed):
    """Any sequence of writes gives what taking their documents one by one gives."""
    rng, root, now = random.Random(seed), new_path(spark, "root"), {}
    for n, step in enumerate(itertools.islice(itertools.cycle(["upsert", "append", "append", "compact", "append"]), 9)):
        docs = [(str(k), rng.choice([None, 1, 2, 3, 4]), f"{n}-{k}") for k in rng.sample(range(12), 6)]
        if step == "compact":
            store.compact(spark, root)
            assert not store.deltas(spark, root)
        else:
            if step == "append":
                store.append(table(spark, docs), root, "w", n, versions=True)
            else:
                store.upsert(table(spark, docs), root, versions=True)
            for d in docs:
                apply(now, d)
        assert state(spark, root) == now


def test_versions_in_one_write(spark):
    root, now = new_path(spark, "root"), {}
    docs = [(str(n % 3), v, str(n)) for n, v in enumerate([5, 1, None, 4, 3, 2, 7, 3, None, 6, 4, 2])]
    df = table(spark, docs).withColumn("_order", F.col("_source").cast("int"))
    store.append(df, root, "w", 0, "_order", versions=True)
    for d in docs:
        apply(now, d)
    assert state(spark, root) == now
    other = new_path(spark, "root")
    store.upsert(df, other, order="_order", versions=True)
    assert state(spark, other) == now


def test_pushes_and_pulls_keep_newer_versions(spark):
    root, remote = new_path(spark, "root"), new_path(spark, "remote")
    store.upsert(table(spark, [("1", 3, "a"), ("2", 9, "a"), ("3", 5, "a")]), root)
    store.upsert(table(spark, [("1", 5, "b"), ("2", 2, "b"), ("3", 5, "b"), ("4", 1, "b")]), remote)
    jobs.push(spark, root, remote, if_exists="warn")
    want = {"1": (5, "b"), "2": (9, "a"), "3": (5, "b"), "4": (1, "b")}
    assert state(spark, remote) == want
    jobs.pull(spark, remote, root, if_exists="warn")
    assert state(spark, root) == {"1": (5, "b"), "2": (9, "a"), "3": (5, "a"), "4": (1, "b")}


def test_streams_keep_newer_versions(spark):
    landing, root, points = new_path(spark, "landing"), new_path(spark, "store"), new_path(spark, "points")
    for n, docs in enumerate(([("1", 5, "5")], [("1", 2, "2"), ("2", 4, "4")], [("1", 6, "6"), ("2", 4, "again")])):
        jobs.export(table(spark, docs), landing, f"{n}.bulk")
        streams.import_stream(spark, landing, root, checkpoint=points).awaitTermination()
    assert state(spark, root) == {"1": (6, "6"), "2": (4, "4")}
    assert len(store.deltas(spark, root)) == 2


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_scan_with_a_small_delta_moves_no_stored_documents(spark):
    root = new_path(spark, "root")
    store.upsert(table(spark, some(0, 3000, "x" * 200)), root)
    store.append(table(spark, some(5, 9, "new")), root, "w", 0)
    found = store.scan(spark, root)
    assert sum(s == "new" for _, s in state(spark, root).values()) == 4
    # what is left of the stored documents after the anti-join goes straight to the union
    anti = next(x for x in plan(found).split("Union")[1:] if "LeftAnti" in x)
    branch = anti.split("LeftAnti")[0] + anti.split("LeftAnti")[1].split("BroadcastExchange")[0]
    assert "Exchange" not in branch and "BroadcastHashJoin" in plan(found)
    other = store.scan(spark, root, ["j"])
    assert "Exchange" not in plan(other) and other.count() == 0


def broken(*args, **kwargs):
    raise RuntimeError("lost")


@pytest.mark.parametrize("step", ["_put_change", "_put", "_commit", "recover"])
def test_a_broken_write_leaves_the_old_state_or_the_new(spark, monkeypatch, step):
    root = new_path(spark, "root")
    store.upsert(table(spark, some(0, 20, "old")), root)
    before = state(spark, root)
    after = before | {str(k): (None, "new") for k in range(10, 30)}
    for write in (lambda: store.upsert(table(spark, some(10, 30, "new")), root), lambda: store.append(table(spark, some(10, 30, "new")), root, "w", 0), lambda: store.reshard(spark, root, {"i": 9})):
        with monkeypatch.context() as m:
            m.setattr(store, step, broken)
            try:
                write()
            except RuntimeError:
                pass
        assert state(spark, root) in (before, after)
    store.upsert(table(spark, some(10, 30, "new")), root)
    assert state(spark, root) == after
    store.recover(spark, root)
    assert state(spark, root) == after and store.recover(spark, root) == 0


def test_files_of_writes_that_broke_off_are_swept(spark, monkeypatch):
    root = new_path(spark, "root")
    store.upsert(table(spark, some(0, 20, "old")), root)
    with monkeypatch.context() as m:
        m.setattr(store, "_commit", broken)
        with pytest.raises(RuntimeError):
            store.upsert(table(spark, some(0, 20, "new")), root)
    assert store.recover(spark, root) == 2  # its change and its generation
    assert state(spark, root) == {str(k): (None, "old") for k in range(20)}


def test_a_scan_can_be_read_while_one_more_write_goes_on(spark):
    root = new_path(spark, "root")
    store.upsert(table(spark, some(0, 20, "a")), root)
    found = store.scan(spark, root)
    store.upsert(table(spark, some(0, 20, "b")), root)
    assert {r["_source"] for r in found.collect()} == {"a"}


def test_a_copy_follows_changes(spark, monkeypatch):
    root, remote, points = new_path(spark, "root"), new_path(spark, "remote"), new_path(spark, "points")

    def follow():
        before = store.layout(spark, remote).seq
        streams.copy_stream(spark, root, remote, {"i": "k"}, points).awaitTermination()
        assert state(spark, remote, "k") == state(spark, root)
        return store.changes(spark, remote).where(F.col("_seq") > before).count()

    store.upsert(table(spark, some(0, 500, "a")), root)
    assert follow() == 500
    store.upsert(table(spark, some(100, 110, "b")), root)
    assert follow() == 10
    store.append(table(spark, some(105, 120, "c")), root, "w", 0)
    store.append(table(spark, some(110, 125, "d")), root, "w", 1)
    assert follow() == 20  # the last state of each key
    store.compact(spark, root)
    store.reshard(spark, root, {"i": 7})
    assert follow() == 0
    monkeypatch.setattr(store, "FEED", 1)
    store.upsert(table(spark, some(0, 5, "e")), root)
    store.upsert(table(spark, some(5, 9, "f")), root)
    assert follow() == 500  # changes that are no longer kept: the whole store


def test_odd_index_names(spark):
    root = new_path(spark, "root")
    names = ["a b", "ü/x", "c=d", "e%f", "g:h", "i*j"]
    for source in ("1", "2"):
        store.upsert(table(spark, [(n, "7", None, source) for n in names]), root)
    assert sorted((r["index"], r["_source"]) for r in store.scan(spark, root).collect()) == sorted((n, "2") for n in names)
    assert store.indices(spark, root) == sorted(names)
    remote = new_path(spark, "remote")
    path = new_path(spark, "archive")
    jobs.export(store.scan(spark, root), path, "a.tar")
    jobs.import_(spark, path, remote, with_metadata=False)
    copy = new_path(spark, "copy")
    streams.copy_stream(spark, remote, copy).awaitTermination()  # the import went straight to the buckets
    assert sorted(r["index"] for r in store.scan(spark, copy).collect()) == sorted(names)


def test_nothing_to_write(spark):
    root = new_path(spark, "root")
    store.upsert(table(spark, []), root)
    assert store.scan(spark, root).count() == 0 and store.indices(spark, root) == []
    store.append(table(spark, []), root, "w", 0)
    assert store.compact(spark, root) == 1 and store.scan(spark, root).count() == 0


def test_an_import_can_stay_a_delta(spark):
    root, path = new_path(spark, "root"), new_path(spark, "archive")
    jobs.export(table(spark, some(5, 30, "{}", 2)), path, "a.tar")
    for k in range(2):
        jobs.import_(spark, path, root, merge=False)
        assert len(store.deltas(spark, root)) == k  # the first load has nothing to be merged with
    gens = store.layout(spark, root).buckets
    store.upsert(table(spark, [("7", 1, "old"), ("8", 3, "new"), ("99", 1, "new")]), root, merge=False)
    assert store.layout(spark, root).buckets == gens and len(store.deltas(spark, root)) == 2
    want = {str(k): (2, "{}") for k in range(5, 30)} | {"8": (3, "new"), "99": (1, "new")}
    assert state(spark, root) == want
    store.compact(spark, root)
    assert state(spark, root) == want
