"""Split archives, manifests that are swapped, counted lines, logs of streams and of runs, and the first n rows."""

import bz2
import datetime
import glob
import gzip
import io
import json
import lzma
import os
import pickle
import random
import struct
import tarfile
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from docpack.model import DOC, KEY
from docpack.model import struct as schema_of
from docpack.operators import order, store
from docpack.plans import jobs
from docpack.session import new_path
from docpack.sources import archive, codecs, formats
from docpack.streaming import streams


def local(path):
    return archive.file_system(path)[1]


def table(spark, rows):
    return spark.createDataFrame([(i, t, k, None, None, None, None, s, {"note": f"n {k}"}) for i, t, k, s in rows], schema_of(DOC))


def some(n, source="{}"):
    return [(f"i{k % 3}", f"t{k % 2}", f"{k:05d}", source) for k in range(n)]


def write_file(spark, name, data):
    path = local(new_path(spark, "written"))
    os.makedirs(path)
    with open(f"{path}/{name}", "wb") as f:
        f.write(data)
    return path


# -- one file read by many tasks


@pytest.mark.parametrize("kind", ["tar", "cpio", "bulk"])
@pytest.mark.parametrize("codec", ["", "gz", "bz2", "xz", "lzf"])
def test_one_file_is_read_by_many_tasks(spark, kind, codec):
    path, name = new_path(spark, "split"), f"a.{kind}" + (f".{codec}" if codec else "")
    rnd = random.Random(1)
    rows = [(i, t, k, json.dumps({"x": rnd.randbytes(150).hex()})) for i, t, k, _ in some(900)]
    archive.register(spark)
    packets = jobs.packets_of(table(spark, rows).coalesce(1), name).select(*archive.WRITTEN).withColumns({"seq": F.lit(0).cast("long"), "archive": F.lit(""), "part": F.lit(0)})
    packets.sortWithinPartitions(*KEY, "field").write.format("docpack_archive").option("name", name).option("memberBytes", 20_000).mode("append").save(path)
    assert [x.name for x in archive.found(path)] == [name]
    got = jobs.read_packets(spark, path, splitBytes=30_000)
    assert got.rdd.getNumPartitions() > 3
    read = sorted((r["index"], r["type"], r["id"], r["field"], r["payload"], r["seq"]) for r in got.collect())
    whole = sorted((r["index"], r["type"], r["id"], r["field"], r["payload"], r["seq"]) for r in jobs.read_packets(spark, path).collect())
    assert read == whole and len({r[5] for r in read}) == len(read) == (900 if kind == "bulk" else 1800)
    assert sorted(r[:3] + (r[4],) for r in read if r[3] == "_source") == sorted(rows)
    docs = jobs.read_packets(spark, path, splitBytes=30_000, documents=True)
    assert docs.count() == 900 and docs.select("run").distinct().count() == 900  # no document was cut
    # other tools take all members as one
    with open(archive.found(path)[0].path, "rb") as f:
        data = {"": lambda x: x, "gz": gzip.decompress, "bz2": bz2.decompress, "xz": lzma.decompress, "lzf": lambda x: codecs.reader(io.BytesIO(x), "lzf").read()}[codec](f.read())
    if kind == "tar":
        with tarfile.open(fileobj=io.BytesIO(data)) as tar:
            assert len(tar.getnames()) == 1800
    elif kind == "bulk":
        assert data.count(b"\n") == 1800


def test_filters_skip_stretches_of_a_part(spark, monkeypatch):
    path = new_path(spark, "prune")
    rows = [("i", f"t{k // 500}", f"{k:05d}", "x" * 500) for k in range(2000)]
    packets = jobs.packets_of(table(spark, rows), "p.tar.gz").select(*archive.WRITTEN).withColumns({"seq": F.lit(0).cast("long"), "archive": F.lit(""), "part": F.lit(0)})
    archive.register(spark)
    packets.coalesce(1).sortWithinPartitions(*KEY).write.format("docpack_archive").option("name", "p.tar.gz").option("memberBytes", 50_000).mode("append").save(path)
    spans = []
    own = archive.Stretch.__init__
    monkeypatch.setattr(archive.Stretch, "__init__", lambda self, raw, a, b: (spans.append(b - a), own(self, raw, a, b))[1])

    def read(**wanted):
        spans.clear()
        reader = archive.Reader({"path": path})
        reader.wanted = {k: set(v) for k, v in wanted.items()}
        return sum(b.num_rows for p in reader.partitions() for b in reader.read(p))

    size = archive.found(path)[0].size
    assert read() == 4000 and not spans
    assert read(type=["t2"]) == 1000 and sum(spans) < 0.35 * size
    assert read(id=["01234"]) == 2 and sum(spans) < 0.1 * size
    assert read(id=["00001", "01999"]) == 4 and len(spans) == 2
    assert read(id=["none"], type=["t1"]) == 0 and sum(spans) < 0.35 * size
    assert read(index=["j"]) == 0 and not spans
    assert jobs.read_packets(spark, path).where("type = 't2' AND id IN ('01234', '00001')").count() == 2


def test_places_of_many_values():
    places = archive.Places()
    places.begin(0, 0)
    for k in range(100):
        places.add(("i", f"t{k % 16}", f"{k:03d}"))
    row = places.rows[0]
    may = lambda **w: archive.may_have(row, {k: {v} for k, v in w.items()})
    assert may(index="i", type="t3", id="050") and not may(index="j") and not may(type="t16") and not may(id="1000") and may(id="0505")
    assert json.loads(json.dumps(row)) == row


# -- bulk files of others


ACTION = b'{"index":{"_index":"i","_type":"t","_id":"%d"}}\n'


@pytest.mark.parametrize("end", [b"", b"\n", ACTION % 7])
def test_lines_are_told_by_their_number(spark, end):
    """Payloads that look like actions, blank actions, empty payloads, and cuts at every place."""
    payload = [b"{}", ACTION[:-1] % 5, b"", b'{"index":{"_index":"no","_type":"no","_id":"no"}}' * 3]
    data = b"".join((b"  \n" if k % 11 == 0 else ACTION % k) + payload[k % 4] + b"\n" for k in range(60)) + end
    path = write_file(spark, "b.bulk", data)
    key = lambda rows: sorted((int(r["id"]), r["seq"], r["payload"]) for r in rows)
    want = key(jobs.read_packets(spark, path, splitBytes=1 << 30).collect())
    assert [w[0] for w in want] == [k for k in range(60) if k % 11]
    for per in (37, 101, 512, 1999):
        lines, n = [], 0
        for a, b in archive.byte_ranges(len(data), per):
            lines.append((a, b, n))
            n += archive.line_ends(f"{path}/b.bulk", a, b)
        reader = archive.Reader({"path": path, "spans": json.dumps({"b.bulk": lines})})
        rows = [r for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
        assert key([r | {"seq": w[1]} for r, w in zip(sorted(rows, key=lambda r: int(r["id"])), want, strict=True)]) == want
    got = jobs.read_packets(spark, path, splitBytes=300)
    assert got.rdd.getNumPartitions() > 5 and [(a, c) for a, _, c in key(got.collect())] == [(a, c) for a, _, c in want]


# -- tar files of others


def foreign_tar(fmt, rnd, n=120):
    """Long names, directories, links, an embedded tar, contents of whole blocks, and payloads larger than a range."""
    inner = io.BytesIO()
    with tarfile.open(fileobj=inner, mode="w") as t:
        for k in range(5):
            info = tarfile.TarInfo(f"i/t/inner{k}/_source")
            info.size = 600
            t.addfile(info, io.BytesIO(b"i" * 600))
    raw, want = io.BytesIO(), []
    with tarfile.open(fileobj=raw, mode="w", format=fmt) as t:
        for k in range(n):
            data = rnd.choice([b"", b"x" * 512, b"{}", b"y" * rnd.randrange(4000), inner.getvalue(), b"z" * 9000])
            info = tarfile.TarInfo(f"i/t/{k:03d}{'n' * rnd.choice([0, 0, 150 if fmt != tarfile.USTAR_FORMAT else 60])}{rnd.choice(['', 'ü'])}/_source")
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
            want.append((info.name.split("/")[2], data.decode()))
            if k % 9 == 0:
                t.addfile(directory := tarfile.TarInfo(f"i/t{k}"))
                directory.type = tarfile.DIRTYPE
                link = tarfile.TarInfo(f"i/t/link{k}")
                link.type, link.linkname, link.size = tarfile.SYMTYPE, "elsewhere", 7
                t.addfile(link)
    return raw.getvalue(), want


@pytest.mark.parametrize("fmt", [tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT])
@pytest.mark.parametrize("per", [512, 2048, 5120, 20_000])
def test_foreign_tar_files_are_read_by_ranges(spark, fmt, per):
    data, want = foreign_tar(fmt, random.Random(per))
    path = write_file(spark, "f.tar", data)
    whole = [(n, p) for n, p in formats.read_tar(io.BytesIO(data))]
    per += -per % 512
    rows = []
    for a, b in archive.byte_ranges(len(data), per):
        links = formats.tar_links(io.BytesIO(data), a, b)
        rows.append(("f.tar", a, b, *(x.tobytes() for x in links)))
    spans = jobs._tar_spans(spark.createDataFrame(rows, "name string, a long, b long, places binary, exits binary, files binary").orderBy("a"))
    assert len(spans["f.tar"]) > 3
    reader = archive.Reader({"path": path, "spans": json.dumps(spans)})
    got = [r for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
    assert [(f"{r['index']}/{r['type']}/{r['id']}/{r['field']}", r["payload"].encode()) for r in got if r["field"]] == [(n, d) for n, d in whole if n.count("/") == 3]
    assert [r["seq"] for r in got] == list(range(len(whole)))
    assert sorted((r["id"], r["payload"]) for r in got if r["field"]) == sorted(want)


def test_foreign_tar_through_jobs_and_a_damaged_one(spark):
    data, want = foreign_tar(tarfile.GNU_FORMAT, random.Random(4))
    path = write_file(spark, "f.tar", data)
    got = jobs.read_packets(spark, path, splitBytes=20_000)
    assert got.rdd.getNumPartitions() > 5
    assert sorted((r["id"], r["payload"]) for r in got.where("field = '_source'").collect()) == sorted(want)
    damaged = bytearray(data)
    step = formats.tar_step(data[:512])[1]
    damaged[step + 10] ^= 1  # the second header's sum is wrong
    path = write_file(spark, "d.tar", bytes(damaged))
    assert jobs._spans(spark, path, 20_000) == {}


# -- replacing


@pytest.mark.parametrize("step", ["write", "_swap", "_name", "_sweep"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_broken_overwrite_leaves_the_old_archive_or_the_new(spark, monkeypatch, step, when):
    """Parts as tasks leave them, committed here, where the commit can be broken."""
    path = new_path(spark, "swap")

    def put(rows, broken):
        writer = archive.Writer({"path": path, "name": "a.tar.gz", "maxBytes": "300"}, True)
        batch = archive.pa.RecordBatch.from_pylist([{"index": i, "type": t, "id": k, "field": "_source", "payload": s, "meta": None} for i, t, k, s in rows], archive.pa.schema([archive.ARROW.field(n) for n in archive.WRITTEN]))
        messages = [writer.write(iter([batch]))]
        if broken and step == "write":
            return
        if broken:
            own = getattr(writer, step)

            def lost(*args):
                if when == "after":
                    own(*args)
                raise RuntimeError("lost")

            monkeypatch.setattr(writer, step, lost)
        writer.commit(messages)

    old, new = some(30, "old " * 20), some(20, "new " * 20)
    put(old, False)
    state = lambda: sorted((r["id"], r["payload"]) for r in jobs.read_packets(spark, path).collect())
    want = lambda rows: sorted((k, s) for _, _, k, s in rows)
    assert state() == want(old) and len(archive.found(path)) > 5
    try:
        put(new, True)
    except RuntimeError:
        pass
    assert state() == want(old if step == "write" or (step, when) == ("_swap", "before") else new)
    put(new[:7], False)
    assert state() == want(new[:7])
    names = {os.path.basename(x) for x in glob.glob(f"{local(path)}/*")}
    live = archive.found(path)
    assert {n for n in names if not n.startswith("_summary")} == {x.name for x in live} | {os.path.basename(x.index) for x in live} | {"_manifest-a.tar.gz.json"}


def test_a_first_write_shows_all_parts_or_none(spark, monkeypatch):
    path = new_path(spark, "first")
    monkeypatch.setattr(archive.Writer, "_name", lambda *a: None)  # before any part has its name
    writer = archive.Writer({"path": path, "name": "a.bulk", "maxBytes": "100"}, False)
    batch = archive.pa.RecordBatch.from_pylist([{"index": "i", "type": "t", "id": str(k), "field": "_source", "payload": "{}", "meta": None} for k in range(9)], archive.pa.schema([archive.ARROW.field(n) for n in archive.WRITTEN]))
    message = writer.write(iter([batch]))
    assert archive.found(path) == []
    writer.commit([message])
    assert jobs.read_packets(spark, path).count() == 9 and len(archive.found(path)) == 3
    assert jobs.read_packets(spark, f"{path}/1.a.bulk").count() > 0
    assert jobs.read_packets(spark, f"{path}/*a.bulk").count() == 9


def test_a_lost_part_is_told_and_a_removed_archive_is_gone(spark):
    path = new_path(spark, "lost")
    jobs.export(table(spark, some(50)).coalesce(1), path, "a.tar", max_bytes=200)
    os.remove(archive.found(path)[1].path)
    with pytest.raises(Exception, match="gone"):
        jobs.read_packets(spark, path).count()
    for f in glob.glob(f"{local(path)}/*a.tar"):
        os.remove(f)
    assert archive.found(path) == []
    jobs.export(table(spark, some(5)), path, "a.tar")
    assert jobs.read_packets(spark, path).where("field = '_source'").count() == 5


def test_cpio_names_occur_once(spark):
    rows = table(spark, [*some(40), *some(40)]).repartition(1)
    with pytest.raises(Exception, match="already"):
        jobs.export(rows, new_path(spark, "cpio"), "a.cpio", parts=1)
    assert "names" not in vars(formats.CpioWriter(io.BytesIO()))


# -- streams


def test_a_stream_takes_so_many_files_a_batch_and_goes_on_after_a_restart(spark):
    landing, root, points = new_path(spark, "landing"), new_path(spark, "store"), new_path(spark, "points")

    def run():
        q = streams.import_stream(spark, landing, root, checkpoint=points, max_files=3)
        q.awaitTermination()
        return sorted(int(r["id"]) for r in store.scan(spark, root).select("id").collect())

    for k in range(7):
        jobs.export(table(spark, [("i", "t", str(k), "{}")]), landing, f"{k}.bulk")
    assert [len(run()) for _ in range(4)] == [3, 6, 7, 7]
    jobs.export(table(spark, [("i", "t", "70", "{}")]), landing, "0a.bulk")
    assert run() == [*range(7), 70]
    offsets = sorted(glob.glob(f"{local(points)}/offsets/[0-9]*"), key=lambda x: int(os.path.basename(x)))
    with open(offsets[-1]) as f:
        assert json.loads(f.read().splitlines()[-1]) == {"n": 8}


def test_log_of_files(spark):
    path = local(new_path(spark, "log"))
    log = archive.FileLog(path)
    for k in range(40):
        assert log.take([f"{k}-{j}" for j in range(3)]) == 3 * k + 3
    assert len(glob.glob(f"{path}/*.json")) <= log.JOINED
    again = archive.FileLog(path)
    assert again.names == log.names == [f"{k}-{j}" for k in range(40) for j in range(3)]
    # a joined file beside those it was joined from
    with open(f"{path}/{0:012d}-{6:012d}.json", "w") as f:
        json.dump(log.names[:6], f)
    assert archive.FileLog(path).names == log.names


def test_names_taken_by_a_run_that_broke_off_are_read(spark):
    landing, path = new_path(spark, "landing"), new_path(spark, "log")
    for k in range(4):
        jobs.export(table(spark, [("i", "t", str(k), "{}")]), landing, f"{k}.bulk")
    options = {"path": landing, "log": path, "maxFiles": "2"}
    assert archive.StreamReader(options).latestOffset() == {"n": 2}  # and its offset was lost
    reader = archive.StreamReader(options)
    end = reader.latestOffset()
    assert end == {"n": 4} and len(reader.partitions({"n": 0}, end)) == 4
    assert pickle.loads(pickle.dumps(reader)).log is None  # names do not travel with tasks
    replay = archive.StreamReader(options)
    assert [x.name for x in replay.partitions({"n": 1}, {"n": 3})] == ["1.bulk", "2.bulk"] and replay.partitions({"n": 4}, {"n": 4}) == []


def test_a_copy_takes_so_many_changes_a_batch(spark):
    root, remote, points = new_path(spark, "root"), new_path(spark, "remote"), new_path(spark, "points")
    for k in range(5):
        store.upsert(table(spark, [("i", "t", str(k), "{}")]), root)
    counts = []
    for _ in range(4):
        streams.copy_stream(spark, root, remote, checkpoint=points, changes_per_batch=2).awaitTermination()
        counts.append(store.scan(spark, remote).count())
    assert counts == [2, 4, 5, 5]


# -- runs


def test_runs_are_active_until_they_end_or_are_silent(spark):
    path = new_path(spark, "runs")
    seen = lambda silent="2 minutes": [r["mode"] for r in jobs.active_runs(spark, path, silent).collect()]
    with jobs.Run(path, "export", "x", beat=0.2) as run:
        time.sleep(1)
        assert seen() == ["export"] and jobs.run_events(spark, path).where("event = 'beat'").count() >= 2
        run.counted(3, {"a": 1})
    assert seen() == [] and [(r["docs"], r["detail"]) for r in jobs.runs(spark, path).collect()] == [(3, '{"a": 1}')]
    assert jobs.run_events(spark, path).count() == 2
    with pytest.raises(ValueError), jobs.Run(path, "import", "y"):
        raise ValueError("no")
    assert seen() == [] and jobs.runs(spark, path).count() == 1
    dead = jobs.Run(path, "copy", "z")
    dead._tell("started")  # and its driver dies
    assert seen() == ["copy"]
    time.sleep(2)
    assert seen("1 second") == []


def test_watched_runs_close_when_silent(spark):
    path, out = new_path(spark, "runs"), new_path(spark, "watched")
    jobs.Run(path, "copy", "dead")._tell("started")
    with jobs.Run(path, "export", "done"):
        pass
    q = streams.watch_runs(spark, path, out, silent_seconds=4, every="1 second")
    try:
        end, found = time.time() + 60, {}
        going = False
        while time.time() < end and found.get("copy") != "silent":
            time.sleep(1)
            if glob.glob(f"{local(out)}/batch=*/*.parquet"):
                found = {r["mode"]: r["state"] for r in streams.watched_runs(spark, out).collect()}
                going |= found.get("copy") == "running"
        assert found == {"copy": "silent", "export": "finished"} and going
    finally:
        q.stop()


# -- the first n


@pytest.mark.parametrize("n", [0, 1, 7, 500, 999, 1000, 1001, 5000])
def test_first_rows(spark, n):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.randrange(400), "x") for _ in range(1000)]
    got = order.first_rows(spark.createDataFrame(rows, "k string, v int, p string").repartition(6), ["k", "v"], n)
    place = lambda r: (r[0] is not None, r[0] or "", r[1])
    assert sorted((place(r) for r in got.collect())) == sorted(map(place, rows))[:n]


def test_first_rows_of_equal_rows_and_without_a_single_task(spark):
    rows = spark.range(3000).selectExpr("'k' AS k", "id % 2 AS v")
    assert order.first_rows(rows, ["k"], 1200).count() == 1200
    ids = spark.range(4000).selectExpr("id", "cast(id AS string) AS text")
    first = order.first_rows(ids, ["id"], 2500)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "Exchange" not in plan and first.count() == 2500 and first.agg(F.max("id")).first()[0] == 2499


def test_times_of_runs(spark):
    path = new_path(spark, "times")
    jobs.export(table(spark, some(3)), path, "a.bulk")
    r = jobs.runs(spark, path).first()
    assert r["mode"] == "export" and r["docs"] == 3 and datetime.timedelta(0) <= r["finished"] - r["started"] < datetime.timedelta(minutes=5)


# -- metadata, compressed zips, batches


def test_mappings_are_wrapped_in_archives_and_not_in_stores(spark):
    body = '{"properties":{"n":{"type":"string"}}}'
    meta = spark.createDataFrame([("i", "_mapping", "t", body), ("i", "_mapping", "u", '{"u":' + body + "}"), ("i", "_settings", None, "{}")], "index string, kind string, name string, body string")
    path, root = new_path(spark, "meta"), new_path(spark, "root")
    jobs.export(table(spark, some(3)), path, "a.tar", meta=meta)
    raw = {r["type"]: r["payload"] for r in jobs.read_packets(spark, path).where("id = '_mapping'").collect()}
    assert raw == {t: f'{{"{t}":{body}}}' for t in "tu"}
    jobs.import_(spark, path, root, rename={"i/t": "v"})
    assert {r["name"]: r["body"] for r in store.metadata(spark, root, kinds=["_mapping"]).collect()} == {"v": body, "u": body}


@pytest.mark.parametrize("seekable", [True, False])
def test_zip_without_a_directory(seekable):
    raw = io.BytesIO()
    entries = [("i/t/1/_source", b"{}" * 40_000, zipfile.ZIP_DEFLATED), ("i/t/2/_source", b"", zipfile.ZIP_DEFLATED), ("i/t/ü/_source", bytes(range(256)) * 900, zipfile.ZIP_DEFLATED), ("i/", b"", zipfile.ZIP_STORED)]
    entries += [("i/t/3/_source", b"PK\x03\x04 stored", zipfile.ZIP_STORED)] * seekable  # its size can stand before it
    with zipfile.ZipFile(raw if seekable else formats.Forward(raw), "w") as z:
        for name, data, method in entries if seekable else entries[:3]:
            z.writestr(zipfile.ZipInfo(name), data, method)
    want = [(n, d) for n, d, _ in (entries if seekable else entries[:3]) if not n.endswith("/")]
    assert list(formats.read_zip_forward(io.BytesIO(raw.getvalue()))) == want
    with pytest.raises((EOFError, ValueError)):
        list(formats.read_zip_forward(io.BytesIO(raw.getvalue()[: len(raw.getvalue()) // 2])))
    damaged = bytearray(raw.getvalue())
    damaged[60] ^= 255
    with pytest.raises(Exception):  # noqa: B017
        list(formats.read_zip_forward(io.BytesIO(bytes(damaged))))


def test_zip_with_sizes_of_eight_bytes():
    raw = io.BytesIO()
    with zipfile.ZipFile(formats.Forward(raw), "w") as z:
        for k in range(3):
            info = zipfile.ZipInfo(f"i/t/{k}/_source")
            info.compress_type = zipfile.ZIP_DEFLATED
            with z.open(info, "w", force_zip64=k != 1) as f:
                f.write(b"x" * (k * 1000))
    assert list(formats.read_zip_forward(io.BytesIO(raw.getvalue()))) == [(f"i/t/{k}/_source", b"x" * (k * 1000)) for k in range(3)]


def test_batches_and_tasks_of_an_import(spark):
    path, root = new_path(spark, "batches"), new_path(spark, "root")
    jobs.export(table(spark, some(50)).repartition(5), path, "a.tar", parts=5)
    reader = archive.Reader({"path": path, "documents": "true", "batchSize": "3"})
    assert all(b.num_rows <= 3 for p in reader.partitions() for b in reader.read(p))
    jobs.import_(spark, path, root, batch_size=7, concurrency=2)
    assert store.scan(spark, root).count() == 50
    remote = new_path(spark, "remote")
    jobs.push(spark, root, remote, concurrency=1)
    assert store.scan(spark, remote).count() == 50


def test_zip_parts_are_read_by_ranges_and_keep_no_directory_in_memory(spark, monkeypatch):
    rows = [(i, t, k, json.dumps({"x": "é" * (int(k) % 90)})) for i, t, k, _ in some(70_000)]
    raw, packets = io.BytesIO(), [dict(zip(("index", "type", "id", "field", "payload"), (i, t, k, "_source", s), strict=True)) for i, t, k, s in rows]
    w = formats.ZipWriter(raw)
    held = [w.add(p) for p in packets] and {k: v for k, v in vars(w).items() if isinstance(v, list | dict | bytes | bytearray)}
    assert not held
    w.close()
    with zipfile.ZipFile(raw) as z:  # more entries than two bytes can count
        assert z.testzip() is None and [(x.filename, z.read(x).decode()) for x in z.infolist()] == [("/".join((i, t, k, "_source")), s) for i, t, k, s in rows]
    path = new_path(spark, "zip")
    archive.register(spark)
    table(spark, rows[:900]).coalesce(1).select(*KEY, F.lit("_source").alias("field"), F.col("_source").alias("payload"), F.lit(None).cast("map<string,string>").alias("meta"), F.lit(0).cast("long").alias("seq"), F.lit("").alias("archive"), F.lit(0).alias("part")).write.format("docpack_archive").option("name", "a.zip").option("memberBytes", 20_000).mode("append").save(path)
    monkeypatch.setattr(formats, "zip_slices", None)
    got = jobs.read_packets(spark, path, splitBytes=10_000)
    assert got.rdd.getNumPartitions() > 3
    assert sorted((r["index"], r["type"], r["id"], r["payload"]) for r in got.collect()) == sorted(rows[:900])


def test_zip_places_beyond_four_bytes(monkeypatch):
    raw = io.BytesIO()
    monkeypatch.setattr(formats.ZipWriter, "MOST", 300)  # any reader takes places from the longer field where the short one is full
    w = formats.ZipWriter(raw)
    for k in range(3):
        w.add({"index": "i", "type": "t", "id": str(k), "field": "_source", "payload": "{}"})
    w.close()
    assert raw.getvalue().count(b"PK\x06\x06") == 0
    w = formats.ZipWriter(raw2 := io.BytesIO())
    for k in range(20):
        w.add({"index": "i", "type": "t", "id": str(k), "field": "_source", "payload": "{}"})
    w.close()
    assert raw2.getvalue().count(b"PK\x06\x06") == 1 and raw2.getvalue().count(struct.pack("<2H", 1, 8)) >= 10


@pytest.mark.parametrize("fmt", [tarfile.GNU_FORMAT, tarfile.PAX_FORMAT, tarfile.USTAR_FORMAT])
def test_tar_as_tarfile_reads_it(fmt, monkeypatch):
    rnd, raw = random.Random(3), io.BytesIO()
    want = []
    with tarfile.open(fileobj=raw, mode="w", format=fmt) as tar:
        for k in range(60):
            name = "/".join(("i", "t", "x" * (90 if k % 20 == 19 else 3), f"{k}"))
            info, data = tarfile.TarInfo(("d/" * 30 if k == 40 else "") + name), rnd.randbytes(rnd.choice([0, 5, 512, 700, 30_000]))
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
            want.append((info.name, data))
    assert list(formats.read_tar(io.BytesIO(raw.getvalue()))) == want
    with pytest.raises(tarfile.ReadError):
        list(formats.read_tar(io.BytesIO(raw.getvalue()[: 512 * 8 + 100])))


def test_plain_tar_needs_no_tarfile(monkeypatch):
    raw = io.BytesIO()
    w = formats.TarWriter(raw)
    packets = [{"index": "i", "type": "t", "id": f"{k}", "field": "_source", "payload": "ü" * k} for k in range(50)]
    for p in packets:
        w.add(p)
    w.close()
    raw.seek(0)
    monkeypatch.setattr(tarfile, "open", None)
    assert list(formats.read_tar(raw)) == [(f"i/t/{p['id']}/_source", p["payload"].encode()) for p in packets]


def test_small_parts_are_read_by_few_tasks(spark):
    rows = [(i, t, k, "x" * 300) for i, t, k, _ in some(400)]
    path = new_path(spark, "small")
    jobs.export(table(spark, rows), path, "s.tar.gz", max_bytes=1000)
    assert len(archive.found(path)) > 80
    got = jobs.read_packets(spark, path, documents=True)
    assert got.rdd.getNumPartitions() <= 2 * archive.TASKS
    assert sorted((r["index"], r["type"], r["id"], r["fields"]["_source"]) for r in got.collect()) == sorted(rows)
    assert got.select("archive", "run").distinct().count() == 400


def test_a_stream_reads_one_file_by_many_tasks(spark):
    landing = new_path(spark, "landing")
    jobs.export(table(spark, some(900, "x" * 200)), landing, "s.bulk.gz", parts=1)
    reader = archive.StreamReader({"path": landing, "documents": "true", "splitBytes": "1000"})
    slices = reader.partitions({"taken": []}, reader.latestOffset())
    assert len(slices) > len(archive.found(landing)) == 1
    assert sum(b.num_rows for s in slices for b in reader.read(s)) == 900


def test_reshard_import_needs_no_plain_tar(spark, monkeypatch):
    names, export = [], jobs.export
    monkeypatch.setattr(jobs, "export", lambda docs, path, name, **o: names.append(name) or export(docs, path, name, **o))
    from docpack.plans import io_queries

    assert io_queries.reshard_import(spark, "/root/testdata/sf0.001").count() == 1680
    assert names == ["stores.tar.gz"]
