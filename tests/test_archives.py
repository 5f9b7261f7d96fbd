import io
import json
import random
import shutil
import struct
import subprocess
import tarfile
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from docpack.model import DOC, KEY
from docpack.model import struct as schema_of
from docpack.operators import store
from docpack.plans import io_queries, jobs
from docpack.plans import tables as T
from docpack.session import new_path
from docpack.sources import archive, codecs, formats
from docpack.streaming import streams

LONG = "https://example.org/" + "path/" * 40
DOCS = [
    ("index1", "test1", "https://www.google.de", '{"content":"Hello World"}'),
    ("index1", "test1", "a b~*-_.!#%?", '{"content":"Hello Jörg 😀"}'),
    ("index1", "test 2", LONG, '{"content":"long"}'),
    ("index2", "t/ü", "x" * 150, '{"a":' + "[1]," * 0 + "1}"),
]


def local(path: str) -> str:
    return archive.file_system(path)[1]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, k, None, None, None, None, s, {"note": f"line one\nline two {k[:5]}"}) for i, t, k, s in DOCS]
    return spark.createDataFrame(rows, schema_of(DOC))


@pytest.mark.parametrize("codec", ["", *codecs.CODECS])
@pytest.mark.parametrize("kind", formats.FORMATS)
def test_round_trip(spark, docs, kind, codec):
    path, name = new_path(spark, "t"), f"all.{kind}" + (f".{codec}" if codec else "")
    jobs.export(docs, path, name)
    back = jobs.documents_of(jobs.read_packets(spark, path))
    assert sorted(map(tuple, back.select(*KEY, "_source").collect())) == sorted(DOCS)
    if kind != "bulk":
        assert {r["id"]: r["fields"]["note"] for r in back.collect()} == {k: f"line one\nline two {k[:5]}" for _, _, k, _ in DOCS}


@pytest.mark.parametrize("size", [0, 1, 2, 31, 33, 300, 70_000, 200_000])
def test_lzf(size):
    rng = random.Random(size)
    for data in (bytes(rng.randrange(256) for _ in range(size)), (b"abcabcabd" * (size // 9 + 1))[:size], bytes(size)):
        raw = io.BytesIO()
        w = codecs.writer(raw, "lzf")
        w.write(data)
        w.close()
        raw.seek(0)
        assert codecs.reader(raw, "lzf").read() == data


def test_lzf_golden():
    assert codecs.reader(io.BytesIO(b"ZV\x00\x00\x03abc"), "lzf").read() == b"abc"
    assert codecs.reader(io.BytesIO(b"ZV\x01\x00\x07\x00\x0c\x02abc\xe0\x00\x02"), "lzf").read() == b"abc" + b"abc" * 3
    with pytest.raises(EOFError):
        codecs.reader(io.BytesIO(b"ZV\x00\x00\x09abc"), "lzf").read()


def write(spark, name: str, data: bytes) -> str:
    path = new_path(spark, "golden")
    fs, inner = archive.file_system(path)
    fs.create_dir(inner, recursive=True)
    with open(f"{inner}/{name}", "wb") as f:
        f.write(data)
    return path


def test_bulk_without_last_brace_and_odd_line(spark):
    lines = ['{"index":{"_index":"index1","_type":"test1","_id":"doc1"}', '{"content":"Hello Jörg"}', '{"create":{"_index":"i","_type":"t","_id":"a\\"b","_parent":"p","_version":7}}', "{}", '{"index":{"_index":"i","_type":"t","_id":"odd"}}']
    rows = jobs.documents_of(jobs.read_packets(spark, write(spark, "x.bulk", "\n".join(lines).encode()))).orderBy("id").collect()
    assert [(r["id"], r["_source"], r["_parent"], r["_version"]) for r in rows] == [('a"b', "{}", "p", 7), ("doc1", '{"content":"Hello Jörg"}', None, None)]


def test_bulk_action_without_id_fails(spark):
    with pytest.raises(Exception, match="bulk action without id"):
        jobs.read_packets(spark, write(spark, "x.bulk", b'{"index":{"_index":"i","_type":"t"}}\n{}\n')).collect()


def test_foreign_tar(spark):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for name, data in (("i", None), ("i/t/1/_source", b"{}"), ("i/t/._1/_source", b"junk"), ("i/t/" + "ü" * 120 + "/_source", b"{}"), ("i/t/2/_source/five", b"{}"), ("i/t/3", b"[]")):
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
            else:
                info.size = len(data)
            tar.addfile(info, io.BytesIO(data or b""))
    path = write(spark, "f.tar", raw.getvalue())
    docs = jobs.documents_of(jobs.read_packets(spark, path))
    assert sorted((r["id"], r["_source"]) for r in docs.collect()) == [("1", "{}"), ("3", "[]"), ("ü" * 120, "{}")]
    assert jobs.read_packets(spark, path, corrupt="keep").where("index IS NULL").count() == 1
    with pytest.raises(Exception, match="more than four parts"):
        jobs.read_packets(spark, path, corrupt="fail").collect()


def cpio_bytes(layout: str, name: bytes, data: bytes, wrong: int = 0) -> bytes:
    name += b"\0"
    if layout in ("070701", "070702"):
        total = (sum(data) + wrong) & 0xFFFFFFFF if layout == "070702" else 0
        head = layout.encode() + b"".join(b"%08X" % n for n in (1, 0o100644, 0, 0, 1, 0, len(data), 0, 0, 0, 0, len(name), total)) + name
        return head + b"\0" * (-len(head) % 4) + data + b"\0" * (-len(data) % 4)
    if layout == "070707":
        return b"070707" + b"".join(b"%06o" % n for n in (0, 1, 0o100644, 0, 0, 1, 0)) + b"%011o" % 0 + b"%06o" % len(name) + b"%011o" % len(data) + name + data
    head = struct.pack(layout + "13H", 0o070707, 0, 1, 0o100644, 0, 0, 1, 0, 0, 0, len(name), len(data) >> 16, len(data) & 0xFFFF)
    return head + name + b"\0" * (len(name) % 2) + data + b"\0" * (len(data) % 2)


@pytest.mark.parametrize("layout", ["070701", "070702", "070707", "<", ">"])
def test_cpio_layouts(layout):
    data = b"".join(cpio_bytes(layout, n, d) for n, d in ((b"i/t/1/_source", b"{}"), (b"i/t/22/_source", b"x" * 70_001), (b"TRAILER!!!", b""))) + b"\0" * 100
    assert list(formats.read_cpio(io.BytesIO(data))) == [("i/t/1/_source", b"{}"), ("i/t/22/_source", b"x" * 70_001)]


def test_cpio_checksum_and_duplicates():
    with pytest.raises(ValueError, match="checksum"):
        list(formats.read_cpio(io.BytesIO(cpio_bytes("070702", b"a", b"data", wrong=1))))
    w = formats.CpioWriter(io.BytesIO())
    packet = dict(zip(("index", "type", "id", "field", "payload"), "abcde", strict=True))
    w.add(packet)
    with pytest.raises(ValueError, match="already"):
        w.add(packet)


def test_zip_stored_and_slices(spark):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for k in range(500):
            z.writestr(f"i/t/{k}/_source", json.dumps({"k": k}) * 20, zipfile.ZIP_STORED if k % 2 else zipfile.ZIP_DEFLATED)
    path = write(spark, "z.zip", raw.getvalue())
    packets = jobs.read_packets(spark, path, splitBytes=5000)
    assert packets.rdd.getNumPartitions() > 3 and packets.count() == 500
    assert packets.select("seq").distinct().count() == 500


def test_bulk_ranges(spark):
    lines = b"".join(b'{"index":{"_index":"i","_type":"t","_id":"%d"}}\n{"k":%d}\n' % (k, k) for k in range(2000))
    packets = jobs.read_packets(spark, write(spark, "b.bulk", lines), splitBytes=7000, splitBulk=True)
    assert packets.rdd.getNumPartitions() > 5
    assert sorted(int(r["id"]) for r in packets.collect()) == list(range(2000))


def test_a_part_ends_when_its_bytes_exceed_the_limit(spark):
    rows = [("index1", "test1", f"doc{k}", None, None, None, None, '{"content":"Hello World %d"}' % k, None) for k in range(100)]
    path = new_path(spark, "split")
    jobs.export(spark.createDataFrame(rows, schema_of(DOC)).coalesce(1), path, "s.tar", max_bytes=275)
    found = {archive.part_of(p): p for p, _ in archive.archives(path)}
    assert len(found) == 10 and found[0].endswith("/s.tar") and found[9].endswith("/9.s.tar")
    assert jobs.read_packets(spark, found[0]).count() == 11  # ten of 27 bytes are 270, the next one exceeds 275
    assert jobs.read_packets(spark, path).count() == 100


def test_save_modes_and_empty(spark, docs):
    path = new_path(spark, "modes")
    assert jobs.export(docs.limit(0), path, "e.zip").first()["packets"] == 0
    jobs.export(docs, new_path(spark, "modes"), "e.zip")
    full = new_path(spark, "modes")
    jobs.export(docs, full, "e.bulk")
    with pytest.raises(FileExistsError):
        jobs.export(docs, full, "e.bulk")
    jobs.export(docs.limit(1), full, "e.bulk", overwrite=True)
    assert jobs.read_packets(spark, full).count() == 1


def test_bulk_payload_of_several_lines(spark):
    row = lambda s: spark.createDataFrame([("i", "t", "1", None, None, None, None, s, None)], schema_of(DOC))
    path = new_path(spark, "lines")
    jobs.export(row('{\n "a": 1\n}'), path, "a.bulk")
    assert jobs.documents_of(jobs.read_packets(spark, path)).first()["_source"] == '{"a":1}'
    with pytest.raises(Exception, match="one line or JSON"):
        jobs.export(row("no\njson"), new_path(spark, "lines"), "a.bulk")


def test_filters_reach_the_source(spark, docs):
    path = new_path(spark, "push")
    jobs.export(docs, path, "p.tar")
    packets = jobs.read_packets(spark, path).where("index = 'index1' AND type IN ('test1')")
    plan = packets._jdf.queryExecution().executedPlan().toString()
    assert "test1" not in plan.split("BatchScan")[0]
    assert packets.where("field = '_source'").count() == 2


@pytest.mark.skipif(not shutil.which("tar"), reason="no tar")
def test_system_tar_lists_the_same_names(spark, docs):
    path = new_path(spark, "system")
    jobs.export(docs, path, "s.tar.gz")
    names = sorted(x for p, _ in archive.archives(path) for x in subprocess.run(["tar", "tzf", p], capture_output=True, text=True, check=True).stdout.split())
    assert names == sorted(formats.encode_name(i, t, k, f) for i, t, k, _ in DOCS for f in ("_source", "note"))


def test_metadata_goes_along_and_is_renamed(spark, docs):
    meta = spark.createDataFrame([("index1", "_settings", None, '{"index.number_of_shards":"2"}'), ("index1", "_mapping", "test1", "{}"), ("index1", "_alias", "al", '{"term":{"type":"first"}}'), ("empty", "_settings", None, "{}")], "index string, kind string, name string, body string")
    path, root = new_path(spark, "meta"), new_path(spark, "root")
    jobs.export(docs, path, "m.tar", meta=meta)
    jobs.import_(spark, path, root, rename={"index1": "new", "index1/test1": "first"}, mappings={"new_first": '{"own":1}'})
    got = sorted((r["index"], r["kind"], r["name"] or "", r["body"]) for r in store.metadata(spark, root).collect())
    assert got == [("empty", "_settings", "", "{}"), ("new", "_alias", "al", '{"term":{"type":"first"}}'), ("new", "_mapping", "first", '{"own":1}'), ("new", "_settings", "", '{"index.number_of_shards":"2"}')]
    assert store.create_alias(spark, root, "al", "new", '{"term":{"type":"first"}}').count() == 2
    assert spark.read.parquet(f"{root}/docs").where("index = 'new'").agg(F.max("bucket")).first()[0] <= 1


def test_later_runs_replace_whole_documents(spark):
    lines = b"".join(b'{"index":{"_index":"i","_type":"t","_id":"%s"%s}}\n{"n":%d}\n' % x for x in ((b"1", b',"_parent":"p"', 1), (b"2", b"", 2), (b"1", b"", 3)))
    path, root = write(spark, "r.bulk", lines), new_path(spark, "root")
    jobs.import_(spark, path, root)
    assert sorted((r["id"], r["_source"], r["_parent"]) for r in store.scan(spark, root).collect()) == [("1", '{"n":3}', None), ("2", '{"n":2}', None)]


def test_mixed_versions_are_refused(spark):
    rows = [("i", "t", "1", None, None, None, 3, "{}", None), ("i", "t", "2", None, None, None, None, "{}", None)]
    with pytest.raises(ValueError, match="version"):
        store.upsert(spark.createDataFrame(rows, schema_of(DOC)), new_path(spark, "root"))


def test_streams_take_files_that_land_later_under_any_name(spark):
    landing, root, out = new_path(spark, "landing"), new_path(spark, "store"), new_path(spark, "assembled")
    points = new_path(spark, "points"), new_path(spark, "points")

    def land(first: int, name: str) -> None:
        rows = [("i", "t", str(k), None, None, None, None, "{}", None) for k in range(first, first + 12)]
        jobs.export(spark.createDataFrame(rows, schema_of(DOC)).repartitionByRange(12, "id"), landing, name)

    def taken() -> list[int]:
        streams.import_stream(spark, landing, root, checkpoint=points[0]).awaitTermination()
        streams.assemble_stream(spark, landing, out, checkpoint=points[1]).awaitTermination()
        assembled = sorted(int(r["id"]) for r in spark.read.parquet(out).select("id").collect())
        assert assembled == sorted(int(r["id"]) for r in store.scan(spark, root).select("id").collect())
        return assembled

    land(0, "pages-0.tar.gz")
    assert taken() == list(range(12))
    land(12, "pages-1.tar.gz")  # its parts but the first sort before pages-0.tar.gz
    assert len(archive.archives(landing)) > 13
    assert taken() == list(range(24))
    land(24, "a.tar.gz")
    assert taken() == list(range(36)) == taken()


def test_stream_offsets(spark):
    path = write(spark, "b.tar", b"")
    reader = archive.StreamReader({"path": path})
    end = reader.latestOffset()
    files = [x.path for x in reader.partitions(reader.initialOffset(), end)]
    assert [archive.base_name(x) for x in files] == ["b.tar"] and reader.partitions({"after": files[0]}, end) == []
    assert reader.partitions(end, end) == []
    with pytest.raises(FileNotFoundError, match="gone.tar"):
        reader.partitions(end, {"taken": ["b.tar", "gone.tar"]})


def table(spark, rows):
    return spark.createDataFrame([(i, t, k, None, None, None, v, s, None) for i, t, k, v, s in rows], schema_of(DOC))


def test_an_export_tells_of_its_own_archive_and_refuses_only_its_own_name(spark):
    path = new_path(spark, "names")
    rows = [("i", "t", str(k), None, "{}") for k in range(30)]
    one = jobs.export(table(spark, rows[:5]), path, "small.bulk").first()
    two = jobs.export(table(spark, [*rows, ("i", "t", "x", None, None)]), path, "all.bulk").first()
    assert (one["packets"], one["docs"], two["packets"], two["docs"], two["skipped"]) == (5, 5, 30, 30, 1)
    jobs.export(table(spark, rows[:2]), path, "2024.tar")
    jobs.export(table(spark, rows[:3]), path, "tar.tar")
    with pytest.raises(FileExistsError):
        jobs.export(table(spark, rows[:2]), path, "2024.tar")
    log = jobs.runs(spark, path)
    assert sorted((r["mode"], r["docs"]) for r in log.collect()) == [("export", 2), ("export", 3), ("export", 5), ("export", 30)]
    assert log.where("finished < started").count() == 0


def test_equal_versions_go_to_the_first_that_arrives(spark):
    path, root = new_path(spark, "versions"), new_path(spark, "root")
    fs, inner = archive.file_system(path)
    fs.create_dir(inner, recursive=True)
    line = '{"index":{"_index":"i","_type":"t","_id":"%s","_version":%d}}\n{"n":%d}\n'
    with open(f"{inner}/v.bulk", "w") as f:
        f.write(line % ("0", 1, 0) + line % ("1", 7, 1) + line % ("2", 1, 1))
    with open(f"{inner}/1.v.bulk", "w") as f:
        f.write(line % ("1", 7, 2) + line % ("2", 2, 2))
    jobs.import_(spark, path, root)
    assert {r["id"]: r["_source"] for r in store.scan(spark, root).collect()} == {"0": '{"n":0}', "1": '{"n":1}', "2": '{"n":2}'}


def test_limit_order_parts_and_default_names(spark):
    rows = [(f"i{k % 2}", "t", f"{k:03d}", None, "{}") for k in range(40)]
    path = new_path(spark, "options")
    assert jobs.export(table(spark, rows), path, indices=["i1"], types=["t"], limit=7, ordered=True, parts=1).first()["docs"] == 7
    assert [archive.base_name(p) for p, _ in archive.archives(path)] == ["i1_t.tar.gz"]
    packets = jobs.read_packets(spark, path).orderBy("part", "seq").collect()
    assert [r["id"] for r in packets] == [f"{k:03d}" for k in range(1, 15, 2)]
    many = new_path(spark, "options")
    jobs.export(table(spark, rows), many, parts=5)
    assert {archive.base_name(p) for p, _ in archive.archives(many)} == {"_all.tar.gz", *(f"{n}._all.tar.gz" for n in range(1, 5))}
    root, remote = new_path(spark, "root"), new_path(spark, "root")
    store.upsert(table(spark, rows), root)
    assert jobs.push(spark, root, remote, limit=3).agg(F.sum("docs")).first()[0] == 3


def test_hidden_indices_stay_unless_named(spark):
    rows = [(".jobs", "t", "1", None, "{}"), ("i", "t", "1", None, "{}")]
    assert jobs.export(table(spark, rows), new_path(spark, "hidden"), "a.tar").first()["docs"] == 1
    assert jobs.export(table(spark, rows), new_path(spark, "hidden"), "a.tar", system=["i"]).first()["docs"] == 1
    assert jobs.export(table(spark, rows), new_path(spark, "hidden"), "a.tar", system=[]).first()["docs"] == 2


def test_runs_as_the_reader_puts_them_together(spark):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        for name, data in (("i/_settings/null/null", b"{}"), ("i/t/1/a", b"x"), ("i/t/1/_source", b"{}"), ("i/t/2/_source", b"[]"), ("i/t/1/_source", b"later"), ("i/t/._2/_source", b"no"), ("i/t/3/a/five", b"no"), ("i/t/1/a", b"y"), ("i/t/1/a", b"z")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    path, root = write(spark, "r.tar", raw.getvalue()), new_path(spark, "root")
    rows = jobs.read_packets(spark, path, documents=True).orderBy("run").collect()
    assert [(r["type"], r["id"], r["fields"], r["run"], r["last_seq"]) for r in rows if r["index"]] == [("_settings", "null", {"_source": "{}"}, 0, 0), ("t", "1", {"a": "x", "_source": "{}"}, 1, 2), ("t", "2", {"_source": "[]"}, 3, 3), ("t", "1", {"_source": "later"}, 4, 4), ("t", "1", {"a": "z"}, 7, 8)]
    assert sum(r["index"] is None for r in rows) == 1
    jobs.import_(spark, path, root)
    assert '"unread": 1' in jobs.runs(spark, root).first()["detail"]
    assert jobs.read_packets(spark, path, documents=True).where("id = '2'").count() == 1


def test_payloads_that_are_no_text_fail(spark):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        info = tarfile.TarInfo("i/t/1/_source")
        info.size = 2
        tar.addfile(info, io.BytesIO(b"\xff\xfe"))
    path = write(spark, "b.tar", raw.getvalue())
    with pytest.raises(Exception, match="not UTF-8"):
        jobs.read_packets(spark, path).collect()
    assert jobs.read_packets(spark, path, badText="replace").count() == 1


def test_streams_import_metadata(spark):
    landing, root = new_path(spark, "landing"), new_path(spark, "store")
    meta = spark.createDataFrame([("i", "_settings", None, '{"index.number_of_shards":"2"}'), ("i", "_alias", "al", "")], "index string, kind string, name string, body string")
    jobs.export(table(spark, [("i", "t", str(k), None, "{}") for k in range(20)]), landing, "m.zip", meta=meta)
    streams.import_stream(spark, landing, root, rename={"i": "j"}).awaitTermination()
    assert sorted((r["index"], r["kind"]) for r in store.metadata(spark, root).collect()) == [("j", "_alias"), ("j", "_settings")]
    assert spark.read.parquet(f"{root}/docs").agg(F.max("bucket"), F.count("*")).first()[:2] == (1, 20)


def test_parents_of_one_index(spark):
    parents = table(spark, [("a", "p", "1", None, "A"), ("b", "p", "1", None, "B")])
    child = table(spark, [("a", "c", "9", None, "{}")]).withColumn("_parent", F.lit("1"))
    assert store.children_with_parents(child, parents).count() == 2
    assert store.children_with_parents(child, parents, one_index=True).first()["parent_source"] == "A"
    assert store.orphans(child, parents.where("index = 'b'"), one_index=True).count() == 1


def test_deltas_are_merged_as_they_are_read_and_compacted(spark):
    root = new_path(spark, "root")
    rows = lambda first, last, text: table(spark, [("i", "t", str(k), None, text) for k in range(first, last)])
    state = lambda: {r["id"]: r["_source"] for r in store.scan(spark, root).collect()}
    store.upsert(rows(0, 6, "a"), root)
    files = set(spark.read.parquet(f"{root}/docs").inputFiles())
    assert store.append(rows(2, 8, "b"), root, "w", 0) == 1
    assert store.append(rows(4, 9, "lost"), root, "w", 1) == 2
    assert store.append(rows(4, 9, "c"), root, "w", 1) == 2  # run again
    want = {str(k): "a" if k < 2 else "b" if k < 4 else "c" for k in range(9)}
    assert state() == want and set(spark.read.parquet(f"{root}/docs").inputFiles()) == files
    assert store.scan(spark, root, where="_source = 'b'").count() == 2  # states that were replaced are not found
    assert store.scan(spark, root, ["j"]).count() == 0
    assert store.compact(spark, root) == 2 and store.compact(spark, root) == 0 and state() == want
    store.append(rows(0, 1, "d"), root, "w", 2)
    store.upsert(rows(0, 2, "e"), root)  # later than all deltas
    assert state() == want | {"0": "e", "1": "e"} and not store.deltas(spark, root)


def test_streams_compact_after_some_batches(spark):
    landing, root, points = new_path(spark, "landing"), new_path(spark, "store"), new_path(spark, "points")
    seen = []
    for k in range(5):
        jobs.export(table(spark, [("i", "t", str(n), None, str(k)) for n in (k, 9)]), landing, f"{k}.tar")
        streams.import_stream(spark, landing, root, checkpoint=points, compact_after=3).awaitTermination()
        seen.append(len(store.deltas(spark, root)))
        assert {r["id"]: r["_source"] for r in store.scan(spark, root).collect()} == {str(n): str(n) for n in range(k + 1)} | {"9": str(k)}
    assert seen == [0, 1, 2, 0, 1]


def test_tar_headers_are_those_of_tarfile():
    packets = [{"index": "a", "type": "b", "id": x, "field": "_source", "payload": p} for x in ("1", "ü ~/", "x" * 79, "x" * 80, "x" * 81, "y" * 300) for p in (None, "", "ä" * 700)]
    own, other = io.BytesIO(), io.BytesIO()
    out = formats.TarWriter(own)
    with tarfile.open(fileobj=other, mode="w|", format=tarfile.GNU_FORMAT, encoding="utf-8") as tar:
        for p in packets:
            data = (p["payload"] or "").encode()
            assert out.add(p) == len(data)
            info = tarfile.TarInfo(formats.encode_name(p["index"], p["type"], p["id"], p["field"]))
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    out.close()
    assert own.getvalue() == other.getvalue()


@pytest.fixture(scope="module")
def repeated_pages(tmp_path_factory):
    """Pages of which two have one URL."""
    folder = tmp_path_factory.mktemp("pages")
    duckdb.sql("COPY (SELECT 'https://a.example/' || (k %% 9) AS url, k AS page_id, '<p>' AS html FROM range(10) t(k)) TO '%s' (FORMAT parquet)" % (folder / "pages.parquet"))
    return str(folder)


@pytest.mark.parametrize("kind", formats.FORMATS)
def test_documents_of_one_key_stay_apart_if_asked(spark, kind):
    rows = [("i", "t", k, None, None, None, None, s, {"a": s}) for k, s in (("1", "x"), ("1", "y"), ("2", "z"), ("2", "z"), ("2", "z"), ("3", "w"))]
    path = new_path(spark, "repeats")
    told = jobs.export(spark.createDataFrame(rows, schema_of(DOC)).coalesce(1), path, f"r.{kind}", parts=1, repeats=True).first()
    want = sorted((r[2], r[7]) for r in rows)
    read = jobs.read_packets(spark, path)
    assert told["packets"] == read.count() == (6 if kind == "bulk" else 12)
    assert sorted((r["id"], r["fields"]["_source"]) for r in jobs.read_packets(spark, path, documents=True).collect()) == want
    if kind != "bulk":
        assert sorted((r["id"], r["_source"]) for r in jobs.documents_of(read).collect()) == want
        assert sorted((r["id"], r["fields"]["a"]) for r in jobs.documents_of(read).collect()) == want


def test_pages_of_one_url_are_all_listed_and_read(spark, repeated_pages):
    lines = io_queries.archive_listing(spark, repeated_pages).collect()
    assert len(lines) == 10 and len(set(lines)) == 9
    got = io_queries._round_trip(spark, T.page_docs(spark, repeated_pages).coalesce(1), "p.cpio.gz", parts=1, repeats=True)
    assert sorted(r["_source"] for r in got.collect()) == sorted('{"page_id":%d}' % k for k in range(10))


def test_pages_of_one_url_are_all_imported(spark, repeated_pages):
    got = io_queries.stream_import(spark, repeated_pages).collect()
    assert sorted((r["id"], r["_source"]) for r in got) == sorted(("https://a.example/%d" % (k % 9), '{"page_id":%d}' % k) for k in range(10))
