"""Export, import, push and pull: compositions of the operators."""

from __future__ import annotations

import datetime
import json
import threading
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.observation import Observation

from docpack.functions.predicates import not_system, of_types
from docpack.model import ATTRIBUTES, KEY, PACKET
from docpack.operators import order, reshape, stats, store
from docpack.session import written
from docpack.sources import archive, formats

FIELDS = [x.split()[0] for x in PACKET.split(", ")]


def packets_of(docs: DataFrame, name: str, fields: list[str] | None = None, repeats: bool = False) -> DataFrame:
    """Documents as packets for an archive; in bulk files attributes go into the action line. With ``repeats`` the column ``seq`` tells documents apart."""
    if formats.format_of(name)[0] != "bulk":
        if repeats:
            docs = docs.withColumn("seq", F.monotonically_increasing_id())
        return reshape.explode_fields(docs, fields, rest=("seq",) if repeats else ()).withColumn("meta", F.lit(None).cast("map<string,string>"))
    own = [a for a in ATTRIBUTES if fields is None or a in fields]
    entries = F.filter(F.array(*[F.struct(F.lit(a).alias("key"), F.col(a).cast("string").alias("value")) for a in own]), lambda e: e["value"].isNotNull()) if own else None
    meta = F.map_from_entries(entries) if own else F.lit(None).cast("map<string,string>")
    return docs.where("_source IS NOT NULL").select(*KEY, F.lit("_source").alias("field"), F.col("_source").alias("payload"), meta.alias("meta"))


def write_packets(packets: DataFrame, directory: str, name: str, max_bytes: int = 0, overwrite: bool = False, repeats: bool = False) -> dict:
    """An archive of packets; fails if there is one that is not empty, unless ``overwrite``. With ``repeats`` a coordinate may come again, and ``seq`` says which document a packet is of. Returns packets, docs, bytes and parts as they were written."""
    archive.register(packets.sparkSession)
    fs, inner = archive.file_system(directory)
    fs.create_dir(inner, recursive=True)
    if not overwrite and (full := [p for p, size in archive.parts_of(directory, name) if size]):
        raise FileExistsError(f"archive exists: {full[0]}")
    want = packets.select(*[F.col(c) if c in packets.columns else F.lit(None).cast(dict(x.split(" ", 1) for x in PACKET.split(", "))[c]).alias(c) for c in FIELDS])
    job = uuid.uuid4().hex
    if formats.format_of(name)[0] == "cpio":  # where a name may occur once
        want = want.sortWithinPartitions(*KEY, *(["seq"] if repeats else []), "field")
    want.write.format("docpack_archive").option("name", name).option("maxBytes", str(max_bytes)).option("job", job).option("repeats", str(repeats).lower()).mode("overwrite" if overwrite else "append").save(directory)
    return archive.summary(directory, job)


def read_packets(spark: SparkSession, path: str, **options) -> DataFrame:
    """Packets of archives. Large plain bulk and tar files without an index are gone through before, by tasks, so that they can be read by ranges."""
    archive.register(spark)
    reader = spark.read.format("docpack_archive")
    for k, v in options.items():
        reader = reader.option(k, str(v).lower() if isinstance(v, bool) else v)
    if spans := _spans(spark, path, int(options.get("splitBytes", archive.SPLIT))):
        reader = reader.option("spans", json.dumps(spans))
    return reader.load(path)


def _spans(spark: SparkSession, path: str, per: int) -> dict[str, list]:
    """For plain bulk and tar files that are larger than ``per`` and have no index: ranges (first byte, last byte, lines or entries before)."""
    large = [x for x in archive.found(path) if formats.format_of(x.name) in (("bulk", ""), ("tar", "")) and x.size > per and not x.index]
    per += -per % 512
    ranges = [(x.name, archive.whole_path(path, x.path), a, b) for x in large for a, b in archive.byte_ranges(x.size, per)]
    if not ranges:
        return {}

    def look(batches):
        for batch in batches:
            for name, at, a, b in batch.itertuples(index=False):
                if formats.format_of(name)[0] == "bulk":
                    row = [name, a, b, archive.line_ends(at, a, b), None, None, None]
                else:
                    fs, inner = archive.file_system(at)
                    with fs.open_input_file(inner) as f:
                        row = [name, a, b, None, *(x.tobytes() for x in formats.tar_links(f, a, b))]
                yield pd.DataFrame([row], columns=["name", "a", "b", "n", "places", "exits", "files"])

    dealt = spark.createDataFrame(ranges, "name string, path string, a long, b long").repartition(len(ranges), "name", "a")
    rows = written(dealt.mapInPandas(look, "name string, a long, b long, n long, places binary, exits binary, files binary"), "spans")
    out: dict[str, list] = {}
    told = rows.orderBy("name", "a")
    for r in told.where("n IS NOT NULL").select("name", "a", "b", "n").collect():  # one row for each range
        own = out.setdefault(r["name"], [])
        own.append((r["a"], r["b"], sum(own[-1][2:]) if own else 0, r["n"]))
    spans = {name: [x[:3] for x in own] for name, own in out.items()}
    return spans | _tar_spans(told.where("places IS NOT NULL"))


def _tar_spans(ranges: DataFrame) -> dict[str, list]:
    """The entries of tar files followed from the beginning, range by range: where in each range the first one begins.

    A file whose entries do not fit together is left out, and so read as a whole, with its error if it has one.
    """
    out: dict[str, list] = {}
    at: dict[str, int] = {}
    for r in ranges.toLocalIterator():  # one range at a time
        name = r["name"]
        here = at.get(name, 0)
        if here < 0 or here >= r["b"]:
            continue
        places, exits, files = (np.frombuffer(r[c], np.int64) for c in ("places", "exits", "files"))
        k = int(np.searchsorted(places, here))
        own = out.setdefault(name, [])
        if k == len(places) or places[k] != here or exits[k] == -2:
            at[name] = -2
            continue
        if exits[k] >= 0 or files[k]:
            own.append((here, int(exits[k]) if exits[k] >= 0 else r["b"], own[-1][2] + own[-1][3] if own else 0, int(files[k])))
        at[name] = int(exits[k])
    return {name: [x[:3] for x in own] for name, own in out.items() if at[name] != -2}


RUN_LOG = "run_id string, mode string, path string, started timestamp, finished timestamp, docs long, detail string"
RUN_EVENT = "run_id string, mode string, path string, event string, at timestamp, started timestamp, docs long, detail string"


class Run:
    """A job in the run log of a folder: records of its start, of every ``beat`` seconds while it goes on, and of its end.

    Each record is a file of its own, so that runs need no lock. A run whose driver dies has no end; it is active until it has been
    silent for a while (``active_runs``).
    """

    def __init__(self, folder: str, mode: str, path: str, beat: float = 30.0):
        self.fs, inner = archive.file_system(folder)
        self.folder, self.beat, self.over = f"{inner}/_runs", beat, threading.Event()
        self.row = {"run_id": uuid.uuid4().hex, "mode": mode, "path": path, "started": _now().isoformat(), "docs": None, "detail": None}
        self.beats: list[str] = []
        self.fs.create_dir(self.folder, recursive=True)

    def _tell(self, event: str) -> str:
        at = _now()
        path = f"{self.folder}/{self.row['run_id']}-{at.timestamp():017.6f}-{event}.json"
        with self.fs.open_output_stream(f"{self.folder}/.{self.row['run_id']}") as f:
            f.write(json.dumps(self.row | {"event": event, "at": at.isoformat()}).encode())
        self.fs.move(f"{self.folder}/.{self.row['run_id']}", path)
        return path

    def _beating(self) -> None:
        while not self.over.wait(self.beat):
            self.beats.append(self._tell("beat"))

    def __enter__(self) -> Run:
        self._tell("started")
        self.thread = threading.Thread(target=self._beating, daemon=True)
        self.thread.start()
        return self

    def counted(self, docs: int, detail: dict) -> None:
        self.row |= {"docs": docs, "detail": json.dumps(detail)}

    def __exit__(self, kind, error, trace) -> None:
        self.over.set()
        self.thread.join()
        if error is not None:
            self.row["detail"] = json.dumps({"error": str(error)[:1000]})
        self._tell("finished" if error is None else "failed")
        for path in self.beats:
            self.fs.delete_file(path)


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the run log in a directory of archives or a store."""
    fs, inner = archive.file_system(folder)
    fs.create_dir(f"{inner}/_runs", recursive=True)
    return spark.read.schema(RUN_EVENT).option("ignoreMissingFiles", "true").json(f"{folder}/_runs")  # beats go when a run ends


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that have finished."""
    return run_events(spark, folder).where("event = 'finished'").select("run_id", "mode", "path", "started", F.col("at").alias("finished"), "docs", "detail")


def active_runs(spark: SparkSession, folder: str, silent: str = "2 minutes") -> DataFrame:
    """Runs that have neither finished nor failed and were heard of within ``silent``: ``run_id, mode, path, started, heard``."""
    events = run_events(spark, folder)
    of = ["run_id", "mode", "path", "started"]
    going = stats.active_runs(events.where("event = 'started'").select(*of), events.where("event IN ('finished', 'failed')").select(*of))
    heard = events.groupBy("run_id").agg(F.max("at").alias("heard"))
    return going.join(heard, "run_id").where(F.col("heard") >= F.current_timestamp() - F.expr(f"INTERVAL {silent}"))


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def limited(docs: DataFrame, limit: int | None, ordered: bool) -> DataFrame:
    """The first ``limit`` documents by key, and documents in the order of their keys, if asked for."""
    docs = order.first_rows(docs, KEY, limit) if limit is not None else docs
    return docs.repartitionByRange(*KEY).sortWithinPartitions(*KEY) if ordered else docs


def in_parts(docs: DataFrame, parts: int | None, per: int = 1 << 20) -> DataFrame:
    """Dealt into ``parts``; by default one for each core, of at least ``per`` bytes, or more that are as large as a file's split, where the input is too small to be read by all cores, else as it comes."""
    if parts is None:
        spark = docs.sparkSession
        plan = docs._jdf.queryExecution().optimizedPlan()
        size = int(str(plan.stats().sizeInBytes()))
        leaves = plan.collectLeaves()
        held = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))  # columns of a table take less in its files than as rows
        split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        cores = spark.sparkContext.defaultParallelism
        want = min(max(cores, -(-size // split)), max(1, size // per))
        tasks = -(-min(held, size) // split)
        parts = want if tasks < cores and want > tasks else None
    return docs.repartition(parts) if parts else docs


def export(
    docs: DataFrame,
    directory: str,
    name: str | None = None,
    indices: list[str] | None = None,
    types: dict | list | None = None,
    where: Column | str | None = None,
    fields: list[str] | None = None,
    rename: dict[str, str] | None = None,
    meta: DataFrame | None = None,
    with_metadata: bool = True,
    with_aliases: bool = True,
    max_bytes: int = 0,
    overwrite: bool = False,
    parts: int | None = None,
    limit: int | None = None,
    ordered: bool = False,
    system: list[str] | None = None,
    repeats: bool = False,
) -> DataFrame:
    """Writes documents to an archive; returns its summary (packets, docs, bytes, skipped). Metadata comes in a part before all others.

    Without a ``name`` it is that of the one index, and of the one type, that is exported, else ``_all.tar.gz``. ``parts`` is how many
    tasks write (``in_parts`` says the default), ``ordered`` puts documents in the order of their keys. ``skipped`` counts
    documents without a source, which bulk files cannot hold. Two documents with one key are an error in cpio files, and one document where they are
    neighbours in tar and zip files, unless ``repeats``: then each is a document when the archive is read.
    """
    if name is None:
        one = indices[0] if indices and len(indices) == 1 and indices != ["_all"] else None
        of = list(types) if isinstance(types, list | set | tuple) else list((types or {}).get(one, []))
        name = "_".join([one, *of] if one and len(of) == 1 else [one or "_all"]) + ".tar.gz"
    docs = docs.where(not_system(F.col("index"), system))
    if indices and indices != ["_all"]:
        docs = docs.where(F.col("index").isin(indices))
    docs = docs.where(of_types(F.col("index"), F.col("type"), types))
    docs = docs.where(where) if where is not None else docs
    docs = limited(in_parts(docs, parts), limit, ordered)
    bulk = formats.format_of(name)[0] == "bulk" if formats.format_of(name) else False
    seen = Observation()
    docs = docs.observe(seen, F.count(F.lit(1)).alias("docs"), F.count(F.when(F.col("_source").isNull(), 1)).alias("skipped"))
    packets = packets_of(reshape.rename(docs, rename), name, fields, repeats)
    if meta is not None and with_metadata and not bulk:
        kept = meta.where(F.col("kind") != "_alias") if not with_aliases else meta
        kept = kept.where(F.col("index").isin(indices)) if indices and indices != ["_all"] else kept
        head = reshape.metadata_packets(reshape.rename_metadata(kept, rename)).withColumn("meta", F.lit(None).cast("map<string,string>"))
        packets = head.coalesce(1).unionByName(packets, allowMissingColumns=True)
    with Run(directory, "export", f"{directory}/{name}") as run:
        told = write_packets(packets, directory, name, max_bytes, overwrite, repeats)
        skipped = (seen.get.get("skipped") or 0) if bulk else 0
        run.counted(told["docs"], told | {"skipped": skipped})
    return docs.sparkSession.createDataFrame([(told["packets"], told["docs"], told["bytes"], skipped)], "packets long, docs long, bytes long, skipped long")


def documents_of(packets: DataFrame) -> DataFrame:
    """Packets of archives as documents: by runs of equal coordinates, the last run of a key wins.

    Runs are found in each archive by the order of its packets; a key's last run is the one in the last part.
    """
    runs = reshape.coordinate_runs(reshape.sane(packets))
    flat = reshape.with_meta(runs.select(*KEY, "field", "payload", "meta", "seq", "archive", "part", "run"))
    docs = reshape.route_fields(reshape.assemble(flat, ["archive", "part", "run"]))
    return docs


def import_(
    spark: SparkSession,
    path: str,
    root: str,
    indices: list[str] | None = None,
    types: list[str] | None = None,
    rename: dict[str, str] | None = None,
    settings: dict[str, str] | None = None,
    mappings: dict[str, str] | None = None,
    with_metadata: bool = True,
    with_aliases: bool = True,
    if_exists: str = "warn",
    versions: bool | None = None,
    batch_size: int = archive.ROWS,
    concurrency: int | None = None,
    merge: bool = True,
) -> DataFrame:
    """Loads an archive (all its parts) into a store; returns documents by index as the archive has them.

    With ``merge=False`` a store that has documents gets these as a delta, so a small load costs its own documents and not the buckets they hash to.

    A reader hands on up to ``batch_size`` documents (or 8 MB) at once, and at most ``concurrency`` tasks read (by default as many as there are).

    The reader puts documents together, so they are written once and shuffled once, to their buckets. ``types`` also selects mappings.
    The run log of the store says how many entries had names that could not be read.
    """
    with Run(root, "import", path) as run:
        rows = read_packets(spark, path, documents=True, batchSize=batch_size)
        rows = rows.coalesce(concurrency) if concurrency else rows
        if indices and indices != ["_all"]:
            rows = rows.where(F.col("index").isin(indices))
        rows = written(reshape.kinds(rows), "import")
        if with_metadata:
            put_metadata(_of_types(reshape.packets_metadata(rows.where("kind <> 'doc'").withColumn("payload", F.col("fields")["_source"])), types), root, rename, settings, mappings, with_aliases, if_exists)
        docs = reshape.route_fields(rows.where("kind = 'doc' AND index IS NOT NULL").drop("kind"))
        docs = docs.where(F.col("type").isin(types)) if types else docs
        docs = reshape.rename(docs, rename).withColumn("_order", F.struct("part", "archive", "run"))
        store.upsert(docs, root, order="_order", versions=versions, kept=True, merge=merge)
        unread = rows.where("index IS NULL").count()
        counts = written(stats.doc_count(docs), "import-count")
        run.counted(counts.agg(F.sum("docs")).first()[0] or 0, {"unread": unread})
    return counts


def _of_types(meta: DataFrame, types: dict | list | None) -> DataFrame:
    """Without the mappings of other types."""
    return meta.where((F.col("kind") != "_mapping") | of_types(F.col("index"), F.col("name"), types)) if types else meta


def put_metadata(meta: DataFrame, root: str, rename: dict | None, settings: dict | None, mappings: dict | None, with_aliases: bool, if_exists: str) -> None:
    meta = reshape.rename_metadata(meta if with_aliases else meta.where("kind <> '_alias'"), rename)
    given = {**{f"{k}_settings": v for k, v in (settings or {}).items()}, **{f"{k}_mapping": v for k, v in (mappings or {}).items()}}
    if given:
        meta = reshape.override(meta, meta.sparkSession.createDataFrame(list(given.items()), "key string, body string"))
    store.create_indices(meta, root, if_exists)


def copy(spark: SparkSession, from_root: str, to_root: str, if_exists: str, indices=None, types=None, where=None, fields=None, rename=None, settings=None, mappings=None, with_metadata=True, with_aliases=True, limit=None, system=None, concurrency: int | None = None) -> DataFrame:
    """Copies documents, and metadata (mappings of the given types only). A document with a version replaces lower versions only.

    At most ``concurrency`` tasks read the source at once.
    """
    with Run(to_root, "copy", from_root) as run:
        if with_metadata:
            put_metadata(_of_types(store.metadata(spark, from_root, indices), types), to_root, rename, settings, mappings, with_aliases, if_exists)
        docs = store.scan(spark, from_root, indices, types, where).where(not_system(F.col("index"), system))
        docs = docs.coalesce(concurrency) if concurrency else docs
        docs = reshape.rename(limited(docs, limit, False), rename)
        if fields is not None:
            docs = docs.withColumns({a: F.lit(None).cast("long" if a == "_version" else "string") for a in ATTRIBUTES if a not in fields})
        store.upsert(docs, to_root, versions=True)
        counts = written(stats.doc_count(store.scan(spark, to_root)), "copy-count")
        run.counted(counts.agg(F.sum("docs")).first()[0] or 0, {})
    return counts


def push(spark: SparkSession, root: str, remote_root: str, **options) -> DataFrame:
    """Copies documents of a store into a remote one; an index that is there must be empty or absent unless ``if_exists`` says otherwise."""
    return copy(spark, root, remote_root, options.pop("if_exists", "require_empty"), **options)


def pull(spark: SparkSession, remote_root: str, root: str, **options) -> DataFrame:
    """Copies documents of a remote store into this one; fails if an index is there, unless ``if_exists`` says otherwise."""
    return copy(spark, remote_root, root, options.pop("if_exists", "error"), **options)
