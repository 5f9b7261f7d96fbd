"""The data source ``docpack_archive``: packets in bulk, tar, zip and cpio files, plain or compressed.

    spark.dataSource.register(DocpackArchive)
    spark.read.format("docpack_archive").load(path)          # a file, a directory or a glob
    packets.write.format("docpack_archive").option("name", "all.tar.gz").mode("append").save(directory)

A directory has a manifest of each archive written to it, ``_manifest-<name>.json``, which says what its parts are. A write gives
its parts their names only after the manifest is in place, and until then the manifest says where they are; so readers have the archive as it
was before or after a write, never none or a mixture. Archives without a manifest consist of the files that have their names.

Each part has an index beside it: where in the file documents begin, every ``memberBytes`` of payload, and which coordinates lie between.
Compressed files begin a member there that can be read alone (other tools read all members as one). Reading makes a partition
of every ``splitBytes`` of such a part, of zip files of other tools by slices of their directory, of plain bulk and tar files by ``spans`` that
``jobs.read_packets`` has looked for, and one of any other file. Filters on index, type and id skip stretches that the index says have none.

With ``documents`` a row is a run of neighbouring entries of one document, put together as they are read. With ``repeats`` the writer takes
``seq`` for the number of a packet's document, and puts an empty entry ``_next`` between two neighbouring documents of one coordinate, which ends a run and is no packet. Entries whose names have more
than four parts come with null keys and their name as field, unless ``corrupt`` is ``drop`` or ``fail``; a payload that is not UTF-8 fails
unless ``badText`` is ``replace``. Writing makes at least one part of each task; ``maxBytes`` starts another part with the next document when
a part's payload exceeds it, so that no document lies in two parts. Paths may be of any file system that pyarrow opens; on a cluster all executors must reach them.
"""

from __future__ import annotations

import io
import json
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from docpack.model import PACKET, RUN
from docpack.sources import codecs, formats

NAMES = [x.split()[0] for x in PACKET.split(", ")]
ARROW = pa.schema(
    [pa.field(n, pa.string()) for n in NAMES[:5]] + [pa.field("meta", pa.map_(pa.string(), pa.string())), pa.field("seq", pa.int64()), pa.field("archive", pa.string()), pa.field("part", pa.int32())]
)
RUN_ARROW = pa.schema(
    [pa.field(n, pa.string()) for n in NAMES[:3]] + [pa.field("fields", pa.map_(pa.string(), pa.string())), pa.field("run", pa.int64()), pa.field("last_seq", pa.int64()), pa.field("archive", pa.string()), pa.field("part", pa.int32())]
)
ROWS = 2000
SPLIT = 64 << 20
ENTRY, TOGETHER, TASKS = 256, 32 << 20, 32
WRITTEN = NAMES[:6]


def file_system(path: str) -> tuple[pfs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path):
        return pfs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pfs.LocalFileSystem(), path


def whole_path(asked: str, inner: str) -> str:
    """A file's path as a task can open it, where ``asked`` is how its directory was named."""
    scheme = re.match(r"[A-Za-z][A-Za-z0-9+.-]+:(//[^/]*)?", asked)
    return f"{scheme[0]}{inner}" if scheme and not asked.startswith("file:") else inner


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def part_of(name: str) -> int:
    m = re.match(r"(\d+)\.", base_name(name))
    return int(m[1]) if m else 0


@dataclass
class Archive:
    """A file of an archive: where it is, how large, its official name, and its index, if there is one."""

    path: str
    size: int
    name: str
    index: str | None = None
    work: int | None = None  # bytes of payload and ``ENTRY`` for each entry, where the manifest says so


def manifest_path(inner: str, name: str) -> str:
    return f"{inner}/_manifest-{name}.json"


def _manifest(fs, inner: str, name: str) -> list[dict] | None:
    """The parts of an archive as its manifest has them (``name``, ``at`` until it has that name, ``index``); None without one."""
    if fs.get_file_info(path := manifest_path(inner, name)).type != pfs.FileType.File:
        return None
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())["parts"]


def _resolved(fs, inner: str, parts: list[dict]) -> list[Archive]:
    """Where the parts of a manifest are now. An archive of which no file is left is no archive; a single lost part is an error."""
    asked = [f"{inner}/{p[k]}" for p in parts for k in ("at", "name")]
    infos = fs.get_file_info(asked)
    out, lost = [], None
    for n, p in enumerate(parts):
        info = next((x for x in infos[2 * n : 2 * n + 2] if x.type == pfs.FileType.File), None)
        if info is None:
            lost = p["name"]
        else:
            out.append(Archive(info.path, info.size, p["name"], f"{inner}/{p['index']}" if p.get("index") else None, p.get("work")))
    if out and lost:
        raise FileNotFoundError(f"a part of an archive is gone: {inner}/{lost}")
    return out


def found(path: str) -> list[Archive]:
    """Archive files of a file, a directory, or a pattern in the last component, in order of parts; manifests say what is part of what."""
    fs, inner = file_system(path)
    last = base_name(inner)
    one = None if any(c in last for c in "*?[") else fs.get_file_info(inner)
    folder = inner.rstrip("/") if one is not None and one.type == pfs.FileType.Directory else inner.rstrip("/").rpartition("/")[0] or "/"
    infos = fs.get_file_info(pfs.FileSelector(folder, allow_not_found=True))
    names = [m[1] for x in infos if (m := re.fullmatch(r"_manifest-(.+)\.json", x.base_name))]
    listed = [a for n in names for a in _resolved(fs, folder, _manifest(fs, folder, n) or [])]
    of_manifest = lambda name: any(re.fullmatch(r"(?:\d+\.)?" + re.escape(n), name) for n in names)
    bare = [Archive(x.path, x.size, x.base_name) for x in infos if x.type == pfs.FileType.File and formats.format_of(x.path) and x.base_name[:1] not in "._" and not of_manifest(x.base_name)]
    files = listed + bare
    if one is None:
        pattern = re.compile("".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in last))
        files = [x for x in files if pattern.fullmatch(x.name)]
    elif one.type != pfs.FileType.Directory:
        files = [x for x in files if x.name == last]
        if not files:
            raise FileNotFoundError(path)
    return sorted(files, key=lambda x: (part_of(x.name), x.name))


def archives(path: str) -> list[tuple[str, int]]:
    """Archive files (path, bytes), as ``found``."""
    return [(x.path, x.size) for x in found(path)]


def parts_of(directory: str, name: str) -> list[tuple[str, int]]:
    """Files (path, bytes) in a directory that are parts of the archive ``name``: itself, ``1.name`` and so on."""
    return [(x.path, x.size) for x in found(directory) if re.fullmatch(r"(?:\d+\.)?" + re.escape(name), x.name)]


def summary(directory: str, job: str) -> dict:
    """What the writer of a job counted: packets, documents, bytes of payload, parts. It is read once."""
    fs, inner = file_system(directory)
    with fs.open_input_stream(path := f"{inner}/_summary-{job}") as f:
        out = json.loads(f.read())
    fs.delete_file(path)
    return out


@dataclass
class Slice(InputPartition):
    path: str = ""
    first: int = 0
    last: int = -1
    part: int = 0
    name: str = ""
    index: str | None = None
    before: int = 0  # lines of a bulk file or entries of a tar file before ``first``, where it is read by ranges that were looked for
    more: list[Slice] = field(default_factory=list)  # small parts that are read by the same task, after this one

    def __post_init__(self):
        super().__init__(self.path)


def together(slices: list[tuple[Slice, int]]) -> list[Slice]:
    """Slices with their work, neighbours joined up to ``TOGETHER`` bytes of it, or less where fewer than ``TASKS`` tasks would be left: a part may be much smaller than what a task costs."""
    most = min(TOGETHER, sum(w for _, w in slices) // TASKS)
    out: list[Slice] = []
    held = most + 1
    for s, work in slices:
        if held + work > most:
            out.append(s)
            held = work
        else:
            out[-1].more.append(s)
            held += work
    return out


def byte_ranges(size: int, per: int) -> list[tuple[int, int]]:
    return [(a, min(a + per, size)) for a in range(0, max(size, 1), per)]


def bulk_range(f, first: int, last: int, lines: int) -> Iterator[tuple[int, dict, str]]:
    """The documents (with their numbers) whose action lines begin in [first, last), of a file that has ``lines`` line ends before ``first``.

    Actions and payloads take turns, so the number of a line says what it is, whatever it looks like.
    """
    if first:
        f.seek(first - 1)
        if f.readline() != b"\n":
            lines += 1
    if lines % 2:
        f.readline()
        lines += 1
    while f.tell() < last:
        action, payload = f.readline(), f.readline()
        if not payload:
            return
        if action.strip():
            yield lines // 2, formats.parse_action(action.decode()), payload.decode().rstrip("\r\n")
        lines += 2


def line_ends(path: str, first: int, last: int) -> int:
    """How many lines end in [first, last) of a file."""
    fs, _ = file_system(path)
    n = 0
    with fs.open_input_file(path) as f:
        f.seek(first)
        while first < last and (block := f.read(min(1 << 22, last - first))):
            n += block.count(b"\n")
            first += len(block)
    return n


class Stretch(io.RawIOBase):
    """The bytes [first, last) of a file, from its beginning to its end."""

    def __init__(self, raw, first: int, last: int):
        self.raw, self.left = raw, last - first
        raw.seek(first)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        block = self.raw.read(min(len(into), self.left))
        into[: len(block)] = block
        self.left -= len(block)
        return len(block)


class Places:
    """Where documents begin in a part that is being written, and which coordinates come from there to the next place."""

    FEW = 16

    def __init__(self):
        self.rows: list[dict] = []

    def begin(self, offset: int, seq: int) -> None:
        self.rows.append({"offset": offset, "seq": seq, "has": [[], [], []]})

    def add(self, key: tuple) -> None:
        for held, value in zip(self.rows[-1]["has"], key, strict=True):
            if value is None or value in held:
                continue
            if len(held) < self.FEW:
                held.append(value)
            elif len(held) == self.FEW:  # the least and the greatest from here on
                held[:] = [None, min(*held, value), max(*held, value)] + [None] * (self.FEW - 2)
            else:
                held[1], held[2] = min(held[1], value), max(held[2], value)


def may_have(row: dict, wanted: dict[str, set[str]]) -> bool:
    """Whether a stretch of an index can have entries of the wanted coordinates."""
    for k, column in enumerate(("index", "type", "id")):
        if column in wanted:
            held = row["has"][k]
            if held[:1] == [None] and len(held) > Places.FEW:
                if not any(held[1] <= v <= held[2] for v in wanted[column] if v is not None):
                    return False
            elif not wanted[column] & set(held):
                return False
    return True


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path", "")
        self.split = int(options.get("splitBytes", SPLIT))
        self.spans: dict[str, list] = json.loads(options.get("spans", "{}"))
        self.payload = options.get("payload", "true").lower() == "true"
        self.corrupt = options.get("corrupt", "keep")
        self.errors = options.get("badText", "strict")
        self.documents = options.get("documents", "false").lower() == "true"
        self.rows = int(options.get("batchSize", ROWS))
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) else ""
            if column in ("index", "type", "id") and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        return self.slices(found(self.path))

    def slices(self, files: list[Archive]) -> list[Slice]:
        fs, _ = file_system(self.path)
        out = []
        for a in files:
            kind, codec = formats.format_of(a.name)
            spans = [(0, -1, 0)]
            if not codec and kind == "zip" and a.size > self.split and not a.index:
                with fs.open_input_file(a.path) as f:
                    spans = [(x, y, 0) for x, y in formats.zip_slices(f, self.split)]
            elif a.index and a.size > self.split:
                spans = [(x, y, 0) for x, y in byte_ranges(a.size, self.split)]
            elif a.name in self.spans:
                spans = [tuple(x) for x in self.spans[a.name]]
            work = (a.size if a.work is None else a.work) // len(spans)
            out += [(Slice(a.path, x, y, part_of(a.name), a.name, a.index, n), work) for x, y, n in spans]
        return together(out)

    def _stretches(self, fs, s: Slice) -> Iterator[tuple[int, int, int]]:
        """Bytes of an indexed part that begin in the slice and may have what is wanted, and the number of their first entry."""
        if s.index is None or (s.last < 0 and not self.wanted):
            yield s.first, s.last, s.before
            return
        with fs.open_input_stream(s.index) as f:
            rows = json.loads(f.read())
        ends = [r["offset"] for r in rows[1:]] + [rows[-1]["end"]]
        first = last = seq = None
        for r, end in zip(rows, ends, strict=True):
            if (s.last < 0 or s.first <= r["offset"] < s.last) and may_have(r, self.wanted):
                if last != r["offset"]:
                    if last is not None:
                        yield first, last, seq
                    first, seq = r["offset"], r["seq"]
                last = end
        if last is not None:
            yield first, last, seq

    def _entries(self, s: Slice):
        """(sequence number, key and field, payload, attributes) of the slice's entries."""
        fs, _ = file_system(self.path)
        kind, codec = formats.format_of(s.name or s.path)
        with fs.open_input_file(s.path) as raw:
            if kind == "zip" and s.index is None:
                if codec:  # no directory to seek in
                    entries = formats.read_zip_forward(codecs.reader(raw, codec))
                else:
                    entries = formats.read_zip(raw if raw.size() > 1 << 16 else io.BytesIO(raw.read()), (s.first, s.last) if s.last >= 0 else None)
                yield from self._named(s, entries, s.first)
            elif kind == "bulk" and s.index is None and s.last >= 0:
                for n, action, payload in bulk_range(io.BufferedReader(raw, 1 << 20), s.first, s.last, s.before):
                    yield n, *_line(action, payload)
            else:
                for first, last, seq in self._stretches(fs, s):
                    part = raw if last < 0 else io.BufferedReader(Stretch(raw, first, last), 1 << 20)
                    f = codecs.reader(part, codec)
                    if kind == "bulk":
                        for n, (action, payload) in enumerate(formats.read_bulk(io.BufferedReader(f) if not isinstance(f, io.IOBase) else f), seq):
                            yield n, *_line(action, payload)
                    elif kind == "zip":
                        yield from self._named(s, formats.read_zip_forward(f, whole=last < 0), seq)
                    else:
                        yield from self._named(s, formats.READERS[kind](f), seq)

    def _named(self, s: Slice, entries, first: int):
        meta = None
        for n, (name, data) in enumerate(entries, first):
            if name == formats.NEXT:
                meta = formats.AGAIN
                continue
            key = formats.decode_name(name)
            if key is None:
                if self.corrupt == "fail":
                    raise ValueError(f"entry name has more than four parts: {name}")
                if self.corrupt == "drop":
                    continue
                key = [None, None, None, name]
            try:
                yield n, key, data.decode("utf-8", self.errors), meta
            except UnicodeDecodeError as e:
                raise ValueError(f"payload of {name} in {s.path} is not UTF-8") from e
            meta = None

    def _runs(self, s: Slice) -> Iterator[pa.RecordBatch]:
        """Runs of entries with one coordinate: the later of equal fields counts. A line of a bulk file is a document of its own.

        Entries that lack a part of their coordinate, or whose type or id begins with a dot, are of no document.
        """
        wanted = [(k, self.wanted[c]) for k, c in enumerate(("index", "type", "id")) if c in self.wanted]
        name = s.name or base_name(s.path)
        bulk = formats.format_of(name)[0] == "bulk"
        rows: list[list] = []
        size, before = 0, None
        for n, key, payload, meta in self._entries(s):
            if key == [None, None, None, key[3]]:  # a name that could not be read: a row without keys
                if not wanted:
                    rows.append([None, None, None, {}, n, n, name, s.part])
                before = None
                continue
            metadata = key[1] == "_settings"
            if key[0] is None or key[1] is None or key[1].startswith(".") or (not metadata and (key[2] is None or key[2].startswith("."))):
                continue
            own = key[:3]
            if any(own[k] not in values for k, values in wanted):
                before = None
                continue
            if bulk or own != before or meta is formats.AGAIN:
                if len(rows) >= self.rows or size > 8 << 20:
                    yield _run_batch(rows)
                    rows, size = [], 0
                rows.append([*own, {}, n, n, name, s.part])
                before = own
            row = rows[-1]
            if self.payload:
                row[3].update(meta if meta and meta is not formats.AGAIN else {})
                row[3][key[3] if key[3] not in (None, "null") else "_source"] = payload
                size += len(payload)
            row[5] = n
        if rows:
            yield _run_batch(rows)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        for s in (partition, *partition.more):
            yield from self._read(s)

    def _read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if self.documents:
            yield from self._runs(partition)
            return
        rows: list[tuple] = []
        wanted = [(k, self.wanted[c]) for k, c in enumerate(("index", "type", "id")) if c in self.wanted]
        size, name = 0, partition.name or base_name(partition.path)
        for n, key, payload, meta in self._entries(partition):
            if any(key[k] not in values for k, values in wanted):
                continue
            rows.append((*key, payload if self.payload else None, meta, n, name, partition.part))
            size += len(payload)
            if len(rows) >= self.rows or size > 8 << 20:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _line(action: dict, payload: str) -> tuple:
    """A document of a bulk file as an entry."""
    meta = {f"_{k}": v for k, v in action.items() if k not in ("index", "type", "id")}
    return [action["index"], action["type"], action["id"], "_source"], payload, meta or None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    columns[5] = [None if m is None else list(m.items()) for m in columns[5]] if any(columns[5]) else [None] * len(rows)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, ARROW, strict=True)], schema=ARROW)


def _run_batch(rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    maps = columns[3]
    ends = pa.array([0, *accumulate(map(len, maps))], pa.int32())
    fields = pa.MapArray.from_arrays(ends, pa.array([k for m in maps for k in m], pa.string()), pa.array([v for m in maps for v in m.values()], pa.string()))
    return pa.RecordBatch.from_arrays([fields if n == 3 else pa.array(c, t.type) for n, (c, t) in enumerate(zip(columns, RUN_ARROW, strict=True))], schema=RUN_ARROW)


def _packets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The packets of Arrow batches, as the formats' writers take them."""
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in WRITTEN]
        columns.append(batch.column("seq").to_pylist() if "seq" in batch.schema.names else [None] * batch.num_rows)
        for index, type_, id_, field_, payload, meta, seq in zip(*columns, strict=True):
            yield {"index": index, "type": type_, "id": id_, "field": field_, "payload": payload, "meta": dict(meta) if meta else None, "seq": seq}


@dataclass
class Parts(WriterCommitMessage):
    files: list[tuple[str, int, int, str | None]] = field(default_factory=list)  # temporary name, packets, payload bytes, name of the index
    docs: int = 0


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.directory, self.name = options["path"].rstrip("/"), options.get("name", "_all.tar.gz")
        if not (kinds := formats.format_of(self.name)):
            raise ValueError(f"no archive suffix in {self.name}")
        self.kind, self.codec = kinds
        self.most = int(options.get("maxBytes", 0))
        self.member = int(options.get("memberBytes", 16 << 20))
        self.repeats = options.get("repeats", "false").lower() == "true"
        self.overwrite = overwrite
        self.job = options.get("job") or uuid.uuid4().hex

    def _open(self, fs, path: str):
        raw = fs.open_output_stream(path)
        f = codecs.writer(raw, self.codec)
        return raw, f, formats.WRITERS[self.kind](f)

    def write(self, iterator) -> Parts:
        fs, inner = file_system(self.directory)
        fs.create_dir(inner, recursive=True)
        done = Parts()
        raw = f = out = None
        path, packets, size, since, places = "", 0, 0, 0, Places()
        between = 0  # entries that are no packets

        def close() -> None:
            out.close()
            if f is not raw:
                f.close()
            end = raw.tell()
            raw.close()
            places.rows[-1]["end"] = end
            index = f"_index-{self.name}-{self.job}-{uuid.uuid4().hex[:12]}.json"
            with fs.open_output_stream(f"{inner}/{index}") as i:
                i.write(json.dumps(places.rows).encode())
            done.files.append((base_name(path), packets - between, size, index))

        from pyspark import TaskContext

        task = TaskContext.get()
        number = task.partitionId() if task else 0
        before = last = None
        for row in _packets(iterator):
            now = (row["index"], row["type"], row["id"])
            again = now == before and self.repeats and row["seq"] != last
            begins = now != before or again
            if out is not None and self.most and size > self.most and begins:
                close()
                out = None
            if out is None:
                path = f"{inner}/_part-{self.name}-{self.job}-{number:06d}-{len(done.files):06d}-{uuid.uuid4().hex[:8]}"
                raw, f, out = self._open(fs, path)
                packets, size, since, places, between = 0, 0, 0, Places(), 0
                places.begin(0, 0)
                again = False
            elif begins and size - since >= self.member:
                if f is not raw:
                    f.close()
                places.begin(raw.tell(), packets)
                if f is not raw:  # a member that can be read alone
                    f = out.f = codecs.writer(raw, self.codec)
                since = size
            if again and self.kind != "bulk":
                out.add(formats.BETWEEN)
                packets += 1
                between += 1
            if begins:
                places.add(now)
                if row["type"] != "_settings" and row["id"] not in ("_mapping", "_alias"):
                    done.docs += 1
            before, last = now, row["seq"]
            size += out.add(row)
            packets += 1
        if out is not None:
            close()
        return done

    def commit(self, messages) -> None:
        """Makes the parts the archive: by a manifest that says where they are, then by their names, in order of tasks."""
        fs, inner = file_system(self.directory)
        fs.create_dir(inner, recursive=True)
        before = _manifest(fs, inner, self.name)
        old = [x for x in found(self.directory) if re.fullmatch(r"(?:\d+\.)?" + re.escape(self.name), x.name)]
        kept = [] if self.overwrite else [{"name": x.name, "at": base_name(x.path), "index": x.index and base_name(x.index), "work": x.work} for x in old]
        first = 1 + max(part_of(x["name"]) for x in kept) if kept else 0
        files = sorted(f for m in messages if m for f in m.files)
        if not files and not old:
            raw, f, out = self._open(fs, f"{inner}/{(path := f'_part-{self.name}-{self.job}-empty')}")
            out.close()
            if f is not raw:
                f.close()
            raw.close()
            files = [(path, 0, 0, None)]
        new = [{"name": f"{n}.{self.name}" if n else self.name, "at": f[0], "index": f[3], "work": f[2] + ENTRY * f[1]} for n, f in enumerate(files, first)]
        self._swap(fs, inner, kept + new)
        self._name(fs, inner, kept + new)
        told = {"packets": sum(f[1] for f in files), "docs": sum(m.docs for m in messages if m), "bytes": sum(f[2] for f in files), "parts": len(files)}
        with fs.open_output_stream(f"{inner}/_summary-{self.job}") as f:
            f.write(json.dumps(told).encode())
        self._sweep(fs, inner, kept + new, [x.path for x in old] + [f"{inner}/{x['index']}" for x in before or [] if x.get("index")])

    def _swap(self, fs, inner: str, parts: list[dict]) -> None:
        """From here on readers have the new parts."""
        aside = f"{inner}/_aside-{self.name}-{self.job}"
        with fs.open_output_stream(aside) as f:
            f.write(json.dumps({"parts": parts}).encode())
        fs.move(aside, manifest_path(inner, self.name))

    def _name(self, fs, inner: str, parts: list[dict]) -> None:
        infos = fs.get_file_info([f"{inner}/{p['at']}" for p in parts])
        for p, info in zip(parts, infos, strict=True):
            if p["at"] != p["name"] and info.type == pfs.FileType.File:
                fs.move(f"{inner}/{p['at']}", f"{inner}/{p['name']}")

    def _sweep(self, fs, inner: str, parts: list[dict], old: list[str]) -> None:
        """Deletes what the archive had before, and files of this name that are not in its manifest: what writes that broke off have left."""
        live = {f"{inner}/{p[k]}" for p in parts for k in ("name", "at", "index") if p[k]}
        mine = re.compile(r"_(?:part|index|aside)-{0}-[0-9a-f]{{32}}\b.*|(?:\d+\.)?{0}".format(re.escape(self.name)))
        left = [x.path for x in fs.get_file_info(pfs.FileSelector(inner)) if mine.fullmatch(x.base_name)]
        for info in fs.get_file_info(sorted({*old, *left} - live)):
            if info.type == pfs.FileType.File:
                fs.delete_file(info.path)

    def abort(self, messages) -> None:
        fs, inner = file_system(self.directory)
        for m in messages:
            for f in m.files if m else []:
                for name in (f[0], f[3]):
                    if name and fs.get_file_info(f"{inner}/{name}").type == pfs.FileType.File:
                        fs.delete_file(f"{inner}/{name}")


class FileLog:
    """Names of files that a stream has taken, numbered in the order in which it took them; a folder of small files that are joined now and then.

    All names are held by the driver, as Spark's own file streams do; offsets are numbers.
    """

    JOINED = 16

    def __init__(self, path: str):
        self.fs, self.path = file_system(path)
        self.names: list[str] = []
        self.files: list[str] = []
        self.load()

    def load(self) -> None:
        found_ = self.fs.get_file_info(pfs.FileSelector(self.path, allow_not_found=True))
        self.files = sorted(x.path for x in found_ if re.fullmatch(r"\d{12}-\d{12}\.json", x.base_name))
        held: dict[int, str] = {}
        for path in self.files:  # a joined file and those it was joined from say the same
            with self.fs.open_input_stream(path) as f:
                held.update(enumerate(json.loads(f.read()), int(base_name(path)[:12])))
        self.names = [held[n] for n in range(len(held))]

    def take(self, new: list[str]) -> int:
        """Adds names; returns how many there are."""
        if new:
            self._write(len(self.names), new)
            self.names += new
            if len(self.files) >= self.JOINED:
                old = self.files
                self.files = []
                self._write(0, self.names)
                for path in set(old) - set(self.files):
                    self.fs.delete_file(path)
        return len(self.names)

    def _write(self, first: int, names: list[str]) -> None:
        self.fs.create_dir(self.path, recursive=True)
        path = f"{self.path}/{first:012d}-{first + len(names):012d}.json"
        with self.fs.open_output_stream(aside := f"{self.path}/aside-{os.getpid()}") as f:
            f.write(json.dumps(names).encode())
        self.fs.move(aside, path)
        self.files.append(path)


class StreamReader(DataSourceStreamReader):
    """Micro-batches of archive files that land in a directory, whole files, in any order of names.

    With ``log``, a folder of the stream's own, names that are taken lie there and the offset is their number, at most ``maxFiles`` more
    a batch; without it the offset holds the names. A file is known by its name: other content under a taken name is not read again.
    """

    def __init__(self, options: dict):
        self.options = options
        self.most = int(options.get("maxFiles", 0))
        self.log = FileLog(options["log"]) if options.get("log") else None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"log": None}  # tasks read files and need no names

    def _files(self) -> dict[str, Archive]:
        return {x.name: x for x in found(self.options["path"])}

    def initialOffset(self) -> dict:
        return {"n": 0} if self.log else {"taken": []}

    def latestOffset(self) -> dict:
        if not self.log:
            return {"taken": sorted(self._files())}
        known = set(self.log.names)
        new = sorted((n for n in self._files() if n not in known), key=lambda n: (part_of(n), n))
        return {"n": self.log.take(new[: self.most] if self.most else new)}  # with what a run that broke off had taken and not read

    def _names(self, start: dict, end: dict, files: dict) -> set[str]:
        if self.log:
            if end["n"] > len(self.log.names):
                self.log.load()
            return set(self.log.names[start["n"] : end["n"]])
        # a checkpoint of an earlier version names the greatest path read
        after = lambda offset: [n for n, x in files.items() if x.path <= offset["after"]] if "after" in offset else offset["taken"]
        return set(after(end)) - set(after(start))

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        files = self._files()
        new = sorted(self._names(start, end, files), key=lambda n: (part_of(n), n))
        if lost := [n for n in new if n not in files]:
            raise FileNotFoundError(f"removed before it was read: {lost[0]}")
        return Reader(self.options).slices([files[n] for n in new])

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return Reader(self.options).read(partition)


class DocpackArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "docpack_archive"

    def schema(self) -> str:
        return RUN if self.options.get("documents", "false").lower() == "true" else PACKET

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.options)


def register(spark) -> None:
    """Makes the format known to a session and lets filters on index, type and id reach it."""
    spark.dataSource.register(DocpackArchive)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
