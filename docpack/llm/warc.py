"""WARC derivatives: for each response record a linked metadata record and a plain-text conversion record.

Responses come from WARC files (``read_warc``) or from a table of pages (``responses``); derived records go to a table or, one gzip
member each, to WARC files (``write_warc``).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docpack.session import sided, written
from docpack.sources.archive import file_system

EPOCH = "1970-01-01T00:00:00Z"
RECORD = "record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, payload_digest string, headers string, content string"
RESPONSE_COLUMNS = ["record_id", "target_uri", "warc_date", "http_headers", "payload", "payload_digest", "payload_length"]
# one step: a comment, a script or style with its content, or a tag; none can run over the text more than once
MARK = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>|<[!?][^<>]*>", re.S | re.I)
TEMPLATE_END = re.compile(r"</template\s*>", re.I)
HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
CHARSET = re.compile(r"""\bcharset\s*=\s*["']?([\w-]+)""", re.I)
# fixed values: elements that begin a line of their own
BLOCKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table td th title tr ul".split())


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_uuid(*parts: str | None) -> str:
    """A record identifier that is the same in every run: UUID form of a hash of the parts."""
    h = hashlib.sha256("\0".join("" if p is None else f"={p}" for p in parts).encode("utf-8", "surrogatepass")).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-{'89ab'[int(h[16], 16) % 4]}{h[17:20]}-{h[20:32]}>"


def page_text(source: str) -> tuple[str, dict]:
    """Plain text (one line a block, runs of white space as one space) and title, language, charset and links in order.

    Left out: comments, scripts, styles, templates (one that is not closed ends at its own tag), and the first title, which is in the metadata; later titles are text.
    """
    found: dict = {"title": "", "lang": "", "charset": "", "links": []}
    out: list[str] = []
    head: list[str] = []
    at, inside, hidden = 0, "", False
    closed = max((m.start() for m in TEMPLATE_END.finditer(source)), default=-1)
    for m in MARK.finditer(source):
        if not hidden:
            (head if inside else out).append(source[at : m.start()])
        at = m.end()
        name, close = (m[3] or "").lower(), m[2]
        if name == "template":
            hidden = not close and at <= closed
        if hidden:
            continue
        if not name:
            out.append(" ")
            continue
        if name == "title":
            inside = "" if close else "title"
            if close and not found["title"]:
                found["title"] = " ".join(entities.unescape("".join(head)).split())
            else:
                out += ["\n", *head, "\n"]
            head = []
        elif name == "a" and not close and (h := HREF.search(m[4])):
            found["links"].append(entities.unescape(h[1] or h[2] or h[3] or ""))
        elif name == "html" and not found["lang"] and (h := LANG.search(m[4])):
            found["lang"] = h[1]
        elif name == "meta" and not found["charset"] and (h := CHARSET.search(m[4])):
            found["charset"] = h[1].lower()
        if name in BLOCKS and not inside:
            out.append("\n")
    (head if inside else out).append(source[at:])
    lines = (" ".join(x.split()) for x in entities.unescape("".join(out).replace("\r", " ").replace("\t", " ")).split("\n"))
    return "\n".join(x for x in lines if x), found


def header_lines(fields: list[tuple[str, str | None]]) -> str:
    return "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v)


def derive(record_id: str, uri: str | None, date: str, http: str, payload: str, payload_digest: str, payload_length: int) -> list[tuple]:
    """The two derived records of one response, as rows of ``RECORD``.

    Both refer to the response and name the digest of its payload; a conversion's payload is its block.
    """
    text, found = page_text(payload)
    meta = [("title", found["title"]), ("languages", found["lang"]), ("charset", found["charset"]), ("source-payload-digest", payload_digest), ("source-payload-length", str(payload_length))]
    meta += [(f"http-header-{k.strip().lower()}", v.strip()) for k, _, v in (x.partition(":") for x in http.split("\r\n")[1:]) if v]
    meta += [("outlink", x) for x in found["links"]]
    out = []
    for kind, mime, content in (("metadata", "application/warc-fields", header_lines(meta)), ("conversion", "text/plain; charset=utf-8", text)):
        block = content.encode("utf-8", "surrogatepass")
        own = record_uuid(kind, record_id)
        fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", record_id), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Block-Digest", digest(block))]
        fields += [("WARC-Payload-Digest", digest(block))] * (kind == "conversion") + [("Source-Payload-Digest", payload_digest), ("Content-Type", mime), ("Content-Length", str(len(block)))]
        out.append((kind, own, record_id, uri, date, mime, len(block), digest(block), payload_digest, "WARC/1.1\r\n" + header_lines(fields), content))
    return out


def record_bytes(headers: str, content: str) -> bytes:
    """One record as it stands in a file."""
    return headers.encode("utf-8", "surrogatepass") + b"\r\n" + content.encode("utf-8", "surrogatepass") + b"\r\n\r\n"


def parse_records(data: bytes | BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record in uncompressed WARC bytes. Folded header lines are joined."""
    f = io.BytesIO(data) if isinstance(data, bytes) else data
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields: dict[str, str] = {}
        last = ""
        while (line := f.readline()).strip():
            text = line.decode("utf-8", "surrogateescape").rstrip("\r\n")
            if text[0] in " \t" and last:
                fields[last] += " " + text.strip()
            else:
                last, _, value = text.partition(":")
                fields[last] = value.strip()
        size = int(fields["Content-Length"])
        block = f.read(size)
        if len(block) != size:
            raise EOFError("WARC record ends early")
        yield fields, block


def _unchunked(body: bytes) -> tuple[bytes, str]:
    """The chunks of a body joined; as far as they go if a size is no number, or the whole body if it has no chunk."""
    f, parts = io.BytesIO(body), []
    while size := f.readline().split(b";")[0].strip():
        try:
            n = int(size, 16)
        except ValueError:
            return (b"".join(parts) if parts else body), "bad chunk size"
        if n <= 0:
            break
        parts.append(f.read(n))
        f.readline()
    return b"".join(parts), ""


def _expanded(body: bytes, coding: str) -> tuple[bytes, str]:
    """A body without one content coding; as it is if it is not of that coding, as far as it goes if it breaks off."""
    if coding in ("", "identity") or not body:
        return body, ""
    if coding not in ("gzip", "x-gzip", "deflate"):
        return body, f"content coding {coding} is not known"
    for bits in (47,) if "gzip" in coding else (15, -15):  # deflate is sent with and without its header
        tool, out = zlib.decompressobj(bits), []
        try:
            out.append(tool.decompress(body))
            while tool.eof and bits == 47 and tool.unused_data.startswith(b"\x1f\x8b"):  # further members
                rest, tool = tool.unused_data, zlib.decompressobj(bits)
                out.append(tool.decompress(rest))
        except zlib.error:
            if out:
                return b"".join(out), f"{coding} is damaged"
            continue
        return b"".join(out), "" if tool.eof else f"{coding} breaks off"
    return body, f"not {coding}"


def http_parts(block: bytes) -> tuple[str, bytes, str, str | None]:
    """Header lines, payload (as it was sent), its text, and what was wrong with it (None: nothing).

    Chunks are joined and content codings undone, the last first; the text is by the charset of header or page, else UTF-8. A body that is not
    what its headers say is taken as far as it can be read.
    """
    head, mark, payload = block.partition(b"\r\n\r\n")
    wrong = [] if mark else ["no end of headers"]
    http = head.decode("latin-1")
    named: dict[str, str] = {}
    for k, _, v in (x.partition(":") for x in http.split("\r\n")[1:]):
        k = k.strip().lower()
        named[k] = f"{named[k]}, {v.strip()}" if k in named and k.endswith("encoding") else v.strip()
    body = payload
    if "chunked" in named.get("transfer-encoding", "").lower():
        body, bad = _unchunked(body)
        wrong += [bad] * bool(bad)
    for coding in reversed(named.get("content-encoding", "").lower().split(",")):
        body, bad = _expanded(body, coding.strip())
        wrong += [bad] * bool(bad)
    found = CHARSET.search(named.get("content-type", "")) or CHARSET.search(body[:2048].decode("latin-1"))
    try:
        text = body.decode(found[1] if found else "utf-8", "replace")
    except (LookupError, ValueError):  # no charset of text, or one that cannot replace what it cannot read
        text = body.decode("utf-8", "replace")
        wrong.append(f"charset {found[1]} cannot be used")
    return http, payload, text, "; ".join(wrong) or None


class Members(io.RawIOBase):
    """The content of gzip members one after the other; where they are damaged or break off, what comes before that and then the error."""

    def __init__(self, raw: BinaryIO):
        self.raw, self.tool, self.ready, self.rest = raw, None, b"", b""
        self.fault: Exception | None = None

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.ready:
            if self.fault:
                raise self.fault
            if not (block := self.rest or self.raw.read(1 << 16)):
                if self.tool is None:
                    return 0
                self.fault = EOFError("gzip breaks off")
                continue
            self.rest = b""
            if self.tool is None:
                block = block.lstrip(b"\0")  # padding
                if not block:
                    continue
                self.tool = zlib.decompressobj(31)
            self._expand(block)
        n = min(len(into), len(self.ready))
        into[:n], self.ready = self.ready[:n], self.ready[n:]
        return n

    def _expand(self, block: bytes) -> None:
        before = self.tool.copy()
        try:
            self.ready = self.tool.decompress(block)
        except zlib.error as e:
            self.fault = e
            for at in range(0, len(block), 64):  # as much as comes before the damage
                try:
                    self.ready += before.decompress(block[at : at + 64])
                except zlib.error:
                    break
            return
        if self.tool.eof:
            self.rest, self.tool = self.tool.unused_data, None


RESPONSE = "key string, record_id string, target_uri string, warc_date string, http_headers string, payload string, payload_digest string, payload_length long, reason string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files (plain or gzip; a file, folder or glob): ``key`` (the record's identifier) and ``RESPONSE_COLUMNS``.

    A file is read by one task, record by record; files are dealt out in turns, the largest first. Identifiers, dates and HTTP headers are those
    of the file, and so is the payload's digest where the record has one; ``payload_length`` is of the payload as it was sent. Other records, and
    responses of other schemes than HTTP, are passed over. A response that is not what its headers say is kept as far as it can be read, with
    the ``reason``; where a file itself breaks off or is damaged, what came before is kept, and a row without identifiers tells file and reason.
    """
    sizes = spark.read.format("binaryFile").load(path).select("path", "length")  # no content is read
    tasks = max(1, sizes.count())
    place = F.row_number().over(W.orderBy(F.desc("length"), "path")) - 1  # as many rows as files
    files = sizes.withColumn("place", place).repartitionByRange(tasks, "place").select("path")
    names = ["key", *RESPONSE_COLUMNS, "reason"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                fs, inner = file_system(name)
                with fs.open_input_stream(inner, compression=None) as raw:
                    f = io.BufferedReader(Members(raw) if name.endswith(".gz") else raw, 1 << 20)
                    rows, size = [], 0
                    records = parse_records(f)
                    while True:
                        try:
                            fields, block = next(records)
                        except StopIteration:
                            break
                        except (EOFError, OSError, ValueError, KeyError, zlib.error) as e:
                            rows.append((None, None, None, None, None, None, None, None, f"{name}: {type(e).__name__}: {e}"))
                            break
                        if fields.get("WARC-Type") != "response" or "http" not in fields.get("Content-Type", ""):
                            continue
                        http, payload, text, reason = http_parts(block)
                        own = fields.get("WARC-Record-ID", "")
                        rows.append((own, own, fields.get("WARC-Target-URI"), fields.get("WARC-Date", EPOCH), http, text, fields.get("WARC-Payload-Digest") or digest(payload), len(payload), reason))
                        size += len(text)
                        if size > 8 << 20:
                            yield _responses(rows, names)
                            rows, size = [], 0
                    yield _responses(rows, names)

    return files.mapInPandas(run, RESPONSE)


def _responses(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"payload_length": "Int64"})


def response_record(record_id: str, uri: str | None, date: str, http: str, payload: str, payload_digest: str, payload_length: int | None = None) -> tuple[str, str]:
    """Header and content of a response as it stands in a file."""
    content = f"{http.rstrip()}\r\n\r\n{payload}"
    block = content.encode("utf-8", "surrogatepass")
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n" + header_lines(fields), content


def write_warc(records: DataFrame, directory: str, name: str = "derived") -> DataFrame:
    """Writes ``headers`` and ``content`` of records to ``<directory>/<name>-<n>.warc.gz``, a gzip member for each; returns ``path, records``.

    A task writes one file under a name of its own; only files of tasks that have ended well get their final names.
    """
    spark, job = records.sparkSession, uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, inner = file_system(directory)
        fs.create_dir(inner, recursive=True)
        path, n = f"{inner}/_{job}-{uuid.uuid4().hex}", 0
        with fs.open_output_stream(path, compression=None) as f:
            for batch in batches:
                for headers, content in zip(batch["headers"], batch["content"], strict=True):
                    f.write(gzip.compress(record_bytes(headers, content), mtime=0))
                    n += 1
        yield pd.DataFrame({"path": [path], "records": [n]})

    done = sorted(map(tuple, records.select("headers", "content").mapInPandas(run, "path string, records long").collect()))  # one row for each task
    fs, inner = file_system(directory)
    out = []
    for path, n in done:
        if n:
            fs.move(path, final := f"{inner}/{name}-{len(out):05d}.warc.gz")
            out.append((final, n))
    for x in fs.get_file_info(_selector(inner)):
        if x.base_name.startswith(f"_{job}-"):  # empty ones, and those of tasks that ran twice
            fs.delete_file(x.path)
    return spark.createDataFrame(out, "path string, records long")


def _selector(path: str):
    from pyarrow.fs import FileSelector

    return FileSelector(path)


def _numbered(source: DataFrame, again: DataFrame) -> DataFrame:
    """With ``nth``: of rows that share ``h`` all but the first are numbered, part by part of a written table, so that no task has all of them."""
    several = written(source.join(sided(again), "h", "left_semi").withColumn("place", F.monotonically_increasing_id()), "warc-several").withColumn("part", F.shiftright("place", 33))
    before = W.partitionBy("h").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = several.groupBy("h", "part").agg(F.count("*").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    nth = F.col("first") + F.row_number().over(W.partitionBy("h", "part").orderBy("place")) - 1
    numbered = several.join(starts.select("h", "part", "first"), ["h", "part"]).withColumn("nth", nth)
    numbered = numbered.withColumn("nth", F.when(F.col("nth") > 0, F.col("nth").cast("string"))).select(*source.columns, "nth")
    return source.join(sided(again), "h", "left_anti").withColumn("nth", F.lit(None).cast("string")).unionByName(numbered)


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str | None = None, http: str | None = None) -> DataFrame:
    """Pages as response records: ``key`` and ``RESPONSE_COLUMNS``. A null page has an empty payload.

    ``date`` and ``http`` name columns with dates and HTTP header lines of the capture; a table of bare pages has none and gets the epoch
    and a status, type and length. Identifiers follow from key, URL and payload, and of rows that repeat them all from their number too, so they are the same
    in every run and each row has one of its own.
    """
    kind = pages.schema[key].dataType.simpleString()
    given = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    source = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"), given(date).alias("date"), given(http).alias("http"))
    source = source.withColumn("h", F.xxhash64("key", "url", "html"))
    again = written(source.groupBy("h").count().where("count > 1").select("h"), "warc-again")
    source = _numbered(source, again) if not again.isEmpty() else source.withColumn("nth", F.lit(None).cast("string"))
    source = source.select(F.col("key").cast("string"), "url", "html", "date", "http", "nth")  # pandas has no whole numbers beside nulls

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, u, h, day, lines, nth in zip(*[batch[c] for c in ("key", "url", "html", "date", "http", "nth")], strict=True):
                body = (h or "").encode("utf-8", "surrogatepass")
                lines = lines or f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
                own = digest(body)
                rows.append((record_uuid("response", k, u, own, *([nth] if nth else [])), u, day or EPOCH, lines, h or "", own, len(body), None))
            yield pd.concat([batch[["key"]].reset_index(drop=True), pd.DataFrame(rows, columns=[*RESPONSE_COLUMNS, "reason"])], axis=1)

    return source.mapInPandas(run, RESPONSE).withColumn("key", F.col("key").cast(kind))


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows per response (``key`` and ``RESPONSE_COLUMNS``): ``key`` and ``RECORD``.

    Derived identifiers follow from the response's. Empty payloads give an empty conversion; a null target URI is
    left out of the headers; records that repeat give equal ones; rows without a record (damaged files) give none. An empty table gives no rows.
    """
    records = records.where("record_id IS NOT NULL")
    kind = records.schema["key"].dataType.simpleString()
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                rows = [r for x in zip(*[part[c] for c in RESPONSE_COLUMNS], strict=True) for r in derive(x[0], x[1], x[2], x[3] or "", x[4] or "", x[5], int(x[6]))]
                yield pd.concat([part[["key"]].loc[part.index.repeat(2)].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return records.select(F.col("key").cast("string"), *RESPONSE_COLUMNS).mapInPandas(run, f"key string, {RECORD}").withColumn("key", F.col("key").cast(kind))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    return derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet"))).withColumnRenamed("key", "page_id")
