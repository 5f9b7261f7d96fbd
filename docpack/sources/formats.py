"""Archive formats: streams of named entries in bulk, tar, zip and cpio files."""

from __future__ import annotations

import io
import json
import re
import struct
import tarfile
import tempfile
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote_plus, unquote_plus

import numpy as np

FORMATS = ("bulk", "tar", "zip", "cpio")
SUFFIX = re.compile(r"\.(bulk|tar|zip|cpio)(?:\.(gz|bz2|xz|lzf))?$", re.I)
# fixed values: characters that a form-URL-encoded name keeps
KEEP = "-_.*"


def format_of(path: str) -> tuple[str, str] | None:
    m = SUFFIX.search(path)
    return (m[1].lower(), (m[2] or "").lower()) if m else None


PLAIN = re.compile(r"[A-Za-z0-9_.*-]+")
WHOLE = re.compile(r"[A-Za-z0-9_.*-]+(?:/[A-Za-z0-9_.*-]+){3}")


def encode_name(*parts: str | None) -> str:
    """Four name components; a missing or empty one is the word ``null``."""
    if None not in parts and "" not in parts and (plain := "/".join(parts)).count("/") == len(parts) - 1 and WHOLE.fullmatch(plain):
        return plain
    return "/".join((p if PLAIN.fullmatch(p) else quote_plus(p, safe=KEEP).replace("~", "%7E")) if p else "null" for p in parts)


def decode_name(name: str) -> list[str | None] | None:
    """Components of an entry's name, four at most; None for a name with more."""
    if WHOLE.fullmatch(name):
        return name.split("/")
    parts = [x for x in name.split("/") if x]
    if len(parts) > 4:
        return None
    out = []
    for p in parts:
        if PLAIN.fullmatch(p):  # nothing to decode
            out.append(p)
            continue
        head, mark, tail = p.partition("#")
        out.append(unquote_plus(head) + mark + tail.replace("+", " "))
    return [*out, *[None] * (4 - len(out))]


# an entry between two documents of one coordinate, and the attribute of the entry after it
BETWEEN = {"index": "_next", "type": None, "id": None, "field": None, "payload": None}
NEXT, AGAIN = encode_name("_next", None, None, None), {"_next": "true"}


# -- readers: (name or action, payload) in order; directories are skipped


ACTION = {k: re.compile(rf'"_{k}"\s*:\s*("(?:[^"\\]|\\.)*")') for k in ("index", "type", "id", "parent", "routing", "timestamp")}
VERSION = re.compile(r'"_version"\s*:\s*"?(-?\d+)')


def parse_action(line: str) -> dict[str, str]:
    """Index, type, id and attributes of a bulk action line; a last brace may be missing."""
    out = {}
    for k, pattern in ACTION.items():
        if m := pattern.search(line):
            try:
                out[k] = json.loads(m[1])
            except ValueError:
                out[k] = m[1][1:-1]
    if m := VERSION.search(line):
        out["version"] = m[1]
    missing = {"index", "type", "id"} - set(out)
    if missing:
        raise ValueError(f"bulk action without {', '.join(sorted(missing))}: {line[:200]}")
    return out


def read_bulk(f: BinaryIO) -> Iterator[tuple[dict[str, str], str]]:
    lines = io.TextIOWrapper(f, "utf-8", newline="\n") if not isinstance(f, io.TextIOBase) else f
    while action := lines.readline():
        payload = lines.readline()
        if not payload:
            return  # an odd last line
        if action.strip():
            yield parse_action(action), payload.rstrip("\r\n")


def plain_entry(head: bytes) -> tuple[str, int] | None:
    """Name and size of a file whose tar header says nothing that needs ``tarfile``: no prefix, no other header before it, a size in octal digits."""
    if len(head) != 512 or head[156] != 48 or head[345] or head[257:262] != b"ustar":
        return None
    try:
        size, total = int(head[124:135], 8), int(head[148:154], 8)
    except ValueError:
        return None
    if head[135] not in (0, 32) or sum(head[:148].translate(None, b"\0")) + 256 + sum(head[156:].translate(None, b"\0")) != total:
        return None
    return head[:100].partition(b"\0")[0].decode("utf-8", "surrogateescape"), size


class After(io.RawIOBase):
    """A file that goes forward, with bytes of it that were read already."""

    def __init__(self, head: bytes, f: BinaryIO):
        self.head, self.f = head, f

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        block, self.head = (self.head[: len(into)], self.head[len(into) :]) if self.head else (self.f.read(len(into)), b"")
        into[: len(block)] = block
        return len(block)


def read_tar(f: BinaryIO) -> Iterator[tuple[str, bytes]]:
    """Plain entries are read here; from the first other one on the archive goes to ``tarfile``, which takes some ten times as long for an entry."""
    f = f if isinstance(f, io.BufferedReader) else io.BufferedReader(f, 1 << 20)
    begun = False
    while entry := plain_entry(head := f.read(512)):
        name, size = entry
        data = f.read(size + -size % 512)
        if len(data) < size:
            raise tarfile.ReadError("unexpected end of data")
        yield name, data[:size]
        begun = True
    if begun and not head.strip(b"\0"):  # the end, of the file or of the archive
        return
    f = io.BufferedReader(After(head, f), 1 << 16)
    with tarfile.open(fileobj=f, mode="r|", encoding="utf-8", errors="surrogateescape") as tar:
        while entry := tar.next():
            tar.members.clear()  # else all headers of the archive stay in memory
            if entry.isfile():
                yield entry.name, tar.extractfile(entry).read()


# fixed values: type flags of entries whose content follows, and of headers that say more about the next entry
REGULAR, MORE = (b"0", b"\0", b"7"), (b"L", b"K", b"x", b"X")


def _octal(field: bytes) -> int | None:
    try:
        return tarfile.nti(field)
    except tarfile.HeaderError:
        return None


def tar_step(block: bytes) -> tuple[bytes, int] | None:
    """The type flag of a tar header and how many bytes header and content take; None for a block that is no header, or of a kind that changes what follows."""
    if len(block) < 512 or block[0] == 0 and not any(block):
        return None
    if _octal(block[148:156]) not in tarfile.calc_chksums(block):
        return None
    flag, size = block[156:157], _octal(block[124:136])
    if size is None or size < 0 or flag in (b"S", b"g"):
        return None
    held = size if flag in REGULAR or flag in MORE or flag not in (b"1", b"2", b"3", b"4", b"5", b"6") else 0
    return flag, 512 + held + -held % 512


def tar_links(f: BinaryIO, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every block of [first, last) that looks like the beginning of an entry or the end of the archive: its place, where the entries from there on leave the
    range (-1: the archive ends before, -2: they do not fit together), and how many files they are.

    Which of them are entries and not content that looks so is known only to who comes from the beginning.
    """
    f.seek(first)
    data = f.read(last - first)
    rows = np.frombuffer(data[: len(data) // 512 * 512], np.uint8).reshape(-1, 512)
    field = rows[:, 148:156]
    plain = ((field >= 48) & (field <= 55)) | (field == 32) | (field == 0)
    total = rows.sum(1, dtype=np.int64) - field.sum(1, dtype=np.int64)
    likely = np.flatnonzero(plain.all(1) & (total > 0))
    steps = {}
    for k in likely.tolist():
        if step := tar_step(data[512 * k : 512 * k + 512]):
            steps[first + 512 * k] = step

    def entry(at: int) -> tuple[int, int]:
        """Where an entry ends that begins here, with headers that say more about it, and whether it is a file; -2 if it does not fit."""
        while True:
            if at < last:
                step = steps.get(at)
            else:
                f.seek(at)
                step = tar_step(f.read(512))
            if step is None:
                return -2, 0
            if step[0] not in MORE:
                return at + step[1], int(step[0] in REGULAR)
            if step[0] in (b"x", b"X"):
                f.seek(at + 512)
                if b" size=" in f.read(step[1] - 512):
                    return -2, 0
            at += step[1]

    out = {first + 512 * k: (-1, 0) for k in np.flatnonzero(~rows.any(1)).tolist()}  # a block of zeros ends an archive
    for at in sorted(steps, reverse=True):
        end, files = entry(at)
        if end < 0 or end >= last:
            out[at] = end, files
        else:
            out[at] = (out[end][0], out[end][1] + files) if end in out else (-2, 0)
    places = np.array(sorted(out), np.int64)
    return places, np.array([out[k][0] for k in places.tolist()], np.int64), np.array([out[k][1] for k in places.tolist()], np.int64)


def zip_slices(f: BinaryIO, per: int) -> list[tuple[int, int]]:
    """Ranges of entry numbers of about ``per`` bytes of the file each, from the central directory; entries of one document stay together."""
    out, start = [], 0
    with zipfile.ZipFile(f) as z:
        infos = z.infolist()
        for k in range(1, len(infos)):
            if infos[k].header_offset - infos[start].header_offset >= per and infos[k].filename.rpartition("/")[0] != infos[k - 1].filename.rpartition("/")[0]:
                out.append((start, k))
                start = k
    return [*out, (start, len(infos))] if start < len(infos) or not out else out


def read_zip(f: BinaryIO, span: tuple[int, int] | None = None) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(f) as z:
        for info in z.infolist()[slice(*span)] if span else z.infolist():
            if not info.is_dir():
                yield info.filename, z.read(info)


def read_zip_forward(f: BinaryIO, whole: bool = True) -> Iterator[tuple[str, bytes]]:
    """The entries of a zip file that cannot be sought in, by the headers before them; an entry's sizes may stand behind it if it is deflated.

    What is not ``whole`` is a range of entries, which may end without a directory.
    """
    f = f if isinstance(f, io.BufferedReader) else io.BufferedReader(f, 1 << 16)
    while (head := f.read(4)) == b"PK\x03\x04":
        _, flags, method, _, _, crc, packed, size, name_length, extra_length = struct.unpack("<5H3L2H", _exactly(f, 26, "zip"))
        name = _exactly(f, name_length, "zip").decode("utf-8" if flags & 0x800 else "cp437")
        extra = _exactly(f, extra_length, "zip")
        while len(extra) >= 4:  # sizes beyond four bytes
            kind, length = struct.unpack("<2H", extra[:4])
            if kind == 1 and packed == 0xFFFFFFFF:
                size, packed = struct.unpack("<2Q", extra[4:20])
            extra = extra[4 + length :]
        if flags & 1:
            raise ValueError(f"zip entry is encrypted: {name}")
        behind = bool(flags & 8)
        if method == zipfile.ZIP_STORED and not behind:
            data = _exactly(f, packed, "zip")
        elif method == zipfile.ZIP_DEFLATED:
            data = _inflated(f) if behind else zlib.decompress(_exactly(f, packed, "zip"), -15)
        else:
            raise ValueError(f"zip entry cannot be read without a directory: {name}")
        if behind:
            crc = _exactly(f, 4, "zip")
            crc = struct.unpack("<L", _exactly(f, 4, "zip") if crc == b"PK\x07\x08" else crc)[0]
            _exactly(f, 8, "zip")
            if f.peek(2)[:2] != b"PK":  # sizes of eight bytes each
                _exactly(f, 8, "zip")
        if zlib.crc32(data) != crc:
            raise ValueError(f"zip entry is damaged: {name}")
        if not name.endswith("/"):
            yield name, data
    if head not in (b"PK\x01\x02", b"PK\x05\x06") and (whole or head):
        raise ValueError(f"not a zip header: {head!r}")


def _inflated(f: io.BufferedReader) -> bytes:
    """A deflated stream from its beginning to its end, and not a byte more."""
    tool, out = zlib.decompressobj(-15), []
    while not tool.eof:
        block = f.peek(1)
        if not block:
            raise EOFError("zip archive ends early")
        out.append(tool.decompress(block))
        f.read(len(block) - len(tool.unused_data))
    return b"".join(out)


def _exactly(f: BinaryIO, n: int, what: str = "cpio") -> bytes:
    out = f.read(n)
    if len(out) != n:
        raise EOFError(f"{what} archive ends early")
    return out


def read_cpio(f: BinaryIO) -> Iterator[tuple[str, bytes]]:
    """New ASCII, new ASCII with checksums, old ASCII, and old binary in both byte orders."""
    while True:
        magic = f.read(6)
        if not magic:
            return
        total = None
        if magic in (b"070701", b"070702"):
            head = _exactly(f, 104)
            mode, size, length, total = int(head[8:16], 16), int(head[48:56], 16), int(head[88:96], 16), int(head[96:], 16) if magic == b"070702" else None
            name_pad, data_pad = -(110 + length) % 4, -size % 4
        elif magic == b"070707":
            head = _exactly(f, 70)
            mode, length, size = int(head[12:18], 8), int(head[53:59], 8), int(head[59:70], 8)
            name_pad = data_pad = 0
        elif magic[:2] in (b"\xc7\x71", b"\x71\xc7"):
            order = "<" if magic[:2] == b"\xc7\x71" else ">"
            half = struct.unpack(order + "13H", magic + _exactly(f, 20))
            mode, length, size = half[3], half[10], half[11] << 16 | half[12]
            name_pad, data_pad = length % 2, size % 2
        else:
            raise ValueError(f"not a cpio header: {magic!r}")
        name = _exactly(f, length + name_pad)[: length - 1].decode("utf-8", "surrogateescape")
        data = _exactly(f, size + data_pad)[:size]
        if name == "TRAILER!!!":
            return
        if total is not None and sum(data) & 0xFFFFFFFF != total:
            raise ValueError(f"cpio checksum of {name} is wrong")
        if mode & 0o170000 != 0o040000:
            yield name, data


# -- writers: one file each


def action_line(index: str | None, type_: str | None, id_: str | None, meta: dict[str, str] | None = None) -> str:
    head = {"_index": index, "_type": type_, "_id": id_} | {k: v for k, v in (meta or {}).items() if v is not None}
    return json.dumps({"index": head}, ensure_ascii=False, separators=(",", ":"))


class BulkWriter:
    """Two lines a document; only sources are written, attributes go into the action line."""

    def __init__(self, f: BinaryIO):
        self.f = f

    def add(self, packet: dict) -> int:
        if (packet.get("field") or "_source") != "_source":
            return 0
        payload = packet["payload"] or ""
        if "\n" in payload or "\r" in payload:
            try:
                payload = json.dumps(json.loads(payload), ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                raise ValueError(f"a bulk payload must be one line or JSON: {packet['index']}/{packet['type']}/{packet['id']}") from None
        data = f"{action_line(packet['index'], packet['type'], packet['id'], packet.get('meta'))}\n{payload}\n".encode()
        self.f.write(data)
        return len(data)

    def close(self) -> None:
        pass


class TarWriter:
    """Headers differ in name and size only, so those that fit are made from one that ``tarfile`` gives."""

    BLANK = tarfile.TarInfo().tobuf(tarfile.GNU_FORMAT)
    FIXED = sum(BLANK[100:124]) + sum(BLANK[136:148]) + 8 * 32 + sum(BLANK[156:])  # the sum's own field counts as blanks
    MIDDLE, END = BLANK[100:124], BLANK[156:]

    def __init__(self, f: BinaryIO):
        self.f, self.written = f, 0

    def _header(self, name: bytes, size: int) -> bytes:
        digits = b"%011o\0" % size
        return b"%b%b%b%b%06o\0 %b" % (name.ljust(100, b"\0"), self.MIDDLE, digits, self.BLANK[136:148], self.FIXED + sum(name) + sum(digits), self.END)

    def _write(self, block: bytes) -> None:
        self.f.write(block)
        self.written += len(block)

    def add(self, packet: dict) -> int:
        data = (packet["payload"] or "").encode()
        name = encode_name(*(packet[k] for k in ("index", "type", "id", "field")))
        if len(name) <= 100 and name.isascii() and len(data) < 1 << 33:
            head = self._header(name.encode(), len(data))
        else:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            head = info.tobuf(tarfile.GNU_FORMAT, "utf-8", "surrogateescape")
        self._write(head + data + b"\0" * (-len(data) % tarfile.BLOCKSIZE))
        return len(data)

    def close(self) -> None:
        self._write(b"\0" * (2 * tarfile.BLOCKSIZE))
        self._write(b"\0" * (-self.written % tarfile.RECORDSIZE))


class Forward(io.RawIOBase):
    """A file that only goes forward; ``zipfile`` then writes sizes behind its entries."""

    def __init__(self, f: BinaryIO):
        self.f = f

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.f.write(data)
        return len(data)


class ZipWriter:
    """Entries with their sizes before them, deflated where that makes them shorter. The directory is kept aside, on disk beyond 4 MB, so memory does not grow with the entries."""

    DAY = 33  # fixed value: 1980-01-01 as files have it
    MOST = 0xFFFFFFFF

    def __init__(self, f: BinaryIO):
        self.f, self.at, self.entries, self.directory = f, 0, 0, tempfile.SpooledTemporaryFile(4 << 20)

    def _write(self, block: bytes) -> None:
        self.f.write(block)
        self.at += len(block)

    def add(self, packet: dict) -> int:
        data = (packet["payload"] or "").encode()
        name = encode_name(*(packet[k] for k in ("index", "type", "id", "field"))).encode()
        tool = zlib.compressobj(6, zlib.DEFLATED, -15, 8 if len(data) > 1 << 10 else 2)
        small = tool.compress(data) + tool.flush() if len(data) > 32 else data
        method, held = (zipfile.ZIP_DEFLATED, small) if len(small) < len(data) else (zipfile.ZIP_STORED, data)
        same = struct.pack("<5H3L2H", 20, 0, method, 0, self.DAY, zlib.crc32(data), len(held), len(data), len(name), 0)
        extra = struct.pack("<2HQ", 1, 8, self.at) if self.at >= self.MOST else b""  # where the entry is, beyond four bytes
        record = same[:-2] + struct.pack("<4H2L", len(extra), 0, 0, 0, 0o600 << 16, min(self.at, self.MOST))
        self.directory.write(b"PK\x01\x02" + struct.pack("<H", 45 if extra else 20) + record + name + extra)
        self._write(b"PK\x03\x04" + same + name + held)
        self.entries += 1
        return len(data)

    def close(self) -> None:
        start = self.at
        self.directory.seek(0)
        while block := self.directory.read(1 << 20):
            self._write(block)
        self.directory.close()
        size = self.at - start
        if self.entries >= 0xFFFF or start >= self.MOST or size >= self.MOST:
            end = self.at
            self._write(b"PK\x06\x06" + struct.pack("<Q2H2L4Q", 44, 45, 45, 0, 0, self.entries, self.entries, size, start))
            self._write(b"PK\x06\x07" + struct.pack("<LQL", 0, end, 1))
        few = min(self.entries, 0xFFFF)
        self._write(b"PK\x05\x06" + struct.pack("<4H2LH", 0, 0, few, few, min(size, self.MOST), min(start, self.MOST), 0))


class CpioWriter:
    """New ASCII layout with numbered inodes. A name may not occur twice in a row; ``jobs.write_packets`` sorts names, so that none occurs twice."""

    def __init__(self, f: BinaryIO):
        self.f, self.last, self.entries, self.written = f, None, 0, 0

    def _entry(self, name: bytes, data: bytes, inode: int, mode: int) -> None:
        head = b"070701%08X%08X%016X%08X%08X%08X%032X%08X%08X%b\0" % (inode, mode, 0, 1, 0, len(data), 0, len(name) + 1, 0, name)
        out = head + b"\0" * (-len(head) % 4) + data + b"\0" * (-len(data) % 4)
        self.f.write(out)
        self.written += len(out)

    def add(self, packet: dict) -> int:
        name = encode_name(*(packet[k] for k in ("index", "type", "id", "field"))).encode()
        if name == self.last:
            raise ValueError(f"cpio entry is there already: {name.decode()}")
        self.last = name
        self.entries += 1
        data = (packet["payload"] or "").encode()
        self._entry(name, data, self.entries, 0o100644)
        return len(data)

    def close(self) -> None:
        self._entry(b"TRAILER!!!", b"", 0, 0)
        self.f.write(b"\0" * (-self.written % 512))


WRITERS = {"bulk": BulkWriter, "tar": TarWriter, "zip": ZipWriter, "cpio": CpioWriter}
READERS = {"tar": read_tar, "zip": read_zip, "cpio": read_cpio}
