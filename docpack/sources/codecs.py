"""Compression by suffix: gz, bz2, xz, and lzf with its 64 KiB chunks."""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import struct
from typing import BinaryIO

CHUNK = 0xFFFF
CODECS = ("gz", "bz2", "xz", "lzf")


def lzf_expand(data: bytes, size: int) -> bytes:
    """One compressed chunk: literal runs, and copies from up to 8191 bytes back."""
    out, at = bytearray(), 0
    while at < len(data):
        control = data[at]
        at += 1
        if control < 32:
            out += data[at : at + control + 1]
            at += control + 1
            continue
        length = control >> 5
        if length == 7:
            length += data[at]
            at += 1
        start = len(out) - ((control & 31) << 8) - data[at] - 1
        at += 1
        if start < 0:
            raise ValueError("lzf copy from before the chunk")
        for k in range(start, start + length + 2):
            out.append(out[k])
    if len(out) != size:
        raise ValueError("lzf chunk has the wrong length")
    return bytes(out)


def lzf_compress(data: bytes) -> bytes:
    """Greedy matches of three bytes and more, found through the last place of each three bytes."""
    out, last = bytearray(), {}
    at = start = 0

    def literals(end: int) -> None:
        for k in range(start, end, 32):
            run = data[k : min(k + 32, end)]
            out.append(len(run) - 1)
            out.extend(run)

    while at < len(data) - 2:
        key = data[at : at + 3]
        seen = last.get(key, -1)
        last[key] = at
        if seen < 0 or at - seen > 8192:
            at += 1
            continue
        length, most = 3, min(264, len(data) - at)
        while length < most and data[seen + length] == data[at + length]:
            length += 1
        literals(at)
        back, size = at - seen - 1, length - 2
        out += bytes([min(size, 7) << 5 | back >> 8]) + (bytes([size - 7]) if size >= 7 else b"") + bytes([back & 255])
        at = start = at + length
    literals(len(data))
    return bytes(out)


class LzfReader(io.RawIOBase):
    def __init__(self, raw: BinaryIO):
        self.raw, self.rest = raw, b""

    def readable(self) -> bool:
        return True

    def _need(self, n: int) -> bytes:
        got = self.raw.read(n)
        if len(got) != n:
            raise EOFError("lzf stream ends inside a chunk")
        return got

    def readinto(self, into) -> int:
        while not self.rest:
            head = self.raw.read(5)
            if not head:
                return 0
            if len(head) < 5 or head[:2] != b"ZV":
                raise ValueError("not an lzf chunk")
            stored = struct.unpack(">H", head[3:])[0]
            if head[2] == 0:
                self.rest = self._need(stored)
            else:
                size = struct.unpack(">H", self._need(2))[0]
                self.rest = lzf_expand(self._need(stored), size)
        n = min(len(into), len(self.rest))
        into[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


class LzfWriter(io.RawIOBase):
    def __init__(self, raw: BinaryIO):
        self.raw, self.buffer = raw, bytearray()

    def writable(self) -> bool:
        return True

    def _chunk(self, data: bytes) -> None:
        small = lzf_compress(data)
        if len(small) + 2 < len(data):
            self.raw.write(b"ZV\x01" + struct.pack(">HH", len(small), len(data)) + small)
        else:
            self.raw.write(b"ZV\x00" + struct.pack(">H", len(data)) + data)

    def write(self, data) -> int:
        self.buffer += data
        while len(self.buffer) >= CHUNK:
            self._chunk(bytes(self.buffer[:CHUNK]))
            del self.buffer[:CHUNK]
        return len(data)

    def close(self) -> None:
        if not self.closed:
            if self.buffer:
                self._chunk(bytes(self.buffer))
                self.buffer.clear()
            super().close()


def reader(raw: BinaryIO, codec: str) -> BinaryIO:
    if codec == "lzf":
        return io.BufferedReader(LzfReader(raw), 1 << 16)
    return {"": lambda: raw, "gz": lambda: gzip.GzipFile(fileobj=raw), "bz2": lambda: bz2.BZ2File(raw), "xz": lambda: lzma.LZMAFile(raw)}[codec]()


def writer(raw: BinaryIO, codec: str) -> BinaryIO:
    """Closing it completes the stream and leaves ``raw`` open. Archives of equal content are equal: no times are stored."""
    return {
        "": lambda: raw,
        "gz": lambda: gzip.GzipFile(filename="", mode="wb", fileobj=raw, mtime=0, compresslevel=6),
        "bz2": lambda: bz2.BZ2File(raw, "wb"),
        "xz": lambda: lzma.LZMAFile(raw, "wb", preset=1),
        "lzf": lambda: LzfWriter(raw),
    }[codec]()
