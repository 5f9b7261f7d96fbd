"""Column expressions and numpy helpers for the words of a text: maximal runs outside the six ASCII white spaces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
U = np.uint64
HASH_BITS = 60
SLICE = 1 << 20


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def key_hash(*parts: Column | str) -> Column:
    """The first 60 bits of an MD5 as a long; null parts count as the text ``null``."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def hash_bucket(h: Column, buckets: int) -> Column:
    """The leading bits of a 60-bit hash, so that buckets follow the order of the hash."""
    return F.shiftright(h, HASH_BITS - (buckets.bit_length() - 1)).cast("int")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, 0x9E3779B97F4A7C15, U)
        out[0] = 1
        return np.multiply.accumulate(out)


_POW = _powers(256)


def _slices(buf: np.ndarray, space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of slices of about ``SLICE`` bytes that end at white space."""
    at = 0
    while at < len(buf):
        end = min(at + SLICE, len(buf))
        if end < len(buf):
            step = np.flatnonzero(space[end : end + SLICE])
            while not len(step) and end + SLICE < len(buf):
                end += SLICE
                step = np.flatnonzero(space[end : end + SLICE])
            end = end + int(step[0]) if len(step) else len(buf)
        yield at, end
        at = end


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in order, and for each text where its words begin (one more at the end).

    The same word has the same hash in every process. Works through the bytes slice by slice, so a very
    long text needs no more working memory than many short ones.
    """
    global _POW
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    hashes, places = [], []
    for lo, hi in _slices(buf, space):
        solid = ~space[lo:hi]
        at = np.flatnonzero(solid)
        if not len(at):
            continue
        first = np.empty(len(at), bool)
        first[0] = True
        np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(at)))
        inside = np.arange(len(at)) - np.repeat(starts, lengths)
        if (longest := int(lengths.max())) > len(_POW):
            _POW = _powers(longest)
        with np.errstate(over="ignore"):
            values = (buf[lo:hi][at].astype(U) + U(1)) * _POW[inside]
            hashes.append(mix(np.add.reduceat(values, starts) + lengths.astype(U) * U(0xD6E8FEB86659FD93)))
        places.append(at[starts] + lo)
    if not hashes:
        return np.zeros(0, U), np.zeros(len(texts) + 1, np.int64)
    where = np.concatenate(places)
    return np.concatenate(hashes), np.concatenate(([0], np.searchsorted(where, ends))).astype(np.int64)


def shingles(words: np.ndarray, starts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words in each text, and where each text's begin.

    A text of fewer words has one shingle of all its words; a text without words has none.
    """
    n = np.diff(starts)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out_starts = np.concatenate(([0], np.cumsum(count))).astype(np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(int(out_starts[-1]), U)
        m = max(0, len(words) - size + 1)
        rolled = np.zeros(m, U)
        for k in range(size):
            rolled += words[k : k + m] * U(2 * k + 0x9E3779B97F4A7C15)
        rolled = mix(rolled)
        full = n >= size
        if full.any():
            at = np.repeat(starts[:-1][full] - out_starts[:-1][full], count[full])
            place = np.concatenate([np.arange(a, b) for a, b in zip(out_starts[:-1][full], out_starts[1:][full], strict=True)])
            out[place] = rolled[place + at]
        for i in np.flatnonzero((n > 0) & (n < size)):
            own = words[starts[i] : starts[i + 1]]
            out[out_starts[i]] = mix(np.sum(own * (np.arange(1, len(own) + 1, dtype=U) * U(0xA24BAED4963EE407)), dtype=U).reshape(1))[0]
    return out, out_starts
