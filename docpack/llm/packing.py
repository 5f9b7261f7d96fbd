"""Best-fit packing of tokenised documents by minimum bin slack.

Documents are cut into pieces of at most one sequence. A full piece is a sequence of its own; the others are dealt evenly into
pools of some thousand. In a pool, bins are filled one after the other: the longest piece left opens the bin, and a subset-sum
dynamic program on bitsets over the other lengths left finds the fullest combination, which is removed.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpack.session import small_batches, written

TWO_SPACES = re.compile(r"\s\s")
# fixed value: the special token of the vocabulary
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache
def encoders(vocabulary: str):
    """Two encoders with the ids of ``vocabulary`` (a ranks file): one for any text, one for texts without two spaces in a row.

    The pattern's look-ahead matters only where white spaces follow each other; without it, matching is faster.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    made = lambda name, pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return made("any", public_tokenizers.PATTERN), made("plain", public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", ""))


def token_ids(text: str, vocabulary: str, special: dict[str, int] | None = None) -> np.ndarray:
    """Ids of a text. A string of ``special`` is the one id that is given for it; what stands on either side is tokenised for itself."""
    every, plain = encoders(vocabulary)
    encoded = lambda t: (every if TWO_SPACES.search(t) else plain).encode_ordinary(t)
    if special and any(x in text for x in special):
        parts = re.split("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")", text)
        return np.array([i for k, t in enumerate(parts) for i in ([special[t]] if k % 2 else encoded(t))], "<u4")
    return np.array(encoded(text), "<u4")


def cut_pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = 2048, vocabulary: str = "byte_bpe_50k.tiktoken", end_id: int = 0, special: dict[str, int] | None = None) -> DataFrame:
    """``key, piece, start, length, ids`` (little-endian 32-bit numbers): each document's tokens and then ``end_id``.

    Only documents longer than ``capacity`` are cut; all their pieces but the first are full, so that one
    piece at most is left to pack. Null and empty texts are the one token ``end_id``. The ids are those that the same
    vocabulary's ``tokenizers`` file gives, with its one special token (``SPECIAL``) unless ``special`` names others.
    """
    special = SPECIAL if special is None else special
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for k, t in zip(batch["key"], batch["text"], strict=True):
                ids = np.append(token_ids(t, vocabulary, special), np.array([end_id], "<u4")) if t else np.array([end_id], "<u4")
                at, piece = 0, 0
                while at < len(ids):
                    stop = at + ((len(ids) - at) % capacity or capacity)
                    rows.append((k, piece, at, stop - at, ids[at:stop].astype("<u4").tobytes()))
                    at, piece = stop, piece + 1
                size += len(ids)
                if size > 1 << 19:
                    yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids"]).astype({"key": batch["key"].dtype})
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids"]).astype({"key": batch["key"].dtype})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInPandas(run, f"key {kind}, piece int, start long, length long, ids binary")


def fullest(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """Numbers of each length (descending, with counts) whose sum is the largest that fits ``room``.

    Bit s of a bitset says that some pieces add up to s. Stops at the first exact fit; among equal sums
    longer pieces are preferred.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for k, (length, n) in enumerate(zip(lengths, counts, strict=True)):
        if length > room:
            continue
        left, take = min(n, room // length), 1
        while left > 0:  # powers of two give every number of copies
            take = min(take, left)
            steps.append((k, take, reach))
            reach |= (reach << (take * length)) & mask
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, [0] * len(lengths)
    for k, take, before in reversed(steps):
        if not before >> total & 1:
            out[k] += take
            total -= take * lengths[k]
    return out


def fill_bins(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of the values in ``lengths`` by minimum bin slack, each with the longest value left."""
    values, counts = np.unique(lengths, return_counts=True)
    values, counts = [int(v) for v in values[::-1]], [int(c) for c in counts[::-1]]
    bins = []
    while values:
        first, room = values[0], capacity - values[0]
        counts[0] -= 1
        found = [first]
        if room > 0:
            for k, n in enumerate(fullest(values, counts, room)):
                if n:
                    found += [values[k]] * n
                    counts[k] -= n
        bins.append(found)
        if not all(counts):
            values = [v for v, c in zip(values, counts, strict=True) if c]
            counts = [c for c in counts if c]
    return bins


def pack(pieces: DataFrame, capacity: int = 2048, pool: int = 4096) -> DataFrame:
    """``pieces`` (with ``key``, ``piece``, ``length``) with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Pieces that fill a sequence are given one where they are, with a number below 0. The others are dealt evenly into pools of
    about ``pool``, by a hash of their row in the table of pieces, so that rows that agree in key, or in everything, are dealt like
    any others; a pool costs at most one bin of slack. Pieces of length 0 do not occur.
    """
    names = pieces.columns
    table = written(pieces.withColumn("__dp_row", F.monotonically_increasing_id()), "pieces")
    pools = max(1, -(-table.where(F.col("length") < capacity).count() // pool))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "__dp_row"], ascending=[False, True], kind="stable").reset_index(drop=True)
        own = int(group["__dp_pool"].iloc[0])
        lengths = group["length"].to_numpy()
        left = {int(v): list(at)[::-1] for v, at in pd.Series(np.arange(len(lengths))).groupby(lengths)}
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n, found in enumerate(fill_bins(lengths, capacity)):
            at = 0
            for value in found:
                row = left[value].pop()
                sequence[row], offset[row] = n * pools + own, at
                at += value
        return group[names].assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    dealt = table.where(F.col("length") < capacity).withColumn("__dp_pool", F.pmod(F.xxhash64("__dp_row"), F.lit(pools)).cast("int"))
    full = table.where(F.col("length") >= capacity).select(*names, (-1 - F.col("__dp_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return dealt.groupBy("__dp_pool").applyInPandas(run, schema).unionByName(full)


def pack_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = 2048, vocabulary: str = "byte_bpe_50k.tiktoken", pool: int = 4096, with_ids: bool = False, special: dict[str, int] | None = None) -> DataFrame:
    """Tokenises and packs ``docs``: one row per piece with ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``with_ids`` adds the ids themselves, which then travel with the pieces. An empty table gives no rows; a null key
    is packed like any other, and rows that repeat are packed one by one.
    """
    pieces = cut_pieces(docs, text, key, capacity, vocabulary, special=special)
    light = pieces.select("key", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *["ids"] * with_ids)
    packed = pack(light, capacity, pool)
    return packed.select(F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
