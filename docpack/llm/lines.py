"""Line deduplication with two Bloom filters.

Hashes of long lines are dealt into ranges, as many as the lines ask for. The task of a range reads them into a filter of those
seen once and one of those seen twice, both of a fixed size, and gives out the second one; it keeps no hashes. Lines ask these
filters where their documents are, as long as all filters together are small enough to be broadcast (``sided``), else where a range's filter is.
Only lines that are suspected so go on, are counted, and of these only the ones that enough documents hold are shuffled with their
text, to be confirmed exactly and to find the document that keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from docpack.llm.text import SPACES
from docpack.session import sided, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_BITS = 1 << 24
RANGE_LINES = 1 << 20
PROBES = 4


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """Each line without ASCII white space at both ends, A-Z in lower case."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.transform(F.split(lowered, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)))


def line_hashes(keys: Column, min_chars: int) -> Column:
    """For each key its hash, or 0 if it is short."""
    h = lambda x: F.xxhash64(x)
    return F.transform(keys, lambda x: F.when(F.char_length(x) >= min_chars, F.when(h(x) == 0, 1).otherwise(h(x))).otherwise(0))


def _bits(mixed: np.ndarray, bits: int) -> np.ndarray:
    """Places of each mixed hash in a filter: one row per probe, from its lower half by steps of its upper half."""
    low, high = mixed & 0xFFFFFFFF, (mixed >> 32) & 0xFFFFFFFF
    return np.stack([(low + k * high) % bits for k in range(PROBES)])


def _asked(mixed: Column, words: Column, bits: int) -> Column:
    """Whether the filter in ``words`` (64 bits each) has all places of ``mixed``: what ``_bits`` and ``_has`` say, as a column."""
    low, high = mixed.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(mixed, 32)
    places = [(low + F.lit(k) * high) % F.lit(bits) for k in range(PROBES)]
    tests = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in places]
    return reduce(Column.__and__, tests)


def _has(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _set(filter_: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    np.bitwise_or.at(filter_, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))


def _once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of a batch of documents, each once, and whether the batch has it again: a common line travels once for each batch."""
    for batch in batches:
        lists = [x for x in batch["hashes"] if len(x)]
        if lists:
            seen, counts = np.unique(np.concatenate(lists), return_counts=True)
            yield pd.DataFrame({"h": seen, "again": counts > 1})


def _twice(bits: int):
    """The filter of what a range's rows have twice; the task holds this one and that of what was seen once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice, own = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8), None
        for batch in batches:
            if not len(batch):
                continue
            own = int(batch["range"].iloc[0])
            mixed = batch["mixed"].to_numpy(np.int64)
            seen, counts = np.unique(mixed, return_counts=True)
            again = counts > 1
            again[np.searchsorted(seen, mixed[batch["again"].to_numpy(bool)])] = True
            at = _bits(seen, bits)
            _set(twice, at[:, again | _has(once, at)])
            _set(once, at)
        if own is not None and twice.any():
            yield pd.DataFrame({"range": [own], "words": [twice.view("<i8")]})

    return run


def suspected(hashes: DataFrame, bits: int = FILTER_BITS, range_lines: int = RANGE_LINES) -> DataFrame:
    """``hashes`` with one row for each element ``h`` of its column ``hashes`` (array of long, distinct in each row) that another row holds too, and few others.

    A range has about ``range_lines`` hashes for filters of ``bits`` (a multiple of 64), so their number grows with the lines.
    """
    n = hashes.agg(F.sum(F.size("hashes"))).first()[0] or 0
    ranges = max(1, -(-n // range_lines))
    placed = {"range": F.pmod(F.xxhash64("h", F.lit(1)), F.lit(ranges)).cast("int"), "mixed": F.xxhash64("h")}
    once = hashes.select("hashes").mapInPandas(_once, "h long, again boolean").withColumns(placed).select("range", "mixed", "again")
    filters = written(once.repartitionById(ranges, "range").mapInPandas(_twice(bits), "range int, words array<long>"), "line-filters", narrow=True)
    rows = hashes.select(*[c for c in hashes.columns if c != "hashes"], F.explode("hashes").alias("h")).withColumns(placed)
    filters = sided(filters.withColumnRenamed("range", "_range"))
    return rows.join(filters, (F.col("range") == F.col("_range")) & _asked(F.col("mixed"), F.col("words"), bits), "left_semi").drop("range", "mixed")


PLACES = StructType([StructField("pos", ArrayType(IntegerType())), StructField("first", ArrayType(BooleanType()))])


def _places(hashes: pd.Series, wanted: pd.Series) -> pd.DataFrame:
    """Where ``wanted`` hashes are in ``hashes``, and whether it is the first place of that hash."""
    pos, first = [], []
    for h, w in zip(hashes, wanted, strict=True):
        at = np.flatnonzero(np.isin(h, w))
        new = np.zeros(len(at), bool)
        new[np.unique(np.asarray(h)[at], return_index=True)[1]] = True
        pos.append(at.astype(np.int32))
        first.append(new)
    return pd.DataFrame({"pos": pos, "first": first})


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = 40, min_docs: int = 5, bits: int = FILTER_BITS, range_lines: int = RANGE_LINES) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    Lines whose key has at least ``min_chars`` code points and is found in at least ``min_docs`` documents are dropped, but
    for all of them in the largest ``key`` that holds it. Null and empty texts are one empty line. Rows with
    equal ``key`` count as documents of their own and share the verdict. A null key is the least: it keeps a line
    only if no other document holds it. An empty table gives an empty result; columns of the added names are replaced.
    """
    columns = [c for c in docs.columns if c.lower() not in ("kept_text", "n_lines", "n_dropped")]
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("content", F.xxhash64("text"))
    hashes = F.array_distinct(F.filter(line_hashes(line_keys(F.col("text")), min_chars), lambda h: h != 0))
    found = written(rows.select("id", "content", hashes.alias("hashes")).where(F.size("hashes") > 0), "line-hashes")
    pairs = written(suspected(found, bits, range_lines), "line-suspects")
    often = written(pairs.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("h"), "line-often", narrow=True)
    marked = pairs.join(sided(often), "h", "left_semi").groupBy("id", "content").agg(F.collect_set("h").alias("wanted"))
    marked = written(marked.select(F.col("id").alias("_id"), F.col("content").alias("_content"), "wanted"), "line-marked")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content"))
    holders = rows.join(sided(marked), same).withColumn("keys", line_keys(F.col("text")))
    places = holders.withColumn("at", F.pandas_udf(_places, PLACES)(line_hashes(F.col("keys"), min_chars), "wanted"))
    one = F.explode(F.transform(F.arrays_zip("at.pos", "at.first"), lambda p: F.struct(p["pos"].alias("pos"), p["first"].alias("first"), F.get("keys", p["pos"]).alias("line"))))
    suspects = written(places.select("id", "content", one.alias("x")).select("id", "content", "x.*"), "line-texts")
    repeats = suspects.groupBy("line").agg(F.sum(F.col("first").cast("long")).alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    repeats = written(repeats.select("line", "keeper"), "line-repeats")  # a table of its own, so that the join can split a very common line
    lost = suspects.join(sided(repeats), "line").where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id", "content").agg(F.collect_set("pos").alias("lost"))
    lost = written(lost.select(F.col("id").alias("__dp_id"), F.col("content").alias("__dp_content"), F.col("lost").alias("__dp_lost")), "line-lost")
    joined = docs.select(*[F.col(f"`{c}`") for c in columns]).join(sided(lost), F.col(f"`{key}`").eqNullSafe(F.col("__dp_id")) & (F.xxhash64(F.col(f"`{text}`").cast("string")) == F.col("__dp_content")), "left")
    lines = split_lines(F.col(f"`{text}`").cast("string"))
    places_left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__dp_lost")
    kept = F.when(F.col("__dp_lost").isNull(), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).otherwise(F.array_join(F.transform(places_left, lambda p: F.get(lines, p)), "\n"))
    n_dropped = F.coalesce(F.size("__dp_lost"), F.lit(0))
    return joined.select(*[F.col(f"`{c}`") for c in columns], kept.alias("kept_text"), F.size(lines).cast("long").alias("n_lines"), F.when(F.col("__dp_lost").isNull(), 0).otherwise(n_dropped).cast("long").alias("n_dropped"))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, k.n, k.line, r.key IS NOT NULL AND r.keeper <> k.doc_id AS dropped FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
