"""Exact deduplication as a stateful stream.

A stream runs through (digest, identifier, locator) of every document; its keyed state, kept on disk without expiry, retains
for each digest the document that stays, where that content lies, and a count. Documents whose digest was met before are hits:
their whole normalised texts are compared with the text that the state names. A folder keeps records, state and checkpoint, so
that a later delivery of documents is held against all earlier ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpack.llm.text import SPACES
from docpack.session import new_path, sided, written

#: State on disk; only changes are uploaded with each batch, no space is set aside for state yet to come, and an executor's stores share a bounded memory.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
}


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


RECORD = "digest string, id {kind}, content long, delivery long, place long, locator string"


def deliver(docs: DataFrame, folder: str, digest=sha256) -> tuple[DataFrame, int]:
    """Adds the records of ``docs`` (``id``, ``norm``, ``content``, ``locator``) to the folder as its next delivery; they and its number.

    ``place`` numbers the rows of a delivery; once written it tells rows apart that agree in everything else. Records are written aside and
    get their place as a whole, so a delivery that breaks off leaves none.
    """
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/records")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    number = 1 + max((int(x.getPath().getName()) for x in fs.listStatus(path)), default=-1) if fs.exists(path) else 0
    own, aside = f"{folder}/records/{number:09d}", f"{folder}/aside-{uuid.uuid4().hex}"
    kind = docs.schema["id"].dataType.simpleString()
    records = docs.select(digest(F.col("norm")).alias("digest"), "id", "content", F.lit(number).cast("long").alias("delivery"), F.monotonically_increasing_id().alias("place"), "locator")
    records.write.parquet(aside)
    fs.mkdirs(path)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(aside), spark._jvm.org.apache.hadoop.fs.Path(own)):
        raise RuntimeError(f"another delivery has written {own}")
    return spark.read.schema(RECORD.format(kind=kind)).parquet(own), number


def stream_state(spark, folder: str, kind: str, files_per_batch: int = 10_000, of: DataFrame | None = None) -> DataFrame:
    """Runs the records of ``folder`` that were not yet read through the keyed state, and returns what it has (``of`` these digests only).

    ``digest, first, group_size``: ``first`` is the row of the first delivery that had the digest, of these the one with the least
    id (null ids last) and place. The state's changes of each micro-batch are written under the batch's number, so that a
    batch that is run again replaces its own. Counts only grow, so the last change of a digest is its largest count.
    """
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(RECORD.format(kind=kind)).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(f"{folder}/records")
        order = F.struct(F.col("delivery"), F.col("id").isNull().alias("none"), F.col("id"), F.col("place"), F.col("content"), F.col("locator"))
        state = stream.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
        put = lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={n}")
        state.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changes = spark.read.schema(state.schema).option("basePath", f"{folder}/changes").parquet(f"{folder}/changes")
    changes = changes.join(of, "digest", "left_semi") if of is not None else changes
    return changes.groupBy("digest").agg(F.max_by("first", "group_size").alias("first"), F.max("group_size").alias("group_size"))


def _fetched(spark, wanted: DataFrame, text: str, key: str, kind: str) -> DataFrame:
    """``id, content, norm`` of documents of earlier deliveries, from the files that their locators (``wanted``: ``id, content, locator``) name."""
    files = [r["locator"] for r in wanted.select("locator").distinct().collect()]  # names of files that hold hits
    if not all(files):
        raise ValueError("documents of an earlier delivery did not come from files, so their texts cannot be compared")
    if not files:
        return wanted.select("id", "content", F.lit("").alias("norm")).where("false")
    rows = spark.read.schema(f"`{key}` {kind}, `{text}` string").parquet(*files)
    rows = rows.select(F.col(key).alias("id"), F.xxhash64(text).alias("content"), normalised(F.col(text)).alias("norm"))
    return rows.join(sided(wanted.select(F.col("id").alias("_id"), F.col("content").alias("_content")).distinct()), F.col("id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")), "left_semi")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", digest=sha256, files_per_batch: int = 10_000, folder: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, keep_locator, group_size, kept, text_digest``, and ``content`` (a hash of the text as it is).

    ``doc_id`` is the key. Of equal normalised texts the least key stays; null keys come last. Null texts count as empty,
    and empty texts are equal to each other. Rows that repeat key and text form one group with one row kept. Texts
    that share a digest but differ (``digest`` may be weak) are grouped by the texts themselves. Other columns of
    ``docs`` are ignored, whatever their names. An empty table gives an empty result.

    With ``folder`` the documents are its next delivery: a text that an earlier one had is kept there and not again, and groups count
    documents of all deliveries. Texts of earlier ones are read anew from their Parquet files, only those that hold hits.
    Without, the state lives as long as the call.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    folder = (folder or new_path(spark, "dedup")).rstrip("/")
    raw = F.col(text).cast("string")
    source = docs.select(F.col(key).alias("id"), normalised(raw).alias("norm"), F.xxhash64(raw).alias("content"), F.input_file_name().alias("locator"))
    records, number = deliver(source, folder, digest)
    # earlier deliveries had other digests too, which do not matter now
    of = sided(written(records.select("digest").distinct(), "dedup-digests")) if number else None
    state = stream_state(spark, folder, kind, files_per_batch, of).where("group_size > 1")
    repeated = written(state.select("digest", "first", "group_size"), "dedup-repeated")
    small = sided(repeated)
    found = records.join(small, "digest", "left")
    own = F.col("group_size").isNull() | ((F.col("first.delivery") == F.col("delivery")) & (F.col("first.place") == F.col("place")))
    found = found.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.when(F.col("group_size").isNull(), F.col("locator")).otherwise(F.col("first.locator")).alias("keep_locator"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        own.alias("kept"), F.col("digest").alias("text_digest"), "content", "place",
    )
    # the whole texts of hits and of what the state names, whether they came now or earlier: equal if the least is the greatest
    hits = written(records.join(small, "digest", "left_semi").select(F.col("id").alias("_id"), F.col("content").alias("_content")).distinct(), "dedup-hits")
    texts = source.join(sided(hits), F.col("id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")), "left_semi")
    earlier = records.select("digest").join(small, "digest").where(F.col("first.delivery") < number).select("first.*").select("id", "content", "locator").distinct()
    if number:
        texts = texts.select("norm").unionByName(_fetched(spark, written(earlier, "dedup-earlier"), text, key, kind).select("norm"))
    differ = texts.groupBy(digest(F.col("norm")).alias("digest")).agg(F.min("norm").alias("a"), F.max("norm").alias("b")).where("a <> b").select("digest")
    differ = written(differ, "dedup-differ")
    if not differ.isEmpty():
        found = _by_text(spark, source, records, differ, found, folder, number, text, key, kind)
    return found.select("doc_id", "keep_id", "keep_locator", "group_size", "kept", "text_digest", "content")


def _by_text(spark, source: DataFrame, records: DataFrame, clashing: DataFrame, found: DataFrame, folder: str, number: int, text: str, key: str, kind: str) -> DataFrame:
    """Groups anew, by whole texts, all documents whose digest stands for more than one text."""
    every = spark.read.schema(RECORD.format(kind=kind)).option("recursiveFileLookup", "true").parquet(f"{folder}/records").join(clashing, "digest", "left_semi")
    every = written(every, "dedup-clashing")
    texts = source.select("id", "content", "norm")
    if number:
        texts = texts.unionByName(_fetched(spark, every.where(F.col("delivery") < number).select("id", "content", "locator"), text, key, kind))
    texts = texts.select(F.col("id").alias("_id"), F.col("content").alias("_content"), "norm").distinct()
    rows = written(every.join(texts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content"))).drop("_id", "_content"), "dedup-texts")
    order = F.struct(F.col("delivery"), F.col("id").isNull().alias("none"), F.col("id"), F.col("place"), F.col("locator"))
    groups = written(rows.groupBy("digest", "norm").agg(F.min(order).alias("first"), F.count("*").alias("group_size")), "dedup-by-text")
    own = rows.where(F.col("delivery") == number).join(groups, ["digest", "norm"]).select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("keep_id"), F.col("first.locator").alias("keep_locator"), "group_size",
        ((F.col("first.delivery") == F.col("delivery")) & (F.col("first.place") == F.col("place"))).alias("kept"), F.col("digest").alias("text_digest"), "content", "place",
    )
    return found.join(clashing.withColumnRenamed("digest", "text_digest"), "text_digest", "left_anti").unionByName(own)


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group of equal normalised texts.

    Of rows that repeat key and text as they are, the one with the least digest of all its columns stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    groups = written(exact_groups(docs, text, key, **options).select(F.col("doc_id").alias("__dp_id"), F.col("content").alias("__dp_content"), "kept", "group_size").where("group_size > 1"), "dedup-grouped")
    # rows are told apart by key and text; of those that no other row repeats, the ones that are not kept go
    by_row = groups.groupBy("__dp_id", "__dp_content").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__dp_id")) & (F.xxhash64(F.col(f"`{text}`").cast("string")) == F.col("__dp_content"))
    lost = written(by_row.where("NOT kept").select("__dp_id", "__dp_content"), "dedup-lost")
    again = written(by_row.where("kept AND n > 1").select("__dp_id", "__dp_content"), "dedup-again")
    if again.isEmpty():
        return docs.join(sided(lost), same, "left_anti").select(*columns)
    kept = docs.join(sided(lost.unionByName(again)), same, "left_anti").select(*columns)
    row = F.struct(*columns)
    one = docs.join(sided(again), same).groupBy("__dp_id", "__dp_content").agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("row"))
    return kept.unionByName(one.select("row.*"))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
