"""Structured Streaming: import from a landing directory, copies between stores, and transfer rates."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpack.model import KEY
from docpack.operators import reshape, store
from docpack.plans.jobs import RUN_EVENT, put_metadata
from docpack.session import new_path, written
from docpack.sources import archive, feed


def _run(stream: DataFrame, each, checkpoint: str | None, name: str, every: str | None = None, mode: str = "append"):
    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint or new_path(stream.sparkSession, f"{name}-checkpoint"))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _appended(docs: DataFrame, root: str, checkpoint: str, n: int, order: str, compact_after: int) -> None:
    """Adds batch ``n`` of the stream with this checkpoint to a store, and compacts the store when it has ``compact_after`` deltas.

    The first documents of a store go to its buckets at once, as there is nothing to rewrite. Documents with versions replace lower ones only.
    """
    if not store.has_buckets(docs.sparkSession, root):
        store.upsert(docs, root, order=order, versions=True)
    elif store.append(docs, root, hashlib.sha256(checkpoint.encode()).hexdigest()[:16], n, order, versions=True) >= compact_after:
        store.compact(docs.sparkSession, root)


def import_stream(spark: SparkSession, landing: str, root: str, rename: dict | None = None, checkpoint: str | None = None, every: str | None = None, with_metadata: bool = True, with_aliases: bool = True, compact_after: int = 64, max_files: int = 0):
    """Imports archive files as they land, settings, mappings and aliases before documents; a file is whole in one batch, and so are its documents.

    Batches are appended to the store, which is compacted after every ``compact_after``. A batch may be run again without harm.
    ``max_files`` bounds the files of a batch (0: none); a stream without ``every`` is one batch then.
    """
    archive.register(spark)
    checkpoint = checkpoint or new_path(spark, "import-checkpoint")

    def each(batch: DataFrame, n: int) -> None:
        rows = written(reshape.kinds(batch), "landed")
        if with_metadata:
            put_metadata(reshape.packets_metadata(rows.where("kind <> 'doc'").withColumn("payload", F.col("fields")["_source"])), root, rename, None, None, with_aliases, "warn")
        docs = reshape.rename(reshape.route_fields(rows.where("kind = 'doc' AND index IS NOT NULL").drop("kind")), rename)
        _appended(docs.withColumn("_order", F.struct("part", "archive", "run")), root, checkpoint, n, "_order", compact_after)

    return _run(spark.readStream.format("docpack_archive").option("documents", "true").option("log", f"{checkpoint}/archive-files").option("maxFiles", max_files).load(landing), each, checkpoint, "import", every)


def copy_stream(spark: SparkSession, from_root: str, to_root: str, rename: dict | None = None, checkpoint: str | None = None, changes_per_batch: int = 0, every: str | None = None, compact_after: int = 64):
    """Copies a store and then follows its changes, so a write of ten documents copies ten; batches are appended as ``import_stream``'s are.

    ``changes_per_batch`` bounds the writes that a batch takes (0: none); a stream without ``every`` is one batch then.
    """
    spark.dataSource.register(feed.StoreFeed)
    checkpoint = checkpoint or new_path(spark, "copy-checkpoint")
    stream = spark.readStream.format("docpack_feed").option("maxChanges", changes_per_batch).option("log", f"{checkpoint}/feed-end").load(from_root)

    def each(batch: DataFrame, n: int) -> None:
        _appended(reshape.rename(batch, rename), to_root, checkpoint, n, "_seq", compact_after)

    return _run(stream, each, checkpoint, "copy", every)


def assemble_stream(spark: SparkSession, landing: str, out: str, checkpoint: str | None = None):
    """Documents of archive files as they land, as Parquet; archives are whole in a batch, so no state is kept between batches."""
    archive.register(spark)
    checkpoint = checkpoint or new_path(spark, "assemble-checkpoint")

    def each(batch: DataFrame, n: int) -> None:
        docs = reshape.route_fields(reshape.kinds(batch).where("kind = 'doc' AND index IS NOT NULL").drop("kind"))
        docs.select(*KEY, "_source").write.mode("overwrite").parquet(f"{out}/batch={n}")

    stream = spark.readStream.format("docpack_archive").option("documents", "true").option("log", f"{checkpoint}/archive-files").load(landing)
    return _run(stream, each, checkpoint, "assemble")


def rates(log: DataFrame, late: str = "5 seconds", width: str = "1 second", slide: str | None = None) -> DataFrame:
    """Bytes by second of a stream ``ts, bytes`` (or sliding, for the recent rate); what is later than the watermark is left out."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return log.withWatermark("ts", late).groupBy(window.alias("w")).agg(F.sum("bytes").cast("long").alias("bytes")).select(F.unix_timestamp("w.start").alias("second"), "bytes")


def keep_rates(rates_: DataFrame, out: str, checkpoint: str | None = None, every: str | None = None):
    """Keeps a stream of ``rates`` in ``out``: each batch's changed seconds. State is dropped behind the watermark."""
    put = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
    return _run(rates_, put, checkpoint, "rates", every, mode="update")


def kept_rates(spark: SparkSession, out: str) -> DataFrame:
    """The last bytes of each second that ``keep_rates`` has seen."""
    rows = spark.read.schema("second long, bytes long, batch long").parquet(out)
    return rows.groupBy("second").agg(F.max_by("bytes", "batch").alias("bytes"))


RUN_STATE = "run_id string, mode string, path string, state string, heard timestamp"


def _heard(silent_ms: int):
    """The state of a run: finished or failed by its own word, silent when nothing was heard of it for a while, else running."""

    def step(key, batches, state):
        last = list(state.get) if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([[key[0], last[0], last[1], "silent", last[2]]], columns=["run_id", "mode", "path", "state", "heard"])
            return
        ended = None
        for batch in batches:
            for r in batch.itertuples():
                if last is None or r.at >= last[2]:
                    last = [r.mode, r.path, r.at]
                ended = r.event if r.event in ("finished", "failed") else ended
        if ended:
            if state.exists:
                state.remove()
        else:
            state.update((last[0], last[1], last[2].to_pydatetime()))
            state.setTimeoutDuration(silent_ms)
        yield pd.DataFrame([[key[0], last[0], last[1], ended or "running", last[2]]], columns=["run_id", "mode", "path", "state", "heard"])

    return step


def watch_runs(spark: SparkSession, folder: str, out: str, silent_seconds: float = 120, checkpoint: str | None = None, every: str = "10 seconds"):
    """Follows the run log of a folder and keeps what becomes of each run in ``out``; a run that is silent too long is closed by a timer.

    State is kept for runs that go on only.
    """
    fs, inner = archive.file_system(folder)
    fs.create_dir(f"{inner}/_runs", recursive=True)
    events = spark.readStream.schema(RUN_EVENT).option("ignoreMissingFiles", "true").json(f"{folder}/_runs").select("run_id", "mode", "path", "event", "at")
    states = events.groupBy("run_id").applyInPandasWithState(_heard(int(silent_seconds * 1000)), RUN_STATE, "mode string, path string, heard timestamp", "append", "ProcessingTimeTimeout")
    put = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
    return _run(states, put, checkpoint, "runs", every)


def watched_runs(spark: SparkSession, out: str) -> DataFrame:
    """The last state of each run that ``watch_runs`` has seen."""
    rows = spark.read.schema(f"{RUN_STATE}, batch long").parquet(out)
    return rows.groupBy("run_id").agg(F.max_by(F.struct("mode", "path", "state", "heard"), "batch").alias("r")).select("run_id", "r.*")
