"""A store of documents: Parquet by index and hash bucket of the id, beside a table of index metadata.

    <root>/docs/gen=<seq>/index=<name>/bucket=<n>/...   documents, as the write ``seq`` left these buckets
    <root>/changes/seq=<seq>/...                        documents of a write, as they came
    <root>/layout/<seq>.json                            which buckets and changes are the store; the last one counts
    <root>/meta/index=<name>/...                        settings, mappings, aliases

A write adds files first and its layout last, so readers have the state before it or after it, never one between. An index has as many
buckets as shards. Buckets are found by linear hashing: one more shard takes rows out of one bucket only, so another number of
shards, given with any write, moves the rows of the buckets that it splits or joins.

A write is a change: ``append`` leaves it beside the buckets, to be merged as it is read, ``upsert`` and ``compact`` put changes into the
buckets they touch. A document with a version replaces one of a lower version only; one without replaces any. Changes of
the last writes are kept as a feed that copies follow. One writer at a time may write to a store.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructType

from docpack.functions.predicates import of_types
from docpack.model import DOC, KEY, META, struct
from docpack.operators.reshape import highest_version, last_writer
from docpack.session import written

SHARDS = 4
FEED = 64
BROADCAST = 32 << 20
DOC_SCHEMA, META_SCHEMA = struct(DOC), struct(META)
CHANGE_SCHEMA = StructType([*DOC_SCHEMA.fields]).add("_seq", LongType()).add("_plain", BooleanType())


# -- files


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.delete(p, True)


# -- layout


@dataclass
class Layout:
    """What a store consists of after the write ``seq``."""

    seq: int = 0
    counts: dict[str, int] = field(default_factory=dict)  # buckets of each index
    buckets: dict[str, dict[str, int]] = field(default_factory=dict)  # of each index and bucket that has rows the generation
    changes: list[dict] = field(default_factory=list)  # oldest first: seq, rows, bytes of keys, indices, writer, batch, merged
    since: int = 0  # changes up to this one are no longer kept

    def deltas(self) -> list[dict]:
        """Changes that are not in the buckets yet."""
        return [c for c in self.changes if not c["merged"]]


def layout(spark: SparkSession, root: str) -> Layout:
    """The layout that the last write left; an empty one where there is no store."""
    names = _layouts(spark, root)
    return _read_layout(spark, root, names[-1]) if names else Layout()


def _layouts(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _names(spark, f"{root}/layout") if n.endswith(".json")]


def _read_layout(spark: SparkSession, root: str, name: str) -> Layout:
    fs, p = _path(spark, f"{root}/layout/{name}")
    stream = fs.open(p)
    try:
        return Layout(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, new: Layout) -> None:
    """Makes ``new`` the layout of the store: a file that is written aside and gets its name at the end."""
    gone = [c for c in new.changes[:-FEED] if c["merged"]]
    new.changes = [c for c in new.changes if c not in gone]
    new.since = max([new.since, *[c["seq"] for c in gone]])
    fs, aside = _path(spark, f"{root}/layout/_aside")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(new.__dict__).encode()))
    out.close()
    _, named = _path(spark, f"{root}/layout/{new.seq:012d}.json")
    if fs.exists(named) or not fs.rename(aside, named):
        raise RuntimeError(f"another writer has written to {root}")
    recover(spark, root, keep=2)


def recover(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Deletes what writes that broke off have left, and what only layouts before the last ``keep`` had; returns how many folders of files went.

    Each write does so for all but the last two layouts, so results of a scan can be read while one more write goes on.
    """
    names = _layouts(spark, root)
    for n in names[:-keep]:
        _delete(spark, f"{root}/layout/{n}")
    live: set[str] = set()
    for n in names[-keep:]:
        held = _read_layout(spark, root, n)
        live |= {f"changes/seq={c['seq']}" for c in held.changes}
        live |= {f"docs/gen={g}" for own in held.buckets.values() for g in own.values()}
        live |= {f"docs/gen={g}/{_of(spark, i)}/bucket={b}" for i, own in held.buckets.items() for b, g in own.items()}
    went = 0
    for folder in ("docs", "changes"):
        for n in _names(spark, f"{root}/{folder}"):
            if "=" in n and f"{folder}/{n}" not in live:
                went += _delete(spark, f"{root}/{folder}/{n}")
            elif folder == "docs" and "=" in n:  # some of its buckets were written again
                for i in _names(spark, f"{root}/docs/{n}"):
                    for b in _names(spark, f"{root}/docs/{n}/{i}") if "=" in i else []:
                        if f"docs/{n}/{i}/{b}" not in live:
                            went += _delete(spark, f"{root}/docs/{n}/{i}/{b}")
    return went


def _of(spark: SparkSession, index: str) -> str:
    """The folder of an index."""
    return "index=" + spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(index)


def linear_bucket(h: int, count: int) -> int:
    """The bucket of a hash among ``count``: its low bits, one bit fewer where that bucket is not there yet."""
    high = 1 << count.bit_length()
    return h % high if h % high < count else h % (high >> 1)


def changed_buckets(old: int, new: int) -> set[int]:
    """Buckets of ``new`` whose rows another number of shards changes."""
    less, more = min(old, new), max(old, new)
    there = {linear_bucket(b, less) for b in range(less, more)}
    return there | set(range(less, more)) if new > old else there


def bucketed(docs: DataFrame, counts: dict[str, int]) -> DataFrame:
    """With the ``linear_bucket`` of each id among its index's, ``SHARDS`` where no count is given."""
    of = lambda given, other: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in given.items() for x in pair]), F.col("index")), F.lit(other)) if given else F.lit(other)
    count, high = of(counts, SHARDS), of({i: 1 << n.bit_length() for i, n in counts.items()}, 2 * SHARDS)
    low = F.pmod(F.hash("id"), high)
    return docs.withColumn("bucket", F.when(low < count, low).otherwise(F.pmod(F.hash("id"), (high / 2).cast("int"))).cast("int"))


def shard_counts(meta: DataFrame) -> DataFrame:
    """``index, shards`` of settings that name ``number_of_shards``."""
    n = F.coalesce(F.get_json_object("body", "$['index.number_of_shards']"), F.get_json_object("body", "$.index.number_of_shards"), F.get_json_object("body", "$.number_of_shards"))
    return meta.where("kind = '_settings'").select("index", n.cast("int").alias("shards")).where("shards > 0")


# -- reading


def _buckets(spark: SparkSession, root: str, lay: Layout, wanted: dict[str, set[int]] | None = None) -> DataFrame | None:
    """Documents (with ``bucket``) of all buckets, or of those wanted of some indices; None if there are none."""
    paths = [f"{root}/docs/gen={g}/{_of(spark, i)}/bucket={b}" for i, own in lay.buckets.items() for b, g in own.items() if wanted is None or int(b) in wanted.get(i, ())]
    if not paths:
        return None
    schema = StructType([*DOC_SCHEMA.fields]).add("bucket", IntegerType())
    return spark.read.schema(schema).option("basePath", f"{root}/docs").parquet(*paths).select(*schema.names)


def _changes(spark: SparkSession, root: str, deltas: list[dict]) -> DataFrame:
    return spark.read.schema(CHANGE_SCHEMA).parquet(*[f"{root}/changes/seq={d['seq']}" for d in deltas])


def changes(spark: SparkSession, root: str) -> DataFrame:
    """The changes that are kept, in buckets or not, with ``_seq``, the number of the write, and ``_plain``."""
    kept = [c for c in layout(spark, root).changes if not c.get("whole")]
    return _changes(spark, root, kept) if kept else spark.createDataFrame([], CHANGE_SCHEMA)


def in_buckets(spark: SparkSession, root: str) -> DataFrame:
    """Documents in buckets, with ``bucket``, without deltas."""
    found = _buckets(spark, root, layout(spark, root))
    return found if found is not None else spark.createDataFrame([], StructType([*DOC_SCHEMA.fields]).add("bucket", IntegerType()))


def has_buckets(spark: SparkSession, root: str) -> bool:
    return bool(layout(spark, root).buckets)


def indices(spark: SparkSession, root: str) -> list[str]:
    """Names of the indices that have documents, from the layout."""
    lay = layout(spark, root)
    return sorted({*lay.buckets, *(i for d in lay.deltas() for i in d["indices"])})


def deltas(spark: SparkSession, root: str) -> list[str]:
    """Folders of the changes that are merged as they are read, oldest first."""
    return [f"{root}/changes/seq={d['seq']}" for d in layout(spark, root).deltas()]


def latest(rows: DataFrame) -> DataFrame:
    """Of each key the state that its rows leave, taken in the order of ``_seq``: a plain row replaces any, others a lower version or none.

    So the last plain row counts and what came after it; of those the highest version, of equal versions the first. A state is plain if one of its rows is.
    """
    of_key = W.partitionBy(*KEY)
    plain = F.max(F.when(F.col("_plain"), F.col("_seq"))).over(of_key)
    version = F.coalesce(F.col("_version"), F.lit(-(1 << 63)).cast("long"))
    order = of_key.orderBy(F.desc("_v"), F.asc("_seq"))
    after = rows.withColumns({"_p": plain, "_v": version}).where(F.col("_p").isNull() | (F.col("_seq") >= F.col("_p")))
    return after.withColumn("_n", F.row_number().over(order)).where("_n = 1").withColumn("_plain", F.col("_p").isNotNull()).select(*rows.columns)


def _same(a: DataFrame, b: DataFrame, prefix: str = "_k_"):
    return [a[k].eqNullSafe(b[f"{prefix}{k}"]) for k in KEY]


def _with_keys(docs: DataFrame, keys: DataFrame, small: bool, how: str) -> DataFrame:
    """Documents whose keys are (``left_semi``) or are not (``left_anti``) among ``keys``."""
    keys = keys.select(*[F.col(k).alias(f"_k_{k}") for k in KEY])
    return docs.join(F.broadcast(keys) if small else keys, _same(docs, keys), how)


def _merged(docs: DataFrame | None, changes: DataFrame, small: bool, single: bool) -> DataFrame:
    """Documents and changes as one state. Documents that no change has the key of pass by, without a shuffle if the keys are ``small``.

    ``single`` says that no two changes have the same key.
    """
    plain = changes.select(*CHANGE_SCHEMA.names)
    if docs is None:
        return (plain if single else latest(plain)).select(*DOC_SCHEMA.names)
    docs = docs.select(*DOC_SCHEMA.names)
    keys = changes.select(*KEY) if single else changes.select(*KEY).distinct()
    contested = _with_keys(docs, keys, small, "left_semi").withColumns({"_seq": F.lit(-1).cast("long"), "_plain": F.lit(True)})
    return _with_keys(docs, keys, small, "left_anti").unionByName(latest(contested.unionByName(plain)).select(*DOC_SCHEMA.names))


def _small(deltas: list[dict]) -> bool:
    return sum(d["bytes"] + 48 * d["rows"] for d in deltas) <= BROADCAST


def scan(spark: SparkSession, root: str, indices: list[str] | None = None, types: dict | list | None = None, where: Column | str | None = None) -> DataFrame:
    """Documents of some or (by default) all indices; index names prune folders, the rest is pushed to the files.

    Deltas of those indices are merged with the documents of their keys, and ``where`` comes after that; all other
    documents come straight from the files.
    """
    lay = layout(spark, root)
    every = not indices or indices == ["_all"]
    chosen = None if every else {i: set(range(lay.counts.get(i, 0))) for i in indices}
    docs = _buckets(spark, root, lay, chosen)
    open_ = [d for d in lay.deltas() if every or set(d["indices"]) & set(indices)]
    of = of_types(F.col("index"), F.col("type"), types)  # index and type are of the key, so they may be filtered before
    docs = docs.where(of).select(*DOC_SCHEMA.names) if docs is not None else None
    if open_:
        added = _changes(spark, root, open_).where(of)
        docs = _merged(docs, added if every else added.where(F.col("index").isin(indices)), _small(open_), len(open_) == 1)
    if docs is None:
        return spark.createDataFrame([], DOC_SCHEMA)
    return docs.where(where) if where is not None else docs


def metadata(spark: SparkSession, root: str, indices: list[str] | None = None, types: list[str] | None = None, kinds: list[str] | None = None) -> DataFrame:
    """Settings, mappings (of the given types; none means all) and aliases."""
    if not _exists(spark, f"{root}/meta"):
        return spark.createDataFrame([], META_SCHEMA)
    rows = spark.read.schema(META_SCHEMA).parquet(f"{root}/meta")
    if indices and indices != ["_all"]:
        rows = rows.where(F.col("index").isin(indices))
    if types:
        rows = rows.where((F.col("kind") != "_mapping") | F.col("name").isin(types))
    return rows.where(F.col("kind").isin(kinds)) if kinds else rows


# -- writing


def _folded(docs: DataFrame, order: str | None, versions: bool, all_have: bool = False) -> DataFrame:
    """One row for each key of a write, and whether it is plain. Of equal keys the last by ``order`` counts, with versions as ``latest`` says."""
    plain = F.col("_version").isNull() if versions else F.lit(True)
    rows = docs.withColumn("_order", F.col(order) if order else F.lit(0))
    if not versions:
        rows = last_writer(rows, [F.col("_order")]) if order else rows.dropDuplicates(KEY)
    elif all_have:
        rows = highest_version(rows, "_order")
    else:
        return latest(rows.select(*DOC_SCHEMA.names, F.col("_order").alias("_seq"), plain.alias("_plain"))).select(*DOC_SCHEMA.names, "_plain")
    return rows.select(*DOC_SCHEMA.names, plain.alias("_plain"))


def _put_change(rows: DataFrame, root: str, lay: Layout, writer: str | None = None, batch: int | None = None) -> dict:
    """Writes a change's files; its entry says how large it is and of which indices."""
    spark, seen, seq = rows.sparkSession, Observation(), lay.seq + 1
    keys = sum((F.coalesce(F.octet_length(k), F.lit(0)) for k in KEY), F.lit(0))
    counted = rows.select(*DOC_SCHEMA.names, F.lit(seq).cast("long").alias("_seq"), "_plain").observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(keys).cast("long").alias("bytes"))
    counted.write.mode("overwrite").parquet(f"{root}/changes/seq={seq}")
    change = {"seq": seq, "rows": seen.get["rows"] or 0, "bytes": seen.get["bytes"] or 0, "writer": writer, "batch": batch, "merged": False}
    names = _changes(spark, root, [change]).select("index").distinct().collect()  # index names only
    return change | {"indices": sorted(r["index"] for r in names)}


def append(docs: DataFrame, root: str, writer: str, batch: int, order: str | None = None, versions: bool = False) -> int:
    """Adds the documents of a writer's micro-batch as a delta; returns how many deltas there are. Of equal keys the last by ``order`` counts.

    Without ``versions`` a document replaces what the store has; with them one that has a version replaces lower ones only. A batch that
    is run again replaces its own delta, and is left out if that is in the buckets already.
    """
    spark = docs.sparkSession
    lay = layout(spark, root)
    own = [c for c in lay.changes if (c["writer"], c["batch"]) == (writer, batch)]
    if not any(c["merged"] for c in own):
        lay.changes = [c for c in lay.changes if c not in own]
        lay.changes.append(_put_change(_folded(docs, order, versions), root, lay, writer, batch))
        lay.seq += 1
        _commit(spark, root, lay)
    return len(lay.deltas())


def compact(spark: SparkSession, root: str) -> int:
    """Puts all deltas into the buckets; returns how many there were. Broken off, it leaves the store as it was."""
    lay = layout(spark, root)
    open_ = lay.deltas()
    if open_:
        _put(spark, root, lay, _changes(spark, root, open_), _small(open_), len(open_) == 1, {})
    return len(open_)


def _put(spark: SparkSession, root: str, lay: Layout, changes: DataFrame | None, small: bool, single: bool, counts: dict[str, int]) -> None:
    """Writes the buckets that changes touch or that other counts split or join as a new generation, and then the layout with them.

    Tasks share out a large bucket. Index names and touched buckets come to the driver; they are as many as folders.
    """
    names = [r["index"] for r in changes.select("index").distinct().collect()] if changes is not None else []
    new = lay.counts | {n: SHARDS for n in names if n not in lay.counts} | counts
    touched: dict[str, set[int]] = {i: changed_buckets(lay.counts[i], n) for i, n in new.items() if i in lay.counts and lay.counts[i] != n}
    if changes is not None:
        changes = bucketed(changes, new)
        for r in changes.select("index", "bucket").distinct().collect() if lay.buckets else []:
            touched.setdefault(r["index"], set()).add(r["bucket"])
    # the buckets that these rows lie in now
    old = {i: {linear_bucket(b, lay.counts[i]) for b in own} | {b for b in range(new[i], lay.counts[i]) if linear_bucket(b, new[i]) in own} for i, own in touched.items() if i in lay.counts}
    docs = _buckets(spark, root, lay, old)
    rows = docs.select(*DOC_SCHEMA.names) if docs is not None else None
    if changes is not None:
        rows = _merged(rows, changes, small, single)
    gen = lay.seq + 1
    if rows is not None:
        rows = bucketed(rows, new).hint("rebalance", F.col("index"), F.col("bucket"))
        rows.write.mode("overwrite").partitionBy("index", "bucket").parquet(f"{root}/docs/gen={gen}")
    buckets = {i: {b: g for b, g in own.items() if int(b) not in old.get(i, ())} for i, own in lay.buckets.items()}
    for i in new:
        for b in _names(spark, f"{root}/docs/gen={gen}/{_of(spark, i)}"):
            buckets.setdefault(i, {})[b.removeprefix("bucket=")] = gen
    done = [c | {"merged": True} for c in lay.changes]
    _commit(spark, root, Layout(gen, new, {i: own for i, own in buckets.items() if own}, done, lay.since))


def reshard(spark: SparkSession, root: str, counts: dict[str, int]) -> None:
    """Gives indices other numbers of shards: only buckets that are split or joined are written. Deltas are compacted before."""
    compact(spark, root)
    lay = layout(spark, root)
    if other := {i: n for i, n in counts.items() if lay.counts.get(i, n) != n}:
        _put(spark, root, lay, None, True, True, other)


def _wanted_counts(spark: SparkSession, root: str, shards: int | DataFrame | None, names: list[str]) -> dict[str, int]:
    """The numbers of shards that a write asks for: one for all, those of a table ``index, shards``, or those of the settings."""
    if isinstance(shards, int):
        return dict.fromkeys(names, shards)
    rows = shards if shards is not None else shard_counts(metadata(spark, root))
    return {r["index"]: r["shards"] for r in rows.collect() if r["index"] in names}  # one row for each index


def version_gate(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming documents whose version is greater than that of the stored document, if there is one."""
    held = stored.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("_version").alias("_held"))
    return incoming.join(held, _same(incoming, held, "_"), "left").where(F.col("_held").isNull() | (F.col("_version") > F.col("_held"))).select(*incoming.columns)


def merged(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored documents, each replaced by the incoming one of its key."""
    columns = [c for c in stored.columns if c in incoming.columns]
    return _with_keys(stored.select(*columns), incoming, False, "left_anti").unionByName(incoming.select(*columns))


def upsert(docs: DataFrame, root: str, shards: int | DataFrame | None = None, order: str | None = None, versions: bool | None = None, kept: bool = False, merge: bool = True) -> None:
    """Replaces or adds documents by key. Of equal keys the last by ``order`` counts; with ``versions`` see ``latest``.

    By default versions count if all documents have one; a mixture is refused then, while ``versions=True`` takes each document as it is.
    Indices that the write has get the number of shards that is asked for, by ``shards`` or their settings. Deltas are compacted before.
    ``kept`` says that ``docs`` is a projection of a written table and need not be written again to be counted. Without ``merge`` a store that has
    documents gets these as a delta: no bucket is written, and numbers of shards stay as they are.
    """
    spark = docs.sparkSession
    if merge:
        compact(spark, root)
    lay = layout(spark, root)
    first, all_have = not lay.buckets, False
    if versions is None:
        docs = docs if kept else written(docs, "incoming")
        n = docs.agg(F.count("_version"), F.count("*")).first()
        if n[0] not in (0, n[1]):
            raise ValueError("some documents have a version and some have none")
        versions = all_have = n[0] > 0
    rows = _folded(docs, order, versions, all_have)
    if first and kept:  # nothing to follow or to merge with: straight to the buckets
        rows = rows.withColumn("_seq", F.lit(lay.seq + 1).cast("long"))
        names = [r["index"] for r in docs.select("index").distinct().collect()]
        change = {"seq": lay.seq + 1, "rows": 0, "bytes": 0, "writer": None, "batch": None, "merged": False, "indices": sorted(names), "whole": True}
    else:
        change = _put_change(rows, root, lay)
        rows = _changes(spark, root, [change])
        names = change["indices"]
    lay.changes.append(change)
    if not merge and not first:
        lay.seq += 1
        _commit(spark, root, lay)
        return
    counts = _wanted_counts(spark, root, shards, names)
    _put(spark, root, lay, rows, _small([change]) and not change.get("whole"), True, counts)


def upsert_metadata(rows: DataFrame, root: str) -> None:
    """Replaces or adds settings, mappings and aliases by (index, kind, name); whole indices are rewritten, they are few rows."""
    spark = rows.sparkSession
    new = rows.select(*META_SCHEMA.names)
    if _exists(spark, f"{root}/meta"):
        stored = metadata(spark, root).join(new.select("index").distinct(), "index", "left_semi").select(*META_SCHEMA.names)
        keys = [stored[k].eqNullSafe(new[k]) for k in ("index", "kind", "name")]
        new = stored.join(new, keys, "left_anti").unionByName(new)
    new = written(new, "meta")
    new.repartition("index").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("index").parquet(f"{root}/meta")


def create_indices(meta: DataFrame, root: str, if_exists: str = "warn") -> list[str]:
    """Adds metadata of indices before their documents; returns names that were there already.

    ``if_exists``: ``warn`` goes on, ``require_empty`` fails if such an index has documents, ``error`` fails.
    """
    spark = meta.sparkSession
    known = set(indices(spark, root)) | {r["index"] for r in metadata(spark, root).select("index").distinct().collect()}
    there = sorted(known & {r["index"] for r in meta.select("index").distinct().collect()})  # index names only
    if there and if_exists == "error":
        raise ValueError(f"indices exist: {there}")
    if there and if_exists == "require_empty" and not scan(spark, root, there).limit(1).isEmpty():
        raise ValueError(f"indices have documents: {there}")
    upsert_metadata(meta, root)
    return there


def alias_filter(body: str | None) -> Column:
    """An alias's filter: none, ``{"term": {field: value}}``, or SQL."""
    if not body:
        return F.lit(True)
    if body.lstrip().startswith("{"):
        term = json.loads(body).get("term")
        if not term:
            return F.lit(True)
        out = F.lit(True)
        for k, v in term.items():
            own = F.col(k) if k in DOC_SCHEMA.names else F.get_json_object("_source", f"$.{k}")
            out &= own == str(v)
        return out
    return F.expr(body)


def create_alias(spark: SparkSession, root: str, alias: str, index: str, body: str | None = None) -> DataFrame:
    """A view of an index under another name, with a filter if there is one."""
    docs = scan(spark, root, [index]).where(alias_filter(body))
    docs.createOrReplaceTempView(f"`{alias}`" if not alias.isidentifier() else alias)
    return docs


def _parent_of(children: DataFrame, one_index: bool):
    """Where a child's parent is: the id in ``_parent``, in its own index if ``one_index``."""
    same = children["_parent"] == F.col("_pid")
    return same & (children["index"] == F.col("_pindex")) if one_index else same


def children_with_parents(children: DataFrame, parents: DataFrame, one_index: bool = False) -> DataFrame:
    """Children (by ``_parent``) with ``parent_source``; ``one_index`` if parents are those of the child's own index only."""
    up = parents.select(F.col("index").alias("_pindex"), F.col("id").alias("_pid"), F.col("_source").alias("parent_source"))
    return children.join(up, _parent_of(children, one_index)).drop("_pid", "_pindex")


def orphans(children: DataFrame, parents: DataFrame, one_index: bool = False) -> DataFrame:
    """Children without a parent."""
    return children.join(parents.select(F.col("index").alias("_pindex"), F.col("id").alias("_pid")), _parent_of(children, one_index), "left_anti")
