"""Documents to packets and back; renames; overrides of settings and mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docpack.functions.names import packet_kind, unwrap_mapping, wrap_mapping
from docpack.functions.predicates import sane_packet
from docpack.model import ATTRIBUTES, KEY

# -- renames


def rename_map(spec: dict[str, str] | Column | None) -> Column:
    """A map column of a JSON object or a dict; ``index`` and ``index/type`` are its keys. Unreadable JSON gives a null map."""
    if isinstance(spec, Column):
        return F.from_json(spec, "map<string,string>")
    return F.create_map(*[F.lit(x) for kv in (spec or {}).items() for x in kv]).cast("map<string,string>")


def renamed_index(index: Column, names: Column) -> Column:
    return F.coalesce(F.get(F.array(names), F.lit(0))[index], index)


def renamed_type(index: Column, type_: Column, names: Column) -> Column:
    """By the key ``index/type`` with the index's old name."""
    return F.coalesce(names[F.concat_ws("/", index, type_)], type_)


def rename(rows: DataFrame, spec: dict[str, str] | None) -> DataFrame:
    """Index and type by their new names; types are looked up first, by the old index name."""
    if not spec:
        return rows
    names = rename_map(spec)
    return rows.withColumns({"index": renamed_index(F.col("index"), names), "type": renamed_type(F.col("index"), F.col("type"), names)})


def rename_join(rows: DataFrame, names: DataFrame) -> DataFrame:
    """The same from a table ``key, value``, for maps too large for a literal. Spark broadcasts it if it is small."""
    whole = names.where(~F.contains("key", F.lit("/"))).select(F.col("key").alias("_i"), F.col("value").alias("_new_index"))
    types = names.where(F.contains("key", F.lit("/"))).select(F.col("key").alias("_t"), F.col("value").alias("_new_type"))
    out = rows.join(whole, rows["index"] == F.col("_i"), "left").join(types, F.concat_ws("/", rows["index"], rows["type"]) == F.col("_t"), "left")
    return out.withColumns({"index": F.coalesce("_new_index", rows["index"]), "type": F.coalesce("_new_type", rows["type"])}).drop("_i", "_t", "_new_index", "_new_type")


def rename_targets(spec: DataFrame) -> DataFrame:
    """``index, types`` that a rename table's keys name."""
    parts = F.split("key", "/", 2)
    return spec.groupBy(F.get(parts, F.lit(0)).alias("index")).agg(F.array_sort(F.collect_set(F.get(parts, F.lit(1)))).alias("types"))


# -- documents to packets


def explode_fields(docs: DataFrame, fields: list[str] | None = None, attributes: bool = True, rest: tuple[str, ...] = ()) -> DataFrame:
    """One packet per attribute, stored field and source of each document: ``index, type, id, field, payload``.

    ``fields`` restricts stored fields and attributes; the source goes along always, as do columns ``rest``. Null values make no packet.
    """
    own = ATTRIBUTES if attributes else []
    own = [a for a in own if fields is None or a in fields]
    stored = F.map_entries(F.coalesce("fields", F.create_map().cast("map<string,string>")))
    if fields is not None:
        stored = F.filter(stored, lambda e: e["key"].isin(list(fields)))
    fixed = F.array(*[F.struct(F.lit(a).alias("key"), F.col(a).cast("string").alias("value")) for a in [*own, "_source"]])
    all_ = F.filter(F.concat(stored, fixed), lambda e: e["value"].isNotNull())
    return docs.select(*KEY, *rest, F.explode(all_).alias("e")).select(*KEY, *rest, F.col("e.key").alias("field"), F.col("e.value").alias("payload"))


def first_value(values: Column) -> Column:
    """The first value of a multi-valued field, as text."""
    return F.get(values, F.lit(0)).cast("string")


# -- packets to documents


def coordinate(index: Column, type_: Column, id_: Column) -> Column:
    return F.concat_ws("/", *[F.coalesce(c, F.lit("null")) for c in (index, type_, id_)])


def coordinate_runs(packets: DataFrame, along: str = "archive", order: str = "seq") -> DataFrame:
    """Adds ``run``: a number that grows by one whenever the coordinate differs from the packet's before in the archive, or a document of the same one begins."""
    key = coordinate(*map(F.col, KEY))
    w = W.partitionBy(along).orderBy(order)
    again = F.coalesce(F.map_contains_key("meta", F.lit("_next")), F.lit(False)) if "meta" in packets.columns else F.lit(False)
    changed = F.when((F.lag(key).over(w) == key) & ~again, 0).otherwise(1)
    return packets.withColumn("_new", changed).withColumn("run", F.sum("_new").over(w).cast("long")).drop("_new")


def assemble(packets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``index, type, id, archive, run, last_seq, fields``: fields of each run as a map, the later of equal fields wins."""
    by = by or ["archive", "run"]
    latest = packets.groupBy(*KEY, *by, "field").agg(F.max_by("payload", "seq").alias("payload"), F.max("seq").alias("seq"))
    return latest.groupBy(*KEY, *by).agg(F.max("seq").alias("last_seq"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "payload")))).alias("fields"))


def with_meta(packets: DataFrame) -> DataFrame:
    """Attributes that came in bulk action lines as packets of their own; a packet without field is the source."""
    entries = F.concat(F.array(F.struct(F.coalesce("field", F.lit("_source")).alias("key"), F.col("payload").alias("value"))), F.coalesce(F.filter(F.map_entries("meta"), lambda e: e["key"] != "_next"), F.array().cast("array<struct<key:string,value:string>>")))
    rest = [c for c in packets.columns if c not in ("field", "payload", "meta")]
    return packets.select(*rest, F.explode(entries).alias("_e")).select(*rest, F.col("_e.key").alias("field"), F.col("_e.value").alias("payload"))


def route_fields(assembled: DataFrame) -> DataFrame:
    """Documents of field maps: attributes by name, the source as it is or else the last other field as ``{name: payload}``.

    Fields that begin with a dot are left out.
    """
    m = F.col("fields")
    others = F.filter(F.map_entries(m), lambda e: ~e["key"].isin(*ATTRIBUTES, "_source") & ~F.startswith(e["key"], F.lit(".")))
    last = F.element_at(others, -1)
    whole = F.when(F.size(others) > 0, F.to_json(F.create_map(last["key"], last["value"])))
    rest = [c for c in assembled.columns if c not in (*KEY, "fields")]
    return assembled.select(
        *KEY, *rest,
        *[m[a].cast("long" if a == "_version" else "string").alias(a) for a in ATTRIBUTES],
        F.coalesce(m["_source"], whole).alias("_source"),
        F.when(F.size(others) > 0, F.map_from_entries(others)).alias("fields"),
    )


def sane(packets: DataFrame) -> DataFrame:
    return packets.where(sane_packet(*map(F.col, (*KEY, "payload"))))


def kinds(packets: DataFrame) -> DataFrame:
    return packets.withColumn("kind", packet_kind(F.col("type"), F.col("id")))


def last_writer(rows: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Of each key the row that comes last. An aggregate with partial sums, so a key with very many rows is no hot task."""
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(*rows.columns), F.struct(*(order or [F.col("seq")]))).alias("r")).select("r.*")


def highest_version(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Of each key the row with the highest version, of equal versions the first by ``seq`` (of any type that can be ordered)."""
    down = -F.coalesce(F.col("_version"), F.lit(-1))
    return rows.groupBy(*KEY).agg(F.min_by(F.struct(*rows.columns), F.struct(down, F.col(seq))).alias("r")).select("r.*")


# -- metadata


def metadata_packets(meta: DataFrame) -> DataFrame:
    """``META`` rows as packets: settings, mappings and aliases with their places in an entry's name. A mapping's body is wrapped in its type."""
    place = lambda s, m, a: F.when(F.col("kind") == "_settings", s).when(F.col("kind") == "_mapping", m).otherwise(a)
    none = F.lit(None).cast("string")
    return meta.select("index", place(F.lit("_settings"), F.col("name"), F.col("name")).alias("type"), place(none, F.lit("_mapping"), F.lit("_alias")).alias("id"), none.alias("field"), F.when(F.col("kind") == "_mapping", wrap_mapping(F.col("name"), unwrap_mapping(F.col("name"), F.col("body")))).otherwise(F.col("body")).alias("payload"))


def packets_metadata(packets: DataFrame) -> DataFrame:
    """The ``META`` rows of classified packets; mappings are taken out of their types."""
    rows = packets.where("kind <> 'doc'")
    body = F.when(F.col("kind") == "mapping", unwrap_mapping(F.col("type"), F.col("payload"))).otherwise(F.col("payload"))
    return rows.select("index", F.concat(F.lit("_"), "kind").alias("kind"), F.when(F.col("kind") != "settings", F.col("type")).alias("name"), body.alias("body"))


def rename_metadata(meta: DataFrame, spec: dict[str, str] | None) -> DataFrame:
    """Index names of all rows and type names of mappings, by their new names."""
    if not spec:
        return meta
    names = rename_map(spec)
    new = F.when(F.col("kind") == "_mapping", renamed_type(F.col("index"), F.col("name"), names)).otherwise(F.col("name"))
    return meta.withColumns({"name": new, "index": renamed_index(F.col("index"), names)})


def override(meta: DataFrame, given: DataFrame) -> DataFrame:
    """Bodies from ``given`` (``key``, ``body``) where it has ``<index>_settings`` or ``<index>_<type>_mapping``, of renamed names."""
    key = F.when(F.col("kind") == "_settings", F.concat("index", F.lit("_settings"))).when(F.col("kind") == "_mapping", F.concat("index", F.lit("_"), "name", F.lit("_mapping")))
    found = meta.withColumn("_key", key).join(given.select(F.col("key").alias("_key"), F.col("body").alias("_body")), "_key", "left")
    return found.withColumn("body", F.coalesce("_body", "body")).select(*meta.columns)


def override_params(params: DataFrame) -> DataFrame:
    return params.where(F.col("key").rlike("_(settings|mapping)$"))
