"""Queries of projections, filters, joins, sets and windows, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from docpack.functions import names, predicates
from docpack.operators import order, reshape, stats
from docpack.plans import tables as T

QUERIES: dict = {}
SQL: dict[str, str] = {}
KEY3 = '"index", type, id'


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


RENAMES = {"orders": "sales", "orders/F": "final", "customer": "clients", "customer/BUILDING": "builders"}
RENAME_JSON = '{"orders":"sales","orders/F":"final","customer":"clients","customer/BUILDING":"builders"}'
NEW_INDEX = "CASE \"index\" WHEN 'orders' THEN 'sales' WHEN 'customer' THEN 'clients' ELSE \"index\" END"
NEW_TYPE = "CASE WHEN \"index\" = 'orders' AND type = 'F' THEN 'final' WHEN \"index\" = 'customer' AND type = 'BUILDING' THEN 'builders' ELSE type END"

# -- projections


@query("encode_entry_name", f"SELECT page_id, 'pages/page/' || {T.URL('url')} || '/_source' AS name FROM pages")
def encode_entry_name(spark, d):
    return T.table(spark, d, "pages").select("page_id", names.encode_entry_name(F.lit("pages"), F.lit("page"), F.col("url"), F.lit("_source")).alias("name"))


@query("decode_entry_name", "SELECT page_id, 'pages' AS \"index\", 'page' AS type, url AS id, 'null' AS field FROM pages")
def decode_entry_name(spark, d):
    name = names.encode_entry_name(F.lit("pages"), F.lit("page"), F.col("url"), F.lit(None).cast("string"))
    rows = T.table(spark, d, "pages").select("page_id", name.alias("name"))
    return rows.withColumns(names.decode_entry_name(F.col("name"))).drop("name")


@query("rename_index", f'SELECT {NEW_INDEX} AS "index", id FROM {T.STORES}')
def rename_index(spark, d):
    return T.stores(spark, d).select(reshape.renamed_index(F.col("index"), reshape.rename_map(RENAMES)).alias("index"), "id")


@query("rename_type", f'SELECT "index", {NEW_TYPE} AS type, id FROM {T.STORES}')
def rename_type(spark, d):
    return T.stores(spark, d).select("index", reshape.renamed_type(F.col("index"), F.col("type"), reshape.rename_map(RENAMES)).alias("type"), "id")


@query("parse_rename_map", "SELECT o_orderkey, o_orderpriority AS value FROM orders")
def parse_rename_map(spark, d):
    spec = F.to_json(F.create_map(F.col("o_orderkey").cast("string"), F.col("o_orderpriority")))
    parsed = T.table(spark, d, "orders").select("o_orderkey", reshape.rename_map(spec).alias("m"))
    return parsed.select("o_orderkey", F.element_at("m", F.col("o_orderkey").cast("string")).alias("value"))


@query("rename_spec_targets", "SELECT p_brand AS \"index\", string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY p_brand")
def rename_spec_targets(spark, d):
    spec = T.table(spark, d, "part").select(F.concat_ws("/", "p_brand", "p_type").alias("key")).distinct()
    return reshape.rename_targets(spec).select("index", F.array_join("types", ",").alias("types"))


@query(
    "explode_fields",
    "SELECT \"index\", type, id, '_source' AS field, _source AS payload FROM " + T.STORES + " UNION ALL SELECT \"index\", type, id, '_parent', _parent FROM " + T.STORES + " WHERE _parent IS NOT NULL UNION ALL SELECT \"index\", type, id, '_timestamp', _timestamp FROM " + T.STORES + " WHERE _timestamp IS NOT NULL",
)
def explode_fields(spark, d):
    return reshape.explode_fields(T.stores(spark, d))


@query("first_value", "SELECT vec_id, round(embedding[1]::DOUBLE, 4) AS first FROM embeddings")
def first_value(spark, d):
    return T.table(spark, d, "embeddings").select("vec_id", F.round(reshape.first_value(F.col("embedding")).cast("float").cast("double"), 4).alias("first"))


@query("route_meta_fields", f"SELECT {KEY3}, _parent, _timestamp, _source FROM {T.STORES}")
def route_meta_fields(spark, d):
    packets = reshape.explode_fields(T.stores(spark, d)).withColumns({"seq": F.lit(0).cast("long"), "archive": F.lit("a"), "run": F.lit(1)})
    return reshape.route_fields(reshape.assemble(packets)).select("index", "type", "id", "_parent", "_timestamp", "_source")


OVERRIDES = "SELECT 'orders_settings' AS key, '{\"index.number_of_shards\":\"7\"}' AS body UNION ALL SELECT 'orders_' || o_orderstatus || '_mapping', '{\"max\":' || max(o_orderkey) || '}' FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus"


def _overrides(spark, d):
    orders = T.table(spark, d, "orders")
    top = orders.where("o_orderstatus <> 'P'").groupBy("o_orderstatus").agg(F.concat(F.lit('{"max":'), F.max("o_orderkey").cast("string"), F.lit("}")).alias("body"))
    settings = spark.createDataFrame([("orders_settings", '{"index.number_of_shards":"7"}')], "key string, body string")
    return top.select(F.concat(F.lit("orders_"), "o_orderstatus", F.lit("_mapping")).alias("key"), "body").unionByName(settings)


def _overridden(kind: str) -> str:
    key = "\"index\" || '_settings'" if kind == "_settings" else "\"index\" || '_' || name || '_mapping'"
    return f"SELECT m.\"index\", m.kind, m.name, coalesce(o.body, m.body) AS body FROM {T.METAS} m LEFT JOIN ({OVERRIDES}) o ON o.key = {key} WHERE m.kind = '{kind}'"


@query("override_settings", _overridden("_settings"))
def override_settings(spark, d):
    return reshape.override(T.meta_rows(spark, d).where("kind = '_settings'"), _overrides(spark, d))


@query("override_mapping", _overridden("_mapping"))
def override_mapping(spark, d):
    return reshape.override(T.meta_rows(spark, d).where("kind = '_mapping'"), _overrides(spark, d))


@query("collect_override_params", "SELECT key, n FROM (SELECT o_orderpriority || '_settings' AS key, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT o_orderstatus || '_x_mapping', count(*) FROM orders GROUP BY 1)")
def collect_override_params(spark, d):
    orders = T.table(spark, d, "orders")
    make = lambda c, s: orders.groupBy(F.concat(c, F.lit(s)).alias("key")).agg(F.count("*").alias("n"))
    return reshape.override_params(make("o_orderpriority", "_settings").unionByName(make("o_orderstatus", "_x_mapping")).unionByName(make("o_orderstatus", "_plain")))


@query("default_archive_name", "SELECT DISTINCT '/exports/' || \"index\" || '_' || type || '.tar.gz' AS name FROM " + T.STORES + " UNION ALL SELECT DISTINCT '/exports/' || \"index\" || '.tar.gz' FROM " + T.STORES + " UNION ALL SELECT '/exports/_all.tar.gz'")
def default_archive_name(spark, d):
    s, none = T.stores(spark, d), F.lit(None).cast("string")
    rows = s.select("index", "type").distinct().unionByName(s.select("index", none.alias("type")).distinct()).unionByName(s.select(none.alias("index"), none.alias("type")).distinct())
    return rows.select(names.default_archive_name(F.lit("/exports"), F.col("index"), F.col("type")).alias("name"))


@query("part_file_name", "SELECT p_partkey, CASE WHEN p_size > 5 THEN p_size || '.' || p_brand || '.tar.gz' ELSE p_brand || '.tar.gz' END AS file, CASE WHEN p_size > 5 THEN p_size ELSE 0 END AS part FROM part")
def part_file_name(spark, d):
    part = F.when(F.col("p_size") > 5, F.col("p_size")).otherwise(0)
    old = F.concat(F.lit("3."), F.col("p_brand"), F.lit(".tar.gz"))
    rows = T.table(spark, d, "part").select("p_partkey", names.part_file_name(part, old).alias("file"))
    return rows.withColumn("part", names.part_number(F.col("file")))


@query("payload_bytes", "SELECT doc_id, strlen(text) AS bytes FROM documents")
def payload_bytes(spark, d):
    return T.table(spark, d, "documents").select("doc_id", names.payload_bytes(F.col("text")).alias("bytes"))


@query("normalize_name", r"SELECT page_id, regexp_replace(replace(regexp_replace(CASE page_id % 3 WHEN 0 THEN 'C:\' || url WHEN 1 THEN '///' || replace(url, '/', '\') ELSE url END, '^[A-Za-z]:', ''), '\', '/'), '^/+', '') AS name FROM pages")
def normalize_name(spark, d):
    raw = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("C:\\"), "url")).when(F.col("page_id") % 3 == 1, F.concat(F.lit("///"), F.translate("url", "/", "\\"))).otherwise(F.col("url"))
    return T.table(spark, d, "pages").select("page_id", names.normalize_name(raw).alias("name"))


@query("bulk_action_line", "SELECT o_orderkey, '{\"index\":{\"_index\":\"orders\",\"_type\":\"' || o_orderstatus || '\",\"_id\":\"' || o_orderkey || '\"}}' AS line FROM orders")
def bulk_action_line(spark, d):
    return T.table(spark, d, "orders").select("o_orderkey", names.bulk_action_line(F.lit("orders"), F.col("o_orderstatus"), F.col("o_orderkey").cast("string")).alias("line"))


@query("parse_action_line", "SELECT page_id, 'pages' AS \"index\", 'page' AS type, url || '\"\\' AS id FROM pages")
def parse_action_line(spark, d):
    line = names.bulk_action_line(F.lit("pages"), F.lit("page"), F.concat("url", F.lit('"\\')))
    cut = F.when(F.col("page_id") % 2 == 0, line).otherwise(F.regexp_replace(line, r"\}$", ""))
    rows = T.table(spark, d, "pages").select("page_id", cut.alias("line"))
    return rows.withColumns(names.parse_action_line(F.col("line"))).drop("line")


@query("packet_kind", f"SELECT \"index\", substr(kind, 2) AS kind, count(*) AS n FROM {T.METAS} GROUP BY ALL UNION ALL SELECT \"index\", 'doc', count(*) FROM {T.STORES} GROUP BY ALL")
def packet_kind(spark, d):
    packets = reshape.metadata_packets(T.meta_rows(spark, d)).select("index", "type", "id").unionByName(T.stores(spark, d).select("index", "type", "id"))
    return reshape.kinds(packets).groupBy("index", "kind").agg(F.count("*").alias("n"))


@query("wrap_mapping", f"SELECT \"index\", name, '{{\"' || name || '\":' || body || '}}' AS body FROM {T.METAS} WHERE kind = '_mapping'")
def wrap_mapping(spark, d):
    return T.meta_rows(spark, d).where("kind = '_mapping'").select("index", "name", names.wrap_mapping(F.col("name"), F.col("body")).alias("body"))


@query("resolve_format", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'tar' WHEN 1 THEN 'bulk' END AS format, CASE page_id % 3 WHEN 0 THEN 'gz' END AS codec FROM pages")
def resolve_format(spark, d):
    path = F.concat("url", F.when(F.col("page_id") % 3 == 0, ".TAR.gz").when(F.col("page_id") % 3 == 1, ".bulk").otherwise(".html"))
    return T.table(spark, d, "pages").select("page_id", names.archive_format(path).alias("format"), names.archive_codec(path).alias("codec"))


# -- filters

WORDS = "' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' '"


@query("filter_match_all", "SELECT count(*) AS n FROM documents")
def filter_match_all(spark, d):
    return T.table(spark, d, "documents").where(predicates.match_all()).agg(F.count("*").alias("n"))


@query("filter_match_phrase", f"SELECT doc_id FROM documents WHERE contains({WORDS}, ' of the ')")
def filter_match_phrase(spark, d):
    return T.table(spark, d, "documents").where(predicates.match_phrase(F.col("text"), "Of, THE")).select("doc_id")


@query("filter_range", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'")
def filter_range(spark, d):
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return T.table(spark, d, "events").where(predicates.in_range(F.col("ts"), gte=at("2024-01-05 00:00:00"), lt=at("2024-01-12 00:00:00"))).select("event_id")


@query("filter_bool", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW'")
def filter_bool(spark, d):
    late = predicates.in_range(F.col("o_orderdate"), gte=F.lit("1997-01-01").cast("timestamp_ntz"))
    return T.table(spark, d, "orders").where(predicates.filtered(F.col("o_orderstatus") == "F", late, F.col("o_orderpriority") != "5-LOW")).select("o_orderkey")


@query("filter_uri_query", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def filter_uri_query(spark, d):
    return T.table(spark, d, "orders").where(predicates.uri_query('* AND o_orderstatus:O AND o_orderpriority:"1-URGENT"')).select("o_orderkey")


@query("filter_types", f"SELECT {KEY3} FROM {T.STORES} WHERE (\"index\" = 'orders' AND type IN ('F', 'O')) OR \"index\" = 'nation'")
def filter_types(spark, d):
    return T.stores(spark, d).where(predicates.of_types(F.col("index"), F.col("type"), {"orders": {"F", "O"}, "nation": set()})).select("index", "type", "id")


@query("exclude_system_index", f"SELECT \"index\", count(*) AS n FROM {T.STORES} WHERE \"index\" <> 'region' GROUP BY ALL")
def exclude_system_index(spark, d):
    marked = T.stores(spark, d).withColumn("index", F.when(F.col("index") == "region", F.lit(".jobs")).otherwise(F.col("index")))
    return marked.where(predicates.not_system(F.col("index"))).groupBy("index").agg(F.count("*").alias("n"))


@query("sane_packets", "SELECT page_id FROM pages WHERE page_id % 4 = 3")
def sane_packets(spark, d):
    bad = lambda k, x, y: F.when(F.col("page_id") % 4 == k, x).otherwise(y)
    packets = T.table(spark, d, "pages").select("page_id", F.lit("pages").alias("index"), bad(0, F.lit("._page"), F.lit("page")).alias("type"), bad(1, F.concat(F.lit("."), "url"), F.col("url")).alias("id"), bad(2, F.lit(None), F.lit("{}")).alias("payload"))
    return reshape.sane(packets).select("page_id")


@query("select_fields", "SELECT doc_id::VARCHAR AS id, 'lang' AS field, lang AS payload FROM documents UNION ALL SELECT doc_id::VARCHAR, '_source', '{\"doc_id\":' || doc_id || ',\"source\":\"' || source || '\",\"n_chars\":' || n_chars || '}' FROM documents")
def select_fields(spark, d):
    return reshape.explode_fields(T.text_docs(spark, d), ["lang"]).select("id", "field", "payload")


# -- joins


def _names(spark, d):
    customers = T.table(spark, d, "customer").select("c_mktsegment").distinct()
    orders = T.table(spark, d, "orders").select("o_orderstatus").distinct()
    types = customers.select(F.concat(F.lit("customer/"), "c_mktsegment").alias("key"), F.concat(F.lit("new_"), "c_mktsegment").alias("value"))
    return types.unionByName(orders.select(F.concat(F.lit("orders/"), "o_orderstatus").alias("key"), F.concat(F.lit("new_"), "o_orderstatus").alias("value"))).unionByName(orders.groupBy().agg(F.lit("orders").alias("key"), F.lit("sales").alias("value")))


@query("rename_join", f"SELECT CASE \"index\" WHEN 'orders' THEN 'sales' ELSE \"index\" END AS \"index\", CASE WHEN \"index\" IN ('orders', 'customer') THEN 'new_' || type ELSE type END AS type, id FROM {T.STORES}")
def rename_join(spark, d):
    return reshape.rename_join(T.stores(spark, d), _names(spark, d)).select("index", "type", "id")


@query("override_join", f"SELECT m.\"index\", m.kind, m.name, coalesce(o.body, m.body) AS body FROM {T.METAS} m LEFT JOIN ({OVERRIDES}) o ON o.key = CASE m.kind WHEN '_settings' THEN m.\"index\" || '_settings' WHEN '_mapping' THEN m.\"index\" || '_' || m.name || '_mapping' END")
def override_join(spark, d):
    return reshape.override(T.meta_rows(spark, d), _overrides(spark, d))


@query("types_semi", f"SELECT \"index\", name, body FROM {T.METAS} WHERE kind = '_mapping' AND name IN (SELECT o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT')")
def types_semi(spark, d):
    wanted = T.table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderstatus").alias("name")).distinct()
    return T.meta_rows(spark, d).where("kind = '_mapping'").join(wanted, "name", "left_semi").select("index", "name", "body")


@query("index_type_sets", f"SELECT \"index\", string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM {T.STORES} GROUP BY ALL")
def index_type_sets(spark, d):
    return stats.index_type_sets(T.stores(spark, d)).select("index", F.array_join("types", ",").alias("types"))


# -- windows and assembly


RUNS = "SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = role THEN 0 ELSE 1 END AS new FROM conversations)"


def _turns(spark, d):
    """Turns as packets: role and half of the turn make the coordinate, so that neighbours often share one."""
    return T.table(spark, d, "conversations").select(
        F.lit("conversations").alias("index"), F.col("role").alias("type"), F.col("conv_id").cast("string").alias("id"), F.concat(F.lit("f"), (F.col("turn") % 2).cast("string")).alias("field"),
        F.col("text").alias("payload"), F.col("turn").alias("seq"), F.col("conv_id").cast("string").alias("archive"),
    )


@query("coordinate_runs", f"SELECT conv_id::VARCHAR AS archive, turn AS seq, run FROM ({RUNS})")
def coordinate_runs(spark, d):
    return reshape.coordinate_runs(_turns(spark, d)).select("archive", "seq", "run")


@query("assemble_docs", f"SELECT role AS type, conv_id::VARCHAR AS id, run, max(turn) AS last_seq, max_by(text, turn) FILTER (turn % 2 = 0) AS f0, max_by(text, turn) FILTER (turn % 2 = 1) AS f1 FROM ({RUNS}) GROUP BY role, conv_id, run")
def assemble_docs(spark, d):
    docs = reshape.assemble(reshape.coordinate_runs(_turns(spark, d)))
    return docs.select("type", "id", "run", "last_seq", F.col("fields")["f0"].alias("f0"), F.col("fields")["f1"].alias("f1"))


@query("last_writer_wins", f"SELECT id, type, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY type, id ORDER BY seq DESC) AS r FROM ({T.LINES})) WHERE r = 1")
def last_writer_wins(spark, d):
    return reshape.last_writer(T.line_packets(spark, d)).select("id", "type", "l_partkey", "l_suppkey")


@query("highest_version", f"SELECT id, type, _version, max(l_partkey) AS top FROM (SELECT *, rank() OVER (PARTITION BY type, id ORDER BY _version DESC) AS r FROM ({T.LINES})) WHERE r = 1 GROUP BY ALL")
def highest_version(spark, d):
    rows = T.line_packets(spark, d).withColumn("first", -F.col("l_partkey"))
    return reshape.highest_version(rows, "first").select("id", "type", "_version", F.col("l_partkey").alias("top"))


ROTATE = """WITH RECURSIVE d AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn, doc_id, strlen(text)::BIGINT AS b FROM documents),
r AS (SELECT lang, rn, doc_id, 0 AS part, b AS acc FROM d WHERE rn = 1
      UNION ALL
      SELECT d.lang, d.rn, d.doc_id, CASE WHEN r.acc > 100000 THEN r.part + 1 ELSE r.part END, CASE WHEN r.acc > 100000 THEN d.b ELSE r.acc + d.b END
      FROM r JOIN d ON d.lang = r.lang AND d.rn = r.rn + 1)
SELECT lang, doc_id, part FROM r"""


def _rotated(spark, d):
    rows = T.table(spark, d, "documents").select("lang", "doc_id", F.octet_length("text").cast("long").alias("size"))
    return stats.rotate_parts(rows, "lang", "doc_id", "size", 100_000)


@query("rotate_parts", ROTATE)
def rotate_parts(spark, d):
    return _rotated(spark, d)


@query("split_by_bytes", ROTATE.replace("SELECT lang, doc_id, part FROM r", "SELECT lang, part, count(*) AS docs, sum(d.b)::BIGINT AS bytes FROM r JOIN d USING (lang, doc_id) GROUP BY ALL"))
def split_by_bytes(spark, d):
    sizes = T.table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("b"))
    return _rotated(spark, d).join(sizes, "doc_id").groupBy("lang", "part").agg(F.count("*").alias("docs"), F.sum("b").cast("long").alias("bytes"))


@query("batch_numbers", "SELECT type, o_orderkey, ((row_number() OVER (PARTITION BY type ORDER BY o_orderkey) - 1) // 1000)::BIGINT AS batch FROM (SELECT o_orderstatus AS type, o_orderkey FROM orders)")
def batch_numbers(spark, d):
    rows = T.table(spark, d, "orders").select(F.col("o_orderstatus").alias("type"), "o_orderkey")
    return stats.batch_numbers(rows, 1000, "type", "o_orderkey")


@query("doc_order", f"SELECT {KEY3} FROM {T.STORES}")
def doc_order(spark, d):
    return T.stores(spark, d).sortWithinPartitions("index", "type", "id").select("index", "type", "id")


@query("limit_docs", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100")
def limit_docs(spark, d):
    return order.first_rows(T.table(spark, d, "orders"), ["o_orderkey"], 100).select("o_orderkey")


@query("limit_half", f"SELECT {KEY3}, _source FROM (SELECT *, row_number() OVER (ORDER BY \"index\", type, id) AS n FROM {T.STORES}) WHERE n <= (SELECT count(*) // 2 FROM {T.STORES})")
def limit_half(spark, d):
    """Half of all documents, the first by key: more than one task could hold at scale."""
    docs = T.stores(spark, d)
    return order.first_rows(docs, ["index", "type", "id"], docs.count() // 2).select("index", "type", "id", "_source")


# -- sets


@query("union_indices", f"SELECT {KEY3}, _source FROM {T.STORES} WHERE \"index\" IN ('orders', 'nation')")
def union_indices(spark, d):
    return T.orders_docs(spark, d).unionByName(T.nation_docs(spark, d)).select("index", "type", "id", "_source")


RUN = "SELECT event_type AS mode, user_id AS path, date_trunc('hour', ts)::VARCHAR AS started FROM events"


def _runs(spark, d, mode: str):
    return T.table(spark, d, "events").where(F.col("event_type") == mode).select(F.col("event_type").alias("mode"), F.col("user_id").alias("path"), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("started"))


def _modes(spark, d):
    return [r[0] for r in T.table(spark, d, "events").select("event_type").distinct().orderBy("event_type").limit(2).collect()]


@query("union_runs", f"SELECT * FROM ({RUN}) WHERE mode IN (SELECT DISTINCT event_type FROM events ORDER BY 1 LIMIT 2)")
def union_runs(spark, d):
    one, two = _modes(spark, d)
    return _runs(spark, d, one).unionByName(_runs(spark, d, two))


@query("active_runs", f"SELECT DISTINCT a.path, a.started FROM ({RUN}) a WHERE a.mode = (SELECT min(event_type) FROM events) AND NOT EXISTS (SELECT 1 FROM ({RUN}) b WHERE b.mode <> a.mode AND b.path = a.path AND b.started = a.started)")
def active_runs(spark, d):
    one = _modes(spark, d)[0]
    started = _runs(spark, d, one).select("path", "started").distinct()
    finished = T.table(spark, d, "events").where(F.col("event_type") != one).select(F.col("user_id").alias("path"), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("started"))
    return stats.active_runs(started, finished)


@query("index_set_minus_all", f'SELECT DISTINCT "index" FROM {T.STORES}')
def index_set_minus_all(spark, d):
    s = T.stores(spark, d).select("index")
    return s.unionByName(s.select(F.lit("_all").alias("index"))).distinct().where("index <> '_all'")


# -- aggregates


@query("doc_count", f'SELECT "index", count(*) AS docs FROM {T.STORES} GROUP BY ALL')
def doc_count(spark, d):
    return stats.doc_count(T.stores(spark, d))


@query("export_summary", f"SELECT count(*) AS packets, count(DISTINCT (type, id)) AS docs, sum(strlen(_source))::BIGINT AS bytes FROM ({T.PART})")
def export_summary(spark, d):
    return stats.export_summary(reshape.explode_fields(T.part_docs(spark, d)))


@query("import_summary", f"SELECT \"index\", sum(1 + (_parent IS NOT NULL)::INT + (_timestamp IS NOT NULL)::INT)::BIGINT AS packets FROM {T.STORES} GROUP BY ALL")
def import_summary(spark, d):
    return stats.doc_count(reshape.explode_fields(T.stores(spark, d)), "packets")


@query("bytes_per_second", f"SELECT second, sum(bytes)::BIGINT AS bytes FROM ({T.TRANSFERS}) GROUP BY second")
def bytes_per_second(spark, d):
    return stats.bytes_per_second(T.transfers(spark, d))


@query("overall_rate", f"SELECT sum(bytes)::BIGINT AS bytes, max(second) - min(second) AS seconds, sum(bytes)::DOUBLE / (max(second) - min(second)) AS rate FROM ({T.TRANSFERS})")
def overall_rate(spark, d):
    return stats.overall_rate(T.transfers(spark, d))


@query("remaining_time", f"SELECT run, CASE WHEN sum(bytes)::DOUBLE / (max(second) - min(second)) < 0.001 THEN 0 ELSE floor((2 * sum(bytes) + 12345 - sum(bytes)) / (sum(bytes)::DOUBLE / (max(second) - min(second))) + 0.5) END::BIGINT AS remaining FROM ({T.TRANSFERS}) GROUP BY run")
def remaining_time(spark, d):
    took = F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))
    rows = T.transfers(spark, d).groupBy("run").agg((2 * F.sum("bytes") + 12345).alias("planned"), F.sum("bytes").alias("done"), (F.sum("bytes") / took).alias("rate"))
    return rows.select("run", stats.remaining_time(F.col("planned"), F.col("done"), F.col("rate")).alias("remaining"))


@query("sum_transfers", f"SELECT (2 * sum(bytes))::BIGINT AS planned, sum(bytes)::BIGINT AS done FROM ({T.TRANSFERS})")
def sum_transfers(spark, d):
    return stats.sum_transfers(T.transfers(spark, d).select((2 * F.col("bytes")).alias("planned"), F.col("bytes").alias("done")))


SCALED = f"SELECT second // 600 AS second, sum(bytes) AS bytes FROM ({T.TRANSFERS}) GROUP BY 1"


@query("recent_rate", f"SELECT second, bytes::BIGINT AS bytes, sum(bytes) OVER (ORDER BY second RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)::DOUBLE / 5 AS rate FROM ({SCALED})")
def recent_rate(spark, d):
    scaled = T.transfers(spark, d).withColumn("ts", F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / 600)))
    return stats.recent_rate(scaled)
