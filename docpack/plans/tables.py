"""The driver's tables as documents and packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpack.model import documents

STRING = ["_parent", "_routing", "_timestamp"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_docs(spark, sf_dir) -> DataFrame:
    return documents(table(spark, sf_dir, "part"), "part", "p_type", "p_partkey", ["p_partkey", "p_name", "p_brand", "p_size"])


def nation_docs(spark, sf_dir) -> DataFrame:
    return documents(table(spark, sf_dir, "nation"), "nation", F.lit("nation"), "n_nationkey", ["n_nationkey", "n_name", "n_regionkey"], _parent="n_regionkey")


def region_docs(spark, sf_dir) -> DataFrame:
    return documents(table(spark, sf_dir, "region"), "region", F.lit("region"), "r_regionkey", ["r_regionkey", "r_name"])


def customer_docs(spark, sf_dir) -> DataFrame:
    return documents(table(spark, sf_dir, "customer"), "customer", "c_mktsegment", "c_custkey", ["c_custkey", "c_name", "c_nationkey"])


def day(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def orders_docs(spark, sf_dir) -> DataFrame:
    return documents(table(spark, sf_dir, "orders"), "orders", "o_orderstatus", "o_orderkey", ["o_orderkey", "o_custkey", "o_orderpriority"], _parent="o_custkey", _timestamp=day("o_orderdate"))


def page_docs(spark, sf_dir) -> DataFrame:
    return documents(table(spark, sf_dir, "pages"), "pages", F.lit("page"), "url", ["page_id"])


def text_docs(spark, sf_dir) -> DataFrame:
    """Documents with two stored fields, one of them the raw text."""
    fields = F.create_map(F.lit("text"), F.col("text"), F.lit("lang"), F.col("lang"))
    return documents(table(spark, sf_dir, "documents"), "documents", "lang", "doc_id", ["doc_id", "source", "n_chars"], fields=fields)


def event_docs(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("source", F.col("props"))
    docs = documents(rows, "events", "event_type", "event_id", ["event_id", "user_id"], _timestamp=F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), _routing="user_id")
    return docs


def line_packets(spark, sf_dir) -> DataFrame:
    """Line items as packets of documents that come again: order and line number are the key, the rest their order."""
    rows = table(spark, sf_dir, "lineitem")
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return rows.select(
        F.lit("lineitem").alias("index"), F.col("l_returnflag").alias("type"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        "l_partkey", "l_suppkey", F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long").alias("_version"), order.alias("seq"),
    )


def transfers(spark, sf_dir) -> DataFrame:
    """Events as a transfer log: the run, the time and the bytes of each."""
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("run"), F.col("ts").cast("timestamp").alias("ts"), F.octet_length("props").cast("long").alias("bytes"))


def stores(spark, sf_dir) -> DataFrame:
    """Orders, customers, nations and regions in one."""
    return orders_docs(spark, sf_dir).unionByName(customer_docs(spark, sf_dir)).unionByName(nation_docs(spark, sf_dir)).unionByName(region_docs(spark, sf_dir))


def meta_rows(spark, sf_dir) -> DataFrame:
    """Metadata that follows from the data: settings by order count, mappings by status and segment, an alias by segment."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    shards = F.concat(F.lit('{"index.number_of_shards":"'), (1 + F.pmod(F.count("*"), F.lit(5))).cast("string"), F.lit('"}'))
    none = F.lit(None).cast("string")
    mapping = lambda n: F.concat(F.lit('{"properties":{"n":'), n.cast("string"), F.lit("}}"))
    return (
        orders.groupBy().agg(shards.alias("body")).select(F.lit("orders").alias("index"), F.lit("_settings").alias("kind"), none.alias("name"), "body")
        .unionByName(customers.groupBy().agg(shards.alias("body")).select(F.lit("customer").alias("index"), F.lit("_settings").alias("kind"), none.alias("name"), "body"))
        .unionByName(orders.groupBy("o_orderstatus").agg(mapping(F.count("*")).alias("body")).select(F.lit("orders").alias("index"), F.lit("_mapping").alias("kind"), F.col("o_orderstatus").alias("name"), "body"))
        .unionByName(customers.groupBy("c_mktsegment").agg(mapping(F.count("*")).alias("body")).select(F.lit("customer").alias("index"), F.lit("_mapping").alias("kind"), F.col("c_mktsegment").alias("name"), "body"))
        .unionByName(customers.select("c_mktsegment").distinct().select(F.lit("customer").alias("index"), F.lit("_alias").alias("kind"), F.concat(F.lit("only_"), F.lower("c_mktsegment")).alias("name"), F.concat(F.lit('{"term":{"type":"'), "c_mktsegment", F.lit('"}}')).alias("body")))
    )


#: DuckDB forms of the same
PART = "SELECT 'part' AS \"index\", p_type AS type, p_partkey::VARCHAR AS id, '{\"p_partkey\":' || p_partkey || ',\"p_name\":\"' || p_name || '\",\"p_brand\":\"' || p_brand || '\",\"p_size\":' || p_size || '}' AS _source FROM part"
ORDERS = "SELECT 'orders' AS \"index\", o_orderstatus AS type, o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS _parent, strftime(o_orderdate, '%Y-%m-%d') AS _timestamp, '{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"o_orderpriority\":\"' || o_orderpriority || '\"}' AS _source FROM orders"
CUSTOMER = "SELECT 'customer' AS \"index\", c_mktsegment AS type, c_custkey::VARCHAR AS id, NULL::VARCHAR AS _parent, NULL::VARCHAR AS _timestamp, '{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\",\"c_nationkey\":' || c_nationkey || '}' AS _source FROM customer"
NATION = "SELECT 'nation' AS \"index\", 'nation' AS type, n_nationkey::VARCHAR AS id, n_regionkey::VARCHAR AS _parent, NULL::VARCHAR AS _timestamp, '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS _source FROM nation"
REGION = "SELECT 'region' AS \"index\", 'region' AS type, r_regionkey::VARCHAR AS id, NULL::VARCHAR AS _parent, NULL::VARCHAR AS _timestamp, '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}' AS _source FROM region"
STORES = f"({ORDERS} UNION ALL {CUSTOMER} UNION ALL {NATION} UNION ALL {REGION})"
PAGE = "SELECT 'pages' AS \"index\", 'page' AS type, url AS id, '{\"page_id\":' || page_id || '}' AS _source FROM pages"
LINES = "SELECT l_returnflag AS type, l_orderkey || '-' || l_linenumber AS id, l_partkey, l_suppkey, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS _version, row_number() OVER (ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS seq FROM lineitem"
TRANSFERS = "SELECT event_type AS run, ts, strlen(props) AS bytes, epoch(date_trunc('second', ts))::BIGINT AS second FROM events"
METAS = """(
SELECT 'orders' AS "index", '_settings' AS kind, NULL::VARCHAR AS name, '{"index.number_of_shards":"' || (1 + count(*) % 5) || '"}' AS body FROM orders
UNION ALL SELECT 'customer', '_settings', NULL, '{"index.number_of_shards":"' || (1 + count(*) % 5) || '"}' FROM customer
UNION ALL SELECT 'orders', '_mapping', o_orderstatus, '{"properties":{"n":' || count(*) || '}}' FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'customer', '_mapping', c_mktsegment, '{"properties":{"n":' || count(*) || '}}' FROM customer GROUP BY c_mktsegment
UNION ALL SELECT DISTINCT 'customer', '_alias', 'only_' || lower(c_mktsegment), '{"term":{"type":"' || c_mktsegment || '"}}' FROM customer)"""
URL = lambda x: f"replace(replace(replace(url_encode({x}),'%20','+'),'%2A','*'),'~','%7E')"
