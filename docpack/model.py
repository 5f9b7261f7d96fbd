"""Schemas that flow through the library, and how the driver's tables become documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

PACKET = "index string, type string, id string, field string, payload string, meta map<string,string>, seq long, archive string, part int"
DOC = "index string, type string, id string, _parent string, _routing string, _timestamp string, _version long, _source string, fields map<string,string>"
#: a document as a reader puts it together from neighbouring entries
RUN = "index string, type string, id string, fields map<string,string>, run long, last_seq long, archive string, part int"
META = "index string, kind string, name string, body string"
_TYPES = {"string": StringType(), "long": LongType(), "map<string,string>": MapType(StringType(), StringType())}


def struct(ddl: str) -> StructType:
    """A schema text of this module as a type; works before there is a session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (x.split(" ", 1) for x in ddl.split(", "))])


KEY = ["index", "type", "id"]
ATTRIBUTES = ["_parent", "_routing", "_timestamp", "_version"]


def documents(rows: DataFrame, index: str | Column, type_: str | Column, id_: str | Column, source: list[str], **attributes: str | Column) -> DataFrame:
    """``rows`` as documents. A string names a column; ``source`` are the columns of the JSON; attributes as in ``DOC``, with ``fields`` a map column."""
    col = lambda x: F.col(x) if isinstance(x, str) else x
    given = {k: col(v) for k, v in attributes.items()}
    return rows.select(
        (F.lit(index) if isinstance(index, str) else index).cast("string").alias("index"),
        col(type_).cast("string").alias("type"),
        col(id_).cast("string").alias("id"),
        *[given.get(a, F.lit(None)).cast("long" if a == "_version" else "string").alias(a) for a in ATTRIBUTES],
        (F.to_json(F.struct(*source)) if source else F.lit(None).cast("string")).alias("_source"),
        given.get("fields", F.lit(None)).cast("map<string,string>").alias("fields"),
    )
