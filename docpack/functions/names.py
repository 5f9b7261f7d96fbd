"""Entry names, archive names and bulk action lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: suffixes of archive formats and of compression codecs
ARCHIVE_SUFFIX = r"\.(bulk|tar|zip|cpio)(?:\.(gz|bz2|xz|lzf))?$"


def encode_entry_name(*parts: Column) -> Column:
    """Form-URL-encoded components joined by slashes; a null or empty one is the word ``null``."""
    whole = lambda p: F.when(p.isNull() | (p == ""), F.lit("null")).otherwise(F.url_encode(p))
    return F.concat_ws("/", *map(whole, parts))


def name_parts(name: Column) -> Column:
    """Decoded components of an entry name; empty ones collapse."""
    return F.transform(F.filter(F.split(name, "/", -1), lambda x: x != ""), F.url_decode)


def decode_entry_name(name: Column) -> dict[str, Column]:
    """Index, type, id and field of an entry name; all null for a name of more than four components. The word ``null`` stays."""
    parts = name_parts(name)
    part = lambda k: F.when(F.size(parts) <= 4, F.get(parts, F.lit(k)))
    return {c: part(k) for k, c in enumerate(("index", "type", "id", "field"))}


def archive_format(path: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(path), ARCHIVE_SUFFIX, 1), F.lit(""))


def archive_codec(path: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(path), ARCHIVE_SUFFIX, 2), F.lit(""))


def default_archive_name(directory: Column, index: Column, type_: Column) -> Column:
    return F.concat(directory, F.lit("/"), F.coalesce(F.concat(index, F.coalesce(F.concat(F.lit("_"), type_), F.lit(""))), F.lit("_all")), F.lit(".tar.gz"))


def part_file_name(part: Column, name: Column) -> Column:
    plain = F.regexp_replace(name, r"^\d+\.", "")
    return F.when(part > 0, F.concat(part.cast("string"), F.lit("."), plain)).otherwise(plain)


def part_number(file: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(file, r"^(\d+)\.", 1), F.lit("")).cast("int"), F.lit(0))


def payload_bytes(payload: Column) -> Column:
    return F.octet_length(payload).cast("long")


def normalize_name(name: Column) -> Column:
    """Without drive letter and leading slashes, with slashes for back-slashes."""
    return F.regexp_replace(F.translate(F.regexp_replace(name, r"^[A-Za-z]:", ""), "\\", "/"), r"^/+", "")


def bulk_action_line(index: Column, type_: Column, id_: Column) -> Column:
    return F.to_json(F.struct(F.struct(index.alias("_index"), type_.alias("_type"), id_.alias("_id")).alias("index")))


def parse_action_line(line: Column) -> dict[str, Column]:
    """Index, type and id of an action line, with or without its last brace; JSON escapes of quotes and back-slashes are resolved."""

    def part(key: str) -> Column:
        raw = F.regexp_extract(line, rf'"_{key}"\s*:\s*"((?:[^"\\]|\\.)*)"', 1)
        return F.regexp_replace(raw, r'\\(["\\/])', "$1")

    return {c: part(c) for c in ("index", "type", "id")}


def packet_kind(type_: Column, id_: Column) -> Column:
    return F.when(type_ == "_settings", "settings").when(id_ == "_mapping", "mapping").when(id_ == "_alias", "alias").otherwise("doc")


def wrap_mapping(type_: Column, body: Column) -> Column:
    return F.concat(F.lit('{"'), type_, F.lit('":'), body, F.lit("}"))


def unwrap_mapping(type_: Column, body: Column) -> Column:
    """The body of a mapping that ``wrap_mapping`` has wrapped; any other as it is."""
    head = F.concat(F.lit('{"'), type_, F.lit('":'))
    own = F.startswith(body, head) & F.endswith(body, F.lit("}"))
    return F.when(own, F.substring(body, F.length(head) + 1, F.length(body) - F.length(head) - 1)).otherwise(body)


def listing(name: Column, size: Column) -> Column:
    """A line as of ``ls``: kind, size in seven places, name."""
    return F.format_string("%s %7d %s", F.when(F.endswith(name, F.lit("/")), "d").otherwise("-"), size, name)
