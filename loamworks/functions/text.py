"""Text, identity and JSON as columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def stripped(text: Column) -> Column:
    """Unicode white space dropped at both ends."""
    return F.regexp_replace(F.regexp_replace(text, rf"^{_SPACE}+", ""), rf"{_SPACE}+\z", "")


def word_count(text: Column) -> Column:
    """Pieces between white space; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, rf"{_SPACE}+"), lambda x: x != "")), F.lit(0))


def content_hash(url: Column, text: Column) -> Column:
    """Stable identity of a text at an address: SHA-256 hex of the URL, a zero byte and the stripped text."""
    return F.sha2(F.concat(F.encode(url, "UTF-8"), F.lit(b"\x00"), F.encode(stripped(text), "UTF-8")), 256)


def chunk_id(hash_: Column, index: Column) -> Column:
    return F.concat(F.substring(hash_, 1, 16), F.lit("-"), index.cast("string"))


def uuid5(name: Column, space: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """UUID of version 5 of a name, without leaving the JVM."""
    digest = F.sha1(F.concat(F.lit(space.bytes), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def breadcrumb(headings: Column) -> Column:
    return F.array_join(headings, " > ")


def vector_literal(embedding: Column) -> Column:
    """A vector as ``[a,b,…]``."""
    return F.concat(F.lit("["), F.array_join(embedding.cast("array<string>"), ","), F.lit("]"))


def iso_timestamp(at: Column) -> Column:
    """ISO 8601 in UTC; without a fraction where it is zero."""
    whole = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss") == F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    micros = F.date_format(at, "SSSSSS") == "000000"
    return F.when(whole | micros, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def payload(metadata: Column, fields: list[str], timestamps: tuple[str, ...] = ("crawl_timestamp",)) -> Column:
    """A metadata struct as JSON, with nulls kept and timestamps in ISO form."""
    parts = [(iso_timestamp(metadata[x]) if x in timestamps else metadata[x]).alias(x) for x in fields]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def scalar_or_json(json: Column, field: str) -> Column:
    """A field of a JSON object: scalars as they are, objects and arrays as JSON text."""
    return F.get_json_object(json, f"$.{field}")


def class_name(collection: str) -> str:
    """Name of a collection with a capital first letter and the rest in lower case."""
    return collection.capitalize()
