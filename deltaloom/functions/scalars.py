"""Scalar functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), for which value is computed once, however often then names it; branches of a CASE share nothing."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _backwards(raw: Column) -> Column:
    """Bytes in the opposite order: in Latin-1 each is one character."""
    return F.encode(F.reverse(F.decode(raw, "ISO-8859-1")), "ISO-8859-1")


def abbreviate(hex_: Column, first: int = 4, last: int = 4) -> Column:
    """first...last characters of a hex text; shorter ones stay."""
    return F.when(F.length(hex_) > first + last, F.concat(F.substring(hex_, 1, first), F.lit("..."), F.right(hex_, F.lit(last)))).otherwise(hex_)


def parse_identity(text: Column) -> Column:
    """64 hex digits with or without 0x, any case -> lower-case digits; else null."""
    body = F.lower(F.regexp_replace(text, "^0[xX]", ""))
    return F.when(body.rlike("^[0-9a-f]{64}$"), body)


def reverse_bytes(hex_: Column) -> Column:
    """Hex text with its byte pairs in the opposite order."""
    even = _once(hex_, lambda h: F.left(h, F.length(h) - F.length(h) % 2))
    return F.regexp_replace(F.reverse(even), "(.)(.)", "$2$1")


def parse_connection_id(text: Column) -> Column:
    """32 hex digits with or without 0x, any case; else null."""
    body = F.lower(F.regexp_replace(text, "^0[xX]", ""))
    return F.when(body.rlike("^[0-9a-f]{32}$"), body)


def _hyphenated(d: Column) -> Column:
    part = lambda a, n: F.substring(d, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def parse_uuid(text: Column) -> Column:
    """A uuid with or without hyphens, any case -> lower-case hyphenated; else null."""
    return _once(F.lower(F.replace(text, F.lit("-"), F.lit(""))), lambda d: F.when(d.rlike("^[0-9a-f]{32}$"), _hyphenated(d)))


def uuid_from_little_endian(raw: Column) -> Column:
    """16 little-endian bytes -> hyphenated text; null where there aren't 16."""
    digits = _once(raw, lambda r: F.when(F.length(r) == 16, F.lower(F.hex(_backwards(r)))))
    return _once(digits, lambda d: F.when(d.isNotNull(), _hyphenated(d)))


def uuid_to_little_endian(text: Column) -> Column:
    """A uuid's text -> its 16 bytes in little-endian order; null where it is none."""
    return _backwards(F.unhex(F.replace(parse_uuid(text), F.lit("-"), F.lit(""))))


def micros_to_interval(micros: Column) -> Column:
    """A count of microseconds, any that a long holds -> a day-time interval."""
    return micros.cast("long") * F.expr("INTERVAL '0.000001' SECOND")


def schedule_to_json(at: Column) -> Column:
    """struct<type, micros> -> the JSON that schedule_at reads."""
    return F.when(at.isNotNull(), F.to_json(F.struct(at["type"].alias("type"), at["micros"].alias("value"))))


def variant(tag: Column, value: Column, names: list[str]) -> Column:
    """A tagged union's tag number and payload text -> its JSON; null where no variant has that number."""
    name = F.when(tag.between(0, len(names) - 1), F.get(F.array(*map(F.lit, names)), tag.cast("int")))
    return F.when(name.isNotNull(), F.to_json(F.struct(name.alias("type"), value.alias("value"))))


def variant_of(json: Column, names: list[str]) -> Column:
    """The JSON of a tagged union -> struct<tag, value>; null where its type is none of names."""
    v = F.from_json(json, "type string, value string")
    tag = F.array_position(F.array(*map(F.lit, names)), v["type"]).cast("int") - 1
    return F.when(tag >= 0, F.struct(tag.alias("tag"), v["value"].alias("value")))


def schedule_at(json: Column) -> Column:
    """{"type": "interval" | "time", "value": micros} -> struct<type, micros>."""
    v = F.from_json(json, "type string, value bigint")
    return F.when(v["type"].isin("interval", "time"), F.struct(v["type"].alias("type"), v["value"].alias("micros")))


def is_variant(json: Column, name: str) -> Column:
    return F.coalesce(F.get_json_object(json, "$.type") == name, F.lit(False))


def query_hash(queries: Column) -> Column:
    """Stable 32-bit hash of a group of queries: spaces collapsed, sorted, FNV-1a over UTF-16LE, a line feed after each.

    The order is that of UTF-16 units, which big-endian bytes have; UTF-8 orders letters beyond the basic plane otherwise.
    """
    clean = F.transform(queries, lambda q: F.trim(F.regexp_replace(q, r"(?U)\s+", " ")))
    ranked = F.array_sort(F.transform(clean, lambda q: F.struct(F.encode(q, "UTF-16BE").alias("at"), q.alias("q"))))
    text = F.array_join(F.transform(ranked, lambda r: F.concat(F.hex(F.encode(r["q"], "UTF-16LE")), F.lit("0A"))), "")
    pairs = F.regexp_extract_all(text, F.lit("(..)"), F.lit(1))
    step = lambda h, p: F.pmod(h.bitwiseXOR(F.conv(p, 16, 10).cast("long")) * F.lit(16777619).cast("long"), F.lit(1 << 32))
    return F.aggregate(pairs, F.lit(2166136261).cast("long"), step)


def from_tables(query: Column) -> Column:
    """Names of tables after FROM alone, quotes off: those whose rows a subscription returns."""
    return F.array_distinct(F.regexp_extract_all(query, F.lit(r"""(?i)FROM\s+["`]?(\w+)["`]?"""), F.lit(1)))


def table_refs(query: Column) -> Column:
    """Names of tables after FROM and JOIN, quotes off."""
    return F.array_distinct(F.regexp_extract_all(query, F.lit(r"""(?i)\b(?:from|join)\s+["`]?(\w+)["`]?"""), F.lit(1)))
