"""Schemaless JSON records as ``MAP<STRING, VARIANT>`` columns.

A behaviour-log record has a handful of known members and any number of others which must pass
through unchanged. A map of variants keeps them all, whatever their type, and get, put, remove and
serialise become built-in map functions.
"""

from pyspark.sql import functions as F

RECORD = "map<string,variant>"


def parse_record(text):
    """The record in a JSON text; NULL when the text is no JSON object."""
    return as_record(F.try_parse_json(text))


def as_record(variant):
    """A variant's members; NULL when it is no object."""
    return F.try_variant_get(variant, "$", RECORD)


def as_variant(record):
    return F.to_variant_object(record)


def get_text(variant, path="$"):
    """Text of a member: objects and arrays as JSON, JSON null and absent members as NULL."""
    return F.try_variant_get(variant, path, "string")


def get_long(variant, path="$"):
    return F.try_variant_get(variant, path, "bigint")


def get_items(variant, path="$"):
    """Members of an array; NULL when the member is no array."""
    return F.try_variant_get(variant, path, "array<variant>")


def remove(record, *names):
    return F.map_filter(record, lambda name, _: ~name.isin(*names))


def put(record, **members):
    """Set members from text, number or variant columns, replacing those of the same name."""
    pairs = []
    for name, value in members.items():
        pairs += [F.lit(name), value.cast("variant")]
    return F.map_concat(remove(record, *members), F.create_map(*pairs))


def serialise(record):
    """JSON text without members that are null."""
    return F.to_json(F.map_filter(record, lambda _, v: v.isNotNull() & ~F.is_variant_null(v)))
