"""Typed tables from JSON text: the change log, the configuration log, produced detail streams."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.cdc import usable_seconds


def _typed(df, schema, keep):
    """Columns of a JSON text; texts that do not parse give no row.

    The record comes out of an ``explode`` of one element: filters on its columns stop there instead
    of repeating the parse below it, once per condition.
    """
    parsed = df.select(*keep, F.explode(F.array(F.from_json("value", schema))).alias("_r"))
    return parsed.filter(F.col("_r").isNotNull()).select(*keep, "_r.*")


def read_changes(df, tables=None, keep=()):
    """Change-log rows from ``value``; rows without a table name are no change rows and dropped.

    ``tables`` limits the result to some source tables, looking at the table name alone before the
    full parse. With several consumers, parse once and store the result by table
    (``land_changes``): each flow then reads only its tables' folders.
    """
    if tables:
        df = df.filter(F.get_json_object("value", "$.table").isin(*tables))
    return _typed(df, schemas.CHANGE_SCHEMA, keep).filter(F.col("table").isNotNull())


#: What a text of the change log turns out to be, in ``tag_changes``.
CHANGE, UNREADABLE, UNTIMED = "change", "unreadable", "untimed"


def tag_changes(df, keep=()):
    """Every text of a change log once, parsed once, with its ``outcome``.

    ``change`` is a usable change row. ``unreadable`` is no text, text that is no JSON object, or one without a table name;
    ``untimed`` names a table but its ``ts`` no second of the years 1 to 9999, so that no stream could place it in time. Only
    these two keep their text in ``value``. Nothing is left out: the outcomes add up to the texts read.
    """
    record = F.from_json("value", schemas.CHANGE_SCHEMA)
    parsed = df.select("value", *keep, F.explode(F.array(record)).alias("_r")).select("value", *keep, "_r.*")
    outcome = F.when(F.col("table").isNull(), UNREADABLE).when(usable_seconds("ts").isNull(), UNTIMED).otherwise(CHANGE)
    return parsed.withColumn("outcome", outcome).withColumn("value", F.when(F.col("outcome") != CHANGE, F.col("value")))


def split_changes(tagged):
    """(usable change rows, the others with their text) of ``tag_changes`` output."""
    good = tagged.filter(F.col("outcome") == CHANGE).drop("outcome", "value")
    return good, tagged.filter(F.col("outcome") != CHANGE)


def read_config_changes(df, keep=()):
    """Configuration change events (op, before, after, ts_ms) from ``value``."""
    return _typed(df, schemas.CONFIG_CHANGE_SCHEMA, keep).filter(F.col("op").isNotNull())


def read_config_snapshot(table):
    """A configuration table, read whole, as the events of its initial load."""
    row = F.struct(*[F.col(c).cast("string").alias(c) for c in schemas.CONFIG_COLUMNS])
    return table.select(F.lit("r").alias("op"), F.lit(None).cast(schemas.CONFIG_ROW).alias("before"),
                        row.alias("after"), F.lit(0).cast("bigint").alias("ts_ms"))


def read_detail(df, columns, keep=()):
    """A produced detail stream as a typed table, from the JSON text in ``value``."""
    return _typed(df, schemas.detail_schema(columns), keep)
