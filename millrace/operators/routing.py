"""Routing change rows to dimension tables by configuration."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.cdc import keep_columns
from millrace.operators.bounds import MAX_BYTES, MAX_ROWS, broadcast_if_small
from millrace.operators.upsert import latest_by_key


def current_config(config_changes, order=("ts_ms",)):
    """The configuration in force: one row per source table.

    A delete removes the table named before the change; any other event puts the row after it. So a
    row whose source table was renamed leaves the old name in place.
    """
    is_delete = F.col("op") == "d"
    named = config_changes.withColumn(
        "_table", F.when(is_delete, F.col("before.source_table")).otherwise(F.col("after.source_table")))
    last = latest_by_key(named.filter(F.col("_table").isNotNull()), ["_table"], order, deleted=is_delete)
    return last.select(*[F.col(f"after.{c}").alias(c) for c in schemas.CONFIG_COLUMNS])


#: What becomes of a change row under a configuration, in ``tag_by_config``.
ROUTED, UNROUTED, NO_DATA = "routed", "unrouted", "no data"


def tag_by_config(changes, config, types=schemas.KEPT_TYPES, max_rows=MAX_ROWS, max_bytes=MAX_BYTES):
    """Every change row once, with its ``outcome`` under the configuration and, if routed, its target.

    ``unrouted`` is a row whose table is not configured, ``no data`` one of a configured table whose type puts no data
    (deletes, markers); both keep all their members. Adds ``sink_table`` and ``pk`` (the key columns' values; ``id`` where none is
    named); routed rows keep only the configured members. A configuration too large to broadcast is joined by shuffle.
    """
    wanted = config.select(
        F.col("source_table").alias("_source"), "sink_table", "sink_columns",
        F.split(F.coalesce("sink_pk", F.lit("id")), ",").alias("_pk"))
    side = broadcast_if_small(wanted, max_rows, max_bytes)
    kept = F.coalesce(F.col("type").isin(*types), F.lit(False))
    outcome = F.when(F.col("_source").isNull(), UNROUTED).when(~kept, NO_DATA).otherwise(ROUTED)
    routed = F.col("outcome") == ROUTED
    return (
        changes.join(side, F.col("table") == F.col("_source"), "left")
        .withColumn("outcome", outcome)
        .withColumn("pk", F.when(routed, F.transform("_pk", lambda name: F.col("data")[F.trim(name)])))
        .withColumn("data", F.when(routed, keep_columns(F.col("data"), F.col("sink_columns"))).otherwise(F.col("data")))
        .withColumn("sink_table", F.when(routed, F.col("sink_table")))
        .drop("_source", "_pk", "sink_columns")
    )


def route_by_config(changes, config, max_rows=MAX_ROWS, max_bytes=MAX_BYTES):
    """Change rows whose table is configured, with their target and only the configured members.

    Adds ``sink_table`` and ``pk`` (the key columns' values; ``id`` where none is named). A
    configuration too large to broadcast is joined by shuffle.
    """
    wanted = config.select(
        F.col("source_table").alias("_source"), "sink_table", "sink_columns",
        F.split(F.coalesce("sink_pk", F.lit("id")), ",").alias("_pk"))
    side = broadcast_if_small(wanted, max_rows, max_bytes)
    return (
        changes.join(side, F.col("table") == F.col("_source"))
        .withColumn("pk", F.transform("_pk", lambda name: F.col("data")[F.trim(name)]))
        .withColumn("data", keep_columns(F.col("data"), F.col("sink_columns")))
        .drop("_source", "_pk", "sink_columns")
    )


def unrouted(changes, config):
    """Change rows whose table is not configured."""
    known = config.select(F.col("source_table").alias("_source"))
    return changes.join(broadcast_if_small(known), F.col("table") == F.col("_source"), "left_anti")
