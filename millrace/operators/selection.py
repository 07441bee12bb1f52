"""Choosing change-log rows by table, type and content."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import cdc

EVENT_TIME = "event_time"


def keep_types(changes, types=schemas.KEPT_TYPES):
    """Rows that put data: inserts, updates and bootstrap rows, not deletes or markers."""
    return changes.filter(F.col("type").isin(*types))


def with_event_time(changes, ts="ts", delay="0 seconds"):
    """Add the watermarked event time of change rows from their epoch seconds; NULL where they name no time."""
    return (changes.withColumn(EVENT_TIME, F.timestamp_seconds(cdc.usable_seconds(ts)))
                   .withWatermark(EVENT_TIME, delay))


def select_table(changes, table, columns, types=None, where=None, keep=()):
    """One source table as columns.

    ``columns`` are members of ``data``; ``where`` is a further condition on the change row and
    ``keep`` maps envelope columns (type, old, ts) to their output names. Filters come before the
    projection so that they reach the scan: on a change log stored by table, the table condition
    prunes partitions.

    If the change log carries ``event_time``, its watermark is to advance with every table's rows,
    or a table without traffic would hold a join back for good. The condition then names the event
    time, which keeps it from being moved below the watermark.
    """
    wanted = F.col("table") == table
    if types:
        wanted = wanted & F.col("type").isin(*types)
    if where is not None:
        wanted = wanted & where
    kept = list(keep.items() if isinstance(keep, dict) else [(c, c) for c in keep])
    if EVENT_TIME in changes.columns:
        wanted = F.when(F.col(EVENT_TIME).isNotNull(), wanted)
        kept.append((EVENT_TIME, EVENT_TIME))
    return changes.filter(wanted).select(*[cdc.data(c).alias(c) for c in columns],
                                         *[F.col(source).alias(name) for source, name in kept])


def union_all(first, *others):
    """All rows of same-shaped frames, columns matched by name."""
    for other in others:
        first = first.unionByName(other)
    return first
