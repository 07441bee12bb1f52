"""Per-visitor operators over streams."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.times import event_date
from millrace.operators.visitors import assign_event_time, is_session_start
from millrace.streaming.processors import BounceProcessor, DailyFirstProcessor, FirstVisitProcessor

# State processors see columns by name only where the name is a public identifier.
DAY, START, EVENT_TIME, SPAN, OWN, GROUP = "visit_day", "session_start", "visit_time", "visit_span", "own_span", "visitor_group"

#: Seconds of processing time after which a visitor's remembered day is forgotten.
DAY_TTL = 24 * 3600
#: A bounce span covers this many waits.
BOUNCE_SPANS = 8
#: Groups of visitors whose bounces share state, in each span. A call costs as much as hundreds of records; fixed for the life of a
#: checkpoint.
BOUNCE_GROUPS = 256


def repair_new_flag(df, key="mid", flag="is_new", ts="ts", order="arrival", tz="UTC", usable=None):
    """Streaming form of the flag correction. ``usable`` names a boolean column: rows where it is false are let through
    unchanged, beside the others and without state, so that they need no second pass; give them keys that spread them.

    A visitor's first-visit day is kept without expiry. Within a micro-batch the record of lowest
    ``order`` counts as the first; across micro-batches, arrival does. ``df`` should be narrow (the
    record text rather than parsed variants), for its rows pass through Python workers.
    """
    marked = df.withColumn(DAY, event_date(F.col(ts), tz))
    repaired = marked.groupBy(key, *([usable] if usable else [])).transformWithStateInPandas(
        statefulProcessor=FirstVisitProcessor(marked.schema, flag, DAY, order),
        outputStructType=marked.schema, outputMode="Append", timeMode="None")
    return repaired.select(*df.columns)


def first_visit_per_day(df, key="mid", ts="ts", order="arrival", starts=None, tz="UTC", ttl=DAY_TTL):
    """Streaming form of the daily first visit.

    A visitor's last day is kept without a watermark: no clock, however wrong, makes another visitor's rows late. ``ttl``
    seconds of processing time after that day's first visit it is forgotten (never, if None), so the state holds the
    visitors of one such span; a row of the same day that arrives later still goes out again. A micro-batch gives a
    visitor's day once. A day comes out again, too, if a later micro-batch returns to it after another day came in between
    (days d1, d2, d1).
    """
    starts = is_session_start() if starts is None else starts
    dated = df.filter(starts).withColumn(DAY, event_date(F.col(ts), tz))
    return dated.groupBy(key).transformWithStateInPandas(
        statefulProcessor=DailyFirstProcessor(DAY, ts, order, None if ttl is None else int(ttl * 1000)),
        outputStructType=dated.schema, outputMode="Append", timeMode="None" if ttl is None else "ProcessingTime").drop(DAY)


def detect_bounce(df, key="mid", ts="ts", order="arrival", starts=None, value="value",
                  within=schemas.BOUNCE_WITHIN_MS, delay=schemas.BOUNCE_DELAY, span=None):
    """Streaming form of bounce detection: rows (key, ts, order, value) of the bounced starts.

    ``order`` breaks ties and must be a whole number. A start is emitted once the watermark
    (``delay`` behind the newest record) shows that nothing can follow it in time; records later
    than the watermark are dropped.

    State is kept by one of ``BOUNCE_GROUPS`` groups of visitors and time ``span`` (milliseconds, at least ``within``): a hot
    visitor's records are spread over tasks, and a call holds a group's records of one span and its seam only. The records of the first ``within`` of a span are also
    sent to the span before it.
    """
    starts = is_session_start() if starts is None else starts
    span = span or BOUNCE_SPANS * within
    if span < within:
        raise ValueError("span must not be shorter than within")
    begin = F.col(ts) - F.pmod(F.col(ts), F.lit(span))
    seam = F.pmod(F.col(ts), F.lit(span)) < within
    slim = assign_event_time(df, ts, delay, EVENT_TIME).select(
        key, ts, order, starts.alias(START), F.when(starts, F.col(value)).alias(value), EVENT_TIME, begin.alias("_begin"),
        F.explode(F.when(seam, F.array(begin, begin - span)).otherwise(F.array(begin))).alias(SPAN))
    own = F.col("_begin") == F.col(SPAN)
    group = F.pmod(F.xxhash64(key), F.lit(BOUNCE_GROUPS)).cast("int").alias(GROUP)
    slim = slim.select(group, key, SPAN, ts, order, START, own.alias(OWN), F.when(own, F.col(value)).alias(value), EVENT_TIME)
    kinds = {name: df.schema[name].dataType.simpleString() for name in (key, ts, order)}
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items()) + f", `{value}` string"
    return slim.groupBy(GROUP, SPAN).transformWithStateInPandas(
        statefulProcessor=BounceProcessor(within, key, ts, order, START, OWN, value),
        outputStructType=schema, outputMode="Append", timeMode="EventTime")
