"""Per-visitor operators over the behaviour log, batch forms.

A visitor may own a third of all rows, so none of these brings a visitor's rows into one task:
the first two reduce before they shuffle, the third splits a visitor's history by time.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.times import event_date


def is_session_start(last_page="last_page_id"):
    """A page reached from no other page."""
    return F.col(last_page).isNull()


def assign_event_time(df, ts="ts", delay=schemas.BOUNCE_DELAY, name="event_time"):
    """Event time from epoch milliseconds, with a bounded-lateness watermark."""
    return df.withColumn(name, F.timestamp_millis(F.col(ts))).withWatermark(name, delay)


def repair_new_flag(df, key="mid", flag="is_new", ts="ts", order="arrival", tz="UTC"):
    """Correct the new-visitor flag.

    A visitor's first record, by ``order``, fixes the first-visit day: its own day if it carries
    flag 1, else the day before. A record with flag 1 on any other day gets flag 0.

    The correction depends on visitor and day alone, so it is worked out on one row per visitor and
    day, from minima of plain columns (hash aggregation, combined before the shuffle), and joined
    back on both. ``order`` must be a single sortable column that is unique per visitor.
    """
    marked = df.withColumn("_day", event_date(F.col(ts), tz))
    is_new = F.col(flag) == "1"
    days = marked.groupBy(F.col(key).alias("_key"), F.col("_day").alias("_flip_day")).agg(
        F.min(order).alias("_first"), F.min(F.when(is_new, F.col(order))).alias("_first_new"))
    visitor = Window.partitionBy("_key")
    first_day = F.min_by("_flip_day", "_first").over(visitor)
    starts_new = F.min("_first_new").over(visitor) == F.min("_first").over(visitor)
    flips = (
        days.withColumn("_visit_day", F.when(starts_new, first_day).otherwise(F.date_sub(first_day, 1)))
        .filter(F.col("_first_new").isNotNull() & (F.col("_flip_day") != F.col("_visit_day")))
        .select("_key", "_flip_day", F.lit(True).alias("_flip"))
    )
    joined = marked.join(
        flips, (F.col(key) == F.col("_key")) & (F.col("_day") == F.col("_flip_day")), "left")
    repaired = F.when(is_new & F.col("_flip"), F.lit("0")).otherwise(F.col(flag))
    return joined.withColumn(flag, repaired).select(*df.columns)


def first_visit_per_day(df, key="mid", ts="ts", order="arrival", starts=None, tz="UTC"):
    """A visitor's first session start of each day.

    ``row_number() = 1`` keeps one row per visitor and day in every task before the shuffle (window
    group limit), so the shuffle carries visitors times days, not sessions.
    """
    starts = is_session_start() if starts is None else starts
    day = Window.partitionBy(key, "_day").orderBy(ts, order)
    return (
        df.filter(starts)
        .withColumn("_day", event_date(F.col(ts), tz))
        .withColumn("_n", F.row_number().over(day))
        .filter(F.col("_n") == 1)
        .drop("_day", "_n")
    )


def detect_bounce(df, key="mid", ts="ts", order="arrival", starts=None,
                  within=schemas.BOUNCE_WITHIN_MS, span=None):
    """Session starts not followed, within ``within`` milliseconds, by a page of the same session.

    A start bounces if the visitor's next record in (``ts``, ``order``) is another start, comes
    ``within`` or more later, or does not exist.

    The next record is sought inside time spans (at least ``within`` long) of a visitor's history.
    Records in the first ``within`` of a span are also put at the end of the span before, where they
    can only be the next record: whatever lies further on is too late to matter. This makes the
    window group (visitor, span) instead of the visitor, in one shuffle. Only starts carry their
    columns through it; other records travel as key, time and order.
    """
    starts = is_session_start() if starts is None else starts
    span = span or 64 * within
    if span < within:
        raise ValueError("span must not be shorter than within")
    begin = F.col(ts) - F.pmod(F.col(ts), F.lit(span))
    early = F.pmod(F.col(ts), F.lit(span)) < within
    rows = df.select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.col(order).alias("_order"),
        begin.alias("_begin"), starts.alias("_start"),
        F.when(starts, F.struct(*df.columns)).alias("_row"),
        F.explode(F.when(early, F.array(begin, begin - span)).otherwise(F.array(begin))).alias("_span"),
    ).withColumn("_own", F.col("_begin") == F.col("_span"))
    rows = rows.withColumn("_row", F.when(F.col("_own"), F.col("_row"))).drop("_begin")
    following = Window.partitionBy("_key", "_span").orderBy("_ts", "_order")
    return (
        rows.withColumn("_next_ts", F.lead("_ts").over(following))
        .withColumn("_next_start", F.lead("_start").over(following))
        .filter(F.col("_start") & F.col("_own"))
        .filter(F.col("_next_ts").isNull() | F.col("_next_start")
                | (F.col("_next_ts") - F.col("_ts") >= within))
        .select("_row.*")
    )
