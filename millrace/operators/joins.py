"""Joins between change streams, and lookups in a dictionary."""

from functools import reduce

from pyspark.sql import functions as F

from millrace.operators.bounds import MAX_BYTES, MAX_ROWS, fits
from millrace.operators.selection import EVENT_TIME, with_event_time

BUCKET_SPANS = 10   # one time bucket covers this many retention spans
RIGHT_TIME = "_right_time"


def _seconds(name):
    return F.col(name).try_cast("bigint")


def retained_join(left, right, on, how="inner", ttl=None, left_ts=None, right_ts=None,
                  delay="0 seconds"):
    """Equi-join of two change streams whose rows wait ``ttl`` seconds for their partner.

    ``on`` lists ``(left column, right column)`` pairs; ``how`` is ``inner`` or ``left``. The result
    has the left columns, then the right ones without the right keys. Column names must otherwise
    differ. ``left_ts`` and ``right_ts`` name epoch-second columns; they are needed with ``ttl``.

    * ``ttl=None`` (batch): every pair of a key joins, however far apart.
    * ``ttl`` given: pairs at most ``ttl`` seconds apart join. The condition is on event time, so
      it equals a processing-time retention only while arrival keeps pace with event time.
    * streams: ``ttl`` is required. The band lets the state be evicted; a left row without partner
      is emitted once, padded, after the watermark has passed. A side that has no ``event_time``
      gets it here, ``delay`` late. The result keeps one watermarked column, ``event_time`` of the
      left side, so that joins can be chained.

    With a band, time buckets become part of the join key: a right row is repeated in the one or
    two buckets its band touches, a left row stays in one. Rows of a key far apart in time are
    never paired, and a hot key spreads over as many partitions (or state stores) as it has buckets.
    Without a band a hot key is left to adaptive skew splitting, which both inputs allow because
    each is shuffled directly into the join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    streaming = left.isStreaming or right.isStreaming
    if streaming and ttl is None:
        raise ValueError("a stream join needs ttl")
    if ttl is not None and not (left_ts and right_ts):
        raise ValueError("ttl needs left_ts and right_ts")

    renamed = {key: f"_right_{key}" for _, key in on}
    right = right.withColumnsRenamed(renamed)
    match = [left[l] == right[renamed[r]] for l, r in on]
    dropped = list(renamed.values())

    if ttl is not None:
        span = BUCKET_SPANS * max(int(ttl), 1)
        to_bucket = lambda seconds: F.floor(seconds / span)
        at = _seconds(right_ts if right_ts not in renamed else renamed[right_ts])
        right = (right.withColumn("_right_at", at)
                      .withColumn("_right_bucket", F.explode(F.sequence(
                          to_bucket(F.col("_right_at") - ttl), to_bucket(F.col("_right_at") + ttl)))))
        left = (left.withColumn("_left_at", _seconds(left_ts))
                    .withColumn("_left_bucket", to_bucket(F.col("_left_at"))))
        dropped += ["_right_at", "_right_bucket", "_left_at", "_left_bucket"]
        match = [F.col(l) == F.col(renamed[r]) for l, r in on]
        match.append(F.col("_left_bucket") == F.col("_right_bucket"))
        if streaming:
            if EVENT_TIME not in left.columns:
                left = with_event_time(left, left_ts, delay)
            if EVENT_TIME not in right.columns:
                right = with_event_time(right, "_right_at", delay)
            right = right.withColumnRenamed(EVENT_TIME, RIGHT_TIME)
            dropped.append(RIGHT_TIME)
            band = F.expr(f"interval {int(ttl)} seconds")
            match += [F.col(EVENT_TIME) >= F.col(RIGHT_TIME) - band,
                      F.col(EVENT_TIME) <= F.col(RIGHT_TIME) + band]
        else:
            match.append(F.col("_left_at").between(F.col("_right_at") - ttl, F.col("_right_at") + ttl))

    return left.join(right, reduce(lambda a, b: a & b, match), how).drop(*dropped)


def lookup_join(df, dictionary, on, columns, key="dic_code", how="inner",
                max_rows=MAX_ROWS, max_bytes=MAX_BYTES, small=None):
    """Attach dictionary columns by code.

    ``columns`` maps dictionary columns to output names. Inner by default: rows whose code is null
    or unknown disappear. The dictionary is measured on every call (unless ``small`` already says
    how it came out) and broadcast when small, in which case the other side is not shuffled.
    """
    if dictionary.isStreaming:
        raise ValueError("the dictionary must be a batch frame")
    wanted = dictionary.select(F.col(key).alias("_code"),
                               *[F.col(c).alias(name) for c, name in columns.items()])
    if small is None:
        small = fits(wanted, max_rows, max_bytes)
    side = F.broadcast(wanted) if small else wanted
    return df.join(side, F.col(on) == F.col("_code"), how).drop("_code")


def two_role_lookup(df, dictionary, roles, column="dic_name", key="dic_code", **bounds):
    """The same dictionary in several roles: ``roles`` maps code columns to output names."""
    small = fits(dictionary.select(key, column), **bounds)
    for code, name in roles.items():
        df = lookup_join(df, dictionary, code, {column: name}, key=key, small=small)
    return df
