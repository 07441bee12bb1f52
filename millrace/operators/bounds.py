"""Broadcasting only what is proven small."""

from pyspark.sql import functions as F

MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024


def fits(df, max_rows=MAX_ROWS, max_bytes=MAX_BYTES):
    """Whether a batch frame stays within a row and a text-size bound.

    Reads at most ``max_rows + 1`` rows and brings one row of two numbers to the driver.
    """
    size = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("n"),
             F.coalesce(F.sum(F.length(F.to_json(F.struct("*"))).cast("bigint")), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def broadcast_if_small(df, max_rows=MAX_ROWS, max_bytes=MAX_BYTES):
    """A broadcast hint when the measured size allows it; otherwise the frame as it is, so that
    the join shuffles both sides and adaptive execution splits its hot keys."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
