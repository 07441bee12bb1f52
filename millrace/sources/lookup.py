"""The dictionary table."""

import time

from pyspark.sql import functions as F


def read_lookup(spark, fmt="jdbc", columns=None, **options):
    """A lookup table as a batch frame: over JDBC, or from any file format.

    Connection options (``url``, ``dbtable``, ``user``, ``password``, ``driver``) come from the caller.
    """
    rows = spark.read.format(fmt).options(**options).load()
    return rows.select(*[F.col(c) for c in columns]) if columns else rows


class RefreshingLookup:
    """A lookup read at most once per ``seconds``, for use inside ``foreachBatch``.

    ``read`` returns the frame; it is kept in executor storage until the next refresh, so an edit of
    the table shows after at most ``seconds``. A lost executor's part is read again.
    """

    def __init__(self, read, seconds=3600, clock=time.monotonic):
        self._read, self._seconds, self._clock = read, seconds, clock
        self._frame, self._until = None, None

    def __call__(self):
        now = self._clock()
        if self._frame is None or now >= self._until:
            if self._frame is not None:
                self._frame.unpersist()
            self._frame, self._until = self._read().persist(), now + self._seconds
        return self._frame
