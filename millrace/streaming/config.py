"""The configuration log, read on from where it was left."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.sinks.merged import MergedTable, start_upsert

ENTRY = "source_name string, op string, entry " + "struct<" + ",".join(f"{c}:string" for c in schemas.CONFIG_COLUMNS) + ">"


class ConfigLog:
    """The configuration in force, advanced by what is new in its log.

    ``read`` returns a stream of configuration events (``read_config_changes``). Each call reads on to the log's present end, from the
    offsets of the last call, and keeps one row per source table, deletes included, in a ``MergedTable`` below ``root``; so a call
    reads the new events and the configuration itself, not the log's history. ``order`` lists whole-number columns of the
    events, oldest to newest. The offsets are in ``root`` too: a restarted job, or a second one with the same ``root``, goes on from
    there. One job advances a root at a time.

    ``numbers`` lists how many events each call has read.
    """

    def __init__(self, spark, read, root, order=("ts_ms",), compact_every=20):
        self.spark, self._read, self._root, self._order, self._every = spark, read, root, list(order), compact_every
        ages = "".join(f", `{c}` bigint" for c in self._order)
        self._table = MergedTable(spark, f"{root}/entries", ENTRY + ages, ["source_name"], [f"`{c}`" for c in self._order],
                                  deleted="op = 'd'", buckets=1)
        self.numbers = []

    def _events(self):
        """Events as rows of the table: a delete removes the table named before it, any other event puts the row after it."""
        events = self._read()
        delete = F.col("op") == "d"
        name = F.when(delete, F.col("before.source_table")).otherwise(F.col("after.source_table"))
        entry = F.struct(*[F.col(f"after.{c}").alias(c) for c in schemas.CONFIG_COLUMNS])
        rows = events.select(name.alias("source_name"), "op", F.when(~delete, entry).alias("entry"),
                             *[F.col(c).cast("bigint") for c in self._order])
        return rows.filter("source_name IS NOT NULL")

    def advance(self):
        """Read what is new."""
        query = start_upsert(self._events(), self._table, f"{self._root}/offsets", compact_every=self._every)
        query.awaitTermination()
        self.numbers.append(sum(p["numInputRows"] for p in query.recentProgress))

    def __call__(self):
        self.advance()
        return self._table.current().select("entry.*")
