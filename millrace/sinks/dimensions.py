"""Dimension tables driven by configuration.

All dimension changes of a batch are written in one pass to one folder tree, partitioned by target
table. A row is stored as its key and a map of the configured members, so the tables' columns neither
meet in one schema nor clash with the batch marks; readers prune to a table's folder and take its
columns, all text, from the configuration. The current rows are the last version of each key.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.upsert import latest_by_key
from millrace.sinks.merged import MergedTable, mark_done
from millrace.sinks.writers import write_batch

VERSION = "_version"
STORED = f"sink_table string, pk array<string>, {VERSION} array<bigint>, data map<string,string>"


def dimension_log(spark, root, buckets=64):
    """All dimension tables below ``root`` as one keyed table: its ``compact`` merges what ``upsert_dimensions`` appended, and
    ``read_dimension`` then reads a table's snapshot and the batches since."""
    return MergedTable(spark, root, STORED, ["sink_table", "pk"], [VERSION], buckets=buckets, partition_by=["sink_table"])


def config_rows(config):
    """The configured tables one after the other, for a caller that needs their names or columns."""
    return list(config.toLocalIterator())


def columns_of(row):
    return row["sink_columns"].split(",")


def keys_of(row):
    return [name.strip() for name in (row["sink_pk"] or "id").split(",")]


def table_schema(row):
    """The configured columns, all text; the key columns are not null."""
    keys = set(keys_of(row))
    return T.StructType([T.StructField(c, T.StringType(), c not in keys) for c in columns_of(row)])


def ensure_table(spark, row, root, name=None):
    """Create the target table of a configuration row if it is absent; returns its name (``name`` if given).

    Key and extension are kept as table options.
    """
    name = name or row["sink_table"]
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=f"{root}/{name}", source="parquet", schema=table_schema(row),
                                  primary_key=",".join(keys_of(row)), extend=row["sink_extend"] or "")
    return name


def upsert_dimensions(routed, root, batch_id=0, writer="main", order=("change_ts",)):
    """Write the last version of each key of a routed batch, all tables in one pass.

    ``routed`` comes from ``route_by_config`` plus the ``order`` columns (whole numbers, oldest to
    newest). Changes of one second are told apart only by an order with the arrival behind it, such as
    ``("change_ts", "arrival")``. NULL stays NULL.
    """
    last = latest_by_key(routed, ["sink_table", "pk"], order)
    version = F.array(*[F.col(c).cast("bigint") for c in order]).alias(VERSION)
    rows = last.select("sink_table", "pk", version, "data")
    # Few files per table, and a table with most of the rows is split over several writers.
    write_batch(rows.hint("rebalance", F.col("sink_table")), root, batch_id, writer, partition_by=["sink_table"])
    mark_done(routed.sparkSession, root, batch_id, writer)


def read_dimension(spark, row, root):
    """The current rows of one dimension table.

    Reads that table's folders only, and of a compacted root no version that its snapshot covers. The columns come from the configuration: one added later is NULL
    in older rows, and one left out is not read.
    """
    last = dimension_log(spark, root).current(F.col("sink_table") == row["sink_table"])
    return last.select(*[F.col("data")[c].alias(c) for c in columns_of(row)])


def publish_dimension(spark, row, root, tables, name=None):
    """Replace the rows of a catalog table by the current rows of its dimension; the table has the dimension's name, or ``name``.

    Columns go by name. One that the table lacks is added to it; one that the configuration has
    dropped stays and becomes NULL.
    """
    name = ensure_table(spark, row, tables, name)
    there = [c.lower() for c in spark.table(name).columns]
    added = [c for c in columns_of(row) if c.lower() not in there]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` STRING' for c in added)})")
    current = read_dimension(spark, row, root)
    known = {c.lower(): c for c in current.columns}
    columns = [F.col(f"`{known[c.lower()]}`") if c.lower() in known else F.lit(None).cast("string").alias(c)
               for c in spark.table(name).columns]
    current.select(*columns).write.insertInto(name, overwrite=True)
    return name
