"""Appending, upserting and fanning out results."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from millrace.operators.upsert import latest_by_key


def as_messages(df, keys=None, deleted=None):
    """Rows as ``(key, value)`` texts for a topic; rows whose ``value`` is already text keep it.

    The key is the JSON array of ``keys`` with nulls kept, so different keys never share a text and a
    message written twice (a topic sink is at-least-once) carries the same one. Null values are skipped. With ``keys``, a row
    that meets the condition ``deleted`` becomes a tombstone: its key without a value, which removes the key from a
    compacted topic and from ``latest_messages``.
    """
    text = F.col("value") if df.columns == ["value"] else F.to_json(F.struct("*"))
    key = F.to_json(F.array(*[F.col(k).cast("string") for k in keys])) if keys else F.xxhash64("value").cast("string")
    if keys and deleted is not None:
        gone = F.coalesce(deleted, F.lit(False))
        return df.filter(gone | text.isNotNull()).select(F.when(~gone, text).alias("value"), key.alias("key"))
    rows = df.select(text.alias("value"), *([key.alias("key")] if keys else []))
    rows = rows.filter(F.col("value").isNotNull())
    return rows if keys else rows.select(key.alias("key"), "value")


def latest_messages(messages, schema, order=("arrival",)):
    """The current rows of a keyed topic: of each key's messages the last one by ``order``, unless it is a tombstone.

    ``messages`` has ``key`` and ``value`` texts; of a topic's offsets only those of one partition compare, and a key's
    messages share one. A value that is no JSON object of ``schema`` gives a row of nulls.
    """
    last = latest_by_key(messages, ["key"], order, deleted=F.col("value").isNull())
    return last.select(F.explode(F.array(F.from_json("value", schema))).alias("_r")).select("_r.*")


@contextmanager
def _no_idle_batches(spark, wanted):
    """Queries started meanwhile run no micro-batch without data; a query keeps the settings of its start."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false" if wanted else before)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_append(df, target, checkpoint=None, fmt="parquet", partition_by=(), trigger=None, keys=None, deleted=None,
                 idle=True, **options):
    """Append rows to a folder, or to a topic with ``fmt="kafka"`` (as messages keyed by ``keys``; those that meet ``deleted``
    as tombstones).

    A stream returns its started query. Files and checkpoint together give each row exactly once; a
    topic gives at least once. ``trigger`` defaults to one run over what is available. ``idle=False`` is for state that
    lives in processing time: such a query always finds a reason for one more micro-batch without data and would not end.
    """
    if fmt == "kafka":
        options.setdefault("topic", target)
        df = as_messages(df, keys, deleted)
    else:
        options["path"] = target
        if fmt == "parquet":
            options.setdefault("compression", "zstd")
    if not df.isStreaming:
        writer = df.write.format(fmt).mode("append").options(**options)
        return (writer.partitionBy(*partition_by) if partition_by else writer).save()
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    writer = (df.writeStream.format(fmt).outputMode("append").options(**options)
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    with _no_idle_batches(df.sparkSession, not idle):
        return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def land_changes(changes, target, checkpoint=None, **options):
    """Store a parsed change log by source table, so that readers prune to their tables' folders."""
    return write_append(changes, target, checkpoint, partition_by=["table"], **options)


def write_upsert(df, target, keys, checkpoint=None, **options):
    """Keyed upsert: every version is appended; ``read_latest`` gives the current rows of a folder.
    In a topic the messages carry the key, so that the topic can be compacted by it. ``merged.MergedTable`` is the form
    whose readers do not read every version ever written."""
    return write_append(df, target, checkpoint, keys=keys, **options)


def read_latest(spark, target, keys, order, deleted=None):
    """The current rows of an upsert target; ``deleted`` marks a version that removes its key."""
    return latest_by_key(spark.read.parquet(target), keys, order, deleted)


#: Columns that mark who wrote a row and in which batch; no payload may use these names.
WRITER, BATCH = "millrace_writer", "millrace_batch"


def write_batch(df, target, batch_id, writer="main", partition_by=(), fmt="parquet"):
    """Write one micro-batch so that a repeated attempt replaces itself.

    The batch number names the folder, under reserved column names; a payload with one of them is refused. A query started over with a new checkpoint counts from zero
    again: give it another ``writer`` name.
    """
    if {c.lower() for c in df.columns} & {WRITER, BATCH}:
        raise ValueError(f"{WRITER} and {BATCH} are reserved column names")
    df = df.withColumns({WRITER: F.lit(writer), BATCH: F.lit(batch_id).cast("long")})
    (df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by, WRITER, BATCH).save(target))


def fan_out(batch, outputs, targets, batch_id, writer="main", fmt="text"):
    """Write several outputs of one micro-batch, each to its own target.

    ``outputs`` makes ``{name: frame}`` from the batch, which is kept in executor storage meanwhile
    (and derived again should an executor be lost). Where the outputs have one shape, routing them
    in one pass (``route_log`` and ``partition_by``) does without storage and without repetition.
    """
    batch = batch.persist()
    try:
        for name, frame in outputs(batch).items():
            write_batch(frame, targets[name], batch_id, writer, fmt=fmt)
    finally:
        batch.unpersist()
