"""Raw text streams."""

from pyspark.sql import functions as F

# How much one micro-batch takes in, unless the caller names a limit of their own. A backlog is then
# worked off in bounded steps, and what one key can bring into a task at once is bounded with it. A rate: nothing is
# left out. A file larger than the limit is taken alone.
BATCH_LIMITS = {
    "kafka": {"maxOffsetsPerTrigger": "10000000"},
    "text": {"maxBytesPerTrigger": str(64 << 30)},  # digits only: the reader knows no units
    "parquet": {"maxBytesPerTrigger": str(64 << 30)},
}


def read_log(spark, fmt="kafka", streaming=True, keep=(), **options):
    """Text records of a topic or folder as ``value`` (a null payload stays a null record).

    ``fmt`` is ``kafka`` (the connector must be on the class path), ``text`` or ``parquet``;
    ``options`` go to the reader, ``path`` included. ``keep`` names further source columns, such as
    Kafka's ``partition``. Of a topic, ``arrival`` is the offset: it orders the messages of one key, which share a
    partition. A stream resumes where its checkpoint left off and takes in at most ``BATCH_LIMITS`` per micro-batch.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and not any(name.lower().startswith("max") and name.lower().endswith("pertrigger") for name in options):
        options = {**BATCH_LIMITS.get(fmt, {}), **options}
    if streaming and fmt == "parquet":
        reader = reader.schema(options.pop("schema", "value string"))
    rows = reader.format(fmt).options(**options).load()
    return as_log(rows, fmt, keep)


def as_log(rows, fmt, keep=()):
    """The columns of ``read_log`` from a source's rows."""
    arrival = [F.col("offset").alias("arrival")] if fmt == "kafka" else []
    return rows.select(F.col("value").cast("string").alias("value"), *arrival, *keep)
