"""Column expressions over change-log rows (``type``, ``data``, ``old``)."""

from pyspark.sql import functions as F

from millrace.functions.times import FIRST_MS, LAST_MS


def data(name):
    return F.col("data")[name]


def old(name):
    return F.col("old")[name]


def status_changed(column, to):
    """An update that moved ``column`` to ``to``.

    ``old`` lists only the changed members, so its member being present and not null is the test;
    a change away from NULL is therefore not seen.
    """
    return (F.col("type") == "update") & (data(column) == to) & old(column).isNotNull()


def is_increase(column):
    """True for an insert, and for an update that raised ``column``."""
    raised = data(column).try_cast("int") > old(column).try_cast("int")
    return (F.col("type") == "insert") | ((F.col("type") == "update") & F.coalesce(raised, F.lit(False)))


def increase(column):
    """How much ``column`` grew, as text; meaningful where ``is_increase`` holds."""
    # Differences of ints always fit a bigint.
    grown = data(column).try_cast("int").cast("bigint") - old(column).try_cast("int").cast("bigint")
    return F.when(F.col("type") == "insert", data(column)).otherwise(grown.cast("string"))


def line_amount(quantity, price):
    """Quantity times price as text with four decimals."""
    return (quantity.try_cast("decimal(16,2)") * price.try_cast("decimal(16,2)")).cast("string")


def date_id(text):
    """Day of a date-time text as yyyy-MM-dd; NULL where the text is no date-time.

    Goes through TIMESTAMP_NTZ: no session zone is involved and a bare time of day stays NULL.
    """
    return text.try_cast("timestamp_ntz").cast("date").cast("string")


def keep_columns(values, sink_columns):
    """Drop the members of a map whose names are not in a comma-separated list (exact names)."""
    names = F.split(sink_columns, ",")
    return F.map_filter(values, lambda name, _: F.array_contains(names, name))


def change_seconds(ts="ts"):
    """Epoch seconds of a change row, whose ``ts`` is text."""
    return F.col(ts).try_cast("bigint")


def usable_seconds(ts="ts"):
    """Epoch seconds of a change row, NULL where they name no time of the years 1 to 9999."""
    seconds = change_seconds(ts)
    return F.when(seconds.between(FIRST_MS // 1000, LAST_MS // 1000), seconds)
