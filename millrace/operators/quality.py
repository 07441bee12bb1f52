"""Parsing the behaviour log and setting unusable records aside."""

from pyspark.sql import functions as F

from millrace.functions import records as R
from millrace.functions.times import is_time

PARSED = ["record", "mid", "is_new", "page_id", "last_page_id", "ts"]


def parse_log(df, value="value"):
    """Parse log text once: the whole record, plus the members the operators work on as columns.

    ``record`` is NULL for text that is no JSON object. Other columns of ``df`` are kept.

    The parsed members come out of an ``explode`` of one element. Filters on them would otherwise be
    moved below the parse and repeat it for every condition; they stop at an explode.
    """
    members = F.struct(
        R.as_record(F.col("_json")).alias("record"),
        R.get_text(F.col("_json"), "$.common.mid").alias("mid"),
        R.get_text(F.col("_json"), "$.common.is_new").alias("is_new"),
        R.get_text(F.col("_json"), "$.page.page_id").alias("page_id"),
        R.get_text(F.col("_json"), "$.page.last_page_id").alias("last_page_id"),
        R.get_long(F.col("_json"), "$.ts").alias("ts"),
    )
    return (df.withColumn("_json", F.try_parse_json(value))
              .select(*df.columns, F.explode(F.array(members)).alias("_log"))
              .select(*df.columns, "_log.*"))


def is_usable(required=("mid", "ts")):
    """Whether a record of ``parse_log`` output is usable; never null.

    It is not, and so dirty, if there is no text, text that is no JSON object, no required member (the visitor to
    group by, the time to order by), or a ``ts`` that names no time of the years 1 to 9999.
    """
    usable = F.col("record").isNotNull()
    for name in required:
        usable = usable & (is_time(F.col(name)) if name == "ts" else F.col(name).isNotNull())
    return usable


def split_dirty(parsed, required=("mid", "ts")):
    """Usable and dirty records of ``parse_log`` output (``is_usable``): ``(good, dirty)``; dirty keeps the text."""
    usable = is_usable(required)
    dirty = parsed.filter(~usable).select(*[c for c in parsed.columns if c not in PARSED])
    return parsed.filter(usable), dirty
