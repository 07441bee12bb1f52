"""Rows of many text columns on their way through a shuffle.

A text column costs 8 bytes beside its text, which is filled up to a whole number of words; together texts cost two bytes more each.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTES, SIZES, LONG = "_text_bytes", "_text_sizes", "_text_long"
#: Sizes from which on a row's go to ``LONG`` instead of ``SIZES``, whose numbers have 16 bits.
_LONG_FROM = 1 << 15


def text_columns(df, but=()):
    """The columns that ``packed`` takes, if names are told apart by more than their case; ``but`` are names in lower case."""
    if len({c.lower() for c in df.columns}) < len(df.columns):
        return []
    return [f.name for f in df.schema if f.dataType == T.StringType() and f.name.lower() not in but]


def packed(df, texts):
    """Rows whose columns ``texts`` are one value: their bytes in a row, and their sizes."""
    columns = [F.col(f"`{c}`") for c in texts]
    sizes = [F.octet_length(c) for c in columns]
    joined = F.concat(*[F.coalesce(c.cast("binary"), F.lit(b"")) for c in columns])
    long = F.greatest(*sizes, F.lit(0)) >= _LONG_FROM
    short = F.when(~long, F.array(*[n.try_cast("smallint") for n in sizes]))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in texts], joined.alias(BYTES), short.alias(SIZES),
                     F.when(long, F.array(*sizes)).alias(LONG))


def unpacked(df, texts):
    """The columns ``texts`` of ``packed`` rows again, behind the others."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (BYTES, SIZES, LONG)]
    start, columns = F.lit(1), []
    for i, name in enumerate(texts):
        size = F.coalesce(F.col(SIZES)[i].cast("int"), F.col(LONG)[i])
        columns.append(F.substring(F.col(BYTES), start, size).cast("string").alias(name))
        start = start + F.coalesce(size, F.lit(0))
    return df.select(*kept, *columns)
