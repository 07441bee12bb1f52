"""The current rows of a change log."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.packing import packed, text_columns, unpacked

#: Text columns of a row from which on they are shuffled as one.
PACKED_FROM = 8


def latest_by_key(df, keys, order, deleted=None):
    """The last row of each key by ``order`` (columns, ascending age to newest).

    ``deleted`` is a condition: a key whose last row meets it is gone. Each task keeps one row per
    key before the shuffle (window group limit), so a key with very many versions costs no more
    than one with as many as there are tasks. Rows of many text columns are shuffled with their texts in one.
    """
    ages = [F.col(c) if isinstance(c, str) else c for c in order]
    texts = text_columns(df, but=_read_by(df, [*map(F.col, keys), *ages]))
    pack = len(texts) >= PACKED_FROM
    slim = packed(df, texts) if pack else df
    newest = Window.partitionBy(*keys).orderBy(*[c.desc() for c in ages])
    last = slim.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") == 1).drop("_n")
    if pack:
        last = unpacked(last, texts).select(*[F.col(f"`{c}`") for c in df.columns])
    return last if deleted is None else last.filter(~F.coalesce(deleted, F.lit(False)))


def _read_by(df, columns):
    """Names, in lower case, of the columns of a frame that expressions read."""
    found = df.select(*columns)._jdf.queryExecution().analyzed().references().toSeq()
    return {found.apply(i).name().lower() for i in range(found.length())}
