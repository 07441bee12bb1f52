"""Line deduplication across documents, with DataFrame functions only.

Only hashes and positions of lines are shuffled. The decision comes back as one compressed bitmap per
document: 64 lines to a word, and a word stands there only if a line of it goes.
"""

from pyspark.sql import Column, DataFrame, functions as F, Window

from millrace.llm.names import apart

# The white space stripped from both ends of a line for its key.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line stripped of white space, A-Z in lower case."""
    stripped = F.trim(line, F.lit(BLANKS))
    return F.when(stripped.rlike("[A-Z]"), F.translate(stripped, UPPER, LOWER)).otherwise(stripped)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _document(docs):
    """Id, text and a 128-bit name of each row's content, by which the bitmap finds its way back."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns(
        {"d1": F.xxhash64("doc_id", "text"), "d2": F.xxhash64(F.lit(7), "text", "doc_id")})


def _line_hashes(documents):
    keys = F.transform(split_lines(F.col("text")), line_key)
    hashed = F.transform(keys, lambda k, i: F.struct(
        F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(11), k).alias("h2"), i.alias("pos"), (k != "").alias("full")))
    lines = documents.select("doc_id", "d1", "d2", F.explode(F.filter(hashed, lambda x: x["full"])).alias("l"))
    return lines.select("doc_id", "d1", "d2", "l.h1", "l.h2", "l.pos")


def _dropped_lines(documents, mode, min_docs):
    lines = _line_hashes(documents)
    slices = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A key's documents are dealt to slices, and (key, slice) is what a task holds together: a key with a third
    # of all lines is spread by its documents, and ranges by key still keep its slices near each other.
    sliced = lines.withColumn("slice", F.pmod("d1", F.lit(slices)))
    ordered = sliced.repartitionByRange(slices, "h1", "h2", "slice").sortWithinPartitions(
        "h1", "h2", "slice", "doc_id", "d1", "d2", "pos")
    run = Window.partitionBy("h1", "h2", "slice").orderBy("doc_id", "d1", "d2", "pos")
    same = (F.lag("d1").over(run) == F.col("d1")) & (F.lag("d2").over(run) == F.col("d2"))
    streamed = ordered.withColumn("new_doc", ~F.coalesce(same, F.lit(False)))
    place = F.struct("doc_id", "d1", "d2", "pos")
    # Only what comes first in its document is counted; the range order lets each task fold a key to one row.
    keys = streamed.filter("new_doc").groupBy("h1", "h2").agg(
        F.count("*").alias("n_docs"), F.min(place).alias("first"))
    if mode == "common":
        keys = keys.filter(F.col("n_docs") >= min_docs).select("h1", "h2")
        return lines.join(keys, ["h1", "h2"], "left_semi").select("d1", "d2", "pos")
    firsts = keys.select("h1", "h2", "first")
    return lines.join(firsts, ["h1", "h2"]).filter(~(place.eqNullSafe(F.col("first")))).select("d1", "d2", "pos")


def keep_bitmaps(docs: DataFrame, mode: str = "first", min_docs: int = 10) -> DataFrame:
    """``d1, d2, drops`` for each document (distinct id and text) that loses lines; others have no row.

    ``drops`` is an array of (word number, bits of the lines that go), in order; a word that is not there keeps
    all its 64 lines. With ``mode="first"`` a line stays only where its key occurs first (smallest id, then
    position); with ``mode="common"`` keys found in ``min_docs`` documents or more lose all their lines.

    Lines are dealt by ranges of their hashes with a secondary sort by document and position, and a window
    streams over each run. Lines whose key is empty never go. Null and empty texts have one empty line. Rows
    repeated with the same id and text are one document; rows that share only the id are different ones. A null id sorts
    first. Other columns are ignored. Two 64-bit hashes stand for a key.
    """
    if mode not in ("first", "common"):
        raise ValueError(f"unknown mode {mode}")
    dropped = _dropped_lines(_document(docs), mode, min_docs)
    words = dropped.groupBy("d1", "d2", F.expr("int(pos div 64)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("d1", "d2").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops"))


DENSE = "transform(sequence(0, element_at(__drops, -1).word), w -> coalesce(map_from_entries(__drops)[w], 0L))"


def _with_bitmaps(docs, mode, min_docs):
    """The rows of ``docs`` with their lines, those that stay, and whether any goes, under reserved names."""
    bitmaps = keep_bitmaps(docs, mode, min_docs).toDF("__d1", "__d2", "__drops")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    named = docs.withColumns({"__d1": F.xxhash64(doc_id, text), "__d2": F.xxhash64(F.lit(7), text, doc_id)})
    # One word per 64 lines up to the last that loses any, so that a line finds its bit by index.
    joined = named.join(bitmaps, ["__d1", "__d2"], "left").withColumns(
        {"__lines": split_lines(F.col("text")), "__dense": F.expr(DENSE)})
    stays = F.filter("__lines", lambda line, i: ~F.coalesce(
        F.getbit(F.get("__dense", F.floor(i / 64).cast("int")), i % 64) == 1, F.lit(False)))
    return joined.withColumn("__stay", F.when(F.col("__drops").isNull(), F.col("__lines")).otherwise(stays))


def drop_lines(docs: DataFrame, mode: str = "first", min_docs: int = 10) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` for every row; see :func:`keep_bitmaps`."""
    n_lines, n_stay = F.size("__lines").cast("long"), F.size("__stay").cast("long")
    return _with_bitmaps(docs, mode, min_docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), n_lines.alias("n_lines"), (n_lines - n_stay).alias("n_dropped"),
        F.array_join("__stay", "\n").alias("kept_text"))


@apart
def without_lines(docs: DataFrame, mode: str = "first", min_docs: int = 10) -> DataFrame:
    """The rows of ``docs`` with ``text`` reduced to the lines that stay and all other columns as they were.

    A text that loses no line is unchanged, null included."""
    return _with_bitmaps(docs, mode, min_docs).withColumn("text", F.when(F.col("__drops").isNull(), F.col("text")).otherwise(
        F.array_join("__stay", "\n"))).select(*docs.columns)
