"""The corpus pipeline: from raw documents to token ids of a mixed corpus, in five stages.

Each stage works on all that the one before kept. All but the last return the columns of ``documents``.
"""

from pyspark.sql import functions as F

from millrace.llm import bpe, line_dedup, mixing, near_duplicates, quality
from millrace.session import work_folder

#: Pieces of a run's order in which the mix is drawn.
SHARDS = 64


def good_documents(spark, docs, sf_dir):
    """Quality rules: documents that fail them go."""
    return quality.keep_good(docs)


def first_lines(spark, docs, sf_dir):
    """Line dedup: a line stays where its key occurs first. ``n_chars`` follows the text; a document of which no
    word is left goes."""
    kept = line_dedup.without_lines(docs, mode="first").filter(F.col("text").rlike(mixing.WORD))
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def one_of_each(spark, docs, sf_dir):
    """N-gram Jaccard join: of documents that links connect, the one with the smallest id stays."""
    return near_duplicates.one_of_each(docs)


def mixed(spark, docs, sf_dir):
    """Mixing: each document as often as the mix takes it."""
    return mixing.mixed_rows(docs, shards=SHARDS)


def encoded(spark, docs, sf_dir):
    """BPE: ``doc_id, n_tokens, ids`` of each row."""
    import public_tokenizers

    found = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", good_documents), ("line_dedup", first_lines), ("ngram_join", one_of_each),
          ("mixing", mixed), ("bpe", encoded)]

#: Drawing at random and BPE have no SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over ``documents``; each stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "corpus-pipeline")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
