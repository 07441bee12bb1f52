"""The registered queries of this subpackage and their SQL, by name."""

from pyspark.sql import functions as F

from millrace.llm import (
    bpe, fixity, line_dedup, minhash, mixing, near_duplicates, neighbours, page_text, quality, token_codes, toxicity,
    vector_codes, whitening)
from millrace.session import work_folder

QUERIES = {}
ORACLE = {}


def register(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op3_quality_rules(spark, sf_dir):
    found = quality.quality_rules(table(spark, sf_dir, "documents"))
    return found


@register
def op10_line_dedup(spark, sf_dir):
    found = line_dedup.drop_lines(table(spark, sf_dir, "documents"), mode="common", min_docs=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op10_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), line AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line
), common AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT keyed.*, common.k IS NOT NULL AS gone FROM keyed LEFT JOIN common ON keyed.k = common.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register
def op7_bpe(spark, sf_dir):
    import public_tokenizers

    found = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decode=True)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op4_mixing(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("picks")).alias("taken"))


@register
def op5_token_codes(spark, sf_dir):
    import public_tokenizers

    folder = token_codes.token_folder(spark)
    manifest = token_codes.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_codes.read_digests(manifest, folder)


@register
def op1_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@register
def op6_warc_fixity(spark, sf_dir):
    """Two replicas of all pages as WARC, one with a changed bit in the pages with id 13 modulo 97, and their audit."""
    pages = table(spark, sf_dir, "pages")
    folder = work_folder(spark, "warc")
    catalogue = fixity.write_warc(pages, f"{folder}/a")
    fixity.copy_files(catalogue, f"{folder}/a", f"{folder}/b", harm=F.col("page_id") % 97 == 13)
    found = fixity.audit(catalogue, f"{folder}/a", f"{folder}/b", f"{folder}/trees")
    return found.filter("second_wrong AND NOT first_wrong").select("page_id", "n_bytes")


# All of a record but its url, its page and the digits of its length is the same for every page.
ORACLE["op6_warc_fixity"] = """
SELECT page_id, strlen(coalesce(html, '')) + strlen(coalesce(url, '')) + HEAD
       + length(CAST(strlen(coalesce(html, '')) AS VARCHAR)) AS n_bytes
FROM pages WHERE page_id % 97 = 13
""".replace("HEAD", str(len(fixity.record(None, "", b"")) - 1))


@register
def op8_page_text(spark, sf_dir):
    found = page_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register
def op9_ngram_join(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op11_vector_codes(spark, sf_dir):
    coded, model = vector_codes.compress(table(spark, sf_dir, "embeddings"), label="label")
    return vector_codes.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(model)).alias("codebooks_sha256"))


@register
def op12_whitening(spark, sf_dir):
    found, _ = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found


@register
def op13_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))
