"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Each n-gram of a whole text counts once. Its feature is the log ratio of how often it occurs in toxic and in clean
training texts; a logistic regression learns the weights. N-grams whose ratio may be chance have no weight.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import pretokens, spans
from millrace.session import work_folder

SIZES = (3, 4, 5)
BITS = 20
#: Most labelled rows of each class that are learnt from (those with the smallest hash of their id).
ROWS_PER_CLASS = 4000
#: Least standard errors by which an n-gram's log ratio must differ from 0.
CERTAIN = 4.0


def grams(strings):
    """Hashed character n-grams of some texts (A-Z and Latin letters in lower case, white space as one space's kin):
    for each n-gram size the text number and the hash at every place."""
    strings = [s or "" for s in strings]
    points = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    text = np.repeat(np.arange(len(strings)), lengths)
    lower = pretokens._lower()
    points = np.where(points < len(lower), lower[np.minimum(points, len(lower) - 1)], points)
    points = np.where((points >= 9) & (points <= 13), 32, points).astype(np.uint64)
    values = (points + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(29)
    total = np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(points) < n:
            return
        total = total[:len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + values[n - 1:]
        if n in SIZES:
            at = np.flatnonzero(text[:len(points) - n + 1] == text[n - 1:])
            h = total[at] * np.uint64(0xC2B2AE3D27D4EB4F)
            yield text[at], (h >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(strings, mask=None):
    """(text number, n-gram) pairs, each once, sorted."""
    keys = [np.empty(0, np.int64)]
    for text, gram in grams(strings):
        if mask is not None:
            hit = np.flatnonzero(mask[gram])
            text, gram = text[hit], gram[hit]
        keys.append((text << BITS) | gram)
    keys = np.unique(np.concatenate(keys))
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _sample(docs, labels, rows_per_class):
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.filter(~_held_out("doc_id"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("toxic") == c).orderBy(*order).limit(rows_per_class) for c in (0, 1)]
    # At most twice rows_per_class ids: a bound that the data cannot move.
    ids = F.broadcast(chosen[0].union(chosen[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = known.groupBy("toxic").count()
    return texts.join(ids, "doc_id").select("toxic", "text"), {r["toxic"]: r["count"] for r in counts.collect()}


def _held_out(column):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def _gram_rows(batches):
    for rows, strings in spans.chunks(batches):
        text, gram = _distinct(strings)
        bounds = np.searchsorted(text, np.arange(len(strings) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows.column("toxic"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(gram.astype(np.int32)))],
            ["toxic", "grams"])


def _gram_counts(batches):
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        lists = batch.column("grams")
        owner = np.repeat(toxic, lists.value_lengths().to_numpy(zero_copy_only=False))
        gram = lists.flatten().to_numpy(zero_copy_only=False)
        for c in (0, 1):
            counts[c] += np.bincount(gram[owner == c], minlength=1 << BITS)
    some = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[0][some]), pa.array(counts[1][some])],
                                     ["gram", "clean", "toxic"])


def fit_weights(rows, labels, ratios, toxic_share, steps=600, rate=0.1, ridge=1e-4):
    """Weights of a logistic regression on ``ratios[rows]`` (one array of feature numbers per text) and its intercept.
    Toxic texts have ``toxic_share`` of the weight, as among all labels. Full-batch gradient steps with Adam's step sizes."""
    lengths = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    feature = np.concatenate([np.asarray(r, np.int64) for r in rows]) if len(rows) else np.empty(0, np.int64)
    value = ratios[feature]
    y = np.asarray(labels, float)
    weight = np.where(y > 0, toxic_share / max(y.sum(), 1), (1 - toxic_share) / max((1 - y).sum(), 1))
    w, b = np.full(len(ratios), 0.1), 0.0
    m, v = np.zeros(len(ratios) + 1), np.zeros(len(ratios) + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(owner, w[feature] * value, len(rows))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        g = np.append(np.bincount(feature, error[owner] * value, len(ratios)) + ridge * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS):
    """(n-gram numbers, their weights times ratios, intercept) of a model learnt from at most ``rows_per_class`` whole
    texts of each class. Ids with crc32(id as text) mod 5 = 0 are never learnt from. A document with several labels is
    toxic if one says so. Where the labels, or the labelled texts that are there, are of one class only, the score is the share of
    toxic labels, smoothed, and below one half if there are none."""
    spark = docs.sparkSession
    sample, counts = _sample(docs, labels, rows_per_class)
    n_clean, n_toxic = counts.get(0, 0), counts.get(1, 0)
    # Without labels the score lies below one half: nothing speaks against a document.
    unlearnt = np.empty(0, np.int64), np.empty(0), float(np.log((n_toxic + 1) / (n_clean + 2)))
    if not n_clean or not n_toxic:
        return unlearnt
    folder = work_folder(spark, "toxicity-sample")
    sample.repartition(spark.sparkContext.defaultParallelism).mapInArrow(
        _gram_rows, "toxic int, grams array<int>").write.parquet(folder)
    texts = spark.read.parquet(folder)
    texts_of = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not texts_of.get(0) or not texts_of.get(1):
        return unlearnt  # labels of documents that are not there
    total = texts_of
    seen = texts.mapInArrow(_gram_counts, "gram int, clean long, toxic long").groupBy("gram").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Log ratio of the shares of toxic and clean texts with the n-gram, and its standard error.
    ratio = F.log((F.col("toxic") + 1) / (total[1] + 2)) - F.log((F.col("clean") + 1) / (total[0] + 2))
    error = F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("clean") + 1))
    chosen = seen.select("gram", ratio.alias("ratio"), error.alias("error")).filter(F.abs("ratio") > CERTAIN * F.col("error"))
    chosen = chosen.select("gram", "ratio").orderBy("gram").toPandas()  # at most 2 ** BITS rows
    gram, ratios = chosen["gram"].to_numpy(np.int64), chosen["ratio"].to_numpy(float)
    place = np.full(1 << BITS, -1, np.int32)
    place[gram] = np.arange(len(gram))

    def features(batches):
        for batch in batches:
            own = [place[np.asarray(g, np.int64)] for g in batch.column("grams").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([g[g >= 0].tolist() for g in own], pa.list_(pa.int32()))], ["toxic", "grams"])

    learnt = texts.mapInArrow(features, "toxic int, grams array<int>").toPandas()
    learnt = learnt.sort_values(by="grams", key=lambda c: c.map(lambda g: (len(g), tuple(g)))).reset_index(drop=True)
    weights, intercept = fit_weights(learnt["grams"].tolist(), learnt["toxic"].to_numpy(), ratios,
                                     n_toxic / (n_toxic + n_clean))
    return gram, weights * ratios, float(intercept)


def scores(strings, gram, weight, intercept):
    """Chance of label 1 for each text."""
    mask = np.zeros(1 << BITS, bool)
    mask[gram] = True
    table = np.zeros(1 << BITS)
    table[gram] = weight
    text, found = _distinct(strings, mask)
    z = intercept + np.bincount(text, table[found], len(strings))
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text of ``docs`` in one pass without a shuffle. A null or
    empty text has no n-grams and gets the intercept's score; repeated rows and null ids are scored row by row; other
    columns are ignored. The model's size is bounded by the n-gram hash, whatever the data."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        for rows, strings in spans.chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(scores(strings, *shared.value))],
                                             ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = rows.mapInArrow(judged, "doc_id long, score double")
    return found.select("doc_id", _held_out("doc_id").alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
