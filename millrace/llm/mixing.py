"""Mix sources to target weights by a multivariate-hypergeometric splitting tree over blocks of documents.

Documents fall into ``blocks`` blocks per source by a hash, whatever their number, so a source that holds a third of
all rows is spread like the others and every table of blocks or quotas is bounded by sources times blocks.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.names import apart
from millrace.session import work_folder

WORD = r"[^\x20\x09-\x0D]+"
SOURCE = ["source_name", "no_source"]
#: The search for documents that fit into what a target leaves open goes on, past the block at the edge, through blocks of
#: so many times the words of the source's longest document. What then is open is shorter than that many documents.
LONGEST = 16


def fill_targets(sizes, weights, share, most):
    """Target of each source: its part by weight of ``share`` times all sizes; what is over ``most`` times its
    own size goes to the others by weight, until none is above."""
    sizes = np.asarray(sizes, dtype=float)
    weights = np.asarray(weights, dtype=float)
    left, targets = share * sizes.sum(), np.zeros(len(sizes))
    caps, open_ = most * sizes, np.ones(len(sizes), dtype=bool)
    while open_.any():
        part = left * weights / weights[open_].sum()
        over = open_ & (part > caps)
        if not over.any():
            targets[open_] = part[open_]
            break
        targets[over] = caps[over]
        left -= caps[over].sum()
        open_ &= ~over
    return targets


def split_tree(quotas, shards, seed):
    """Blocks of each source for each shard (rows: shards). The quotas are cut in two again and again; each cut draws
    from a multivariate hypergeometric law, so every shard gets a mix as if the blocks had been shuffled together."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    nodes = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while nodes:
        low, high, own = nodes.pop()
        if high - low == 1:
            out[low] = own
            continue
        middle = (low + high) // 2
        total = int(own.sum())
        taken = total * (middle - low) // (high - low)
        draw = np.random.Generator(np.random.PCG64([seed, low, high]))
        left = draw.multivariate_hypergeometric(own, taken, method="marginals") if 0 < taken < total else own * (taken > 0)
        nodes += [(low, middle, left), (middle, high, own - left)]
    return out


def _targets(totals, weights, share, most):
    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["no_source", "source_name"], key=lambda c: c.map(
            lambda v: v.encode() if isinstance(v, str) else v)).reset_index(drop=True)
        own = [weights[i % len(weights)] for i in range(len(pdf))]
        return pdf.assign(target=fill_targets(pdf["source_size"], own, share, most))

    return totals.groupBy().applyInPandas(
        plan, "source_name string, no_source boolean, source_size long, target double")


def _shards(units, shards, seed):
    """Units (source, pass, block) with their shard: each source's units in a permuted order, cut by the tree."""
    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["no_source", "source_name"]).reset_index(drop=True)
        counts = split_tree(pdf["n_units"].to_numpy(), shards, seed)
        ends = counts.cumsum(axis=0)
        return pd.concat([pdf[SOURCE].assign(shard=i, low=ends[i] - counts[i], high=ends[i]) for i in range(shards)])

    quotas = units.groupBy(SOURCE).agg(F.count("*").alias("n_units"))
    ranges = quotas.groupBy().applyInPandas(
        cut, "source_name string, no_source boolean, shard int, low long, high long")
    permuted = Window.partitionBy(SOURCE).orderBy(F.xxhash64(F.lit(seed), "pass", "block"), "pass", "block")
    placed = units.withColumn("place", F.row_number().over(permuted) - 1)
    return placed.join(ranges, SOURCE).filter("place >= low AND place < high").drop("place", "low", "high")


def _fit(table: pa.Table) -> pa.Table:
    """A source's rows from the edge block on, with ``part``: in their permuted order, each that still fits is in the part
    pass. ``shard`` is the one that the edge block drew for this pass."""
    table = table.sort_by([(c, "ascending") for c in ("low", "block", "key", "doc_id", "text_hash")])
    low, sizes = table.column("low").to_numpy(), table.column("size").to_numpy()
    rest, whole = table.column("rest")[0].as_py(), table.column("whole")[0].as_py()
    part = np.zeros(len(sizes), bool)
    room = rest - low[0]
    for i, size in enumerate(sizes.tolist()):
        if size <= room and (size or low[i] < rest):
            part[i], room = True, room - size
    shards = [d["shard"] for d in table.column("draws")[0].as_py() or () if d["pass"] == whole]
    shard = pa.array([shards[0] if shards else None] * len(part), pa.int32())
    draws = table.column("draws").cast(pa.list_(pa.struct([("pass", pa.int32()), ("shard", pa.int32())])))
    table = table.set_column(table.column_names.index("draws"), "draws", draws)  # its members may be null for Spark
    return table.append_column("part", pa.array(part)).append_column("shard", shard)


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2, shards: int = 16, blocks: int = 1024,
        seed: int = 17) -> DataFrame:
    """``doc_id, text_hash, source, size, source_size, target, picks`` for every row of ``docs``.

    ``size`` counts words. Sources in code point order, null last, weigh ``weights`` in turn and share ``share``
    times all sizes; no target is over ``most`` times its source. A source is taken whole as often as its target
    allows; the rest comes from its blocks in a permuted order, from the block at the edge and those behind it document
    by document, as they still fit, and from the one document outside these whose size is nearest to what then is open. ``picks`` lists each time the row is taken, as
    ``(pass, shard, place)``: no pass takes a row twice, and ``place`` orders a shard.

    A null or empty text has size 0 and, like every row of a whole pass, may be picked with no words. Null ids and
    repeated rows are rows of their own; an empty table gives an empty result. Reruns agree. The sizes are written
    once to the folder of ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    source = F.col("source").cast("string")
    name = F.xxhash64(text)
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), name)
    folder = work_folder(spark, "mix-sizes")
    docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), name.alias("text_hash"),
        F.coalesce(source, F.lit("")).alias("source_name"), source.isNull().alias("no_source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.pmod(key, F.lit(blocks)).cast("int").alias("block"), F.xxhash64(F.lit(seed + 1), key).alias("key"),
    ).write.parquet(folder)
    sized = spark.read.parquet(folder)

    sums = sized.groupBy(*SOURCE, "block").agg(
        F.sum("size").alias("block_size"), F.max("size").alias("longest"))
    totals = sums.groupBy(SOURCE).agg(F.sum("block_size").alias("source_size"))
    targets = _targets(totals, list(weights), share, most).withColumns({
        "whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")})
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    order = Window.partitionBy(SOURCE).orderBy(F.xxhash64(F.lit(seed + 2), "block"), "block")
    placed = sums.join(targets, SOURCE).withColumns({
        "high": F.sum("block_size").over(order), "longest": F.max("longest").over(Window.partitionBy(SOURCE))})
    placed = placed.withColumn("low", F.col("high") - F.col("block_size"))
    # A block is in the part pass whole, not at all, or at or near behind the edge.
    placed = placed.withColumns({
        "edge": (F.col("high") > F.col("rest")) & (F.col("low") < F.col("rest") + LONGEST * F.col("longest")),
        "passes": F.col("whole") + ((F.col("low") < F.col("rest")) & (F.col("block_size") > 0)).cast("int")})
    units = placed.filter("passes > 0").select(
        *SOURCE, "block", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("pass"))
    drawn = _shards(units, shards, seed).groupBy(*SOURCE, "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    plan = placed.select(*SOURCE, "block", "source_size", "target", "low", "rest", "edge", "whole").join(
        drawn, [*SOURCE, "block"], "left")

    rows = sized.join(plan, [*SOURCE, "block"])
    inside = rows.filter(~F.col("edge")).withColumns({"part": F.col("low") < F.col("rest"), "shard": F.lit(None).cast("int")})
    edge = rows.filter("edge")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in edge.schema]
    edge = edge.groupBy(*SOURCE).applyInArrow(_fit, ", ".join([*fields, "part boolean", "shard int"]))
    both = inside.unionByName(edge)
    # What these blocks leave open is closed by the one row outside the part pass whose size is nearest to it.
    gaps = edge.groupBy(SOURCE).agg(
        F.max("rest").alias("__rest"), F.min("low").alias("__low"),
        F.coalesce(F.sum(F.when(F.col("part"), F.col("size"))), F.lit(0)).alias("__in"),
        F.max("shard").alias("__shard"))
    gaps = gaps.select(*SOURCE, (F.col("__rest") - F.col("__low") - F.col("__in")).alias("gap"), "__shard")
    open_blocks = plan.filter(F.col("edge") | (F.col("low") >= F.col("rest"))).select(*SOURCE, "block").join(gaps, SOURCE)
    outside = both.filter(~F.col("part")).select(*SOURCE, "block", "key", "size").join(open_blocks, [*SOURCE, "block"])
    off = F.abs(F.col("size") - F.col("gap"))
    nearest = outside.filter(off < F.col("gap")).groupBy(*SOURCE).agg(
        F.min(F.struct(off.alias("off"), "key", "block", "__shard")).alias("n"))
    fill = nearest.select(*SOURCE, F.col("n.block").alias("block"), F.col("n.key").alias("fill_key"),
                          F.col("n.__shard").alias("fill_shard"))
    both = both.join(fill, [*SOURCE, "block"], "left")
    none = F.array().cast("array<struct<pass:int,shard:int>>")
    draws = F.concat(
        F.filter(F.coalesce("draws", none), lambda d: F.col("part") | (d["pass"] < F.col("whole"))),
        # Blocks behind the edge drew no shard for the part pass: their rows go with the edge block's.
        F.when(F.col("part") & F.col("edge") & (F.col("low") >= F.col("rest")),
               F.array(F.struct(F.col("whole").alias("pass"), F.col("shard")))).otherwise(none),
        F.when((F.col("key") == F.col("fill_key")) & ~F.col("part"),
               F.array(F.struct(F.col("whole").alias("pass"), F.col("fill_shard").alias("shard")))).otherwise(none))
    picks = F.transform(draws, lambda d: F.struct(
        d["pass"].alias("pass"), d["shard"].alias("shard"), F.xxhash64(F.lit(seed), d["shard"], d["pass"], "key").alias("place")))
    return both.select("doc_id", "text_hash", F.when(~F.col("no_source"), F.col("source_name")).alias("source"), "size",
                       "source_size", "target", picks.alias("picks"))


@apart
def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, each as often as it is taken, with all their columns; rows of
    one shard lie together in their drawn order."""
    picked = mix(docs, **settings).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.explode("picks").alias("__pick")).distinct()
    named = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64(F.col("text").cast("string"))})
    same = [named["__id"].eqNullSafe(picked["__id"]), named["__hash"] == picked["__hash"]]
    joined = named.join(picked, same).withColumns({"__shard": F.col("__pick.shard"), "__place": F.col("__pick.place")})
    return joined.repartition("__shard").sortWithinPartitions("__shard", "__place").select(*[named[c] for c in docs.columns])
