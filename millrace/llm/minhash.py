"""MinHash near-duplicates by bottom-k sketches from one hash function.

A document's sketch is the ``KEPT`` smallest hashes of its shingle set; a set of no more is its own sketch. Inverted lists
tell for every retained value which sketches hold it. Two sketches of a link share at least ``needed`` values, so each
meets its partners in the lists of its rarest shared values, all but ``needed - 1`` of them; one that shares fewer
values than it needs has no partner and leaves. In a list the most central sketch is compared with the others; what is
by then in one component needs no more pairs, so a group of copies costs about its size, and lists that stay mixed are
worked through in blocks. A pair's overlap within the sketch of its union estimates its similarity and filters; whole
sets decide.
"""

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import spans
from millrace.llm.components import components
from millrace.llm.near_duplicates import name_of, sets
from millrace.session import work_folder

WORDS = 4
#: Links have at least ``PART / WHOLE`` of their union in common.
PART, WHOLE = 80, 100
#: Values in a sketch.
KEPT = 64
#: Chance at most that the estimate rejects a link of exactly that similarity whose sets are larger than a sketch.
MISSED = 1e-7
#: Pairs of one set that a task compares at a time.
SLICE_PAIRS = 512
#: Chosen sets (three numbers each) up to which the choice of texts to read is broadcast; beyond it is a shuffled join.
BROADCAST_ROWS = 1_000_000
#: Shingles that a block of a family holds, about; one set is never cut.
BLOCK_SHINGLES = 1 << 17

_U = np.uint64


@functools.cache
def least_shared():
    """Largest number of shared values that a sketch of the union of two linked sets has but with the chance ``MISSED``."""
    p, chance = PART / WHOLE, 0.0
    for shared in range(KEPT + 1):
        chance += math.comb(KEPT, shared) * p ** shared * (1 - p) ** (KEPT - shared)
        if chance > MISSED:
            return shared
    return KEPT


def needed(n):
    """Values that the sketch of a set of ``n`` shingles shares with that of any set it links to: exact as long as its
    largest partner is its own sketch."""
    whole = -(-PART * n // WHOLE)
    return whole if n * WHOLE <= KEPT * PART else min(whole, least_shared())


def estimate(a, b, na, nb):
    """Whether two sketches (ascending) leave room for a link: exact if both are whole sets, else by the values shared
    within the sketch of the union."""
    union = np.union1d(a, b)
    if na <= KEPT and nb <= KEPT:
        return WHOLE * (na + nb - len(union)) >= PART * len(union)
    both = np.intersect1d(a, b, assume_unique=True)
    return np.count_nonzero(both <= union[:KEPT][-1]) >= least_shared()


def linked(a, b):
    """Whether two whole sets (ascending) link."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = np.count_nonzero(a[at] == b)
    return WHOLE * both >= PART * (len(a) + len(b) - both)


SETS = "doc_id long, n int, h long, sketch binary"


def _describe(batches):
    """Sizes, names and sketches; of equal sets among a task's rows the first ones carry the sketch."""
    seen = set()
    for rows, strings in spans.chunks(batches):
        ids, out = rows.column("doc_id"), []
        for own, known in zip(sets(strings, WORDS), ids.is_valid().to_pylist(), strict=True):
            h = name_of(own)
            sketch = None
            if len(own) and known and h not in seen:
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(h)
                sketch = own[:KEPT].tobytes()
            out.append((len(own), h, sketch))
        n, h, sketch = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int32()), pa.array(h, pa.int64()), pa.array(sketch, pa.binary())],
                                         ["doc_id", "n", "h", "sketch"])


def _values(batches):
    for batch in batches:
        sketches = batch.column("sketch")
        sizes = sketches.value_lengths().to_numpy() if hasattr(sketches, "value_lengths") else \
            np.array([len(s) for s in sketches.to_pylist()])
        counts = sizes // 8
        flat = np.frombuffer(b"".join(sketches.to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(flat), pa.array(np.repeat(batch.column("h").to_numpy(), counts)),
             pa.array(np.repeat(batch.column("n").to_numpy(), counts))], ["v", "h", "n"])


def _compare(batches):
    """Pairs of a centre (kind 0) and the sketches beside it (kind 1) that the estimate lets pass."""
    key, centre = None, None
    for batch in batches:
        found = []
        for a, part, kind, b, n, sketch in zip(*(batch.column(c).to_pylist() for c in ("a", "slice", "kind", "b", "n", "sketch")),
                                               strict=True):
            own = np.frombuffer(sketch, _U)
            if kind == 0:
                key, centre = (a, part), (own, n)
            elif key == (a, part) and estimate(*_paired(centre, (own, n))):
                found.append((a, b, centre[1] <= KEPT and n <= KEPT))
        if found:
            a, b, sure = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure)], ["a", "b", "sure"])


def _paired(x, y):
    return x[0], y[0], x[1], y[1]


PAIRS = "a long, b long, sure boolean"


def _wholes(batches):
    """Whole sets of the chosen texts."""
    for batch in batches:
        for h, n, text in zip(*(batch.column(c).to_pylist() for c in ("h", "n", "text")), strict=True):
            own = sets([text], WORDS)[0]
            if name_of(own) == h:  # not another text under the same id
                yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([n], pa.int32()), pa.array([own.tobytes()])], ["h", "n", "whole"])


def _within(batches):
    """Links between a block of a family (kind 0) and all of the family (kind 1), of different components. Shared values are
    counted by inverting the block's sketches; whole sets decide on pairs that the estimate lets pass."""
    key, held, index = None, [], None
    for batch in batches:
        found = []
        for family, part, kind, h, component, whole in zip(
                *(batch.column(c).to_pylist() for c in ("family", "slice", "kind", "h", "component", "whole")), strict=True):
            if (family, part) != key:
                key, held, index = (family, part), [], None
            own = np.frombuffer(whole, _U)
            if kind == 0:
                held.append((h, component, own))
                continue
            if index is None:
                sketches = [x[2][:KEPT] for x in held]
                values = np.concatenate(sketches)
                order = np.argsort(values, kind="stable")
                index = values[order], np.repeat(np.arange(len(held)), [len(x) for x in sketches])[order]
                sizes, places = np.array([len(x[2]) for x in held]), np.array([x[1] for x in held])
            n, sketch = len(own), own[:KEPT]
            lo, hi = np.searchsorted(index[0], sketch, "left"), np.searchsorted(index[0], sketch, "right")
            met = np.concatenate([index[1][i:j] for i, j in zip(lo, hi, strict=True)])
            shared = np.bincount(met, minlength=len(held))
            fit = (np.maximum(sizes, n) * PART <= np.minimum(sizes, n) * WHOLE) & (places != component) & (shared >= needed(n))
            for i in np.flatnonzero(fit):
                other = held[i][2]
                if estimate(other[:KEPT], sketch, len(other), n) and linked(other, own):
                    found.append((min(h, held[i][0]), max(h, held[i][0])))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])


def _verify(batches):
    """Links among a set (kind 0) and those beside it (kind 1), by their whole sets."""
    key, centre = None, None
    for batch in batches:
        found = []
        for a, part, kind, h, text in zip(*(batch.column(c).to_pylist() for c in ("a", "slice", "kind", "h", "text")), strict=True):
            if kind == 0 and (a, part) == key:
                continue
            own = sets([text], WORDS)[0]
            if name_of(own) != h:
                continue  # another text under the same id
            if kind == 0:
                key, centre = (a, part), own
            elif (a, part) == key:
                if linked(centre, own):
                    found.append((a, h))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])


class _Run:
    """One run: its folder, tables and links. Sets are known by their 64-bit names ``h``."""

    def __init__(self, docs):
        self.spark = docs.sparkSession
        self.folder = work_folder(self.spark, "minhash")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.count = 0
        self.links = None

    def kept(self, df, name):
        self.count += 1
        path = f"{self.folder}/{self.count:02d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def texts(self, chosen):
        """The documents at the ids (``doc``) of chosen sets. Few chosen ones are broadcast, so that texts are not shuffled."""
        few = chosen.count() <= BROADCAST_ROWS
        return self.docs.join(F.broadcast(chosen) if few else chosen, F.col("doc_id") == F.col("doc"))

    def dealt(self, pairs):
        """``a, slice, kind, h`` of pairs ``a, b``: centres (kind 0) beside their partners, a centre of many in slices."""
        slices = pairs.groupBy("a").agg(F.ceil(F.count("*") / SLICE_PAIRS).cast("int").alias("slices"))
        rows = pairs.join(slices, "a").select("a", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int").alias("slice"), "b")
        centres = rows.select("a", "slice").distinct()
        return rows.select("a", "slice", F.lit(1).alias("kind"), F.col("b").alias("h")).unionByName(
            centres.select("a", "slice", F.lit(0).alias("kind"), F.col("a").alias("h")))

    def in_order(self, rows):
        return rows.repartition(self.parts, "a", "slice").sortWithinPartitions("a", "slice", "kind")

    def compare(self, pairs):
        """Verify candidate pairs (``a, b``) that their estimate lets pass."""
        pairs = self.kept(pairs.distinct(), "pairs")
        met = self.dealt(pairs).join(self.sketches, "h").select("a", "slice", "kind", F.col("h").alias("b"), "n", "sketch")
        self.verify(self.kept(self.in_order(met).mapInArrow(_compare, PAIRS), "estimated"))

    def verify(self, estimated):
        """Keep the links among pairs that passed the estimate: sure ones, whose sketches were whole sets, and those that their
        texts confirm."""
        rows = self.dealt(estimated.filter("NOT sure").select("a", "b").distinct())
        chosen = self.kept(rows.select("h").distinct().join(self.nodes.select("h", "doc"), "h"), "chosen")
        texts = self.texts(chosen).select("h", "text")
        met = rows.join(texts, "h").select("a", "slice", "kind", "h", "text")
        confirmed = self.in_order(met).mapInArrow(_verify, "a long, b long").distinct()
        self.add(estimated.filter("sure").select("a", "b").union(confirmed))

    def lists(self, described):
        """``list, size, h, n`` of the inverted lists in which sketches meet: the lists of a sketch's rarest shared values.
        Lists of the same sketches are one."""
        whole = described.filter(F.col("sketch").isNotNull())
        values = whole.select("h", "n", "sketch").mapInArrow(_values, "v long, h long, n int")
        for again in range(2):  # sketches that leave make more values single
            # At first a set that two tasks have described counts twice; that only keeps a value that no other set has.
            shared = values.groupBy("v").agg(F.count("*").alias("size")).filter("size > 1")
            # A set, for tasks may have described the same set; the sizes only order the lists.
            own = F.array_sort(F.collect_set(F.struct("size", "v"))).alias("own")
            ranked = values.join(shared.hint("merge"), "v").groupBy("h", "n").agg(own)
            ranked = ranked.withColumn("need", _needed(F.col("n"))).filter(F.size("own") >= F.col("need"))
            if not again:
                values = self.kept(ranked.select("h", "n", F.explode("own.v").alias("v")), "shared")
        first = F.slice("own", F.lit(1), F.size("own") - F.col("need") + 1)
        rows = self.kept(ranked.select("h", "n", F.explode(first.getField("v")).alias("v")), "rarest")
        each = rows.groupBy("v").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("h")).alias("list")).filter("size > 1")
        return self.kept(rows.join(each, "v").select("list", "size", "h", "n").distinct(), "lists")

    def star(self, members):
        """Compare the most central sketch of each list with the others."""
        centre = members.groupBy("list", "size").agg(F.max(F.struct("weight", "h", "n")).alias("top"))
        centre = centre.select("list", "size", F.col("top.h").alias("a"), F.col("top.n").alias("na"))
        pairs = members.join(centre, ["list", "size"]).filter(_sizes_fit("na", "n") & (F.col("a") != F.col("h")))
        self.compare(pairs.select("a", F.col("h").alias("b")))

    def mixed(self, members):
        """Members of the lists whose sketches are not yet all in one component, with their component."""
        placed = members.join(self.classes, F.col("h") == F.col("node"), "left").drop("node")
        placed = placed.withColumn("component", F.coalesce("component", "h"))
        ends = placed.groupBy("list", "size").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        ends = ends.filter("lo <> hi").select("list", "size")
        return self.kept(placed.join(ends, ["list", "size"], "left_semi"), "mixed")

    def rest(self, members):
        """All pairs of different components within the lists that are still mixed. These make up families, whose sets outside
        the largest component are dealt to blocks and visited by the family."""
        # Lists of one most central sketch are one family, so that its pairs meet once, not in every list that they share.
        centre = members.groupBy("list", "size").agg(F.max(F.struct("weight", "h")).getField("h").alias("family"))
        family = self.kept(members.join(centre, ["list", "size"]).select("family", "h", "n", "component").distinct(), "families")
        shares = family.groupBy("family", "component").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
        top = shares.groupBy("family").agg(F.max(F.struct("c", "component", "n")).alias("top"), F.sum("n").alias("all"))
        blocks = F.ceil((F.col("all") - F.col("top.n")) / BLOCK_SHINGLES).cast("int")
        placed = family.join(top.select("family", F.col("top.component").alias("most"), blocks.alias("slices")), "family")
        placed = placed.filter("slices > 0")
        own = placed.filter("component <> most").select(
            "family", F.pmod(F.xxhash64("h"), F.col("slices")).cast("int").alias("slice"), F.lit(0).alias("kind"), "h", "component")
        visits = placed.select(
            "family", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(1).alias("kind"), "h", "component")
        chosen = self.kept(family.select("h", "n").distinct().join(self.nodes.select("h", "doc"), "h"), "chosen")
        texts = self.texts(chosen).select("h", "n", "text")
        wholes = self.kept(texts.mapInArrow(_wholes, "h long, n int, whole binary"), "wholes").dropDuplicates(["h"])
        rows = own.unionByName(visits.join(own.select("family", "slice").distinct(), ["family", "slice"], "left_semi"))
        rows = rows.join(wholes.select("h", "whole"), "h").select("family", "slice", "kind", "h", "component", "whole")
        met = rows.repartition(self.parts, "family", "slice").sortWithinPartitions("family", "slice", "kind")
        self.add(met.mapInArrow(_within, "a long, b long").distinct())

    def add(self, links):
        """Take in links, and find the components anew."""
        found = self.kept(links, "links")
        self.links = found if self.links is None else self.links.union(found)
        self.count += 1
        self.classes = components(self.links, f"{self.folder}/{self.count:02d}-components")

    def run(self):
        described = self.kept(self.docs.mapInArrow(_describe, SETS), "sets")
        full = described.filter("n > 0 AND doc_id IS NOT NULL")
        self.nodes = self.kept(full.groupBy("h").agg(F.min("doc_id").alias("doc")), "nodes")
        members = self.lists(described)
        weights = members.groupBy("h").agg(F.sum("size").alias("weight"))
        members = self.kept(members.join(weights, "h"), "members")
        wanted = members.select("h").distinct()
        sketches = described.filter(F.col("sketch").isNotNull()).join(wanted, "h", "left_semi")
        self.sketches = self.kept(sketches.select("h", "n", "sketch").dropDuplicates(["h"]), "sketches")
        self.star(members)
        members = self.mixed(members)
        if not members.isEmpty():
            self.rest(members)
        placed = self.nodes.join(self.classes, F.col("h") == F.col("node"), "left").select(
            "h", "doc", F.coalesce("component", "h").alias("component"))
        least = placed.groupBy("component").agg(F.min("doc").alias("least"))
        named = placed.join(least, "component").select(F.col("h").alias("of"), "least")
        known = (F.col("n") > 0) & F.col("doc_id").isNotNull()
        component = F.when(known, F.col("least")).otherwise(F.col("doc_id"))
        return described.drop("sketch").join(named, F.col("h") == F.col("of"), "left").select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _needed(n):
    """:func:`needed` of a column."""
    whole = F.ceil(F.lit(PART) * n / WHOLE).cast("int")
    return F.when(n * WHOLE <= KEPT * PART, whole).otherwise(F.least(whole, F.lit(least_shared())))


def _sizes_fit(a, b):
    return F.greatest(a, b) * PART <= F.least(a, b) * WHOLE


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id``, ``text``).

    A document's set is its distinct shingles of four words, A-Z in lower case; with fewer words the whole sequence is
    one shingle. Two documents link when ``100 * intersection >= 80 * union`` of their whole sets (of 64-bit shingle hashes);
    ``component_id`` is the smallest id that links reach and ``kept`` marks the document with that id. Every link stated is
    true. Between sets of up to 51 shingles none is missed; of larger ones a link at the very limit is missed with a chance
    of at most 1e-7, nearer copies with less.

    A null text or one without words has an empty set, links with nothing and is its own component; so is each row
    without an id, whose component is null and which is kept. Repeated rows share their component; rows that share an id
    but not the text are nodes of their own. Other columns are ignored; an empty table gives an empty result.
    Intermediate tables are written to the folder of ``spark.checkpoint.dir``.
    """
    return _Run(docs).run()
