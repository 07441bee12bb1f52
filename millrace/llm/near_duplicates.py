"""Exact n-gram Jaccard self-join by universe partition, and its classes.

Sets of similar size form a band. For a band, the universe of shingles is cut into ``m`` segments by hash, more
than two linked sets can differ in, so that two linked sets agree on some whole segments (pigeonhole); the hash of
a segment's subset is a signature, and only sets that share one are candidates. Sets of a few shingles take every
shingle as a segment of its own.

Costs decide what a signature is used for. A segment that is empty or whose bucket stays large and mixed is
skipped. A set that skips more than the spare segments allow also takes the one-deletion neighbourhoods of the others, and
opens its cheapest skipped buckets again if even that leaves a gap. Candidates are verified on their whole texts.

Sets that are equal are one node. Links inside a bucket are looked for from its most central members first, and
members that are by then in one component need no further pairs; so a group of copies costs about its size.
Candidates whose sketches, and then parities of one to two bits a shingle, differ in more bits than linked sets can in
shingles are not verified.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import spans
from millrace.llm.components import components
from millrace.llm.names import apart
from millrace.session import work_folder

WORDS = 5
#: Links have at least ``PART / WHOLE`` of their union in common.
PART, WHOLE = 80, 100
#: Bands that end below this many shingles take single shingles as segments.
SINGLES_TO = 76
BAND_RATIO = 1.4
#: Members of a bucket that are paired with each other without regard to cost.
SMALL_BUCKET = 32
#: Bits of a signature; subsets that share one by chance are candidates the more. The zeros above shrink in a shuffle.
SIGN_BITS = 48
#: Pairs of one set that a task verifies at a time.
SLICE_PAIRS = 256
#: Shingles of the sets whose parities a block of a family holds, about; one set is never cut.
BLOCK_SHINGLES = 1 << 21
#: Longs up to which the choice of texts to read is broadcast (24 MB); beyond it is a shuffled join.
BROADCAST_LONGS = 3_000_000

_U = np.uint64


def sets(strings, words=WORDS):
    """Sorted distinct shingle hashes of each text, A-Z in lower case; a text of fewer words is one shingle."""
    texts = spans.Texts(strings)
    upper = (texts.data >= 65) & (texts.data <= 90)
    texts.data = np.where(upper, texts.data | 32, texts.data).astype(np.uint8)
    starts, ends, text = texts.words()
    hashes = spans.SpanHasher.of_bytes(texts.data)(starts, ends)
    runs, at = spans.windows(hashes, text, words)
    bounds = np.searchsorted(text[at], np.arange(texts.n + 1))
    places = np.searchsorted(text, np.arange(texts.n + 1))
    out = []
    for i in range(texts.n):
        own = runs[bounds[i]:bounds[i + 1]]
        if not len(own) and places[i] < places[i + 1]:
            few = hashes[places[i]:places[i + 1]]
            own = spans.windows(few, np.zeros(len(few), np.int64), len(few))[0] ^ _U(len(few))
        out.append(np.unique(own))
    return out


def name_of(own):
    """64-bit hash of a set; with the set's size it names a node."""
    return int(spans.mix(np.array([spans.mix(own).sum(dtype=_U) + _U(len(own))]))[0].astype(np.int64)) if len(own) else 0


@functools.cache
def bands():
    """Least sizes of the bands, from the smallest sets that may link to an unequal one (4 shingles)."""
    edges = [4]
    while edges[-1] < 1 << 62:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
    return np.array(edges, dtype=np.int64)


def largest_partner(n):
    """Largest size that a set of ``n`` shingles may link to."""
    return n * WHOLE // PART


def segments(band):
    """(segments, spare ones) of a band of the smaller sets; 0 segments: every shingle is one."""
    top = int(bands()[band + 1]) - 1
    if top < SINGLES_TO:
        return 0, 0
    # A pair differs in at most (l + u) * (1 - s) / (1 + s) shingles.
    differ = (top + largest_partner(top)) * (WHOLE - PART) // (WHOLE + PART)
    spare = 3 + -(-(differ + 1) * 12 // 100)
    return differ + 1 + spare, spare


def most_different(n, band, low):
    """Most shingles in which a set may differ from one that it links to in a band; ``low``: the band below its own."""
    partner = int(bands()[band + 1]) - 1 if low else largest_partner(n)
    return (n + partner) * (WHOLE - PART) // (WHOLE + PART)


def families(n):
    """Bands that a set takes part in: its own, and the one below if its smaller partners may lie there."""
    if n < 4:
        return []
    band = int(np.searchsorted(bands(), n, side="right")) - 1
    below = band > 0 and n <= largest_partner(int(bands()[band]) - 1)
    return [(band, False)] + ([(band - 1, True)] if below else [])


def subsets(own, band):
    """(segment of each shingle, mixed shingles, signature of each segment, whether it is empty) of a set."""
    m, _ = segments(band)
    mixed = spans.mix(own + _U((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    if m == 0:
        return np.arange(len(own)), mixed, mixed >> _U(64 - SIGN_BITS), np.zeros(len(own), bool)
    place = ((mixed >> _U(32)) % _U(m)).astype(np.int64)
    # Sums modulo 2 ** 64 by halves, which doubles hold exactly.
    halves = [np.bincount(place, (mixed >> _U(s) & _U(0xFFFFFFFF)).astype(float), m).astype(_U) for s in (0, 32)]
    total = halves[0] + (halves[1] << _U(32))
    return place, mixed, _sign(total, np.arange(m), band), np.bincount(place, minlength=m) == 0


def _sign(total, place, band):
    """Signatures of subsets of ``total``: a set's segments never share one, so that a skipped one is a segment."""
    m = segments(band)[0]
    hashed = spans.mix(total + place.astype(_U) * _U(0xD6E8FEB86659FD93) + _U(band * 0xA24BAED4963EE407 % (1 << 64)))
    return hashed % _U((1 << SIGN_BITS) // m) * _U(m) + place.astype(_U)


SKETCH = [f"s{i}" for i in range(8)]
SETS = ("doc_id long, n int, h long, m_own int, spare_own int, empty_own int, m_low int, spare_low int, empty_low int, "
        + ", ".join(f"{s} long" for s in SKETCH) + ", bits binary")


def sketch(own):
    """Parity of the number of shingles in each of 512 parts: two sketches differ in no more bits than their sets in shingles."""
    part = (spans.mix(own + _U(0x165667B19E3779F9)) >> _U(55)).astype(np.int64)
    return np.packbits(np.bincount(part, minlength=512) & 1).view(np.int64).tolist()


def sizes_fit(a="a", b="b"):
    """Whether sizes (``n`` under the prefixes) leave room for a link."""
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    return F.greatest(na, nb) * PART <= F.least(na, nb) * WHOLE


def may_link(a="a", b="b"):
    """Whether sizes and sketches (``n``, ``sk`` under the prefixes) leave room for a link; false only where there is none."""
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    bits = sum(F.bit_count(F.col(f"sk{a}")[s].bitwiseXOR(F.col(f"sk{b}")[s])) for s in SKETCH)
    return sizes_fit(a, b) & (bits * (WHOLE + PART) <= (na + nb) * (WHOLE - PART))


def _describe(batches):
    for rows, strings in spans.chunks(batches):
        out = []
        for own in sets(strings):
            facts = {False: (0, 0, 0), True: (0, 0, 0)}
            for band, low in families(len(own)):
                m, _ = segments(band)
                facts[low] = (m, m - 1 - most_different(len(own), band, low), int(subsets(own, band)[3].sum()))
                if m == 0:  # linked sets share PART / WHOLE of the larger at least
                    facts[low] = (len(own), -(-len(own) * PART // WHOLE) - 1, 0)
            out.append((len(own), name_of(own), *facts[False], *facts[True], *sketch(own), parities(own)))
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
             *(pa.array(c, pa.int32()) for c in columns[2:8]), *(pa.array(c, pa.int64()) for c in columns[8:-1]),
             pa.array(columns[-1], pa.binary())],
            [c.split()[0] for c in SETS.split(", ")])


#: Above its bits ``sig`` has ``LOW`` in the band below the set's own. Little else, for there are a few hundred rows a text.
SIGNATURES = "h long, sig long"
LOW = 1 << SIGN_BITS


def _signatures(batches):
    seen = set()
    for _, strings in spans.chunks(batches):
        parts = []
        for own in sets(strings):
            key = (name_of(own), len(own))
            if key in seen or not families(len(own)):
                continue
            if len(seen) >= 200_000:
                seen.clear()
            seen.add(key)  # copies among the task's rows would only repeat the signatures
            for band, low in families(len(own)):
                *_, signs, empty = subsets(own, band)
                parts.append((signs[~empty].astype(np.int64) + low * LOW, key[0]))
        if parts:
            sizes = [len(p[0]) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([p[1] for p in parts], sizes), pa.int64()), pa.array(np.concatenate([p[0] for p in parts]))], ["h", "sig"])


NEIGHBOURS = "sig long, kind int, doc long"


def _neighbourhoods(batches):
    """For each segment subset of a text that is not left out, its signature (kind 0) and those of its one-deletion
    neighbours (kind 1).

    Linked sets that differ in at most d of m segments' shingles, and skip all segments that are equal, have at least
    2 m - d - (segments the one leaves out) - (those the other does) segments that differ by one shingle and are left out by
    neither. So each set may leave out (2 m - d - 1) / 2 of them: the empty and skipped ones, then those of most shingles."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc", "n", "h", "lows", "skipped", "text")]
        for doc, n, h, lows, skipped, text in zip(*columns, strict=True):
            own = sets([text])[0]
            if (name_of(own), len(own)) != (h, n):
                continue
            for band, low in families(n):
                if low not in lows or segments(band)[0] == 0:
                    continue
                place, mixed, signs, empty = subsets(own, band)
                total = np.zeros(len(signs), _U)
                np.add.at(total, place, mixed)
                less = _sign(total[place] - mixed, place, band).astype(np.int64)
                shut = empty | np.isin(signs.astype(np.int64), np.array(skipped, np.int64))
                more = (2 * len(signs) - most_different(n, band, low) - 1) // 2 - int(shut.sum())
                if more > 0:
                    shut[np.argsort(np.where(shut, 1, -np.bincount(place, minlength=len(signs))), kind="stable")[:more]] = True
                fulls, less = signs[~shut].astype(np.int64), less[~shut[place]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((fulls, less))), pa.array(np.repeat([0, 1], [len(fulls), len(less)]), pa.int32()),
                     pa.array(np.full(len(fulls) + len(less), doc))], ["sig", "kind", "doc"])


def _verify(batches):
    """Linked pairs of a set (kind 0) with the sets beside it (kind 1)."""
    key, centre = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("a", "slice", "kind", "b", "n", "h", "text")]
        found = []
        for a, part, kind, b, n, h, text in zip(*columns, strict=True):
            if kind == 0 and (a, part) == key and centre is not None:
                continue
            own = sets([text])[0]
            if (len(own), name_of(own)) != (n, h):
                continue  # another text under the same id
            if kind == 0:
                key, centre = (a, part), own
            elif (a, part) == key and centre is not None:
                at = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
                both = int((centre[at] == own).sum())
                if WHOLE * both >= PART * (len(own) + len(centre) - both):
                    found.append((a, b))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])


def parities(own):
    """Parity of the number of shingles in each of a power of two of parts, one to two a shingle, packed; a set's parities
    over half as many parts are the two halves' exclusive or."""
    parts = 512
    while parts < len(own):
        parts *= 2
    part = (spans.mix(own + _U(0x27D4EB2F165667C5)) & _U(parts - 1)).astype(np.int64)
    return np.packbits(np.bincount(part, minlength=parts) & 1).tobytes()


def _near(batches):
    """Pairs of a set (kind 0) with the sets beside it (kind 1) that may link by sizes and parities."""
    key, block = None, None
    for batch in batches:
        found = []
        for a, part, kind, b, n, bits in zip(
                *(batch.column(c).to_pylist() for c in ("a", "slice", "kind", "b", "n", "bits")), strict=True):
            own = np.frombuffer(bits, _U)
            if kind == 0:
                key, block = (a, part), _Block([(a, a, n, own)])
            elif (a, part) == key and next(block.near(b, n, own), None) is not None:
                found.append((a, b))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])


class _Block:
    """Nodes of a block of a family, by the number of words of their parities."""

    def __init__(self, held):
        self.groups = {}
        by_words = {}
        for doc, component, n, bits in held:
            by_words.setdefault(len(bits), []).append((doc, component, n, bits))
        for words, rows in by_words.items():
            docs, components, sizes, bits = zip(*rows, strict=True)
            self.groups[words] = np.array(docs), np.array(components), np.array(sizes, np.int64), np.stack(bits)

    def near(self, component, n, bits):
        """Nodes of other components whose sizes and parities leave room for a link; others have none."""
        for words, (docs, components, sizes, held) in self.groups.items():
            if words == 2 * len(bits):
                held = held[:, :len(bits)] ^ held[:, len(bits):]
            mine = bits[:words] ^ bits[words:] if len(bits) == 2 * words else bits
            if held.shape[1] != len(mine):
                continue  # sizes too far apart for a link
            fit = np.flatnonzero((components != component) & (np.maximum(sizes, n) * PART <= np.minimum(sizes, n) * WHOLE))
            apart = np.bitwise_count(held[fit] ^ mine).sum(axis=1, dtype=np.int64)
            yield from docs[fit[apart * (WHOLE + PART) <= (sizes[fit] + n) * (WHOLE - PART)]].tolist()


def _within(batches):
    """Pairs between a block of a family (kind 0) and all of the family (kind 1), of different components, that may link by
    sizes and parities."""
    key, held, block = None, [], None
    for batch in batches:
        found = []
        for family, part, kind, doc, component, n, bits in zip(
                *(batch.column(c).to_pylist() for c in ("family", "slice", "kind", "doc", "component", "n", "bits")), strict=True):
            if (family, part) != key:
                key, held, block = (family, part), [], None
            own = np.frombuffer(bits, _U)
            if kind == 0:
                held.append((doc, component, n, own))
                continue
            block = block or _Block(held)
            found += [(min(doc, other), max(doc, other)) for other in block.near(component, n, own)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])


class _Join:
    """One run: its folder, tables and verified pairs."""

    def __init__(self, docs):
        self.spark = docs.sparkSession
        self.folder = work_folder(self.spark, "near-duplicates")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.count = 0
        self.tested = self.fresh = self.known = None

    def kept(self, df, name):
        self.count += 1
        path = f"{self.folder}/{self.count:02d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def texts(self, chosen):
        """``doc, n, h, text`` of the chosen nodes (``doc, n, h, at`` and more)."""
        longs = F.lit(len(chosen.columns) + 2) + (F.size("skipped") if "skipped" in chosen.columns else 0)
        few = (chosen.agg(F.sum(longs)).first()[0] or 0) <= BROADCAST_LONGS
        return self.docs.join(F.broadcast(chosen) if few else chosen, F.col("doc_id") == F.col("at")).drop("doc_id", "at")

    def parities(self, chosen):
        """``bits`` of the chosen nodes (``doc, n, h, at`` and more), once a row that holds the node's text under that id."""
        few = (chosen.agg(F.sum(F.lit(len(chosen.columns) + 2))).first()[0] or 0) <= BROADCAST_LONGS
        named = self.described.select("doc_id", F.col("n").alias("size"), F.col("h").alias("name"), "bits")
        same = (F.col("doc_id") == F.col("at")) & (F.col("name") == F.col("h")) & (F.col("size") == F.col("n"))
        return named.join(F.broadcast(chosen) if few else chosen, same).drop("doc_id", "size", "name", "at")

    def dealt(self, pairs):
        """Each pair's ``b`` (kind 1) and each ``a`` (kind 0) beside it, in slices of an ``a``'s pairs, with the nodes' columns."""
        slices = pairs.groupBy("a").agg(F.ceil(F.count("*") / SLICE_PAIRS).cast("int").alias("slices"))
        dealt = pairs.join(slices, "a").withColumn("slice", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int")).select("a", "slice", "b")
        centres = dealt.select("a", "slice").distinct().withColumns({"kind": F.lit(0), "b": F.col("a")})
        wanted = dealt.withColumn("kind", F.lit(1)).unionByName(centres)
        # Pairs go to the texts before the shuffle, which then moves each text once a slice.
        return self.kept(wanted.join(self.nodes.select(F.col("doc").alias("b"), "n", "h", "at"), "b"), "needed")

    def near(self, pairs):
        """The pairs that may link by their parities, which are a small part of the texts."""
        met = self.parities(self.dealt(pairs)).select("a", "slice", "kind", "b", "n", "bits")
        met = met.repartition(self.parts, "a", "slice").sortWithinPartitions("a", "slice", "kind")
        return self.kept(met.mapInArrow(_near, "a long, b long").distinct(), "near")

    def verify(self, pairs, near=False):
        """Verify candidate pairs (``a, b``) that were not tested before, and add the links found; ``near``: their parities
        have been compared."""
        pairs = pairs.filter(F.col("a") != F.col("b")).select("a", "b").distinct()
        if self.tested is not None:
            turned = self.tested.select(F.col("b").alias("a"), F.col("a").alias("b"))
            pairs = pairs.join(self.tested.union(turned), ["a", "b"], "left_anti")
        pairs = self.kept(pairs, "pairs")
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        if self.known is not None and pairs.isEmpty():
            return
        needed = self.dealt(pairs if near else self.near(pairs))
        met = self.texts(needed).select("a", "slice", "kind", "b", "n", "h", "text")
        met = met.repartition(self.parts, "a", "slice").sortWithinPartitions("a", "slice", "kind")
        found = self.kept(met.mapInArrow(_verify, "a long, b long").distinct(), "links")
        if self.known is None or not found.isEmpty():
            self.fresh = found if self.fresh is None else self.fresh.union(found)

    def classes(self):
        """Components of the links found so far."""
        if self.fresh is not None:
            # New links join the components known before, each of which is a star.
            edges = self.fresh if self.known is None else self.fresh.union(
                self.known.select(F.col("node").alias("a"), F.col("component").alias("b")))
            self.count += 1
            self.known, self.fresh = components(edges, f"{self.folder}/{self.count:02d}-components"), None
        return self.known

    def run(self):
        described = self.described = self.kept(self.docs.mapInArrow(_describe, SETS), "sets")
        whole = described.filter("n > 0 AND doc_id IS NOT NULL")
        facts = [c.split()[0] for c in SETS.split(", ")][3:-1]
        # A node goes by its set's name; ``at`` is the smallest id where its text stands.
        self.nodes = self.kept(whole.groupBy("h", "n").agg(
            F.min("doc_id").alias("at"), *[F.first(c).alias(c) for c in facts]).withColumn("doc", F.col("h")), "nodes")
        self.sketches = self.nodes.select("doc", "n", F.struct(*SKETCH).alias("sk"))
        members = self.members()
        weights = members.groupBy("doc").agg(F.sum(F.col("mult") * F.col("cnt")).alias("weight")).join(self.nodes.select("doc", "n"), "doc")
        members = self.kept(members.join(weights, "doc"), "members")
        self.star(members.withColumn("component", F.lit(None).cast("long")))
        open_ = self.open(members.filter("cnt > 2"))
        if not open_.isEmpty():
            self.star(open_)
            open_ = self.open(open_.drop("component"))
        if not open_.isEmpty():
            self.rest(open_)
        classes = self.classes()
        placed = self.nodes.select("h", "n", "at", "doc").join(classes, F.col("doc") == F.col("node"), "left").withColumn(
            "component", F.coalesce("component", "doc"))
        least = placed.groupBy("component").agg(F.min("at").alias("least"))
        named = placed.join(least, "component").select("h", "n", "least")
        return described.select("doc_id", "h", "n").join(named, ["h", "n"], "left").select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"),
            F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("least")).otherwise(
                F.col("doc_id")).alias("component_id"))

    def members(self):
        """``bucket, cnt, doc, low, mult`` of all buckets with two nodes or more. Small buckets with the same members
        are one, ``mult`` times; a large one stands for its signature alone."""
        signs = self.docs.filter("doc_id IS NOT NULL").mapInArrow(_signatures, SIGNATURES)
        once = signs.repartition(self.parts, F.col("sig") % LOW).select("h", (F.col("sig") % LOW).alias("sig"), (F.col("sig") >= LOW).alias("low"))
        whole = Window.partitionBy("sig")
        counted = once.dropDuplicates(["sig", "h", "low"]).withColumns(
            {"cnt": F.count("*").over(whole), "who": F.bit_xor(F.xxhash64("h")).over(whole)})
        shared = counted.filter("cnt > 1").withColumn(
            "bucket", F.when(F.col("cnt") > SMALL_BUCKET, F.col("sig")).otherwise(F.col("who")))
        rows = shared.groupBy("bucket", "cnt", "h", "low").agg(F.count("*").alias("mult"))
        return self.kept(rows, "buckets").withColumn("doc", F.col("h")).drop("h")

    def star(self, members):
        """Pair each bucket's most central member with all others. If components are known, the centre is the most
        central member outside the component of the most central one, and its own component needs no pairs."""
        best = F.struct("weight", "doc", "n", "component")
        first = members.groupBy("bucket", "cnt").agg(F.max(best).alias("top"))
        if not members.filter("component IS NOT NULL").isEmpty():
            other = members.join(first.select("bucket", "cnt", F.col("top.component").alias("known")), ["bucket", "cnt"])
            first = other.filter("component <> known").groupBy("bucket", "cnt").agg(F.max(best).alias("top"))
        centres = first.select("bucket", "cnt", F.col("top.doc").alias("a"), F.col("top.n").alias("na"),
                               F.col("top.component").alias("ca"))
        beside = members.select("bucket", "cnt", F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
        apart = F.col("cb").isNull() | (F.col("ca") != F.col("cb"))
        pairs = beside.join(centres, ["bucket", "cnt"]).filter(apart & sizes_fit() & (F.col("a") != F.col("b")))
        # Sketches are wider than pairs: they join a pair once, not its members in every bucket.
        for x in "ab":
            pairs = (pairs.select("a", "b").distinct() if x == "a" else pairs).join(self.sketches.select(
                F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("sk").alias(f"sk{x}")), x)
        self.verify(pairs.filter(may_link()))

    def open(self, members):
        """Members of the buckets whose members are not yet all in one component, with their component."""
        classes = self.classes()
        placed = members.join(classes, F.col("doc") == F.col("node"), "left").drop("node")
        placed = placed.withColumn("component", F.coalesce("component", "doc"))
        mixed = placed.groupBy("bucket", "cnt").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        mixed = mixed.filter("lo <> hi").select("bucket", "cnt")
        return self.kept(placed.join(mixed, ["bucket", "cnt"], "left_semi"), "open")

    def rest(self, members):
        """What the stars leave open: pairs of small buckets, and for large ones what the skipping rules demand."""
        def paired(probes, among):
            a = probes.select("bucket", "cnt", F.col("doc").alias("a"), F.col("n").alias("na"), F.col("sk").alias("ska"),
                              F.col("component").alias("ca"))
            b = among.select("bucket", "cnt", F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("sk").alias("skb"),
                             F.col("component").alias("cb"))
            both = a.join(b, ["bucket", "cnt"]).filter((F.col("ca") != F.col("cb")) & may_link())
            return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

        self.families(members.filter(F.col("cnt") <= SMALL_BUCKET))
        members = self.open(members.filter(F.col("cnt") > SMALL_BUCKET).drop("component"))
        large = members.join(self.sketches.drop("n"), "doc")
        pairs = self.spark.createDataFrame([], "a long, b long")
        if not large.isEmpty():
            facts = self.nodes.select("doc", "h", *[f"{f}_{k}" for f in ("m", "spare", "empty") for k in ("own", "low")])
            pick = lambda f: F.when(F.col("low"), F.col(f"{f}_low")).otherwise(F.col(f"{f}_own"))
            hot = large.join(facts, "doc").withColumns({f: pick(f) for f in ("m", "spare", "empty")})
            single = F.col("m") == F.col("n")  # never so in a band of segments, which are fewer than shingles
            # What a set may leave unopened: the spare ones; or what it may leave out of the deletions, if it takes them too.
            costly = Window.partitionBy("doc", "low").orderBy(F.col("cnt").desc(), "bucket")
            ranked = hot.withColumn("rank", F.row_number().over(costly) + F.col("empty"))
            most = F.when(single, F.col("spare")).otherwise(F.floor((F.col("m") + F.col("spare")) / 2))
            ranked = self.kept(ranked.withColumn("skipped", F.col("rank") <= most).withColumn("single", single), "ranked")
            pairs = pairs.union(paired(ranked.filter(~F.col("skipped")), large))
            # Sets of segments that skip more than the spare ones take the one-deletion neighbourhoods.
            over = ranked.filter(~F.col("single")).groupBy("doc", "low").agg(
                F.max("rank").alias("r"), F.first("spare").alias("s")).filter("r > s").select("doc", "low")
        else:
            over = None
        pairs = pairs.union(self.deletions(over, None if over is None else ranked))
        self.verify(pairs)

    def families(self, members):
        """All pairs of different components within small buckets that stay mixed. Buckets of one most central member are a
        family, so that its pairs meet once, not in every bucket that they share; its sets outside the largest component
        are dealt to blocks and visited by the family."""
        centre = members.groupBy("bucket", "cnt").agg(F.max(F.struct("weight", "doc")).getField("doc").alias("family"))
        family = self.kept(members.join(centre, ["bucket", "cnt"]).select("family", "doc", "n", "component").distinct(), "families")
        if family.isEmpty():
            return
        shares = family.groupBy("family", "component").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
        top = shares.groupBy("family").agg(F.max(F.struct("c", "component", "n")).alias("top"), F.sum("n").alias("all"))
        slices = F.ceil((F.col("all") - F.col("top.n")) / BLOCK_SHINGLES).cast("int")
        placed = family.join(top.select("family", F.col("top.component").alias("most"), slices.alias("slices")), "family").filter("slices > 0")
        own = placed.filter("component <> most").select(
            "family", F.pmod(F.xxhash64("doc"), F.col("slices")).cast("int").alias("slice"), F.lit(0).alias("kind"), "doc", "component")
        visits = placed.select(
            "family", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(1).alias("kind"), "doc", "component")
        visits = visits.join(own.select("family", "slice").distinct(), ["family", "slice"], "left_semi")
        chosen = self.kept(family.select("doc").distinct().join(self.nodes.select("doc", "n", "h", "at"), "doc"), "chosen")
        bits = self.parities(chosen).dropDuplicates(["doc"]).select("doc", "n", "bits")
        rows = own.unionByName(visits).join(bits, "doc").select("family", "slice", "kind", "doc", "component", "n", "bits")
        met = rows.repartition(self.parts, "family", "slice").sortWithinPartitions("family", "slice", "kind")
        pairs = self.kept(met.mapInArrow(_within, "a long, b long").distinct(), "near")
        if not pairs.isEmpty():
            self.verify(pairs, near=True)

    def deletions(self, over, ranked):
        """Candidates among the sets with more empty or skipped segments than spare ones, by a segment that is equal but
        for one shingle."""
        spared = self.nodes.select("doc", F.lit(False).alias("low"), F.col("m_own").alias("m"), F.col("spare_own").alias("s"),
                                   F.col("empty_own").alias("e"), "n")
        below = self.nodes.select("doc", F.lit(True).alias("low"), F.col("m_low").alias("m"), F.col("spare_low").alias("s"),
                                  F.col("empty_low").alias("e"), "n")
        sparse = spared.union(below).filter("e > s AND m <> n").select("doc", "low")
        warm = (sparse if over is None else sparse.union(over)).groupBy("doc").agg(F.collect_set("low").alias("lows"))
        # A set's skipped segments go with it: at most as many as it has shingles.
        if ranked is None:
            shut = warm.withColumn("skipped", F.array().cast("array<long>"))
        else:
            skips = ranked.filter("skipped AND NOT single").groupBy("doc").agg(F.collect_list("bucket").alias("skipped"))
            shut = warm.join(skips, "doc", "left").withColumn("skipped", F.coalesce("skipped", F.array().cast("array<long>")))
        chosen = self.kept(shut.join(self.nodes.select("doc", "n", "h", "at"), "doc"), "warm")
        near = self.texts(chosen).mapInArrow(_neighbourhoods, NEIGHBOURS)
        near = near.repartition(self.parts, "sig")
        # A signature is of use if a subset and a neighbour of another meet in it.
        kinds = Window.partitionBy("sig")
        met = near.withColumns({"lo": F.min("kind").over(kinds), "hi": F.max("kind").over(kinds)}).filter("lo <> hi")
        classes = self.classes()
        met = self.kept(met.select("sig", "kind", "doc"), "neighbours").join(self.sketches, "doc").join(
            classes, F.col("doc") == F.col("node"), "left").withColumn("component", F.coalesce("component", "doc"))

        def side(kind, x):
            return met.filter(F.col("kind") == kind).select(
                "sig", F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("sk").alias(f"sk{x}"), F.col("component").alias(f"c{x}"))

        both = side(0, "a").join(side(1, "b"), "sig").filter((F.col("ca") != F.col("cb")) & may_link())
        return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id``, ``text``).

    A document's set is its distinct shingles of five words, A-Z in lower case; with fewer words the whole sequence is
    one shingle. Two documents link when ``100 * intersection >= 80 * union``; ``component_id`` is the smallest id that
    links reach. The result is exact for every pair (sets are compared by 64-bit shingle hashes).

    A null text or one without words has an empty set, links with nothing and is its own component; so is each row
    without an id, whose component is null. Repeated rows share their component; rows that share an id but not the text are
    nodes of their own. Other columns are ignored; an empty table gives an empty result. Intermediate tables are
    written to the folder of ``spark.checkpoint.dir``.
    """
    return _Join(docs).run()


@apart
def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of its component; of equal ids one row
    stays. Rows without an id stay."""
    found = near_duplicates(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    named = docs.withColumn("__id", F.col("doc_id").cast("long"))
    nameless = named.filter("__id IS NULL").drop("__id")
    once = Window.partitionBy("__id").orderBy(F.xxhash64("text"), "text")
    kept = named.join(found, "__id").withColumn("__row", F.row_number().over(once)).filter("__row = 1")
    return kept.select(*docs.columns).unionByName(nameless.select(*docs.columns))
