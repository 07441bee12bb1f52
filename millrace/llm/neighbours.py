"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by fast Hadamard pseudo-rotations (three rounds of random signs and a Hadamard
transform) and files each under its nearest signed axis; as the number of rows grows, further rotations refine the
bucket, so that it keeps its size. A query looks into the buckets of its nearest axes in every table; all vectors found
there are ranked by their exact distance. A query that finds too few looks on through all rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from millrace.session import work_folder

#: Vectors that a task compares a query with at a time; larger buckets are dealt to slices of about this size.
SLICE_ROWS = 4096
#: Rows of a bucket that the geometry aims at, about.
BUCKET_ROWS = 128
#: Buckets of more than one slice up to which their sizes are broadcast (24 bytes each); beyond it is a shuffled join.
BROADCAST_BUCKETS = 100_000
#: Numbers that a block of queries holds while their buckets are ranked.
BLOCK_COSTS = 1 << 22
KEY = ["dim", "bucket", "slice"]


def hadamard(x):
    """Normalised Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, -1, 2, step)
        x = np.concatenate((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def rotate(x, seed):
    """Pseudo-rotation of unit rows, padded to a power of two."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    signs = np.random.Generator(np.random.PCG64(seed)).choice([-1.0, 1.0], (3, width))
    for s in signs:
        x = hadamard(x * s)
    return x


def geometry(width, rows):
    """Coordinates that each rotation of a table names a signed axis of: all of the first one's, then as many as buckets
    of about ``BUCKET_ROWS`` of ``rows`` rows need."""
    sizes, buckets = [width], 2 * width
    while buckets * BUCKET_ROWS < rows:
        size = 1
        while size < width and buckets * 2 * size * BUCKET_ROWS < rows:
            size *= 2
        sizes.append(size)
        buckets *= 2 * size
    return sizes


def probes_for(sizes, probed):
    """Buckets that a query reads in a table: ``probed`` of one rotation's, growing with the root of the number of buckets, so
    that the share of rows compared falls with that root."""
    buckets = float(np.prod([2.0 * s for s in sizes]))
    return int(np.ceil(probed * np.sqrt(buckets / (2 * sizes[0]))))


def axis_costs(x, size, seed):
    """For each row the squared distance lost by taking each signed axis of ``size`` coordinates instead of the nearest."""
    turned = rotate(x, seed)[:, :size]
    signed = np.concatenate((turned, -turned), axis=1)
    return 2 * (signed.max(axis=1, keepdims=True) - signed)


def probes(x, table, sizes, n, seed):
    """The ``n`` best buckets of each row in a table, best first; a bucket names one signed axis for each rotation."""
    codes, costs = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for a, size in enumerate(sizes):
        own = axis_costs(x, size, [seed, table, a])
        keep = min(n, own.shape[1])
        best = own.argmin(axis=1)[:, None] if keep == 1 else np.argsort(own, axis=1, kind="stable")[:, :keep]
        costs = (costs[:, :, None] + np.take_along_axis(own, best, 1)[:, None, :]).reshape(len(x), -1)
        codes = (codes[:, :, None] * own.shape[1] + best[:, None, :]).reshape(len(x), -1)
        order = np.argsort(costs, axis=1, kind="stable")[:, :n]
        costs, codes = np.take_along_axis(costs, order, 1), np.take_along_axis(codes, order, 1)
    return codes


def _groups(batch):
    """Rows of a batch by dimension: (their numbers, their vectors, these scaled to length 1)."""
    vectors = batch.column("vector")
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        x = flat[starts[rows][:, None] + np.arange(dim)]
        scaled = x / np.abs(x).max(axis=1, keepdims=True).astype(np.float64)
        yield rows, x, scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _filed(batches, tables, total, probed, seed):
    """Each row with its bucket of each table, or (``probed``) with all that it reads there."""
    for batch in batches:
        for rows, x, unit in _groups(batch):
            sizes = geometry(1 << max(0, x.shape[1] - 1).bit_length(), total)
            n = probes_for(sizes, probed) if probed else 1
            step = max(1, BLOCK_COSTS // (n * 2 * sizes[0]))
            for low in range(0, len(rows), step):
                some = slice(low, low + step)
                found = [probes(unit[some], table, sizes, n, seed) * tables + table for table in range(tables)]
                yield _packed(batch, rows[some], x[some], np.concatenate(found, axis=1))


def _as_one(batches):
    """Each row in the one bucket of its dimension."""
    for batch in batches:
        for rows, x, _ in _groups(batch):
            yield _packed(batch, rows, x, np.zeros((len(rows), 1), np.int64))


FILED = "dim int, vec_id long, of long, vector binary, buckets array<long>"


def _packed(batch, rows, x, codes):
    own = batch.take(pa.array(rows))
    places = np.arange(len(rows) + 1, dtype=np.int32) * codes.shape[1]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(rows), x.shape[1], np.int32)), own.column("vec_id"), own.column("of"),
         pa.array([v.tobytes() for v in np.ascontiguousarray(x)], pa.binary()),
         pa.ListArray.from_arrays(pa.array(places), pa.array(codes.ravel()))], ["dim", "vec_id", "of", "vector", "buckets"])


def _nearest(batches, k, kind_of):
    """Best ``k`` of the vectors of a slice for each query of its bucket; vectors come before queries."""
    key, held, ids, matrix, single = None, {}, None, None, True
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*KEY, "kind", "vec_id", "of", "vector")]
        out = []
        for dim, bucket, part, kind, vec_id, of, vector in zip(*columns, strict=True):
            if (dim, bucket, part) != key:
                key, held, ids, matrix = (dim, bucket, part), {}, None, None
            if kind == 0:
                held[vec_id, of] = vector
                continue
            if matrix is None:
                ids = np.array([i for i, _ in held], np.int64)
                matrix = np.frombuffer(b"".join(held.values()), kind_of).reshape(len(held), dim).astype(np.float64)
                single, held = len(np.unique(ids)) == len(ids), {}
            gap = matrix - np.frombuffer(vector, kind_of).astype(np.float64)
            score = np.sqrt((gap * gap).sum(axis=1))
            other = np.flatnonzero(ids != vec_id)
            if single and len(other) > k:
                other = other[score[other] <= np.partition(score[other], k - 1)[k - 1]]
            best = other[np.lexsort((ids[other], score[other]))]
            # Of rows of one id, which may be several, the nearest counts.
            first = np.sort(np.unique(ids[best], return_index=True)[1])[:k] if len(best) else best
            out += [(vec_id, of, int(ids[i]), float(score[i])) for i in best[first]]
        if out:
            q, o, i, s = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(o, pa.int64()), pa.array(i, pa.int64()),
                                              pa.array(s, pa.float64())], ["query_id", "of", "vec_id", "score"])


FOUND = "query_id long, of long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector, of`` (a hash of the vector) of the vectors that take part. Single precision stays so on the way."""
    kind = vectors.schema["embedding"].dataType
    element = kind.elementType if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else T.DoubleType()
    one = F.col("embedding").cast(T.ArrayType(element))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), one.alias("vector")).filter("vec_id IS NOT NULL")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    taken = rows.filter(finite & F.exists("vector", lambda v: v != 0))
    return taken.withColumn("of", F.xxhash64("vector"))


def _met(filed, visits, large, few, k, kind_of):
    """Distances of queries and rows that share a bucket. ``large`` tells the slices of buckets of more than one."""
    large = F.broadcast(large) if few else large

    def sliced(rows):
        return rows.join(large, ["dim", "bucket"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))

    slice_of = F.pmod(F.xxhash64("vec_id", "of"), F.col("slices")).cast("int")
    columns = ["vec_id", "of", "vector"]
    held = sliced(filed).select("dim", "bucket", slice_of.alias("slice"), F.lit(0).alias("kind"), *columns)
    asked = sliced(visits).select(
        "dim", "bucket", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(1).alias("kind"), *columns)
    parts = int(filed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.unionByName(asked).repartition(parts, *KEY).sortWithinPartitions(*KEY, "kind")
    return dealt.mapInArrow(lambda b: _nearest(b, k, kind_of), FOUND)


def nearest(vectors: DataFrame, queries, k: int = 10, tables: int = 16, probed: int = 8, seed: int = 29) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row of ``vectors`` (``vec_id``, ``embedding``) that
    the condition ``queries`` (on ``vec_id``) names, by Euclidean distance in double precision, ties to the smaller id.

    Every row is filed in every table, under as many signed axes as buckets of about ``BUCKET_ROWS`` need (:func:`geometry`);
    a query reads ``probed`` buckets of each table, more as buckets get finer (:func:`probes_for`). A query that finds fewer
    than ``k`` so is compared with every row of its dimension, in slices; it gets all candidates if these are fewer.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an id. A
    query never finds its own id. Equal rows count once; of several vectors of one id the nearest counts, and each
    is a query of its own. Vectors meet those of their own dimension only. Other columns are ignored; an empty table
    gives an empty result.

    A bucket of any size is dealt to slices by id; its queries visit them all, and a task holds one slice. Rows are counted,
    and their buckets and what these give are written to the folder of ``spark.checkpoint.dir``, when this is called.
    """
    spark = vectors.sparkSession
    folder = work_folder(spark, "neighbours")
    rows = usable(vectors)
    kind_of = np.float32 if isinstance(rows.schema["vector"].dataType.elementType, T.FloatType) else np.float64
    total = rows.count()

    def kept(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    def found_in(filed, visits, name):
        filed = kept(filed, f"{name}-filed").withColumn("bucket", F.explode("buckets"))
        visits = visits.withColumn("bucket", F.explode("buckets"))
        slices = F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("slices")
        large = kept(filed.groupBy("dim", "bucket").agg(slices).filter("slices > 1"), f"{name}-large")
        return kept(_met(filed, visits, large, large.count() <= BROADCAST_BUCKETS, k, kind_of), name)

    asked = rows.filter(queries).dropDuplicates(["vec_id", "of"])
    found = found_in(rows.mapInArrow(lambda b: _filed(b, tables, total, 0, seed), FILED),
                     asked.mapInArrow(lambda b: _filed(b, tables, total, probed, seed), FILED), "buckets")
    enough = found.groupBy("query_id", "of").agg(F.countDistinct("vec_id").alias("met")).filter(F.col("met") >= k)
    short = kept(asked.join(enough.withColumnRenamed("query_id", "vec_id"), ["vec_id", "of"], "left_anti"), "short")
    if not short.isEmpty():
        dims = F.broadcast(short.select(F.size("vector").alias("dims")).distinct()) if short.count() <= BROADCAST_BUCKETS else \
            short.select(F.size("vector").alias("dims")).distinct()
        same = rows.join(dims, F.size("vector") == F.col("dims"), "left_semi")
        found = found.unionByName(found_in(same.mapInArrow(_as_one, FILED), short.mapInArrow(_as_one, FILED), "rest"))
    once = found.groupBy("query_id", "of", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id", "of").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
