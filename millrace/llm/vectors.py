"""Tables of vectors as blocks: some rows' ids and, of one dimension, their components as integers."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Components that a block holds at most; a longer vector is a block of its own.
BLOCK_COMPONENTS = 1 << 18


def finite(vectors: DataFrame, label=None) -> DataFrame:
    """``vec_id, label, vector`` of the rows whose vector is there and has finite components only; ``label`` names a column,
    or is null for all rows."""
    as_doubles = F.col("embedding").cast(T.ArrayType(T.DoubleType()))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          (F.col(label) if label else F.lit(None).cast("int")).alias("label"), as_doubles.alias("vector"))
    return rows.filter(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def smallest(rows: DataFrame, n: int) -> list:
    """Vectors of the ``n`` smallest ids of ``finite`` rows that have the first one's dimension; null ids come last, rows of
    one id by their components."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    first = rows.orderBy(*order).select("vector").first()
    if first is None:
        return []
    same = rows.filter(F.size("vector") == len(first["vector"]))
    return [r["vector"] for r in same.orderBy(*order).limit(n).select("vector").collect()]


def integers(components, factor, most):
    """``floor(factor * component)``, held within ``most`` on either side."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(factor * np.asarray(components, np.float64)), -most, most).astype(np.int64)


def pieces(batches, factor, most):
    """(ids, labels, integers) of runs of rows of one dimension."""
    for batch in batches:
        vectors = batch.column("vector")
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        for dims in np.unique(lengths).tolist():
            of_dims = np.flatnonzero(lengths == dims)
            step = max(1, BLOCK_COMPONENTS // max(dims, 1))
            for at in range(0, len(of_dims), step):
                own = of_dims[at:at + step]
                x = integers(flat[starts[own][:, None] + np.arange(dims)], factor, most)
                yield batch.column("vec_id").take(pa.array(own)), batch.column("label").take(pa.array(own)), x


def as_list(values):
    """An Arrow array as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
