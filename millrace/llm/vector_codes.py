"""Vector code compression: product codes learned and assigned in whole numbers through value dictionaries.

A block of vectors is kept as, for every dimension, a dictionary of its distinct integers and the rows' places in it. To
compare a block with a codebook, the squared differences of each dictionary's integers to all entries are tabulated
once; the distances of a part are then gathers from these tables by the rows' places, added up.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import vectors as V
from millrace.operators.bounds import broadcast_if_small
from millrace.session import work_folder

#: Integers are held within this on either side (components within 65,536 at a factor of 1024), so that distances of up to
#: 512 dimensions fit 64 bits.
MOST = 1 << 26
#: Rows whose distances to all entries a task holds at a time.
ROWS = 512

_BLOCK = "vec_id array<long>, label array<{}>, dims int, sizes binary, words binary, places binary"


def part_edges(dims, parts):
    """Bounds of the parts: consecutive, equal where ``parts`` divides ``dims``."""
    return [dims * p // parts for p in range(parts + 1)]


def _dictionaries(batches, factor):
    for ids, labels, x in V.pieces(batches, factor, MOST):
        words, places = [], np.empty(x.shape[::-1], np.uint32)
        for d in range(x.shape[1]):
            own, places[d] = np.unique(x[:, d], return_inverse=True)
            words.append(own.astype(np.int32))
        small = places.astype(np.uint16) if x.shape[0] <= 1 << 16 else places
        yield pa.RecordBatch.from_arrays(
            [V.as_list(ids), V.as_list(labels), pa.array([x.shape[1]], pa.int32()),
             pa.array([np.array([len(w) for w in words], np.int32).tobytes()]),
             pa.array([b"".join(w.tobytes() for w in words)]), pa.array([small.tobytes()])],
            ["vec_id", "label", "dims", "sizes", "words", "places"])


class Block:
    """Some rows: ``words[d]`` are the distinct integers of dimension ``d``, ``places[d]`` the rows' places in them."""

    def __init__(self, n, dims, sizes, words, places):
        self.n, self.dims = n, dims
        ends = np.cumsum(np.frombuffer(sizes, np.int32))
        self.words = np.split(np.frombuffer(words, np.int32).astype(np.int64), ends[:-1]) if dims else []
        kind = np.uint16 if n <= 1 << 16 else np.uint32
        self.places = np.frombuffer(places, kind).reshape(dims, n)

    def assign(self, entries, first):
        """Nearest of ``entries`` (integers, one row each) to the rows' part that begins at dimension ``first``: (index, the
        lower of equals; squared distance)."""
        width = entries.shape[1]
        code, error = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        if not width:
            return code, error
        words = self.words[first:first + width]  # each in ascending order
        furthest = max(int(max(w[-1] - e.min(), e.max() - w[0])) for w, e in zip(words, entries.T, strict=True))
        kind = np.int32 if furthest * furthest * width < 1 << 31 else np.int64
        tables = [np.square(w.astype(kind)[:, None] - e.astype(kind)) for w, e in zip(words, entries.T, strict=True)]
        for at in range(0, self.n, ROWS):
            rows = slice(at, at + ROWS)
            total = tables[0][self.places[first][rows]]
            for j in range(1, width):
                total += tables[j].take(self.places[first + j][rows], axis=0)
            code[rows] = total.argmin(axis=1)
            error[rows] = total[np.arange(len(total)), code[rows]]
        return code, error

    def sums(self, code, size, first, width):
        """Row counts and component sums of the rows given each code."""
        total = np.zeros((size, width), np.int64)
        for j in range(width):
            value = self.words[first + j][self.places[first + j]].astype(np.float64)
            total[:, j] = np.bincount(code, value, size).astype(np.int64)  # below 2 ** 53, so exact
        return np.bincount(code, minlength=size), total


def _blocks(batches):
    for batch in batches:
        for i, row in enumerate(batch.select(["dims", "sizes", "words", "places"]).to_pylist()):
            ids, labels = batch.column("vec_id")[i].values, batch.column("label")[i].values
            yield ids, labels, Block(len(ids), row["dims"], row["sizes"], row["words"], row["places"])


def _partial_sums(batches, books, edges):
    """Per part and entry, the number of a task's rows nearest to it and the sums of their components."""
    counts = [np.zeros(len(b), np.int64) for b in books]
    sums = [np.zeros(b.shape, np.int64) for b in books]
    for _, _, block in _blocks(batches):
        if block.dims == edges[-1]:
            for p, book in enumerate(books):
                code, _ = block.assign(book, edges[p])
                n, total = block.sums(code, len(book), edges[p], book.shape[1])
                counts[p] += n
                sums[p] += total
    for p, book in enumerate(books):
        used = np.flatnonzero(counts[p])
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used]),
                 pa.array(sums[p][used].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])


def _coded(batches, books, edges):
    digits = np.array([f"{i:02x}" for i in range(256)])
    for ids, labels, block in _blocks(batches):
        if block.dims == edges[-1]:
            found = [block.assign(book, edges[p]) for p, book in enumerate(books)]
            text = digits[found[0][0]].astype(object)
            for code, _ in found[1:]:
                text = text + digits[code]
            code, error = pa.array(text, pa.string()), pa.array(sum(e for _, e in found))
        else:
            code, error = pa.nulls(len(ids), pa.string()), pa.nulls(len(ids), pa.int64())
        yield pa.RecordBatch.from_arrays([ids, labels, code, error], ["vec_id", "label", "code", "error"])


class Codebooks:
    """Entries of each part, as integers. ``text`` lists them by part, entry and place."""

    def __init__(self, books, edges):
        self.books, self.edges = books, edges

    @property
    def text(self):
        return ",".join(str(v) for book in self.books for entry in book.tolist() for v in entry)


def _fitted(spark, blocks, start, parts, rounds):
    edges = part_edges(start.shape[1], parts)
    books = [start[:, a:b].copy() for a, b in zip(edges, edges[1:])]
    width = max(b.shape[1] for b in books)
    for _ in range(rounds):
        partial = blocks.mapInArrow(lambda b, now=books: _partial_sums(b, now, edges),
                                    "part int, entry int, n long, sums array<long>")
        total = partial.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width)]).alias("sums"))
        books = [b.copy() for b in books]
        for row in total.collect():  # at most parts * 256 rows of a part's width
            book = books[row["part"]]
            book[row["entry"]] = [s // row["n"] for s in row["sums"][:book.shape[1]]]
    return Codebooks(books, edges)


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, factor: int = 1024, label=None):
    """(``vec_id, label, code, error`` of every usable row, :class:`Codebooks`) of ``vectors`` (``vec_id``, ``embedding``).

    Components become ``floor(factor * x)``. A vector is cut into ``parts`` consecutive parts. The codebook of a part begins
    as that part of the ``entries`` smallest ids (at most 256); ``rounds`` times each part goes to its nearest entry, ties to
    the lower one, and each entry becomes the floor of its parts' mean, unused entries staying. All arithmetic is in whole
    numbers, so reruns agree however the rows are dealt. ``code`` has two hex digits a part, ``error`` is the squared
    distance over all parts.

    Rows whose vector is null or holds null or non-finite components go. The dimension is that of the smallest id; rows of
    another one come back with a null code and error. Null ids count as largest; repeated ids and rows are rows of their own;
    other columns are ignored. Integers are held within 2 ** 26 on either side. An empty table gives no rows and no
    codebooks. ``label`` names a column to carry along.

    The blocks and the coded rows are written to the folder of ``spark.checkpoint.dir``. A task sums its rows by part and
    entry before the shuffle; the driver holds the codebooks alone, whose size does not follow the table's.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits")
    spark = vectors.sparkSession
    rows = V.finite(vectors, label)
    kind = rows.schema["label"].dataType
    start = V.smallest(rows, entries)
    coded = f"vec_id long, label {kind.simpleString()}, code string, error long"
    if not start:
        return spark.createDataFrame([], coded), Codebooks([], [0])
    folder = work_folder(spark, "vector-codes")
    schema = _BLOCK.format(kind.simpleString())
    rows.mapInArrow(lambda b: _dictionaries(b, factor), schema).write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema(schema).parquet(f"{folder}/blocks")
    model = _fitted(spark, blocks, V.integers(start, factor, MOST), parts, rounds)
    books, edges = model.books, model.edges
    blocks.mapInArrow(lambda b: _coded(b, books, edges), coded).write.parquet(f"{folder}/coded")
    return spark.read.schema(coded).parquet(f"{folder}/coded"), model


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` rows with ``label_error``: ``error`` summed over the rows of an equal label, nulls together. Sums are
    combined before the shuffle, and broadcast only if measured small; else adaptive execution splits a hot label."""
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(broadcast_if_small(sums), F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")


def digest(model: Codebooks) -> str:
    return hashlib.sha256(model.text.encode()).hexdigest()
