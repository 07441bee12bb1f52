"""Token ids as directly addressable codes.

An id is cut into chunks of 8 bits. Level 0 holds the lowest chunk of every id, level 1 the next chunk of those
ids that need it, and so on; a continuation bitmap beside each level says which ids go on, and a rank directory
(set bits before every 512th) finds their place in the next level. So any id is read by a few small reads.

File (little-endian): ``DAC1``, then uint64 counts of documents, ids and levels; int64 document ids; uint64 places
of the documents' first ids (one more at the end); per level a uint64 count, its chunks, its bitmap (in whole
64-bit words), its directory (uint64).
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import pretokens, shared_files, spans
from millrace.session import work_folder

MAGIC = b"DAC1"
RANK_BITS = 512
#: Ids that a file holds before the next begins; a longer document is one file.
FILE_IDS = 4 << 20
NO_ID = np.iinfo(np.int64).min
MANIFEST = "task long, number long, file string, n_docs long, n_ids long"


def _bitmap(flags):
    raw = np.packbits(flags, bitorder="little").tobytes()
    return raw + bytes(-len(raw) % 8)


def encode_ids(doc_ids, first, ids):
    """The bytes of a file of some documents; a document id of None is written as the smallest long."""
    levels, rest = [], np.asarray(ids)
    if rest.dtype != np.uint32:
        rest = rest.astype(np.uint64)
    while True:
        more = rest > 0xFF
        blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64) if len(more) else more
        set_bits = np.concatenate(([0], np.cumsum(blocks)))[:len(rest) // RANK_BITS + 1]
        # A cast to bytes keeps the lowest chunk.
        levels.append([len(rest), rest.astype(np.uint8).tobytes(), _bitmap(more), set_bits.astype("<u8").tobytes()])
        rest = rest[more] >> rest.dtype.type(8)
        if not len(rest):
            break
    names = np.array([NO_ID if d is None else d for d in doc_ids], dtype="<i8")
    out = [MAGIC, np.array([len(names), len(ids), len(levels)], "<u8").tobytes(), names.tobytes(),
           np.asarray(first, "<u8").tobytes()]
    for n, *parts in levels:
        out += [np.array([n], "<u8").tobytes(), *parts]
    return b"".join(out)


class Reader:
    """Random access to a file by small reads; ``source`` has ``seek`` and ``read``."""

    def __init__(self, source):
        self.source = source
        head = self._read(0, 28)
        if head[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.n_docs, self.n_ids, n_levels = np.frombuffer(head, "<u8", 3, 4).astype(np.int64).tolist()
        self.levels, at = [], 28 + 16 * self.n_docs + 8
        for _ in range(n_levels):
            n = int(np.frombuffer(self._read(at, 8), "<u8")[0])
            bitmap = at + 8 + n
            directory = bitmap + (n + 63) // 64 * 8
            self.levels.append((n, at + 8, bitmap, directory))
            at = directory + 8 * (n // RANK_BITS + 1)

    def _read(self, at, size):
        self.source.seek(at)
        return self.source.read(size)

    def documents(self):
        """Document ids (None where null) and the places of their first ids, one more at the end."""
        names = np.frombuffer(self._read(28, 8 * self.n_docs), "<i8")
        first = np.frombuffer(self._read(28 + 8 * self.n_docs, 8 * self.n_docs + 8), "<u8").astype(np.int64)
        return [None if d == NO_ID else d for d in names.tolist()], first

    def _rank(self, level, place):
        """Set bits of a level's bitmap before ``place``."""
        _, _, bitmap, directory = self.levels[level]
        block = place // RANK_BITS
        before = int(np.frombuffer(self._read(directory + 8 * block, 8), "<u8")[0])
        first = bitmap + block * RANK_BITS // 8
        bits = np.unpackbits(np.frombuffer(self._read(first, (place % RANK_BITS + 7) // 8), np.uint8), bitorder="little")
        return before + int(bits[:place % RANK_BITS].sum())

    def token(self, place):
        """The id at ``place``, which touches one chunk, one bit and one directory entry per level."""
        value = 0
        for level, (_, chunks, bitmap, _) in enumerate(self.levels):
            value |= self._read(chunks + place, 1)[0] << (8 * level)
            if not self._read(bitmap + place // 8, 1)[0] >> (place % 8) & 1:
                break
            place = self._rank(level, place)
        return value

    def tokens(self, start, stop):
        """The ids from ``start`` up to ``stop``; reads that range of each level only."""
        if start >= stop:
            return np.empty(0, np.uint64)
        values, live, a, b = np.zeros(stop - start, np.uint64), np.arange(stop - start), start, stop
        for level, (_, chunks, bitmap, _) in enumerate(self.levels):
            values[live] |= np.frombuffer(self._read(chunks + a, b - a), np.uint8).astype(np.uint64) << np.uint64(8 * level)
            bits = np.unpackbits(np.frombuffer(self._read(bitmap + a // 8, (b + 7) // 8 - a // 8), np.uint8), bitorder="little")
            live = live[bits[a % 8:a % 8 + b - a].astype(bool)]
            if not len(live):
                break
            a = self._rank(level, a)
            b = a + len(live)
        return values


def _write(batches, folder, path, kind, end_id):
    from pyspark import TaskContext

    task, number, files = TaskContext.get().partitionId(), 0, None
    held, count = [], 0

    def flush():
        nonlocal files, held, count, number
        files = files or shared_files.Files(folder, ".dac")
        names = [d for ids, *_ in held for d in ids]
        sizes = np.concatenate([n for _, n, _ in held])
        first = np.concatenate(([0], np.cumsum(sizes)))
        file = files.write(encode_ids(names, first, np.concatenate([x for *_, x in held])))
        row = pa.RecordBatch.from_pydict({"task": [task], "number": [number], "file": [file], "n_docs": [len(names)],
                                          "n_ids": [int(first[-1])]})
        held, count, number = [], 0, number + 1
        return row

    for rows, strings in spans.chunks(batches):
        ids, bounds = pretokens.encode_texts(strings, path, kind)
        ended = np.insert(ids.astype(np.uint32), bounds[1:], end_id)  # one end id behind each text
        if count and count + len(ended) > FILE_IDS:
            yield flush()
        held.append((rows.column("doc_id").to_pylist(), np.diff(bounds) + 1, ended))
        count += len(ended)
    if held:
        yield flush()


def write_tokens(docs: DataFrame, folder: str, path: str, kind: str = "gpt", end_id: int = 0) -> DataFrame:
    """Encode every whole text of ``docs``, end each with ``end_id``, write files to ``folder`` in ascending order of
    ``doc_id`` and return their manifest: ``task, number, file, n_docs, n_ids, start`` (ids in all files before).

    Texts are dealt and sorted by ranges of ``doc_id`` before they are encoded, so ids are never shuffled. A null text
    is empty: only its end id is written. A null ``doc_id`` comes first; rows with one id are ordered by a hash of
    their text; repeated rows are each written. Other columns are ignored; an empty table writes nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = f"{folder}/manifest"
    dealt.mapInArrow(lambda b: _write(b, folder, path, kind, end_id), MANIFEST).write.parquet(manifest)
    files = spark.read.schema(MANIFEST).parquet(manifest)
    # One window over a row per writing task, then one per task over its files.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = files.groupBy("task").agg(F.sum("n_ids").alias("all")).select("task", F.sum("all").over(before).alias("base"))
    within = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce("base", F.lit(0)) + F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return files.join(tasks, "task").withColumn("start", start).select(*files.columns, "start")


def _read(batches, folder):
    for batch in batches:
        for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
            with shared_files.open_file(folder, name) as source:
                reader = Reader(source)
                doc_ids, first = reader.documents()
                step = 512
                for i in range(0, len(doc_ids), step):
                    bounds = first[i:i + step + 1]
                    ids = reader.tokens(int(bounds[0]), int(bounds[-1])).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[i:i + step], pa.int64()), pa.array(start + bounds[:-1], pa.int64()),
                         pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)), pa.array(ids))],
                        ["doc_id", "start", "ids"])


def _spread(manifest):
    # A manifest is small, and without a number adaptive execution would give all its files to one task.
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file", "start").repartition(parts, "file")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files of a manifest; ``start`` counts all ids before it."""
    return _spread(manifest).mapInArrow(lambda b: _read(b, folder), "doc_id long, start long, ids array<long>")


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what :func:`read_tokens` reads: the unsigned crc32 of the ids as uint32."""
    def crc(batches):
        for batch in _read(batches, folder):
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            bounds = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))))
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"),
                                              pa.array(np.diff(bounds), pa.int64()), pa.array(sums, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _spread(manifest).mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark):
    return work_folder(spark, "token-codes")
