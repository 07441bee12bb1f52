"""BPE encoding and decoding through a table of distinct words.

1. Texts are split into words, block by block; a block keeps its distinct words and its documents become
   codes into them. Codes and words are written once to the shared folder.
2. The words of all blocks meet by word hash, where each distinct word is encoded once.
3. Ids go back to the blocks and are joined to the documents by position; an id-to-piece table decodes.

What is shuffled is distinct words per block and compressed codes, never (document, position, word) rows.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import pretokens, spans
from millrace.session import work_folder

BLOCK_CHARS = 24 << 20
SQUEEZE = pa.Codec("zstd", compression_level=9)
PARTS = "block long, part int, kind int, seq long, doc_id long, payload binary"
#: Kinds of rows, in the order in which a block needs them.
WORDS, IDS, CODES = 0, 1, 2
#: Codes, in bytes before packing, that one row holds; the joining worker holds the ids and decoded texts of one row at a time.
ROWS_BYTES = 1 << 20


def pack(*arrays):
    """Arrays of small non-negative integers as compressed byte planes."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, dtype="<u4")
        planes = a.view(np.uint8).reshape(-1, 4).T
        raw = b"".join(p.tobytes() for p in planes)
        squeezed = SQUEEZE.compress(raw, asbytes=True) if raw else b""
        out.append(np.array([len(a), len(squeezed)], dtype="<u4").tobytes() + squeezed)
    return b"".join(out)


def unpack(payload):
    at, out = 0, []
    while at < len(payload):
        n, size = np.frombuffer(payload, "<u4", 2, at).tolist()
        at += 8
        raw = pa.decompress(payload[at:at + size], 4 * n, codec="zstd", asbytes=True) if n else b""
        out.append(np.frombuffer(raw, np.uint8).reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64))
        at += size
    return out


def _pack_words(words):
    raw = [w.encode() for w in words]
    joined = b"".join(raw)
    return len(joined).to_bytes(8, "little") + pack(np.array([len(w) for w in raw])) \
        + (SQUEEZE.compress(joined, asbytes=True) if joined else b"")


def _unpack_words(payload):
    total, n, size = int.from_bytes(payload[:8], "little"), *np.frombuffer(payload, "<u4", 2, 8).tolist()
    lengths = unpack(payload[8:16 + size])[0]
    joined = pa.decompress(payload[16 + size:], total, codec="zstd", asbytes=True) if total else b""
    ends = np.cumsum(lengths)
    return [joined[a:b].decode() for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)], n


def _batch(rows):
    columns = list(zip(*rows, strict=True))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      [c.split()[0] for c in PARTS.split(", ")])


class _Block:
    """Distinct words and coded documents of some texts."""

    def __init__(self):
        self.index, self.docs, self.chars = {}, [], 0

    def add(self, ids, words, chars):
        index = self.index
        place = np.fromiter((index.setdefault(w, len(index)) for w in words.distinct), np.int64, len(words.distinct))
        codes = place[words.codes] if len(words.codes) else words.codes
        self.docs += [(d, codes[words.first[i]:words.first[i + 1]].astype(np.int32)) for i, d in enumerate(ids)]
        self.chars += chars

    def rows(self, block, parts):
        words = list(self.index)
        counts = np.zeros(len(words), np.int64)
        for _, codes in self.docs:
            np.add.at(counts, codes, 1) if len(codes) < 64 else counts.__iadd__(np.bincount(codes, minlength=len(words)))
        # Words lie by part, frequent ones first, so that a part's words need no codes beside them.
        part = np.fromiter((zlib.crc32(w.encode()) % parts for w in words), np.int64, len(words))
        order = np.lexsort((-counts, part))
        # Documents are coded by descending frequency over the block; the first row says which word that is.
        by_count = np.argsort(-counts, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[by_count] = np.arange(len(words))
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        for p in range(parts):
            own = order[edges[p]:edges[p + 1]]
            if len(own):
                yield _batch([(block, p, WORDS, 0, None, len(own).to_bytes(4, "little") + pack(rank[own]) +
                               _pack_words([words[i] for i in own]))])
        held, rows, size = [], [], 0
        for seq, (doc_id, codes) in enumerate(self.docs):
            held.append((seq, doc_id, rank[codes] if len(codes) else codes))
            size += len(codes) * 4
            if size > ROWS_BYTES or seq == len(self.docs) - 1:
                lengths = np.array([len(c) for _, _, c in held])
                ids = np.array([-1 if d is None else d for _, d, _ in held], np.int64).tobytes()
                nulls = bytes(d is None for _, d, _ in held)
                body = len(held).to_bytes(4, "little") + ids + nulls + pack(lengths, np.concatenate([c for *_, c in held]))
                rows.append((block, -1, CODES, seq, None, body))
                held, size = [], 0
        for row in rows:
            yield _batch([row])


def _split(batches, path, kind, parts):
    from pyspark import TaskContext

    task, number, block = TaskContext.get().partitionId(), 0, _Block()
    for rows, strings in spans.chunks(batches):
        words = pretokens.split(strings, path, kind)
        block.add(rows.column("doc_id").to_pylist(), words, sum(map(len, filter(None, strings))))
        if block.chars >= BLOCK_CHARS:
            yield from block.rows((task << 24) | number, parts)
            number, block = number + 1, _Block()
    if block.docs:
        yield from block.rows((task << 24) | number, parts)


#: Distinct words of a part that one task remembers between blocks; beyond them a word is encoded again.
REMEMBERED = 400_000


def _encode(batches, path):
    known = {}
    for batch in batches:
        for block, part, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "payload")), strict=True):
            head = 4 + 8 + int.from_bytes(payload[8:12], "little")
            rank = unpack(payload[4:head])[0]
            words, _ = _unpack_words(payload[head:])
            new = [w for w in words if w not in known]
            fresh = dict(zip(new, pretokens.encode_words(new, path), strict=True))
            if len(known) + len(fresh) > REMEMBERED:
                known = {w: known[w] for w in words if w in known}
            known.update((w, np.array(i, np.int32).tobytes()) for w, i in fresh.items())
            ids = [known[w] for w in words]
            lengths = np.array([len(x) // 4 for x in ids])
            yield _batch([(block, part, IDS, 0, None, pack(rank, lengths, np.frombuffer(b"".join(ids), np.int32)))])


def pieces_of(path):
    """The id-to-piece table of a tokenizer without a decoder: as many entries as its vocabulary."""
    tokenizer = pretokens.load(path)
    size = max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1
    return [tokenizer.id_to_token(i) or "" for i in range(size)]


def _join(batches, path, decode):
    pieces = pieces_of(path) if decode else None
    current, ranks, lengths, flat, table = None, [], [], [], None
    for batch in batches:
        for block, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "payload")), strict=True):
            if block != current:
                current, ranks, lengths, flat, table = block, [], [], [], None
            if kind == IDS:
                r, n, f = unpack(payload)
                ranks.append(r), lengths.append(n), flat.append(f)
                continue
            if table is None:
                table = _word_table(ranks, lengths, flat, pieces)
                ranks, lengths, flat = [], [], []
            yield from _documents(payload, *table)


def _word_table(ranks, lengths, flat, pieces):
    """Ids of the block's words by rank: where they start, how many, all of them; and their decoded texts."""
    if not ranks:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), None if pieces is None else []
    ranks, lengths, flat = np.concatenate(ranks), np.concatenate(lengths), np.concatenate(flat)
    starts = np.cumsum(lengths) - lengths
    at, n = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
    at[ranks], n[ranks] = starts, lengths
    texts = None
    if pieces is not None:
        names = [pieces[i] for i in flat.tolist()]
        texts = [" ".join(names[a:a + m]) for a, m in zip(at.tolist(), n.tolist(), strict=True)]
    return at, n, flat, texts


def _documents(payload, at, n, flat, texts):
    count = int.from_bytes(payload[:4], "little")
    doc_ids = np.frombuffer(payload, "<i8", count, 4)
    nulls = np.frombuffer(payload, np.uint8, count, 4 + 8 * count).astype(bool)
    sizes, codes = unpack(payload[4 + 9 * count:])
    first = np.concatenate(([0], np.cumsum(sizes)))
    ids, ends = pretokens.expand(codes, at, n, flat)
    bounds = ends[first].astype(np.int32)
    columns = [pa.array(doc_ids, pa.int64(), mask=nulls), pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))]
    names = ["doc_id", "ids"]
    if texts is not None:
        own = codes.tolist()
        columns.append(pa.array([" ".join([texts[c] for c in own[a:b]]) for a, b in
                                 zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.string()))
        names.append("decoded")
    yield pa.RecordBatch.from_arrays(columns, names)


def encode(docs: DataFrame, path: str, decode: bool = False, kind: str = "clip") -> DataFrame:
    """``doc_id, ids`` (and ``decoded``) of every whole text of ``docs``, equal to what the tokenizers library
    gives without added special tokens; strings of special tokens in a text become their ids, as there.

    ``decoded`` is the library's ``decode(ids, skip_special_tokens=False)`` for a tokenizer without a decoder:
    pieces joined by one space. ``path`` names a file that every executor has.

    One row comes out per row of ``docs``: null and empty texts have no ids and decode to the empty text; repeated rows and
    null ids stay apart; other columns are ignored; an empty table gives an empty result. Memory is bounded by a
    block of ``BLOCK_CHARS`` characters or one longer text. The split is written to the folder of
    ``spark.checkpoint.dir``, so later steps and lost executors read it again rather than repeat it.
    """
    spark = docs.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    folder = work_folder(spark, "bpe-words")
    rows.mapInArrow(lambda b: _split(b, path, kind, parts), PARTS).write.option("compression", "uncompressed").parquet(folder)
    split = spark.read.schema(PARTS).parquet(folder)
    words = split.filter(F.col("kind") == WORDS).repartition(parts, "part")
    ids = words.mapInArrow(lambda b: _encode(b, path), PARTS)
    met = split.filter(F.col("kind") == CODES).union(ids)
    joined = met.repartition(parts, "block").sortWithinPartitions("block", "kind", "seq")
    schema = "doc_id long, ids array<int>" + (", decoded string" if decode else "")
    return joined.mapInArrow(lambda b: _join(b, path, decode), schema)
