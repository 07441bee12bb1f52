"""WARC files and a Merkle fixity audit of their replicas.

Records and ordered ranges of records are hashed into a tree per file, and the files' roots into one tree above. The
catalogue keeps each record's digest as it was written, and so has a tree of its own: a replica whose root equals its
root is sound, and two damaged ones cannot agree unnoticed. Else only branches that differ are descended, down to the records.
"""

import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import shared_files

#: Children of a tree node.
FANOUT = 16
#: Bytes after which a WARC file is closed; a longer record is a file of its own.
FILE_BYTES = 32 << 20
CATALOGUE = ("file_no long, file string, record long, page_id long, offset long, length long, n_bytes long, digest binary, "
             "last boolean")
LEAVES = "file_no long, node long, digest binary"
READ_BYTES = 4 << 20


def record(page_id, url, html, place=""):
    """One WARC resource record. A null url or page is written empty; the record id follows from the page's id and url and
    from the record's ``place``, so that repeated rows have ids of their own."""
    body = html if html is not None else b""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {place} {target}")
    head = (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Target-URI: {target}\r\n"
            "WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/html\r\n"
            f"Content-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


def _write(batches, folder):
    from pyspark import TaskContext

    files, task = shared_files.Files(folder, ".warc.gz"), TaskContext.get().partitionId()
    number, held, size, rows = 0, [], 0, []

    def flush():
        nonlocal number, held, size, rows
        name = files.write(b"".join(held))
        out = pa.RecordBatch.from_pylist(
            [{"file_no": (task << 32) | number, "file": name, **row, "last": i == len(rows) - 1} for i, row in enumerate(rows)],
            pa.schema([("file_no", pa.int64()), ("file", pa.string()), ("record", pa.int64()), ("page_id", pa.int64()),
                       ("offset", pa.int64()), ("length", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.binary()),
                       ("last", pa.bool_())]))
        number, held, size, rows = number + 1, [], 0, []
        return out

    for batch in batches:
        for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
            raw = record(page_id, url, html.encode() if html is not None else None, f"{task} {number} {len(rows)}")
            member = gzip.compress(raw, mtime=0)
            if held and size + len(member) > FILE_BYTES:
                yield flush()
            rows.append({"record": len(rows), "page_id": page_id, "offset": size, "length": len(member), "n_bytes": len(raw),
                         "digest": hashlib.sha256(member).digest()})
            held.append(member)
            size += len(member)
    if held:
        yield flush()


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as they come as WARC files, each record a gzip member, to ``folder``;
    return the catalogue of their records (``file_no, file, record, page_id, offset, length, n_bytes, digest, last``; ``n_bytes``
    before compression, ``digest`` the sha256 of the record's bytes in the file, ``last`` in its file), also written there.
    Nothing but the catalogue is shuffled.

    Every row is a record: repeated rows too, and null ids. Other columns are ignored; no pages give no files."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows.mapInArrow(lambda b: _write(b, folder), CATALOGUE).write.parquet(f"{folder}/written")
    spark = pages.sparkSession
    written = spark.read.schema(CATALOGUE).parquet(f"{folder}/written")
    # Files are numbered without gaps, for the tree above them: one row a file, few enough for one window.
    numbers = written.select("file_no").distinct().withColumn(
        "__no", F.row_number().over(Window.orderBy("file_no")).cast("long") - 1)
    catalogue = f"{folder}/catalogue"
    written.join(numbers, "file_no").withColumn("file_no", F.col("__no")).drop("__no").write.parquet(catalogue)
    return spark.read.schema(CATALOGUE).parquet(catalogue)


def _copy(batches, source, target):
    store, path = shared_files.open_folder(target)
    store.create_dir(path, recursive=True)
    name, opened, out, draft = None, None, None, None

    def finish():
        opened.close()
        out.close()
        store.move(draft, f"{path}/{name}")
        return pa.RecordBatch.from_pydict({"file": [name]})

    for batch in batches:
        for row in batch.to_pylist():
            if row["file"] != name:
                if name is not None:
                    yield finish()
                name = row["file"]
                draft = f"{path}/{name}.{uuid.uuid4().hex}"
                opened, out = shared_files.open_file(source, name), store.open_output_stream(draft, compression=None)
            raw = opened.read(row["length"])
            if row["harm"] and raw:
                at = len(raw) // 2
                raw = raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1:]
            out.write(raw)
    if name is not None:
        yield finish()


def copy_files(catalogue: DataFrame, source: str, target: str, harm=None) -> DataFrame:
    """Copy the catalogued files to the folder ``target`` under their names; return the names copied (``file``). A file
    takes its name when it is whole. ``harm`` (a condition on the catalogue) names records whose copy gets one bit
    changed, to try an audit."""
    wrong = F.coalesce(harm, F.lit(False)) if harm is not None else F.lit(False)
    rows = catalogue.select("file_no", "file", "record", "length", wrong.alias("harm"))
    dealt = rows.repartition("file").sortWithinPartitions("file", "record")
    dealt.mapInArrow(lambda b: _copy(b, source, target), "file string").write.parquet(f"{target}/copied")
    return catalogue.sparkSession.read.schema("file string").parquet(f"{target}/copied")


def _hash_records(batches, folder):
    def read(file, offset, length):
        digest = hashlib.sha256()
        file.seek(offset)
        while length is None or length:
            part = file.read(READ_BYTES if length is None else min(length, READ_BYTES))
            if not part:
                break
            digest.update(part)
            length = None if length is None else length - len(part)
        return digest.digest()

    for batch in batches:
        out, name, file = [], None, None
        for row in batch.to_pylist():
            if row["file"] != name or file is None:
                if file:
                    file.close()
                name, file = row["file"], None
                try:
                    file = shared_files.open_file(folder, name) if name else None
                except OSError:
                    file = None
            # The last record goes to the end of the file, so that surplus bytes show.
            digest = read(file, row["offset"], None if row["last"] else row["length"]) if file else b""
            out.append((row["file_no"], row["record"], digest))
        if file:
            file.close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["file_no", "node", "digest"])


def leaves(catalogue: DataFrame, folder: str) -> DataFrame:
    """``file_no, node, digest`` (sha256) of every catalogued range, read from a replica's folder in bounded pieces; the last
    one of a file to the file's end. What is missing is hashed as far as it is there; records of a missing file have the
    empty digest."""
    # A catalogue is small beside its files: without a number adaptive execution would give them to few tasks.
    parts = int(catalogue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = catalogue.select("file_no", "file", "record", "offset", "length", "last").repartitionByRange(parts, "file_no", "record")
    return spread.sortWithinPartitions("file_no", "record").mapInArrow(lambda b: _hash_records(b, folder), LEAVES)


def _parent(level, over_files):
    """Columns that name the node above: of a file's ranges, or of the runs of files once each file is one node."""
    if over_files:
        return [F.floor(F.col("file_no") / FANOUT).cast("long").alias("file_no"), F.lit(0).cast("long").alias("node")]
    return [F.col("file_no"), F.floor(F.col("node") / FANOUT).cast("long").alias("node")]


def _above(level, over_files):
    """The level above: a node's digest is the sha256 of its children's, in order (at most ``FANOUT`` of them)."""
    children = F.sort_array(F.collect_list(F.struct(level["file_no"], level["node"], level["digest"])))
    joined = F.concat_ws("", F.transform(children, lambda c: F.hex(c["digest"])))
    return level.groupBy(*_parent(level, over_files)).agg(F.unhex(F.sha2(joined, 256)).alias("digest"))


def tree(leaf_level: DataFrame, folder: str, records_per_file: int, n_files: int) -> list[DataFrame]:
    """Levels of a replica's tree, records first and the root last; each is written to ``folder`` once."""
    spark = leaf_level.sparkSession

    def kept(df, i):
        df.write.parquet(f"{folder}/level-{i}")
        return spark.read.schema(LEAVES).parquet(f"{folder}/level-{i}")

    levels = [kept(leaf_level, 0)]
    for over_files in _steps(records_per_file, n_files):
        levels.append(kept(_above(levels[-1], over_files).select("file_no", "node", "digest"), len(levels)))
    return levels


def _steps(records_per_file, n_files):
    """For each level above the records, whether it joins files."""
    steps = []
    for width, over_files in ((records_per_file, False), (n_files, True)):
        while width > 1:
            steps.append(over_files)
            width = -(-width // FANOUT)
    return steps


def audit(catalogue: DataFrame, first: str, second: str, folder: str) -> DataFrame:
    """The rows of the catalogue whose records are not in the replicas' folders ``first`` or ``second`` as they were written,
    with ``first_wrong`` and ``second_wrong``; empty if all roots agree.

    Trees are written under ``folder``, and what differs after each level, so a level's plan does not hold those above. A
    level is compared only below the nodes that differ above it. No catalogued records give an empty result.
    """
    spark = catalogue.sparkSession
    facts = catalogue.agg(F.max("record").alias("r"), F.max("file_no").alias("f")).first()
    if facts["r"] is None:
        return catalogue.withColumns({"first_wrong": F.lit(True), "second_wrong": F.lit(True)})
    per_file, n_files = facts["r"] + 1, facts["f"] + 1
    written = catalogue.select("file_no", F.col("record").alias("node"), "digest")
    truth = tree(written, f"{folder}/written", per_file, n_files)
    found = None
    for name, replica in (("first", first), ("second", second)):
        own = tree(leaves(catalogue, replica), f"{folder}/{name}", per_file, n_files)
        wrong = _descend(spark, truth, own, _steps(per_file, n_files), f"{folder}/{name}-wrong").select(
            "file_no", F.col("node").alias("record"), F.lit(True).alias(f"{name}_wrong"))
        found = wrong if found is None else found.join(wrong, ["file_no", "record"], "full")
    both = found.select("file_no", "record", *[F.coalesce(f"{n}_wrong", F.lit(False)).alias(f"{n}_wrong") for n in ("first", "second")])
    return catalogue.join(both, ["file_no", "record"])


def _descend(spark, truth, own, steps, folder):
    """Records (``file_no, node``) whose digests differ, found from the roots down by branches that do."""
    wrong = None
    for i, (a, b, over_files) in reversed(list(enumerate(zip(truth, own, [*steps, None], strict=True)))):
        if wrong is not None:
            a, b = (_below(level, wrong, over_files) for level in (a, b))
        both = a.join(b.withColumnRenamed("digest", "found"), ["file_no", "node"])
        both.filter(F.col("digest") != F.col("found")).select("file_no", "node").write.parquet(f"{folder}-{i}")
        wrong = spark.read.schema("file_no long, node long").parquet(f"{folder}-{i}")
        if wrong.isEmpty():
            break
    return wrong


def _below(level, wrong, over_files):
    """The nodes of a level whose parents differ."""
    parent = [c.alias(f"__{n}") for c, n in zip(_parent(level, over_files), ("file_no", "node"), strict=True)]
    named = wrong.toDF("__file_no", "__node")
    return level.select("*", *parent).join(named, ["__file_no", "__node"], "left_semi").select(*level.columns)
