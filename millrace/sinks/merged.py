"""Compaction of keyed upserts: a log-structured merge of the batches into a snapshot by key.

Below a table's folder lie

* ``millrace_writer=<w>/millrace_batch=<n>``: the versions that each batch appended (below the partition columns, if any);
* ``_merged/done/<w>/<n>``: marks of the batches that are complete;
* ``_merged/<generation>-<name>``: snapshot rows, one per key, in folders by hash of the key (``bucket``);
* ``_merged/manifest/<generation>.json``: the batches covered, and where each bucket's rows are.

A compaction merges the complete batches that no manifest covers into the buckets they touch, in new files, and then
puts one new manifest in place. Until that last step nothing that a reader sees has changed, so a compaction that is
killed leaves the old view. Plain readers of the folder see the batches only: names that begin with ``_`` are hidden from them.
"""

import json
import uuid
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.bounds import fits
from millrace.operators.upsert import latest_by_key
from millrace.sinks.folders import Folder
from millrace.sinks.writers import BATCH, WRITER, write_batch

BUCKET = "millrace_bucket"
#: Snapshot folders that a view is put together from at most, before a compaction rewrites all buckets.
MOST_FOLDERS = 8


def mark_done(spark, root, batch_id, writer="main"):
    """State that a batch is complete. Only marked batches are compacted."""
    Folder(spark, root).write(f"_merged/done/{quote(writer, safe='')}/{int(batch_id)}")


def _both(conditions):
    return reduce(lambda a, b: a & b, conditions)


class MergedTable:
    """A keyed table whose versions are appended in batches.

    ``schema`` is that of the rows, ``keys`` names the key columns and ``order`` the SQL expressions, oldest to newest, that
    tell a key's versions apart; equal ones go by batch, then writer. ``deleted`` is an SQL condition: a version that meets it
    removes its key. It stays in the snapshot as a tombstone, so that an older version that arrives later does not bring the
    key back. ``partition_by`` (key columns) prunes reads by ``where``. ``buckets`` is fixed with the first compaction: choose it so
    that a bucket's rows suit one task. Null keys are equal to each other. One compaction runs at a time; of two, the
    second to finish fails and changes nothing.
    """

    def __init__(self, spark, root, schema, keys, order, deleted=None, buckets=64, partition_by=()):
        self.spark, self.root = spark, root.rstrip("/")
        given = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in given])
        self.keys, self.order, self.deleted = list(keys), list(order), deleted
        self.buckets, self.partition_by = buckets, list(partition_by)
        self.stored = T.StructType([*self.schema.fields, T.StructField(WRITER, T.StringType()), T.StructField(BATCH, T.LongType())])
        self.folder = Folder(spark, root)

    # writing

    def append(self, df, batch_id, writer="main"):
        """Append one batch of versions, tombstones among them; a repeated attempt replaces itself."""
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        write_batch(rows, self.root, batch_id, writer, self.partition_by)
        mark_done(self.spark, self.root, batch_id, writer)

    # reading

    def manifest(self):
        """The manifest in force: generation, batches covered by writer, snapshot folder by bucket."""
        names = [n for n in self.folder.names("_merged/manifest") if n.endswith(".json")]
        if not names:
            return {"generation": 0, "buckets": self.buckets, "covered": {}, "places": {}}
        return json.loads(self.folder.read(f"_merged/manifest/{names[-1]}"))

    def _done(self, covered):
        """Highest complete batch of each writer that is not covered yet."""
        found = {}
        for name in self.folder.names("_merged/done"):
            batches = [int(n) for n in self.folder.names(f"_merged/done/{name}") if n.isdigit()]
            if batches and max(batches) > covered.get(unquote(name), -1):
                found[unquote(name)] = max(batches)
        return found

    def _read(self, path, schema):
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _versions(self, after, upto=None):
        """Appended versions behind the batches ``after``, and no further than ``upto`` if given. The conditions name folders,
        so covered files are not read."""
        rows = self._read(self.root, self.stored)
        writer, batch = F.col(WRITER), F.col(BATCH)
        if upto is not None:
            parts = [(writer == w) & (batch <= n) & (batch > after.get(w, -1)) for w, n in upto.items()]
            return rows.filter(reduce(lambda a, b: a | b, parts, F.lit(False)))
        if not after:
            return rows
        beyond = [(writer == w) & (batch > n) for w, n in after.items()]
        return rows.filter(reduce(lambda a, b: a | b, beyond, ~writer.isin(*after)))

    def _snapshot(self, manifest, buckets=None):
        """Snapshot rows with their bucket, of some buckets or of all."""
        schema = T.StructType([*self.stored.fields, T.StructField(BUCKET, T.IntegerType())])
        by_folder = {}
        for bucket, name in manifest["places"].items():
            if buckets is None or int(bucket) in buckets:
                by_folder.setdefault(name, []).append(int(bucket))
        parts = [self._read(f"{self.root}/_merged/{name}", schema).select(*schema.names).filter(F.col(BUCKET).isin(*own))
                 for name, own in sorted(by_folder.items())]
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else self.spark.createDataFrame([], schema)

    def _ages(self):
        return [*[F.expr(o) for o in self.order], F.col(BATCH), F.col(WRITER)]

    def _newest(self, rows, keys=None):
        return latest_by_key(rows, keys or self.keys, self._ages())

    def _over(self, old, new):
        """The newer row of each key of ``old`` and ``new``, which have one row per key. Where ``new`` is measured small it is
        broadcast, and the snapshot is neither shuffled nor sorted."""
        version = F.struct(*[c.alias(f"v{i}") for i, c in enumerate(self._ages())])
        named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]
        if not fits(new.select(*self.keys, *[c.alias(f"_v{i}") for i, c in enumerate(self._ages())])):
            return self._newest(old.unionByName(new))
        same = _both([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)])
        arrived = F.broadcast(new.select(*named, version.alias("_new")))
        aged = old.withColumn("_old", version)
        left = aged.join(arrived, same & (F.col("_new") > F.col("_old")), "left_anti").drop("_old")
        beaten = aged.select(*self.keys, "_old").join(arrived, same & (F.col("_new") <= F.col("_old"))).select(
            *[f"_k{i}" for i in range(len(self.keys))])  # no more rows than ``new``
        return left.unionByName(new.join(F.broadcast(beaten), same, "left_anti"))

    def current(self, where=None):
        """The current rows; ``where`` is a condition on ``partition_by`` columns that prunes the folders read.

        Reads the snapshot and the batches behind it, not the versions that the snapshot covers.
        """
        manifest = self.manifest()
        old, new = self._snapshot(manifest).drop(BUCKET), self._versions(manifest["covered"])
        if where is not None:
            old, new = old.filter(where), new.filter(where)
        new = self._newest(new.select(*self.stored.names))
        rows = self._over(old.select(*self.stored.names), new) if manifest["places"] else new
        if self.deleted is not None:
            rows = rows.filter(~F.coalesce(F.expr(self.deleted), F.lit(False)))
        return rows.select(*self.schema.names)

    # compacting

    def _bucketed(self, rows, buckets):
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))

    def compact(self, forget=None):
        """Merge the complete batches not covered yet; returns the new generation, or None if there is nothing to do.

        Only buckets that these batches touch are read and written again, until more than ``MOST_FOLDERS`` folders make up the
        snapshot. ``forget`` is an SQL condition on tombstones: those that meet it go for good (choose it so that no older
        version can arrive any more).
        """
        manifest = self.manifest()
        upto = self._done(manifest["covered"])
        if not upto:
            return None
        generation, buckets = manifest["generation"] + 1, manifest["buckets"]
        name = f"{generation:012d}-{uuid.uuid4().hex[:12]}"
        # At most one row per key and task is shuffled, so a key of many versions is no burden.
        fresh = self._newest(self._versions(manifest["covered"], upto).select(*self.stored.names))
        self._bucketed(fresh, buckets).write.parquet(f"{self.root}/_merged/{name}-fresh")
        schema = T.StructType([*self.stored.fields, T.StructField(BUCKET, T.IntegerType())])
        fresh = self._read(f"{self.root}/_merged/{name}-fresh", schema)
        touched = {r[0] for r in fresh.select(BUCKET).distinct().collect()}  # no more than there are buckets
        if len({p for b, p in manifest["places"].items() if int(b) not in touched}) >= MOST_FOLDERS:
            touched |= {int(b) for b in manifest["places"]}
        both = self._snapshot(manifest, touched).unionByName(fresh).repartition(BUCKET)
        rows = self._newest(both, [BUCKET, *self.keys])
        if forget is not None and self.deleted is not None:
            rows = rows.filter(~F.coalesce(F.expr(f"({self.deleted}) AND ({forget})"), F.lit(False)))
        # The bucket comes first, so that listing one level tells which buckets have rows.
        rows.write.partitionBy(BUCKET, *self.partition_by).parquet(f"{self.root}/_merged/{name}")
        there = {int(n.split("=")[1]) for n in self.folder.names(f"_merged/{name}") if n.startswith(f"{BUCKET}=")}
        places = {b: p for b, p in manifest["places"].items() if int(b) not in touched}
        places |= {str(b): name for b in sorted(there)}
        self._publish({"generation": generation, "buckets": buckets, "covered": {**manifest["covered"], **upto}, "places": places})
        self.folder.delete(f"_merged/{name}-fresh")
        return generation

    def _publish(self, manifest):
        """Put a manifest in force: one rename, which fails if another compaction has taken the number."""
        draft = f"_merged/draft-{uuid.uuid4().hex[:12]}.json"
        self.folder.write(draft, json.dumps(manifest, indent=1))
        if not self.folder.exists("_merged/manifest"):
            self.folder.write("_merged/manifest/README", "Generations of the snapshot; the last one is in force.\n")
        try:
            self.folder.move(draft, f"_merged/manifest/{manifest['generation']:012d}.json")
        except Exception:
            self.folder.delete(draft)
            raise

    def vacuum(self):
        """Delete the batches that the snapshot covers and the snapshot folders, manifests and remains of killed compactions
        that it has replaced. Call it when no reader of an earlier view and no compaction runs."""
        manifest = self.manifest()
        for writer, upto in manifest["covered"].items():
            label = quote(writer, safe="")
            for path in self.folder.matching("/".join(["*"] * len(self.partition_by) + [f"{WRITER}=*", f"{BATCH}=*"])):
                *_, own, batch = path.split("/")
                if unquote(own.split("=", 1)[1]) == writer and int(batch.split("=", 1)[1]) <= upto:
                    self.folder.delete(path)
            for n in self.folder.names(f"_merged/done/{label}"):
                if int(n) < upto:
                    self.folder.delete(f"_merged/done/{label}/{n}")
        used = set(manifest["places"].values())
        for name in self.folder.names("_merged"):
            number = name.split("-")[0]
            if number.isdigit() and int(number) <= manifest["generation"] and name not in used:
                self.folder.delete(f"_merged/{name}")
        for name in self.folder.names("_merged/manifest"):
            if name.endswith(".json") and int(name.split(".")[0]) < manifest["generation"]:
                self.folder.delete(f"_merged/manifest/{name}")


def start_upsert(df, table, checkpoint, writer="main", compact_every=None, trigger=None, forget=None):
    """Append a stream's micro-batches to a :class:`MergedTable`, and compact it after every ``compact_every`` of them."""
    def write(batch, batch_id):
        table.append(batch, batch_id, writer)
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact(forget)

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
