"""Tables of one row per key that change in place, for batches and streams.

The rows lie in buckets of the key. A commit writes file sets for the buckets that it changes and then one entry of the
log: which file sets make up each bucket, oldest first, and which batch of which writer came last. The entry is written
under another name and moved into place, so the newest entry is always a whole table; files that no entry names do not exist
for a reader. A bucket is a base and a few deltas, of which the newest row of a key counts; a commit to a bucket with
many deltas writes it anew. Superseded files go when no kept entry names them. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerfold.operators.ledger import BUCKETS, bucket_of
from ledgerfold.session import checkpointed, empty_frame

#: Deltas of a bucket before it is written anew, entries of the log that stay readable, writers of one bucket.
DELTAS, KEEP, WRITERS = 4, 3, 4


@dataclass(frozen=True)
class Entry:
    """One state of a table: no longer than its buckets and its writers are many."""

    version: int
    schema: str
    buckets: dict[int, list[int]]
    done: dict[str, int] = field(default_factory=dict)
    digests: dict[int, str] = field(default_factory=dict)


class KeyedTable:
    """``key`` tells rows apart; rows are dealt by ``by``, which is the key unless stated, a column that the key decides."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS, by: str | None = None):
        self.spark, self.path, self.key, self.n, self.by = spark, path.rstrip("/"), key, buckets, by or key

    # -- the log ----------------------------------------------------------------------------------------

    def _files(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        fs = hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs, hadoop.Path

    def _listed(self, folder: str) -> list[str]:
        fs, path = self._files()
        if not fs.exists(path(folder)):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path(folder)))

    def versions(self) -> list[int]:
        names = self._listed(f"{self.path}/_log")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]

    def entry(self, version: int | None = None) -> Entry | None:
        """The newest entry, or a stated one; None for a table that is not there."""
        known = self.versions()
        if not known:
            return None
        fs, path = self._files()
        stream = fs.open(path(f"{self.path}/_log/{known[-1] if version is None else version:020d}.json"))
        try:
            said = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        for name in ("buckets", "digests"):
            said[name] = {int(k): v for k, v in said[name].items()}
        return Entry(**said)

    def before(self, writer: str, batch: int) -> Entry | None:
        """The newest entry that holds nothing of this batch of the writer, nor of later ones: what a repeated batch must read."""
        for version in reversed(self.versions()):
            entry = self.entry(version)
            if entry.done.get(writer, -1) < batch:
                return entry
        return None

    def _write(self, entry: Entry) -> None:
        fs, path = self._files()
        final, draft = (f"{self.path}/_log/{n}" for n in (f"{entry.version:020d}.json", f".{uuid.uuid4().hex}"))
        stream = fs.create(path(draft), True)
        stream.write(bytearray(json.dumps(asdict(entry), sort_keys=True), "utf-8"))
        stream.close()
        if fs.exists(path(final)) or not fs.rename(path(draft), path(final)):
            fs.delete(path(draft), False)
            raise RuntimeError(f"another writer made version {entry.version} of {self.path}")

    # -- reading ----------------------------------------------------------------------------------------

    def read(self, entry: Entry | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of an entry (the newest if none is given), from the files that it names; of some buckets if given."""
        entry = entry or self.entry()
        if entry is None:
            return None
        wanted = {b: v for b, v in entry.buckets.items() if buckets is None or b in buckets}
        schema = StructType.fromJson(json.loads(entry.schema))
        plain = [self._folder(v[0], b) for b, v in wanted.items() if len(v) == 1]
        layered = [self._folder(v, b) for b, vs in wanted.items() if len(vs) > 1 for v in vs]
        out = self._open(plain, schema).drop("version")
        if layered:
            newest = Window.partitionBy(self.key).orderBy(F.desc("version"))
            rows = self._open(layered, schema).withColumn("_nth", F.row_number().over(newest))
            out = out.unionByName(rows.filter("_nth = 1").drop("_nth", "version"))
        return out.drop("bucket")

    def _folder(self, version: int, bucket: int) -> str:
        return f"{self.path}/version={version}/bucket={bucket}"

    def _open(self, folders: list[str], schema: StructType) -> DataFrame:
        whole = StructType([*schema.fields, StructField("version", IntegerType()), StructField("bucket", IntegerType())])
        if not folders:
            return empty_frame(self.spark, whole)
        return self.spark.read.schema(whole).option("basePath", self.path).parquet(*folders)

    # -- writing ----------------------------------------------------------------------------------------

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that some rows lie in: no more than the table has."""
        return sorted(r[0] for r in rows.select(bucket_of(self.by, self.n)).distinct().collect())

    def merge(self, fresh: DataFrame, writer: str = "batch", batch: int | None = None) -> Entry | None:
        """Add rows, in place of those with their keys. ``fresh`` has one row per key and is read several times, so it
        should be stored. A batch number that the writer has reached before changes nothing."""
        old = self.entry()
        if old and batch is not None and old.done.get(writer, -1) >= batch:
            return old
        touched = self.buckets_of(fresh)
        full = [b for b in touched if old and len(old.buckets.get(b, [])) >= DELTAS]
        rows = fresh
        if full:
            rows = rows.unionByName(self.read(old, full).join(fresh.select(self.key), self.key, "left_anti"), allowMissingColumns=True)
        return self._commit(rows, old, touched, full, {writer: batch} if batch is not None else {})

    def replace(self, rows: DataFrame, changed: list[int], gone: list[int], digests: dict[int, str]) -> Entry | None:
        """Whole new contents of some buckets; others stay as they are, ``gone`` ones go."""
        return self._commit(rows, self.entry(), changed, changed, {}, gone, digests)

    def _commit(self, rows, old, touched, anew, done, gone=(), digests=None) -> Entry | None:
        if not touched and not gone and not done:
            return old
        version = (old.version if old else 0) + 1
        if touched:
            placed = rows.withColumn("bucket", bucket_of(self.by, self.n))
            salt = F.pmod(F.xxhash64(self.key, F.lit("file")), F.lit(WRITERS))
            placed.repartition("bucket", salt).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/version={version}")
        held = dict(old.buckets) if old else {}
        for b in gone:
            held.pop(b, None)
        for b in touched:
            held[b] = [version] if b in anew or b not in held else [*held[b], version]
        schema = rows.schema.json() if touched or not old else old.schema
        entry = Entry(version, schema, held, {**(old.done if old else {}), **done}, digests if digests is not None else (old.digests if old else {}))
        self._write(entry)
        self.sweep()
        return entry

    def sweep(self, keep: int = KEEP) -> None:
        """Remove entries but the last ones, and file sets that none of these names."""
        fs, path = self._files()
        known = self.versions()
        kept = [self.entry(v) for v in known[-keep:]]
        named = {(v, b) for e in kept for b, versions in e.buckets.items() for v in versions}
        for v in known[:-keep]:
            fs.delete(path(f"{self.path}/_log/{v:020d}.json"), False)
        for folder in self._listed(self.path):
            if not folder.startswith("version="):
                continue
            version = int(folder.removeprefix("version="))
            if version > known[-1]:
                continue  # a write that is not committed yet, or never was: its number comes again
            here = [n for n in self._listed(f"{self.path}/{folder}") if n.startswith("bucket=")]
            dead = [n for n in here if (version, int(n.removeprefix("bucket="))) not in named]
            for n in dead if len(dead) < len(here) else []:
                fs.delete(path(f"{self.path}/{folder}/{n}"), True)
            if len(dead) == len(here):
                fs.delete(path(f"{self.path}/{folder}"), True)


def publish(table: KeyedTable, rows: DataFrame, digest: str = "digest") -> DataFrame:
    """Make a table equal to ``rows``, which hold a digest of themselves; returns ``(key, action)``: written, unchanged or pruned.

    A bucket's digest is the sum of its rows' digests, in any order, and their number. Buckets whose digest stands are neither
    read nor written. The new state is there at once or, after a crash, not at all. The actions are stored before that.
    """
    rows = rows if rows.isStreaming else checkpointed(rows)
    share = F.conv(F.substring(F.col(digest), 1, 15), 16, 10).cast("decimal(38,0)")
    sums = rows.groupBy(bucket_of(table.key, table.n).alias("b")).agg(F.sum(share).alias("s"), F.count("*").alias("n"))
    now = {r["b"]: f"{r['n']}:{r['s']}" for r in sums.collect()}
    old = table.entry()
    before = old.digests if old else {}
    changed = sorted(b for b, d in now.items() if before.get(b) != d)
    gone = sorted(b for b in before if b not in now)
    mine = rows.withColumn("_b", bucket_of(table.key, table.n))
    fresh = mine.filter(F.col("_b").isin(changed)).drop("_b")
    same = mine.filter(~F.col("_b").isin(changed)).select(table.key, F.lit("unchanged").alias("action"))
    held = table.read(old, changed + gone)
    a = fresh.select(table.key, F.col(digest).alias("_new"))
    b = held.select(table.key, F.col(digest).alias("_old")) if held is not None else a.select(table.key, F.col("_new").alias("_old")).limit(0)
    action = F.when(F.col("_new").isNull(), "pruned").when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged").otherwise("written")
    actions = checkpointed(a.join(b, table.key, "full_outer").select(table.key, action.alias("action")).unionByName(same))
    table.replace(fresh, changed, gone, now)
    return actions


def named_once(table: KeyedTable, wanted: DataFrame) -> DataFrame:
    """``(identity_key, slug)`` for every identity of ``wanted`` (identity_key, first_seq), from a register that only grows.

    Who has a name keeps it, whoever comes later with an earlier date. Newcomers are told apart inside this call: of those
    with one plain name the earliest takes it if it is free, the others their digest form.
    """
    from ledgerfold.operators.packages import allocate_slugs

    held = table.read()
    if held is None:
        held = table.spark.createDataFrame([], "identity_key string, slug string")
    new = checkpointed(allocate_slugs(wanted.join(held.select("identity_key"), "identity_key", "left_anti"), held))
    table.merge(new)
    known = table.read()
    return (new if known is None else known).join(wanted.select("identity_key"), "identity_key", "left_semi")
