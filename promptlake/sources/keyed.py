"""Keyed tables of Parquet files in hash buckets, with a manifest as the commit.

    table/data/<commit>/bucket=17/part-....parquet     written once, never changed
    table/manifest/000000000003.json                   version 3: where each bucket's rows are

A row belongs to the bucket of its key's hash.  A change reads and rewrites the buckets of
its own keys alone; the next manifest names their new folders beside the old ones of all
other buckets.  A manifest is written under another name and renamed, which fails if the
version is there: of two writers that began from one version the second has to begin
again.  Until the rename readers see the version before, whatever has been written, and a
version that was read stays readable until ``vacuum`` takes it away.

A manifest has a line for each bucket with rows; their number is chosen with the table,
so that a bucket is some hundred MB.  Manifests are what the driver reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
#: Where rows that are dealt out for a change belong: their bucket, and which part of it.
PLACE = ("_bucket", "_part")


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Manifest:
    """A version: its number, the key, the number of buckets, the columns, each bucket's folder, the last batch of each stream."""

    version: int
    key: str
    buckets: int
    schema: dict
    folders: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def bucket_of(key: str, buckets: int) -> Column:
    """Null keys have a bucket too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _dealt(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """``rows`` with their places, dealt out by them; the more partitions a shuffle has, the more parts has a bucket."""
    parts = -(-2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    part = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(parts))
    return rows.withColumns(dict(zip(PLACE, (bucket_of(key, buckets), part), strict=True))).repartition(*PLACE)


class _Store:
    """A folder, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        where = self._at(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """A file that is there whole or not at all; one that is there already is a conflict."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        hadoop = self.jvm.org.apache.hadoop.fs
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else self.fs.getUri(), self.conf).rename(draft, self._at(name), options)
        except Exception as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e) or self.fs.exists(self._at(name)):
                raise Conflict(f"{name} is there") from e
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _name(version: int) -> str:
    return f"manifest/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in _Store(spark, path).names("manifest") if n.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The newest version, or a given one; None of a table that has none."""
    there = versions(spark, path)
    if version is None and not there:
        return None
    return Manifest(**json.loads(_Store(spark, path).read(_name(there[-1] if version is None else version))))


def _rows(spark: SparkSession, path: str, m: Manifest, folders: list[str]) -> DataFrame:
    schema = StructType.fromJson(m.schema)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f}" for f in folders])  # of columns that came later, older folders have nulls


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows of a version."""
    m = manifest(spark, path, version)
    if m is None:
        raise FileNotFoundError(f"{path} has no version")
    return _rows(spark, path, m, list(m.folders.values()))


def read_keys(spark: SparkSession, path: str, keys: list, version: int | None = None) -> DataFrame:
    """Rows of some keys, from their buckets alone."""
    m = manifest(spark, path, version)
    kind = StructType.fromJson(m.schema)[m.key].dataType
    wanted = spark.createDataFrame([(k,) for k in keys], StructType().add(m.key, kind))
    there = {str(r[0]) for r in wanted.select(bucket_of(m.key, m.buckets)).distinct().collect()}
    return _rows(spark, path, m, [f for b, f in m.folders.items() if b in there]).filter(F.col(m.key).isin(list(keys)))


def change(
    spark: SparkSession, path: str, batch: DataFrame, key: str, merged: Callable[[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]], DataFrame], empty: Callable[[], StructType], buckets: int = BUCKETS,
    stream: str | None = None, batch_id: int | None = None, replaced: tuple[str, ...] = (), watched: Callable[[DataFrame], DataFrame] = lambda d: d,
) -> Manifest | None:
    """The version that ``merged(target, batch, deal)`` makes of the buckets of the batch's keys.

    ``target`` are the rows of those buckets, with the columns that ``empty`` gives for a
    new table.  Rows are dealt out once: ``merged`` groups what ``deal`` makes of both by
    ``PLACE`` and the key, and its result still has ``PLACE``.  Columns in ``replaced`` are
    null in buckets of which every row is in the batch, for a merge that doesn't look at
    what the batch replaces.  A batch that a stream has committed before changes nothing,
    and returns None; so does one without rows.  ``watched`` may observe what is written.
    """
    old = manifest(spark, path)
    if old is not None and stream is not None and batch_id <= old.batches.get(stream, -1):
        return None
    if old is not None and old.key != key:
        raise ValueError(f"the key of {path} is {old.key}")
    n = old.buckets if old is not None else buckets
    touched = [str(r[0]) for r in batch.select(bucket_of(key, n)).distinct().collect()]  # n at most
    if not touched:
        return None
    now = Manifest(0, key, n, empty().jsonValue()) if old is None else old
    there = lambda found: _rows(spark, path, now, [now.folders[b] for b in found if b in now.folders])
    target = there(touched)
    if replaced and set(touched) & set(now.folders):
        stays = target.select(key).join(batch.select(key), key, "left_anti").select(bucket_of(key, n)).distinct()
        mixed = {str(r[0]) for r in stays.collect()}  # n at most
        blank = {f.name: F.lit(None).cast(f.dataType) for f in target.schema if f.name in replaced and f.name != key}
        target = there([b for b in touched if b in mixed]).unionByName(there([b for b in touched if b not in mixed]).withColumns(blank))
    out = merged(target, batch, lambda rows: _dealt(rows, key, n))
    folder = f"data/{now.version + 1:012d}-{uuid.uuid4().hex}"
    to = watched(out).withColumnRenamed(PLACE[0], "bucket").drop(PLACE[1])  # a file a part at most
    to.write.partitionBy("bucket").parquet(f"{path.rstrip('/')}/{folder}")
    written = {name.removeprefix("bucket=") for name in _Store(spark, path).names(folder) if name.startswith("bucket=")}
    folders = {b: f for b, f in now.folders.items() if b not in touched} | {b: f"{folder}/bucket={b}" for b in written}
    batches = now.batches | ({stream: batch_id} if stream is not None else {})
    new = Manifest(now.version + 1, key, n, out.drop(*PLACE).schema.jsonValue(), folders, batches)
    commit(spark, path, new)
    return new


def commit(spark: SparkSession, path: str, new: Manifest) -> None:
    _Store(spark, path).publish(_name(new.version), json.dumps(asdict(new)))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last versions, and folders that those don't name; not while a writer is at work.  Returns the folders."""
    store, there = _Store(spark, path), versions(spark, path)
    kept = there[-max(keep, 1) :]
    for v in there:
        if v not in kept:
            store.delete(_name(v))
    needed = {f.rpartition("/")[0] for v in kept for f in manifest(spark, path, v).folders.values()}
    named = {f for v in kept for f in manifest(spark, path, v).folders.values()}
    gone = [f"data/{n}" for n in store.names("data") if f"data/{n}" not in needed]
    gone += [f for n in sorted(needed) for f in (f"{n}/{b}" for b in store.names(n) if b.startswith("bucket=")) if f not in named]
    for f in gone:
        store.delete(f)
    return gone
