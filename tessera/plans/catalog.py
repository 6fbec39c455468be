"""Versioned catalog store whose tables lie in hash buckets.

Layout: ``<root>/v=<tag>/<table>/b=<bucket>/part-*`` and a pointer of each version,
``<root>/_current/<version>.json``. A pointer names for every table the folder that holds each
of its buckets. A batch reads the buckets that its keys fall into, writes those
buckets anew under its own version (copy on write) and flips the pointer;
everything else is carried over by the pointer alone, so work follows the batch
and not the catalog. Readers see the old version or the new one.

Three kinds of tables:

* ``buckets``: rows with a key, dealt by its hash; order is a column, not a
  place, so an update never sorts or moves other rows;
* ``log``: append-only (rows without a key, files processed, actions to do);
* ``whole``: small tables replaced as a whole (service state).

All I/O goes through Spark readers/writers and the root's Hadoop file system,
so ``root`` may be any shared file system Spark can write."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessera.operators.transforms import KEY, q

BUCKET = "b"
DEFAULT_BUCKETS = 16        # of a new table, unless the session sets spark.tessera.store.buckets
BUCKETS_KEY = "spark.tessera.store.buckets"
LOG_PARTS = 48              # appended folders of a log until they are merged into one


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row. Keys are hashed as text: 7 and "7" are one key."""
    return F.pmod(F.xxhash64(*[q(k).cast("string") for k in key]), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Stored:
    """Where a table lies: ``at[b]`` is the tag of the folder that holds bucket
    ``b`` (None: empty); of a log all its folders in order, of a whole table one."""

    name: str
    kind: str
    key: tuple[str, ...]
    schema: StructType
    at: tuple[str | None, ...]

    @property
    def buckets(self) -> int:
        return len(self.at)

    def paths(self, root: str, buckets: Iterable[int] | None = None) -> list[str]:
        if self.kind != "buckets":
            return [f"{root}/v={tag}/{self.name}" for tag in self.at if tag]
        wanted = range(self.buckets) if buckets is None else sorted(set(buckets))
        return [f"{root}/v={self.at[b]}/{self.name}/{BUCKET}={b}" for b in wanted if self.at[b]]


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` as it names it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the store; none if it is not there."""
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _pointers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(x.removesuffix(".json")) for x in _children(spark, f"{root}/_current") if re.fullmatch(r"\d+\.json", x))


def _read_pointer(spark: SparkSession, root: str, version: int) -> dict:
    fs, p = _folder(spark, f"{root}/_current/{version}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_pointer(spark: SparkSession, root: str, pointer: dict) -> None:
    """Whole or not at all: written beside its place and renamed."""
    fs, draft = _folder(spark, f"{root}/_current/.{pointer['version']}.json")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(pointer).encode()))
    finally:
        out.close()
    _, final = _folder(spark, f"{root}/_current/{pointer['version']}.json")
    if not fs.rename(draft, final):
        raise RuntimeError(f"version {pointer['version']} of {root} was written by somebody else")


def _stored(tables: dict) -> dict[str, Stored]:
    return {t: Stored(t, s["kind"], tuple(s["key"]), StructType.fromJson(s["schema"]), tuple(s["at"])) for t, s in tables.items()}


class Catalog:
    """The current version of a store, and the changes that make the next one.

    ``put``, ``put_buckets`` and ``append`` write under the next version at once, and
    later reads of this object see what they wrote (a stage boundary that lasts).
    Nobody else does before ``commit`` adds the pointer. A batch that crashes
    leaves folders that no pointer names; its replay overwrites them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        versions = _pointers(spark, root)
        p = _read_pointer(spark, root, versions[-1]) if versions else {}
        self.version, self.batch = p.get("version"), p.get("batch")
        self.last_file_seq = p.get("last_file_seq", 0)
        self.tables = _stored(p.get("tables", {}))
        self.next = (self.version or 0) + 1
        self._tags: dict[str, int] = {}
        self.changed = False

    # ------------------------------------------------------------- reading
    def __contains__(self, table: str) -> bool:
        return table in self.tables

    def names(self, hidden: bool = False) -> list[str]:
        return [t for t in sorted(self.tables) if hidden or not t.startswith("__")]

    def frame(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or some buckets of it; columns that a file lacks are null."""
        return self.frame_of(self.tables[table], buckets)

    def frame_of(self, stored: Stored, buckets: Iterable[int] | None = None) -> DataFrame:
        paths = stored.paths(self.root, buckets)
        if not paths:
            return self.spark.createDataFrame([], stored.schema)
        return self.spark.read.schema(stored.schema).parquet(*paths)

    def frames(self, hidden: bool = False) -> dict[str, DataFrame]:
        return {t: self.frame(t) for t in self.names(hidden)}

    def buckets_of(self, table: str, keys: DataFrame) -> list[int]:
        """The buckets that ``keys`` (with the table's key columns) fall into: at most
        as many numbers as the table has buckets."""
        t = self.tables[table]
        return sorted(r[0] for r in keys.select(bucket_of(t.key, t.buckets)).distinct().collect())

    # ------------------------------------------------------------- writing
    def _target(self, table: str) -> tuple[str, str]:
        n = self._tags[table] = self._tags.get(table, -1) + 1
        tag = f"{self.next}.{n}" if n else str(self.next)
        return tag, f"{self.root}/v={tag}/{table}"

    def _write_buckets(self, table: str, df: DataFrame, key: Sequence[str], buckets: int) -> tuple[str, set[int]]:
        """Writes ``df`` by bucket; the buckets that came out with rows."""
        tag, path = self._target(table)
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(min(n, buckets), BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(path))
        prefix = BUCKET + "="
        return tag, {int(x.removeprefix(prefix)) for x in _children(self.spark, path) if x.startswith(prefix)}

    def put(self, table: str, df: DataFrame, key: Sequence[str] = (), buckets: int | None = None) -> None:
        """A whole table anew: in buckets if it has a ``key``, else in one piece."""
        if not key:
            tag, path = self._target(table)
            df.write.mode("overwrite").parquet(path)
            self.tables[table] = Stored(table, "whole", (), df.schema, (tag,))
        else:
            n = buckets or int(self.spark.conf.get(BUCKETS_KEY, str(DEFAULT_BUCKETS)))
            tag, full = self._write_buckets(table, df, key, n)
            self.tables[table] = Stored(table, "buckets", tuple(key), df.schema, tuple(tag if b in full else None for b in range(n)))
        self.changed = True

    def put_buckets(self, table: str, df: DataFrame, touched: Iterable[int]) -> None:
        """``df`` is what the buckets ``touched`` hold from now on. New columns are null
        in all other buckets; a column of another type than before becomes text and
        makes the table be written whole."""
        old, touched = self.tables[table], sorted(set(touched))
        if not touched:
            return
        schema = _merged_schema(df.schema, old.schema)
        if schema is None:
            rest = self.frame(table, set(range(old.buckets)) - set(touched))
            self.put(table, _union_as_text(df, rest), old.key, old.buckets)
            return
        tag, full = self._write_buckets(table, df, old.key, old.buckets)
        if not full <= set(touched):
            raise ValueError(f"{table}: rows of buckets that were not read: {sorted(full - set(touched))[:5]}")
        at = [(tag if b in full else None) if b in set(touched) else old.at[b] for b in range(old.buckets)]
        self.tables[table] = replace(old, schema=schema, at=tuple(at))
        self.changed = True

    def append(self, table: str, df: DataFrame) -> None:
        """Rows added to a log. After ``LOG_PARTS`` appends the log becomes one folder."""
        old = self.tables.get(table)
        schema = df.schema if old is None else _merged_schema(df.schema, old.schema)
        if old is not None and (schema is None or len(old.at) >= LOG_PARTS):
            df = _union_as_text(self.frame(table), df)
            old, schema = None, df.schema
        tag, path = self._target(table)
        df.write.mode("overwrite").parquet(path)
        self.tables[table] = Stored(table, "log", (), schema, (*(old.at if old is not None else ()), tag))
        self.changed = True

    def rebucket(self, table: str, buckets: int) -> None:
        """The table in another number of buckets (the only way to change it)."""
        self.put(table, self.frame(table), self.tables[table].key, buckets)

    def drop(self, table: str) -> None:
        self.changed |= self.tables.pop(table, None) is not None

    def commit(self, batch: int | None = None, last_file_seq: int | None = None) -> int:
        """Flip the pointer. ``batch`` and ``last_file_seq`` stay as they were unless given."""
        self.batch = self.batch if batch is None else batch
        self.last_file_seq = self.last_file_seq if last_file_seq is None else last_file_seq
        tables = {t: {"kind": s.kind, "key": list(s.key), "schema": s.schema.jsonValue(), "at": list(s.at)} for t, s in self.tables.items()}
        # readers take the highest version
        _write_pointer(self.spark, self.root, {"version": self.next, "batch": self.batch, "last_file_seq": self.last_file_seq, "tables": tables})
        self.version = self.next
        self.next, self._tags, self.changed = self.version + 1, {}, False
        return self.version


def _merged_schema(new: StructType, old: StructType) -> StructType | None:
    """Columns of both, ``new`` first; None if a column has two types."""
    kinds = {f.name: f.dataType for f in old}
    if any(f.name in kinds and kinds[f.name] != f.dataType for f in new):
        return None
    names = {f.name for f in new}
    return StructType([*[StructField(f.name, f.dataType, True) for f in new],
                       *[StructField(f.name, f.dataType, True) for f in old if f.name not in names]])


def _union_as_text(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both frames; columns that differ in type become text."""
    kinds = {f.name: f.dataType for f in a.schema}
    differ = {f.name for f in b.schema if f.name in kinds and kinds[f.name] != f.dataType}
    a, b = (df.select(*[q(c).cast("string").alias(c) if c in differ else q(c) for c in df.columns]) for df in (a, b))
    return a.unionByName(b, allowMissingColumns=True)


# ----------------------------------------------------------- plain functions
def current_version(spark: SparkSession, root: str) -> int | None:
    return Catalog(spark, root).version


def last_batch(spark: SparkSession, root: str) -> int | None:
    """The batch that wrote the current version, if it was given one."""
    return Catalog(spark, root).batch


def load(spark: SparkSession, root: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    out = Catalog(spark, root).frames(hidden=True)
    return {t: out[t] for t in tables} if tables else out


def save(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], batch: int | None = None) -> int:
    """``tables`` whole (in buckets where rows have a key) beside those that are there."""
    catalog = Catalog(spark, root)
    for t, df in tables.items():
        catalog.put(t, df, [KEY] if KEY in df.columns else ())
    return catalog.commit(batch)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete what no pointer of the newest ``keep`` versions names: folders of
    older versions, of crashed batches and the older pointers. The number of
    folders deleted. To be called by the one writer, between batches."""
    versions = _pointers(spark, root)
    used: set[str] = set()
    for v in versions[-keep:]:
        for stored in _stored(_read_pointer(spark, root, v)["tables"]).values():
            used.update(x.removeprefix(root) for x in stored.paths(root))
    if not versions:
        return 0
    gone = 0
    fs, _ = _folder(spark, root)

    def delete(path: str) -> None:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)

    for version in _children(spark, root):
        if not version.startswith("v="):
            continue
        kept_tables = 0
        for table in _children(spark, f"{root}/{version}"):
            path = f"/{version}/{table}"
            if path in used:
                kept_tables += 1
                continue
            kept = [b for b in _children(spark, root + path) if f"{path}/{b}" in used]
            if not kept:
                delete(root + path)
                gone += 1
                continue
            kept_tables += 1
            for b in _children(spark, root + path):
                if b.startswith(BUCKET + "=") and b not in kept:
                    delete(f"{root}{path}/{b}")
                    gone += 1
        if not kept_tables:
            delete(f"{root}/{version}")
    for v in versions[:-keep]:
        delete(f"{root}/_current/{v}.json")
    return gone


def reload_from_replicas(spark: SparkSession, spec, key_mode: str = "concat") -> dict[str, DataFrame]:
    """SRC-5: rebuild the catalog from the newest of its replicas (by file
    modification time) and pass it through the key + duplicate merge again.
    Replicas are the ``catalog names`` targets written by ``sinks.publish``
    (``<target>/<table>``, or one document of all tables)."""
    from tessera.operators.transforms import FILE_SEQ, ROW_SEQ, with_key
    from tessera.plans.prepare import key_and_merge
    from tessera.sinks.writers import replica_folder
    from tessera.sources.scan import list_files, newest_replica, read_json_documents, scan_csv, scan_json_tables, table_from_rows

    listings = None
    for target in spec.catalog_names:
        try:
            lf = list_files(spark, target).select(F.lit(target).alias("target"), "modificationTime")
        except FileNotFoundError:  # replica not written yet
            continue
        listings = lf if listings is None else listings.unionByName(lf)
    if listings is None:
        return {}
    newest = newest_replica(listings.groupBy("target").agg(F.max("modificationTime").alias("modificationTime")),
                            "target").first()[0]
    fmt = newest.rsplit(".", 1)[-1].lower() if "." in newest.rsplit("/", 1)[-1] else "parquet"
    out = {}
    folder = replica_folder(spark, newest)
    documents = None
    for t, ts in spec.tables.items():
        path = f"{folder}/{t}"
        try:
            if fmt == "csv":
                df = scan_csv(spark, path, spec.csv_separator, tokens=spec.null_tokens)
            elif fmt == "json":
                if documents is None:
                    documents = scan_json_tables(read_json_documents(spark, folder, whole_file=False), list(spec.tables)).drop("_pos")
                df = table_from_rows(documents.withColumn("tbl", F.col("tbl")), t)
                if not [c for c in df.columns if not c.startswith("_file") and c not in (ROW_SEQ, "tbl")]:
                    continue  # table absent from the document
                df = df.drop("tbl")
            else:
                df = spark.read.parquet(path)
        except AnalysisException:  # table absent from the replica
            continue
        df = df.drop(*[c for c in df.columns if c.startswith("_file") or c == ROW_SEQ])
        df = df.withColumn(FILE_SEQ, F.lit(0).cast("long")).withColumn(ROW_SEQ, F.monotonically_increasing_id())
        out[t] = key_and_merge(df, ts, spec, key_mode) if ts.key else with_key(df, [], key_mode)
    return out
