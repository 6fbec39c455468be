"""The watch service (STR-1/2/3 over whole batches): posted files stream in
through the file source; every micro-batch runs ``consolidate`` on its files
plus the data files still held from earlier batches; held files older than
the clean period are reported as expired (FIL-7).

State is part of the catalog's version: ``__held`` are the data files waiting,
``__processed`` the metadata files of all batches so far (a log: a batch appends
its own), ``__clean`` the time of the last clean, ``__outbox`` the file actions of
every batch. They are written with the catalog's tables under one pointer, so a
batch that is replayed either finds its version current and does nothing, or
starts from the version before it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import manifest
from tessera.plans import catalog as store
from tessera.plans import outbox
from tessera.plans.consolidate import BatchResult, consolidate, target_listing
from tessera.session import materialize
from tessera.sources.listing import list_tree
from tessera.spec import CatalogSpec
from tessera.streaming.watch import start

_EMPTY = {"version": None, "published": 0, "held": 0, "expired": 0, "rejected": 0}
MOST_FILES = 10_000     # files of one batch: what the driver may hold the names of
VACUUM_EVERY = 20       # batches


def run_batch(spark: SparkSession, spec: CatalogSpec, paths: list[str], catalog_root: str,
              now=None, write_replicas: bool = True, listed: bool = False, batch_id: int | None = None,
              most_files: int = MOST_FILES, encodings: DataFrame | None = None) -> dict:
    """One batch: files not processed before (SET-2) plus the held data files.
    ``paths`` are folders to list, or (``listed=True``) the files of one
    micro-batch. Of the files to do the ``most_files`` oldest are taken, the others
    wait for the next batch (``left``). A ``batch_id`` that the catalog already holds
    is skipped. ``encodings``: see ``consolidate``."""
    cat = store.Catalog(spark, catalog_root)
    if batch_id is not None and cat.batch is not None and cat.batch >= batch_id:
        return dict(_EMPTY)
    held = cat.frame("__held") if "__held" in cat else None
    left = 0
    if listed:
        todo_paths = list(paths)
    else:
        todo = list_tree(spark, list(paths)).select("path", "modificationTime")
        if "__processed" in cat:
            todo = manifest.files_to_process(todo, cat.frame("__processed"), ["path", "modificationTime"])
        if held is not None:
            todo = todo.join(held.select("path"), "path", "left_anti")
        todo = materialize(todo)
        todo_paths = [r[0] for r in todo.orderBy("modificationTime", "path").limit(most_files).select("path").collect()]
        left = max(0, todo.count() - len(todo_paths)) if len(todo_paths) == most_files else 0
    if held is not None and todo_paths:
        held = held.join(spark.createDataFrame([(p,) for p in todo_paths], "path string"), "path", "left_anti")
    if not todo_paths:
        return _EMPTY | {"held": held.count() if held is not None else 0}
    now_col = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    expired: list[DataFrame] = []

    def state(cat: store.Catalog, result: BatchResult) -> DataFrame | None:
        done = result.files.filter(F.col("file_class").isin(list(spec.metadata_regex)) | (F.col("file_class") == manifest.UNKNOWN))
        cat.append("__processed", done.select("path", "modificationTime"))
        # FIL-7: a clean runs when the clean period has passed since the last one
        # (the first one waits a period when "delay first clean" is set)
        last = cat.frame("__clean") if "__clean" in cat else spark.range(1).select(
            (now_col if spec.delay_first_clean else F.lit(None).cast("timestamp")).alias("last_clean"))
        due = last.select(F.coalesce(manifest.clean_due(F.col("last_clean"), now_col, spec.clean_period_hours), F.lit(True)).alias("due"),
                          F.col("last_clean")).first()
        waiting = result.pending
        if due["due"]:
            expired.append(materialize(manifest.expired(waiting, "modificationTime", now_col, spec.clean_period_hours)))
            waiting = waiting.join(expired[0].select("path"), "path", "left_anti")
        if due["due"] or "__clean" not in cat:
            when = spark.range(1).select(now_col.alias("last_clean")) if due["due"] else last
            cat.put("__clean", when)
        cat.put("__held", waiting)
        return expired[0] if expired else None

    result = consolidate(spark, spec, todo_paths, catalog_root, write_replicas=write_replicas, held=held,
                         batch=batch_id, state=state, encodings=encodings)
    if result.version % VACUUM_EVERY == 0:
        store.vacuum(spark, catalog_root)
    kinds = {r["kind"]: r["count"] for r in result.actions.groupBy("kind").count().collect()}
    return {
        "version": result.version,
        "published": kinds.get("publish", 0),
        "held": store.Catalog(spark, catalog_root).frame("__held").count(),
        "expired": sum(e.count() for e in expired),
        "rejected": kinds.get("reject", 0),
        **({"left": left} if left else {}),
    }


def mirror(spark: SparkSession, spec: CatalogSpec, catalog_root: str) -> int:
    """FIL-8: copies that make the publish folders of a class hold the same file
    names, as actions of a version of their own; their number. Run once before
    a service starts."""
    parts = []
    for folders in spec.get_folders.values():
        listed = target_listing(spark, folders) if len(folders) > 1 else None
        if listed is not None:
            missing = manifest.mirror_diff(listed, "folder", "file_name", folders)
            held = listed.groupBy("file_name").agg(F.min("path").alias("path"))
            parts.append(missing.join(held, "file_name").select(
                F.lit("mirror").alias("kind"), F.lit("copy").alias("action"), "path", "file_name", F.col("missing_in").alias("folder")))
    if not parts:
        return 0
    cat = store.Catalog(spark, catalog_root)
    n = outbox.append(cat, *parts).count()
    if n:
        cat.commit()
    return n


def serve(spark: SparkSession, spec: CatalogSpec, inputs: list[str], catalog_root: str,
          checkpoint: str, once: bool | None = None, max_files_per_trigger: int = 1000,
          encodings: DataFrame | None = None):
    """Watch ``inputs``; ``once`` (default: the spec's test mode) processes the
    backlog and stops, otherwise polls every check period."""
    once = spec.test_mode if once is None else once
    mirror(spark, spec, catalog_root)
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    stream = None
    for folder in inputs:  # one source per watched folder
        source = (spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True)
                  .option("maxFilesPerTrigger", max_files_per_trigger).load(folder).select("path"))
        stream = source if stream is None else stream.unionByName(source)

    def apply(batch: DataFrame, batch_id: int):
        # the file names of one micro-batch (bounded by maxFilesPerTrigger)
        paths = [r[0] for r in batch.collect()]
        if paths:
            print(json.dumps({"batch": batch_id, **run_batch(spark, spec, paths, catalog_root, listed=True, batch_id=batch_id,
                                                                      encodings=encodings)}))

    q = start(stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint),
              "available" if once else spec.check_period_seconds)
    if once:
        q.awaitTermination()
    return q
