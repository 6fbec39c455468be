"""STR-1 watch folders, STR-2 incremental upsert per micro-batch, STR-3 held
data files waiting for their references, STR-4 one-time processing of files
that arrive twice.

``trigger="available"`` processes what is there and stops (the reference's
test mode); otherwise a processing-time trigger polls every check period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.merge import merge_duplicates
from tessera.operators.transforms import q
from tessera.operators.upsert import fold_files, fold_into, without_sequences
from tessera.session import materialize


# ---------------------------------------------------------------- STR-1
def watch(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
          max_files_per_trigger: int | None = None, **options) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return (r.load(path).withColumn("_file_path", F.col("_metadata.file_path"))
            .withColumn("_arrival", F.col("_metadata.file_modification_time")))


def start(writer, trigger: str | float = "available"):
    """``available`` = process the backlog and stop; a number = poll period (s)."""
    if trigger == "available":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{float(trigger)} seconds").start()


def run_to_files(stream: DataFrame, out: str, checkpoint: str, trigger="available", fmt: str = "parquet"):
    q = start(stream.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint)
              .outputMode("append"), trigger)
    if trigger == "available":
        q.awaitTermination()
    return q


# ---------------------------------------------------------------- STR-2
def upsert_batches(stream: DataFrame, catalog_root: str, checkpoint: str, key_cols: Sequence[str],
                   file_col: str, order_cols: Sequence[str], trigger="available", table: str = "catalog"):
    """Each micro-batch: merge duplicate keys inside each file (AGG-1), then fold
    the batch into the catalog by file order (WIN-3 = repeated coalescing
    upserts). Only the hash buckets that hold keys of the batch are read and
    written. The stored catalog keeps every column's file sequence, so files may
    arrive in any order. A batch notes its id with its version; a replayed batch
    finds it there and skips (idempotent sink); lineage restarts at each version.
    """
    from tessera.plans import catalog as store

    key_cols, order_cols = list(key_cols), list(order_cols)

    def apply(batch: DataFrame, batch_id: int):
        cat = store.Catalog(batch.sparkSession, catalog_root)
        if cat.batch is not None and cat.batch >= batch_id:
            return
        rows = materialize(merge_duplicates(batch.drop("_file_path", "_arrival"), [*key_cols, file_col], order_cols,
                                            keep_order_cols=False))
        if table not in cat:
            cat.put(table, fold_files(rows, key_cols, file_col, (), keep_sequences=True), key_cols)
        else:
            touched = cat.buckets_of(table, rows.select(*[q(k) for k in key_cols]))
            cat.put_buckets(table, fold_into(cat.frame(table, touched), rows, key_cols, file_col, ()), touched)
        cat.commit(batch_id)

    q_ = start(stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint), trigger)
    if trigger == "available":
        q_.awaitTermination()
    return q_


def read_catalog(spark: SparkSession, catalog_root: str, table: str = "catalog") -> DataFrame | None:
    from tessera.plans import catalog as store

    found = store.load(spark, catalog_root).get(table)
    return None if found is None else without_sequences(found)


# ---------------------------------------------------------------- STR-3
def match_held_files(files: DataFrame, refs: DataFrame, key: str, file_time: str, ref_time: str,
                     hold: str, delay: str, how: str = "inner") -> DataFrame:
    """Stream-stream join: a held data file is published when a reference with
    the same key arrives within ``hold`` after it. Watermarks bound the state.
    ``how="left_outer"`` also emits every file that found no reference, once
    the watermark has passed its hold period (those are the expired files)."""
    f = _event_time(files, file_time).withWatermark(file_time, delay).alias("f")
    r = _event_time(refs, ref_time).withWatermark(ref_time, delay).alias("r")
    cond = ((F.col(f"f.{key}") == F.col(f"r.{key}")) & (F.col(f"r.{ref_time}") >= F.col(f"f.{file_time}"))
            & (F.col(f"r.{ref_time}") <= F.col(f"f.{file_time}") + F.expr(f"INTERVAL {hold}")))
    return f.join(r, cond, how)


# ---------------------------------------------------------------- STR-4
def dedupe_arrivals(stream: DataFrame, cols: Sequence[str], time_col: str, delay: str) -> DataFrame:
    """The same (name, content) arriving again within ``delay`` is dropped."""
    return _event_time(stream, time_col).withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(cols))


def _event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (session time zone), not TIMESTAMP_NTZ."""
    if dict(df.dtypes)[col] != "timestamp":
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df
