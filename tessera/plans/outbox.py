"""FIL-6, FIL-9, FIL-10 and FIL-11 as deliveries: what a batch decided to do with
files is saved under the batch's catalog version, in the same commit.

``__outbox`` is a log of actions ``(version, n, kind, action, path, file_name,
folder, replaces, reason)``. Whoever moves files reads it from the offset that they
acknowledged last. A batch that crashes before its commit leaves no action, a
batch that is replayed adds none, so each action is delivered once for every
acknowledged offset: read, act, acknowledge."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.catalog import Catalog

OUTBOX = "__outbox"
ACTIONS = ("version int, n long, kind string, action string, path string, file_name string, folder string, replaces string, reason string")
_ACK = "version int, n long"


def actions(spark: SparkSession, root: str, after: tuple[int, int] | None = None) -> DataFrame:
    """The actions beyond the offset ``after`` (``(version, n)``; None: all), in order."""
    cat = Catalog(spark, root)
    log = cat.frame(OUTBOX) if OUTBOX in cat else spark.createDataFrame([], ACTIONS)
    if after is not None:
        log = log.where(F.struct("version", "n") > F.struct(F.lit(after[0]).cast("int"), F.lit(after[1]).cast("long")))
    return log.orderBy("version", "n")


def acknowledged(spark: SparkSession, root: str, consumer: str = "files") -> tuple[int, int] | None:
    """The offset that ``consumer`` acknowledged last."""
    try:
        last = spark.read.schema(_ACK).json(f"{root}/_acks/{consumer}").agg(F.max(F.struct("version", "n")).alias("last")).first()["last"]
    except AnalysisException:
        return None
    return None if last is None else (last["version"], last["n"])


def acknowledge(spark: SparkSession, root: str, offset: tuple[int, int], consumer: str = "files") -> None:
    """All actions up to ``offset`` are done."""
    spark.createDataFrame([tuple(offset)], _ACK).coalesce(1).write.mode("append").json(f"{root}/_acks/{consumer}")


def pending(spark: SparkSession, root: str, consumer: str = "files") -> DataFrame:
    """The actions that ``consumer`` has not acknowledged, in order."""
    return actions(spark, root, acknowledged(spark, root, consumer))


def append(cat: Catalog, *parts: DataFrame | None) -> DataFrame:
    """Adds action frames (any of the columns after ``n``) to the batch that ``cat`` is
    about to commit; the batch's actions, as stored."""
    names = [c.split()[0] for c in ACTIONS.split(", ")][2:]
    whole = None
    for part in parts:
        if part is not None:
            one = part.select(*[F.col(c).cast("string") if c in part.columns else F.lit(None).cast("string").alias(c) for c in names])
            whole = one if whole is None else whole.unionByName(one)
    version = cat.next
    whole = whole.select(F.lit(version).alias("version"), F.monotonically_increasing_id().alias("n"), *names)
    cat.append(OUTBOX, whole)
    return cat.frame(OUTBOX).where(F.col("version") == version)
