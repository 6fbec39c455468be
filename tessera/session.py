"""Session helpers and the shared scratch location.

On a cluster the scratch location is the folder named by
``spark.checkpoint.dir`` (shared storage). Only when nothing is set — local
tests — do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}  # application -> its temporary folder (local masters only)
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of stage boundaries are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what is small by construction; the threshold is the
    # size check Catalyst applies to everything else.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables: the
    session's ``spark.checkpoint.dir``, as the URI it is. A local master
    without that setting gets a temporary folder, one per application; on a
    cluster, where executors would not see it, that is an error."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "work", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Cut lineage at a stage boundary: a reliable checkpoint in the shared
    checkpoint folder (survives executor loss; never a local checkpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def gathered(df):
    """``df`` as rows that the driver holds: for frames whose size a batch's bound on
    files limits (plans, rejects), which Catalyst then knows to be small."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def as_table(df, name: str):
    """``df`` written to the shared folder and read back: Catalyst knows its size then,
    and broadcasts it only below its threshold."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
