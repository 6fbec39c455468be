"""Helpers shared by the training-data operators: shared scratch tables,
connected components, and picking one row among exact ties."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master (tests) may run without it; there the driver's
    temporary folder is as good, because driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="tessera-llm-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def persist(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: the
    lineage ends here and the rows survive the loss of any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


WHOLE_TEXT_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows hold whole texts and go to Python next: the session's
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` is lowered to 1,000 if it is
    higher (its default is 10,000), so that a batch is a few MB on either side."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= WHOLE_TEXT_ROWS:
        conf.set(key, str(WHOLE_TEXT_ROWS))
    return df


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges(u, v)``;
    ``component`` is the smallest node reachable.

    Alternating large-star and small-star rounds: every round hangs the
    neighbours of a node onto the smallest of them. Rounds are logarithmic in
    practice and move only edges; a node with very many neighbours is reduced
    by ``min`` before the shuffle and its edges are re-joined with a one-row
    side, which AQE may split. Each round is a written table. Self loops are
    kept as nodes. No rows: no rows.
    """
    base = persist(edges.select("u", "v"), "edges")
    nodes = base.select(F.col("u").alias("node")).union(base.select(F.col("v").alias("node"))).distinct()
    current = base.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    seen = None
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = persist(current.join(low, "v").select("u", F.col("m").alias("v")).distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        current = persist(small, "small-star")
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or state[0] == 0:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left")
            .select("node", F.coalesce("component", "node").alias("component")))


def one_row_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the least row by all other columns in order. Grouping
    is by aggregation (map-side combine), so a hot key is no hot task."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    packed = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row"))
    return packed.select(*[f"`{c}`" if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns])
