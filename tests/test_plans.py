"""Plan-shape checks: the scale properties the operators rely on."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import merge, upsert

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fan_out_needs_no_shuffle(spark):
    plan = _plan(E.queries()["publish_plan"](spark, SF))
    assert "Exchange" not in plan and "Join" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["retention"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    # only event_id and ts are read; the wide props/value columns are pruned
    assert schemas and all(set(re.findall(r"(\w+):", s)) <= {"event_id", "ts"} for s in schemas)


def test_small_delta_upsert_does_not_shuffle_the_catalog(spark):
    cat = spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_orderkey").alias("_key"), "o_orderstatus", F.lit(0).alias("_file_seq"))
    delta = cat.filter(F.col("_key") < 20).select("_key", F.lit("X").alias("o_orderstatus"),
                                                  F.lit(1).alias("_file_seq"))
    plan = _plan(upsert.upsert_into(cat, delta, ["_key"], ("_file_seq",)))
    assert re.search(r"BroadcastHashJoin .*LeftAnti", plan)


def test_duplicate_merge_counts_by_hash_and_passes_single_keys(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("v"), F.col("l_shipdate").alias("_s"))
    plan = _plan(merge.merge_duplicates(li, ["l_orderkey", "l_linenumber"], ["_s"]))
    assert "Window" not in plan and "SortAggregate" not in plan


def test_numbering_uses_range_partitioning(spark):
    df = E.queries()["catalog_sort"](spark, SF)
    plan = _plan(df)
    # rows were range partitioned and written once; what is left is a broadcast of one row per partition
    assert "Scan ExistingRDD" in plan and "BroadcastHashJoin" in plan
    assert not re.search("MapInPandas|SortMergeJoin|rangepartitioning", plan)
    # the only single-partition exchange feeds the per-partition statistics
    assert plan.count("SinglePartition") <= 1
