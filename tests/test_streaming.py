"""Structured Streaming operators over a folder of posted files."""

import random

from pyspark.sql import functions as F

from conftest import rows
from tessera.session import work_path
from tessera.streaming import watch


def test_held_files_left_outer_expire(spark):
    src = work_path(spark, "held_in")
    data = [(1, "u", "2024-01-01 00:00:00", "file"), (2, "u", "2024-01-01 00:30:00", "ref"),
            (3, "v", "2024-01-01 01:00:00", "file"), (4, "w", "2024-01-03 00:00:00", "ref")]
    df = spark.createDataFrame(data, "id int, k string, t string, kind string").withColumn("ts", F.to_timestamp("t"))
    df.filter(F.col("id") <= 3).drop("t").write.parquet(f"{src}/a")
    schema = df.drop("t").schema
    stream = watch.watch(spark, f"{src}/*", schema, max_files_per_trigger=1)
    files = stream.filter(F.col("kind") == "file").select(F.col("id").alias("fid"), "k", F.col("ts").alias("fts"))
    refs = stream.filter(F.col("kind") == "ref").select(F.col("k"), F.col("ts").alias("rts"))
    out = watch.match_held_files(files, refs, "k", "fts", "rts", "1 HOUR", "1 HOUR", how="left_outer")
    sink, ck = work_path(spark, "held_out"), work_path(spark, "held_ck")
    q = out.select(F.col("f.fid").alias("fid"), F.col("r.rts").isNotNull().alias("matched")) \
        .writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck).start()
    q.processAllAvailable()
    # a later file moves the watermark past file 3's hold period
    df.filter(F.col("id") == 4).drop("t").write.parquet(f"{src}/b")
    q.processAllAvailable()
    # the global watermark is the minimum over both sides: a later file and a later reference
    spark.createDataFrame([(5, "x", "2024-01-05 00:00:00", "ref"), (6, "y", "2024-01-05 00:00:00", "file")],
                          "id int, k string, t string, kind string") \
        .withColumn("ts", F.to_timestamp("t")).drop("t").write.parquet(f"{src}/c")
    spark.createDataFrame([(7, "z", "2024-01-06 00:00:00", "file"), (8, "z", "2024-01-06 00:00:00", "ref")],
                          "id int, k string, t string, kind string") \
        .withColumn("ts", F.to_timestamp("t")).drop("t").write.parquet(f"{src}/d")
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    got = rows(spark.read.parquet(sink))
    assert (1, True) in got and (3, False) in got and (7, True) in got


def test_stream_dedupe_by_name_and_content(spark):
    src = work_path(spark, "dedupe_in")
    spark.createDataFrame([("a.txt", "h1"), ("a.txt", "h1"), ("a.txt", "h2")], "name string, md5 string") \
        .write.parquet(f"{src}/one")
    spark.createDataFrame([("a.txt", "h1"), ("b.txt", "h1")], "name string, md5 string").write.parquet(f"{src}/two")
    stream = watch.watch(spark, f"{src}/*", "name string, md5 string", max_files_per_trigger=1)
    out = watch.dedupe_arrivals(stream, ["name", "md5"], "_arrival", "1 hour").select("name", "md5")
    sink, ck = work_path(spark, "dedupe_out"), work_path(spark, "dedupe_ck")
    watch.run_to_files(out, sink, ck)
    assert rows(spark.read.parquet(sink)) == [("a.txt", "h1"), ("a.txt", "h2"), ("b.txt", "h1")]


def test_held_files_are_pending_published_or_expired(spark):
    """One file after the other: a status changes as event time passes."""
    from tessera.streaming import held

    src, out, ck = (work_path(spark, f"follow_{x}") for x in ("in", "out", "ck"))
    posted = [[(1, "u", "00:00", True), (2, "v", "00:10", True), (0, "u", "00:30", False)],
              [(3, "w", "01:00", True), (4, "u", "01:05", True)],
              [(0, "w", "02:00", False), (0, "x", "02:04", False)],
              [(5, "u", "02:05", True)]]
    schema = "id long, k string, at timestamp, is_file boolean"
    for i, part in enumerate(posted):
        rows_ = [(a, k, t, f) for a, k, t, f in part]
        spark.createDataFrame(rows_, "id long, k string, t string, is_file boolean").select(
            "id", "k", F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t")).alias("at"), "is_file").coalesce(1).write.parquet(f"{src}/{i}")
        stream = watch.watch(spark, f"{src}/*", schema)
        files = stream.where("is_file").select("id", "k", "at")
        refs = stream.where("NOT is_file").select("k", "at")
        held.run_held(held.follow_held_files(files, refs, "k", "1 hour"), out, ck)
    assert rows(held.statuses(spark, out)) == [(1, "published"), (2, "expired"), (3, "published"), (4, "pending"), (5, "pending")]
    changes = spark.read.parquet(out)
    assert changes.where("id = 2").count() == 2 and changes.where("id = 1").count() == 1


def _follow_all(spark, posted, **how):
    """``posted``: per micro-batch rows (id, k, minute, kind); (last statuses, changes, state rows after each batch)."""
    from tessera.streaming import held

    src, out, ck = (work_path(spark, f"follow_{x}") for x in ("in", "out", "ck"))
    n_state = []
    for i, part in enumerate(posted):
        spark.createDataFrame(part, "id long, k long, minute long, kind string").select(
            "id", "k", F.timestamp_seconds(F.col("minute") * 60 + 1_700_000_000).alias("at"), "kind").coalesce(1).write.parquet(f"{src}/{i}")
        stream = watch.watch(spark, f"{src}/*", "id long, k long, at timestamp, kind string")
        changes = held.follow_held_files(stream.where("kind = 'file'").select("id", "k", "at"), stream.where("kind = 'ref'").select("k", "at"),
                                         "k", "1 hour", clock=stream.select("at"), **how)
        q = held.run_held(changes, out, ck)
        n_state.append([s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]])
    return dict(rows(held.statuses(spark, out))), spark.read.parquet(out), n_state


def test_held_files_share_state_by_buckets(spark):
    """Many keys, few groups: every key is told apart inside its bucket."""
    rng = random.Random(3)
    posted, n = [], 0
    for batch in range(3):
        part = []
        for _ in range(150):
            n += 1
            part.append((n, rng.randrange(60) + (1 << 60), batch * 180 + rng.randrange(120), rng.choice(["file", "ref", "other"])))
        posted.append(part)
    got, changes, n_state = _follow_all(spark, posted, buckets=4)
    every = [r for part in posted for r in part]
    newest = max(r[2] for r in every)

    def want(i, k, at):
        if any(r[3] == "ref" and r[1] == k and at <= r[2] <= at + 60 for r in every):
            return "published"
        return "expired" if at + 60 < newest else "pending"

    assert got == {i: want(i, k, at) for i, k, at, kind in every if kind == "file"}
    assert set(got.values()) == {"published", "expired", "pending"}
    assert all(x <= 4 for batch in n_state for x in batch) and any(x > 0 for batch in n_state for x in batch)
    assert changes.groupBy("id", "status").count().where("count > 1").isEmpty()  # each is told once


def test_held_files_without_key_or_time(spark):
    """No reference meets a null key; a file without a time waits on; rows of no interest move event time and leave no state."""
    posted = [[(1, None, 0, "file"), (0, None, 5, "ref"), (2, 7, None, "file"), (0, 7, 5, "ref"), (0, 7, None, "ref"), (3, 8, 0, "file"),
               (4, 9, 290, "file")],
              [(0, None, 300, "other"), (0, 5, None, "other")]]
    got, _, n_state = _follow_all(spark, posted)
    assert got == {1: "expired", 2: "pending", 3: "expired", 4: "pending"}
    assert n_state[-1][-1] == 1  # file 4 alone
