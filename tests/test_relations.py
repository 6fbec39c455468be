import random

from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.ranking import running_total, sequence_within
from tessera.operators import relations
from tessera.spec import CatalogSpec


def test_sequence_within_matches_row_number_with_hot_group(spark):
    from pyspark.sql import Window
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 9)}", i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, o int")
    a = sequence_within(df, ["g"], ["o"], "rn", num_partitions=7)
    b = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long"))
    assert rows(a, "g", "o", "rn") == rows(b, "g", "o", "rn")


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "o int, w int")
    out = {r["o"]: r["t"] for r in running_total(df, [], ["o"], "w", "t", 5).collect()}
    acc = 0
    for i in range(50):
        acc += i % 3
        assert out[i] == acc


def test_assign_pk_ranges(spark):
    d = spark.createDataFrame([(1, 5), (1, 7), (2, 1), (2, 2), (3, 0)], "f int, pk int")
    out = rows(relations.assign_pk(d, "pk", 10, "f", "new"), "f", "pk", "new")
    # file 1: 5..7 -> 10..12; file 2: 1..2 -> 13..14; file 3: 0 -> 15 (no reuse when min is 0)
    assert out == [(1, 5, 10), (1, 7, 12), (2, 1, 13), (2, 2, 14), (3, 0, 15)]


def _fixpoint(tables, edges, pk_del, fk_del):
    """Brute force: apply both orphan rules until nothing changes."""
    t = {k: set(v) for k, v in tables.items()}
    changed = True
    while changed:
        changed = False
        for child, parent in edges:
            if fk_del[(child, parent)]:
                keep = {r for r in t[child] if r[1] is None or r[1] in {p[0] for p in t[parent]}}
                changed |= keep != t[child]
                t[child] = keep
        for parent in t:
            if pk_del.get(parent):
                kids = [c for c, p in edges if p == parent]
                if kids:
                    refs = {r[1] for c in kids for r in t[c]}
                    keep = {r for r in t[parent] if r[0] in refs}
                    changed |= keep != t[parent]
                    t[parent] = keep
    return t


def test_orphan_two_passes_equal_fixpoint(spark):
    rnd = random.Random(11)
    for _ in range(3):
        pk_del = {"a": rnd.random() < 0.7, "b": rnd.random() < 0.7, "c": False}
        fk_del = {("b", "a"): rnd.random() < 0.7, ("c", "b"): rnd.random() < 0.7}
        tables = {
            "a": [(i, None) for i in range(6) if rnd.random() < 0.8],
            "b": [(10 + i, rnd.choice([None, *range(8)])) for i in range(8)],
            "c": [(100 + i, rnd.choice([None, *range(10, 20)])) for i in range(10)],
        }
        cfg = {"metadata": {"key": {"a": ["k"], "b": ["k"], "c": ["k"]}, "association": {
            "a": {"PK": {"name": "id", "delete orphan": pk_del["a"]}},
            "b": {"PK": {"name": "id", "delete orphan": pk_del["b"]},
                  "FK": {"a": {"name": "ref", "delete orphan": fk_del[("b", "a")]}}},
            "c": {"FK": {"b": {"name": "ref", "delete orphan": fk_del[("c", "b")]}}}}}}
        spec = CatalogSpec.from_config(cfg)
        dfs = {k: spark.createDataFrame(v, "id int, ref int") for k, v in tables.items()}
        got = relations.orphan_cascade(dfs, spec)
        want = _fixpoint(tables, [("b", "a"), ("c", "b")], pk_del, fk_del)
        for k in tables:
            assert set(rows(got[k], "id", "ref")) == want[k], k


def test_fk_orphans_keeps_null_fk(spark):
    child = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, fk int")
    parent = spark.createDataFrame([(5,)], "pk int")
    assert rows(relations.fk_orphans(child, parent, "fk", "pk"), "id") == [(1,), (2,)]


def test_remap_fk_by_file(spark):
    child = spark.createDataFrame([(1, 0, 7), (2, 1, 7), (3, 1, 8)], "id int, f int, fk bigint")
    m = spark.createDataFrame([(1, 7, 70)], "f int, old_pk bigint, ref_pk bigint")
    assert rows(relations.remap_fk(child, m, "fk", file_col="f"), "id", "fk") == [(1, 7), (2, 70), (3, 8)]


def test_sequence_within_inside_set_operations(spark):
    """Used on both sides of a union/except the numbering must not depend on
    task ids (partition identity is taken from the data)."""
    from pyspark.sql import Window
    rnd = random.Random(5)
    data = [(rnd.choice([None, 1, 2]), rnd.choice([None, "a", "b"]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "x int, g string, o int")
    a = sequence_within(df, [], [("x", False, True), "o"], "rn", 9)
    b = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("x").desc_nulls_last(), "o")).cast("long"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = sequence_within(df, ["g"], ["o"], "rn", 4)
    d = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long"))
    assert c.unionByName(a).exceptAll(d.unionByName(b)).count() == 0


def test_orphan_cascade_narrow_path_matches_full_path(spark):
    rnd = random.Random(4)
    cfg = {"metadata": {"key": {"a": ["k"], "b": ["k"]}, "association": {
        "a": {"PK": {"name": "id", "delete orphan": True}},
        "b": {"FK": {"a": {"name": "ref", "delete orphan": True}}}}}}
    spec = CatalogSpec.from_config(cfg)
    a = spark.createDataFrame([(f"a{i}", i, "x" * 3) for i in range(8)], "_key string, id int, payload string")
    b = spark.createDataFrame([(f"b{i}", rnd.choice([None, *range(12)]), "y") for i in range(15)],
                              "_key string, ref int, payload string")
    narrow = relations.orphan_cascade({"a": a, "b": b}, spec)
    full = relations.orphan_cascade({"a": a.withColumnRenamed("_key", "rid"), "b": b.withColumnRenamed("_key", "rid")},
                                    spec)
    for t in ("a", "b"):
        assert rows(narrow[t], "_key", "payload") == rows(full[t], "rid", "payload")


def test_dense_ids_follow_the_order(spark):
    df = spark.createDataFrame([(f"k{i:03d}", i % 5) for i in range(40)], "k string, g int")
    out = relations.dense_ids(df, [("g", True, True), "k"], start=100, out="id")
    got = [r["k"] for r in out.orderBy("id").collect()]
    assert got == sorted((f"k{i:03d}" for i in range(40)), key=lambda k: (int(k[1:]) % 5, k))
    assert sorted(r["id"] for r in out.collect()) == list(range(100, 140))
