"""The bucketed store and the integrity of references over batches."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators.relations import orphan_cascade
from tessera.operators.transforms import with_key
from tessera.operators.upsert import upsert_into
from tessera.plans import catalog as store
from tessera.plans import integrity
from tessera.spec import CatalogSpec


def _kv(spark, data):
    return with_key(spark.createDataFrame(data, "k string, v string"), ["k"])


def test_a_batch_reads_and_writes_only_its_buckets(spark, tmp_path):
    root = str(tmp_path)
    cat = store.Catalog(spark, root)
    cat.put("t", _kv(spark, [(f"k{i}", "old") for i in range(200)]), ["_key"], buckets=32)
    cat.commit()
    cat = store.Catalog(spark, root)
    delta = _kv(spark, [("k3", "new"), ("k77", "new"), ("fresh", "new")])
    touched = cat.buckets_of("t", delta)
    assert 1 <= len(touched) <= 3
    old = cat.frame("t", touched)
    read = {f.split("/b=")[1].split("/")[0] for f in old.inputFiles()}
    assert read <= {str(b) for b in touched}
    cat.put_buckets("t", upsert_into(old, delta, ["_key"], ()), touched)
    cat.commit()
    assert sorted(x for x in os.listdir(f"{root}/v=2/t") if x.startswith("b=")) == sorted(f"b={b}" for b in touched)
    got = dict(rows(store.load(spark, root)["t"], "k", "v"))
    assert len(got) == 201 and {k for k, v in got.items() if v == "new"} == {"k3", "k77", "fresh"}


def test_columns_come_and_change_type(spark, tmp_path):
    root = str(tmp_path)
    store.save(spark, root, {"t": _kv(spark, [(f"k{i}", str(i)) for i in range(20)])})
    cat = store.Catalog(spark, root)
    wide = _kv(spark, [("k1", "x")]).withColumn("extra", F.lit("e"))
    b = cat.buckets_of("t", wide)
    cat.put_buckets("t", upsert_into(cat.frame("t", b), wide, ["_key"], ()), b)
    assert cat.frame("t").where("extra IS NOT NULL").count() == 1 and cat.frame("t").count() == 20
    one = cat.buckets_of("t", _kv(spark, [("k7", "")]))
    cat.put_buckets("t", cat.frame("t", one).withColumn("v", F.expr("try_cast(v AS bigint)")), one)
    assert dict(cat.frame("t").dtypes)["v"] == "string"
    assert dict(rows(cat.frame("t"), "k", "v"))["k7"] == "7" and cat.frame("t").count() == 20


def test_a_crashed_batch_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    store.save(spark, root, {"t": _kv(spark, [("a", "1"), ("b", "1")])})
    cat = store.Catalog(spark, root)
    cat.put_buckets("t", cat.frame("t").withColumn("v", F.lit("lost")), range(cat.tables["t"].buckets))
    cat.append("log", spark.createDataFrame([("x",)], "line string"))
    assert rows(store.load(spark, root)["t"], "k", "v") == [("a", "1"), ("b", "1")]  # no pointer names what was written
    assert "log" not in store.load(spark, root)
    again = store.Catalog(spark, root)
    b = again.buckets_of("t", _kv(spark, [("a", "2")]))
    again.put_buckets("t", upsert_into(again.frame("t", b), _kv(spark, [("a", "2")]), ["_key"], ()), b)
    assert again.commit() == 2
    assert rows(store.load(spark, root)["t"], "k", "v") == [("a", "2"), ("b", "1")]


def test_logs_append_merge_and_vacuum(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "LOG_PARTS", 3)
    root = str(tmp_path)
    for i in range(6):
        cat = store.Catalog(spark, root)
        cat.append("log", spark.createDataFrame([(str(i),)], "line string"))
        cat.put("whole", spark.createDataFrame([(i,)], "n int"))
        cat.commit(batch=i)
    assert [r[0] for r in rows(store.load(spark, root)["log"], "line")] == list("012345")
    cat = store.Catalog(spark, root)
    assert len(cat.tables["log"].at) < 6 and cat.batch == 5 and cat.version == 6
    cat.append("log", spark.createDataFrame([("crashed",)], "line string"))
    assert store.vacuum(spark, root, keep=1) > 0
    assert not os.path.exists(f"{root}/v=7") and not os.path.exists(f"{root}/v=2/whole")
    found = store.load(spark, root)
    assert [r[0] for r in rows(found["log"], "line")] == list("012345") and rows(found["whole"]) == [(5,)]
    assert store.vacuum(spark, root, keep=1) == 0 and store.current_version(spark, root) == 6


def _spec(parent_orphans, child_orphans):
    return CatalogSpec.from_config({"metadata": {
        "key": {"a": ["k"], "b": ["k"], "c": ["k"]},
        "association": {
            "a": {"PK": {"name": "a_id", "int type": True, "delete orphan": parent_orphans}},
            "b": {"PK": {"name": "b_id", "delete orphan": parent_orphans}, "FK": {"a": {"name": "b_a", "delete orphan": child_orphans}}},
            "c": {"FK": {"b": {"name": "c_b", "delete orphan": child_orphans}, "a": {"name": "c_a", "delete orphan": True}}}}}})


COLS = {"a": ("a_id bigint", ("a_id",)), "b": ("b_id string, b_a bigint", ("b_id", "b_a")), "c": ("c_b string, c_a bigint", ("c_b", "c_a"))}


@pytest.mark.parametrize("parents,children,seed,batches", [(True, True, 1, 3), (False, True, 3, 2)])
def test_incremental_integrity_equals_whole_passes(spark, tmp_path, parents, children, seed, batches):
    rng, spec, root = random.Random(seed), _spec(parents, children), str(tmp_path)
    whole = {}
    pick = lambda most: None if rng.random() < 0.1 else rng.randrange(most)
    for batch in range(batches):
        size = 40 if batch == 0 else rng.choice([3, 6])
        made = {"a": [(f"k{rng.randrange(25)}", pick(20)) for _ in range(size)],
                "b": [(f"k{rng.randrange(40)}", None if (x := pick(25)) is None else f"b{x}", pick(22)) for _ in range(size)],
                "c": [(f"k{rng.randrange(60)}", None if (x := pick(27)) is None else f"b{x}", pick(22)) for _ in range(size)]}
        cat = store.Catalog(spark, root)
        before, posted, touched = dict(cat.tables), {}, {}
        for t in ("a", "b", "c"):
            if batch and rng.random() < 0.3:
                continue
            one = {r[0]: r for r in made[t]}
            df = with_key(spark.createDataFrame(list(one.values()), f"k string, {COLS[t][0]}"), ["k"])
            posted[t] = df
            whole[t] = df if t not in whole else upsert_into(whole[t], df, ["_key"], ())
            if t in cat:
                touched[t] = cat.buckets_of(t, df)
                cat.put_buckets(t, upsert_into(cat.frame(t, touched[t]), df, ["_key"], ()), touched[t])
            else:
                cat.put(t, df, ["_key"], buckets=8)
        sizes = {t: whole[t].count() for t in whole}
        whole = {t: spark.createDataFrame(df.collect(), df.schema) for t, df in orphan_cascade(whole, spec).items()}
        gone = integrity.clean(cat, before, posted, touched, spec)
        cat.commit()
        for t in whole:
            cols = ("k", *COLS[t][1])
            assert rows(cat.frame(t), *cols) == rows(whole[t], *cols), (batch, t)
            assert gone.get(t, 0) == sizes[t] - whole[t].count()
        for p, kids in (("a", (("b", "b_a"), ("c", "c_a"))), ("b", (("c", "c_b"),))):
            refs = {}
            for c, fk in kids:
                for (v,) in rows(whole[c], fk):
                    if v is not None:
                        refs[str(v)] = refs.get(str(v), 0) + 1
            assert dict(rows(cat.frame(f"__refs_{p}"), "pk", "n")) == refs
