import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import merge, upsert


def test_merge_first_seen_order_and_nulls(spark):
    df = spark.createDataFrame(
        [("k", 3, "b", None), ("k", 1, "a", None), ("k", 2, "b", None), ("u", 1, "z", "q"), ("n", 1, None, None),
         ("n", 2, None, None)], "_key string, _row_seq int, v string, w string")
    out = merge.merge_duplicates(df, ["_key"], ["_row_seq"])
    assert rows(out, "_key", "v", "w", "_row_seq") == [("k", "a, b", None, 1), ("n", None, None, 1),
                                                         ("u", "z", "q", 1)]


def test_merge_hot_key(spark):
    data = [("hot", i, f"v{i % 5}") for i in range(3000)] + [(f"k{i}", i, "x") for i in range(100)]
    df = spark.createDataFrame(data, "_key string, _row_seq int, v string")
    out = {r["_key"]: r["v"] for r in merge.merge_duplicates(df, ["_key"], ["_row_seq"]).collect()}
    assert out["hot"] == "v0, v1, v2, v3, v4" and out["k7"] == "x" and len(out) == 101


def test_merged_pk_map(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 3, 2), ("a", 9, 3), ("b", 4, 1)], "name string, pk int, s int")
    assert rows(merge.merged_pk_map(df, ["name"], "pk", ["s"])) == [(3, 5), (9, 5)]


def test_coalesce_upsert_semantics(spark):
    old = spark.createDataFrame([("S1", "2", "20", "x", 0), ("S2", "1", "10", "y", 0)],
                                "_key string, Qty string, Amount string, note string, _file_seq int")
    new = spark.createDataFrame([("S1", "3", "30", None, 1), ("S3", "5", None, "z", 1)],
                                "_key string, Qty string, Amount string, extra string, _file_seq int")
    out = upsert.coalesce_upsert(old, new, ["_key"], ("_file_seq",))
    assert rows(out, "_key", "Qty", "Amount", "note", "extra", "_file_seq") == [
        ("S1", "3", "30", "x", None, 1), ("S2", "1", "10", "y", None, 0), ("S3", "5", None, None, "z", 1)]


def _random_frames(spark, seed):
    rnd = random.Random(seed)
    def mk(fs):
        return [(f"k{rnd.randint(0, 6)}", rnd.choice([None, "a", "b", "c"]), rnd.choice([None, "x", "y"]), fs)
                for _ in range(rnd.randint(0, 8))]
    return [spark.createDataFrame(mk(i), "_key string, v string, w string, _file_seq int") for i in range(3)]


def _dedup(df):
    return merge.merge_duplicates(df, ["_key", "_file_seq"], [], keep_order_cols=False)


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000))
def test_fold_equals_sequential_upserts(spark, seed):
    frames = [_dedup(f) for f in _random_frames(spark, seed)]
    seq = frames[0]
    for f in frames[1:]:
        seq = upsert.coalesce_upsert(seq, f, ["_key"], ("_file_seq",))
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    folded = upsert.fold_files(u, ["_key"], "_file_seq", ())
    assert rows(seq, "_key", "v", "w", "_file_seq") == rows(folded, "_key", "v", "w", "_file_seq")


def test_upsert_idempotent(spark):
    frames = [_dedup(f) for f in _random_frames(spark, 7)]
    c, d = frames[0], frames[1]
    once = upsert.coalesce_upsert(c, d, ["_key"], ("_file_seq",))
    twice = upsert.coalesce_upsert(once, d, ["_key"], ("_file_seq",))
    assert rows(once) == rows(twice.select(*once.columns))


@given(st.lists(st.sampled_from("abcdefgh"), unique=True, max_size=8),
       st.lists(st.sampled_from("abcdefgh"), unique=True, max_size=8))
def test_column_order_is_permutation(new, old):
    out = upsert.merge_column_order(new, old)
    assert sorted(out) == sorted(set(new) | set(old))
    assert [c for c in out if c in new] == new


def test_column_order_neighbours():
    # legacy-only 'x' sits after its previous neighbour 'a'; 'y' before its next neighbour 'd'
    assert upsert.merge_column_order(["a", "c", "d"], ["a", "x", "c"]) == ["a", "x", "c", "d"]
    assert upsert.merge_column_order(["d", "a"], ["y", "d"]) == ["y", "d", "a"]


def test_load_stats(spark):
    cat = spark.createDataFrame([(1,), (2,)], "k int")
    d = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert rows(upsert.load_stats(cat, d, ["k"])) == [("added", 1), ("dropped_null_key", 1), ("updated", 1)]


def test_fold_into_equals_full_fold(spark):
    frames = [_dedup(f) for f in _random_frames(spark, 21)]
    full = frames[0].unionByName(frames[1]).unionByName(frames[2])
    want = upsert.fold_files(full, ["_key"], "_file_seq", ())
    cat = upsert.fold_files(frames[0].unionByName(frames[1]), ["_key"], "_file_seq", ())
    got = upsert.fold_into(cat, frames[2], ["_key"], "_file_seq", ())
    assert rows(got, "_key", "v", "w", "_file_seq") == rows(want, "_key", "v", "w", "_file_seq")


def test_upsert_into_equals_coalesce_upsert(spark):
    frames = [_dedup(f) for f in _random_frames(spark, 5)]
    a = upsert.coalesce_upsert(frames[0], frames[1], ["_key"], ("_file_seq",))
    b = upsert.upsert_into(frames[0], frames[1], ["_key"], ("_file_seq",))
    assert rows(a, "_key", "v", "w", "_file_seq") == rows(b, "_key", "v", "w", "_file_seq")


def test_upsert_into_column_order(spark):
    old = spark.createDataFrame([("k", "1", "x")], "_key string, a string, legacy string")
    new = spark.createDataFrame([("k", "2", "n")], "_key string, a string, fresh string")
    out = upsert.upsert_into(old, new, ["_key"], ())
    assert out.columns == ["_key", "a", "legacy", "fresh"]
    assert rows(out) == [("k", "2", "x", "n")]


def _merged(data, n_order):
    """Rows ``(key, *order, *values)`` merged in plain Python."""
    out = {}
    for key, *rest in sorted(data, key=lambda r: r[1:1 + n_order]):
        order, values = tuple(rest[:n_order]), rest[n_order:]
        first, texts = out.setdefault(key, (order, [[] for _ in values]))
        for text, v in zip(texts, values):
            if v is not None and v not in text:
                text.append(v)
    return sorted(((k, *o, *[", ".join(t) if t else None for t in texts]) for k, (o, texts) in out.items()), key=str)


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000))
def test_merge_matches_plain_python(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(["h", "h", "h", "a", "b", None, *(f"u{i}" for i in range(9))]), i, rnd.choice([None, "x", "y", "z"]),
             rnd.choice([None, "p", "q"])) for i in range(60)]
    df = spark.createDataFrame(data, "_key string, _row_seq int, v string, w string")
    got = merge.merge_duplicates(df, ["_key"], ["_row_seq"])
    assert sorted(rows(got, "_key", "_row_seq", "v", "w"), key=str) == _merged(data, 1)


def test_merge_two_order_columns(spark):
    data = [("k", 2, 1, "a"), ("k", 1, 9, "b"), ("k", 1, 5, None), ("u", 3, 3, "c"), ("n", 1, 1, None), ("n", 1, 2, None)]
    df = spark.createDataFrame(data, "_key string, _file_seq int, _row_seq int, v string")
    got = merge.merge_duplicates(df, ["_key"], ["_file_seq", "_row_seq"])
    assert sorted(rows(got, "_key", "_file_seq", "_row_seq", "v"), key=str) == _merged(data, 2)
