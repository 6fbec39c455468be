"""Exact dedup and mixing against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, DOCS + extra)


def _dedup(df):
    return sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()), key=str)


def test_exact_groups_nulls_ties_and_long_texts(spark):
    long = "x" * 300_000
    rows = [(1, "a", None, None, None), (2, "a", "en", "s", 1), (3, None, None, None, None), (4, "", "en", "s", 0),
            (5, long, "en", "s", 1), (6, long, "en", "s", 1), (7, long[:-1] + "y", "en", "s", 1),
            (8, "b", "en", "s", 1), (8, "b", "fr", "t", 1), (None, "c", "en", "s", 1), (9, "c", "en", "s", 1),
            (None, "d", "en", "s", 1), (None, "d", "en", "s", 1)]
    assert _dedup(_docs(spark, rows)) == sorted([
        (1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (5, 6, 2, False), (6, 6, 2, True),
        (7, 7, 1, True), (8, 8, 2, True), (8, 8, 2, False), (None, 9, 2, False), (9, 9, 2, True),
        (None, None, 2, True), (None, None, 2, False)], key=str)


def test_exact_same_prefix_and_length_is_not_enough(spark):
    head = "p" * 200
    rows = [(i, head + c, "en", "s", 1) for i, c in enumerate("abca")]
    assert [r[2] for r in _dedup(_docs(spark, rows))] == [2, 1, 1, 2]


def test_exact_empty_table_and_clashing_columns(spark):
    assert _dedup(_docs(spark, [])) == []
    rows = [(1, "a", "en", "s", 1, 7, "k"), (2, "a", "en", "s", 1, 8, "l"), (3, "b", "en", "s", 1, 9, "m")]
    df = _docs(spark, rows, ", n_bytes long, digest string")
    assert len(_dedup(df)) == 3
    kept = exact_dedup.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_exact_stage_keeps_one_row_of_every_text(spark):
    rng = random.Random(3)
    texts = ["t%d" % rng.randrange(40) for _ in range(200)] + [None, ""]
    rows = [(rng.choice([None, rng.randrange(30)]), t, "en", rng.choice("ab"), 1) for t in texts]
    kept = exact_dedup.keep_one_of_each(_docs(spark, rows)).collect()
    best = {}
    for r in rows:
        t = r[1] or ""
        best[t] = max(best.get(t, -1), -1 if r[0] is None else r[0])
    assert sorted((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in kept) == sorted(best.items())


def _brute_mix(rows, epochs=3):
    sizes = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest())
             for i, t, s in rows]
    names = sorted({s for _, s, _, _ in sizes}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for _, x, n, _ in sizes if x == s) for s in names}
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        level = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > epochs * total[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: float(epochs * total[s]) for s in over}
        free -= over
    out = []
    for s in names:
        whole = int(target[s] // total[s]) if total[s] else 0
        at = 0
        for i, _, n, _ in sorted((d for d in sizes if d[1] == s), key=lambda d: (d[3], d[2])):
            again = total[s] > 0 and at + n / 2 < target[s] - whole * total[s]
            at += n
            out.append((i, s, n, total[s], round(target[s], 6), (whole + again) * n))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing_matches_plain_python(spark, seed):
    rng = random.Random(seed)
    share = ["hot"] * 30 + ["a", "b", "c", None, "é"]
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 40))), rng.choice(share)) for i in range(150)]
    rows += [(200, None, "a"), (201, "", "b"), (202, "\t \n", "empty"), (None, "x y", "a"), (7, "same", "a"), (7, "same", "a"),
             (203, "z " * 20_000, "hot")]
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix_sources(df)
    assert sorted(((r.id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect()), key=str) == _brute_mix(rows)
    again = {(r.id, r.size, r.taken) for r in mixing.mix_sources(df.repartition(7)).collect()}
    assert again == {(r.id, r.size, r.taken) for r in got.collect()}
    by_source = got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("target"), F.max("size").alias("m")).collect()
    assert all(abs(r.t - r.target) <= r.m for r in by_source)


def test_mixing_empty_table_and_repeats(spark):
    schema = "doc_id long, text string, source string, row string, copies int"
    assert mixing.mix_sources(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, "a b c", "big", "r", 1), (2, "a", "small", "s", 2), (3, "d e f g", "big", "t", 3)], schema)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    want = {r.id: r.copies for r in mixing.mix_sources(df).collect()}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in want.items() for _ in range(n))


def test_mixing_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    plan = mixing.mix_sources(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
