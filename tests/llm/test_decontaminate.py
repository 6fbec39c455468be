"""Winnowed benchmark passages against every window of every text."""

import random
import re

import pytest

from tessera.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
LOWER = {i: i + 32 for i in range(65, 91)}


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def _brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = _words(text)
        size = min(len(w), window)
        for at in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[at: at + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = _words(text), set(), set()
        for size in {len(k) for k in windows}:
            for at in range(len(w) - size + 1):
                if (named := windows.get(tuple(w[at: at + size]))):
                    hit.update(range(at, at + size))
                    found |= named
        out.append((doc_id, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in df.collect()), key=str)


def _check(spark, docs, items, **more):
    got = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more)
    assert _got(got) == _brute(docs, items, **more)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_match_every_window(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "Beta", "γάμμα", "d4", "e", "f", "g", "h"][: rng.randint(2, 8)])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 5, 7, 9, 10, 11, 25])))) for i in range(25)]
    docs = []
    for i in range(40):
        words = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            take = rng.choice(items)[1].split()
            a = rng.randrange(len(take) + 1)
            at = rng.randrange(len(words) + 1)
            words[at:at] = take[a: a + rng.randint(5, 20)]
        docs.append((i, rng.choice([" ", "\n", ", ", "  --"]).join(words)))
    _check(spark, docs, items)
    _check(spark, docs, [x for x in items if len(_words(x[1])) >= 10])


def test_nulls_ties_repeats_and_long_texts(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    items = [(1, passage), (1, passage), (2, passage + " more"), (None, "Only three words"), (3, None), (4, "..."), (10, "a a a a a a a a a a a a")]
    docs = [(1, passage), (1, passage), (2, None), (3, ""), (None, passage.upper()), (4, "x " * 30_000 + passage + " y" * 30_000),
            (5, "only THREE words! only three"), (6, "a " * 500), (7, passage.replace(" ", "\t--")), (8, passage.replace("w5", "v5"))]
    _check(spark, docs, items)


def test_hot_passage_is_found_in_every_document(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = [(i, f"head{i} {passage} tail{i % 7}") for i in range(400)] + [(1000 + i, f"clean text {i}") for i in range(200)]
    _check(spark, docs, [(7, passage), (8, passage + " z"), (9, "nothing of the kind stands in any of these documents at all")])


def test_empty_tables_and_clashing_columns(spark):
    _check(spark, [], [(1, "a b c d e f g h i j k")])
    _check(spark, [(1, "a b c"), (2, None)], [])
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", "x", 3)], DOCS + ", passage string, at long")
    items = spark.createDataFrame([(1, "a b c d e f g h i j", "x")], ITEMS + ", words string")
    assert _got(decontaminate.contamination(docs, items)) == [(1, 11, 10, ["1"], True)]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k")], DOCS)
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], ITEMS)
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
