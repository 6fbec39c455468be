"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tessera.llm import spelling

SCHEMA = "doc_id long, text string"
LOWER = {i: i + 32 for i in range(65, 91)}


def _vocabulary(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(rows):
    words = _vocabulary(rows)
    near = {w: [x for x in words if _near(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def _texts(seed, docs=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 8))) for _ in range(40)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rng.randint(0, 120)):
            w = rng.choice(stems[: rng.randint(1, 40)])
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abÀz") + w[at:], w[:at] + rng.choice("cdÿ") + w[at + 1:]])
            words.append(w.upper() if rng.random() < 0.05 else w)
        rows.append((i, rng.choice([" ", ", ", "\n", "1", "×-"]).join(words)))
    return rows


@pytest.mark.parametrize("shard_words", [100_000, 60, 5, 1])
def test_variants_match_all_pairs(spark, shard_words):
    rows = [*_texts(1), (None, "colour colour colour"), (1000, None), (1001, ""), (1002, "... 12")]
    want = _brute(rows)
    assert any(r[2] not in (r[0], r[1]) for r in want)  # a chain of forms
    assert _got(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA), shard_words=shard_words)) == want


def test_ties_long_texts_repeated_rows(spark):
    rows = [(1, "abcde " * 6 + "abcdf " * 6 + "abcdx " * 3), (1, "abcde " * 6 + "abcdf " * 6 + "abcdx " * 3),
            (2, "vwxyz" * 20_000 + " " + "vwxyz " * 5000)]
    want = _brute(rows)
    assert {r[0]: r[1] for r in want}["abcdx"] == "abcde"
    assert _got(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA))) == want


def test_empty_tables_and_clashing_columns(spark):
    assert _got(spelling.spelling_variants(spark.createDataFrame([], SCHEMA))) == []
    assert _got(spelling.spelling_variants(spark.createDataFrame([(1, None)], SCHEMA))) == []
    rows = [(1, "colour colour colour color color color color color color", "x", 5)]
    df = spark.createDataFrame(rows, SCHEMA + ", word string, n long")
    assert _got(spelling.spelling_variants(df)) == _brute([r[:2] for r in rows])


def test_half_index_finds_every_edit():
    rng = random.Random(3)
    for _ in range(300):
        words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(12)}
        for a in words:
            for b in words:
                assert spelling.one_edit(a, b) == (a != b and _near(a, b))
        trie = spelling.Trie({ord("a"): "!", ord("b"): "\x22"}, 2)
        for w in words:
            trie.add(w, 1)
        found = {(w, other) for w in words for path, leaf in trie.search(trie.vector(w))
                 for other, _ in spelling.near_in_leaf(w, leaf, sum(path))}
        assert {frozenset(p) for p in found} == {frozenset((a, b)) for a in words for b in words if a != b and _near(a, b)}
