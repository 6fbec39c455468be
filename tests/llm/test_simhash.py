"""SimHash components against all pairs."""

import random
from itertools import combinations
from math import comb

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash


def _brute_fp(text, shingle=4):
    import re
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _components(rows, distance):
    """rows: (id, fp). Smallest id reachable, null last."""
    n, parent = len(rows), list(range(len(rows)))
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(n):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= distance:
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = root(i)
        if k is not None and (least.get(r) is None or k < least[r]):
            least[r] = k
        least.setdefault(r, None)
    return sorted(((k, least[root(i)]) for i, (k, _) in enumerate(rows)), key=str)


def test_fingerprint_matches_plain_python():
    rng = random.Random(1)
    texts = ["", " \t\n\x0b", "One", "one two THREE", "É a b c d", "a b c d e f"]
    texts += [" ".join(rng.choice("ab cde fgh x".split()) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    for t in texts:
        assert simhash.fingerprint(t.encode(), 4) & (1 << 64) - 1 == _brute_fp(t)


def test_long_text_is_hashed_whole():
    text = " ".join(str(i) for i in range(70_000)).encode()
    assert simhash.fingerprint(text, 4) != simhash.fingerprint(text[:-300_000], 4)
    assert simhash.fingerprint(text, 4) & (1 << 64) - 1 == _brute_fp(text.decode())


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 7])
def test_plan_covers_every_pair(distance):
    rng = np.random.default_rng(5)
    sample = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    parts = simhash.plan_partitions(sample, 1_000_000, distance)
    assert sum(p.threshold + 1 for p in parts) == distance + 1
    probes = lambda parts: sum(comb(p.mask.bit_count(), k) for p in parts for k in range(p.threshold + 1))
    assert probes(parts) < 5000
    assert probes(simhash.plan_partitions(sample[:0], 0, distance)) <= distance + 1
    masks = [p.mask for p in parts]
    assert all(a & b == 0 for i, a in enumerate(masks) for b in masks[:i])


def test_masks_are_all_changes_of_few_bits(spark):
    for bits, radius in (([0, 5, 63], 0), ([0, 5, 63], 1), ([1, 2, 3, 40, 63], 3), ([7], 2), (list(range(64)), 2)):
        got = spark.range(1).select(simhash._flips(bits, radius).alias("m")).first().m
        want = {sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(bits, k)}
        assert len(got) == len(want) and {m & (1 << 64) - 1 for m in got} == want


@pytest.mark.parametrize("distance,hot", [(4, 1024), (4, 2), (3, 2), (3, 1024)])
def test_links_match_all_pairs(spark, distance, hot):
    rng = random.Random(distance * 10 + hot)
    fps = [0, (1 << 64) - 1]
    for _ in range(12):  # clusters around centres, chains included
        f = rng.getrandbits(64)
        for _ in range(8):
            fps.append(f)
            for _ in range(rng.randrange(0, 4)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    edges = simhash.close_pairs(df, distance, hot)
    from tessera.llm.common import connected_components
    got = {r.node: r.component for r in connected_components(edges).collect()}
    signed = [(simhash._signed(f), f) for f in fps]
    want = dict(_components(signed, distance))
    assert {k: got.get(k, k) for k, _ in signed} == want


def test_components_nulls_ties_and_empty(spark):
    near = "the quick brown fox jumps over the lazy dog again and again until it rests " * 8
    rows = [(5, near), (3, near + "now"), (9, "unrelated words that stand alone here and nowhere else at all"),
            (None, None), (4, ""), (7, " \n"), (8, "one two"), (8, "one two"), (2, "ONE TWO"), (None, "solo text of nobody else here")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    got = simhash.simhash_components(df)
    assert sorted(((r.id, r.component_id) for r in got.collect()), key=str) == _components([(i, _brute_fp(t)) for i, t in rows], 4)
    assert {r.fp & (1 << 64) - 1 for r in got.collect()} == {_brute_fp(t) for _, t in rows}
    assert simhash.simhash_components(df.limit(0)).collect() == []


def test_stage_keeps_one_of_each_component(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base, "x"), (3, base + " end", "y"), (3, base + " end", "a"), (7, "alone " * 9, "z"), (7, base, "q"),
            (None, "nobody has this one text at all", "n"), (None, None, "m"), (1, "", "k")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, component int")
    kept = simhash.keep_one_per_component(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=str)
    prints = [_brute_fp(t) for _, t, _ in rows]
    near = bin(prints[0] ^ prints[1]).count("1") <= 4
    want = [(3, base + " end", "a"), (7, "alone " * 9, "z"), (None, "nobody has this one text at all", "n"), (1, "", "k")]
    assert near and got == sorted(want, key=str)
