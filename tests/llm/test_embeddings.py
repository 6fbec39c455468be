"""Spherical-cap filters against all pairs."""

import numpy as np
import pytest

from tessera.llm import embedding_dedup as E


def _brute(rows, cosine=0.95):
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    n, parent = len(rows), list(range(len(rows)))
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    links = [0] * n
    unit = [np.array(v, np.float64) / np.abs(np.array(v, np.float64)).max() if g else None for (_, v), g in zip(rows, good)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = root(i)
        least[r] = k if least.get(r) is None else least[r] if k is None else min(k, least[r])
    return sorted(((k, links[i], least[root(i)], k == least[root(i)]) for i, (k, _) in enumerate(rows)), key=str)


def _run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, node int")
    return sorted(((r.id, r.n_links, r.component_id, r.kept) for r in E.embedding_components(df, **how).collect()), key=str)


def _f32(v):
    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("hot", [1024, 8])
def test_matches_all_pairs(spark, hot):
    rng = np.random.default_rng(3)
    rows = [(i, _f32(rng.standard_normal(32))) for i in range(80)]
    centre = rng.standard_normal(32)
    rows += [(100 + i, _f32(centre + rng.standard_normal(32) * 0.08)) for i in range(30)]
    rows += [(200 + i, rows[5][1]) for i in range(3)] + [(300, [2 * x for x in rows[6][1]])]
    assert _run(spark, rows, hot=hot) == _brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = _f32(np.arange(1, 9))
    rows = [(1, None), (2, []), (3, [0.0] * 8), (4, [nan] + v[1:]), (5, [inf] + v[1:]), (6, [None] + v[1:]), (7, v), (None, v),
            (7, v), (8, v[:4]), (9, v[:4]), (None, [0.0] * 8)]
    assert _run(spark, rows) == _brute(rows)
    assert _run(spark, []) == []


def test_list_decoding_is_complete():
    rng = np.random.default_rng(1)
    code = E.make_code(32, 2000)
    unit = E.unit_rows(rng.standard_normal((20, 32)))
    turned, scale = unit @ code.rotation, 1 / np.sqrt(len(code.words))
    for row, got in zip(turned, code.decode(unit)):
        at, total = 0, np.zeros(1)
        for w in code.words:
            total = (total[:, None] + (row[at:at + w.shape[1]] @ w.T * scale)[None, :]).reshape(-1)
            at += w.shape[1]
        assert sorted(got.tolist()) == np.nonzero(total >= code.threshold)[0].tolist()


def test_recall_at_the_threshold():
    """Pairs at cosine 0.95 exactly, the hardest ones, for a large table's code."""
    rng = np.random.default_rng(2)
    x = E.unit_rows(rng.standard_normal((150, 64)))
    z = rng.standard_normal((150, 64))
    z = E.unit_rows(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * z
    found = np.zeros(150, bool)
    for k in range(E.CODES):
        code = E.make_code(64, 50_000, seed=E.SEED + k)
        found |= [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y))]
    assert found.mean() >= 0.97


def _recall(dim, rows, pairs=60):
    x, y = E._pairs_at(dim, 0.95, pairs, 77)
    found, listed = np.zeros(pairs, bool), 0
    for k in range(E.CODES):
        code = E.make_code(dim, rows, seed=E.SEED + k)
        assert len(code.words) <= 2 and code.threshold < 1
        a, b = code.decode(x), code.decode(y)
        found |= [len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)]
        listed += sum(len(p) for p in a)
    return found.mean(), listed / pairs / E.CODES


@pytest.mark.parametrize("rows", [1_000_000, 50_000_000])
@pytest.mark.parametrize("dim", [16, 64])
def test_recall_does_not_fall_with_the_table(dim, rows):
    """Pairs at cosine 0.95 exactly, decoded only; the lists stay short."""
    recall, listed = _recall(dim, rows)
    assert recall >= 0.97 and listed <= 2 * E.LISTED


@pytest.mark.parametrize("dim", [1, 2, 3, 4, 8])
def test_recall_of_few_components(dim):
    x = np.array([[1.0], [-1.0]]) if dim == 1 else None
    if x is not None:
        assert all(len(n) for n in E.make_code(dim, 10**6).decode(x))
    else:
        assert _recall(dim, 1_000_000)[0] >= 0.97


def test_share_of_a_cap():
    x = E.unit_rows(np.random.default_rng(4).standard_normal((200_000, 16)))
    assert E._tail(16, np.array(0.5)) == pytest.approx((x[:, 0] >= 0.5).mean(), rel=0.05)
