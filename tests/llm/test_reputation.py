"""Host reputation against the same estimate in plain Python."""

import math
import random
from collections import defaultdict

import pytest

from tessera.llm import url_filter as U


def _likelihoods(n, k, prior):
    out = []
    for s in U.STRENGTHS:
        a, b = s * prior, s * (1 - prior)
        out.append(math.lgamma(k + a) - math.lgamma(a) + math.lgamma(n - k + b) - math.lgamma(b) + math.lgamma(s) - math.lgamma(s + n))
    return out


def _weights(members):
    """How common each strength is: expectation maximisation, one vote a member."""
    many = len(U.STRENGTHS)
    weights = [1 / many] * many
    scored = []
    for n, k, prior in members:
        if n > 0:
            x = _likelihoods(n, k, prior)
            scored.append([math.exp(v - max(x)) for v in x])
    for _ in range(U.ROUNDS):
        share = [0.0] * many
        for row in scored:
            total = sum(v * w for v, w in zip(row, weights))
            for j in range(many):
                share[j] += row[j] * weights[j] / total
        weights = [(v + 1 / many) / (len(scored) + 1) for v in share]
    return weights


def _posterior(n, k, prior, weights):
    x = [v + math.log(w) for v, w in zip(_likelihoods(n, k, prior), weights)]
    p = [math.exp(v - max(x)) for v in x]
    means = [(k + s * prior) / (n + s) for s in U.STRENGTHS]
    rate = sum(a * m for a, m in zip(p, means)) / sum(p)
    spread = sum(a * ((m - rate) ** 2 + m * (1 - m) / (n + s + 1)) for a, m, s in zip(p, means, U.STRENGTHS)) / sum(p)
    return rate, math.sqrt(spread)


def _plain(hosts):
    """``{host: (rate, bound)}`` from ``{host: (n, k, domain, suffix)}``."""
    domains, suffixes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    suffix_of = {}
    for n, k, domain, suffix in hosts.values():
        suffix_of[domain] = suffix
        for at in (domains[domain], suffixes[suffix]):
            at[0] += n
            at[1] += k
    total = sum(v[0] for v in suffixes.values()), sum(v[1] for v in suffixes.values())
    top = (total[1] + 0.5) / (total[0] + 1.0)
    w2 = _weights([(n, k, top) for n, k in suffixes.values()])
    prior_d = {d: _posterior(suffixes[suffix_of[d]][0] - n, suffixes[suffix_of[d]][1] - k, top, w2)[0] for d, (n, k) in domains.items()}
    w1 = _weights([(n, k, prior_d[d]) for d, (n, k) in domains.items()])
    prior_h = {h: _posterior(domains[d][0] - n, domains[d][1] - k, prior_d[d], w1)[0] for h, (n, k, d, _) in hosts.items()}
    w0 = _weights([(n, k, prior_h[h]) for h, (n, k, _, _) in hosts.items()])
    out = {}
    for h, (n, k, _, _) in hosts.items():
        rate, sd = _posterior(n, k, prior_h[h], w0)
        out[h] = rate, rate - U.Z * sd
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_reputation_matches_plain_python_and_blocks_bad_hosts(spark, seed):
    rng = random.Random(seed)
    hosts = {}
    for d in range(40):
        domain, bad = f"d{d}.{rng.choice(['com', 'org'])}", rng.random() < 0.2
        for h in range(rng.randint(1, 4)):
            n = rng.choice([0, 1, 3, 20, 60])
            hosts[f"h{h}.{domain}"] = n, sum(rng.random() < (0.97 if bad else 0.05) for _ in range(n)), domain, domain.split(".")[1]
    hosts["big.clean.com"] = 5000, 40, "clean.com", "com"   # a hot host decides nothing for the others
    hosts["www.spam.com"] = 80, 80, "spam.com", "com"
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    outcomes = spark.createDataFrame([(h, v[0], v[1]) for h, v in hosts.items() if v[0]], "host string, n long, k long")
    want = _plain(hosts)
    got = {r.host: (r.rate, r.bound) for r in U.reputation(df, outcomes).collect()}
    assert got.keys() == want.keys()
    for h in want:
        assert got[h] == pytest.approx(want[h], rel=1e-6, abs=1e-6), h
    assert got["www.spam.com"][1] > U.BLOCK_ABOVE > got["big.clean.com"][1]
