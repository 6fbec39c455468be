"""Suffix-array dedup against every window of every text."""

import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import suffix_dedup as S


def _brute(rows, length):
    at = Counter()
    for _, t in rows:
        b = (t or "").encode()
        at.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if at[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((k, len(b), sum(gone), runs, bytes(x for x, c in zip(b, gone) if not c)))
    return sorted(out, key=str)


def _run(spark, rows, **how):
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, spans string")
    return sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.suffix_dedup(df, **how).collect()), key=str)


@pytest.mark.parametrize("alphabet,length,hot", [("ab", 8, 2), ("abcdefé ", 12, 1000), ("abcd", 25, 3)])
def test_matches_brute_force(spark, alphabet, length, hot):
    rng = random.Random(length)
    text = lambda n: "".join(rng.choices(alphabet, k=n))
    shared = [text(rng.randrange(5, 60)) for _ in range(4)]
    rows = [(i, "".join(rng.choice([text(rng.randrange(0, 30)), rng.choice(shared), rng.choice(shared)[3:20]])
                        for _ in range(rng.randrange(0, 6)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, shared[0] * 2), (62, rows[3][1]), (3, rows[3][1]), (3, "x" + rows[5][1]), (63, "a" * 90)]
    assert _run(spark, rows, length=length, hot=hot) == _brute(rows, length)


def test_production_length_planted_passage(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = " ".join(word() for _ in range(90))
    rows = [(i, " ".join(word() for _ in range(150)) + (passage if i % 2 else passage[:390]) + " ".join(word() for _ in range(40)))
            for i in range(6)] + [(9, "z" * 1_200_000)]
    got = _run(spark, rows)
    assert got == _brute(rows[:-1], 400) + [(9, 1_200_000, 1_200_000, 1, b"")] or sorted(got, key=str) == sorted(
        _brute(rows[:-1], 400) + [(9, 1_200_000, 1_200_000, 1, b"")], key=str)


def test_empty_table(spark):
    assert _run(spark, []) == []


def _suffixes(seed=4, groups=12):
    rng = np.random.default_rng(seed)
    buffer = rng.integers(97, 99, 3000).astype(np.uint8)
    start = rng.integers(0, 2900, 400)
    return S.Suffixes(buffer, start, np.minimum(60, 3000 - start), np.sort(rng.integers(0, groups, 400)))


def _plain_order(s):
    raw = [s.buffer[a:a + n].tobytes() for a, n in zip(s.start, s.size)]
    return [(int(s.group[i]), raw[i]) for i in sorted(range(len(raw)), key=lambda i: (s.group[i], raw[i]))], raw


def test_mergesort_orders_suffixes():
    s = _suffixes()
    want, raw = _plain_order(s)
    order, common = s.verified()
    assert [(int(s.group[i]), raw[i]) for i in order] == want
    for a, b, n in zip(order[:-1], order[1:], common[1:]):
        if n >= 0:
            assert raw[a][:n] == raw[b][:n] and raw[a][n:n + 1] != raw[b][n:n + 1] or raw[a] == raw[b]


def test_hash_collisions_are_caught():
    s = _suffixes()
    s.hash[:] = 0  # now everything collides
    want, raw = _plain_order(s)
    order, common = s.verified()
    assert [(int(s.group[i]), raw[i]) for i in order] == want
    assert all(raw[a][:n] == raw[b][:n] for a, b, n in zip(order[:-1], order[1:], common[1:]) if n > 0)


def test_equal_windows_choose_equal_anchors():
    rng = random.Random(1)
    for length, k in ((20, 6), (20, 17), (20, 20)):
        text = "".join(rng.choices("ab", k=600)).encode()
        seen = {}
        for first, windows, anchor in S.segments(text, length, k):
            for w in range(first, first + windows):
                assert w <= anchor <= w + length - k
                assert seen.setdefault(text[w:w + length], anchor - w) == anchor - w


def test_segments_do_not_depend_on_blocks(monkeypatch):
    text = ("".join(random.Random(2).choices("abc", k=900)) + "a" * 300).encode()
    whole = list(S.segments(text, 30, 9))
    monkeypatch.setattr(S, "BLOCK_BYTES", 64)
    assert list(S.segments(text, 30, 9)) == whole


def test_remove_spans():
    assert S.remove_spans(b"abcdefgh", [(0, 2), (2, 3), (5, 7), (6, 7)]) == (b"deh", 2)
    assert S.remove_spans(b"", []) == (b"", 0)
