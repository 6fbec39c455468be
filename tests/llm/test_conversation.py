"""Conversation repair against a search through all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tessera.llm import conversation as C

SCHEMA = "conv_id long, turn long, role string, text string"


def _all_repairs(rows):
    """The best (cost, audit) by plain recursion over every edit sequence."""
    best = None
    limit = 4 * len(rows) + 1

    def go(i, roles, cost, audit):
        nonlocal best
        if cost > limit or (best and cost > best[0]) or not re.fullmatch("(s?(ua)*u?)?", roles):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
            best = cost, audit
        for turn in "ua":
            go(i, roles + turn, cost + 3, audit + "I")
        if i < len(rows):
            initial, doomed, cut = rows[i]
            go(i + 1, roles, cost + 4, audit + "D")
            if not doomed:
                go(i + 1, roles + initial if initial else "?", cost + 3 * cut, audit + "K")
                for turn in "ua":
                    go(i + 1, roles + turn, cost + 3 + 3 * cut, audit + "R")

    go(0, "", 0, "")
    return best


def _random_rows(rng, n):
    return [(rng.choice("suauaua ?"), doomed := rng.random() < 0.2, not doomed and rng.random() < 0.25) for _ in range(n)]


def test_search_matches_every_edit_sequence():
    rng = random.Random(5)
    for n in [0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5] * 4:
        rows = _random_rows(rng, n)
        assert C.search(rows) == _all_repairs(rows), rows


def test_pieces_join_to_the_whole(monkeypatch):
    rng = random.Random(6)
    for n in [0, 5, 9, 14, 20, 31]:
        rows = _random_rows(rng, n)
        want = C.search(rows)
        for size in (1, 3, 7):
            monkeypatch.setattr(C, "PIECE", size)
            assert C.repair(rows) == want


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def _expected(rows):
    found = []
    after = _damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, items, count = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                count[fault] += 1
            items.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in C.LEGAL for a, b in itertools.pairwise(items))
        cost, audit = C.repair(items)
        lines, at, last = [], 0, ""
        for op in audit:
            if op != "I":
                _, _, role, text = mine[at]
                at += 1
                if op == "D":
                    continue
                if op == "K":
                    lines.append((role, text))
                    last = role[:1]
                    continue
            else:
                text = ""
            last = "a" if last == "u" else "u"
            lines.append(({"u": "user", "a": "assistant"}[last], text))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        found.append((conv, gaps, *count, illegal, cost, audit, sha))
    return sorted(found, key=str)


def _got(df):
    cols = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def _check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(C.repair_conversations(C.damaged(df), df)) == _expected(rows)


TEXTS = ["Yes.", "No!", "What?", "cut off", "", " \t", "Good. ", "trail...\n", "É", "x;"]


@pytest.mark.parametrize("piece", [48, 3])
def test_random_conversations(spark, monkeypatch, piece):
    monkeypatch.setattr(C, "PIECE", piece)
    rng = random.Random(piece)
    rows = []
    for conv in range(150):
        turns = sorted(rng.sample(range(20), rng.randint(1, 9)))
        for k, turn in enumerate(turns):
            role = rng.choice(["system", "user"]) if not k else rng.choice(["user", "assistant"] if rng.random() < 0.3 else [["assistant"], ["user"]][k % 2 == 0])
            rows.append((conv, turn, role, rng.choice(TEXTS)))
    _check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho."), (1, None, "user", "a."), (1, None, "user", "a."),
            (1, None, "assistant", "b."), (2, 5, None, "c."), (2, 5, "user", None), (3, 7, "User", "d"), (3, 7, "User", "d"), (4, None, "", ""),
            (5, -3, "user", "é" * 200_000 + "."), (5, 4, "assistant", "ok."), (6, 1, "tool", "x."), (6, 2, "system", "y.")]
    _check(spark, rows)


def test_conversations_without_rows_left_and_empty_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    _check(spark, [(gone, 1, "user", "Hi.")])
    assert _expected([(gone, 1, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    _check(spark, [])


def test_one_conversation_with_most_rows_is_searched_in_many_partitions(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(TEXTS) + str(rng.randrange(900)) + rng.choice([".", ""])) for t in range(1500)]
    rows += [(c, t, ["user", "assistant"][t % 2], "fine.") for c in range(100, 160) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    marked = C.faults(C.damaged(df))
    assert _got(C.repair_conversations(C.damaged(df), df)) == _expected(rows)
    assert C.plans(marked).where("conv_id = '7'").count() == 1


def test_clashing_columns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA + ", audit string, copies int, text_key string")
    assert _got(C.repair_conversations(C.damaged(df), df)) == _expected(rows)
