"""Cross-parsing against naive longest matches, and held-out accuracy."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id as L
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _naive_pieces(text, reference):
    """Greedy pieces of a symbol list, each the longest that occurs in the reference."""
    ref, count, at = bytes(reference), 0, 0
    t = bytes(text)
    while at < len(t):
        n = 1
        while at + n < len(t) and t[at:at + n + 1] in ref:
            n += 1
        if t[at:at + 1] not in ref:
            n = 1
        count, at = count + 1, at + n
    return count


@pytest.mark.parametrize("block", [1024, 50, 7, 1])
def test_pieces_match_naive_parsing_of_whole_texts(monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    rng = random.Random(4)
    alphabet = "abcdé"
    table = L.symbol_table(alphabet)
    text = lambda n, a: L.symbols("".join(rng.choices(a, k=n)), table)
    model = L.LanguageModel({"x": text(200, "ab c"), "y": text(400, "bcd é"), "z": text(3, "a"), "w": text(300, "a")}, alphabet)
    copied = model.references["y"]
    texts = [text(n, "abcdé xÜ") for n in (0, 1, 49, 50, 51, 230, 1500)] + [copied, copied[13:311], np.concatenate([copied[:99], copied[5:]]),
                                                                         text(700, "a"), text(90, "aab")]
    got = model.pieces(texts)
    for row, t in zip(got, texts):
        for have, ref in zip(row, model.references.values()):
            assert have == _naive_pieces(t.tolist(), ref.tolist())
    assert got[7][1] == got[8][1] == 1  # taken from the reference: one piece, however many blocks it spans


def test_long_copy_is_one_piece():
    rng = random.Random(8)
    table = L.symbol_table("abcdefgh")
    reference = L.symbols("".join(rng.choices("abcdefgh ", k=12_000)), table)
    model = L.LanguageModel({"x": reference}, "abcdefgh")
    assert model.pieces([reference[100:9_100], reference, reference[::-1]])[:2].tolist() == [[1], [1]]


def test_automaton_spells_substrings_only():
    ref = np.array([3, 4, 3, 3, 5, 4, 3], np.uint8)
    following = L.suffix_automaton(ref)
    words = {tuple(ref[i:j].tolist()) for i in range(len(ref)) for j in range(i, len(ref) + 1)}
    seen, todo = set(), [((), 0)]
    while todo:
        w, s = todo.pop()
        seen.add(w)
        todo += [(w + (c,), q) for c, q in following[s].items()]
    assert seen == words


def _rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


def test_folds_nulls_and_odd_texts(spark):
    train = [(i, ("the cat sat on the mat and the dog ran " if i % 2 else "le chat est sur la table et le chien court ") * 6,
              "en" if i % 2 else "fr", 1) for i in range(60)]
    odd = [(100, None, "en", 1), (101, "", "fr", 1), (102, "123 !? \n", "en", 1), (None, "the cat", None, 1), (103, "жук", "ru", 1),
           (104, "le chat court " * 30_000, None, 1), (1, train[1][1], "en", 1)]
    df = _rows(spark, train + odd)
    model = L.learn(df.where(~L.held_out()))
    got = L.identify(df.select("doc_id", L.held_out().alias("held_out"), "text"), model, carry=("doc_id", "held_out")).collect()
    assert len(got) == len(train + odd)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == UND for i, UND in ((100, "und"), (101, "und"), (102, "und")))
    assert by_id[104].lang_pred == "fr" and by_id[None].lang_pred == "en" and not by_id[None].held_out
    assert all(by_id[i].lang_pred == lang for i, _, lang, _ in train)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert by_id[103].lang_pred in ("en", "fr") or zlib.crc32(b"103") % 4 != 2


def test_nothing_learned_and_empty_table(spark):
    df = _rows(spark, [(1, "some text", None, 1)])
    assert [(r.lang_pred, r.score) for r in L.identify(df, L.learn(df)).collect()] == [("und", 0.0)]
    assert L.identify(df.limit(0), L.learn(df.limit(0))).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op8_language"](spark, SF).collect() if r.held_out]
    right = sum(truth[r.doc_id] == r.lang_pred for r in got)
    assert len(got) > 100 and right / len(got) >= 0.95


def test_letters_beyond_the_dense_table(monkeypatch):
    """The same pieces whether transitions are dense or looked up."""
    rng = random.Random(6)
    alphabet = "abcdefgh"
    table = L.symbol_table(alphabet)
    text = lambda n, a: L.symbols("".join(rng.choices(a, k=n)), table)
    references = {"x": text(300, "abcd e"), "y": text(200, "cdef gh"), "z": text(9, "a")}
    texts = [text(n, "abcdefgh éx") for n in (0, 1, 40, 2500)]
    dense = L.LanguageModel(references, alphabet).pieces(texts)
    for most in (0, 1, 4):
        monkeypatch.setattr(L, "DENSE_LETTERS", most)
        assert (L.LanguageModel(references, alphabet).pieces(texts) == dense).all()


def test_large_alphabets_stay_apart(spark):
    """Two languages that differ in letters beyond the most frequent 253 only."""
    rng = random.Random(7)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 1200)]
    common, one, two = han[:300], han[300:700], han[700:1100]
    words = {c[0]: [c[i] + c[i + 1] for i in range(0, 400, 2)] for c in (one, two)}
    def text(own):
        return "".join(rng.choice(common) * 2 + rng.choice(words[own[0]]) for _ in range(120))
    rows = [(i, text(one if i % 2 else two), "one" if i % 2 else "two", 0) for i in range(120)]
    df = _rows(spark, rows)
    model = L.learn(df.where("doc_id < 100"))
    assert len(model.alphabet) > 900
    got = L.identify(df.where("doc_id >= 100").withColumn("text", F.translate("text", "".join(common), "")), model).collect()
    assert all(r.lang_pred == ("one" if r.doc_id % 2 else "two") for r in got)


def test_sample_skips_nulls_copies_and_repeated_ids(spark):
    letters = "abcdefghijklmnopqrst"
    nulls = [(i, None if i % 2 else "12 !", "en", 0) for i in range(300)]
    copies = [(1000 + i, "copy copy", "en", 0) for i in range(300)]
    texts = [(2000 + i, f"{letters[i]} u{letters[i]}v", "en", 0) for i in range(9)]
    repeated = [texts[0]] * 200
    model = L.learn(_rows(spark, nulls + copies + texts + repeated), documents=10)
    words = L.symbols("copy " + " ".join(t for _, t, _, _ in texts), L.symbol_table(model.alphabet))
    assert len(model.references["en"]) == len(words) + len("copy ")
