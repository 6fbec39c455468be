"""SRC-6: encodings found by byte-pair likelihoods."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.plans.consolidate import consolidate
from tessera.sources import encodings
from tessera.spec import CatalogSpec

WORDS = ("été école père garçon élève forêt être août niño mañana señor corazón jamás över für größe straße mädchen "
         "schön über país aquí está casa river house water small light under maison jardin wasser himmel pueblo").split()


def _texts(seed, n, words=30):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(3, words))) for _ in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    texts = spark.createDataFrame([(t,) for t in [*_texts(1, 300), None, ""]], "text string")
    return encodings.learn_encodings(texts)


def _guess(spark, model, contents):
    files = spark.createDataFrame([(str(i), c) for i, c in enumerate(contents)], "path string, content binary")
    return {int(r["path"]): r["encoding"] for r in encodings.guess_encoding(files, model).collect()}


def test_model_counts_every_byte_pair(spark):
    """The log-likelihoods equal those of a plain count over the encoded texts, chunk borders included."""
    texts = ["é" * 3 + "x" * (encodings.STEP - 3) + "éaé", "naïve", "a" * encodings.STEP + "ß", "ü" * (2 * encodings.STEP + 1)]
    model = encodings.learn_encodings(spark.createDataFrame([(t,) for t in texts], "text string"), candidates=("utf-8", "cp1252"))
    for name in ("utf-8", "cp1252"):
        counts = {}
        for data in (t.encode(name) for t in texts):
            for i in range(len(data) - 1):
                pair = data[i:i + 2]
                if pair[0] >= 128 or pair[1] >= 128:
                    counts[pair] = counts.get(pair, 0) + 1
        total = 2 * sum(counts.values()) + encodings.UNSEEN * encodings.PAIRS
        got = {(r["odd"], r["pair"]): r[name] for r in model.select("odd", "pair", F.exp(name).alias(name)).collect()}
        for pair, n in counts.items():
            for odd in (0, 1):
                assert got[odd, pair.decode("latin-1")] * total == pytest.approx(n + encodings.UNSEEN)
        assert got[0, ""] * total == pytest.approx(encodings.UNSEEN)


def test_held_out_accuracy(spark, model):
    texts = [t for t in _texts(2, 240) if not t.isascii()]
    contents = [t.encode(encodings.CANDIDATES[i % 6]) for i, t in enumerate(texts)]
    found = _guess(spark, model, contents)
    right = sum(found[i] == encodings.CANDIDATES[i % 6] for i in range(len(texts)))
    assert right >= 0.97 * len(texts)


def test_marks_plain_text_and_odd_contents(spark, model):
    contents = ["été".encode("utf-8-sig"), "été".encode("utf-16"), "plain words".encode(), b"", None, b"\x81\x8d\xff\xfe" * 3,
                "plain words".encode("utf-16-be"), b"\xe9"]
    found = _guess(spark, model, contents)
    assert len(found) == len(contents)
    assert [found[i] for i in range(5)] == ["utf-8", "utf-16le", "utf-8", "utf-8", "utf-8"]
    assert found[6] == "utf-16-be"
    assert found[5] != "utf-8" and found[7] != "utf-8"  # not possible in it


def test_long_text_spans_chunks(spark, model):
    text = " ".join(_texts(3, 600))
    assert len(text) > 10 * encodings.STEP
    assert _guess(spark, model, [text.encode("cp850"), text.encode("utf-16-le")]) == {0: "cp850", 1: "utf-16-le"}


def test_empty_model_and_no_files(spark, model):
    empty = encodings.learn_encodings(spark.createDataFrame([], "text string"))
    assert empty.count() == 1
    assert _guess(spark, empty, [b"abc"]) == {0: "utf-8"}
    assert encodings.guess_encoding(spark.createDataFrame([], "path string, content binary"), model).count() == 0


def test_encoded_agrees_with_codecs(spark):
    every = "".join(c for b in range(256) for c in [bytes([b]).decode("cp850")]) + "ř漢"
    df = spark.createDataFrame([(every,)], "text string")
    for name in ("cp850", "cp1252", "mac-roman"):
        row = df.select(encodings.encoded(F.col("text"), name).alias("b"), encodings.representable(F.col("text"), name).alias("ok")).first()
        assert bytes(row["b"]) == every.encode(name, "replace") and not row["ok"]
    files = spark.createDataFrame([(b"\xe9", "cp1252"), (b"\xe9", "utf-8"), (None, "utf-8"), (b"x", "no such")], "c binary, e string")
    assert [r[0] for r in files.select(encodings.decoded("c", "e")).collect()] == ["é", None, None, None]


def test_batch_of_files_in_several_encodings(spark, model, tmp_path):
    """Metadata files without marks, each in an encoding of its own, load unaltered."""
    post = tmp_path / "post"
    post.mkdir()
    want = {}
    for n, name in enumerate(encodings.CANDIDATES):
        texts = [t for t in _texts(10 + n, 12) if not t.isascii()]
        lines = ["id;name"] + [f"{n}-{i};{t}" for i, t in enumerate(texts)]
        want |= {f"{n}-{i}": t for i, t in enumerate(texts)}
        (post / f"meta{n}.csv").write_bytes("\n".join(lines).encode(name))
    text = _texts(30, 1, 60)[0]
    (post / "doc.json").write_bytes(('{"id": "j", "name": "%s"}' % text).encode("cp1252"))
    spec = CatalogSpec.from_config({
        "name": "enc", "files": {"metadata file regex": {"*": r".*\.(json|csv)$"}, "metadata file formatting": {"csv separator": ";"}},
        "metadata": {"key": {"_": ["id"]}, "in columns": {"_": ["name"]}}})
    result = consolidate(spark, spec, [str(post)], str(tmp_path / "catalog"), write_replicas=False, encodings=model)
    got = {r["id"]: r["name"] for r in result.catalog["_"].select("id", "name").collect()}
    assert got == want | {"j": text}
