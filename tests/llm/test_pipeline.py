"""The pipeline: order of stages, columns between them, every stage's effect."""

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import mixing, simhash, toxicity
from tessera.llm.common import scratch

SF = "/root/testdata/sf0.001"


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after[name] = docs
        if name != "byte_bpe":
            assert docs.columns == columns
    start = spark.read.parquet(f"{SF}/documents.parquet").collect()
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    clean = [r for r in start if not (p := model.at_least(r.text or "")).size or p[0] < toxicity.REJECT_AT]
    assert sorted(r.doc_id for r in after["toxicity"].collect()) == sorted(r.doc_id for r in clean)
    last = {}
    for r in clean:
        last[r.text or ""] = max(last.get(r.text or "", -1), r.doc_id)
    assert sorted(r.doc_id for r in after["exact_dedup"].collect()) == sorted(last.values())
    prints = sorted((i, simhash.fingerprint(t.encode(), 4)) for t, i in last.items())
    parent = {i: i for i, _ in prints}
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if np.bitwise_count(np.uint64((a ^ b) & (1 << 64) - 1)) <= 4:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert sorted(r.doc_id for r in after["simhash_dedup"].collect()) == sorted(i for i in parent if root(i) == i)
    copies = {r.id: r.copies for r in mixing.mix_sources(after["simhash_dedup"]).collect()}
    mixed = [r.doc_id for r in after["mixing"].collect()]
    assert sorted(mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    texts = {r.doc_id: r.text or "" for r in after["mixing"].collect()}
    final = after["byte_bpe"].collect()
    assert sorted(r.doc_id for r in final) == sorted(mixed)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in final)


def test_stages_take_odd_tables(spark, tmp_path):
    """Nulls in every column, repeats, an empty text, clashing extra columns, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, toxic string, size int, ids string"
    rows = [(1, "some words here", "en", "a", 15, "t", 1, "i"), (1, "some words here", "en", "a", 15, "t", 1, "i"),
            (None, None, None, None, None, None, None, None), (2, "", "fr", None, 0, "t", 2, "i"),
            (3, "word " * 50_000, None, "b", None, None, None, None), (None, "unowned text of five words", "en", "b", 1, "x", 3, "y")]
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES:
            path = scratch(spark, f"odd-{name}")
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() == 0 if not table else docs.where(F.col("doc_id") == 3).count() >= 1
