import os

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import identify, linking, manifest
from tessera.session import work_path
from tessera.sources import scan


def test_json_multi_table_documents(spark, tmp_path):
    docs = [
        '{"project": {"correlationKey": "c1", "issue": 7}, "rawFiles": [{"fileName": "a.bin"}, {"fileName": "b.bin"}],'
        ' "clientName": "ACME", "nested": {"x": [1, 2]}}',
        '[{"a": "1"}, {"a": "2"}]',
    ]
    for i, d in enumerate(docs):
        (tmp_path / f"doc{i}.json").write_text(d)
    raw = scan.read_json_documents(spark, str(tmp_path))
    long = scan.scan_json_tables(raw, ["project", "rawFiles"])
    proj = scan.table_from_rows(long, "project")
    assert rows(proj, "correlationKey", "issue") == [("c1", "7")]
    assert rows(scan.table_from_rows(long, "rawFiles"), "fileName") == [("a.bin",), ("b.bin",)]
    default = scan.table_from_rows(long, "_")
    got = rows(default, "_file_name", "a", "clientName", "nested")
    assert got == [("doc0.json", None, "ACME", '{"x":[1,2]}'), ("doc1.json", "1", None, None),
                   ("doc1.json", "2", None, None)]


def test_csv_tokens_and_bom(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id;v\n1;#N/A\n2;ok\n3;NULL\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("id;v\n4;é\n".encode("utf-16"))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    enc = scan.detect_encoding(files)
    assert sorted((os.path.basename(r["path"]), r["encoding"]) for r in enc.collect()) == [
        ("a.csv", "UTF-8"), ("b.csv", "UTF-16LE")]
    df = scan.read_by_encoding(spark, enc, lambda p, e: scan.scan_csv(spark, p, ";", e))
    assert rows(df, "id", "v") == [("1", None), ("2", "ok"), ("3", None), ("4", "é")]


def test_contains_join_is_exact(spark):
    vals = ["8059Log_080152_270324.txt, other.bin", "prefix-a.bin", "none", None, "a.binb.bin"]
    names = ["a.bin", "b.bin", "8059Log_080152_270324.txt", "missing.txt", "other.bin"]
    rows_df = spark.createDataFrame([(i, v, None) for i, v in enumerate(vals)], "id int, files string, pub string")
    files = spark.createDataFrame([(n,) for n in names], "file_name string")
    out, found = linking.link_files(rows_df, files, ["files"], ["pub"])
    brute = {i for i, v in enumerate(vals) if v is not None and any(n in v for n in names)}
    assert {r["id"] for r in out.collect() if r["pub"] == "True"} == brute
    assert {r["pub"] for r in out.collect() if r["id"] not in brute} == {"False"}
    want_found = {n for n in names if any(v is not None and n in v for v in vals)}
    assert {r[0] for r in found.collect()} == want_found
    assert rows(linking.pending_files(files, found)) == [("missing.txt",)]


def test_ignore_classify_versions(spark):
    df = spark.createDataFrame([("in/.hidden",), ("in/x.tmp",), ("in/data.json",), ("in/m_1.xlsx",),
                                ("in/sub/data.json",)], "path string")
    kept = manifest.ignore_filter(df, [".hidden", "re:.*\\.tmp$"])
    assert rows(kept) == [("in/data.json",), ("in/m_1.xlsx",), ("in/sub/data.json",)]
    cls = kept.withColumn("cls", manifest.classify(manifest.basename(F.col("path")), {"meta": r"m_\d+\.xlsx"},
                                                   {"json": r".*\.json"}))
    assert rows(cls, "path", "cls")[1] == ("in/m_1.xlsx", "meta")
    named = kept.withColumn("name", manifest.basename(F.col("path")))
    v = manifest.name_versions(named, "name", ["path"], max_variations=0)
    assert rows(v, "path", "file_name", "action") == [
        ("in/data.json", "data.json", "keep"), ("in/m_1.xlsx", "m_1.xlsx", "keep"),
        ("in/sub/data.json", "data.json-1", "reject")]


def test_match_table_division(spark):
    fc = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f2", "a"), ("f2", "b"), ("f2", "c"), ("f3", "z"),
                                ("f4", "c"), ("f4", "d")], "file string, col string")
    req = identify.required_frame(spark, {"t1": ["a", "b"], "t2": ["a"], "t3": ["c"], "t4": ["d"]})
    got = dict(rows(identify.match_table(fc, req)))
    assert got == {"f1": "t1", "f2": "t1", "f3": "ntf", "f4": "ambiguous"}


def test_mirror_diff(spark):
    p = spark.createDataFrame([("A", "x"), ("B", "x"), ("A", "y"), ("C", "z")], "folder string, file string")
    assert rows(manifest.mirror_diff(p, "folder", "file")) == [
        ("A", "z"), ("B", "y"), ("B", "z"), ("C", "x"), ("C", "y")]


def test_work_path_under_checkpoint_dir(spark):
    p = work_path(spark, "t")
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert p.startswith(root.replace("file:", ""))


def test_name_versions_with_timestamp(spark):
    from pyspark.sql import functions as F
    data = [("rep", 1, "2024-01-02 03:04:05"), ("rep", 2, "2024-01-02 03:04:05"), ("rep", 3, "2024-01-02 03:04:05"),
            ("rep", 4, "2024-02-01 00:00:00"), ("solo", 5, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(data, "stem string, seq int, t string").withColumn("ts", F.to_timestamp("t"))
    out = manifest.name_versions(df, "stem", ["seq"], ext=".csv", max_variations=0, stamp_col="ts")
    assert rows(out, "seq", "file_name", "action") == [
        (1, "rep.csv", "keep"), (2, "rep_20240102_030405.csv", "rename"), (3, "rep_20240102_030405-1.csv", "reject"),
        (4, "rep_20240201_000000.csv", "rename"), (5, "solo.csv", "keep")]


def test_identify_tables_hint_and_columns(spark):
    from tessera.plans.consolidate import identify_tables
    from tessera.spec import CatalogSpec
    spec = CatalogSpec.from_config({"metadata": {
        "key": {"a": ["x"], "b": ["x"], "_": []}, "in columns": {"a": ["y"], "b": ["z"], "_": []}}})
    data = [("f1", "_", {"x": "1", "y": "2"}),        # leftover block -> identified as a by columns
            ("f2", "b", {"x": "1", "z": "2", "y": "3"}),  # named b, b's columns present -> b
            ("f3", "_", {"x": "1", "y": "2", "z": "3"}),  # a and b tie, the hint `_` is not tied -> unresolved
            ("f4", "a", {"q": "1"}),                  # named a, its columns missing; `_` needs nothing -> `_`
            ("f5", "_", {"w": "1"})]                  # nothing but the default table fits -> `_`
    rows_df = spark.createDataFrame(data, "_file_path string, tbl string, row map<string,string>")
    got = {r["_file_path"]: r["table"] for r in identify_tables(spark, rows_df, spec).collect()}
    assert got == {"f1": "a", "f2": "b", "f3": None, "f4": "_", "f5": "_"}
