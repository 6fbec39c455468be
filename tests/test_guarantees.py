"""What the composite plans promise: no row, file or batch is lost."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.ranking import running_total, sequence_within
from tessera.functions.regex import extract_groups
from tessera.operators.sort import with_position
from tessera.operators.upsert import fold_files, fold_into, without_sequences
from tessera.plans import catalog as store
from tessera.plans.consolidate import consolidate
from tessera.plans.load import load_related
from tessera.plans.service import run_batch, serve
from tessera.sinks import writers
from tessera.sources import scan
from tessera.sources.rows import text_rows
from tessera.spec import CatalogSpec
from xlsx_fixture import make_xlsx

CONFIG = {
    "files": {"metadata file regex": {"*": r".*\.(json|csv|xlsx)$"}, "data file regex": {"raw": r".*\.txt$"},
              "metadata file formatting": {"csv separator": ";"}},
    "folders": {"get": {"raw": ["get/raw"]}},
    "metadata": {"required tables": [], "key": {"p": ["name"], "c": ["item"], "log": []},
                 "in columns": {"p": ["name", "pk"], "c": ["item", "fk"], "log": ["line"]},
                 "association": {"p": {"PK": {"name": "pk", "int type": True}}, "c": {"FK": {"p": {"name": "fk"}}}}},
}


def _spec(**files):
    cfg = json.loads(json.dumps(CONFIG))
    cfg["files"] |= files
    return CatalogSpec.from_config(cfg)


def _post(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    if not isinstance(content, bytes):
        content = (content if isinstance(content, str) else json.dumps(content)).encode()
    with open(f"{folder}/{name}", "wb") as fh:
        fh.write(content)


def _reasons(result):
    return {os.path.basename(p): why for p, why in rows(result.rejected, "path", "reason")}


# ------------------------------------------------------------------ ranking
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_positions_keep_every_row_without_exchange_reuse(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(1_000_000, numPartitions=7).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("g"), "id")
        out = with_position(df, [("g", True)], ["id"])
        s = out.agg(F.count("*").alias("n"), F.count_distinct("pos").alias("d"), F.min("pos").alias("a"), F.max("pos").alias("b")).first()
        assert (s.n, s.d, s.a, s.b) == (1_000_000, 1_000_000, 1, 1_000_000)
        assert not any(x in out._jdf.queryExecution().toString() for x in ("MapInPandas", "MapInArrow"))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_groups_and_weights_across_partitions(spark):
    data = [(None if i % 5 == 0 else "hot" if i % 2 else f"g{i % 7}", i, i % 4 if i % 9 else None) for i in range(400)]
    df = spark.createDataFrame(data, "g string, o long, w long")
    seen, total, rank = {}, {}, {}
    for g, o, w in sorted(data, key=lambda r: (r[0] or "", r[1])):
        seen[g] = seen.get(g, 0) + 1
        total[g] = total.get(g, 0) + (w or 0)
        rank[o] = (seen[g], total[g])
    got = sequence_within(df, ["g"], ["o"], "r", 9)
    got = running_total(got, ["g"], ["o"], "w", "t", 5)
    assert {r.o: (r.r, r.t) for r in got.collect()} == rank


# ------------------------------------------------------------------ merging
def test_fold_does_not_depend_on_arrival(spark):
    schema = "k int, v string, w string, f int"
    batches = [spark.createDataFrame([r], schema) for r in ((1, "A", None, 1), (1, None, "X", 3), (1, "B", None, 2))]
    at_once = fold_files(batches[0].union(batches[1]).union(batches[2]), ["k"], "f", ())
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        catalog = fold_files(batches[order[0]], ["k"], "f", (), keep_sequences=True)
        for i in order[1:]:
            catalog = fold_into(catalog, batches[i], ["k"], "f", ())
        assert rows(without_sequences(catalog), "k", "v", "w", "f") == rows(at_once, "k", "v", "w", "f") == [(1, "B", "X", 3)]


# ------------------------------------------------------------------ sources
def test_csv_quotes_breaks_and_long_fields(spark, tmp_path):
    value = [('say "hi"', "line1\nline2"), ("a;b", "x" * 200_000), ("plain", "-")]
    df = spark.createDataFrame(value, "a string, b string")
    path = writers.write_csv(df, str(tmp_path / "t"))
    assert rows(scan.scan_csv(spark, path), "a", "b") == sorted(value)
    _post(str(tmp_path / "raw"), "q.csv", 'a;b\n"say ""hi""";"line1\nline2"\n"a;b";' + "x" * 200_000 + "\nplain;-\n")
    got = text_rows(spark, [str(tmp_path / "raw")], ";").where("_error IS NULL")
    assert rows(got.select(F.col("row")["a"].alias("a"), F.col("row")["b"].alias("b")), "a", "b") == sorted(value)


def test_listing_is_complete(spark, tmp_path):
    for name in ("a.txt", ".hidden", "_under", "empty.txt"):
        _post(str(tmp_path), name, "" if name == "empty.txt" else "x")
    got = scan.list_files(spark, str(tmp_path))
    assert [r[0] for r in rows(got, "name")] == [".hidden", "_under", "a.txt", "empty.txt"]
    assert [r[0] for r in rows(scan.list_files(spark, str(tmp_path), glob="*.txt"), "name")] == ["a.txt", "empty.txt"]


def test_start_anchor_belongs_to_every_alternative(spark):
    df = spark.createDataFrame([("a",), ("xb",), ("b",)], "s string")
    assert sorted(r.s for r in df.where(extract_groups("s", "^(?P<g>a)|b")["g"].isNotNull()).collect()) == ["a", "b"]


def test_back_reference(spark):
    df = spark.createDataFrame([("ab-ab",), ("ab-cd",)], "s string")
    got = df.select(extract_groups("s", r"(?P<x_1>\w+)-(?P=x_1)")["x_1"].alias("x"))
    assert sorted(r.x or "" for r in got.collect()) == ["", "ab"]


def test_json_document_round_trip(spark, tmp_path):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    path = writers.write_json_document({"a": a, "b": a.limit(0)}, str(tmp_path / "d"))
    back = scan.scan_json_tables(scan.read_json_documents(spark, path, whole_file=False), ["a", "b"])
    assert sorted((r.tbl, r.row["id"], r.row.get("v")) for r in back.collect()) == [("a", "1", None), ("a", "2", "x")]


# ------------------------------------------------------- files in one batch
def test_a_bad_file_loses_only_itself(spark, tmp_path):
    post = str(tmp_path / "post")
    _post(post, "good.json", {"p": [{"name": "n1", "pk": "1"}], "c": [{"item": "i1", "fk": "1"}]})
    _post(post, "badkey.json", {"p": [{"name": "n2", "pk": "two"}], "c": [{"item": "i2", "fk": "7"}]})
    _post(post, "malformed.json", '{"p": [{"name": ')
    _post(post, "header.csv", "name;pk\n")
    _post(post, "twice.csv", "name;name\na;b\n")
    _post(post, "empty.csv", "")
    _post(post, "latin.csv", "name;pk\né;5\n".encode("latin-1"))
    _post(post, "utf16.csv", "name;pk\né;6\n".encode("utf-16"))
    _post(post, "utf16.json", json.dumps({"p": [{"name": "n9", "pk": "9"}]}).encode("utf-16"))
    _post(post, "book.xlsx", b"no workbook")
    _post(post, "what.bin", "?")
    r = consolidate(spark, _spec(), [post], str(tmp_path / "cat"), write_replicas=False)
    assert _reasons(r) == {"badkey.json": "bad_integer_key", "malformed.json": "no_rows", "header.csv": "no_rows",
                           "twice.csv": "unreadable", "empty.csv": "no_rows", "latin.csv": "unreadable", "book.xlsx": "unreadable",
                           "what.bin": "unknown_file"}
    assert rows(r.catalog["p"], "name", "pk") == [("n1", 1), ("n9", 9), ("é", 6)]
    assert rows(r.catalog["c"], "item", "fk") == [("i1", 1)]


def test_configured_encoding(spark, tmp_path):
    _post(str(tmp_path / "post"), "latin.csv", "name;pk\né;5\n".encode("latin-1"))
    r = consolidate(spark, _spec(), [str(tmp_path / "post")], str(tmp_path / "cat"), write_replicas=False, encoding="iso-8859-1")
    assert rows(r.catalog["p"], "name", "pk") == [("é", 5)] and _reasons(r) == {}


def test_same_name_other_content_gets_its_own_name(spark, tmp_path):
    for folder, text in (("a", "one"), ("b", "two"), ("c", "one")):
        _post(str(tmp_path / "post" / folder), "f.txt", text)
    r = consolidate(spark, _spec(), [str(tmp_path / "post")], str(tmp_path / "cat"), write_replicas=False)
    names = [n for n, in rows(r.publish_plan, "file_name")]
    assert len(names) == len(set(names)) == 2 and "f.txt" in names


# ------------------------------------------------------------ related tables
def test_merged_parents_keep_their_children(spark):
    p = spark.createDataFrame([("1", "n", 1, 0), ("2", "n", 1, 1)], "pk string, name string, _file_seq int, _row_seq long")
    c = spark.createDataFrame([("a", "1", 1, 0), ("b", "2", 1, 1)], "item string, fk string, _file_seq int, _row_seq long")
    out = load_related({}, {"p": p, "c": c}, _spec())
    assert rows(out["p"], "name", "pk") == [("n", 1)]
    assert rows(out["c"], "item", "fk") == [("a", 1), ("b", 1)]


def test_strict_files_resolve_their_own_references(spark):
    cfg = json.loads(json.dumps(CONFIG))
    cfg["metadata"]["association"]["p"]["PK"]["relative value"] = True
    spec = CatalogSpec.from_config(cfg)
    p = spark.createDataFrame([("1", "n", 1, 0)], "pk string, name string, _file_seq int, _row_seq long")
    c = spark.createDataFrame([("a", "1", 1, 0), ("b", "1", 2, 1)], "item string, fk string, _file_seq int, _row_seq long")
    bad = []
    out = load_related({}, {"p": p, "c": c}, spec, strict=True, rejects=bad)
    assert rows(out["c"], "item") == [("a",)] and rows(bad[0], "_file_seq", "reason") == [(2, "unresolved_reference")]
    assert rows(load_related({}, {"p": p, "c": c}, spec)["c"], "item") == [("a",), ("b",)]


# ------------------------------------------------------------------ batches
def test_replicas_and_order_over_batches(spark, tmp_path):
    spec, root = _spec(**{"catalog names": [str(tmp_path / "r.parquet"), str(tmp_path / "r.csv")]}), str(tmp_path / "cat")
    for n, names in enumerate((["z", "y"], ["a", "z"], ["b"])):
        _post(str(tmp_path / f"post{n}"), "m.json", {"p": [{"name": x, "pk": str(ord(x))} for x in names]})
        r = consolidate(spark, spec, [str(tmp_path / f"post{n}")], root)
        assert r.version == n + 1 and r.replica_errors == {}
    assert [x.name for x in r.catalog["p"].orderBy("_file_seq", "_row_seq").collect()] == ["y", "a", "z", "b"]
    for fmt in ("parquet", "csv"):
        folder = writers.replica_folder(spark, str(tmp_path / f"r.{fmt}"))
        assert folder.endswith("v=3")
    assert spark.read.parquet(writers.replica_folder(spark, str(tmp_path / "r.parquet")) + "/p").count() == 4


def test_untouched_tables_are_carried_over(spark, tmp_path):
    spec, root = _spec(), str(tmp_path / "cat")
    _post(str(tmp_path / "1"), "m.json", {"p": [{"name": "n", "pk": "1"}], "log": [{"line": "l"}]})
    _post(str(tmp_path / "2"), "m.json", {"log": [{"line": "m"}]})
    consolidate(spark, spec, [str(tmp_path / "1")], root)
    r = consolidate(spark, spec, [str(tmp_path / "2")], root)
    assert "p" not in os.listdir(f"{root}/v=2") and "log" in os.listdir(f"{root}/v=2")
    assert r.catalog["p"].count() == 1 and r.catalog["log"].count() == 2


def test_replayed_batch_changes_nothing(spark, tmp_path):
    spec, root, post = _spec(), str(tmp_path / "cat"), str(tmp_path / "post")
    _post(post, "m.json", {"log": [{"line": "l"}, {"line": "l"}]})
    path = [f"{post}/m.json"]
    assert run_batch(spark, spec, path, root, listed=True, batch_id=0)["version"] == 1
    assert run_batch(spark, spec, path, root, listed=True, batch_id=0)["version"] is None
    assert store.load(spark, root)["log"].count() == 2


def test_serve_watches_several_folders(spark, tmp_path):
    spec, root = _spec(), str(tmp_path / "cat")
    for n in ("a", "b"):
        _post(str(tmp_path / n), f"{n}.json", {"p": [{"name": n, "pk": str(ord(n))}]})
    serve(spark, spec, [str(tmp_path / "a"), str(tmp_path / "b")], root, str(tmp_path / "ck"), once=True)
    assert rows(store.load(spark, root)["p"], "name") == [("a",), ("b",)]


@pytest.mark.parametrize("name", ["long.csv", "long.xlsx"])
def test_rows_longer_than_the_header_reject_the_file(spark, tmp_path, name):
    grid = [["k", "v"], ["1", "a"], ["2", "b", "lost"]]
    content = make_xlsx({"T": grid}) if name.endswith("xlsx") else "".join(";".join(r) + "\n" for r in grid)
    spare = [["k", "v"], ["1", "a", ""], ["2"]]
    _post(str(tmp_path), name, content)
    _post(str(tmp_path), f"fine_{name}", make_xlsx({"T": spare}) if name.endswith("xlsx") else "k;v\n1;a;;\n2\n")
    got = text_rows(spark, [str(tmp_path)], ";")
    why = {r["_file_name"]: r["_error"] for r in got.where("_error IS NOT NULL").collect()}
    assert why == {name: "UnreadableFile: row 2 has more fields than the header"}
    fine = got.where(F.col("_file_name") == f"fine_{name}").select(F.col("row")["k"].alias("k"), F.col("row")["v"].alias("v"))
    assert rows(fine, "k", "v") == [("1", "a"), ("2", None)]
