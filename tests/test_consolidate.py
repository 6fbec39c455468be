"""End-to-end batches over real files: multi-table JSON with a table drawn
from the file name, a CSV update, a workbook, data files linked to rows."""

import json
import os

from pyspark.sql import functions as F

from conftest import rows
from tessera.plans.consolidate import consolidate
from tessera.spec import CatalogSpec
from xlsx_fixture import make_xlsx

CONFIG = {
    "name": "monitor",
    "folders": {"get": {"raw": ["get/raw"]}, "store": ["store/a"]},
    "files": {
        "metadata file regex": {"*": r".*\.(json|csv|xlsx)$"},
        "data file regex": {"raw": r".*\.txt$"},
        "input to ignore": ["re:.*\\.tmp$"],
        "metadata file formatting": {"csv separator": ";"},
    },
    "metadata": {
        "required tables": [],
        "key": {"project": ["correlationKey"], "rawFiles": ["correlationKey", "fileName"],
                "_": ["jsonFileName"]},
        "in columns": {"project": ["issue"], "rawFiles": ["sensor"], "_": ["clientName"]},
        "association": {
            "project": {"PK": {"name": "correlationKey", "int type": False, "delete orphan": False}},
            "rawFiles": {"FK": {"project": {"name": "correlationKey", "delete orphan": True}}},
        },
        "data filenames": {"rawFiles": ["fileName"]},
        "data published flag": {"rawFiles": ["rawFilesPublished"]},
        "add filename": {"_": "jsonFileName"},
        "filename data format": {"_": r"(\w+)_(\d{8})_(?P<correlationKey>\w+-\w+)\.json$"},
        "sort by": {"rawFiles": {"by": ["fileName"], "ascending": True}},
    },
}


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    mode = "wb" if isinstance(data, bytes) else "w"
    with open(path, mode) as fh:
        fh.write(data)


def test_required_tables_reject(spark, tmp_path):
    cfg = json.loads(json.dumps(CONFIG))
    cfg["metadata"]["required tables"] = ["project"]
    post = str(tmp_path / "p")
    _write(f"{post}/only_raw.json", json.dumps({"rawFiles": [{"correlationKey": "k", "fileName": "f.txt",
                                                              "sensor": "s"}]}))
    _write(f"{post}/monitor_20260211_abc-def.json", json.dumps({"project": {"correlationKey": "k", "issue": "1"},
                                                               "clientName": "A"}))
    r = consolidate(spark, CatalogSpec.from_config(cfg), [post], str(tmp_path / "c"), write_replicas=False)
    assert [(os.path.basename(p), why) for p, why in rows(r.rejected, "path", "reason")] == [
        ("only_raw.json", "no_usable_table")]
    assert rows(r.catalog["project"], "correlationKey") == [("k",)]


def test_batches_end_to_end(spark, tmp_path):
    spec = CatalogSpec.from_config(CONFIG)
    post, cat = str(tmp_path / "post1"), str(tmp_path / "catalog")
    doc = {"project": {"correlationKey": "abc-def", "issue": "7"},
           "rawFiles": [{"correlationKey": "abc-def", "fileName": "8059Log_1.txt", "sensor": "S1"},
                        {"correlationKey": "abc-def", "fileName": "later.txt", "sensor": "S1"},
                        {"correlationKey": "abc-def", "fileName": "later.txt", "sensor": "S2"}],
           "clientName": "ACME"}
    _write(f"{post}/monitor_20260211_abc-def.json", json.dumps(doc))
    _write(f"{post}/8059Log_1.txt", "raw bytes")
    _write(f"{post}/stray.txt", "nobody references me")
    _write(f"{post}/notes.doc", "unknown kind")
    _write(f"{post}/skip.tmp", "ignored")
    r = consolidate(spark, spec, [post], cat, write_replicas=False)
    assert r.version == 1
    c = r.catalog
    assert rows(c["project"], "correlationKey", "issue") == [("abc-def", "7")]
    assert rows(c["rawFiles"], "fileName", "sensor", "rawFilesPublished") == [
        ("8059Log_1.txt", "S1", "True"), ("later.txt", "S1, S2", "False")]
    assert rows(c["_"], "jsonFileName", "clientName", "correlationKey") == [
        ("monitor_20260211_abc-def.json", "ACME", "abc-def")]
    assert [os.path.basename(p) for (p,) in rows(r.publish_plan, "path")] == ["8059Log_1.txt"]
    assert rows(r.publish_plan, "folder") == [("get/raw",)]
    assert sorted(os.path.basename(p) for (p,) in rows(r.pending, "path")) == ["stray.txt"]
    assert [(os.path.basename(p), why) for p, why in rows(r.rejected, "path", "reason")] == [
        ("notes.doc", "unknown_file")]
    assert rows(r.store_plan, "folder") == [("store/a",)]

    # batch 2: a CSV updates one raw file row, a workbook adds a project without
    # rawFiles, a file lacking the required table is rejected, the data file arrives.
    post2 = str(tmp_path / "post2")
    _write(f"{post2}/update.csv", "correlationKey;fileName;sensor;rawFilesPublished\nabc-def;later.txt;S3;NULL\n")
    _write(f"{post2}/sheet.xlsx", make_xlsx({"project": [["correlationKey", "issue"], ["xyz-1", 9]]}))
    _write(f"{post2}/orphan.json", json.dumps({"rawFiles": [{"correlationKey": "nope", "fileName": "a.txt",
                                                             "sensor": "S"}]}))
    _write(f"{post2}/later.txt", "now here")
    r2 = consolidate(spark, spec, [post2], cat, write_replicas=False)
    assert r2.version == 2
    c2 = r2.catalog
    assert rows(c2["project"], "correlationKey", "issue") == [("abc-def", "7"), ("xyz-1", "9")]
    assert rows(c2["rawFiles"], "fileName", "sensor", "rawFilesPublished") == [
        ("8059Log_1.txt", "S1", "True"), ("later.txt", "S3", "True")]
    assert rows(r2.rejected) == []
    # the orphan file's row points at no project: removed by the FK orphan rule
    assert "a.txt" not in {r["fileName"] for r in c2["rawFiles"].collect()}
    assert [os.path.basename(p) for (p,) in rows(r2.publish_plan, "path")] == ["later.txt"]
    stats = {(t, o): n for t, o, n in rows(r2.stats.groupBy("table", "outcome").agg(F.sum("n").alias("n")))}
    assert stats[("rawFiles", "updated")] == 1 and stats[("project", "added")] == 1
    assert stats[("rawFiles", "orphan_deleted")] == 1  # the row pointing at project "nope"


def test_service_holds_then_publishes(spark, tmp_path):
    from tessera.plans.service import run_batch
    spec = CatalogSpec.from_config(CONFIG)
    cat = str(tmp_path / "cat")

    def doc(name):
        return json.dumps({"project": {"correlationKey": "k-1", "issue": "1"},
                           "rawFiles": [{"correlationKey": "k-1", "fileName": name, "sensor": "s"}]})

    p0 = str(tmp_path / "in0")
    _write(f"{p0}/monitor_20260211_k-1.json", doc("first.txt"))
    run_batch(spark, spec, [p0], cat, write_replicas=False)
    p1 = str(tmp_path / "in1")
    _write(f"{p1}/early.txt", "data before its metadata")
    s1 = run_batch(spark, spec, [p1], cat, write_replicas=False)
    assert s1["held"] == 1 and s1["published"] == 0
    p2 = str(tmp_path / "in2")
    _write(f"{p2}/monitor_20260212_k-1.json", doc("early.txt"))
    s2 = run_batch(spark, spec, [p2], cat, write_replicas=False)
    assert s2["published"] == 1 and s2["held"] == 0
    # the same folder again: nothing new to process (SET-2)
    s3 = run_batch(spark, spec, [p2], cat, write_replicas=False)
    assert s3["version"] is None


def test_repost_is_idempotent_and_copies_count_once(spark, tmp_path):
    spec = CatalogSpec.from_config(CONFIG)
    cat = str(tmp_path / "cat")
    doc = json.dumps({"project": {"correlationKey": "k-9", "issue": "3"},
                      "rawFiles": [{"correlationKey": "k-9", "fileName": "z.txt", "sensor": "a"},
                                   {"correlationKey": "k-9", "fileName": "z.txt", "sensor": "a"}]})
    # the same file posted in two folders is processed once (same name, same content)
    _write(str(tmp_path / "a" / "monitor_20260211_k-9.json"), doc)
    _write(str(tmp_path / "b" / "monitor_20260211_k-9.json"), doc)
    r1 = consolidate(spark, spec, [str(tmp_path / "a"), str(tmp_path / "b")], cat, write_replicas=False)
    assert r1.files.count() == 1
    assert ("rawFiles", "duplicate", 1) in rows(r1.stats, "table", "outcome", "n")
    first = {t: rows(df.drop("_file_seq", "_row_seq")) for t, df in r1.catalog.items()}
    assert rows(r1.catalog["rawFiles"], "fileName", "sensor") == [("z.txt", "a")]
    # re-posting the same document adds nothing
    r2 = consolidate(spark, spec, [str(tmp_path / "a")], cat, write_replicas=False)
    again = {t: rows(df.drop("_file_seq", "_row_seq")) for t, df in r2.catalog.items()}
    assert again == first


def test_publish_actions_against_existing_targets(spark, tmp_path):
    cfg = json.loads(json.dumps(CONFIG))
    get = str(tmp_path / "get")
    cfg["folders"]["get"] = {"raw": [get]}
    cfg["overwrite data in get"] = False
    spec = CatalogSpec.from_config(cfg)
    _write(f"{get}/same.txt", "A")
    _write(f"{get}/changed.txt", "old")
    post = str(tmp_path / "post")
    _write(f"{post}/same.txt", "A")
    _write(f"{post}/changed.txt", "new")
    _write(f"{post}/fresh.txt", "n")
    r = consolidate(spark, spec, [post], str(tmp_path / "cat"), write_replicas=False)
    got = sorted((os.path.basename(p), a) for p, a in rows(r.publish_plan, "path", "action"))
    assert got == [("changed.txt", "rename_older"), ("fresh.txt", "move"), ("same.txt", "drop_identical")]


def test_reload_from_newest_replica(spark, tmp_path):
    cfg = json.loads(json.dumps(CONFIG))
    rep = str(tmp_path / "rep")
    cfg["files"]["catalog names"] = [f"{rep}/a.parquet", f"{rep}/b.csv"]
    spec = CatalogSpec.from_config(cfg)
    post = str(tmp_path / "p1")
    _write(f"{post}/monitor_20260211_k-1.json", json.dumps({
        "project": {"correlationKey": "k-1", "issue": "1"},
        "rawFiles": [{"correlationKey": "k-1", "fileName": "f.txt", "sensor": "s"}], "clientName": "A"}))
    consolidate(spark, spec, [post], str(tmp_path / "cat1"))
    # a fresh store: the catalog comes back from the newest replica
    post2 = str(tmp_path / "p2")
    _write(f"{post2}/monitor_20260212_k-2.json", json.dumps({"project": {"correlationKey": "k-2", "issue": "2"}}))
    r = consolidate(spark, spec, [post2], str(tmp_path / "cat2"), write_replicas=False)
    assert rows(r.catalog["project"], "correlationKey", "issue") == [("k-1", "1"), ("k-2", "2")]
    assert rows(r.catalog["rawFiles"], "fileName", "sensor") == [("f.txt", "s")]


def test_employees_csv_timestamp_and_update(spark, tmp_path):
    cfg = {"files": {"metadata file regex": {"*": r".*\.csv$"}, "metadata file formatting": {"csv separator": ","}},
           "metadata": {"key": {"_": ["employee_id"]}, "in columns": {"_": ["salary"]},
                        "add filename": {"_": "source_file"}, "add file timestamp": {"_": "file_timestamp"}}}
    spec = CatalogSpec.from_config(cfg)
    post, cat = str(tmp_path / "p"), str(tmp_path / "c")
    _write(f"{post}/employees_a.csv", "employee_id,name,salary\n1,Ana,10\n2,Bo,20\n3,Cy,30\n")
    _write(f"{post}/employees_b.csv", "employee_id,name,salary\n4,Di,40\n5,Ed,50\n6,Flo,60\n3,Cy,30\n")
    r1 = consolidate(spark, spec, [post], cat, write_replicas=False)
    emp = r1.catalog["_"]
    assert emp.count() == 6
    got = {r["employee_id"]: (r["salary"], r["source_file"]) for r in emp.collect()}
    assert got["1"] == ("10", "employees_a.csv") and got["6"] == ("60", "employees_b.csv")
    assert all(r["file_timestamp"].endswith("Z") and "T" in r["file_timestamp"] for r in emp.collect())
    post2 = str(tmp_path / "p2")
    _write(f"{post2}/employees_c.csv", "employee_id,name,salary\n2,Bo,25\n")
    r2 = consolidate(spark, spec, [post2], cat, write_replicas=False)
    after = {r["employee_id"]: r["salary"] for r in r2.catalog["_"].collect()}
    assert after == {"1": "10", "2": "25", "3": "30", "4": "40", "5": "50", "6": "60"}
    stats = {o: n for o, n in rows(r2.stats.groupBy("outcome").agg(F.sum("n")))}
    assert stats == {"updated": 1}


def test_unmapped_leftovers_skipped_unless_forced(spark, tmp_path):
    base = {"files": {"metadata file regex": {"*": r".*\.json$"}, "table names": {"project": "Projects"}},
            "metadata": {"key": {"project": ["correlationKey"], "notes": ["note"]},
                         "in columns": {"notes": ["note"]}}}
    post = str(tmp_path / "p")
    _write(f"{post}/d.json", json.dumps({"project": {"correlationKey": "k"}, "note": "hello"}))
    r = consolidate(spark, CatalogSpec.from_config(base), [post], str(tmp_path / "c1"), write_replicas=False)
    assert "notes" not in r.catalog and rows(r.rejected) == []
    forced = json.loads(json.dumps(base))
    forced["metadata"]["force table identification"] = True
    r2 = consolidate(spark, CatalogSpec.from_config(forced), [post], str(tmp_path / "c2"), write_replicas=False)
    assert rows(r2.catalog["notes"], "note") == [("hello",)]


def test_service_expires_held_files_when_clean_is_due(spark, tmp_path):
    from tessera.plans.service import run_batch
    cfg = json.loads(json.dumps(CONFIG))
    cfg["clean period in hours"] = 1
    spec = CatalogSpec.from_config(cfg)
    cat = str(tmp_path / "cat")
    p0 = str(tmp_path / "in0")
    _write(f"{p0}/monitor_20260211_k-1.json", json.dumps({
        "project": {"correlationKey": "k-1", "issue": "1"},
        "rawFiles": [{"correlationKey": "k-1", "fileName": "other.txt", "sensor": "s"}]}))
    _write(f"{p0}/lonely.txt", "never referenced")
    s0 = run_batch(spark, spec, [p0], cat, write_replicas=False, now="2030-01-01 00:00:00")
    assert s0["held"] == 1 and s0["expired"] == 0  # first clean delayed by one period
    p1 = str(tmp_path / "in1")
    _write(f"{p1}/x.doc", "unrelated")
    s1 = run_batch(spark, spec, [p1], cat, write_replicas=False, now="2030-01-01 00:30:00")
    assert s1["held"] == 1 and s1["expired"] == 0  # not due yet
    p2 = str(tmp_path / "in2")
    _write(f"{p2}/y.doc", "unrelated")
    s2 = run_batch(spark, spec, [p2], cat, write_replicas=False, now="2030-01-01 02:00:00")
    assert s2["expired"] == 1 and s2["held"] == 0
