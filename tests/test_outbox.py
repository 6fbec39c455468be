"""File actions as deliveries, the trash, held files of one name, listings in tasks."""

import json
import os

import pytest

from conftest import rows
from tessera.plans import outbox
from tessera.plans.service import mirror, run_batch
from tessera.sources import scan
from tessera.sources.listing import list_tree
from tessera.spec import CatalogSpec


def _post(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(content.encode())


def _spec(tmp_path, **more):
    cfg = {"files": {"metadata file regex": {"*": r".*\.json$"}, "data file regex": {"raw": r".*\.txt$"}},
           "folders": {"get": {"raw": [str(tmp_path / "get")]}, "store": [str(tmp_path / "store")], "trash": str(tmp_path / "trash")},
           "metadata": {"required tables": [], "key": {"p": ["name"]}, "in columns": {"p": ["file"]},
                        "data filenames": {"p": ["file"]}, "data published flag": {"p": ["done"]},
                        "association": {"p": {"PK": {"name": "pk", "int type": True}}}}}
    return CatalogSpec.from_config(cfg | more)


def _actions(df):
    return sorted((r.version, r.kind, r.action, os.path.basename(r.path), r.file_name, r.reason) for r in df.collect())


def test_actions_are_delivered_once(spark, tmp_path):
    spec, root = _spec(tmp_path), str(tmp_path / "cat")
    _post(str(tmp_path / "1/a.json"), json.dumps({"p": [{"name": "n", "pk": "1", "file": "x.txt"}]}))
    _post(str(tmp_path / "1/x.txt"), "data")
    _post(str(tmp_path / "1/bad.json"), json.dumps({"p": [{"name": "m", "pk": "one", "file": "y.txt"}]}))
    _post(str(tmp_path / "get/x.txt"), "older")
    run_batch(spark, spec, [str(tmp_path / "1")], root, write_replicas=False, batch_id=0)
    first = outbox.pending(spark, root)
    assert _actions(first) == [(1, "publish", "overwrite", "x.txt", "x.txt", None), (1, "reject", "reject", "bad.json", None, "bad_integer_key"),
                               (1, "store", "move", "a.json", "a.json", None), (1, "trash", "move", "bad.json", "bad.json", "bad_integer_key")]
    last = first.collect()[-1]
    outbox.acknowledge(spark, root, (last["version"], last["n"]))
    run_batch(spark, spec, [str(tmp_path / "1")], root, write_replicas=False, batch_id=0)  # a replay
    assert outbox.pending(spark, root).count() == 0 and outbox.actions(spark, root).count() == 4
    assert outbox.pending(spark, root, "another reader").count() == 4


@pytest.mark.parametrize("overwrite", [True, False])
def test_trash_options(spark, tmp_path, overwrite):
    spec = _spec(tmp_path, **{"overwrite data in trash": overwrite, "discard invalid data files": True, "overwrite data in get": False})
    _post(str(tmp_path / "1/same.bin"), "s")
    _post(str(tmp_path / "1/other.bin"), "new")
    _post(str(tmp_path / "trash/same.bin"), "s")
    _post(str(tmp_path / "trash/other.bin"), "old")
    _post(str(tmp_path / "1/a.json"), json.dumps({"p": [{"name": "n", "pk": "1", "file": "x.txt"}]}))
    _post(str(tmp_path / "1/x.txt"), "data")
    _post(str(tmp_path / "get/x.txt"), "older")
    run_batch(spark, spec, [str(tmp_path / "1")], str(tmp_path / "cat"), write_replicas=False)
    trash = outbox.actions(spark, str(tmp_path / "cat")).where("kind = 'trash'")
    assert sorted((r.file_name, r.action, r.reason) for r in trash.collect()) == [
        ("other.bin", "overwrite" if overwrite else "rename_older", "unknown_file"),
        ("same.bin", "overwrite" if overwrite else "drop_identical", "unknown_file"), ("x.txt", "move", "replaced")]
    assert [r.path for r in trash.where("reason = 'replaced'").collect()] == [f"file:{tmp_path}/get/x.txt"]


def test_held_files_of_one_name_get_names_of_their_own(spark, tmp_path):
    spec, root = _spec(tmp_path), str(tmp_path / "cat")
    _post(str(tmp_path / "0/m.json"), json.dumps({"p": [{"name": "n", "pk": "1", "file": "other.txt"}]}))
    _post(str(tmp_path / "0/a/f.txt"), "one")
    _post(str(tmp_path / "0/b/f.txt"), "two")
    os.utime(tmp_path / "0/a/f.txt", (1_700_000_000, 1_700_000_000))
    assert run_batch(spark, spec, [str(tmp_path / "0")], root, write_replicas=False)["held"] == 2
    _post(str(tmp_path / "1/n.json"), json.dumps({"p": [{"name": "k", "pk": "2", "file": "f.txt"}]}))
    assert run_batch(spark, spec, [str(tmp_path / "1")], root, write_replicas=False)["published"] == 2
    names = [r.file_name for r in outbox.actions(spark, root).where("kind = 'publish'").collect()]
    assert len(set(names)) == 2 and "f.txt" in names and None not in names


def test_listing_in_tasks_equals_the_listing_of_the_client(spark, tmp_path):
    for name in ("a.txt", ".hidden", "_under", "sub/b c+d.txt", "sub/deep/er/e%20.txt", "empty.txt"):
        _post(str(tmp_path / name), "" if name == "empty.txt" else name)
    os.makedirs(tmp_path / "none")
    cols = ("path", "name", "modificationTime", "length")
    for roots in ([str(tmp_path)], [f"file:{tmp_path}/sub", f"file://{tmp_path}/none", f"{tmp_path}/a.txt"]):
        assert rows(list_tree(spark, roots), *cols) == rows(scan.list_files(spark, roots), *cols)
    with pytest.raises(FileNotFoundError):
        list_tree(spark, [str(tmp_path / "gone")])


def test_mirror_copies_what_a_folder_lacks(spark, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    spec = CatalogSpec.from_config({"folders": {"get": {"raw": [a, b], "other": [c]}}, "metadata": {"key": {"p": ["k"]}}})
    for path in (f"{a}/1.txt", f"{a}/2.txt", f"{b}/2.txt", f"{b}/3.txt", f"{c}/4.txt"):
        _post(path, path)
    root = str(tmp_path / "cat")
    assert mirror(spark, spec, root) == 2
    got = sorted((r.kind, r.action, r.path, r.folder) for r in outbox.pending(spark, root).collect())
    assert got == [("mirror", "copy", f"file:{a}/1.txt", b), ("mirror", "copy", f"file:{b}/3.txt", a)]
