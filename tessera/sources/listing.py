"""SRC-7 in tasks: folders listed level by level.

The frontier of folders is a frame; tasks list them and give back files and the
next frontier, so no path passes the driver, and a level is listed by as many
tasks as it has folders. Roots of file systems that Arrow cannot open in a task
are listed through Hadoop's client instead (``scan.list_files``)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize
from tessera.sources.scan import list_files

FOUND = "path string, name string, modificationTime timestamp, length long, folder boolean"
_SCHEMA = pa.schema([("path", pa.string()), ("name", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")),
                     ("length", pa.int64()), ("folder", pa.bool_())])
OUT_ROWS = 10_000
FOLDERS_A_TASK = 64


def _scheme(root: str) -> str:
    return root.split(":", 1)[0] if "://" in root or root.startswith("file:") else ""


def open_folder(path: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of ``path``, ``path`` inside it, and what to put before its paths."""
    scheme = _scheme(path)
    if scheme in ("", "file"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"), "file:"
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs, inner, path[: len(path) - len(inner)] if path.endswith(inner) else f"{scheme}://"


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[tuple] = []
        for folder in b.column(0).to_pylist():
            fs, inner, prefix = open_folder(folder)
            # a folder may go meanwhile
            for f in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
                ms = None if f.mtime_ns is None else f.mtime_ns // 1_000_000 * 1_000
                out.append((prefix + f.path, f.base_name, ms, f.size, f.type == pafs.FileType.Directory))
                if len(out) >= OUT_ROWS:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def list_tree(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """``(path, name, modificationTime, length)`` of all files below ``roots``, hidden and
    empty ones included; the same rows as ``scan.list_files``. A missing root
    raises ``FileNotFoundError``."""
    own, other = [], []
    for root in roots:
        try:
            fs, inner, _ = open_folder(root.rstrip("/"))
            kind = fs.get_file_info(inner).type
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            other.append(root)
            continue
        if kind == pafs.FileType.NotFound:
            raise FileNotFoundError(root)
        (own if kind == pafs.FileType.Directory else other).append(root)
    found = list_files(spark, other) if other else None
    frontier = spark.createDataFrame([(r.rstrip("/"),) for r in own], "path string") if own else None
    while frontier is not None:
        n = max(1, -(-frontier.count() // FOLDERS_A_TASK))
        level = materialize(frontier.repartition(n).mapInArrow(_list, FOUND))
        files = level.where("NOT folder").drop("folder")
        found = files if found is None else found.unionByName(files)
        frontier = level.where("folder").select("path")
        if frontier.isEmpty():
            frontier = None
    return found
