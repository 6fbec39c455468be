"""Heterogeneous metadata files as long rows.

Metadata files differ in format and in columns from one file to the next, so
every file becomes rows of ``(_file_path, _file_name, _file_mtime, tbl,
_row_seq, row map<string,string>, _error)``:

* JSON documents: natively (``binaryFile``, decoded by byte order mark, then
  ``from_json``), see ``scan.py``;
* CSV and XLSX: ``binaryFile`` + ``mapInArrow``; each task parses its own
  files, record by record and event by event (``xlsx.py``), in output batches of
  bounded size. Large CSV files are dealt out by byte ranges (``split_csv.py``);
* Parquet: natively, columns turned into a map. Every file is decoded once in a
  task beforehand; files whose columns agree are read together.

``tbl`` is the table named inside the file (JSON root key, worksheet name)
or the default table ``_``; RTE-1 decides the rest. A file that cannot be
read, for whatever reason, gives one row with ``_error`` set and ``row`` null:
it loses only itself.
"""

from __future__ import annotations

import csv
import io
import json
import sys
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.operators.transforms import FILE_MTIME, FILE_NAME, FILE_PATH, ROW_SEQ
from tessera.sources.encodings import decoded, guess_encoding
from tessera.sources.scan import PANDAS_DEFAULT_NA, decoded_documents, scan_json_tables
from tessera.sources.split_csv import split_csv_rows
from tessera.sources.xlsx import UnreadableFile, worksheets
from tessera.spec import DEFAULT_TABLE

ERROR = "_error"
OUT_ROWS = 5_000   # parsed rows handed to Spark at a time
OUT_CHARS = 4 << 20

LONG_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField(FILE_MTIME, T.TimestampType()),
    T.StructField("tbl", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("keys", T.ArrayType(T.StringType())),
    T.StructField("vals", T.ArrayType(T.StringType())),
    T.StructField(ERROR, T.StringType()),
])

_BOMS = [(b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe\x00\x00", "utf-32-le"), (b"\x00\x00\xfe\xff", "utf-32-be"),
         (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")]


def decode(data: bytes, default: str = "utf-8") -> str:
    """Text by byte order mark, else by the configured encoding; undecodable
    bytes raise, so the file is rejected rather than altered."""
    for bom, enc in _BOMS:
        if data.startswith(bom):
            return data[len(bom):].decode(enc)
    return data.decode(default)


def _fitted(vals: list, header: list, number: int) -> list:
    """``vals`` at the header's length: short rows end in None, fields beyond the
    header must be empty. ``number`` is the row's, for the reason."""
    if any(v not in (None, "") for v in vals[len(header):]):
        raise UnreadableFile(f"row {number} has more fields than the header")
    return (vals + [None] * len(header))[:len(header)]


def parse_csv(data: bytes, sep: str, encoding: str = "utf-8"):
    """Yield (header, all-text row); pandas' default missing-value text -> None.
    Fields may be of any length."""
    na = set(PANDAS_DEFAULT_NA)
    csv.field_size_limit(sys.maxsize)
    reader = csv.reader(io.StringIO(decode(data, encoding), newline=""), delimiter=sep)
    header = next((row for row in reader if row), None)  # blank lines before it do not count
    if header is None:
        return
    if len(set(header)) < len(header):
        raise UnreadableFile("duplicate column names")
    for n, row in enumerate(reader, 1):
        if row:
            yield header, [None if v in na else v for v in _fitted(row, header, n)]


def parse_xlsx(data: bytes):
    """Yield ``(sheet name, header, rows)`` for every worksheet with a header row; a
    row has the header's length, missing-value texts are None."""
    na = set(PANDAS_DEFAULT_NA)
    for name, grid in worksheets(data):
        top = next(grid, None)
        if top is None:
            continue
        header = [h if h is not None else "" for h in top]
        yield name, header, ([None if v in na else v for v in _fitted(r, header, n)] for n, r in enumerate(grid, 1))


def _parse(path: str, data: bytes, sep: str, encoding: str, sheet_tables: Mapping[str, str]):
    """Yield (table, header, values) of one file."""
    if path.lower().endswith((".xlsx", ".xlsm")):
        for sheet, header, rows in parse_xlsx(data):
            if len(set(header)) < len(header):
                raise UnreadableFile("duplicate column names")
            for vals in rows:
                yield sheet_tables.get(sheet, sheet), header, vals
    else:
        for header, vals in parse_csv(data, sep, encoding):
            yield DEFAULT_TABLE, header, vals


def _make_parser(sep: str, encoding: str, sheet_tables: Mapping[str, str]):
    arrow = to_arrow_schema(LONG_SCHEMA)

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def run(batches):
        for b in batches:
            for path, mtime, content, guess in zip(*b.columns):
                path, mtime, rows, held, pos = path.as_py(), mtime.as_py(), [], 0, 0
                try:
                    for tbl, header, vals in _parse(path, content.as_py(), sep, guess.as_py() or encoding, sheet_tables):
                        rows.append((path, mtime, tbl, pos, header, vals, None))
                        held += sum(len(v) for v in vals if v)
                        pos += 1
                        if len(rows) >= OUT_ROWS or held >= OUT_CHARS:
                            yield batch(rows)
                            rows, held = [], 0
                except Exception as e:  # whatever is wrong with a file, it is this file's fault
                    # the rows before the fault are dropped with the file, by its error row
                    rows.append((path, mtime, DEFAULT_TABLE, pos, None, None, f"{type(e).__name__}: {e}"[:500]))
                if rows:
                    yield batch(rows)
    return run


def _guessed(files: DataFrame, encodings: DataFrame | None) -> DataFrame:
    """``files`` with the ``encoding`` that the model finds for each, null without a model.
    One short row a file of the batch goes to every task; contents stay where they are."""
    if encodings is None:
        return files.withColumn("encoding", F.lit(None).cast("string"))
    texts = files.where(~F.regexp_like(F.lower("path"), F.lit(r"\.xls[xm]$")))
    return files.join(F.broadcast(guess_encoding(texts, encodings)), "path", "left")


def parsed_rows(files: DataFrame, sep: str, encoding: str = "utf-8", sheet_tables: Mapping[str, str] | None = None,
                encodings: DataFrame | None = None) -> DataFrame:
    """``files(path, modificationTime, content)``, CSV or XLSX by name -> long rows. Text without
    a byte order mark is in ``encoding``, or in what the model ``encodings`` finds for it."""
    files = _guessed(files, encodings).select("path", F.col("modificationTime").alias(FILE_MTIME), "content", "encoding")
    parsed = files.mapInArrow(_make_parser(sep, encoding, dict(sheet_tables or {})), LONG_SCHEMA)
    return parsed.select(
        F.col("path").alias(FILE_PATH), F.regexp_extract("path", r"([^/]*)$", 1).alias(FILE_NAME),
        FILE_MTIME, "tbl", F.col("pos").alias(ROW_SEQ),
        F.map_from_arrays("keys", "vals").alias("row"), ERROR)


def text_rows(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str = "utf-8",
              sheet_tables: Mapping[str, str] | None = None, encodings: DataFrame | None = None) -> DataFrame:
    """CSV / XLSX files -> long rows (one task parses whole files)."""
    return parsed_rows(spark.read.format("binaryFile").load(list(paths)), sep, encoding, sheet_tables, encodings)


def json_rows(spark: SparkSession, paths: Sequence[str], tables: Sequence[str], encoding: str = "UTF-8",
              encodings: DataFrame | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").load(list(paths)).select(
        "path", F.col("modificationTime").alias(FILE_MTIME), "content")
    known = (decoded_documents(files, default=encoding) if encodings is None else
             _guessed(files, encodings).withColumn("value", decoded("content", "encoding")))
    docs = known.select(
        F.col("path").alias(FILE_PATH), F.regexp_extract("path", r"([^/]*)$", 1).alias(FILE_NAME), FILE_MTIME, "value")
    long = scan_json_tables(docs, tables)
    # order inside a document's table = position in its list
    return long.select(FILE_PATH, FILE_NAME, FILE_MTIME, "tbl", F.col("_pos").cast("long").alias(ROW_SEQ), "row",
                       F.lit(None).cast("string").alias(ERROR))


def _probe(batches):
    """Decodes whole Parquet files: their columns, or why they cannot be read."""
    for b in batches:
        out = []
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            try:
                file = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                names = [f.name for f in file.schema_arrow]
                if len({n.lower() for n in names}) < len(names):
                    raise UnreadableFile("duplicate column names")
                for _ in file.iter_batches(OUT_ROWS):
                    pass
                out.append((path, json.dumps([(f.name, str(f.type)) for f in file.schema_arrow]), None))
            except Exception as e:  # whatever is wrong with a file, it is this file's fault
                out.append((path, None, f"{type(e).__name__}: {e}"[:500]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["path", "columns", "error"])


def _agreeing(columns: Mapping[str, list]) -> list[list[str]]:
    """Paths in groups in which no column name has two types or spellings."""
    groups: list[tuple[dict, list[str]]] = []
    for path, cols in columns.items():
        mine = {name.lower(): (name, kind) for name, kind in cols}
        for seen, paths in groups:
            if all(seen.get(k, v) == v for k, v in mine.items()):
                seen |= mine
                paths.append(path)
                break
        else:
            groups.append((mine, [path]))
    return [paths for _, paths in groups]


def _parquet_group(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    cols = df.columns
    row = F.map_filter(F.create_map(*[x for c in cols for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]),
                       lambda k, v: v.isNotNull()) if cols else F.create_map().cast("map<string,string>")
    # the path as listings write it: not URL-encoded, one slash after the scheme of a local file
    path = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    return df.select(path.alias(FILE_PATH), F.regexp_extract(path, r"([^/]*)$", 1).alias(FILE_NAME),
                     F.col("_metadata.file_modification_time").alias(FILE_MTIME), F.lit(DEFAULT_TABLE).alias("tbl"),
                     F.col("_metadata.row_index").alias(ROW_SEQ), row.alias("row"), F.lit(None).cast("string").alias(ERROR))


def _unreadable(spark: SparkSession, why: Mapping[str, str]) -> DataFrame:
    rows = [(p, p.rsplit("/", 1)[-1], None, DEFAULT_TABLE, 0, None, e) for p, e in why.items()]
    return spark.createDataFrame(rows, f"{FILE_PATH} string, {FILE_NAME} string, {FILE_MTIME} timestamp, tbl string, "
                                       f"{ROW_SEQ} long, row map<string,string>, {ERROR} string")


def parquet_rows(spark: SparkSession, paths: Sequence[str], unprobed: Sequence[str] = ()) -> DataFrame:
    """Parquet files -> long rows. ``paths`` are decoded in tasks first, so that a
    broken file costs no other, and read in groups whose columns agree; a type that
    Spark cannot read rejects the files that have it. ``unprobed`` files (too large
    to be held in a task) are read as they are. The driver holds one row a file."""
    probed = (spark.read.format("binaryFile").load(list(paths)).select("path", "content")
              .mapInArrow(_probe, "path string, columns string, error string").collect()) if paths else []
    bad = {r["path"]: r["error"] for r in probed if r["error"]}
    groups = _agreeing({r["path"]: json.loads(r["columns"]) for r in probed if not r["error"]}) + [[p] for p in unprobed]
    out = _unreadable(spark, {})
    while groups:
        group = groups.pop()
        try:
            out = out.unionByName(_parquet_group(spark, group))
        except AnalysisException as e:
            if len(group) > 1:
                groups += [[p] for p in group]
            else:
                bad[group[0]] = f"{type(e).__name__}: {e}"[:500]
    return out.unionByName(_unreadable(spark, bad)) if bad else out


def metadata_rows(spark: SparkSession, paths: Sequence[str], tables: Sequence[str], sep: str,
                  encoding: str = "utf-8", sheet_tables: Mapping[str, str] | None = None,
                  large: Sequence[str] = (), encodings: DataFrame | None = None) -> DataFrame | None:
    """All metadata files of a batch as one long frame, whatever their format and
    size. ``large`` files are not read whole by one task: CSV is split, Parquet is
    not decoded beforehand, other formats are rejected. ``encodings``: a model that finds
    the encoding of JSON and CSV files (``encodings.learn_encodings``)."""
    big, by_kind = set(large), {}
    kinds = {"xlsm": "text", "xlsx": "text", "csv": "text", "txt": "text", "json": "json", "parquet": "parquet"}
    for p in paths:
        ext = p.rsplit(".", 1)[-1].lower() if "." in p.rsplit("/", 1)[-1] else ""
        kind = kinds.get(ext)
        if kind is None:
            continue
        if p in big:
            utf8 = encoding.lower().replace("-", "") == "utf8"
            kind = "split" if ext in ("csv", "txt") and utf8 else "unprobed" if kind == "parquet" else "too large"
        by_kind.setdefault(kind, []).append(p)
    parts = []
    if by_kind.get("json"):
        parts.append(json_rows(spark, by_kind["json"], tables, encoding, encodings))
    if by_kind.get("text"):
        parts.append(text_rows(spark, by_kind["text"], sep, encoding, sheet_tables, encodings))
    if by_kind.get("split"):
        parts.append(split_csv_rows(spark, by_kind["split"], sep))
    if by_kind.get("parquet") or by_kind.get("unprobed"):
        parts.append(parquet_rows(spark, by_kind.get("parquet", []), by_kind.get("unprobed", [])))
    if by_kind.get("too large"):
        parts.append(_unreadable(spark, {p: "too large for one task" for p in by_kind["too large"]}))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out
