"""Scans of metadata files: CSV (SRC-1), multi-table JSON (SRC-2), Parquet
(SRC-3), table-per-directory workbooks (SRC-4), catalog reload (SRC-5),
encoding by BOM (SRC-6) and folder listing (SRC-7).

Every scan tags rows with ``_file_path``, ``_file_name``, ``_file_mtime`` and a
``_row_seq`` taken right at the scan (before any shuffle), which gives the
first-seen order the duplicate merge needs.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.nulls import normalize_nulls
from tessera.operators.transforms import FILE_MTIME, FILE_NAME, FILE_PATH, ROW_SEQ, q
from tessera.spec import DEFAULT_CSV_SEPARATOR, DEFAULT_NULL_TOKENS, DEFAULT_TABLE

# Text that pandas' CSV reader turns into a missing value by
# default (its STR_NA_VALUES), in addition to the configured null tokens.
PANDAS_DEFAULT_NA = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _tag(df: DataFrame) -> DataFrame:
    return (df.withColumn(FILE_PATH, F.col("_metadata.file_path"))
            .withColumn(FILE_NAME, F.col("_metadata.file_name"))
            .withColumn(FILE_MTIME, F.col("_metadata.file_modification_time"))
            .withColumn(ROW_SEQ, F.monotonically_increasing_id()))


# ---------------------------------------------------------------- SRC-1
def scan_csv(spark: SparkSession, paths: str | Sequence[str], sep: str = DEFAULT_CSV_SEPARATOR,
             encoding: str = "UTF-8", tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Header row, all columns text (no inference), null tokens -> NULL."""
    df = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
          .option("inferSchema", False)
          # doubled quotes, line breaks and separators inside quotes, fields of any length
          .option("quote", '"').option("escape", '"').option("multiLine", True).option("maxCharsPerColumn", -1)
          .option("nullValue", "\u0000__tessera_no_null__").option("emptyValue", "")
          .csv(list(paths) if not isinstance(paths, str) else paths))
    df = _tag(df)
    data_cols = [c for c in df.columns if not c.startswith("_file") and c != ROW_SEQ]
    return normalize_nulls(df, list(tokens) + PANDAS_DEFAULT_NA, data_cols)


# ---------------------------------------------------------------- SRC-2
def read_json_documents(spark: SparkSession, paths: str | Sequence[str], whole_file: bool = True) -> DataFrame:
    """One row per JSON document: ``(_file_*, _row_seq, value)``. ``whole_file``
    reads one document per file; otherwise one document per line."""
    reader = spark.read.option("wholetext", whole_file)
    df = reader.text(list(paths) if not isinstance(paths, str) else paths)
    return _tag(df)


def scan_json_tables(docs: DataFrame, tables: Sequence[str], default_table: str = DEFAULT_TABLE,
                     value_col: str = "value") -> DataFrame:
    """Split multi-table documents into long rows ``(tbl, _doc_seq, _row_seq2, row)``
    where ``row`` is ``map<string,string>`` (nested values stay JSON text).

    A root key naming a configured table gives that table (list -> rows,
    object -> one row); the other root keys form one row of the default table;
    a root list goes whole to the default table.
    """
    v = F.trim(q(value_col))
    is_list = v.startswith("[")
    root = F.from_json(F.when(~is_list, v), "map<string,string>")
    rows_of_list = F.from_json(F.when(is_list, v), "array<map<string,string>>")
    base = docs.select(*[c for c in docs.columns if c != value_col], root.alias("_m"), rows_of_list.alias("_l"))
    parts = []
    for t in tables:
        if t == default_table:
            continue
        cell = F.trim(F.element_at(F.col("_m"), F.lit(t)))
        arr = F.when(cell.startswith("["), F.from_json(cell, "array<map<string,string>>")).when(
            cell.startswith("{"), F.array(F.from_json(cell, "map<string,string>")))
        parts.append(F.struct(F.lit(t).alias("tbl"), arr.alias("rows")))
    named = [t for t in tables if t != default_table]
    leftovers = F.map_filter(F.col("_m"), lambda k, _v: ~k.isin(named)) if named else F.col("_m")
    default_rows = F.when(F.col("_l").isNotNull(), F.col("_l")).when(
        F.size(leftovers) > 0, F.array(leftovers))
    parts.append(F.struct(F.lit(default_table).alias("tbl"), default_rows.alias("rows")))
    exploded = base.select(*[c for c in base.columns if c not in ("_m", "_l")],
                           F.explode(F.array(*parts)).alias("_p"))
    return (exploded.select(*[c for c in exploded.columns if c != "_p"], F.col("_p.tbl").alias("tbl"),
                            F.posexplode(F.col("_p.rows")).alias("_pos", "row"))
            .filter(F.col("row").isNotNull()))


def table_from_rows(rows: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Wide frame of one table from the long rows. ``columns`` defaults to the
    distinct map keys (a column list: small, collected as a statistic)."""
    t = rows.filter(F.col("tbl") == table)
    if columns is None:
        columns = sorted(r[0] for r in t.select(F.explode(F.map_keys("row"))).distinct().collect())
    keep = [c for c in t.columns if c not in ("row", "_pos")]
    return t.select(*keep, *[F.element_at(F.col("row"), F.lit(c)).alias(c) for c in columns])


# ---------------------------------------------------------------- SRC-3
def scan_parquet(spark: SparkSession, paths: str | Sequence[str], merge_schema: bool = True) -> DataFrame:
    df = spark.read.option("mergeSchema", merge_schema).parquet(
        *([paths] if isinstance(paths, str) else list(paths)))
    return _tag(df)


# ---------------------------------------------------------------- SRC-4 (table-per-directory)
def scan_sheet_dirs(spark: SparkSession, root: str, fmt: str = "parquet", sheet_depth: int = 1,
                    **options) -> DataFrame:
    """Workbook re-aimed as ``<root>/<sheet>/part-*``: one directory per sheet;
    the sheet name is taken from the file path. Columns of all sheets are
    merged by name (missing -> NULL)."""
    df = (spark.read.format(fmt).options(**options).option("recursiveFileLookup", True)
          .option("mergeSchema", True).load(root))
    df = _tag(df)
    parts = F.split(F.col(FILE_PATH), "/")
    return df.withColumn("sheet", F.element_at(parts, -1 - sheet_depth))


# ---------------------------------------------------------------- SRC-7
def list_files(spark: SparkSession, roots: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Recursive listing of files, empty ones and names beginning with ``.`` or
    ``_`` included (Spark's own file sources leave those out), through the
    Hadoop file system of each root. Contents are not read. A missing root
    raises ``FileNotFoundError``."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for root in [roots] if isinstance(roots, str) else roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        store = path.getFileSystem(conf)
        if not store.exists(path):
            raise FileNotFoundError(root)
        files = store.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            name = f.getPath().getName()
            if glob is None or fnmatch.fnmatchcase(name, glob):
                found.append((f.getPath().toString(), name, f.getModificationTime() / 1000.0, f.getLen()))
    df = spark.createDataFrame(found, "path string, name string, seconds double, length long")
    return df.select("path", "name", F.timestamp_millis(F.round(F.col("seconds") * 1000).cast("long")).alias("modificationTime"),
                     "length")


# ---------------------------------------------------------------- SRC-6
def detect_encoding(files: DataFrame, content_col: str = "content", default: str = "UTF-8") -> DataFrame:
    """BOM test on the first bytes (utf-8-sig, utf-32, utf-16); else the default."""
    head = F.hex(F.substring(q(content_col), 1, 4))
    enc = (F.when(head.startswith("EFBBBF"), F.lit("UTF-8"))
           .when(head.startswith("FFFE0000") | head.startswith("0000FEFF"), F.lit("UTF-32"))
           .when(head.startswith("FFFE"), F.lit("UTF-16LE"))
           .when(head.startswith("FEFF"), F.lit("UTF-16BE"))
           .otherwise(F.lit(default)))
    bom = (F.when(head.startswith("EFBBBF"), F.lit(3))
           .when(head.startswith("FFFE0000") | head.startswith("0000FEFF"), F.lit(4))
           .when(head.startswith("FFFE") | head.startswith("FEFF"), F.lit(2)).otherwise(F.lit(0)))
    return files.withColumn("encoding", enc).withColumn("bom_bytes", bom)


def decoded_documents(files: DataFrame, content_col: str = "content", default: str = "UTF-8", out: str = "value") -> DataFrame:
    """``files`` with their content as text ``out``: decoded by byte order mark,
    else by ``default``; null where the bytes are not valid in that encoding."""
    marked = detect_encoding(files, content_col, default)
    body = F.expr(f"substring(`{content_col}`, bom_bytes + 1)")
    text = F.lit(None).cast("string")
    for name, charset in (("UTF-32", "UTF-32"), ("UTF-16LE", "UTF-16LE"), ("UTF-16BE", "UTF-16BE"), ("UTF-8", "UTF-8"),
                          (default, default)):
        whole = q(content_col) if name == "UTF-32" else body  # the mark itself tells UTF-32's byte order
        text = F.when(q("encoding") == name, F.decode(whole, charset)).otherwise(text)
    valid = (q("encoding") != "UTF-8") | F.is_valid_utf8(body.cast("string"))
    return marked.withColumn(out, F.when(valid, text)).drop(content_col, "encoding", "bom_bytes")


def read_by_encoding(spark: SparkSession, manifest: DataFrame, reader) -> DataFrame:
    """Group paths by detected encoding and read each group once with
    ``reader(paths, encoding)``; the group list is bounded by the encodings."""
    encodings = sorted(r[0] for r in manifest.select("encoding").distinct().collect())
    out = None
    for encoding in encodings:
        paths = [r[0] for r in manifest.where(q("encoding") == encoding).select("path").toLocalIterator()]
        df = reader(paths, encoding).withColumn("encoding", F.lit(encoding))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- SRC-5
def newest_replica(manifest: DataFrame, path_col: str = "path", time_col: str = "modificationTime") -> DataFrame:
    """The replica with the latest mtime (ties: the greatest path): one row."""
    return manifest.agg(F.max_by(q(path_col), F.struct(q(time_col), q(path_col))).alias(path_col))
