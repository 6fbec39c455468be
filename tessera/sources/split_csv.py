"""SRC-1 for large files: one CSV file read by many tasks.

Spark's text source deals a file out by byte ranges and gives every line to the
range it begins in. Whether a line begins a record hangs on all quotes before
it, so this takes two passes:

1. every range is summed up as a map from the state at its start (outside or
   inside a quoted field) to the state at its end; composing the maps of a
   file's ranges in order, one row a range, gives each its true start;
2. every range is cut into records. Those that lie inside it are parsed there;
   what hangs over a border is emitted as a fragment, and fragments are joined
   by the record they belong to.

No step depends on where the borders fall, and no file is read whole."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.transforms import FILE_MTIME, FILE_NAME, FILE_PATH, ROW_SEQ
from tessera.sources.scan import PANDAS_DEFAULT_NA
from tessera.spec import DEFAULT_TABLE

OUTSIDE, INSIDE = 0, 1
OUT_ROWS = 5_000
OUT_CHARS = 4 << 20
MOST_RANGES = 100_000   # one small row each; beyond, their states are joined by a shuffle instead of a broadcast
BOM = "﻿"


class _BadRecord(ValueError):
    pass


def line_map(sep: str):
    """``line -> (state after it from outside, from inside)``. Quotes are special at
    the start of a field only; after a closing quote text goes on literally."""
    s = re.escape(sep)
    body = r'[^"]*+(?:""[^"]*+)*+'
    field = rf'(?:"{body}"[^{s}]*+|(?!")[^{s}]*+)'
    whole = re.compile(rf"{field}(?:{s}{field})*+\Z")
    closing = re.compile(rf'{body}"[^{s}]*+(?:{s}{field})*+\Z')

    def states(line: str) -> tuple[int, int]:
        if '"' not in line:
            return OUTSIDE, INSIDE
        return (OUTSIDE if whole.match(line) else INSIDE), (OUTSIDE if closing.match(line) else INSIDE)

    return states


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, mtime, start, value)``: the lines of every range as bytes, in order within it."""
    df = spark.read.option("lineSep", "\n").text(list(paths))
    path = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    return df.select(path.alias("path"), F.col("_metadata.file_modification_time").alias("mtime"),
                     F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))


_MAPS = T.StructType([T.StructField("path", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("from_outside", T.IntegerType()), T.StructField("from_inside", T.IntegerType())])


def _summary(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, seen = line_map(sep), {}
        for b in batches:
            for path, start, raw in zip(*[c.to_pylist() for c in b.columns]):
                line = raw.decode("utf-8", "replace")
                if start == 0 and (path, start) not in seen:
                    line = line.removeprefix(BOM)
                after = states(line)
                a, z = seen.get((path, start), (OUTSIDE, INSIDE))
                seen[path, start] = after[a], after[z]
        if seen:
            yield pa.RecordBatch.from_pydict({
                "path": [k[0] for k in seen], "start": [k[1] for k in seen],
                "from_outside": pa.array([v[0] for v in seen.values()], pa.int32()),
                "from_inside": pa.array([v[1] for v in seen.values()], pa.int32())})
    return run


def range_states(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """``(path, start, state)``: the state in which each byte range begins. That is
    the state after the last range before it which forgets where it began, turned
    over by every range since that swaps the two."""
    maps = _lines(spark, paths).select("path", "start", "value").mapInArrow(_summary(sep), _MAPS)
    by_file = Window.partitionBy("path").orderBy("start")
    upto, before = (by_file.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside"))
    swaps = F.when((F.col("from_outside") == INSIDE) & (F.col("from_inside") == OUTSIDE), 1).otherwise(0)
    told = maps.select("path", "start", fixed.alias("fixed"), F.sum(swaps).over(upto).alias("turned"))
    last = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turned")), ignorenulls=True).over(before)
    so_far = F.coalesce(F.last("turned").over(before), F.lit(0))
    state = (F.coalesce(last["fixed"], F.lit(OUTSIDE)) + so_far - F.coalesce(last["turned"], F.lit(0))) % 2
    return told.select("path", "start", state.cast("int").alias("state"))


_PIECES = T.StructType([T.StructField("path", T.StringType()), T.StructField("mtime", T.TimestampType()), T.StructField("start", T.LongType()),
                        T.StructField("n", T.LongType()), T.StructField("vals", T.ArrayType(T.StringType())),
                        T.StructField("fragment", T.StringType()), T.StructField("error", T.StringType())])


def _parse(record: str, sep: str) -> list[str]:
    rows = list(csv.reader(io.StringIO(record.removesuffix("\r"), newline=""), delimiter=sep))
    if len(rows) > 1:
        raise _BadRecord("a carriage return without a line feed")
    return rows[0] if rows else []


def _cutter(sep: str):
    schema = pa.schema([("path", pa.string()), ("mtime", pa.timestamp("us", "UTC")), ("start", pa.int64()), ("n", pa.int64()),
                        ("vals", pa.list_(pa.string())), ("fragment", pa.string()), ("error", pa.string())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        states, at, out, held = line_map(sep), None, [], 0
        mtime, n, state, open_lines, whole, bad = None, 0, OUTSIDE, [], True, False

        def ended() -> None:
            """What a range leaves: lines of a record that may go on in the next."""
            if at is not None and open_lines and not bad:
                out.append((at[0], mtime, at[1], n if whole else -1, None, "\n".join(open_lines), None))

        for b in batches:
            for path, when, start, began, raw in zip(*[c.to_pylist() for c in b.columns]):
                first = (path, start) != at
                if first:
                    ended()
                    at, mtime, n, state, open_lines, whole, bad = (path, start), when, 0, began, [], began == OUTSIDE, False
                if bad:
                    continue
                try:
                    line = raw.decode("utf-8")
                    if first and start == 0:
                        line = line.removeprefix(BOM)
                    open_lines.append(line)
                    held += len(line)
                    state = states(line)[state]
                    if state == OUTSIDE:
                        record = "\n".join(open_lines)
                        if not whole:  # the end of a record that began in an earlier range
                            out.append((path, mtime, start, -1, None, record, None))
                        elif (vals := _parse(record, sep)):
                            out.append((path, mtime, start, n, vals, None, None))
                        open_lines, whole, n = [], True, n + 1
                except (UnicodeDecodeError, csv.Error, _BadRecord) as e:
                    out.append((path, mtime, start, n, None, None, f"{type(e).__name__.lstrip('_')}: {e}"[:500]))
                    bad = True
                if len(out) >= OUT_ROWS or held >= OUT_CHARS:
                    if out:
                        yield batch(out)
                    out, held = [], 0
        ended()
        if out:
            yield batch(out)

    return run


def _joiner(sep: str):
    """``(..., text)`` -> ``(..., vals, error)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for b in batches:
            vals, errors = [], []
            for text in b.column(b.num_columns - 1).to_pylist():
                try:
                    vals.append(_parse(text, sep))
                    errors.append(None)
                except (csv.Error, _BadRecord) as e:
                    vals.append(None)
                    errors.append(f"{type(e).__name__.lstrip('_')}: {e}"[:500])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(vals, pa.list_(pa.string())), pa.array(errors, pa.string())],
                                             names=[*b.schema.names[:-1], "vals", "error"])
    return run


def split_records(spark: SparkSession, paths: Sequence[str], sep: str, most_ranges: int = MOST_RANGES) -> DataFrame:
    """``(path, mtime, start, n, vals, error)``: the records of all files as lists of
    texts, ordered in a file by ``(start, n)``. UTF-8, lines ended by LF or CRLF;
    anything else is a record with ``error``."""
    from tessera.session import materialize

    states = materialize(range_states(spark, paths, sep))
    lines = _lines(spark, paths)
    if states.count() <= most_ranges:
        lines = lines.join(F.broadcast(states), ["path", "start"])
    else:
        lines = (lines.withColumn("line", F.monotonically_increasing_id()).join(states.hint("merge"), ["path", "start"])
                 .repartition("path", "start").sortWithinPartitions("path", "start", "line"))
    pieces = lines.select("path", "mtime", "start", "state", "value").mapInArrow(_cutter(sep), _PIECES)
    inner = pieces.where("fragment IS NULL").select("path", "mtime", "start", "n", "vals", "error")
    # a record's first fragment carries its number, those that go on carry -1: count the beginnings
    parts = pieces.where("fragment IS NOT NULL").select("path", "mtime", "start", "n", "fragment")
    upto = Window.partitionBy("path").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("record", F.sum(F.when(F.col("n") >= 0, 1).otherwise(0)).over(upto))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("start", "n", "fragment"))), lambda x: x["fragment"])
    joined = (numbered.groupBy("path", "record")
              .agg(F.min("mtime").alias("mtime"), F.min(F.struct("start", "n")).alias("first"), F.array_join(in_order, "\n").alias("text"))
              .select("path", "mtime", F.col("first.start").alias("start"), F.col("first.n").alias("n"), "text"))
    schema = T.StructType([*joined.schema.fields[:-1], T.StructField("vals", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())])
    return inner.unionByName(joined.mapInArrow(_joiner(sep), schema).where("error IS NOT NULL OR size(vals) > 0"))


def _headers(spark: SparkSession, paths: Sequence[str], sep: str) -> Mapping[str, tuple[int, list[str]]]:
    """Per file the number and the texts of its first record that is not blank."""
    found, states = {}, line_map(sep)
    for given in paths:  # large files, so few
        lines = _lines(spark, [given]).select("path", "start", F.monotonically_increasing_id().alias("line"), "value").orderBy("start", "line")
        size = 16
        while given is not None:
            some = lines.limit(size).collect()
            state, record, n = OUTSIDE, [], 0
            for k, r in enumerate(some):
                text = bytes(r["value"]).decode("utf-8", "replace")
                record.append(text.removeprefix(BOM) if not k else text)
                state = states(record[-1])[state]
                if state == OUTSIDE:
                    try:
                        vals = _parse("\n".join(record), sep)
                    except (csv.Error, _BadRecord):
                        vals = ["?"]  # the record itself is an error
                    if vals:
                        found[r["path"]], given = (n, vals), None
                        break
                    record, n = [], n + 1
            if len(some) < size:
                break
            size *= 16
    return found


def split_csv_rows(spark: SparkSession, paths: Sequence[str], sep: str, most_ranges: int = MOST_RANGES) -> DataFrame:
    """Long rows as of ``rows.text_rows``, for files of any size: the header is the
    first record; a doubled column name, or a row with more fields than the
    header, is a row with ``_error``. ``_row_seq`` keeps the order in a file."""
    headers = _headers(spark, paths, sep)
    schema = "path string, head long, keys array<string>"
    heads = spark.createDataFrame([(p, n, keys) for p, (n, keys) in headers.items()], schema)
    rows = split_records(spark, paths, sep, most_ranges).join(F.broadcast(heads), "path")
    rows = rows.where("error IS NOT NULL OR NOT (start = 0 AND n = head)")
    width = F.size("keys")
    extra = F.slice("vals", width + 1, F.greatest(F.size("vals") - width, F.lit(0)))
    na = F.array(*[F.lit(x) for x in PANDAS_DEFAULT_NA])
    vals = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.when(~F.array_contains(na, F.get("vals", i)), F.get("vals", i)))
    error = (F.when(F.col("error").isNotNull(), F.col("error"))
             .when(F.size(F.array_distinct("keys")) < width, F.lit("UnreadableFile: duplicate column names"))
             .when(F.exists(extra, lambda v: v != ""), F.lit("UnreadableFile: a row has more fields than the header")))
    # a range has no more records than bytes, so this number grows through a file
    place = F.col("start") + F.col("n") + F.when(F.col("start") > 0, 1).otherwise(0)
    return rows.select(F.col("path").alias(FILE_PATH), F.regexp_extract("path", r"([^/]*)$", 1).alias(FILE_NAME), F.col("mtime").alias(FILE_MTIME),
                       F.lit(DEFAULT_TABLE).alias("tbl"), place.alias(ROW_SEQ),
                       F.when(error.isNull(), F.map_from_arrays("keys", vals)).alias("row"), error.alias("_error"))
