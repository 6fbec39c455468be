"""Per-row projections and filters: PRJ-1..10, PRJ-13, FLT-1."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import compose_key
from tessera.functions.nulls import null_if_token
from tessera.functions.regex import extract_groups
from tessera.functions.text import apply_value_rules
from tessera.spec import (DEFAULT_CHARACTER_SCOPE, DEFAULT_NULL_TOKENS, FLAG_FALSE, UNLIMITED_SCOPE)

KEY = "_key"
FILE_SEQ = "_file_seq"
ROW_SEQ = "_row_seq"
FILE_NAME = "_file_name"
FILE_PATH = "_file_path"
FILE_MTIME = "_file_mtime"
CONTROL_COLUMNS = (KEY, FILE_SEQ, ROW_SEQ, FILE_NAME, FILE_PATH, FILE_MTIME)


def q(name: str) -> Column:
    """Column by exact name (names may hold dots or spaces)."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---------------------------------------------------------------- PRJ-1
def clean_name(name: str, scope: str = DEFAULT_CHARACTER_SCOPE) -> str:
    if scope == UNLIMITED_SCOPE:
        return name
    return re.sub(scope, "", name)


def clean_column_names(df: DataFrame, scope: str = DEFAULT_CHARACTER_SCOPE) -> DataFrame:
    """Delete characters outside ``scope`` from every column name; raise when
    two names become equal (D15). A rename only: no data is touched."""
    names = [c if c in CONTROL_COLUMNS else clean_name(c, scope) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"column names {seen[new]!r} and {old!r} both clean to {new!r}")
        seen[new] = old
    return df.toDF(*names)


# ---------------------------------------------------------------- PRJ-3 / PRJ-4
def add_file_name(df: DataFrame, column: str, source: Column | None = None) -> DataFrame:
    """Source file name as a column, unless the data already has one."""
    if column in df.columns:
        return df
    return df.withColumn(column, source if source is not None else q(FILE_NAME))


def iso_utc(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def add_file_timestamp(df: DataFrame, column: str, source: Column | None = None) -> DataFrame:
    """Source mtime as ISO-8601 UTC seconds + ``Z``, unless present."""
    if column in df.columns:
        return df
    return df.withColumn(column, iso_utc(source if source is not None else q(FILE_MTIME)))


# ---------------------------------------------------------------- PRJ-5 / PRJ-6
def add_filename_groups(df: DataFrame, pattern: str, rules: dict | None = None,
                        source: Column | None = None) -> DataFrame:
    """Named groups of the file name become columns (overwriting); rows whose
    name does not match keep their values. Value rules apply per group."""
    src = source if source is not None else q(FILE_NAME)
    rules = rules or {}
    for name, expr in extract_groups(src, pattern).items():
        if name in rules:
            expr = apply_value_rules(expr, rules[name])
        keep = q(name) if name in df.columns else F.lit(None).cast("string")
        df = df.withColumn(name, F.coalesce(expr, keep))
    return df


# ---------------------------------------------------------------- PRJ-7
def published_flag(df: DataFrame, flag_columns: Iterable[str],
                   tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Create missing flag columns as "False"; null or a null token -> "False"."""
    toks = list(tokens)
    for c in flag_columns:
        cur = null_if_token(q(c).cast("string"), toks) if c in df.columns else F.lit(None).cast("string")
        df = df.withColumn(c, F.coalesce(cur, F.lit(FLAG_FALSE)))
    return df


# ---------------------------------------------------------------- PRJ-8 / PRJ-9 / FLT-1
def with_key(df: DataFrame, key_columns: Sequence[str], mode: str = "concat", out: str = KEY) -> DataFrame:
    """Composed business key over the sorted key columns."""
    return df.withColumn(out, compose_key(key_columns, mode))


def data_file_column(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Helper column joining the file-name columns (PRJ-9)."""
    return df.withColumn(out, F.concat_ws("-", *[q(c) for c in columns]))


def drop_null_keys(df: DataFrame, key: str = KEY, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """FLT-1: drop rows whose composed key is null or a null token."""
    k = q(key)
    if dict(df.dtypes).get(key, "string") == "string":
        return df.filter(k.isNotNull() & ~k.isin(list(dict.fromkeys(tokens))))
    return df.filter(k.isNotNull())


# ---------------------------------------------------------------- PRJ-10
def typed_keys(df: DataFrame, columns: Sequence[str], reject_col: str = "_reject") -> DataFrame:
    """Cast PK/FK text to bigint with ``try_cast``; a row whose non-null text does
    not parse is flagged in ``reject_col`` (the caller routes it to rejects)."""
    bad = F.lit(False)
    casts = {}
    for c in columns:
        src = q(c)
        cast = src.try_cast("bigint") if dict(df.dtypes)[c] == "string" else src.cast("bigint")
        bad = bad | (src.isNotNull() & cast.isNull())
        casts[c] = cast
    return df.select(*[casts[c].alias(c) if c in casts else q(c) for c in df.columns], bad.alias(reject_col))


# ---------------------------------------------------------------- PRJ-13
def stringify(df: DataFrame, exclude: Iterable[str] = CONTROL_COLUMNS) -> DataFrame:
    ex = set(exclude)
    return df.select(*[q(c) if c in ex else q(c).cast("string").alias(c) for c in df.columns])
