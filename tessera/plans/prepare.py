"""PIP-1: per-table preparation of scanned rows, as one transform chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.nulls import normalize_nulls
from tessera.operators.merge import merge_duplicates, merged_pk_map, surviving_values
from tessera.operators.transforms import (FILE_MTIME, FILE_NAME, FILE_PATH, FILE_SEQ, KEY, ROW_SEQ,
                                          add_file_name, add_file_timestamp, add_filename_groups,
                                          clean_column_names, drop_null_keys, published_flag, typed_keys,
                                          with_key)
from tessera.spec import CatalogSpec, TableSpec


def enrich(df: DataFrame, table: TableSpec, spec: CatalogSpec) -> DataFrame:
    """PRJ-3, PRJ-4, PRJ-5/6, PRJ-7, then PRJ-1 and PRJ-2."""
    if table.add_filename:
        df = add_file_name(df, table.add_filename)
    if table.add_file_timestamp:
        df = add_file_timestamp(df, table.add_file_timestamp)
    if table.filename_format:
        df = add_filename_groups(df, table.filename_format, table.filename_rules)
    if table.published_flags:
        df = published_flag(df, table.published_flags, spec.null_tokens)
    df = clean_column_names(df, spec.character_scope)
    return normalize_nulls(df, spec.null_tokens)


def key_and_merge(df: DataFrame, table: TableSpec, spec: CatalogSpec, key_mode: str = "concat") -> DataFrame:
    """PRJ-8 + FLT-1 + AGG-1 inside each file, then PRJ-10. A keyless table is
    appended as it is (D10/D11)."""
    df = df.drop(FILE_PATH, FILE_NAME, FILE_MTIME)
    if not table.key:
        return df
    df = drop_null_keys(with_key(df, table.key_columns, key_mode), KEY, spec.null_tokens)
    int_cols = integer_keys(df, table, spec)
    single = list(dict.fromkeys(([table.pk.name] if table.pk is not None and table.pk.name in df.columns else []) + int_cols))
    if single:
        # a merged row keeps the PK and the integer FKs seen first (AGG-3), not a merged text of all
        survivors = surviving_values(df, [FILE_SEQ, KEY], single, [ROW_SEQ])
        merged = (merge_duplicates(df.drop(*single), [FILE_SEQ, KEY], [ROW_SEQ])
                  .join(survivors, [FILE_SEQ, KEY]).select(*[f"`{c}`" for c in df.columns]))
    else:
        merged = merge_duplicates(df, [FILE_SEQ, KEY], [ROW_SEQ])
    return typed_keys(merged, int_cols).drop("_reject") if int_cols else merged


def merged_keys(df: DataFrame, table: TableSpec, spec: CatalogSpec, key_mode: str = "concat") -> DataFrame | None:
    """AGG-3 per file: ``(_file_seq, old_pk, survivor)`` of the PKs that merging
    duplicate keys drops; None for a table without key or PK."""
    if not table.key or table.pk is None or table.pk.name not in df.columns:
        return None
    keyed = drop_null_keys(with_key(df, table.key_columns, key_mode), KEY, spec.null_tokens)
    return merged_pk_map(keyed, [FILE_SEQ, KEY], table.pk.name, [ROW_SEQ], keep=[FILE_SEQ])


def integer_keys(df: DataFrame, table: TableSpec, spec: CatalogSpec) -> list[str]:
    """The PK and FK columns of a table that must be integers."""
    cols = []
    if table.pk is not None and table.pk.int_type and table.pk.name in df.columns:
        cols.append(table.pk.name)
    for fk in table.fks:
        parent = spec.tables.get(fk.parent)
        if parent is not None and parent.pk is not None and parent.pk.int_type and fk.name in df.columns:
            cols.append(fk.name)
    return cols


def files_with_bad_keys(df: DataFrame, table: TableSpec, spec: CatalogSpec) -> DataFrame | None:
    """PRJ-10: ``(_file_seq, reason)`` of files with a key that is no integer."""
    cols = integer_keys(df, table, spec)
    if not cols:
        return None
    return (typed_keys(df, cols).filter(F.col("_reject")).select(FILE_SEQ).distinct()
            .withColumn("reason", F.lit("bad_integer_key")))


def prepare(df: DataFrame, table: TableSpec, spec: CatalogSpec, key_mode: str = "concat") -> DataFrame:
    """PIP-1 = enrich -> key -> merge duplicates -> typed keys."""
    return key_and_merge(enrich(df, table, spec), table, spec, key_mode)
