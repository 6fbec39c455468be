"""SRT-1 catalog sort and SRT-2 default (posting-order) sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tessera.functions.ranking import sequence_within
from tessera.operators.transforms import FILE_SEQ, ROW_SEQ, q


def sort_columns(rules: Sequence[tuple[str, bool]]) -> list[Column]:
    """Nulls always last; strings compare as text."""
    return [q(c).asc_nulls_last() if asc else q(c).desc_nulls_last() for c, asc in rules]


def catalog_sort(df: DataFrame, rules: Sequence[tuple[str, bool]]) -> DataFrame:
    """Global sort (range-partitioned by Spark) for writing."""
    return df.orderBy(*sort_columns(rules)) if rules else default_sort(df)


def default_sort(df: DataFrame) -> DataFrame:
    return df.orderBy(q(FILE_SEQ).asc_nulls_last(), q(ROW_SEQ).asc_nulls_last())


def with_position(df: DataFrame, rules: Sequence[tuple[str, bool]], tie_break: Sequence[str] = (),
                  out: str = "pos") -> DataFrame:
    """The row's 1-based position in the sorted catalog, as a column; computed
    with range partitioning, never a single-partition window."""
    order = [(c, asc, True) for c, asc in rules] + [(c, True, True) for c in tie_break]
    return sequence_within(df, [], order, out)
