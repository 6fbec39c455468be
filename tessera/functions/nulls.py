"""PRJ-2: null-token normalisation (exact, whitespace-sensitive match)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.spec import DEFAULT_NULL_TOKENS


def null_if_token(c: Column | str, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """NULL when the text value is one of ``tokens``; otherwise the value."""
    c = F.col(c) if isinstance(c, str) else c
    toks = list(dict.fromkeys(tokens))
    return F.when(~c.isin(toks), c)


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
                    columns: Iterable[str] | None = None) -> DataFrame:
    """One projection over all string columns (others are left as they are)."""
    toks = list(dict.fromkeys(tokens))
    cols = set(columns) if columns is not None else None
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "string" and (cols is None or f.name in cols):
            out.append(null_if_token(F.col(f"`{f.name}`"), toks).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
