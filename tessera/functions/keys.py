"""PRJ-8: business-key composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.spec import NULL_KEY_PART

KEY_SEPARATOR = "-"


def compose_key(columns: Sequence[str], mode: str = "concat", sort: bool = True) -> Column:
    """Key over the key columns, in sorted order.

    ``concat`` mode joins trimmed text parts with ``-`` and writes ``<NA>`` for a
    null part, as the reference does. ``struct`` mode keeps the parts apart,
    so ``a-b``+``c`` and ``a``+``b-c`` stay different keys.
    """
    cols = sorted(dict.fromkeys(columns)) if sort else list(columns)
    if not cols:
        return F.lit(None).cast("string")
    if mode == "struct":
        return F.struct(*[F.col(f"`{c}`") for c in cols])
    parts = [F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit(NULL_KEY_PART)) for c in cols]
    return F.concat_ws(KEY_SEPARATOR, *parts)
