"""Skew-safe ``row_number() OVER (PARTITION BY g ORDER BY o)`` and running totals.

A window partitioned by ``g`` sends a whole group to one task, and a global
``Window.orderBy`` sends the whole table to one task. Here the frame is range
partitioned on ``(g, o)`` instead, so a hot group is spread over many tasks:

1. ``repartitionByRange(n, g, o)`` + ``sortWithinPartitions``, and every row
   is stamped with its partition and place (``monotonically_increasing_id``);
2. that frame is written once to the shared checkpoint folder. From here on
   the stamp is data: whatever is read again, and however often, partitions
   and places are the same, so nothing depends on exchange reuse or on range
   bounds being sampled alike twice;
3. one total per partition (a frame bounded by the partition count, so it may
   be broadcast) gives every partition its offset, hence every row its total
   in the whole order;
4. a group's total is the whole total less what came before its first row,
   one aggregated row per group.

Order items are column names (ascending, nulls first) or tuples
``(name, ascending, nulls_last)``; together with the group columns they
should give a total order inside each group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

_STAMP, _PART, _UPTO, _OFFSET, _BEFORE = "_seq_stamp", "_seq_part", "_seq_upto", "_seq_offset", "_seq_before"
_PLACE_BITS = 33  # monotonically_increasing_id keeps the row's place in its low 33 bits

OrderItem = str | tuple


def _sort_spec(item: OrderItem) -> tuple[str, bool, bool]:
    if isinstance(item, str):
        return item, True, False
    name, asc, *rest = item
    return name, bool(asc), bool(rest[0]) if rest else (not asc)


def _sort_column(name: str, asc: bool, nulls_last: bool) -> Column:
    c = F.col(f"`{name}`")
    if asc:
        return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
    return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()


def sequence_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[OrderItem],
                    out: str = "seq", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its group by ``order_cols``."""
    return running_total(df, group_cols, order_cols, None, out, num_partitions)


def running_total(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[OrderItem],
                  weight_col: str | None, out: str = "total", num_partitions: int | None = None) -> DataFrame:
    """``sum(weight) OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING)``
    for an integral weight (1 per row when ``weight_col`` is None)."""
    group_cols = list(group_cols)
    specs = [(g, True, False) for g in group_cols] + [_sort_spec(o) for o in order_cols]
    order = [_sort_column(*s) for s in specs]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn(_STAMP, F.monotonically_increasing_id()))
    placed = placed.withColumn(_PART, F.shiftright(_STAMP, _PLACE_BITS))
    if weight_col is None:
        weight = F.lit(1).cast("long")
        local = F.col(_STAMP).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    else:
        weight = F.coalesce(F.col(f"`{weight_col}`").cast("long"), F.lit(0))
        local = F.sum(weight).over(Window.partitionBy(_PART).orderBy(_STAMP)
                                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(_PART).agg(F.sum(weight).alias("_n"))
               .select(_PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_OFFSET)))
    totals = placed.withColumn(_UPTO, local).join(F.broadcast(offsets), _PART)
    totals = totals.withColumn(_UPTO, F.col(_UPTO) + F.col(_OFFSET)).drop(_OFFSET, _PART)
    if group_cols:
        before = totals.groupBy(*[F.col(f"`{g}`").alias(f"_seq_g{i}") for i, g in enumerate(group_cols)]).agg(
            F.min_by(F.col(_UPTO) - weight, F.col(_STAMP)).alias(_BEFORE))
        same = F.lit(True)
        for i, g in enumerate(group_cols):
            same = same & totals[f"`{g}`"].eqNullSafe(before[f"_seq_g{i}"])
        totals = totals.join(before, same).drop(*[f"_seq_g{i}" for i in range(len(group_cols))])
        result = F.col(_UPTO) - F.col(_BEFORE)
    else:
        result = F.col(_UPTO)
    return totals.withColumn(out, result.cast("long")).drop(_STAMP, _UPTO, _BEFORE)
