"""Duplicate-key handling: AGG-1 (merge), AGG-2 (detect), AGG-3 (merged-PK map).

AGG-1 is skew-safe: a key may hold a third of all rows. Keys seen once bypass
the merge; the values of repeated keys are deduplicated by a partial
aggregation before anything is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.transforms import FILE_SEQ, KEY, ROW_SEQ, q
from tessera.session import as_table
from tessera.spec import MERGE_SEPARATOR


def duplicate_keys(df: DataFrame, key_cols: Sequence[str] = (KEY,), out: str = "n") -> DataFrame:
    """AGG-2: keys seen more than once, with their counts (partial aggregation)."""
    return (df.groupBy(*[q(k) for k in key_cols]).agg(F.count(F.lit(1)).alias(out))
            .filter(F.col(out) > 1))


def _column_text(i: int, sep: str):
    picked = F.filter(F.col("_l"), lambda x: x["_i"] == F.lit(i))
    return F.when(F.size(picked) > 0, F.array_join(F.transform(picked, lambda x: x["_v"]), sep))


def merge_duplicates(df: DataFrame, key_cols: Sequence[str] = (KEY,),
                     order_cols: Sequence[str] = (FILE_SEQ, ROW_SEQ),
                     sep: str = MERGE_SEPARATOR, keep_order_cols: bool = True) -> DataFrame:
    """AGG-1: one row per key; per column the distinct non-null values in
    first-seen order, joined by ``sep`` (none -> NULL, one -> the value).

    Value columns are text; order columns take the key's first position (the
    smallest ``order_cols`` tuple). A null key is a key.

    Keys are counted first, by hash aggregation over the key columns alone. The
    list of repeated keys, usually short, is written, so that its size is known: it
    marks the rows without shuffling them when it is small, else by a join that
    AQE splits where one key is hot. Rows of keys seen once pass through
    without an aggregate. The others become ``(key, column, value)`` triples,
    deduplicated before anything is collected, so a group never holds more than
    the distinct values that its merged text consists of.
    """
    key_cols = list(key_cols)
    order_cols = [c for c in order_cols if c in df.columns]
    values = [c for c in df.columns if c not in key_cols and c not in order_cols]
    keyed = [q(k) for k in key_cols]
    repeated = (df.groupBy(*keyed).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                .select(*[q(k).alias(f"_k{i}") for i, k in enumerate(key_cols)]))
    repeated = as_table(repeated, "repeated-keys").withColumn("_again", F.lit(True))
    same = reduce(and_, [q(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key_cols)])
    tagged = df.join(repeated, same, "left").drop(*[f"_k{i}" for i in range(len(key_cols))])
    single = tagged.filter(F.col("_again").isNull()).select(
        *keyed, *[q(c).cast("string").alias(c) for c in values], *[q(c) for c in order_cols])

    # one order column keeps hash aggregation, which a struct has not
    position = q(order_cols[0]) if len(order_cols) == 1 else F.struct(*[q(c) for c in order_cols]) if order_cols else F.lit(0)
    cells = [F.struct(F.lit(i).alias("i"), q(c).cast("string").alias("v")) for i, c in enumerate(values)]
    cells.append(F.struct(F.lit(-1).alias("i"), F.lit("").alias("v")))  # keeps all-null keys and their first position
    triples = (tagged.filter(F.col("_again")).select(*keyed, position.alias("_s"), F.explode(F.array(*cells)).alias("_e"))
               .filter(F.col("_e.v").isNotNull())
               .select(*keyed, "_s", F.col("_e.i").alias("_i"), F.col("_e.v").alias("_v")))
    firsts = triples.groupBy(*keyed, "_i", "_v").agg(F.min("_s").alias("_s"))
    per_key = firsts.groupBy(*keyed).agg(F.array_sort(F.collect_list(F.struct("_i", "_s", "_v"))).alias("_l"))
    first = F.element_at(F.filter(F.col("_l"), lambda x: x["_i"] == F.lit(-1)), 1)["_s"]
    merged = per_key.select(*keyed, *[_column_text(i, sep).alias(c) for i, c in enumerate(values)],
                            *[(first if len(order_cols) == 1 else first[c]).alias(c) for c in order_cols])
    out = single.unionByName(merged)
    return out if keep_order_cols else out.drop(*order_cols)


def merged_pk_map(df: DataFrame, key_cols: Sequence[str], pk: str,
                  order_cols: Sequence[str] = (FILE_SEQ, ROW_SEQ), keep: Sequence[str] = ()) -> DataFrame:
    """AGG-3: for keys holding several PKs, survivor = first-seen PK, every other
    PK maps to it. Output ``(*keep, old_pk, survivor)``, ``keep`` being key
    columns such as the file; no list of PKs is collected."""
    key_cols = list(key_cols)
    survivors = surviving_values(df, key_cols, [pk], order_cols).withColumnRenamed(pk, "_survivor")
    pairs = df.select(*[q(k) for k in key_cols], q(pk)).filter(q(pk).isNotNull()).distinct()
    return (pairs.join(survivors, key_cols)
            .filter(q(pk) != F.col("_survivor"))
            .select(*[q(k) for k in keep], q(pk).alias("old_pk"), F.col("_survivor").alias("survivor")))


def surviving_values(df: DataFrame, key_cols: Sequence[str], cols: Sequence[str],
                     order_cols: Sequence[str] = (FILE_SEQ, ROW_SEQ)) -> DataFrame:
    """Per key the value of each of ``cols`` seen first; nulls do not count."""
    seq = F.struct(*[q(c) for c in order_cols if c in df.columns])
    return df.groupBy(*[q(k) for k in key_cols]).agg(
        *[F.min_by(q(c), F.when(q(c).isNotNull(), seq)).alias(c) for c in cols])
