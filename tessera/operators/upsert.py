"""Catalog upsert: JON-1, JON-2, WIN-1, WIN-3, SET-1, PRJ-11, PRJ-12, AGG-5."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ranking import sequence_within
from tessera.operators.transforms import CONTROL_COLUMNS, FILE_SEQ, KEY, ROW_SEQ, q


# ---------------------------------------------------------------- JON-1 / SET-3
def split_updates(catalog: DataFrame, delta: DataFrame, key_cols: Sequence[str] = (KEY,)) -> DataFrame:
    """Incoming rows whose key already exists in the catalog (left semi)."""
    return delta.join(catalog.select(*[q(k) for k in key_cols]), list(key_cols), "left_semi")


def split_adds(catalog: DataFrame, delta: DataFrame, key_cols: Sequence[str] = (KEY,)) -> DataFrame:
    """Incoming rows with a new key (left anti)."""
    return delta.join(catalog.select(*[q(k) for k in key_cols]), list(key_cols), "left_anti")


# ---------------------------------------------------------------- JON-2
def coalesce_upsert(catalog: DataFrame, delta: DataFrame, key_cols: Sequence[str] = (KEY,),
                    order_cols: Sequence[str] = (FILE_SEQ, ROW_SEQ)) -> DataFrame:
    """Matched rows take the new value where it is non-null, else keep the old;
    unmatched old rows stay; new rows are added; columns are the union. The
    order columns come from the new side when matched (the row moves to the end).

    One full outer join on the key: one shuffle per side, none if both sides
    are already partitioned on the key.
    """
    key_cols = list(key_cols)
    o, n = catalog.alias("o"), delta.alias("n")
    cond = [F.col(f"o.`{k}`") == F.col(f"n.`{k}`") for k in key_cols]
    joined = o.join(n, cond, "full_outer")
    matched = F.lit(True)
    for k in key_cols:
        matched = matched & F.col(f"n.`{k}`").isNotNull()
    out = [F.coalesce(F.col(f"n.`{k}`"), F.col(f"o.`{k}`")).alias(k) for k in key_cols]
    seen = set(key_cols)
    cols = [c for c in merge_column_order(list(delta.columns), list(catalog.columns)) if c not in seen]
    ncols, ocols = set(delta.columns), set(catalog.columns)
    new_row = F.lit(True)
    for k in key_cols:
        new_row = new_row & F.col(f"n.`{k}`").isNotNull()
    for c in cols:
        if c in order_cols and c in ncols and c in ocols:
            out.append(F.when(new_row, F.col(f"n.`{c}`")).otherwise(F.col(f"o.`{c}`")).alias(c))
        elif c in ncols and c in ocols:
            out.append(F.coalesce(F.col(f"n.`{c}`"), F.col(f"o.`{c}`")).alias(c))
        elif c in ncols:
            out.append(F.col(f"n.`{c}`").alias(c))
        else:
            out.append(F.col(f"o.`{c}`").alias(c))
    return joined.select(*out)


def upsert_into(catalog: DataFrame, delta: DataFrame, key_cols: Sequence[str] = (KEY,),
                order_cols: Sequence[str] = (FILE_SEQ, ROW_SEQ)) -> DataFrame:
    """JON-2 for a large catalog and a batch-sized delta (one row per key):
    catalog rows whose key is not in the delta pass through an anti join
    against the delta's keys (broadcast when Catalyst's estimate is small, so
    the catalog is scanned, not shuffled); only matched rows go through the
    coalescing full outer join. With a large delta both joins share one
    shuffle of the catalog."""
    key_cols = list(key_cols)
    keys = delta.select(*[q(k) for k in key_cols])
    keep = catalog.join(keys, key_cols, "left_anti")
    hit = catalog.join(keys, key_cols, "left_semi")
    out = keep.unionByName(coalesce_upsert(hit, delta, key_cols, order_cols), allowMissingColumns=True)
    return out.select(*[q(c) for c in merge_column_order(list(delta.columns), list(catalog.columns))])


# ---------------------------------------------------------------- WIN-3
SEQ_OF = "_seq_of_"  # hidden column: the file sequence of a column's current value


def without_sequences(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(SEQ_OF)])


def fold_files(frames: DataFrame, key_cols: Sequence[str] = (KEY,), file_col: str = FILE_SEQ,
               order_cols: Sequence[str] = (ROW_SEQ,), keep_sequences: bool = False) -> DataFrame:
    """Repeated coalescing upserts of files in ``file_col`` order, in one
    aggregation: per key and column the last non-null value by file order.
    Rows must already be one per (key, file) (AGG-1 first).

    ``keep_sequences`` adds a hidden ``_seq_of_<column>`` per value column, the
    sequence of the value that won. Rows that carry such columns (a stored
    catalog) are folded by them, so the outcome does not depend on the order
    in which files arrive.

    ``max_by`` has a partial aggregate, so a hot key is combined map-side.
    """
    key_cols = list(key_cols)
    here = F.struct(q(file_col), *[q(c) for c in order_cols if c in frames.columns])
    values = [c for c in frames.columns if c not in key_cols and c != file_col and c not in order_cols
              and not c.startswith(SEQ_OF)]
    seq = here

    def won(c: str):
        stamp = F.coalesce(q(SEQ_OF + c), here) if SEQ_OF + c in frames.columns else here
        return F.when(q(c).isNotNull(), stamp)

    aggs = [F.max_by(q(c), won(c)).alias(c) for c in values]
    if keep_sequences:
        aggs += [F.max(won(c)).alias(SEQ_OF + c) for c in values]
    aggs.append(F.max(q(file_col)).alias(file_col))
    aggs += [F.max_by(q(c), seq).alias(c) for c in order_cols if c in frames.columns]
    return frames.groupBy(*[q(k) for k in key_cols]).agg(*aggs)


def fold_into(catalog: DataFrame, rows: DataFrame, key_cols: Sequence[str] = (KEY,),
              file_col: str = FILE_SEQ, order_cols: Sequence[str] = (ROW_SEQ,)) -> DataFrame:
    """Incremental WIN-3: only keys present in ``rows`` are re-folded. Rows of
    untouched keys pass through an anti join against the batch's key set —
    a batch-sized frame that Catalyst broadcasts when its estimate is small,
    so the catalog is scanned but not shuffled. A catalog folded with
    ``keep_sequences`` takes files in any order."""
    key_cols = list(key_cols)
    touched = rows.select(*[q(k) for k in key_cols]).distinct()
    keep = catalog.join(touched, key_cols, "left_anti")
    redo = catalog.join(touched, key_cols, "left_semi").unionByName(rows, allowMissingColumns=True)
    folded = fold_files(redo, key_cols, file_col, order_cols, keep_sequences=True)
    return keep.unionByName(folded, allowMissingColumns=True)


# ---------------------------------------------------------------- WIN-1
def post_order(df: DataFrame, out: str = "post_order", group_cols: Sequence[str] = (),
               order_cols: Sequence[str] = (FILE_SEQ, ROW_SEQ)) -> DataFrame:
    """Dense running number by (file, row) order, computed without a
    single-partition window (range partitioning + per-partition offsets)."""
    return sequence_within(df, list(group_cols), [(c, True, True) for c in order_cols], out)


# ---------------------------------------------------------------- SET-1 / PRJ-11
def append_rows(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """Bag union by column name; missing columns become NULL (schema evolution)."""
    return catalog.unionByName(rows, allowMissingColumns=True)


def evolve_schema(frames: Sequence[DataFrame]) -> DataFrame:
    """PRJ-11: union of frames with different columns, column order merged."""
    out = frames[0]
    order = list(out.columns)
    for f in frames[1:]:
        order = merge_column_order(list(f.columns), order)
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*[q(c) for c in order])


# ---------------------------------------------------------------- PRJ-12
def merge_column_order(new: list[str], old: list[str]) -> list[str]:
    """The new file's order leads; each column only in ``old`` is placed next to
    its nearest surviving neighbour: after the closest previous one, else
    directly before the closest next one (D14), else at the end."""
    out = list(new)
    placed = set(out)
    for i, c in enumerate(old):
        if c in placed:
            continue
        pos = None
        for d in range(1, len(old)):
            lo, hi = i - d, i + d
            if lo >= 0 and old[lo] in placed:
                pos = out.index(old[lo]) + 1
                break
            if hi < len(old) and old[hi] in placed:
                pos = out.index(old[hi])
                break
            if lo < 0 and hi >= len(old):
                break
        if pos is None:
            out.append(c)
        else:
            out.insert(pos, c)
        placed.add(c)
    return out


def project_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """SNK-5: only data columns, in the merged order, control columns dropped."""
    keep = [c for c in order if c in df.columns and c not in CONTROL_COLUMNS]
    return df.select(*[q(c) for c in keep])


# ---------------------------------------------------------------- AGG-5
def load_stats(catalog: DataFrame, delta: DataFrame, key_cols: Sequence[str] = (KEY,),
               by: Sequence[str] = ()) -> DataFrame:
    """Rows per outcome: ``dropped_null_key``, ``added`` or ``updated``.

    One left join against the distinct catalog keys, then a partial-aggregated
    count; null keys never enter the join shuffle.
    """
    key_cols = list(key_cols)
    null_key = F.lit(False)
    for k in key_cols:
        null_key = null_key | q(k).isNull()
    nulls = delta.filter(null_key).select(*[q(b) for b in by], F.lit("dropped_null_key").alias("outcome"))
    present = catalog.select(*[q(k) for k in key_cols]).distinct().withColumn("_hit", F.lit(True))
    rest = (delta.filter(~null_key).join(present, key_cols, "left")
            .select(*[q(b) for b in by],
                    F.when(F.col("_hit").isNull(), F.lit("added")).otherwise(F.lit("updated")).alias("outcome")))
    return (nulls.unionByName(rest).groupBy(*[q(b) for b in by], "outcome")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))
