"""Keys across tables: AGG-4, JON-3..8, JON-12, WIN-2 and dense ids (D4).

Joins are written as equi-joins on key columns; Catalyst picks broadcast
only when its size estimate is under ``spark.sql.autoBroadcastJoinThreshold``
(that threshold is the size check), otherwise a shuffled join, and AQE
splits skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ranking import running_total, sequence_within
from tessera.operators.transforms import FILE_SEQ, KEY, q


# ---------------------------------------------------------------- AGG-4
def pk_seed(df: DataFrame, pk: str, by: Sequence[str] = (), out: str = "next_pk") -> DataFrame:
    """``max(pk) + 1`` (1 for an empty table), optionally per group."""
    agg = (F.coalesce(F.max(q(pk)).cast("bigint"), F.lit(0)) + 1).alias(out)
    return df.groupBy(*[q(b) for b in by]).agg(agg)


# ---------------------------------------------------------------- JON-3
def reconcile_pk(catalog: DataFrame, delta: DataFrame, key_cols: Sequence[str], pk: str,
                 file_col: str | None = None) -> DataFrame:
    """Incoming rows whose business key is in the catalog take the catalog's
    PK. Returns the map ``(file?, old_pk, ref_pk)`` for the FK rewrite."""
    key_cols = list(key_cols)
    ref = catalog.select(*[q(k) for k in key_cols], q(pk).alias("ref_pk"))
    cols = ([q(file_col)] if file_col else []) + [q(pk).alias("old_pk"), F.col("ref_pk")]
    return delta.join(ref, key_cols).select(*cols)


# ---------------------------------------------------------------- WIN-2
def assign_pk(delta: DataFrame, pk: str, next_pk: int | DataFrame, file_col: str = FILE_SEQ,
              out: str = "new_pk") -> DataFrame:
    """New relative PKs: per file ``new = old - min(old) + next``, where each
    file's ``next`` follows the previous file's range (D3: ``next += max-min+1``).

    Per-file min/max is a partial aggregate; the running offset over files is
    a running total computed without a single-partition window; the offsets
    (one row per file) join back on the file column.
    """
    per_file = delta.groupBy(q(file_col)).agg(F.min(q(pk)).cast("bigint").alias("_lo"),
                                              F.max(q(pk)).cast("bigint").alias("_hi"))
    per_file = per_file.withColumn("_w", F.col("_hi") - F.col("_lo") + 1)
    per_file = running_total(per_file, [], [(file_col, True, True)], "_w", "_through")
    if isinstance(next_pk, DataFrame):
        # one-row frame -> scalar subquery
        per_file = per_file.withColumn("_seed", next_pk.select(F.col(next_pk.columns[0]).cast("bigint")).scalar())
    else:
        per_file = per_file.withColumn("_seed", F.lit(int(next_pk)).cast("bigint"))
    offsets = per_file.select(q(file_col), "_lo", (F.col("_seed") + F.col("_through") - F.col("_w")).alias("_next"))
    return (delta.join(offsets, file_col)
            .withColumn(out, (q(pk).cast("bigint") - F.col("_lo") + F.col("_next")).cast("bigint"))
            .drop("_lo", "_next"))


def dense_ids(df: DataFrame, order_cols: Sequence, start: int = 1, out: str = "id") -> DataFrame:
    """D4: dense surrogate ids in a total order, without a single-partition
    window (range partitioning + per-partition counts + offsets)."""
    df = sequence_within(df, [], list(order_cols), out)
    return df.withColumn(out, F.col(out) + F.lit(start - 1))


# ---------------------------------------------------------------- JON-4 / JON-5
def remap_fk(child: DataFrame, pk_map: DataFrame, fk: str, file_col: str | None = None,
             old_col: str = "old_pk", new_col: str = "ref_pk") -> DataFrame:
    """Rewrite the child FK through ``pk_map`` (old -> new); unmapped FKs stay.
    The map is keyed by ``(file, old)`` when ``file_col`` is given."""
    m = pk_map.select(*([q(file_col)] if file_col else []), q(old_col).alias("_old"), q(new_col).alias("_new"))
    c = child.alias("c")
    on = [F.col(f"c.`{fk}`") == F.col("m._old")]
    if file_col:
        on.append(F.col(f"c.`{file_col}`") == F.col(f"m.`{file_col}`"))
    joined = c.join(m.alias("m"), on, "left")
    cols = [F.coalesce(F.col("m._new"), F.col(f"c.`{fk}`").cast(m.schema["_new"].dataType)).alias(c2)
            if c2 == fk else F.col(f"c.`{c2}`") for c2 in child.columns]
    return joined.select(*cols)


def rewrite_merged_fk(child: DataFrame, merged_map: DataFrame, fk: str) -> DataFrame:
    """JON-5: FKs pointing at merged-away PKs follow the survivor (AGG-3 map)."""
    return remap_fk(child, merged_map, fk, old_col="old_pk", new_col="survivor")


# ---------------------------------------------------------------- JON-6 / JON-7
def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Keep child rows whose FK is null or present in the parent. Null FKs
    never enter the join shuffle."""
    keys = parent.select(q(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    c = child.alias("c")
    live = c.join(keys, F.col(f"c.`{fk}`") == F.col("_pk"), "left_semi")
    return child.filter(q(fk).isNull()).unionByName(live)


def parent_orphans(parent: DataFrame, children: Sequence[tuple[DataFrame, str]], pk: str) -> DataFrame:
    """Keep parent rows referenced by at least one configured child FK
    (a null parent PK is never referenced, so it goes too)."""
    refs = None
    for df, fk in children:
        r = df.select(q(fk).alias("_fk")).filter(F.col("_fk").isNotNull())
        refs = r if refs is None else refs.unionByName(r)
    if refs is None:
        return parent
    p = parent.alias("p")
    return p.join(refs.distinct(), F.col(f"p.`{pk}`") == F.col("_fk"), "left_semi")


# ---------------------------------------------------------------- JON-8
def _cascade(out: dict, spec, done) -> dict:
    out = dict(out)
    order = [t for t in spec.topological_order() if t in out]
    for t in order:
        for fk in spec.tables[t].fks:
            parent = spec.tables[fk.parent]
            if fk.delete_orphan and fk.parent in out and parent.pk is not None:
                out[t] = done(fk_orphans(out[t], out[fk.parent], fk.name, parent.pk.name))
    for t in reversed(order):
        ts = spec.tables[t]
        if ts.pk is None or not ts.pk.delete_orphan:
            continue
        kids = [(out[c], fk.name) for c, fk in spec.children_of(t) if c in out]
        if kids:
            out[t] = done(parent_orphans(out[t], kids, ts.pk.name))
    return out


def orphan_cascade(tables: Mapping[str, DataFrame], spec, checkpoint: bool = True,
                   row_id: str = KEY) -> dict[str, DataFrame]:
    """Cascading orphan cleanup to its fixpoint in two passes:
    pass 1 parents-first drops children with dead FKs (where the FK asks for
    it); pass 2 children-first drops unreferenced parents (where the PK asks
    for it). Both rules are monotone, so no iteration is needed: 2 joins per
    FK edge.

    When every table has a row id (the business key), the cascade runs on
    narrow ``(row id, pk, fks)`` frames, checkpointed step by step in the
    shared checkpoint folder; a full table is touched only if rows were
    removed from it (one semi join), otherwise it passes through unchanged.
    Without row ids each cleaned table is checkpointed instead.
    """
    from tessera.session import materialize

    done = materialize if checkpoint else (lambda d: d)
    if not (checkpoint and tables and all(row_id in df.columns for df in tables.values())):
        return _cascade(dict(tables), spec, done)
    narrow = {}
    for t, df in tables.items():
        ts = spec.tables.get(t)
        cols = [row_id]
        if ts is not None and ts.pk is not None and ts.pk.name in df.columns:
            cols.append(ts.pk.name)
        if ts is not None:
            cols += [fk.name for fk in ts.fks if fk.name in df.columns and fk.name not in cols]
        narrow[t] = materialize(df.select(*[q(c) for c in cols]))
    cleaned = _cascade(narrow, spec, done)
    out = {}
    for t, df in tables.items():
        if cleaned[t] is narrow[t] or cleaned[t].count() == narrow[t].count():
            out[t] = df
        else:
            out[t] = df.join(cleaned[t].select(q(row_id)), row_id, "left_semi")
    return out
