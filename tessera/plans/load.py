"""PIP-2: load a batch of related tables into the catalog, parents first.

Per table, in topological order of the FK graph:
  * relative PK: incoming rows whose key exists take the catalog PK (JON-3),
    new rows get fresh PKs per file (WIN-2); the (file, old, new) map
    rewrites the FKs of the children (JON-4) before those are keyed;
  * key + merge duplicates per file (AGG-1), then fold the files and upsert
    into the catalog (WIN-3 + JON-2).
Orphans are cleaned once per batch afterwards (JON-8, D18).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.relations import assign_pk, orphan_cascade, pk_seed, remap_fk
from tessera.operators.transforms import FILE_SEQ, KEY, ROW_SEQ
from tessera.operators.upsert import fold_files, upsert_into
from tessera.plans.prepare import files_with_bad_keys, key_and_merge, merged_keys
from tessera.session import materialize
from tessera.spec import CatalogSpec


def _as_long(df: DataFrame, col: str):
    """Text that is no integer becomes null instead of failing the batch."""
    c = F.col(f"`{col}`")
    return c.try_cast("bigint") if dict(df.dtypes)[col] == "string" else c.cast("bigint")


def _without_bad_files(delta: Mapping[str, DataFrame], spec: CatalogSpec,
                       strict: bool) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """``delta`` without the files that PRJ-10 or strict FK resolution rejects,
    in all tables alike, and those files."""
    found = None
    for t, rows in delta.items():
        parts = [files_with_bad_keys(rows, spec.tables[t], spec)]
        for fk in spec.tables[t].fks if strict else ():
            parent = spec.tables.get(fk.parent)
            if parent is not None and parent.pk is not None and parent.pk.relative and fk.name in rows.columns:
                used = rows.select(FILE_SEQ, F.col(f"`{fk.name}`").cast("string").alias("_pk")).where("_pk IS NOT NULL").distinct()
                if fk.parent in delta:
                    used = used.join(delta[fk.parent].select(FILE_SEQ, F.col(f"`{parent.pk.name}`").cast("string").alias("_pk")),
                                     [FILE_SEQ, "_pk"], "left_anti")
                parts.append(used.select(FILE_SEQ).distinct().withColumn("reason", F.lit("unresolved_reference")))
        for p in parts:
            if p is not None:
                found = p if found is None else found.unionByName(p)
    if found is None:
        return dict(delta), None
    found = materialize(found.groupBy(FILE_SEQ).agg(F.min("reason").alias("reason")))
    if found.isEmpty():
        return dict(delta), None
    return {t: rows.join(found.select(FILE_SEQ), FILE_SEQ, "left_anti") for t, rows in delta.items()}, found


def load_related(catalog: Mapping[str, DataFrame], delta: Mapping[str, DataFrame], spec: CatalogSpec,
                 key_mode: str = "concat", clean_orphans: bool = True,
                 checkpoint_tables: bool = True, strict: bool = False,
                 rejects: list[DataFrame] | None = None,
                 near: Callable[[str, DataFrame], DataFrame | None] | None = None,
                 seed: Callable[[str, str], DataFrame | int] | None = None) -> dict[str, DataFrame]:
    """``catalog`` tables carry ``_key``, ``_file_seq``, ``_row_seq``; ``delta``
    tables are enriched scans (see ``prepare.enrich``) with ``_file_seq``.

    ``checkpoint_tables`` cuts the lineage of every updated table (for callers
    that chain loads in memory); a caller that writes a catalog version right
    afterwards passes False and saves the copy.

    A file with a key that is no integer is left out of every table; so is,
    with ``strict`` (D12), a file whose FK names a relative PK that the file
    itself does not post. ``rejects`` receives ``(_file_seq, reason)`` frames
    of such files.

    A caller whose tables are stored in parts gives ``near(table, keys)``, the stored
    rows that may have one of ``keys`` (None: no such table), and ``seed(table, pk)``,
    the next free PK. What comes back for a table is then that part upserted, or
    for a table without key the new rows alone."""
    out = dict(catalog)
    maps: dict[str, DataFrame] = {}
    delta, bad = _without_bad_files(delta, spec, strict)
    if rejects is not None and bad is not None:
        rejects.append(bad)
    merged = {t: m for t in delta if (m := merged_keys(delta[t], spec.tables[t], spec, key_mode)) is not None}
    for t in spec.topological_order():
        if t not in delta:
            continue
        ts = spec.tables[t]
        rows = delta[t]
        for fk in ts.fks:  # JON-5: FKs of PKs that merging dropped follow the survivor, inside their file
            if fk.parent in merged and fk.name in rows.columns:
                rows = remap_fk(rows, merged[fk.parent], fk.name, file_col=FILE_SEQ, old_col="old_pk", new_col="survivor")
        for fk in ts.fks:  # JON-4: follow the parents' new PKs
            if fk.parent in maps and fk.name in rows.columns:
                rows = remap_fk(rows.withColumn(fk.name, _as_long(rows, fk.name)), maps[fk.parent],
                                fk.name, file_col=FILE_SEQ, old_col="old_pk", new_col="new_pk")
        # Stage boundary: the keyed, merged delta of this table is used by
        # the PK map, the upsert and the children, so it is computed once.
        rows = materialize(key_and_merge(rows, ts, spec, key_mode))
        old = out.get(t) if near is None or not ts.key else near(t, rows.select(KEY).distinct())
        if ts.pk is not None and ts.pk.relative and ts.key:
            pk = ts.pk.name
            if old is not None:
                ref = old.select(KEY, F.col(pk).cast("bigint").alias("_ref"))
                matched = rows.join(ref, KEY, "left")
            else:
                matched = rows.withColumn("_ref", F.lit(None).cast("bigint"))
            first = seed(t, pk) if seed is not None else pk_seed(old, pk) if old is not None else 1
            adds = assign_pk(matched.filter(F.col("_ref").isNull()).drop("_ref"), pk, first, FILE_SEQ, "_new")
            upd = matched.filter(F.col("_ref").isNotNull()).withColumn("_new", F.col("_ref")).drop("_ref")
            both = materialize(adds.unionByName(upd))
            maps[t] = both.select(FILE_SEQ, _as_long(both, pk).alias("old_pk"),
                                  F.col("_new").alias("new_pk"))
            rows = both.withColumn(pk, F.col("_new")).drop("_new")
        folded = fold_files(rows, [KEY], FILE_SEQ, [ROW_SEQ]) if ts.key else rows
        if old is not None and ts.key:
            out[t] = upsert_into(old, folded, [KEY], (FILE_SEQ, ROW_SEQ))
        elif t in out:
            out[t] = out[t].unionByName(folded, allowMissingColumns=True)
        else:
            out[t] = folded
        if checkpoint_tables:
            out[t] = materialize(out[t])
    if clean_orphans:
        out = orphan_cascade(out, spec)
    return out
