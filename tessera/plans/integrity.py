"""JON-6, JON-7 and JON-8 over batches: references are checked for what a batch
changed, not for the whole key graph.

Two narrow tables per parent are kept in the store beside the catalog, in buckets
of the parent's key value:

* ``__pk_<parent>``   ``(pk, _key)``: which rows hold a key value;
* ``__refs_<parent>`` ``(pk, n)``: how many child rows refer to it.

A batch gives, for every row it added or changed, the old and the new key values.
Parents first, new foreign keys are looked up in ``__pk_``; children of key values
that vanished are looked for only if one did. Children first, counts are moved by
the difference, and parents whose count falls to nothing, or that are new and
have none, go. What goes in one table is a difference for the next, so the
cascade ends where the two passes over whole tables end."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.relations import orphan_cascade
from tessera.operators.transforms import KEY, q
from tessera.plans.catalog import Catalog, Stored
from tessera.session import materialize
from tessera.spec import CatalogSpec


def _pk_table(parent: str) -> str:
    return f"__pk_{parent}"


def _refs_table(parent: str) -> str:
    return f"__refs_{parent}"


def _text(df: DataFrame, name: str | None):
    return q(name).cast("string") if name is not None and name in df.columns else F.lit(None).cast("string")


class _Edges:
    """The foreign keys between tables that the catalog holds."""

    def __init__(self, cat: Catalog, spec: CatalogSpec):
        self.spec = spec
        self.order = [t for t in spec.topological_order() if t in cat]
        self.up = {t: [fk for fk in spec.tables[t].fks
                       if fk.parent in cat and spec.tables[fk.parent].pk is not None] for t in self.order}
        self.down = {p: [(c, i) for c in self.order for i, fk in enumerate(self.up[c]) if fk.parent == p] for p in self.order}
        self.parents = [p for p in self.order if self.down[p]]
        self.tables = [t for t in self.order if self.up[t] or self.down[t]]

    def keys(self, df: DataFrame, table: str, prefix: str = "") -> DataFrame:
        """``_key``, the row's own key value and its foreign keys, as text."""
        pk = self.spec.tables[table].pk
        return df.select(KEY, _text(df, pk.name if pk else None).alias(f"{prefix}pk"),
                         *[_text(df, fk.name).alias(f"{prefix}fk{i}") for i, fk in enumerate(self.up[table])])

    def asks(self) -> bool:
        return any(fk.delete_orphan for t in self.order for fk in self.up[t]) or any(
            self.spec.tables[p].pk.delete_orphan for p in self.parents)


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, frames) if frames else None


def _build(cat: Catalog, edges: _Edges) -> None:
    """The key and count tables from whole tables."""
    for p in edges.parents:
        held = edges.keys(cat.frame(p), p).where("pk IS NOT NULL").select("pk", KEY)
        cat.put(_pk_table(p), held, ["pk"])
        refs = _union([edges.keys(cat.frame(c), c).select(F.col(f"fk{i}").alias("pk")) for c, i in edges.down[p]])
        cat.put(_refs_table(p), refs.where("pk IS NOT NULL").groupBy("pk").agg(F.count(F.lit(1)).alias("n")), ["pk"])


def _drop_rows(cat: Catalog, table: str, keys: DataFrame) -> None:
    buckets = cat.buckets_of(table, keys)
    cat.put_buckets(table, cat.frame(table, buckets).join(keys, KEY, "left_anti"), buckets)


def _clean_whole(cat: Catalog, edges: _Edges) -> dict[str, int]:
    """Both passes over whole tables, for the first batch of a table."""
    tables = {t: cat.frame(t) for t in edges.order}
    cleaned = orphan_cascade(tables, edges.spec)
    gone = {}
    for t in edges.order:
        if cleaned[t] is tables[t]:
            continue
        before = cat.frame(t).count()
        if cat.tables[t].kind == "buckets":
            cat.put(t, cleaned[t], cat.tables[t].key, cat.tables[t].buckets)
        else:
            kept = materialize(cleaned[t])
            cat.drop(t)
            cat.append(t, kept)
        gone[t] = before - cat.frame(t).count()
    return gone


def clean(cat: Catalog, before: Mapping[str, Stored], posted: Mapping[str, DataFrame], touched: Mapping[str, list[int]],
          spec: CatalogSpec) -> dict[str, int]:
    """Removes from ``cat`` the rows that the spec's orphan rules ask for after a batch;
    the number of rows that went, per table.

    ``before`` are the tables as they were, ``posted`` the keys (``_key``) that the batch
    wrote and ``touched`` the buckets it wrote them to. Tables whose first rows came
    with this batch, and tables without row keys, are checked whole."""
    edges = _Edges(cat, spec)
    if not edges.asks():
        return {}
    keyed = all(cat.tables[t].kind == "buckets" for t in edges.tables)
    known = all(t in before for t in edges.tables) and all(
        _pk_table(p) in cat and _refs_table(p) in cat for p in edges.parents)
    if not keyed or not known:
        gone = _clean_whole(cat, edges)
        if keyed:
            _build(cat, edges)
        return gone

    changes: dict[str, DataFrame] = {}
    for t in edges.tables:
        if t in posted:
            mine = posted[t].select(KEY).distinct()
            new = edges.keys(cat.frame(t, touched[t]).join(mine, KEY, "left_semi"), t, "new_")
            old = edges.keys(cat.frame_of(before[t], touched[t]).join(mine, KEY, "left_semi"), t, "old_")
            both = new.join(old.withColumn("existed", F.lit(True)), KEY, "left")
            names = ["pk", *[f"fk{i}" for i in range(len(edges.up[t]))]]
            same = reduce(lambda a, b: a & b, [F.col(f"new_{n}").eqNullSafe(F.col(f"old_{n}")) for n in names])
            # a row whose keys stayed changes nothing
            diff = materialize(both.where(F.col("existed").isNull() | ~same))
            if not diff.isEmpty():
                changes[t] = diff
    if not changes:
        return {}
    removed: dict[str, DataFrame] = {}

    def remove(t: str, keys: DataFrame) -> None:
        keys = keys.select(KEY)
        keys = materialize((keys if t not in removed else keys.unionByName(removed[t])).distinct())
        if not keys.isEmpty():
            removed[t] = keys

    def current(t: str, keys: DataFrame) -> DataFrame:
        """The key values of some rows as the batch left them."""
        return edges.keys(cat.frame(t, cat.buckets_of(t, keys)).join(keys, KEY, "left_semi"), t)

    def holders(p: str, pks: DataFrame) -> DataFrame:
        """``(pk, _key)``: the rows of ``p`` that hold one of ``pks`` now."""
        table = _pk_table(p)
        found = cat.frame(table, cat.buckets_of(table, pks)).join(pks, "pk", "left_semi").select("pk", KEY)
        if p in changes:
            found = found.join(changes[p].select(KEY), KEY, "left_anti").select("pk", KEY).unionByName(
                changes[p].select(F.col("new_pk").alias("pk"), KEY).join(pks, "pk", "left_semi").select("pk", KEY))
        return found.join(removed[p], KEY, "left_anti").select("pk", KEY) if p in removed else found

    # ------------------------------------------------ parents first: dead references
    for t in edges.order:
        for i, fk in enumerate(edges.up[t]):
            p = fk.parent
            if not fk.delete_orphan:
                continue
            if t in changes:
                mine = changes[t].select(KEY, F.col(f"new_fk{i}").alias("pk")).where("pk IS NOT NULL")
                asked = materialize(mine.select("pk").distinct())
                if not asked.isEmpty():
                    remove(t, mine.join(holders(p, asked).select("pk").distinct(), "pk", "left_anti"))
            lost = []
            if p in changes:
                lost.append(changes[p].where("existed AND old_pk IS NOT NULL AND NOT old_pk <=> new_pk").select(F.col("old_pk").alias("pk")))
            if p in removed:
                lost.append(current(p, removed[p]).where("pk IS NOT NULL").select("pk"))
            if lost:
                asked = materialize(_union(lost).distinct())
                vanished = materialize(asked.join(holders(p, asked).select("pk").distinct(), "pk", "left_anti")) if not asked.isEmpty() else asked
                if not vanished.isEmpty():  # only now are the children of other batches read, two columns of them
                    children = edges.keys(cat.frame(t), t).select(KEY, F.col(f"fk{i}").alias("pk"))
                    remove(t, children.join(vanished, "pk", "left_semi"))
    # ------------------------------------------------ children first: unreferenced parents
    moves: dict[str, DataFrame] = {}
    for p in reversed(edges.order):
        if not edges.down[p]:
            continue
        parts = []
        for c, i in edges.down[p]:
            if c in changes:
                parts.append(changes[c].where("existed").select(F.col(f"old_fk{i}").alias("pk"), F.lit(-1).cast("long").alias("d")))
                parts.append(changes[c].select(F.col(f"new_fk{i}").alias("pk"), F.lit(1).cast("long").alias("d")))
            if c in removed:
                parts.append(current(c, removed[c]).select(F.col(f"fk{i}").alias("pk"), F.lit(-1).cast("long").alias("d")))
        if parts:
            net = _union(parts).where("pk IS NOT NULL").groupBy("pk").agg(F.sum("d").alias("d")).where("d <> 0")
            moves[p] = materialize(net)
        if not spec.tables[p].pk.delete_orphan:
            continue
        asked = []
        if p in moves:
            asked.append(moves[p].where("d < 0").select("pk"))
        if p in changes:
            asked.append(changes[p].where("new_pk IS NOT NULL").select(F.col("new_pk").alias("pk")))
        if not asked:
            continue
        pks = materialize(_union(asked).distinct())
        gone = []
        if not pks.isEmpty():
            table = _refs_table(p)
            refs = cat.frame(table, cat.buckets_of(table, pks)).join(pks, "pk", "left_semi").select("pk", "n")
            total = pks.join(refs, "pk", "left")
            if p in moves:
                total = total.join(moves[p], "pk", "left")
            else:
                total = total.withColumn("d", F.lit(0))
            none = total.where("coalesce(n, 0) + coalesce(d, 0) <= 0").select("pk")
            gone.append(holders(p, materialize(none)).select(KEY))
        if p in changes:
            gone.append(changes[p].where("new_pk IS NULL").select(KEY))  # nobody refers to a null
        if gone:
            remove(p, _union(gone))
    # ------------------------------------------------ the tables of the next batch
    for p in edges.parents:
        table = _pk_table(p)
        out, add = [], None
        if p in changes:
            out.append(changes[p].where("existed AND old_pk IS NOT NULL").select(F.col("old_pk").alias("pk"), KEY))
            add = changes[p].where("new_pk IS NOT NULL").select(F.col("new_pk").alias("pk"), KEY)
        if p in removed:
            out.append(current(p, removed[p]).where("pk IS NOT NULL").select("pk", KEY))
            add = add.join(removed[p], KEY, "left_anti").select("pk", KEY) if add is not None else None
        if out:
            out = materialize(_union(out).distinct())
            pks = out.select("pk") if add is None else out.select("pk").unionByName(add.select("pk"))
            buckets = cat.buckets_of(table, pks)
            kept = cat.frame(table, buckets).join(out, ["pk", KEY], "left_anti")
            cat.put_buckets(table, kept if add is None else kept.unionByName(add), buckets)
        if p in moves:
            table = _refs_table(p)
            buckets = cat.buckets_of(table, moves[p])
            if buckets:
                now = cat.frame(table, buckets).unionByName(moves[p].withColumnRenamed("d", "n")).groupBy("pk").agg(F.sum("n").alias("n"))
                cat.put_buckets(table, now.where("n <> 0"), buckets)
    counts = {}
    for t, keys in removed.items():
        counts[t] = keys.count()
        _drop_rows(cat, t, keys)
    return counts
