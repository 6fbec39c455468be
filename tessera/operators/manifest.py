"""File-manifest operators FIL-1..11 over a DataFrame of files.

A manifest is any frame with a path/name column (``binaryFile`` metadata
columns, or columns derived from a table). The reference moves files one by
one; here each rule is a column or a join, and file moves are a *plan* frame
(``action``, ``target``) that a storage job can execute.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ranking import sequence_within
from tessera.functions.regex import matches
from tessera.operators.transforms import q

UNKNOWN = "unknown"


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


# ---------------------------------------------------------------- FIL-1
def ignore_filter(df: DataFrame, rules: Sequence[str], path_col: str = "path",
                  name_col: str | None = None) -> DataFrame:
    """Drop files matched by an ignore rule: a literal is an exact basename;
    ``re:<pattern>`` is searched in the relative path or matched on the basename."""
    name = q(name_col) if name_col else basename(q(path_col))
    lits = [r for r in rules if not r.startswith("re:")]
    pats = [r[3:] for r in rules if r.startswith("re:")]
    hit = name.isin(lits) if lits else F.lit(False)
    for p in pats:
        hit = hit | matches(q(path_col), p, anywhere=True) | matches(name, p)
    return df.filter(~F.coalesce(hit, F.lit(False)))


# ---------------------------------------------------------------- FIL-2
def classify(name: Column, metadata_rules: Mapping[str, str], data_rules: Mapping[str, str],
             unknown: str = UNKNOWN) -> Column:
    """Metadata rules first, then data rules, in spec order; the first rule
    whose pattern matches at the start of the basename wins."""
    expr = None
    for cls, pat in list(metadata_rules.items()) + list(data_rules.items()):
        cond = matches(name, pat)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return F.lit(unknown) if expr is None else expr.otherwise(F.lit(unknown))


# ---------------------------------------------------------------- FIL-3 / FIL-4
def content_hash(content: Column) -> Column:
    return F.md5(content)


def first_arrivals(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """FIL-4: of files with the same name and the same content (``key_cols``)
    keep the first arrival by ``order_cols``. A partial aggregate (``min`` of a
    struct), so a file posted a million times is combined map-side."""
    rest = [c for c in df.columns if c not in key_cols]
    first = F.min(F.struct(*[q(c) for c in order_cols], *[q(c) for c in rest if c not in order_cols]))
    return (df.groupBy(*[q(k) for k in key_cols]).agg(first.alias("_f"))
            .select(*[q(k) for k in key_cols], *[F.col("_f")[c].alias(c) for c in rest]))


# ---------------------------------------------------------------- FIL-5 / FIL-6
def name_versions(df: DataFrame, stem_col: str, order_cols: Sequence, ext: Column | str = "",
                  max_variations: int = 100, out_name: str = "file_name",
                  stamp_col: str | None = None) -> DataFrame:
    """Number the files sharing a stem in arrival order (skew-safe), then name
    them ``stem`` / ``stem-n`` and plan ``keep`` / ``rename`` / ``reject`` (over
    the variation limit).

    With ``stamp_col`` (a timestamp), renamed copies are
    ``stem_YYYYMMDD_HHMMSS`` and further clashes within one stamp add ``-n``:
    numbering runs per (stem, stamp); the first file of a stem keeps its name."""
    if stamp_col is None:
        ranked = sequence_within(df, [stem_col], list(order_cols), "_v")
        n = F.col("_v") - 1
        ext_c = F.lit(ext) if isinstance(ext, str) else ext
        name = F.when(n == 0, F.concat(q(stem_col), ext_c)).otherwise(
            F.concat(q(stem_col), F.lit("-"), n.cast("string"), ext_c))
        action = (F.when(n > max_variations, F.lit("reject")).when(n > 0, F.lit("rename"))
                  .otherwise(F.lit("keep")))
        return ranked.withColumn(out_name, name).withColumn("action", action).withColumn("version", n).drop("_v")
    ext_c = F.lit(ext) if isinstance(ext, str) else ext
    ranked = sequence_within(df, [stem_col], list(order_cols), "_v")
    stamped = ranked.withColumn("_stamp", F.date_format(q(stamp_col), "yyyyMMdd_HHmmss"))
    renamed = stamped.filter(F.col("_v") > 1)
    renamed = sequence_within(renamed, [stem_col, "_stamp"], list(order_cols), "_k")
    k = F.col("_k") - 1
    rname = F.concat(q(stem_col), F.lit("_"), F.col("_stamp"),
                     F.when(k > 0, F.concat(F.lit("-"), k.cast("string"))).otherwise(F.lit("")), ext_c)
    renamed = renamed.withColumn(out_name, rname).withColumn(
        "action", F.when(k > max_variations, F.lit("reject")).otherwise(F.lit("rename")))
    first = stamped.filter(F.col("_v") == 1).withColumn(out_name, F.concat(q(stem_col), ext_c)) \
        .withColumn("action", F.lit("keep"))
    return first.unionByName(renamed.drop("_k")).withColumn("version", F.col("_v") - 1).drop("_v", "_stamp")


def conflict_action(exists: Column, same_content: Column, overwrite: bool) -> Column:
    """FIL-6: what to do with an incoming file whose name exists at the target."""
    if overwrite:
        return F.when(exists, F.lit("overwrite")).otherwise(F.lit("move"))
    return (F.when(exists & same_content, F.lit("drop_identical"))
            .when(exists, F.lit("rename_older")).otherwise(F.lit("move")))


# ---------------------------------------------------------------- FIL-7
def expired(df: DataFrame, time_col: str, now: Column, hours: float) -> DataFrame:
    """Files older than the clean period at ``now``."""
    return df.filter(q(time_col) < now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600)))


def clean_due(last_clean: Column, now: Column, hours: float) -> Column:
    return now - last_clean > F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600))


# ---------------------------------------------------------------- FIL-8
def mirror_diff(presence: DataFrame, folder_col: str, file_col: str,
                folders: Sequence[str] | None = None) -> DataFrame:
    """For every folder, the files present in some other folder but not in it.

    The folder list is configuration (mirror targets): pass it as ``folders``
    and it is a literal array. When it is derived from the data instead, it is
    one array too: every file that a folder lacks is a row of the result, so
    the list is never what outgrows a task.
    Each file collects the folders holding it (partial aggregation, at most
    one entry per folder) and the difference is exploded: no pair loop and
    no cross join."""
    pairs = presence.select(q(folder_col).alias("_folder"), q(file_col).alias("_file")).distinct()
    if folders is not None:
        all_folders = F.array(*[F.lit(f) for f in sorted(set(folders))])
        pairs = pairs.filter(F.col("_folder").isin(sorted(set(folders))))
    else:
        all_folders = pairs.select(F.array_sort(F.collect_set("_folder"))).scalar()
    per_file = pairs.groupBy("_file").agg(F.collect_set("_folder").alias("_in"))
    return per_file.select(F.explode(F.array_except(all_folders, F.col("_in"))).alias("missing_in"),
                           F.col("_file").alias(file_col))


# ---------------------------------------------------------------- FIL-9 / FIL-10
def fan_out(df: DataFrame, class_col: str, targets: Mapping[str, Sequence[str]], out: str = "folder") -> DataFrame:
    """FIL-9: each file once per target folder of its class. The class -> folders
    map is configuration, so it is a literal map column: no join, no shuffle."""
    if not any(targets.values()):
        return df.withColumn(out, F.lit(None).cast("string")).filter(F.lit(False))
    items = []
    for k, v in targets.items():
        items += [F.lit(k), F.array(*[F.lit(x) for x in v]).cast("array<string>")]
    m = F.create_map(*items)
    return df.withColumn(out, F.explode(F.element_at(m, q(class_col)))).filter(F.col(out).isNotNull())


def store_plan(df: DataFrame, stores: Sequence[str], out: str = "folder") -> DataFrame:
    """FIL-10: each processed metadata file once per store folder."""
    return df.withColumn(out, F.explode(F.array(*[F.lit(s) for s in stores])))


# ---------------------------------------------------------------- FIL-11
def reject_files(files: DataFrame, produced: DataFrame, file_col: str, reason: str = "no_usable_table") -> DataFrame:
    """Files that produced no row of any table."""
    return (files.join(produced.select(q(file_col)).distinct(), file_col, "left_anti")
            .select(q(file_col), F.lit(reason).alias("reason")))


# ---------------------------------------------------------------- SET-2
def files_to_process(files: DataFrame, done: DataFrame, key_cols: Sequence[str] = ("path",)) -> DataFrame:
    """Set difference: listed files not yet processed (or still pending)."""
    return files.join(done.select(*[q(k) for k in key_cols]).distinct(), list(key_cols), "left_anti")


def placement_actions(plan: DataFrame, existing: DataFrame | None, overwrite: bool,
                      folder_col: str = "folder", name_col: str = "file_name") -> DataFrame:
    """FIL-6 + FIL-9: for each planned (file ``path``, target folder), whether
    the name already exists there and what to do (``move`` / ``overwrite`` /
    ``drop_identical`` / ``rename_older``); ``replaces`` is the file that is there.
    ``existing`` lists the targets as ``(folder, file_name, path)``. Contents are
    hashed only for colliding names (FIL-3), never for the rest: a batch has no
    more of them than planned files, and their paths are what the driver holds."""
    if existing is None:
        return plan.withColumn("action", F.lit("move")).withColumn("replaces", F.lit(None).cast("string"))
    ex = existing.select(q(folder_col), q(name_col), F.col("path").alias("replaces"))
    joined = plan.join(ex, [folder_col, name_col], "left")
    spark = plan.sparkSession
    same = F.lit(False)
    clash = [] if overwrite else joined.filter(F.col("replaces").isNotNull()).select("path", "replaces").collect()
    if clash:
        paths = sorted({p for r in clash for p in (r[0], r[1])})
        hashes = spark.read.format("binaryFile").load(paths).select(
            F.col("path").alias("_hp"), content_hash(F.col("content")).alias("_h"))
        joined = (joined.join(hashes.withColumnRenamed("_hp", "path").withColumnRenamed("_h", "_new_h"), "path", "left")
                  .join(hashes.withColumnRenamed("_hp", "replaces").withColumnRenamed("_h", "_old_h"), "replaces", "left"))
        same = F.coalesce(F.col("_new_h") == F.col("_old_h"), F.lit(False))
    action = conflict_action(F.col("replaces").isNotNull(), same, overwrite)
    return joined.withColumn("action", action).drop("_new_h", "_old_h")
