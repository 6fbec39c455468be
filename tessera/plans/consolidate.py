"""PIP-3: one batch of posted files, end to end.

files (SRC-7) -> ignore (FIL-1) -> classify (FIL-2) -> hash + first arrival
(FIL-3/4) -> metadata rows (SRC-1/2/3/4) -> table identification (RTE-1) ->
required tables (FLT-2) -> per table: enrich, key, merge (PIP-1) -> load
related tables (PIP-2) into the buckets that their keys fall into -> references
checked for what changed (JON-8) -> link data files (JON-9..11) -> plans of
file moves (FIL-6, FIL-9..11) and load statistics (AGG-5) -> one commit ->
replicas, sorted (SRT, SNK).

Every table is written before it is read again, so nothing is computed twice.
File moves are not executed: they are saved with the version as actions that a
storage job reads and acknowledges (``outbox``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import identify, linking, manifest, sort, upsert
from tessera.operators.relations import pk_seed
from tessera.operators.transforms import FILE_MTIME, FILE_NAME, FILE_PATH, FILE_SEQ, KEY, ROW_SEQ, q, with_key
from tessera.plans import catalog as store
from tessera.plans import integrity, outbox
from tessera.plans.load import load_related
from tessera.plans.prepare import enrich
from tessera.session import gathered, materialize
from tessera.sinks.writers import publish
from tessera.sources.rows import ERROR, metadata_rows
from tessera.sources.scan import list_files
from tessera.spec import DEFAULT_TABLE, FLAG_TRUE, CatalogSpec

WHOLE_FILE_BYTES = 256 << 20    # larger metadata files are not read whole by one task
MOST_FILES = 100_000            # files of one batch: the driver holds what becomes of each


@dataclass
class BatchResult:
    version: int | None
    catalog: dict
    files: DataFrame
    rejected: DataFrame
    publish_plan: DataFrame
    pending: DataFrame
    store_plan: DataFrame | None
    stats: DataFrame | None
    replica_errors: dict = field(default_factory=dict)
    actions: DataFrame | None = None


def target_listing(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """Files already present in the target folders (names and paths only)."""
    out = None
    for f in sorted(set(folders)):
        try:
            lf = list_files(spark, f).select(F.lit(f).alias("folder"), F.col("name").alias("file_name"), "path")
        except FileNotFoundError:  # not there yet
            continue
        out = lf if out is None else out.unionByName(lf)
    return out


def _versioned(data: DataFrame, spec: CatalogSpec) -> tuple[DataFrame, DataFrame | None]:
    """``data`` with ``publish_name``: files that share a name (their contents
    differ, or FIL-4 had dropped them) keep it once, the others get a time
    stamp; those beyond the variation limit are rejected."""
    stem = F.regexp_extract("file_name", r"^(.*?)(\.[^.]*)?$", 1)
    ext = F.regexp_extract("file_name", r"^(.*?)(\.[^.]*)?$", 2)
    shared = data.groupBy("file_name").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("file_name")
    if shared.isEmpty():
        return data.withColumn("publish_name", F.lit(None).cast("string")), None
    crowd = data.join(shared, "file_name", "left_semi").withColumns({"_stem": stem, "_ext": ext})
    plan = manifest.name_versions(crowd, "_stem", ["modificationTime", "path"], F.col("_ext"), spec.max_file_variations,
                                  out_name="publish_name", stamp_col="modificationTime")
    plan = gathered(plan.select("path", "publish_name", "action"))
    out = data.join(plan.where("action <> 'reject'").select("path", "publish_name"), "path", "left")
    over = plan.where("action = 'reject'").select("path", F.lit("too_many_variations").alias("reason"))
    return out.join(over.select("path"), "path", "left_anti"), over


def _table_hint_names(spec: CatalogSpec) -> dict[str, str]:
    """Worksheet display name -> table."""
    out = {}
    for t in spec.table_names:
        shown = spec.display_name(t)
        if shown:
            out[shown] = t
    return out


def identify_tables(spark: SparkSession, rows: DataFrame, spec: CatalogSpec) -> DataFrame:
    """RTE-1 for every (file, table hint). A block named after a table (JSON
    root key, worksheet) goes to it when that table's required columns are
    present. Other blocks (hint ``_``: leftovers, single-table files) are
    identified by their columns: the fitting table with the fewest further
    columns wins, and a tie goes to the hint if it is among the tied tables
    (else the block is unresolved)."""
    required = identify.required_frame(spark, {t: ts.required_columns for t, ts in spec.tables.items()})
    blocks = (rows.select(FILE_PATH, F.col("tbl").alias("hint"), F.explode(F.map_keys("row")).alias("col")).distinct()
              .groupBy(FILE_PATH, "hint").agg(F.collect_set("col").alias("cols")))
    fits = identify.table_candidates(blocks, [FILE_PATH, "hint"], required)
    tied, hint = identify.closest(), F.col("hint")
    named = [t for t in spec.tables if t != DEFAULT_TABLE]
    final = (F.when(hint.isin(named) & F.exists("cands", lambda c: c["t"] == hint), hint)
             .when(F.size(tied) == 1, F.get(tied, F.lit(0))["t"])
             .when(F.exists(tied, lambda c: c["t"] == hint), hint))
    # Blocks no table claims by name (JSON leftovers, unmapped sheets) are only
    # identified by their columns when the default table is mapped or when
    # identification is forced; otherwise they are skipped, not rejected.
    unnamed = ~hint.isin(named) if named else F.lit(True)
    skip = F.lit(False) if (spec.force_identification or DEFAULT_TABLE in spec.table_names) else unnamed
    return fits.select(FILE_PATH, "hint", F.when(~skip, final).alias("table"), skip.alias("skip"))


def _arrivals(spark: SparkSession, spec: CatalogSpec, inputs: list[str]) -> tuple[DataFrame, list]:
    """SRC-7 and FIL-1..4: the files of the batch, listed (contents unread),
    classified, one of each (name, content); and the same as rows on the driver,
    which has listed them (the service bounds a batch)."""
    files = list_files(spark, inputs).select("path", "name", "modificationTime", "length")
    files = manifest.ignore_filter(files, spec.ignore, path_col="path", name_col="name")
    files = files.withColumn("file_class", manifest.classify(F.col("name"), spec.metadata_regex, spec.data_regex))
    listed = files.collect()
    schema = files.schema
    files = spark.createDataFrame(listed, schema).withColumn("md5", F.lit(None).cast("string"))
    seen = Counter(r["name"] for r in listed)
    full = [r["path"] for r in listed if seen[r["name"]] > 1 and r["length"] > 0]
    if any(n > 1 for n in seen.values()):
        # contents are hashed only where two files share a name (the only case the hash decides)
        if full:
            hashes = (spark.read.format("binaryFile").load(full)
                      .select("path", manifest.content_hash(F.col("content")).alias("md5")))
            files = files.drop("md5").join(hashes, "path", "left")
        files = files.withColumn("md5", F.when(F.col("length") == 0, F.md5(F.lit("").cast("binary"))).otherwise(F.col("md5")))
        files = materialize(manifest.first_arrivals(files, ["name", "md5"], ["modificationTime", "path"]).select(*schema.names, "md5"))
        listed = files.select(*schema.names).collect()
    return files, listed


def _read(spark: SparkSession, spec: CatalogSpec, meta: list, encoding: str,
          encodings: DataFrame | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of the metadata files ``meta`` with their ``table`` and file number, and
    what is rejected."""
    paths = [r["path"] for r in meta]
    rows = metadata_rows(spark, paths, list(spec.tables), spec.csv_separator, encoding, _table_hint_names(spec),
                         large=[r["path"] for r in meta if r["length"] > WHOLE_FILE_BYTES], encodings=encodings)
    listed = spark.createDataFrame([(p, i) for i, p in enumerate(paths, 1)], f"{FILE_PATH} string, {FILE_SEQ} long")
    if rows is None:
        return None, [listed.select(F.col(FILE_PATH).alias("path"), F.lit("no_rows").alias("reason"))]
    rows = materialize(rows)
    unread = rows.filter(F.col(ERROR).isNotNull()).select(F.col(FILE_PATH).alias("path"), F.lit("unreadable").alias("reason")).distinct()
    silent = manifest.reject_files(listed.select(F.col(FILE_PATH).alias("path")), rows.select(F.col(FILE_PATH).alias("path")),
                                   "path", "no_rows")
    rows = rows.join(unread.select(F.col("path").alias(FILE_PATH)), FILE_PATH, "left_anti").drop(ERROR)
    ident = gathered(identify_tables(spark, rows, spec)).where(~F.col("skip")).drop("skip")
    found = ident.filter(F.col("table").isNotNull())
    bad = ident.filter(F.col("table").isNull()).select(FILE_PATH)
    if req := [t for t in spec.required_tables if t in spec.tables]:
        present = found.select(F.col(FILE_PATH).alias("file"), F.col("table").alias("tbl"))
        bad = bad.unionByName(identify.required_tables(present, req).filter(~F.col("ok")).select(F.col("file").alias(FILE_PATH)))
    bad = bad.distinct()
    keep = found.join(bad, FILE_PATH, "left_anti").join(listed, FILE_PATH)  # files in the order of (mtime, path), D16
    rows = rows.join(keep.withColumnRenamed("hint", "tbl"), [FILE_PATH, "tbl"])
    return rows, [unread, silent, bad.select(F.col(FILE_PATH).alias("path"), F.lit("no_usable_table").alias("reason"))]


def _load(cat: store.Catalog, rows: DataFrame, spec: CatalogSpec, key_mode: str,
          strict: bool) -> tuple[list[DataFrame], DataFrame | None]:
    """Upserts ``rows`` into the buckets of their keys and checks references; rejected
    files ``(_file_seq, reason)`` and the load statistics."""
    names: dict[str, list[str]] = {}
    for r in rows.select("table", F.explode(F.map_keys("row")).alias("c")).distinct().collect():
        names.setdefault(r["table"], []).append(r["c"])
    rows = rows.withColumn(FILE_SEQ, F.col(FILE_SEQ) + F.lit(cat.last_file_seq))  # after all earlier batches
    deltas = {}
    for t in spec.tables:
        if t in names:
            wide = rows.filter(F.col("table") == t).select(
                FILE_PATH, FILE_NAME, FILE_MTIME, FILE_SEQ, ROW_SEQ, *[F.element_at("row", F.lit(c)).alias(c) for c in sorted(names[t])])
            deltas[t] = enrich(wide, spec.tables[t], spec)
    before, touched, posted, bad_files = dict(cat.tables), {}, {}, []

    def near(t: str, keys: DataFrame) -> DataFrame | None:
        posted[t] = keys
        if t not in cat:
            return None
        touched[t] = cat.buckets_of(t, keys)
        return cat.frame(t, touched[t])

    loaded = load_related({}, deltas, spec, key_mode, clean_orphans=False, checkpoint_tables=False, strict=strict,
                          rejects=bad_files, near=near,
                          seed=lambda t, pk: pk_seed(cat.frame(t), pk) if t in cat else 1)
    stats_parts = []
    for t in spec.topological_order():
        if t not in loaded:
            continue
        if not spec.tables[t].key:
            cat.append(t, loaded[t])
            continue
        if t in touched:
            cat.put_buckets(t, loaded[t], touched[t])
        else:
            cat.put(t, loaded[t], [KEY])
            touched[t] = list(range(cat.tables[t].buckets))
        k = with_key(deltas[t], spec.tables[t].key_columns, key_mode)
        k = k.withColumn(KEY, F.when(~F.col(KEY).isin(list(spec.null_tokens)), F.col(KEY))).select(FILE_NAME, KEY)
        old = cat.frame_of(before[t], touched[t]).select(KEY) if t in before else k.select(KEY).limit(0)
        stats_parts.append(upsert.load_stats(old, k, [KEY], [FILE_NAME]).withColumn("table", F.lit(t)))
        dups = (k.filter(F.col(KEY).isNotNull()).groupBy(FILE_NAME)
                .agg((F.count(F.lit(1)) - F.count_distinct(KEY)).cast("bigint").alias("n")).filter(F.col("n") > 0))
        stats_parts.append(dups.select(FILE_NAME, F.lit("duplicate").alias("outcome"), "n", F.lit(t).alias("table")))
    gone = integrity.clean(cat, before, posted, touched, spec)
    if counts := [(None, "orphan_deleted", n, t) for t, n in gone.items() if n]:
        stats_parts.append(rows.sparkSession.createDataFrame(counts, f"{FILE_NAME} string, outcome string, n long, `table` string"))
    stats = None
    for s in stats_parts:
        stats = s if stats is None else stats.unionByName(s)
    return bad_files, stats


def _link(cat: store.Catalog, spec: CatalogSpec, data: DataFrame) -> DataFrame | None:
    """JON-9: the names of ``data`` that some row of the catalog holds. Rows that hold
    one are flagged as published; only buckets with a row whose flag changes are
    written. Two or three columns of the tables are read, None without such tables."""
    found = None
    for t, ts in spec.tables.items():
        if not (ts.data_filenames and t in cat and all(c in cat.frame(t).columns for c in ts.data_filenames)):
            continue
        table = cat.frame(t)
        values = None
        for c in ts.data_filenames:
            v = table.select(q(c).cast("string").alias("_value"))
            values = v if values is None else values.unionByName(v)
        met = materialize(linking.contains_matches(values, "_value", data, "file_name"))
        names = met.select("file_name").distinct()
        found = names if found is None else found.unionByName(names)
        if not ts.published_flags or met.isEmpty():
            continue
        hits = met.select("_value").distinct()

        def hit(df: DataFrame) -> DataFrame:
            out = None
            for c in ts.data_filenames:
                one = df.join(hits, q(c).cast("string") == F.col("_value"), "left_semi")
                out = one if out is None else out.unionByName(one)
            return out.distinct()

        def flagged(df: DataFrame, mark) -> DataFrame:
            for f in ts.published_flags:
                df = df.withColumn(f, F.when(mark, F.lit(FLAG_TRUE)).otherwise(q(f) if f in df.columns else F.lit(None)))
            return df

        unset = F.lit(False)
        for f in ts.published_flags:
            unset = unset | ~q(f).eqNullSafe(F.lit(FLAG_TRUE)) if f in table.columns else F.lit(True)
        names_of = [q(c) for c in ts.data_filenames]
        if KEY in table.columns and cat.tables[t].kind == "buckets":
            turned = materialize(hit(table.where(unset).select(KEY, *names_of)).select(KEY).distinct())
            if not turned.isEmpty():
                buckets = cat.buckets_of(t, turned)
                mark = turned.withColumn("_turned", F.lit(True))
                cat.put_buckets(t, flagged(cat.frame(t, buckets).join(mark, KEY, "left"), F.col("_turned")).drop("_turned"), buckets)
        elif not hit(table.where(unset).select(*names_of)).isEmpty():
            keys = hit(table.select(*names_of).distinct()).withColumn("_turned", F.lit(True))
            same = F.lit(True)
            for c in ts.data_filenames:
                same = same & table[f"`{c}`"].eqNullSafe(keys[f"`{c}`"])
            whole = materialize(flagged(table.join(keys.select(*[keys[f"`{c}`"] for c in ts.data_filenames], "_turned"), same, "left")
                                        .select(*[table[f"`{c}`"] for c in table.columns], "_turned"), F.col("_turned")).drop("_turned"))
            cat.drop(t)
            cat.append(t, whole)
    return found.distinct() if found is not None else None


def _file_actions(spark: SparkSession, spec: CatalogSpec, to_publish: DataFrame, processed: DataFrame, rejected: DataFrame,
                  expired: DataFrame | None) -> list[DataFrame]:
    """The batch's plans as actions: publish and store copies, files for the trash,
    rejects."""
    plan = manifest.fan_out(to_publish, "file_class", spec.get_folders)
    targets = [f for v in spec.get_folders.values() for f in v]
    plan = gathered(manifest.placement_actions(plan, target_listing(spark, targets), spec.overwrite_get))
    out, trash = [plan.withColumn("kind", F.lit("publish"))], []
    if spec.store_folders:
        kept = manifest.store_plan(processed, spec.store_folders)
        kept = gathered(manifest.placement_actions(kept, target_listing(spark, spec.store_folders), spec.overwrite_store))
        out.append(kept.withColumn("kind", F.lit("store")))
    out.append(rejected.withColumn("kind", F.lit("reject")).withColumn("action", F.lit("reject")))
    if spec.trash_folder:
        if spec.discard_invalid:
            trash.append(rejected.select("path", "reason"))
        else:  # keys that cannot be resolved go in any case
            trash.append(rejected.where(F.col("reason").isin("bad_integer_key", "unresolved_reference")).select("path", "reason"))
        if expired is not None:
            trash.append(expired.select("path", F.lit("expired").alias("reason")))
        for o in out[:-1]:  # what a copy replaces without overwriting it
            trash.append(o.where("action = 'rename_older'").select(F.col("replaces").alias("path"), F.lit("replaced").alias("reason")))
        gone = None
        for one in trash:
            gone = one if gone is None else gone.unionByName(one)
        gone = gone.distinct().withColumn("file_name", manifest.basename(F.col("path"))).withColumn("folder", F.lit(spec.trash_folder))
        gone = manifest.placement_actions(gone, target_listing(spark, [spec.trash_folder]), spec.overwrite_trash)
        out.append(gone.withColumn("kind", F.lit("trash")))
    return out


def consolidate(spark: SparkSession, spec: CatalogSpec, inputs: list[str], catalog_root: str,
                key_mode: str = "concat", write_replicas: bool = True,
                held: DataFrame | None = None, encoding: str = "utf-8", strict: bool = False, batch: int | None = None,
                encodings: DataFrame | None = None,
                state: Callable[[store.Catalog, BatchResult], DataFrame | None] | None = None) -> BatchResult:
    """``held``: data files kept from earlier batches (path, file_name, file_class,
    modificationTime), matched again against the updated catalog. ``encoding`` is that
    of text files without a byte order mark, unless ``encodings``, a model of byte pairs
    (``sources.encodings``), finds it file by file; ``strict`` rejects files whose
    relative FKs they do not resolve themselves (D12). ``state`` may add tables
    (names begin with ``__``) to the batch's version and returns files that are
    expired; ``batch`` is noted there, so a batch is in the store as a whole or not
    at all."""
    cat = store.Catalog(spark, catalog_root)
    files, listed = _arrivals(spark, spec, inputs)
    if len(listed) > MOST_FILES:
        raise ValueError(f"{len(listed)} files in one batch; service.run_batch takes them in batches of at most {MOST_FILES}")
    is_meta = F.col("file_class").isin(list(spec.metadata_regex))
    meta = sorted((r for r in listed if r["file_class"] in spec.metadata_regex and r["length"] > 0),
                  key=lambda r: (r["modificationTime"], r["path"]))
    if not cat.names() and spec.catalog_names:
        for t, df in store.reload_from_replicas(spark, spec, key_mode).items():  # SRC-5 on start
            if spec.tables[t].key:
                cat.put(t, df, [KEY])
            else:
                cat.append(t, df)
    rejected_parts = [files.filter(F.col("file_class") == manifest.UNKNOWN).select("path", F.lit("unknown_file").alias("reason")),
                      files.filter(is_meta & (F.col("length") == 0)).select("path", F.lit("no_rows").alias("reason"))]
    stats, rows = None, None
    if meta:
        rows, bad = _read(spark, spec, meta, encoding, encodings)
        rejected_parts += bad
        if rows is not None:
            bad_files, stats = _load(cat, rows, spec, key_mode, strict)
            numbered = spark.createDataFrame([(i + cat.last_file_seq, r["path"]) for i, r in enumerate(meta, 1)], f"{FILE_SEQ} long, path string")
            rejected_parts += [numbered.join(b, FILE_SEQ).select("path", "reason") for b in bad_files]
    # ---- data files: link, publish, pending --------------------------------
    cols = ("path", "file_name", "file_class", "modificationTime")
    data = files.filter(F.col("file_class").isin(list(spec.data_regex))).withColumnRenamed("name", "file_name").select(*cols)
    if held is not None:
        data = gathered(data.unionByName(held.select(*cols)).dropDuplicates(["path"]))
    if any(r["file_class"] in spec.data_regex for r in listed) or (held is not None and not data.isEmpty()):
        found = _link(cat, spec, data)
        linked = list(spec.data_regex) if found is not None else []
        # FIL-5: files of one name but other content are published under stamped names
        data, variants = _versioned(data, spec)
        movable = linking.move_only(data, "file_class", linked)
        to_publish = movable if found is None else movable.unionByName(data.join(found, "file_name", "left_semi"))
        pending = gathered(linking.pending_files(data, found) if found is not None else data.limit(0)).drop("publish_name")
        to_publish = gathered(to_publish.distinct().withColumn("file_name", F.coalesce("publish_name", "file_name"))
                                 .select("path", "file_name", "file_class"))
    else:
        variants, pending, to_publish = None, data, data.drop("modificationTime")
    rejected = rejected_parts[0]
    for r in [*rejected_parts[1:], *([variants] if variants is not None else [])]:
        rejected = rejected.unionByName(r)
    rejected = gathered(rejected.groupBy("path").agg(F.min("reason").alias("reason")))
    processed = files.filter(is_meta).join(rejected, "path", "left_anti").select("path", F.col("name").alias("file_name"))
    # ---- one commit -----------------------------------------------------------
    result = BatchResult(None, {}, files, rejected, to_publish, pending, None, stats)
    expired = state(cat, result) if state is not None else None
    actions = outbox.append(cat, *_file_actions(spark, spec, to_publish, processed, rejected, expired))
    version = cat.commit(batch, cat.last_file_seq + len(meta))
    catalog = cat.frames()
    replica_errors: dict = {}
    if rows is not None and write_replicas and spec.catalog_names:
        tables = {t: sort.catalog_sort(upsert.project_columns(df, df.columns), spec.tables[t].sort_by if t in spec.tables else [])
                  for t, df in catalog.items()}
        try:
            replica_errors = publish(tables, spec.catalog_names, spec.csv_separator, version)["errors"]
        except RuntimeError as e:  # the catalog itself is saved; the next batch writes the replicas again
            replica_errors = {"*": str(e)}
    of = lambda kind: actions.where(F.col("kind") == kind).select("path", "file_name", "folder", "action", "replaces")
    return BatchResult(version, catalog, files, rejected, of("publish"), pending, of("store"), stats, replica_errors, actions)
