"""Data files <-> catalog rows: JON-9 (contains-match), JON-10 (pending),
JON-11 (move-only).

A row references a data file when one of its file-name columns *contains*
the file's basename (literal substring). Every name stands in an index under
the rarest of its q-grams (runs of ``GRAM`` characters); every distinct column
value emits its q-grams once, under a 16-byte key instead of its text; what
meets is verified. Emitted rows are linear in the length of a cell, whatever the
names, every containment is found, and no side is assumed small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.transforms import q
from tessera.spec import FLAG_FALSE, FLAG_TRUE

GRAM = 6
_CHUNK = 256    # characters cut at a time: finding a place in a text costs its distance from the start


def _grams(text: Column, n: int) -> Column:
    """The distinct runs of ``n`` characters of ``text``."""
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.char_length(text) - n, F.lit(0)), F.lit(_CHUNK)),
                      lambda at: F.substring(text, at + 1, F.lit(_CHUNK + n - 1)))
    runs = F.transform(cut, lambda c: F.transform(F.sequence(F.lit(1), F.char_length(c) - n + 1), lambda p: F.substring(c, p, F.lit(n))))
    return F.when(F.char_length(text) >= n, F.array_distinct(F.flatten(runs))).otherwise(F.array().cast("array<string>"))


def _anchored(names: DataFrame) -> DataFrame:
    """``(_name, _gram)``: the q-gram of each name that fewest names have; a shorter
    name is its own."""
    grams = names.select("_name", F.explode(F.when(F.char_length("_name") < GRAM, F.array("_name"))
                                            .otherwise(_grams(F.col("_name"), GRAM))).alias("_gram"))
    used = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    return grams.join(used, "_gram").groupBy("_name").agg(F.min(F.struct("_n", "_gram")).alias("_r")).select("_name", F.col("_r._gram").alias("_gram"))


def contains_matches(values: DataFrame, value_col: str, files: DataFrame, name_col: str) -> DataFrame:
    """Pairs ``(value, file name)`` where the value contains the name."""
    names = files.select(q(name_col).alias("_name")).filter(F.col("_name").isNotNull() & (F.length("_name") > 0)).distinct()
    index = _anchored(names)
    short = sorted(r[0] for r in names.select(F.char_length("_name").alias("n")).where(F.col("n") < GRAM).distinct().collect())
    vals = values.select(q(value_col).cast("string").alias("_value")).filter(F.col("_value").isNotNull()).distinct()
    key = F.unhex(F.md5(F.col("_value").cast("binary")))
    grams = vals.select(key.alias("_id"), F.explode(F.flatten(F.array(*[_grams(F.col("_value"), n) for n in [*short, GRAM]]))).alias("_gram"))
    met = grams.join(index, "_gram").select("_id", "_name").distinct()
    return (met.join(vals.select(key.alias("_id"), "_value"), "_id").filter(F.contains("_value", "_name"))
            .select(F.col("_value").alias(value_col), F.col("_name").alias(name_col)))


def link_files(rows: DataFrame, files: DataFrame, name_cols: Sequence[str], flag_cols: Sequence[str],
               file_name_col: str = "file_name") -> tuple[DataFrame, DataFrame]:
    """Flag every row that references an arrived data file, and return
    ``(rows with flags, found file names)``. Flags are set to "True" on a match
    and default to "False"; a match counts even without flag columns (D20)."""
    values = None
    for c in name_cols:
        v = rows.select(q(c).cast("string").alias("_value"))
        values = v if values is None else values.unionByName(v)
    if values is None:
        return rows, files.select(q(file_name_col)).limit(0)
    matches = contains_matches(values, "_value", files, file_name_col)
    hit_values = matches.select("_value").distinct().withColumn("_hit", F.lit(True))
    hit = F.lit(False)
    out = rows
    for i, c in enumerate(name_cols):
        h = hit_values.withColumnRenamed("_value", f"_v{i}").withColumnRenamed("_hit", f"_h{i}")
        out = out.join(h, q(c).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        hit = hit | F.coalesce(F.col(f"_h{i}"), F.lit(False))
    out = out.withColumn("_matched", hit)
    for f in flag_cols:
        cur = F.coalesce(q(f), F.lit(FLAG_FALSE)) if f in rows.columns else F.lit(FLAG_FALSE)
        out = out.withColumn(f, F.when(F.col("_matched"), F.lit(FLAG_TRUE)).otherwise(cur))
    out = out.drop(*[f"_h{i}" for i in range(len(name_cols))])
    found = matches.select(q(file_name_col)).distinct()
    return out, found


def pending_files(files: DataFrame, found: DataFrame, file_name_col: str = "file_name") -> DataFrame:
    """JON-10: arrived data files no row references yet; they wait."""
    return files.join(found, file_name_col, "left_anti")


def move_only(files: DataFrame, class_col: str, linked_classes: Sequence[str]) -> DataFrame:
    """JON-11: files of classes with no declared (non-empty) reference table
    are published without a match."""
    return files.filter(~q(class_col).isin(list(linked_classes)) if linked_classes else F.lit(True))
