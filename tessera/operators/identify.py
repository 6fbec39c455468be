"""RTE-1 table identification and FLT-2 required tables.

A table is a candidate for a block of columns when all its required columns are
among them. Candidates are found through an inverted index: every table stands
under the one of its required columns that fewest tables require, so a block
meets only tables whose rarest column it has, whatever the number of tables, and
the rest of their columns is compared then."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.transforms import q

NOT_FOUND = "ntf"
AMBIGUOUS = "ambiguous"
_ANY = ""   # stands for a column that every block has


def required_frame(spark: SparkSession, required: Mapping[str, Iterable[str]]) -> DataFrame:
    """The index of a configuration: ``(tbl, need, anchor)``, one row per table."""
    sets = {t: sorted(set(cols)) for t, cols in required.items()}
    used = Counter(c for cols in sets.values() for c in cols)
    rows = [(t, cols, min(cols, key=lambda c: (used[c], c), default=_ANY)) for t, cols in sorted(sets.items())]
    return spark.createDataFrame(rows, "tbl string, need array<string>, anchor string")


def table_candidates(blocks: DataFrame, block_cols: Sequence[str], required: DataFrame, cols: str = "cols") -> DataFrame:
    """``(*block_cols, cands)`` per block (its distinct columns in the array ``cols``):
    the fitting tables as structs ``(d, t)``, ``d`` the number of further columns,
    in order. Blocks without any have an empty array."""
    keys = [q(c) for c in block_cols]
    met = (blocks.select(*keys, q(cols).alias("_cols"), F.explode(F.array_union(q(cols), F.array(F.lit(_ANY)))).alias("anchor"))
           .join(required, "anchor").where(F.size(F.array_except("need", "_cols")) == 0)
           .select(*keys, F.struct((F.size("_cols") - F.size("need")).alias("d"), F.col("tbl").alias("t")).alias("_c")))
    fits = met.groupBy(*keys).agg(F.array_sort(F.collect_list("_c")).alias("cands"))
    empty = F.array().cast(fits.schema["cands"].dataType)
    return blocks.select(*keys).join(fits, list(block_cols), "left").select(*keys, F.coalesce("cands", empty).alias("cands"))


def closest(cands: str = "cands"):
    """Of a block's candidates those with the fewest further columns."""
    return F.filter(q(cands), lambda c: c["d"] == q(cands)[0]["d"])


def match_table(file_columns: DataFrame, required: DataFrame, file_col: str = "file", col_col: str = "col") -> DataFrame:
    """The table of every file by its columns: the candidate with the fewest further
    columns; a tie is ``ambiguous``; none is ``ntf``. A file's columns are gathered
    by file (bounded by the width of a schema) after they are deduplicated."""
    blocks = (file_columns.select(q(file_col).alias("_f"), q(col_col).alias("_c")).distinct()
              .groupBy("_f").agg(F.collect_set("_c").alias("cols")))
    best = table_candidates(blocks, ["_f"], required).select("_f", closest().alias("best"))
    return best.select(F.col("_f").alias(file_col),
                       F.when(F.size("best") == 0, F.lit(NOT_FOUND))
                       .when(F.size("best") > 1, F.lit(AMBIGUOUS)).otherwise(F.get("best", F.lit(0))["t"]).alias("tbl"))


def required_tables(file_tables: DataFrame, required: Sequence[str], file_col: str = "file",
                    table_col: str = "tbl") -> DataFrame:
    """FLT-2: per file, the required tables it lacks (tables with >= 1 row
    count as present, D6) and whether it passes."""
    req = F.array(*[F.lit(t) for t in sorted(set(required))])
    present = (file_tables.select(q(file_col), q(table_col)).distinct()
               .groupBy(q(file_col)).agg(F.collect_set(q(table_col)).alias("_have")))
    missing = F.array_sort(F.array_except(req, F.col("_have")))
    return present.select(q(file_col), missing.alias("missing"), (F.size(missing) == 0).alias("ok"))
