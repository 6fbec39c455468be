"""Exact dedup by progressive refinement: byte length, then the hash of a
prefix, then the hash of the whole text, which is read only for rows whose
(length, prefix) occurs more than once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import one_row_per, persist, text_or_empty

PREFIX_CHARS = 64


def _measured(docs: DataFrame, id_col: str, text_col: str, extra: Mapping[str, Column], prefix_chars: int) -> DataFrame:
    body = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), body.alias("body"), F.octet_length(body).alias("n_bytes"),
                       F.xxhash64(F.substring(body, 1, prefix_chars)).alias("head"),
                       *[c.alias(f"x_{k}") for k, c in extra.items()])


def duplicate_heads(docs: DataFrame, text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Rounds one and two: the ``(n_bytes, head)`` shared by several rows."""
    rows = _measured(docs, text_col, text_col, {}, prefix_chars)
    # written, so that its size is known and, where it is not broadcast, AQE can split a length that very many share
    lengths = persist(rows.groupBy("n_bytes").agg(F.count("*").alias("n")).where("n > 1").select("n_bytes"), "exact-lengths")
    return (rows.select("n_bytes", "head").join(lengths, "n_bytes", "left_semi")
            .groupBy("n_bytes", "head").agg(F.count("*").alias("n")).where("n > 1").select("n_bytes", "head"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                extra: Mapping[str, Column] | None = None, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per input row: ``id, n_bytes, digest, keep_id, group_size, kept``
    and the ``extra`` expressions (functions of the row's text).

    Texts are equal when their bytes are equal; null is the empty text. Of
    equal texts the row with the largest id stays. ``digest`` is the SHA-256
    of texts that reached the last round, null for the others, whose length
    and prefix already set them apart.

    Ties: rows equal in id and text are one group; exactly one of them is
    kept. A null id is below every other id; a group of null ids only keeps
    one of them with ``keep_id`` null. Empty tables give no rows. Other
    columns of ``docs``, whatever their names, play no part.

    Hot groups: counts combine before the shuffle, and the one join that
    carries text has one row per key on its other side (broadcast when small,
    split by AQE when skewed). Groups are never gathered.
    """
    extra = dict(extra or {})
    kept_cols = [f"x_{k}" for k in extra]
    # a written table has a known size: Catalyst broadcasts it only below its threshold
    heads = persist(duplicate_heads(docs, text_col, prefix_chars), "exact-heads").withColumn("again", F.lit(True))
    rows = _measured(docs, id_col, text_col, extra, prefix_chars).join(heads, ["n_bytes", "head"], "left")
    hashed = persist(rows.select("id", "n_bytes", F.when(F.col("again"), F.sha2(F.col("body").cast("binary"), 256))
                                 .alias("digest"), *kept_cols), "exact-digests")
    alone = hashed.where("digest IS NULL").select(
        "id", "n_bytes", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *kept_cols)
    keys = ["n_bytes", "digest"]
    # both sides of the join are written, so that AQE splits a group that very many rows share
    by_id = persist(hashed.where("digest IS NOT NULL").groupBy(*keys, "id", *kept_cols).agg(F.count("*").alias("copies")), "exact-ids")
    groups = persist(by_id.groupBy(*keys).agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")), "exact-groups")
    shared = (by_id.join(groups, keys)
              .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
              .select("id", "n_bytes", "digest", "keep_id", "group_size",
                      (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), *kept_cols))
    out = alone.unionByName(shared)
    return out.withColumnsRenamed({f"x_{k}": k for k in extra})


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops, same columns.

    The dropped rows are subtracted by (id, digest). Rows equal in id and text
    collapse to the least by their other columns.
    """
    cols = docs.columns
    verdict = exact_dedup(docs, id_col, text_col).where("group_size > 1")
    actions = persist(verdict.groupBy("id", "digest").agg(F.max("kept").alias("any_kept"), F.count("*").alias("copies"))
                      .where("NOT any_kept OR copies > 1")
                      .select(F.col("id").alias("__id"), F.col("digest").alias("__digest"),
                              F.when(F.col("any_kept"), "one").otherwise("drop").alias("__action")), "exact-actions")
    keyed = docs.withColumn("__sha", F.sha2(text_or_empty(text_col).cast("binary"), 256))
    # the list of dropped rows grows with the table, so it is a shuffled join at every size, once
    marked = keyed.join(actions.hint("merge"), (F.col("__sha") == F.col("__digest")) & F.col(id_col).eqNullSafe(F.col("__id")), "left")
    plain = marked.where("__action IS NULL").select(*[f"`{c}`" for c in cols])
    if actions.where("__action = 'one'").isEmpty():
        return plain  # no row occurs twice with one id: the second pass over the texts would be for nothing
    tied = marked.where("__action = 'one'").select("__sha", *[f"`{c}`" for c in cols])
    return plain.unionByName(one_row_per(tied, ["__sha", id_col]).select(*[f"`{c}`" for c in cols]))
