"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key. Within its source documents are ordered
by that key; prefix sums of their sizes are built in two levels (per key range,
then inside a range), and the mix takes documents until the source's target is
met, in whole epochs first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import persist

WORD = r"[^\x20\x09-\x0D]+"
KEY_DIGITS = 3  # 16**3 key ranges per source
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, weights: int = 3) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, size)``.

    Sources in code-point order, null last, weigh 1, 2, .. ``weights``,
    repeating. All targets sum to all sizes; a target stops at ``max_epochs``
    times its source and the excess goes to the others by weight until none is
    above. That fixed point is ``min(cap, lambda * weight)``: sources sorted by
    cap / weight are capped from the front until the level that the rest would
    get is below their caps. One row per source enters the unpartitioned
    windows, after aggregation.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (per_source.withColumn("weight", (F.row_number().over(named) - 1) % weights + 1)
              .withColumn("cap", F.col("source_size") * max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("total") - F.col("cap_before")) / F.col("weight_left")
    leveled = (ranked
               .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
               .withColumn("weight_left", F.sum("weight").over(everything)
                           - F.coalesce(F.sum("weight").over(before), F.lit(0)))
               .withColumn("total", F.sum("source_size").over(everything))
               .withColumn("level", F.when(F.col("cap") >= level * F.col("weight"), level)))
    # the first source that is not capped sets the level of all that follow
    first = F.first("level", ignorenulls=True).over(Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return leveled.select("source", "source_size", F.least(
        F.col("cap").cast("double"), F.coalesce(first * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"no_source": F.col("source").isNull(), "source_key": F.coalesce("source", F.lit(""))})


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: str = "mix", max_epochs: int = MAX_EPOCHS, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``id, source, size, source_size, target, copies,
    taken`` and the columns named in ``carry`` (as a struct ``row``).

    ``copies`` is how often the mix takes the document: ``floor(target /
    source_size)`` epochs, and once more if it stands before the cut at the
    rest. The cut falls at the document whose middle word reaches the rest, so
    a source is off its target by half a document at most. ``taken = copies *
    size``.

    The random key is md5 of seed and id; ties in it (repeated ids) go by size,
    and rows equal in both are interchangeable. A null id keys as the empty
    text; a null source is a source of its own; a null or blank text has size
    zero and follows its key's side of the cut. A source without words has
    target zero and no copies. Empty tables give no rows.

    A hot source is cut into key ranges of equal expected size, and only range
    totals meet per source; no window ever spans a source.
    """
    key = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"), key.alias("key"),
                        F.substring(key, 1, KEY_DIGITS).alias("range"), *row)
    if not carry:
        sized = persist(sized, "mix-sizes")
    ranges = persist(sized.groupBy("source", "range").agg(F.sum("size").alias("range_size")), "mix-ranges")
    targets = source_targets(ranges.select("source", F.col("range_size").alias("size")), max_epochs)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
    group = ["no_source", "source_key", "range"]  # the null source is a key of its own
    targets = _keyed(targets).select("no_source", "source_key", "source_size", "target")
    plan = _keyed(offsets).join(targets, ["no_source", "source_key"]).select(*group, "offset", "source_size", "target")
    inside = Window.partitionBy(*group).orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # window and join share one partitioning, so documents are shuffled once
    placed = _keyed(sized).withColumn("upto", F.sum("size").over(inside)).join(persist(plan, "mix-plan"), group)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    middle = F.col("offset") + F.col("upto") - F.col("size") / F.lit(2.0)
    copies = (epochs + F.when((F.col("source_size") > 0) & (middle < rest), 1).otherwise(0)).cast("long")
    return placed.withColumn("copies", copies).select(
        "id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *(["row"] if carry else []))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: str = "mix") -> DataFrame:
    """The mix itself: every document as many times as it is taken, same columns."""
    mixed = mix_sources(docs, id_col, text_col, source_col, seed, carry=docs.columns)
    repeated = mixed.where("copies > 0").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
