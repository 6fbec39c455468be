"""Benchmark decontamination by winnowing, in DataFrame functions throughout.

Of every run of ``window`` words the least hash of its ``gram``-word pieces is its
fingerprint, in documents and benchmark items alike. A run of ``window`` words that
both share therefore has one fingerprint on both sides, whatever stands around
it; documents and items are joined on fingerprints and the hits are extended to the
whole windows that they stand for, which are compared as words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import persist

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"   # of lower-cased text
WINDOW = 10
GRAM = 5


def words_of(text: Column) -> Column:
    """Words of a whole text, lower-cased by A-Z only; null has none."""
    split = F.split(F.translate(text.cast("string"), UPPER, UPPER.lower()), BETWEEN_WORDS)
    return F.coalesce(F.array_remove(split, ""), F.array().cast("array<string>"))


def _bound(value: Column, use) -> Column:
    """``use`` of ``value`` evaluated once: it becomes a lambda's variable, which
    no optimizer rule expands again inside the inner loops."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _gram(window: int) -> int:
    return min(GRAM, window)


def prints(words: Column, window: int) -> Column:
    """The distinct fingerprints of all runs of ``window`` words: an array of longs,
    32 bits of hash above the place of the piece (0 for the first word)."""
    gram = _gram(window)

    def pieces(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - gram)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(gram)])
                           .bitwiseAND(F.lit(-1 << 32)).bitwiseOR(i.cast("long")))

    def least(marks: Column) -> Column:
        span = window - gram + 1
        if span == 1:
            return marks
        places = F.sequence(F.lit(0), F.size(marks) - span)
        return F.array_distinct(F.transform(places, lambda i: F.least(*[F.get(marks, i + j) for j in range(span)])))

    found = _bound(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _bound(pieces(hashes), least))
    return F.when(F.size(words) >= window, found).otherwise(F.array().cast("array<bigint>"))


def _text_key(text: str) -> Column:
    """128 bits that stand for a text: what a document holds depends on its text alone."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(item, size, passage)``: every run of ``window`` words of every item, or all
    its words where there are fewer; the words of a passage are joined by spaces."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    runs = items.select("item", size.alias("size"), "words",
                        F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("at"))
    return runs.select("item", "size", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("passage")).distinct()


def _one_size(docs: DataFrame, text_col: str, passages: DataFrame, size: int) -> DataFrame:
    """``(text_key, at, passage_id)``: where passages of ``size`` words stand in texts."""
    gram = _gram(size)
    marks = persist(passages.select(F.explode(prints(F.split("passage", " "), size)).alias("mark"))
                    .select(F.shiftright("mark", 32).alias("print")).distinct(), "leak-prints")
    texts = docs.select(_text_key(text_col).alias("text_key"), words_of(F.col(text_col)).alias("words"))
    seen = texts.select("text_key", F.explode(prints(F.col("words"), size)).alias("mark"))
    seen = seen.select("text_key", F.shiftright("mark", 32).alias("print"),
                       F.col("mark").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("at"))
    hits = persist(seen.join(marks, "print", "left_semi").select("text_key", "at").distinct(), "leak-hits")
    # the windows around the hits of a text: no more than its words
    suspects = persist(hits.groupBy("text_key").agg(F.collect_list("at").alias("places")), "leak-suspects")
    found = docs.select(_text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text")).join(suspects, "text_key")
    found = found.select("text_key", words_of(F.col("text")).alias("words"), "places")
    starts = F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(F.greatest(p - (size - gram), F.lit(0)), p))))
    runs = (found.select("text_key", "words", F.explode(starts).alias("at")).where(F.col("at") + size <= F.size("words"))
            .select("text_key", "at", F.array_join(F.slice("words", F.col("at") + 1, F.lit(size)), " ").alias("passage")))
    return runs.join(passages, "passage").select("text_key", "at", F.lit(size).alias("size"), "passage_id").distinct()


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(text_key, at, size, passage_id)``, the places of benchmark passages in the
    distinct texts, and ``(passage_id, item)``. Both are written tables."""
    windows = persist(item_windows(benchmark, item_col, item_text_col, window), "leak-windows")
    passages = persist(windows.select("size", "passage").distinct()
                       .select("size", "passage", F.monotonically_increasing_id().alias("passage_id")), "leak-passages")
    items = persist(windows.join(passages, ["size", "passage"]).select("passage_id", "item").distinct(), "leak-items")
    sizes = sorted(r["size"] for r in passages.select("size").distinct().collect())  # at most ``window`` of them
    found = None
    for size in sizes or [window]:
        one = _one_size(docs, text_col, passages.where(F.col("size") == size).select("passage", "passage_id"), size)
        found = one if found is None else found.unionByName(one)
    return persist(found, "leak-places"), items


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: ``id, n_words, n_hit, items, contaminated``.

    Words are lower-cased by A-Z and hold letters, digits and everything beyond
    ASCII. A window is ``window`` consecutive words of an item, or all of a shorter
    item. A document word inside any occurrence of a window is hit; ``items`` are
    the ids, as sorted strings, of the items with a window in the document.

    Null texts and texts without words have no words and no hits; such items have no
    windows. A null item id counts as the empty string, repeated items count
    once, repeated rows and ids each come back. Empty tables: no rows, or no hits.
    Texts are read whole; equal texts share their hits. Other columns play no part.

    No side is assumed small: fingerprints and windows are written first, so that
    Catalyst broadcasts them only below its threshold, and AQE splits a passage
    that very many documents share. A document's hits are gathered by the document
    (its own length bounds them), never by passage.
    """
    places, items = benchmark_hits(docs, benchmark, text_col, item_col, item_text_col, window)
    spans = places.select("text_key", "at", (F.col("at") + F.col("size")).alias("end"))
    longest = spans.groupBy("text_key", "at").agg(F.max("end").alias("end"))
    # each run adds the words beyond all runs that began before it
    covered = (longest.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("at", "end"))).alias("runs"))
               .select("text_key", F.aggregate(
                   "runs", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
                   lambda s, r: F.struct((s["n"] + F.greatest(r["end"] - F.greatest(r["at"], s["to"]), F.lit(0))).alias("n"),
                                         F.greatest(r["end"], s["to"]).alias("to"))).getField("n").alias("n_hit")))
    named = (persist(places.select("text_key", "passage_id").distinct().join(items, "passage_id")
                     .select("text_key", "item").distinct(), "leak-named")
             .groupBy("text_key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    verdicts = persist(covered.join(named, "text_key"), "leak-verdicts")
    rows = docs.select(F.col(id_col).alias("id"), _text_key(text_col).alias("text_key"),
                       F.size(words_of(F.col(text_col))).cast("long").alias("n_words"))
    return rows.join(verdicts, "text_key", "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"))
