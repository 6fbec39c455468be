"""Encoding of text files without a byte order mark (SRC-6), by byte-pair likelihoods.

A model holds, for every candidate encoding, the logarithm of how likely a pair of
neighbouring bytes is in text of that encoding, learned from texts of the user's own
(``learn_encodings``). A file gets the candidate under which its byte pairs are most
likely (``guess_encoding``). Only *telling* pairs count: those with a zero byte or one
above 127. A file without any reads the same in every candidate but UTF-16, whose text
always has them, and gets the first candidate.

Both steps are native aggregations; a file of any length is cut into chunks, and its
distinct pairs, at most ``PAIRS``, meet a model of at most that many rows.
"""

from __future__ import annotations

import codecs
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.transforms import q
from tessera.session import materialize
from tessera.sources.scan import detect_encoding

#: Candidates by the names Python's codecs have, in the order that decides ties.
CANDIDATES = ("utf-8", "utf-16-le", "utf-16-be", "cp1252", "cp850", "mac-roman")
_WIDE = {"utf-8": "UTF-8", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE"}  # what Spark encodes by itself
END = "\uffff"     # a noncharacter behind every text that is learned from
STEP = 4096        # bytes or characters of a chunk; even
UNSEEN = 0.5       # count of a pair that the texts do not hold
PAIRS = 2 * 65_536  # at even and at odd offsets
FLOOR = ""         # the model's row for pairs that no text holds


def _high_characters(name: str) -> dict[int, str]:
    """Byte -> character of the upper half of a single-byte encoding."""
    upper = {b: codecs.decode(bytes([b]), name, "ignore") for b in range(128, 256)}
    return {b: c for b, c in upper.items() if c}


def _class(chars) -> str:
    """A regular expression's character class body; ranges are not needed for 128 characters."""
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


def representable(text: Column, name: str) -> Column:
    """Whether ``name`` has every character of ``text``."""
    if name in _WIDE:
        return text.isNotNull()
    return ~F.regexp_like(text, F.lit(f"[^\\x00-\\x7F{_class(_high_characters(name).values())}]"))


def encoded(text: Column, name: str) -> Column:
    """``text`` as bytes of an encoding; characters it lacks become ``?``."""
    if name in _WIDE:
        return F.encode(text, _WIDE[name])
    upper = _high_characters(name)
    kept = F.regexp_replace(text, f"[^\\x00-\\x7F{_class(upper.values())}]", "?")
    # every character becomes that of its byte in Latin-1
    return F.encode(F.translate(kept, "".join(upper.values()), "".join(map(chr, upper))), "ISO-8859-1")


def _pairs(data: Column) -> Column:
    """The telling pairs of neighbouring bytes, repeats included, as two characters of Latin-1:
    an array of those at even and one of those at odd offsets. UTF-16's two byte orders differ
    in that. Pairs that tell nothing are passed over inside the pattern."""
    text = F.decode(data, "ISO-8859-1")
    return F.array(*[F.regexp_extract_all(part, F.lit(r"(?s)\G(?:[\x01-\x7F][\x01-\x7F])*+(..)"), 1)
                     for part in (text, F.substring(text, F.lit(2), F.length(text)))])


def learn_encodings(texts: DataFrame, text_col: str = "text", candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """A model from whole texts: ``odd`` (whether at an odd offset), ``pair``
    (two bytes as Latin-1) and a column of log-likelihoods per
    candidate; the row of the empty ``pair`` holds those of pairs never seen.

    Words, then neighbouring characters are counted; what bytes they are in each candidate is
    worked out on the distinct ones. Null and empty texts teach nothing; without any text
    all pairs are equally likely. The model is at most ``PAIRS`` + 1 rows: write it with
    ``model.write.parquet`` and read it back to use it again.
    """
    # chunks overlap by the character that the next one starts with, and so do the words in them;
    # a pattern's last character is never consumed, so every pair is in one word of one chunk
    chunks = texts.select(F.explode(F.regexp_extract_all(
        F.concat(q(text_col), F.lit(END)), F.lit(f"(?s)(?=(.{{1,{STEP + 1}}})).{{1,{STEP}}}"), 1)).alias("chunk"))
    words = chunks.select(F.explode(F.regexp_extract_all(
        "chunk", F.lit("(?s)(?=((?:[^ ]{1,64} ?| ).))(?:[^ ]{1,64} ?| )(?=.)"), 1)).alias("word")).groupBy("word").count()
    counted = (words.select("count", F.explode(F.regexp_extract_all("word", F.lit("(?s)(?=(..))."), 1)).alias("p"))
               .groupBy(F.substring("p", 1, 1).alias("a"), F.translate(F.substring("p", 2, 1), END, "").alias("b"))
               .agg(F.sum("count").alias("count")))
    spelled = F.array(*[F.concat(encoded(F.col("a"), name), F.coalesce(F.substring(encoded(F.col("b"), name), 1, 1), F.lit(b"")))
                        for name in candidates])
    aligned = [-1] + [i for i, name in enumerate(candidates) if name.startswith("utf-16")]
    parities = F.when(F.col("nth").isin(*aligned), F.array("odd")).otherwise(F.array(F.lit(0), F.lit(1)))  # else at any offset
    seen = materialize(
        counted.select("count", F.posexplode(spelled).alias("nth", "data"))
        .select("count", "nth", F.posexplode(_pairs(F.col("data"))).alias("odd", "pairs"))
        .select("count", "nth", parities.alias("odds"), F.explode("pairs").alias("pair"))
        .select("count", "nth", "pair", F.explode("odds").alias("odd"))
        .groupBy("odd", "pair").agg(*[F.sum(F.when(F.col("nth") == i, F.col("count")).otherwise(0)).alias(f"n{i}")
                                      for i in range(len(candidates))]))
    totals = seen.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(len(candidates))]).first()
    unseen = texts.sparkSession.range(1).select(
        F.lit(0).alias("odd"), F.lit(FLOOR).alias("pair"), *[F.lit(0).cast("long").alias(f"n{i}") for i in range(len(candidates))])
    return seen.unionByName(unseen).select("odd", "pair", *[
        F.log((F.col(f"n{i}") + UNSEEN) / (total + UNSEEN * PAIRS)).alias(name)
        for i, (name, total) in enumerate(zip(candidates, totals, strict=True))])


def _possible(data: Column, name: str) -> Column:
    """Whether bytes can be text of an encoding at all, as far as a scan without decoding tells."""
    if name == "utf-8":
        return F.is_valid_utf8(data.cast("string"))
    if name in _WIDE:
        return F.octet_length(data) % 2 == 0
    gaps = [chr(b) for b in range(128, 256) if b not in _high_characters(name)]
    return ~F.regexp_like(F.decode(data, "ISO-8859-1"), F.lit(f"[{_class(gaps)}]")) if gaps else F.lit(True)


def guess_encoding(files: DataFrame, model: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """``(key, encoding)``, one row per file of ``files(key, content)``, whose keys are distinct: the encoding by byte order mark, else the candidate of the model under which the content
    is most likely, among those it is possible in. Null and empty content, and content
    without a telling pair, get the model's first candidate; a tie gets the earlier one, and
    content possible in none the first.
    """
    names = model.columns[2:]
    floor = model.where(F.col("pair") == F.lit(FLOOR)).first()
    marked = detect_encoding(files.select(q(key).alias("key"), q(content).alias("data")), "data", "")
    data = F.col("data")
    flags = F.array(*[F.coalesce(_possible(data, name), F.lit(True)) for name in names])
    size = F.octet_length(data)
    chunks = F.when((F.col("bom_bytes") == 0) & (size > 1), F.transform(
        F.sequence(F.lit(0), size - 2, F.lit(STEP)), lambda s: F.substring(data, s + 1, F.lit(STEP + 1))))
    # the content itself goes no further than its chunks
    cut = marked.select("key", F.when(F.col("bom_bytes") > 0, F.lower("encoding")).alias("mark"), flags.alias("possible"),
                        F.explode_outer(chunks).alias("chunk"))
    counted = (cut.select("key", "mark", "possible", F.posexplode_outer(_pairs(F.col("chunk"))).alias("odd", "pairs"))
               .select("key", "mark", "possible", "odd", F.explode_outer("pairs").alias("pair"))
               .groupBy("key", "mark", "possible", "odd", "pair").count())
    likely = counted.join(F.broadcast(model), ["odd", "pair"], "left")  # at most PAIRS + 1 rows
    summed = likely.groupBy("key", "mark", "possible").agg(*[
        F.sum(F.when(F.col("pair").isNull(), 0.0).otherwise(F.col("count") * F.coalesce(q(name), F.lit(floor[name]))))
        .alias(f"s{i}") for i, name in enumerate(names)])
    ranked = F.array_max(F.array(*[F.struct(
        F.when(F.element_at("possible", i + 1), F.col(f"s{i}")).otherwise(F.lit(-math.inf)).alias("score"),
        F.lit(-i).alias("earlier"), F.lit(name).alias("name")) for i, name in enumerate(names)]))
    return summed.select(F.col("key").alias(key), F.coalesce("mark", ranked["name"]).alias("encoding"))


@F.pandas_udf(T.StringType())
def decoded(data: pd.Series, encoding: pd.Series) -> pd.Series:
    """Bytes as text of the named encoding, without a byte order mark; null where the bytes
    are not valid in it. (Spark's own ``decode`` ends the job then, and knows fewer names.)"""
    def one(raw, name):
        try:
            return None if raw is None else bytes(raw).decode(name).removeprefix("\ufeff")
        except (UnicodeDecodeError, LookupError):
            return None
    return pd.Series([one(raw, name) for raw, name in zip(data, encoding)], dtype=object)
