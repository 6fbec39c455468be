"""Spelling variant grouping by a frequency-vector trie.

Letters fall into a few groups. A word's vector holds how many letters of each
group it has, and the words hang in a trie by successive counts. One inserted,
deleted or replaced letter changes the vector by one surplus and one deficit at
most, so a depth-first search with a budget of one each reaches the leaf of
every word that near; the words of the leaves reached are verified."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.llm.common import persist

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "a-zÀ-ÿ"     # of lower-cased text
GROUPS = 8
SHARD_WORDS = 50_000    # words of the trie that one search holds; more are dealt to several
KEPT_SEARCHES = 100_000  # leaves found are kept for so many vectors at a time

Vector = tuple[int, ...]


# ------------------------------------------------------------------ the trie
class Trie:
    """Words by the counts of their letter groups. A leaf (a whole vector)
    holds words of one length, found again by their first or last half."""

    def __init__(self, group_of: dict[int, str], groups: int = GROUPS):
        self.group_of, self.digits = group_of, "".join(chr(33 + g) for g in range(groups))
        self.root: dict = {}
        self.leaves: dict[Vector, tuple[dict[str, list], dict[str, list]]] = {}

    def vector(self, word: str) -> Vector:
        marked = word.translate(self.group_of)
        return tuple(map(marked.count, self.digits))

    def add(self, word: str, n: int) -> None:
        vector = self.vector(word)
        if vector not in self.leaves:
            node = self.root
            for count in vector[:-1]:
                node = node.setdefault(count, {})
            node[vector[-1]] = self.leaves[vector] = (defaultdict(list), defaultdict(list))
        heads, tails = self.leaves[vector]
        half = len(word) // 2
        heads[word[:half]].append((word, n))
        tails[word[half:]].append((word, n))

    def search(self, vector: Vector) -> list[tuple[Vector, tuple]]:
        """Leaves whose vector exceeds ``vector`` by one in at most one group and
        then falls short by one in at most one *later* group. Of two different
        vectors within the budgets one reaches the other, never both."""
        found, stack, depth = [], [(0, self.root, 0, 0, ())], len(vector)
        while stack:
            level, node, surplus, deficit, path = stack.pop()
            if level == depth:
                found.append((path, node))
                continue
            own = vector[level]
            if (child := node.get(own)) is not None:
                stack.append((level + 1, child, surplus, deficit, (*path, own)))
            if not surplus and (child := node.get(own + 1)) is not None:
                stack.append((level + 1, child, 1, 0, (*path, own + 1)))
            if surplus and not deficit and own and (child := node.get(own - 1)) is not None:
                stack.append((level + 1, child, 1, 1, (*path, own - 1)))
        return found


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def near_in_leaf(word: str, leaf: tuple[dict, dict], length: int) -> Iterator[tuple[str, int]]:
    """Words of ``leaf`` (all of ``length``) one edit from ``word``: the edit
    leaves the first or the last half of them as it is."""
    heads, tails = leaf
    half = length // 2
    for other in heads.get(word[:half], ()):
        if one_edit(word, other[0]):
            yield other
    rest = length - half
    for other in tails.get(word[len(word) - rest:], ()) if len(word) >= rest else ():
        # those with an equal first half are counted above
        if other[0][:half] != word[:half] and one_edit(word, other[0]):
            yield other


# --------------------------------------------------------------- vocabulary
def damaged_word(doc_id: Column, run: Column) -> Column:
    """``run``, without one code point where the crc32 of ``<doc_id>:<run>`` is a
    multiple of 97."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % 97 == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 5,
               least_count: int = 3) -> DataFrame:
    """``(word, n)``: the lower-cased letter runs of all whole texts after
    :func:`damaged_word`, of ``least_letters`` code points and ``least_count``
    occurrences at least. Counts combine before the shuffle. Null texts have
    no runs; a null id counts as the empty string."""
    runs = F.split(F.translate(F.col(text_col).cast("string"), UPPER, UPPER.lower()), f"[^{LETTERS}]+")
    words = (docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
             .where(F.char_length("run") >= least_letters)  # no shorter run can give a word
             .select(damaged_word(F.col("id"), F.col("run")).alias("word"))
             .where(F.char_length("word") >= least_letters))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of ``words`` in groups of nearly equal use: by falling count,
    each to the group with the least so far. What reaches the driver is one row
    a letter."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    counted = sorted(((r["count"], r.letter) for r in letters.groupBy("letter").count().collect()), reverse=True)
    load, found = [0] * groups, [""] * groups
    for count, letter in counted:
        least = load.index(min(load))
        load[least] += count
        found[least] += letter
    return found


# --------------------------------------------------------------------- search
def _counts(word: Column, groups: list[str]) -> Column:
    """The vector of ``word`` as an array."""
    return F.array(*[(F.char_length(word) - F.char_length(F.translate(word, letters, ""))) if letters else F.lit(0)
                     for letters in groups]).cast("array<int>")


def _shard_depth(words: DataFrame, most: int, groups: int) -> tuple[int, int]:
    """The least number of levels whose largest subtree has at most ``most`` words
    (all levels if none has), and how many parts that subtree needs."""
    per_leaf = words.groupBy("vector").agg(F.count("*").alias("n"))
    per_leaf = persist(per_leaf, "spelling-leaves")
    largest = 0
    for depth in range(groups + 1):
        largest = per_leaf.groupBy(F.slice("vector", 1, depth)).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= most:
            break
    return depth, max(1, -(-largest // most))


def _shifts(depth: int) -> list[Vector]:
    """What a search may differ by in the first ``depth`` levels: nothing, one
    surplus, or one surplus and a later deficit."""
    zero = (0,) * depth
    one = [tuple(int(i == a) for i in range(depth)) for a in range(depth)]
    two = [tuple(int(i == a) - int(i == b) for i in range(depth)) for a, b in itertools.combinations(range(depth), 2)]
    return [zero, *one, *two]


PARTIAL = StructType([StructField("word", StringType()), StructField("n_near", LongType()),
                      StructField("best_n", LongType()), StructField("best", StringType())])


def _searcher(groups: list[str]):
    group_of = {ord(x): chr(33 + g) for g, letters in enumerate(groups) for x in letters}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trie, paths = None, None, {}
        for b in batches:
            near: dict[str, list] = {}

            def link(a: str, b: str, n: int, near=near) -> None:
                mine = near.get(a)
                if mine is None:
                    near[a] = [1, n, b]
                    return
                mine[0] += 1
                if n > mine[1] or (n == mine[1] and b < mine[2]):
                    mine[1:] = n, b

            for key, query, word, n in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if key != shard:
                    shard, trie, paths = key, Trie(group_of, len(groups)), {}
                if not query:
                    trie.add(word, n)
                    continue
                vector = trie.vector(word)
                if vector not in paths:  # words of one vector share the search
                    if len(paths) >= KEPT_SEARCHES:
                        paths.clear()
                    paths[vector] = trie.search(vector)
                for path, leaf in paths[vector]:
                    for other, m in near_in_leaf(word, leaf, sum(path)):
                        if path != vector:  # found from this side only
                            link(other, word, n)
                        link(word, other, m)
            if near:
                yield pa.RecordBatch.from_pydict(
                    {"word": list(near), "n_near": [x[0] for x in near.values()], "best_n": [x[1] for x in near.values()],
                     "best": [x[2] for x in near.values()]}, schema=pa.schema(
                        [("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))

    return search


def near_words(words: DataFrame, groups: list[str] | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(word, n_near, best_n, best)`` of every word of ``words(word, n)`` that has
    words one edit away: their number, and the most frequent of them (ties: the
    smallest in code-point order).

    The trie is dealt to tasks by its upper levels, as many as bring every
    subtree down to ``shard_words`` words. A word searches the subtrees that its
    budgets admit: its own and those one surplus, or one surplus and one later
    deficit away. A leaf with more words than that is dealt by hash, and searched
    in every part. A task streams the searching words and holds one subtree.
    What it finds is summed by word before the shuffle.
    """
    groups = groups if groups is not None else letter_groups(words)
    words = words.select("word", "n", _counts(F.col("word"), groups).alias("vector"))
    depth, parts = _shard_depth(words, shard_words, len(groups))
    top = F.slice("vector", 1, depth) if depth else F.array().cast("array<int>")
    part = F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int")
    members = words.select(F.concat(F.array(part), top).alias("shard"), F.lit(False).alias("query"), "word", "n")
    shifted = F.array(*[
        F.concat(F.array(F.lit(p)), *([F.array(*[F.get("vector", F.lit(i)) + F.lit(by) for i, by in enumerate(shift)])] if depth else []))
        for p in range(parts) for shift in _shifts(depth)])
    queries = words.select(F.explode(shifted).alias("shard"), F.lit(True).alias("query"), "word", "n")
    if depth:  # a shard without members answers nothing
        there = persist(members.select("shard").distinct(), "spelling-shards")
        queries = queries.join(there, "shard", "left_semi")
    dealt = members.union(queries).select(F.array_join("shard", ",").alias("shard"), "query", "word", "n")
    n_parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (dealt.repartition(n_parts, "shard").sortWithinPartitions("shard", "query")
             .mapInArrow(_searcher(groups), PARTIAL))
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for every row of ``forms(word, form)``: forms followed to
    the word that has none. A form is twice as frequent as its word, so chains
    are short and pointer doubling ends after the logarithm of their length."""
    reached = persist(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        doubled = persist(reached.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                    F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = doubled.select("word", "root")
        if doubled.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per word of the :func:`vocabulary`: ``word, form, root, n, n_near,
    form_n``.

    Words are near if one inserted, deleted or replaced code point turns one into
    the other. A word's ``form`` is its most frequent near word (ties: smallest in
    code-point order) if that is at least twice as frequent, else null; ``root``
    follows forms to the last, and is the word itself if it has none.

    Null and blank texts add nothing, very long texts are split whole, repeated
    rows count each time, an empty table gives no rows. Other columns play no
    part. No word, leaf or pair is dropped: a crowded leaf is divided.
    """
    words = persist(vocabulary(docs, id_col, text_col), "spelling-words")
    near = near_words(words, shard_words=shard_words)
    rated = persist(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best_n") >= 2 * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= 2 * F.col("n"), F.col("best_n")).alias("form_n")), "spelling-rated")
    followed = roots(rated.where("form IS NOT NULL"))
    return rated.join(followed, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                       "n_near", "form_n")
