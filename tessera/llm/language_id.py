"""Language identification by cross-parsing: a text is cut greedily into the
longest pieces that occur in a language's reference text, found on the
reference's suffix automaton; the language that needs the fewest pieces,
normalised, wins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.llm.common import small_batches

SAMPLE_DOCUMENTS = 24    # labelled rows per language that the references are made of, with their whole texts
SHORT_TEXT = 1500        # texts of up to so many characters are picked before longer ones
BLOCK = 1024             # symbols of a text that are parsed side by side with its other blocks; no bound on a piece
GROUP_SYMBOLS = 2 << 20  # symbols held at a time
BRANCH = 100             # partitions whose best rows meet first
UNDETERMINED = "und"

SPACE, OTHER, PAD, FIRST = 0, 1, 2, 3  # symbols; the alphabet's letters follow
DENSE_LETTERS = 253                     # letters, the most frequent ones, whose transitions are a dense table
DENSE_BYTES = 256 << 20                 # of that table at most; all other transitions are looked up by key
COUNT_SHIFT = 28                        # transitions hold pieces ended above this bit, the next state below


def is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def symbol_table(alphabet: str) -> np.ndarray:
    """Symbol of every code point: letters of the alphabet in either case, other
    letters, and white space for all else."""
    table = np.where(is_letter(), OTHER, SPACE).astype(np.min_scalar_type(FIRST + len(alphabet)))
    for i, c in enumerate(alphabet):
        for form in {c, c.upper(), c.title()}:
            if len(form) == 1:
                table[ord(form)] = FIRST + i
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a text; runs of anything but letters are one space."""
    s = table[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    keep = s != SPACE
    keep[1:] |= s[:-1] != SPACE
    return s[keep]


def suffix_automaton(reference: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``reference``: from state 0 they
    spell every substring of it and nothing else."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in reference.tolist():
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return following


def parse_table(following: list[dict[int, int]], width: int, offset: int) -> np.ndarray:
    """Dense transitions of greedy parsing for symbols below ``width``: a symbol that does not extend the
    piece ends it and begins the next; one that the reference lacks is a piece
    of its own. Values hold the pieces ended and the next state, plus ``offset``."""
    restart = np.full(width, offset, np.int64)
    for c, q in following[0].items():
        if c < width:
            restart[c] = q + offset
    ends = np.where(restart == offset, 2, 1)  # the piece before, and an unknown symbol itself
    table = np.tile(restart + (ends << COUNT_SHIFT), (len(following), 1))
    table[0] = restart + ((ends - 1) << COUNT_SHIFT)
    for state, row in enumerate(following):
        for c, q in row.items():
            if c < width:
                table[state, c] = q + offset
        table[state, PAD] = state + offset
    return table.astype(np.int32)


class RareTransitions:
    """Transitions of the symbols beyond the dense table, as sorted keys."""

    def __init__(self, automata: list[list[dict[int, int]]], starts: list[int], width: int):
        found = [(state + at, c, q + at) for following, at in zip(automata, starts, strict=True)
                 for state, row in enumerate(following) for c, q in row.items() if c >= width]
        state, c, q = np.array(found, np.int64).reshape(-1, 3).T
        keys = state << 21 | c  # code points, and so symbols, have 21 bits
        order = np.argsort(keys)
        self.keys, self.next = np.append(keys[order], -1), np.append(q[order], -1)

    def _look_up(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) << 21 | c
        at = np.searchsorted(self.keys[:-1], key)
        return np.where(self.keys[at] == key, self.next[at], -1)

    def step(self, state: np.ndarray, c: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """As ``parse_table``: for states, symbols ``c`` and the states ``starts`` in which
        their languages begin (arrays of one shape) the pieces ended and the next state."""
        c = c.astype(np.int64)
        on, begin = self._look_up(state, c), self._look_up(starts, c)
        ends = np.where(begin < 0, 2, 1) - (state == starts)
        fresh = np.where(begin < 0, starts, begin) + (ends << COUNT_SHIFT)
        return np.where(on >= 0, on, fresh)


@dataclass
class LanguageModel:
    """References by language and the alphabet they are written in."""

    references: dict[str, np.ndarray] = field(default_factory=dict)
    alphabet: str = ""

    def __post_init__(self):
        self._ready = None

    def _prepare(self):
        if self._ready is None:
            automata = [suffix_automaton(ref) for ref in self.references.values()]
            states = [len(a) for a in automata]
            width = FIRST + max(0, min(len(self.alphabet), DENSE_LETTERS, DENSE_BYTES // (4 * max(1, sum(states))) - FIRST))
            starts = [sum(states[:i]) for i in range(len(states))]
            tables = [parse_table(a, width, at) for a, at in zip(automata, starts, strict=True)]
            rare = RareTransitions(automata, starts, width) if width < FIRST + len(self.alphabet) else None
            flat = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int32)
            weight = np.log2([len(r) + 1.0 for r in self.references.values()])
            self._ready = symbol_table(self.alphabet), flat, np.array(starts, np.int32), width, weight, rare
        return self._ready

    def __getstate__(self):
        return {"references": self.references, "alphabet": self.alphabet, "_ready": None}

    def _step(self, state: np.ndarray, symbol: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Transitions of many parses at once (arrays of one shape)."""
        _, flat, _, width, _, rare = self._prepare()
        if rare is None:
            return flat[state * np.int64(width) + symbol]
        step = flat[state * np.int64(width) + np.where(symbol < width, symbol, OTHER)]
        beyond = symbol >= width
        if beyond.any():
            step[beyond] = rare.step(state[beyond], symbol[beyond], starts[beyond])
        return step

    def pieces(self, texts: list[np.ndarray]) -> np.ndarray:
        """Pieces that each whole text needs in each language, (texts, languages).

        A text's blocks are first parsed side by side, each as if it began a text.
        Then every block is parsed again from the state that the block before it
        ends in, until the two parses stand in the same state: from there on they
        are one, so the rest is known. A block in which they never meet (a piece
        spans it) ends in another state, and the block after it is done again."""
        _, _, starts, _, _, _ = self._prepare()
        langs, mask = len(starts), (1 << COUNT_SHIFT) - 1
        out = np.zeros((len(texts), langs), np.int64)
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // BLOCK) for t in texts])
        if not len(owner) or not langs:
            return out
        joined = np.concatenate(texts)
        size = np.concatenate([np.minimum(BLOCK, len(t) - np.arange(0, len(t), BLOCK)) for t in texts if len(t)])
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        # every block from its language's start; states and pieces ended after each symbol
        states = np.empty((langs, len(joined)), np.int32)
        ended = np.empty((langs, len(joined)), np.int16)
        order = np.argsort(-size, kind="stable")
        sorted_begin, sorted_size = begin[order], size[order]
        active = len(size) - np.searchsorted(np.sort(size), np.arange(BLOCK), side="right")
        state = np.repeat(starts[:, None], len(size), axis=1)
        count = np.zeros(state.shape, np.int16)
        for j in range(int(sorted_size[0])):
            n = int(active[j])
            at = sorted_begin[:n] + j
            step = self._step(state[:, :n], np.broadcast_to(joined[at], (langs, n)), np.broadcast_to(starts[:, None], (langs, n)))
            count[:, :n] += (step >> COUNT_SHIFT).astype(np.int16)
            state[:, :n] = step & mask
            states[:, at], ended[:, at] = state[:, :n], count[:, :n]
        last = begin + size - 1
        total, final = ended[:, last].astype(np.int64), states[:, last].copy()
        follows = np.zeros(len(size), bool)
        follows[1:] = owner[1:] == owner[:-1]
        lang, block = np.nonzero(follows[None, :] & (np.roll(final, 1, axis=1) != starts[:, None]))
        while len(lang):  # blocks whose beginning is not the start of a piece
            now, so_far = final[lang, block - 1], np.zeros(len(lang), np.int64)
            changed: list[np.ndarray] = []
            at = begin[block]
            while len(lang):
                step = self._step(now, joined[at], starts[lang])
                so_far += step >> COUNT_SHIFT
                now = step & mask
                met, over = now == states[lang, at], at == last[block]
                done = met | over
                if done.any():
                    k, b = lang[done], block[done]
                    # a parse that met the other at the block's end or before has the other's rest
                    total[k, b] = so_far[done] + np.where(met[done], ended[k, last[b]].astype(np.int64) - ended[k, at[done]], 0)
                    ends_in = np.where(met[done], states[k, last[b]], now[done])
                    other = final[k, b] != ends_in
                    final[k, b] = ends_in
                    goes_on = other & (b + 1 < len(size)) & follows[np.minimum(b + 1, len(size) - 1)]
                    changed.append(np.stack([k[goes_on], b[goes_on] + 1]))
                    lang, block, now, so_far, at = lang[~done], block[~done], now[~done], so_far[~done], at[~done]
                at = at + 1
            lang, block = np.concatenate(changed, axis=1) if changed else (np.zeros(0, np.int64),) * 2
        closes = np.append(~follows[1:], True)  # the piece that the text's end cuts off
        total[:, closes] += final[:, closes] != starts[:, None]
        for k in range(langs):
            out[:, k] = np.bincount(owner, total[k], minlength=len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text: the score is how much smaller the
        winner's normalised piece count is than the runner-up's. Equal counts
        go to the first language by name, with score 0."""
        table, _, _, _, weight, _ = self._prepare()
        names = list(self.references)
        coded = [symbols(t or "", table) for t in texts]
        known = [names and bool((c != SPACE).any()) for c in coded]
        cost = self.pieces(coded) * weight[None, :] if names else np.zeros((len(texts), 0))
        out = []
        for row, ok in zip(cost, known, strict=True):
            if not ok:
                out.append((UNDETERMINED, 0.0))
                continue
            best = int(row.argmin())
            second = np.delete(row, best).min(initial=np.inf)
            score = 1.0 if not np.isfinite(second) else float(1 - row[best] / second) if second > 0 else 0.0
            out.append((names[best], min(1.0, max(0.0, score))))
        return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id's text modulo 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          documents: int = SAMPLE_DOCUMENTS, short: int = SHORT_TEXT) -> LanguageModel:
    """References from a bounded sample of rows: of every language ``documents`` rows
    among distinct ids with a letter in their text, one a text, by hash of the id;
    texts of up to ``short`` characters first, longer ones by length after them.
    Every text picked is learned whole. Rows with null id, text or language teach
    nothing.

    Copies and repeated ids meet by aggregation of narrow rows. The best rows of
    each partition meet those of ``BRANCH`` others, and then the best of all, so a
    frequent language is no hot task at any number of partitions."""
    usable = (docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
              .where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.regexp_like("text", F.lit(r"\p{L}")))
              .withColumn("hash", F.xxhash64("text")))
    size = F.when(F.char_length("text") > short, F.char_length("text")).otherwise(0)
    by_id = usable.groupBy("lang", "id").agg(F.min(F.struct("hash", size.alias("size"))).alias("h"))  # repeated ids count once
    by_text = by_id.groupBy("lang", "h").agg(F.min(F.struct(F.xxhash64("id").alias("key"), "id")).alias("least"))
    order = ("h.size", "least.key", "least.id")
    best = by_text.withColumn("branch", F.floor(F.spark_partition_id() / BRANCH))
    for group in (("lang", "branch"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        best = best.withColumn("rank", rank).where(F.col("rank") <= documents)
    picked = best.select("lang", F.col("least.id").alias("id"), F.col("h.hash").alias("hash"))
    rows = (usable.join(F.broadcast(picked), ["lang", "id", "hash"])
            .groupBy("lang", "id").agg(F.min("text").alias("text")))

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = [" ".join("".join(c if c.isalpha() else " " for c in t.as_py().lower()).split()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(clean, pa.string())], names=["lang", "part"])

    schema = StructType([StructField("lang", StringType()), StructField("part", StringType())])
    got = sorted((r.lang, r.part) for r in rows.mapInArrow(letters, schema).collect())
    by_lang: dict[str, list[str]] = {}
    for lang, part in got:
        if part:
            by_lang.setdefault(lang, []).append(part)
    counts: dict[str, int] = {}
    for parts in by_lang.values():
        for p in parts:
            for c in p:
                counts[c] = counts.get(c, 0) + 1
    counts.pop(" ", None)
    alphabet = "".join(sorted(counts, key=lambda c: (-counts[c], c)))
    table = symbol_table(alphabet)
    return LanguageModel({lang: symbols(" ".join(parts), table) for lang, parts in by_lang.items()}, alphabet)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, ``lang_pred`` and ``score`` of every row, from its whole
    text alone. A null text, one without a letter, and every text when nothing
    was learned are ``und`` with score 0. Rows are independent: repeated rows
    and null ids come back as they are, empty tables give no rows."""
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text_col).cast("string").alias("__text"))
    schema = StructType([*rows.schema.fields[:-1], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    names = [*carry, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[str, float]] = []
            group, held = [], 0
            for t in b.columns[-1]:
                group.append(t.as_py())
                held += len(group[-1] or "")
                if held >= GROUP_SYMBOLS:
                    found += model.predict(group)
                    group, held = [], 0
            found += model.predict(group)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], names=names)

    return small_batches(rows).mapInArrow(run, schema)
