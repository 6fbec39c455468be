"""Toxicity by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(cut_k - w.x): one weight vector shared by all ordered
thresholds. The severity of a document is its expected grade."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from tessera.llm.common import persist, small_batches, text_or_empty

SAMPLE_PER_CLASS = 3000   # labelled documents of each class that the fit may see
MIN_DOCUMENTS = 4         # sampled documents that a feature must occur in
MIN_Z = 4.0               # standard errors that its rates in the two classes must lie apart
MIN_GAP = 0.025           # and by how much, so that words of a few copied documents teach nothing
BEGINNINGS = (4, 5)       # letters of a word's beginning that are features too
DOSES = 3                 # severity grades of toxic documents
REJECT_AT = 0.5           # probability of any toxic grade from which a document is toxic
MEMO_WORDS = 60_000

# every ASCII character but letters separates words
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def features_of(word: bytes) -> list[str]:
    """A word and its beginnings."""
    w = word.decode("utf-8", "replace")
    return [w] + [f"{w[:n]}~" for n in BEGINNINGS if len(w) > n]


# -------------------------------------------------------------------- model
@dataclass
class OrdinalModel:
    """``vocabulary`` maps features to columns of ``weights``; ``cuts`` has one
    ascending threshold less than there are grades."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __post_init__(self):
        self._memo: dict[bytes, tuple[int, ...]] = {}

    def columns(self, text: str) -> list[int]:
        """The features that occur in ``text``."""
        memo, found = self._memo, set()
        for w in set(words(text)):
            hit = memo.get(w)
            if hit is None:
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                hit = memo[w] = tuple(i for f in features_of(w) if (i := self.vocabulary.get(f)) is not None)
            if hit:
                found.update(hit)
        return sorted(found)

    def at_least(self, text: str) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, .. ; empty if the model has one grade only."""
        score = float(self.weights[self.columns(text)].sum()) if len(self.weights) else 0.0
        return 1 / (1 + np.exp(np.clip(self.cuts - score, -500, 500)))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, width: int, importance: np.ndarray,
                l2: float = 1e-3, steps: int = 1000, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of least penalised negative log-likelihood, by full-batch
    Adam. Cuts stay ascending: the first is free, the others add exp(gap)."""
    top = int(grades.max(initial=0))
    if top == 0:
        return np.zeros(width), np.zeros(0)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([np.asarray(r, np.int64) for r in rows]) if len(doc) else np.zeros(0, np.int64)
    importance = importance / importance.sum()
    share = np.array([importance[grades <= k].sum() for k in range(top)]).clip(1e-6, 1 - 1e-6)
    start = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    index = np.arange(len(rows))
    for step in range(1, steps + 1):
        w, gaps = theta[:width], np.exp(theta[width + 1:])
        cuts = theta[width] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(doc, w[col], minlength=len(rows))
        below = np.zeros((len(rows), top + 2))
        below[:, -1] = 1
        below[:, 1:-1] = sigmoid(cuts[None, :] - score[:, None])
        slope = below * (1 - below)
        p = np.maximum(below[index, grades + 1] - below[index, grades], 1e-12)
        upper, lower = slope[index, grades + 1] / p, slope[index, grades] / p
        by_score = importance * (upper - lower)
        by_cut = np.array([-(importance * upper)[grades == k].sum() + (importance * lower)[grades == k + 1].sum()
                           for k in range(top)])
        by_gap = [by_cut[k:].sum() * gaps[k - 1] for k in range(1, top)]
        grad = np.concatenate([np.bincount(col, by_score[doc], minlength=width) + l2 * w / max(len(rows), 1) * 10,
                               [by_cut.sum()], by_gap])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        theta -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return theta[:width], theta[width] + np.concatenate(([0.0], np.cumsum(np.exp(theta[width + 1:]))))


def dose_grades(rows: list[list[int]], toxic: np.ndarray, marker: np.ndarray, doses: int = DOSES) -> np.ndarray:
    """Severity grades from 0/1 labels: clean documents are 0, toxic ones 1 to
    ``doses`` by the quantile of how many marker features they hold."""
    grades = np.zeros(len(rows), np.int64)
    count = np.array([int(marker[r].sum()) for r in rows], np.int64)
    is_toxic = toxic > 0
    if is_toxic.any():
        limits = np.quantile(count[is_toxic], [k / doses for k in range(1, doses)])
        grades[is_toxic] = 1 + (count[is_toxic, None] > limits[None, :]).sum(1)
        _, grades[is_toxic] = np.unique(grades[is_toxic], return_inverse=True)  # without empty grades
        grades[is_toxic] += 1
    return grades


# ---------------------------------------------------------------------- fit
def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> tuple[DataFrame, dict[int, int]]:
    """``(text, toxic)`` of at most ``per_class`` labelled documents of each
    class, those of smallest hashed id, and how many each class has in all."""
    known = persist(labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("toxic"))
                    .where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic")),
                    "toxic-labels")
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("id"), F.col("id")]
    picked = [known.where(F.col("toxic") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    picked = picked[0].union(picked[1])  # two per_class rows at most
    rows = (docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(picked), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))
    return persist(rows.select("text", "toxic"), "toxic-sample"), totals


def vocabulary(sample: DataFrame, sizes: dict[int, int]) -> list[tuple[str, float]]:
    """The features whose document rates in the two classes lie ``MIN_GAP`` and
    ``MIN_Z`` standard errors apart, all of them: a document of the two classes
    has so many features on average, and no more than that divided by
    ``MIN_GAP`` can be so frequent in one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, toxic in zip(b.column(0), b.column(1), strict=True):
                seen = sorted({f for w in set(words(text.as_py())) for f in features_of(w)})
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), pa.array([toxic.as_py()] * len(seen), pa.int32())],
                                                 names=["feature", "toxic"])

    schema = StructType([StructField("feature", StringType()), StructField("toxic", IntegerType())])
    n0, n1 = max(sizes.get(0, 0), 1), max(sizes.get(1, 0), 1)
    counts = sample.mapInArrow(run, schema).groupBy("feature").agg(
        F.sum("toxic").alias("in_toxic"), F.count("*").alias("n")).where(F.col("n") >= MIN_DOCUMENTS)
    p1, p0, p = F.col("in_toxic") / n1, (F.col("n") - F.col("in_toxic")) / n0, F.col("n") / (n0 + n1)
    z = (p1 - p0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n0 + 1 / n1))
    rows = (counts.withColumn("z", z).where((F.abs("z") >= MIN_Z) & (F.abs(p1 - p0) >= MIN_GAP))
            .orderBy(F.abs("z").desc(), "feature").select("feature", "z").collect())
    return [(r.feature, r.z) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = SAMPLE_PER_CLASS) -> OrdinalModel:
    """A model from a bounded sample of labelled rows (``per_class`` documents of
    each class). Rows without an id or a label teach
    nothing; of repeated ids the largest label counts. Without toxic labels the
    model has the one grade 0."""
    sample, totals = labelled_sample(docs, labels, per_class, id_col, text_col, label_col)
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return OrdinalModel()
    chosen = vocabulary(sample, sizes)
    model = OrdinalModel({f: i for i, (f, _) in enumerate(chosen)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [model.columns(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(cols, pa.list_(pa.int32())), b.column(1)], names=["cols", "toxic"])

    schema = StructType([StructField("cols", ArrayType(IntegerType())), StructField("toxic", IntegerType())])
    got = sorted((list(r.cols), r.toxic) for r in sample.mapInArrow(run, schema).collect())
    rows, toxic = [r for r, _ in got], np.array([t for _, t in got])
    grades = dose_grades(rows, toxic, np.array([z > 0 for _, z in chosen]))
    # the sample holds as many toxic as clean documents; weigh them as they occur
    weight = np.where(toxic > 0, totals[1] / sizes[1], totals[0] / sizes[0])
    weights, cuts = fit_ordinal(rows, grades, len(chosen), weight)
    return OrdinalModel(model.vocabulary, weights, cuts)


# -------------------------------------------------------------------- score
def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
          reject_at: float = REJECT_AT) -> DataFrame:
    """``carry`` columns, ``severity`` (expected grade), ``p_toxic`` (probability
    of any grade above 0) and ``toxic``, over whole texts.

    Null and empty texts have no features: their severity is the prior's.
    Rows are scored one by one, so repeated rows and null ids come back as
    they are; empty tables give no rows.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], text_or_empty(text_col).alias("__text"))
    schema = StructType([*rows.schema.fields[:-1], StructField("severity", DoubleType()), StructField("p_toxic", DoubleType())])
    names = [*carry, "severity", "p_toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            above = [model.at_least(t.as_py()) for t in b.columns[-1]]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([float(a.sum()) for a in above], pa.float64()),
                 pa.array([float(a[0]) if len(a) else 0.0 for a in above], pa.float64())], names=names)

    return small_batches(rows).mapInArrow(run, schema).withColumn("toxic", F.col("p_toxic") >= reject_at)


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that a model fitted on ``labels`` rejects, same columns."""
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), F.col(f"`{text_col}`").alias("__body"))
    kept = score(packed, fit(docs, labels, id_col, text_col), "__body", carry=("__row",)).where("NOT toxic")
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in cols])
