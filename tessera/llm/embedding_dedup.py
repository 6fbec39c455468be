"""Embedding near-dedup with spherical-cap filters.

Filter directions are a structured random product code: after a random rotation
the space is cut into blocks, and a direction is one codeword per block. A
vector list-decodes to every direction whose inner product passes a threshold,
vectors that share a direction are compared exactly in double precision."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import connected_components, persist

COSINE = 0.95
CODES = 8             # independent codes; a pair must share a direction of one of them
SHARED = 4.0          # directions of each that a pair just at the threshold shares on average
MEMBERS = 96.0        # unrelated vectors that a direction holds on average
HOT_DIRECTION = 1024  # vectors of one direction that are compared in one go; more are dealt in pairs of blocks
SEED = 20240607
CODE_SHIFT = 48       # directions of code k are numbered from k << 48
MOST_WORDS = 16_384   # codewords of a block and directions of a vector at which caps get wider instead of more
LISTED = 64.0
LEAST_BLOCK = 4       # components of a block; fewer leave hardly any different codewords
RECALL = 0.99         # of pairs just at the threshold, by simulation
TRIALS, PROBES = 100, 2  # pairs and codes of that simulation


# --------------------------------------------------------------------- code
@lru_cache(maxsize=64)
def _angles(dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid of angles to a fixed direction, and of a uniform unit vector of ``dim`` >= 2
    components the share at every grid point and up to it."""
    phi = np.linspace(0, math.pi, 40_001)
    density = np.sin(phi) ** (dim - 2)
    below = np.concatenate(([0.0], np.cumsum((density[1:] + density[:-1]) / 2)))
    return phi, density / below[-1], below / below[-1]


def _tail(dim: int, x: np.ndarray) -> np.ndarray:
    """P(one component of a uniform unit vector of ``dim`` components reaches ``x``)."""
    if dim == 1:
        return np.where(x <= -1, 1.0, np.where(x <= 1, 0.5, 0.0))
    phi, _, below = _angles(dim)
    return np.where(x <= 1, np.interp(np.arccos(np.clip(x, -1, 1)), phi, below), 0.0)


def _pair_tail(dim: int, threshold: float, cosine: float) -> float:
    """P(both of two unit vectors at ``cosine`` reach ``threshold`` with a random direction)."""
    phi, density, _ = _angles(dim)
    inside = (phi <= math.acos(threshold)) & (phi > 0)
    rest = math.sqrt(1 - cosine * cosine) * np.sin(phi[inside])
    return float((density[inside] * _tail(dim - 1, (threshold - cosine * np.cos(phi[inside])) / rest)).sum())


@dataclass(frozen=True)
class ProductCode:
    rotation: np.ndarray               # (dim, dim), orthonormal
    words: tuple[np.ndarray, ...]      # per block: (codewords, block dim), unit length
    threshold: float                   # inner product that a direction must reach

    @property
    def directions(self) -> int:
        return math.prod(len(w) for w in self.words)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For every row of ``unit`` the numbers of all directions that it
        reaches. Blocks are joined one by one; a partial sum goes on only if
        the best codewords of the blocks to come could still reach the threshold."""
        turned = unit @ self.rotation
        cuts = np.cumsum([0] + [w.shape[1] for w in self.words])
        scale = 1 / math.sqrt(len(self.words))
        gains = [turned[:, a:b] @ w.T * scale for a, b, w in zip(cuts[:-1], cuts[1:], self.words, strict=True)]
        best_all = np.sum([g.max(1) for g in gains], axis=0)
        best_left = np.cumsum([np.zeros(len(unit))] + [g.max(1) for g in gains[:0:-1]], axis=0)[::-1]
        out = []
        for row in range(len(unit)):
            total, number = np.zeros(1), np.zeros(1, np.int64)
            for k, g in enumerate(gains):
                need = self.threshold - best_left[k][row]
                # only codewords that reach the threshold with the best of all other blocks
                alive = np.nonzero(g[row] >= self.threshold - (best_all[row] - g[row].max()) - 1e-9)[0]
                order = alive[np.argsort(-g[row][alive])]
                ranked = g[row][order]
                # of every partial sum the codewords that keep it alive: a prefix of the ranking
                reach = np.searchsorted(-ranked, total - need, side="right")
                rows = np.repeat(np.arange(len(total)), reach)
                nth = np.arange(len(rows)) - np.repeat(np.cumsum(reach) - reach, reach)
                total, number = total[rows] + ranked[nth], number[rows] * g.shape[1] + order[nth]
            out.append(number)
        return out


def _draw(dim: int, blocks: int, each: int, threshold: float, seed: int) -> ProductCode:
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    if dim == 1:
        return ProductCode(rotation, (np.array([[1.0], [-1.0]]),), threshold)
    words = []
    for part in np.array_split(np.arange(dim), blocks):
        w = rng.standard_normal((each, len(part)))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True))
    return ProductCode(rotation, tuple(words), threshold)


def _pairs_at(dim: int, cosine: float, many: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``many`` random pairs of unit vectors at ``cosine``."""
    rng = np.random.default_rng(seed)
    x, z = unit_rows(rng.standard_normal((many, dim))), rng.standard_normal((many, dim))
    z = unit_rows(z - (z * x).sum(1, keepdims=True) * x)
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * z


@lru_cache(maxsize=256)
def _shape(dim: int, rows: int, cosine: float, shared: float, members: float, codes: int) -> tuple[int, int, float]:
    """``(blocks, codewords of each, threshold)``. A direction is a unit vector, so
    the share of vectors that reach it follows from the sphere alone; how the
    directions of a pair bunch does not, so the codewords grow until random pairs
    at ``cosine`` are found with ``RECALL`` in ``codes`` codes."""
    if dim == 1:
        return 1, 2, 0.5
    cosine = min(cosine, 1 - 1e-9)
    phi, _, below = _angles(dim)
    blocks = 2 if dim >= 2 * LEAST_BLOCK else 1
    keep = min(0.05, members / max(rows, 1))
    while True:
        threshold = math.cos(float(np.interp(keep, below, phi)))
        both = _pair_tail(dim, threshold, cosine)
        # few components leave no thin caps that two vectors at ``cosine`` could share: wider ones, with more members
        if keep >= 0.45 or (both > 0 and shared * keep / both <= LISTED and (shared / both) ** (1 / blocks) <= MOST_WORDS):
            break
        keep *= 1.25
    each = max(2, math.ceil((shared / both) ** (1 / blocks)))
    x, y = _pairs_at(dim, cosine, TRIALS, SEED)
    while True:
        missed = np.zeros(TRIALS)
        for probe in range(PROBES):
            code = _draw(dim, blocks, each, threshold, SEED + 1000 + probe)
            missed += [len(np.intersect1d(a, b)) == 0 for a, b in zip(code.decode(x), code.decode(y), strict=True)]
        miss = missed.sum() / (TRIALS * PROBES)
        if 1 - (miss + 2 * math.sqrt(miss * (1 - miss) / (TRIALS * PROBES))) ** codes >= RECALL:
            return blocks, each, threshold
        each = math.ceil(each * 1.2)


def make_code(dim: int, rows: int, cosine: float = COSINE, shared: float = SHARED, members: float = MEMBERS,
              seed: int = SEED, codes: int = CODES) -> ProductCode:
    """One of ``codes`` codes for ``rows`` vectors: the threshold leaves about
    ``members`` unrelated vectors to a direction (more if ``dim`` is small), and
    there are enough directions that a pair at ``cosine`` shares ``shared`` of
    them on average and is found by one of the codes with ``RECALL``."""
    return _draw(dim, *_shape(dim, rows, cosine, shared, members, codes), seed)


# --------------------------------------------------------------- comparison
def unit_rows(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def linked_pairs(nodes: np.ndarray, unit: np.ndarray, side: np.ndarray, cosine: float) -> np.ndarray:
    """Pairs (u < v) of one group at ``cosine`` or more. ``side`` is 0 for
    members that meet all, 1 and 2 for the two blocks of a dealt group, which
    meet across."""
    found = []
    for at in range(0, len(nodes), 512):
        near = unit[at: at + 512] @ unit.T >= cosine
        i, j = np.nonzero(near)
        i = i + at
        ok = (nodes[i] < nodes[j]) & ((side[i] == 0) | (side[i] != side[j]))
        found.append(np.stack([nodes[i[ok]], nodes[j[ok]]], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def near_links(vectors: DataFrame, dim: int, rows: int, cosine: float = COSINE, hot: int = HOT_DIRECTION,
               codes: int = CODES) -> DataFrame:
    """``(u, v)``, u < v: the linked pairs found among ``vectors(node, vector)``,
    distinct vectors of ``dim`` components."""
    drawn = [make_code(dim, rows, cosine, seed=SEED + k, codes=codes) for k in range(codes)]
    schema = StructType([StructField("direction", LongType()), StructField("node", LongType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(16, min(512, 2 ** 20 // max(len(w) for w in drawn[0].words)))
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                nodes, unit = part.column(0).to_numpy(), unit_rows(_matrix(part.column(1), dim))
                for k, code in enumerate(drawn):
                    lists = code.decode(unit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(lists) + (k << CODE_SHIFT)), pa.array(np.repeat(nodes, [len(x) for x in lists]))],
                        names=["direction", "node"])

    spread = vectors.select("node", "vector")
    reached = persist(spread.repartition(max(spread.sparkSession.sparkContext.defaultParallelism, rows // 2000 + 1), "node")
                      .mapInArrow(decode, schema), "cap-rows")
    # directions of many vectors are dealt out: a member goes to every pair of blocks that holds its own
    crowded = persist(reached.groupBy("direction").agg(F.count("*").alias("n")).where(F.col("n") > hot)
                      .select("direction", F.ceil(F.col("n") / (hot / 2)).cast("int").alias("blocks")), "cap-crowded")
    marked = reached.join(crowded, "direction", "left") if not crowded.isEmpty() else reached.withColumn(
        "blocks", F.lit(None).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (marked.withColumn("own", F.coalesce(own, F.lit(0)))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks") - 1, F.lit(0)))))
             .select("direction", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "node")
             .join(spread, "node").select("direction", "b1", "b2", "own", "node", "vector"))
    parts = dealt.repartition("direction", "b1", "b2").sortWithinPartitions("direction", "b1", "b2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(t: pa.Table) -> pa.RecordBatch:
            key = np.stack([t.column(i).to_numpy() for i in range(3)], 1)
            own, nodes = t.column(3).to_numpy(), t.column(4).to_numpy()
            unit = unit_rows(_matrix(t.column(5), dim))
            starts = np.concatenate(([0], np.nonzero((key[1:] != key[:-1]).any(1))[0] + 1, [len(key)]))
            found = []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a > 1:
                    side = np.zeros(b - a, np.int8) if key[a, 1] == key[a, 2] else np.where(own[a:b] == key[a, 1], 1, 2)
                    found.append(linked_pairs(nodes[a:b], unit[a:b], side, cosine))
            uv = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(uv[:, 0]), pa.array(uv[:, 1])], names=["u", "v"])

        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            key = np.stack([t.column(i).to_numpy() for i in range(3)], 1)
            last = np.nonzero((key != key[-1]).any(1))[0]  # the last group may go on in the next batch
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield pairs(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield pairs(held.combine_chunks())

    links = StructType([StructField("u", LongType()), StructField("v", LongType())])
    return parts.mapInArrow(compare, links).distinct()


# ------------------------------------------------------------------ operator
def is_comparable(vector: Column) -> Column:
    """Neither null nor empty nor zero, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         cosine: float = COSINE, hot: int = HOT_DIRECTION) -> DataFrame:
    """One row per input row: ``id, n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable) and ``kept`` (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; vectors of different length do not link. Equal vectors
    are one node, so copies cost one row; two distinct vectors are one node
    only if their 64-bit hashes collide. No link is below ``cosine``; the
    filters miss a link at ``cosine`` itself with a small probability, which
    falls quickly above it. Ids rank null last: ``component_id`` is null only
    if all ids reachable are, and such rows are kept. Repeated rows link with
    each other. Empty tables give no rows. Other columns play no part.
    """
    vector = F.col(vector_col)
    ok = is_comparable(vector)
    rows = persist(vectors.select(F.col(id_col).alias("id"), F.when(ok, vector).alias("vector"))
                   .withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector"))), "cap-vectors")
    distinct = persist(rows.where("node IS NOT NULL").groupBy("node", "vector")
                       .agg(F.min("id").alias("least_id"), F.count("*").alias("copies")), "cap-nodes")
    sizes = distinct.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).collect()
    links = None
    for size in sorted(sizes):
        found = near_links(distinct.where(F.size("vector") == size.dim), size.dim, size.n, cosine, hot)
        links = found if links is None else links.union(found)
    spark = vectors.sparkSession
    links = persist(links if links is not None else spark.createDataFrame([], "u long, v long"), "cap-links")
    parts = connected_components(links)
    copies = distinct.select("node", "copies")
    both = links.union(links.select("v", "u"))
    others = (both.join(copies, both["v"] == copies["node"]).groupBy("u").agg(F.sum("copies").alias("others"))
              .withColumnRenamed("u", "node"))
    member = (distinct.select("node", "least_id", "copies").join(parts, "node", "left").join(others, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    least = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labels = persist(member.join(least, "component").select(
        "node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "cap-labels")
    alone = rows.where("node IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.where("node IS NOT NULL").join(labels, "node").select("id", "n_links", "component_id")
    return alone.unionByName(linked).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
