"""SimHash near-dedup: fingerprints, Hamming self-join by the general pigeonhole
principle, and connected components.

The join groups correlated bits into partitions, gives every partition its own
threshold (dynamic programming over estimated candidate counts), probes one
index per partition with all values inside that threshold, and verifies the
whole distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import connected_components, one_row_per, persist, small_batches, text_or_empty

BITS = 64
SEED = 42
PLAN_SAMPLE = 4000      # fingerprints looked at when planning; a bound on the plan, never on the join
HOT_BUCKET = 1024       # fingerprints in one bucket from which they are linked through hubs instead of pairs


# ------------------------------------------------------------- fingerprints
def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of the word shingles of ``text`` (signed)."""
    words = text.lower().split()  # on bytes: A-Z only, and white space is 0x20, 0x09-0x0D
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # blocks bound the unpacked bits of a very long text
        block = np.array(hashes[at: at + (1 << 16)], ">u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def text_key(text_col: str):
    return F.xxhash64(text_or_empty(text_col))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(id, text_key, fp)`` per row; ``text_key`` is a 64-bit hash of the text,
    which tells rows with a repeated id apart. Null and blank texts have
    fingerprint zero; a text of fewer words than ``shingle`` is one shingle."""
    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))
    schema = StructType([*rows.schema.fields[:2], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            fps = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             names=["id", "text_key", "fp"])

    return small_batches(rows).mapInArrow(run, schema)


# --------------------------------------------------------------------- plan
@dataclass(frozen=True)
class Partition:
    mask: int          # the bits of this partition
    threshold: int     # differing bits allowed inside it; -1: not used


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, each grown greedily by
    the bit most correlated with those it already has."""
    spread = np.unpackbits(sample.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1].astype(float)
    spread -= spread.mean(0)
    norm = np.sqrt((spread ** 2).sum(0))
    corr = np.abs(spread.T @ spread) / np.maximum(np.outer(norm, norm), 1e-12)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        inside = corr[np.ix_(sorted(left), sorted(left))].sum(0)
        group = [sorted(left)[int(inside.argmax())]]
        left.remove(group[0])
        while len(group) < size:
            rest = sorted(left)
            group.append(rest[int(corr[np.ix_(group, rest)].sum(0).argmax())])
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def candidate_rates(sample: np.ndarray, mask: int, most: int) -> list[float]:
    """For t in 0..most: the share of pairs that differ in at most t bits of
    ``mask``; sampled pairs, floored by independent bits where none was seen."""
    values = sample & np.uint64(mask)
    other = np.concatenate([values[np.arange(len(values)) - s] ^ values for s in (1, 7, 61, 509) if s < len(values)]
                           or [np.zeros(0, np.uint64)])
    seen = np.bincount(np.bitwise_count(other), minlength=most + 1) / max(len(other), 1)
    dist = np.array([1.0])
    for i in range(BITS):
        if mask >> i & 1:
            p = float(((values >> np.uint64(i)) & np.uint64(1)).mean()) if len(values) else 0.5
            differ = 2 * p * (1 - p)
            dist = np.convolve(dist, [1 - differ, differ])
    return [float(max(seen[: t + 1].sum(), dist[: t + 1].sum())) for t in range(most + 1)]


def plan_partitions(sample: np.ndarray, rows: int, distance: int) -> list[Partition]:
    """Partitions and thresholds of least estimated work for ``rows``
    fingerprints: sum(threshold + 1) = distance + 1, so every pair within
    ``distance`` is inside the threshold of one partition at least."""
    best: tuple[float, list[Partition]] | None = None
    rows = max(rows, 1)  # an empty table must not make all plans look alike
    for parts in range(1, distance + 2):
        groups = group_bits(sample, parts) if len(sample) > 1 else np.array_split(np.arange(BITS), parts)
        masks = [sum(1 << int(i) for i in g) for g in groups]
        costs = []
        for mask, g in zip(masks, groups, strict=True):
            rate = candidate_rates(sample, mask, distance)
            probes = [sum(comb(len(g), k) for k in range(t + 1)) for t in range(distance + 1)]
            # rows that probe, and pairs that are verified; a threshold of -1 costs nothing
            costs.append([0.0] + [2.0 * rows * p + rate[t] * rows * rows / 2 for t, p in enumerate(probes)])
        # table[s]: least cost of the partitions so far with sum(threshold + 1) = s
        table: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * (distance + 1)
        for cost in costs:
            table = [min(((table[s - u][0] + cost[u], table[s - u][1] + [u - 1]) for u in range(s + 1)),
                         key=lambda x: x[0]) for s in range(distance + 2)]
        total, thresholds = table[distance + 1]
        if best is None or total < best[0]:
            best = total, [Partition(m, t) for m, t in zip(masks, thresholds, strict=True) if t >= 0]
    return best[1]


# --------------------------------------------------------------------- join
def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(bits: list[int], radius: int):
    """The XOR masks of every change of at most ``radius`` of ``bits``, made in the
    tasks from the bits alone: a plan that spells thousands of masks out is
    sent to every task and kept by the driver."""
    one = "array(" + ",".join(f"CAST('{_signed(1 << b)}' AS BIGINT)" for b in bits) + ")"
    levels = ["array(0L)"]
    for k in range(1, min(radius, len(bits)) + 1):
        body = " | ".join(f"one[i{j}]" for j in range(k))
        for j in range(k - 1, -1, -1):
            first = f"i{j - 1} + 1" if j else "0"
            body = f"transform(sequence({first}, {len(bits) - k + j}), i{j} -> {body})"
            if j < k - 1:
                body = f"flatten({body})"
        levels.append(body)
    return F.expr(f"flatten(transform(array({one}), one -> flatten(array({', '.join(levels)}))))")


def _variants(part: Partition):
    return _flips([i for i in range(BITS) if part.mask >> i & 1], part.threshold)


def _hub_masks(radius: int):
    return _flips(list(range(BITS)), radius)


def hub_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links whose components equal those of all pairs within ``distance``,
    in rows linear in ``fps``: two fingerprints are that close exactly if some
    64-bit value lies within ``distance // 2`` of one and the rest of the other,
    so every fingerprint names the values around it and joins the least one there."""
    near, far = distance // 2, distance - distance // 2
    close = fps.select("fp", F.explode(_hub_masks(near)).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("hub"))
    least = close.groupBy("hub").agg(F.min("fp").alias("v"))
    around = close if far == near else fps.select("fp", F.explode(_hub_masks(far)).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("hub"))
    # both sides grow with the crowd: never built on the driver
    return around.join(least.hint("merge"), "hub").select(F.col("fp").alias("u"), "v").where("u <> v").distinct()


def close_pairs(fps: DataFrame, distance: int, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Edges ``(u, v)`` over distinct fingerprints ``fps(fp)``: every pair
    within ``distance``, except that fingerprints sharing a bucket of
    ``hot_bucket`` or more are linked through hubs, which gives the same
    components without the pairs of that bucket."""
    rows = fps.count()
    picked = fps.orderBy(F.xxhash64("fp")).limit(PLAN_SAMPLE).collect()
    parts = plan_partitions(np.array([r.fp for r in picked], np.int64).view(np.uint64), rows, distance)
    index = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(p.mask)).cast("long")).alias("value"))
        for i, p in enumerate(parts)])).alias("b")).select("fp", "b.part", "b.value")
    hot = persist(index.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") >= hot_bucket)
                  .select("part", "value", F.lit(True).alias("hot")), "simhash-hot")
    probes = index.select("fp", "part", F.explode(F.element_at(
        F.array(*[_variants(p) for p in parts]), F.col("part") + 1)).alias("mask"), F.col("value").alias("own"))
    probes = probes.select(F.col("fp").alias("u"), "part", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
    some_hot = not hot.isEmpty()
    cold = index.join(hot, ["part", "value"], "left_anti") if some_hot else index
    pairs = (probes.join(cold.withColumnRenamed("fp", "v").hint("merge"), ["part", "value"])
             .where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance))
             .select("u", "v").distinct())
    if not some_hot:
        return pairs
    crowd = index.join(hot, ["part", "value"], "left_semi").select("fp").union(
        probes.join(hot, ["part", "value"], "left_semi").select(F.col("u").alias("fp"))).distinct()
    return pairs.union(hub_links(persist(crowd, "simhash-crowd"), distance))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       distance: int = 4, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row per input row: ``id, text_key, fp``, ``component`` (its least
    fingerprint) and ``component_id``, the smallest id reachable over links of
    at most ``distance`` differing bits.

    Equal fingerprints (copies, and all texts without words) collapse to one
    node first, so a group of copies costs one row. Null ids rank above all
    others: ``component_id`` is null only where every id reachable is null.
    Repeated rows each come back. Empty tables give no rows. Other columns
    play no part. Long texts are hashed whole, in blocks.
    """
    prints = persist(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    nodes = persist(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-nodes")
    parts = persist(connected_components(close_pairs(nodes.select("fp"), distance, hot_bucket)), "simhash-parts")
    member = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labels = persist(member.join(least, "component").select("fp", "component", "component_id"), "simhash-labels")
    return prints.join(labels, "fp").select("id", "text_key", "fp", "component", "component_id")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                           distance: int = 4) -> DataFrame:
    """``docs`` with one row of every component, same columns: the smallest id;
    rows of that id go by the hash of their text, and rows equal in both
    collapse to the least by their other columns.

    Only components of several rows are looked at, and what they drop, usually
    little, is subtracted from ``docs`` by (id, text hash).
    """
    cols = docs.columns
    found = persist(simhash_components(docs, id_col, text_col, shingle, distance), "simhash-found")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    # written, so that AQE may split a component that very many rows share
    several = persist(found.groupBy("component").agg(F.count("*").alias("n"), F.min(order).alias("winner"))
                      .where("n > 1").select("component", "winner"), "simhash-several")
    wins = F.col("id").eqNullSafe(F.col("winner.id")) & (F.col("text_key") == F.col("winner.text_key"))
    actions = persist(found.join(several, "component").groupBy("id", "text_key")
                      .agg(F.max(wins).alias("wins"), F.count("*").alias("copies"))
                      .where("NOT wins OR copies > 1")
                      .select(F.col("id").alias("__id"), F.col("text_key").alias("__text_key"),
                              F.when(F.col("wins"), "one").otherwise("drop").alias("__action")), "simhash-actions")
    marked = docs.withColumn("__key", text_key(text_col)).join(
        actions, (F.col("__key") == F.col("__text_key")) & F.col(id_col).eqNullSafe(F.col("__id")), "left")
    plain = marked.where("__action IS NULL").select(*[f"`{c}`" for c in cols])
    if actions.where("__action = 'one'").isEmpty():
        return plain  # no row occurs twice with one id: the second pass over the texts would be for nothing
    tied = marked.where("__action = 'one'").select("__key", *[f"`{c}`" for c in cols])
    return plain.unionByName(one_row_per(tied, ["__key", id_col]).select(*[f"`{c}`" for c in cols]))
