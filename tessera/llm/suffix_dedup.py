"""Suffix-array dedup: remove every byte covered by a string of ``length`` bytes
that also starts anywhere else, in the same text or another.

Two equal windows of ``length`` bytes choose the same anchor, the leftmost
k-gram of least hash inside them (winnowing), at the same offset. So windows
are compared only among texts that share an anchor. A stretch of windows that
chose one anchor is a segment; segments that are equal as a whole repeat as a
whole. Different segments around one anchor are told apart by sorting the
suffixes to the right and (reversed) to the left of the anchor: a mergesort
whose comparisons find common extensions by binary search over prefix
polynomial hashes, verified against the bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from tessera.llm.common import persist, text_or_empty

LENGTH = 400
#: k-gram lengths of the anchors, as shares of the window: the first for all
#: texts, the next ones for segments of anchors that too many share. The last
#: is the window itself, whose segments are single windows, so it always ends.
LEVELS = (0.32, 0.84, 1.0)
HOT_ANCHOR = 4000          # different segments around one anchor that are sorted together
BLOCK_SUFFIXES = 4096      # suffixes sorted in one go (whole anchors)
BLOCK_BYTES = 1 << 20      # bytes of a text that are scanned in one go
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)   # odd, so that powers can be undone modulo 2**64
UNDO = np.uint64(pow(int(BASE), -1, 1 << 64))
OUT_ROWS = 20_000


# ----------------------------------------------------------- prefix hashes
class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, BASE))))
                self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, UNDO))))
        return self.up, self.down


POWERS = Powers()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``h`` with h[j] - h[i], times base ** -i, the polynomial hash of data[i:j]."""
    up, _ = POWERS.get(len(data) + 1)
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])))


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


# ------------------------------------------------------------------ anchors
def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running least values of blocks."""
    n = len(key)
    padded = np.concatenate((key, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def choose_anchors(data: np.ndarray, length: int, k: int) -> np.ndarray:
    """For every window start of ``data`` the position of its anchor."""
    up, down = POWERS.get(len(data) + 1)
    h = prefix_hashes(data)
    with np.errstate(over="ignore"):
        grams = mixed((h[k:] - h[:-k]) * down[: len(h) - k])
    position = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << 21) - 1)  # room for positions of a block; the leftmost of equal hashes wins
    return (_sliding_least((grams & ~low) | position, length - k + 1) & low).astype(np.int64)


def segments(text: bytes, length: int, k: int) -> Iterator[tuple[int, int, int]]:
    """``(first window, windows, anchor)`` of the maximal runs of windows with one anchor."""
    n = len(text) - length + 1
    if n <= 0:
        return
    data = np.frombuffer(text, np.uint8)
    run = None  # a run may go on across the borders of blocks
    for at in range(0, n, BLOCK_BYTES):
        chosen = choose_anchors(data[at: at + BLOCK_BYTES + length - 1], length, k) + at
        starts = np.concatenate(([0], np.nonzero(np.diff(chosen))[0] + 1))
        sizes = np.diff(np.concatenate((starts, [len(chosen)])))
        for s, c, a in zip((starts + at).tolist(), sizes.tolist(), chosen[starts].tolist()):
            if run is not None and run[2] == a:
                run = (run[0], run[1] + c, a)
                continue
            if run is not None:
                yield run
            run = (s, c, a)
    yield run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# -------------------------------------------------------------- suffix sort
class Suffixes:
    """Suffixes of one buffer, each from ``start`` over ``size`` bytes at most,
    sorted inside their groups."""

    def __init__(self, buffer: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray):
        self.buffer, self.start, self.size, self.group = buffer, start, size, group
        self.hash = prefix_hashes(buffer)
        self.down = POWERS.get(len(buffer) + 1)[1]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes x and y by binary search on hashes."""
        a, b = self.start[x], self.start[y]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        h, down = self.hash, self.down
        with np.errstate(over="ignore"):
            while (low < high).any():
                mid = (low + high + 1) >> 1
                same = (h[a + mid] - h[a]) * down[a] == (h[b + mid] - h[b]) * down[b]
                low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffix x sorts before y, and whether they are equal; the end of a suffix sorts first."""
        n = self.common(x, y)
        ended_x, ended_y = n >= self.size[x], n >= self.size[y]
        last = len(self.buffer) - 1
        cx = np.where(ended_x, -1, self.buffer[np.minimum(self.start[x] + n, last)].astype(np.int64))
        cy = np.where(ended_y, -1, self.buffer[np.minimum(self.start[y] + n, last)].astype(np.int64))
        return cx < cy, cx == cy

    def sort(self) -> np.ndarray:
        """Order of the suffixes, groups together: bottom-up mergesort. In a
        round every suffix finds its rank in the run that its own is merged
        with, by binary search, all suffixes at once."""
        order = np.argsort(self.group, kind="stable")
        grouped = self.group[order]
        first = np.concatenate(([0], np.nonzero(np.diff(grouped))[0] + 1))
        count = np.diff(np.concatenate((first, [len(order)])))
        begin, many = np.repeat(first, count), np.repeat(count, count)
        place = np.arange(len(order)) - begin
        width = 1
        while width < count.max(initial=0):
            run = place // width
            odd = run % 2 == 1
            other = np.where(odd, run - 1, run + 1) * width
            live = np.nonzero(other < many)[0]
            low = np.zeros(len(live), np.int64)
            high = np.minimum(other[live] + width, many[live]) - other[live]
            base, mine = (begin + other)[live], order[live]
            while (open_ := np.nonzero(low < high)[0]).size:
                mid = (low[open_] + high[open_]) >> 1
                theirs = order[base[open_] + mid]
                before, equal = self.less(theirs, mine[open_])
                goes = before | (equal & odd[live][open_])  # ties keep the left run first
                low[open_] = np.where(goes, mid + 1, low[open_])
                high[open_] = np.where(goes, high[open_], mid)
            target = np.arange(len(order))
            pair = begin[live] + (run[live] // 2) * 2 * width
            target[live] = pair + (place - run * width)[live] + low
            merged = np.empty_like(order)
            merged[target] = order
            order = merged
            width *= 2
        return order

    def neighbours(self, order: np.ndarray) -> np.ndarray:
        """Common extension of each suffix with the one before it in ``order``; -1 where a group begins."""
        x, y = order[:-1], order[1:]
        n = np.where(self.group[x] == self.group[y], self.common(x, y), -1)
        return np.concatenate(([-1], n))

    def verified(self) -> tuple[np.ndarray, np.ndarray]:
        """Order and neighbours' common extensions, checked against the bytes.
        Where hashes collided, the group is sorted by its bytes instead."""
        order = self.sort()
        common = self.neighbours(order)
        if len(order) < 2:
            return order, common
        x, y, n = order[:-1], order[1:], np.maximum(common[1:], 0)
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        differ = self.buffer[self.start[x][owner] + step] != self.buffer[self.start[y][owner] + step]
        if differ.any():
            for g in np.unique(self.group[x[np.unique(owner[differ])]]):
                at = np.nonzero(self.group[order] == g)[0]
                raw = {int(i): self.buffer[self.start[i]: self.start[i] + self.size[i]].tobytes() for i in order[at]}
                order[at] = sorted(raw, key=raw.get)
                for before, here in zip(at[:-1], at[1:]):
                    a, b = raw[int(order[before])], raw[int(order[here])]
                    common[here] = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        return order, common


def repeated_windows(texts: list[bytes], anchor: np.ndarray, group: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For every segment the runs ``(first, last)`` of its windows that also
    occur in another segment of its group. A segment has len - length + 1
    windows, all of which contain its anchor."""
    size = np.array([len(t) for t in texts], np.int64)
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    right = Suffixes(buffer, begin + anchor, size - anchor, group).verified()
    back = buffer[::-1]
    left = Suffixes(back, len(buffer) - begin - anchor, anchor, group).verified()
    # per suffix: its place in either order; per place: common extension with the one before
    least, most = anchor - (size - length), anchor  # offsets of the anchor in the segment's windows
    ends: list[list[tuple[int, int]]] = [[] for _ in texts]
    opened = np.full(len(texts), -1, np.int64)
    ids_r, ids_l = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
    for offset in range(int(least.min(initial=0)), int(most.max(initial=-1)) + 2):
        ids_r[right[0]] = np.cumsum(right[1] < length - offset)
        ids_l[left[0]] = np.cumsum(left[1] < offset)
        inside = np.nonzero((least <= offset) & (offset <= most))[0]
        again = np.zeros(len(texts), bool)
        if len(inside):
            key = ids_r[inside] * (len(texts) + 1) + ids_l[inside]
            _, where, number = np.unique(key, return_inverse=True, return_counts=True)
            again[inside] = number[where] > 1
        for i in np.nonzero(again & (opened < 0))[0]:
            opened[i] = offset
        for i in np.nonzero(~again & (opened >= 0))[0]:
            # offsets opened .. offset - 1 are windows starting at anchor - offset
            ends[i].append((int(anchor[i] - offset + 1), int(anchor[i] - opened[i])))
            opened[i] = -1
    return ends


# -------------------------------------------------------------------- Spark
def _flush(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _scan(texts: DataFrame, length: int, k: int) -> DataFrame:
    """One row per segment: ``id, tkey, base, first, windows, anchor, gram, c1,
    c2``; ``gram`` names the anchor's k-gram, ``c1, c2`` the segment's bytes."""
    id_type = texts.schema["id"]
    schema = StructType([id_type, *[StructField(n, LongType()) for n in ("tkey", "base")],
                         *[StructField(n, IntegerType()) for n in ("first", "windows", "anchor")],
                         *[StructField(n, LongType()) for n in ("gram", "c1", "c2")]])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            which: list[int] = []
            def out():
                body = _flush(rows, [*[pa.int32()] * 3, *[pa.int64()] * 3], names[3:])
                key = b.select([0, 1, 2]).take(pa.array(which, pa.int64()))
                return pa.RecordBatch.from_arrays([*key.columns, *body.columns], names=names)
            for i, body in enumerate(b.column(3)):
                text = body.as_py() or b""
                for first, windows, anchor in segments(text, length, k):
                    whole = xxhash.xxh3_128_intdigest(text[first: first + windows - 1 + length])
                    rows.append((first, windows, anchor - first, _signed(xxhash.xxh3_64_intdigest(text[anchor: anchor + k])),
                                 _signed(whole >> 64), _signed(whole & (1 << 64) - 1)))
                    which.append(i)
                    if len(rows) >= OUT_ROWS:
                        yield out()
                        rows, which = [], []
            if rows:
                yield out()

    return texts.select("id", "tkey", "base", "body").mapInArrow(run, schema)


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT_ANCHOR, levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """``(id, tkey, start, end)``: byte spans of ``texts(id, tkey, base, body)``,
    shifted by ``base``, that repeated windows cover.

    Counts of anchors and of segments combine before they are shuffled.
    Segments that occur once around an anchor that others share are sorted in
    blocks of whole anchors; an anchor with more than ``hot`` different
    segments is not brought together at all, its segments go through this
    function again with longer anchors.
    """
    k = max(1, round(length * levels[0]))
    found = persist(_scan(texts, length, k), "suffix-segments")
    # written, so that the join's sides are plain shuffles: AQE can split a gram that very many share
    shared = persist(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "suffix-shared")
    hits = persist(found.join(shared, "gram", "left_semi"), "suffix-hits")
    kinds = persist(hits.groupBy("gram", "c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct(
        "tkey", "base", "first", "windows", "anchor", "id")).alias("m")), "suffix-kinds")
    whole = hits.join(kinds.where("n > 1").select("gram", "c1", "c2"), ["gram", "c1", "c2"])
    spans = whole.select("id", "tkey", (F.col("base") + F.col("first")).alias("start"),
                         (F.col("base") + F.col("first") + F.col("windows") - 1 + length).alias("end"))
    if k >= length:
        return spans  # segments are single windows
    mixed_up = persist(kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1"), "suffix-mixed")
    lone = kinds.join(mixed_up, "gram").select("m.id", "m.tkey", "m.base", "m.first", "m.windows", "m.anchor", "gram", "c1", "c2",
                                               (F.col("n") == 1).alias("alone"), "kinds")
    parts = persist(_segment_bytes(texts, lone, length), "suffix-parts")
    sorted_spans = _sorted_spans(parts.where(F.col("kinds") <= hot), length)
    spans = spans.unionByName(sorted_spans)
    crowded = parts.where(F.col("kinds") > hot)
    if not crowded.isEmpty():
        again = crowded.select("id", "tkey", (F.col("base") + F.col("first")).alias("base"), F.col("part").alias("body"))
        spans = spans.unionByName(repeated_spans(again, length, hot, levels[1:]))
    return spans


def _segment_bytes(texts: DataFrame, lone: DataFrame, length: int) -> DataFrame:
    """``lone`` segments with their bytes: texts meet the list of their segments."""
    packed = lone.groupBy("id", "tkey", "base").agg(F.collect_list(F.struct(
        "first", "windows", "anchor", "gram", "alone", "kinds")).alias("parts"))
    packed = persist(packed.withColumnsRenamed({"id": "w_id", "tkey": "w_tkey", "base": "w_base"}), "suffix-wanted")
    joined = texts.join(packed, (F.col("tkey") == F.col("w_tkey")) & (F.col("base") == F.col("w_base"))
                        & F.col("id").eqNullSafe(F.col("w_id")))
    piece = F.substring("body", F.col("p.first") + 1, F.col("p.windows") - 1 + length)
    return (joined.select("id", "tkey", "base", "body", F.explode("parts").alias("p"))
            .select("id", "tkey", "base", "p.*", piece.alias("part")))


def _sorted_spans(parts: DataFrame, length: int) -> DataFrame:
    """Spans of segments that share an anchor but differ, by suffix sorting."""
    schema = StructType([parts.schema["id"], *[StructField(n, LongType()) for n in ("tkey", "start", "end")]])
    rows = (parts.select("gram", "part", "anchor", "alone", "id", "tkey", (F.col("base") + F.col("first")).alias("at"))
            .repartition("gram").sortWithinPartitions("gram"))

    def spans(t: pa.Table) -> pa.RecordBatch:
        gram = t.column("gram").to_numpy()
        group = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1])))
        runs = repeated_windows(t.column("part").to_pylist(), t.column("anchor").to_numpy().astype(np.int64), group, length)
        alone = t.column("alone").to_numpy()
        which = [i for i, r in enumerate(runs) if alone[i] for _ in r]  # others repeat as a whole anyway
        pairs = [p for i, r in enumerate(runs) if alone[i] for p in r]
        key = t.select(["id", "tkey"]).take(pa.array(which, pa.int64()))
        at = t.column("at").to_numpy()[which] if which else np.zeros(0, np.int64)
        first = np.array([p[0] for p in pairs], np.int64)
        last = np.array([p[1] for p in pairs], np.int64)
        return pa.RecordBatch.from_arrays([key.column(0).combine_chunks(), key.column(1).combine_chunks(), pa.array(at + first),
                                           pa.array(at + last + length)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows >= BLOCK_SUFFIXES:
                gram = held.column("gram").to_numpy()
                borders = np.nonzero(gram[1:] != gram[:-1])[0] + 1
                borders = borders[borders <= max(BLOCK_SUFFIXES, borders[0])] if len(borders) else borders
                if not len(borders):
                    break  # one anchor so far; its size is bounded
                yield spans(held.slice(0, int(borders[-1])).combine_chunks())
                held = held.slice(int(borders[-1]))
        if held is not None and held.num_rows:
            gram = held.column("gram").to_numpy()
            yield spans(held.combine_chunks())

    return rows.mapInArrow(run, schema)


def remove_spans(body: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """``body`` without the union of ``spans``, and how many maximal runs that union has."""
    kept, at, runs = [], 0, 0
    for start, end in sorted(spans):
        if start > at or (start == 0 and not runs):
            runs += 1
            kept.append(body[at:start])
        at = max(at, end)
    return b"".join(kept) + body[at:], runs


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 hot: int = HOT_ANCHOR) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, n_spans`` and ``kept``,
    the remaining bytes of its UTF-8 text.

    A byte goes if a string of ``length`` bytes covers it that also starts
    anywhere else; overlaps count, and strings are judged on the input. Null is
    the empty text; texts shorter than ``length`` stay whole. Repeated rows
    repeat each other, so both go whole if they are long enough. A null id is
    an id like others; rows are told apart by id and text. Empty tables give
    no rows. Other columns play no part. A text of any length is scanned in
    blocks, and only its own segments ever meet in one row.
    """
    body = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("tkey"), F.lit(0).cast("long").alias("base"),
                        body.cast("binary").alias("body"))
    spans = repeated_spans(texts, length, hot)
    spans = spans.distinct().groupBy("id", "tkey").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    spans = persist(spans.withColumnsRenamed({"id": "s_id", "tkey": "s_tkey"}), "suffix-spans")
    joined = texts.join(spans, (F.col("tkey") == F.col("s_tkey")) & F.col("id").eqNullSafe(F.col("s_id")), "left").select(
        "id", "body", "spans")
    schema = StructType([joined.schema["id"], *[StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
                         StructField("kept", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held, at = [], 0, 0
            for i, (text, cut) in enumerate(zip(b.column(1), b.column(2), strict=True)):
                whole = text.as_py()
                kept, runs = remove_spans(whole, [(c["start"], c["end"]) for c in cut.as_py() or []])
                rows.append((len(whole), len(whole) - len(kept), runs, kept))
                held += len(kept)
                if held >= 8 << 20 or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(rows)), *_flush(
                        rows, [pa.int64(), pa.int64(), pa.int64(), pa.binary()], schema.names[1:]).columns], names=schema.names)
                    rows, held, at = [], 0, i + 1

    return joined.mapInArrow(run, schema)
