"""Conversation structure repair by depth-first branch and bound.

Every row of a conversation is kept, given another role or deleted, and empty
rows may be inserted, until the roles read ``(s?(ua)+)?``. The search has an
explicit stack, a lower bound for every suffix, an incumbent (cost, audit) and a
dominance table for every node; it ends when nothing on the stack can beat the
incumbent. Long conversations are searched piece by piece for every role that
may stand before and after a piece, and the pieces are joined by least cost."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tessera.llm.common import persist, small_batches

BLANK_CLASS = r"[^\x20\x09-\x0D]"
LEGAL = ("su", "ua", "au")

# What has been emitted last. A conversation may end where nothing was, or after an assistant.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
ENDS = (START, AFTER_ASSISTANT)
NEXT = {(START, "s"): AFTER_SYSTEM, (START, "u"): AFTER_USER, (AFTER_SYSTEM, "u"): AFTER_USER,
        (AFTER_USER, "a"): AFTER_ASSISTANT, (AFTER_ASSISTANT, "u"): AFTER_USER}
TURN_OF = {START: "u", AFTER_SYSTEM: "u", AFTER_USER: "a", AFTER_ASSISTANT: "u"}   # the user or assistant row that may follow
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
PIECE = 48              # rows searched at once

Item = tuple[str, bool, bool]            # initial of the role, must be deleted, is truncated
Found = tuple[int, str]


# ---------------------------------------------------------------- the search
def search(rows: list[Item], entry: int = START, exits: tuple[int, ...] = ENDS) -> Found | None:
    """The cheapest ``(cost, audit)`` from state ``entry`` over ``rows`` to one of
    ``exits``; ties go to the least audit. None if there is no way.

    Two prefixes that lead to one node with equal cost are never prefixes of one
    another (the rest would be insertions, which cost), so the lesser prefix stays
    the lesser whatever follows: the dominance table may compare audits.
    """
    n = len(rows)
    bound = [0] * (n + 1)                # least cost of the rows from i on, whatever the roles
    for i in range(n - 1, -1, -1):
        bound[i] = bound[i + 1] + (DELETE if rows[i][1] else TRUNCATED if rows[i][2] else 0)
    best: Found | None = None
    seen: dict[tuple[int, int], Found] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if best is not None and cost + bound[i] > best[0]:
            continue
        if (known := seen.get((i, state))) is not None and known <= (cost, audit):
            continue
        seen[i, state] = cost, audit
        if i == n and state in exits and (best is None or (cost, audit) < best):
            best = cost, audit
        turn = TURN_OF[state]
        moves = [(i, NEXT[state, turn], cost + INSERT, audit + "I")]
        if i < n:
            initial, doomed, truncated = rows[i]
            moves.append((i + 1, state, cost + DELETE, audit + "D"))
            if not doomed:
                more = TRUNCATED if truncated else 0
                moves.append((i + 1, NEXT[state, turn], cost + REROLE + more, audit + "R"))
                if (state, initial) in NEXT:
                    moves.append((i + 1, NEXT[state, initial], cost + more, audit + "K"))
        # an insertion never leads back: two in a row reach a node that is already cheaper
        stack.extend(sorted(moves, key=lambda m: -m[2] - bound[m[0]]))   # the most promising comes off first
    return best


Pieces = dict[tuple[int, int], Found]


def piece(rows: list[Item], entries: tuple[int, ...], exits: tuple[int, ...]) -> Pieces:
    """The best ``(cost, audit)`` for every entry and exit that a way joins."""
    return {(a, b): got for a in entries for b in exits if (got := search(rows, a, (b,))) is not None}


def join_pieces(left: Pieces, right: Pieces) -> Pieces:
    found: Pieces = {}
    for (a, m), (cost, audit) in left.items():
        for (k, b), (more, rest) in right.items():
            if m == k and ((a, b) not in found or (cost + more, audit + rest) < found[a, b]):
                found[a, b] = cost + more, audit + rest
    return found


def repair(rows: list[Item]) -> Found:
    """The cheapest repair of a whole conversation."""
    if len(rows) <= PIECE:
        return search(rows)
    whole = piece(rows[:PIECE], (START,), tuple(range(4)))
    for at in range(PIECE, len(rows), PIECE):
        whole = join_pieces(whole, piece(rows[at: at + PIECE], tuple(range(4)), tuple(range(4))))
    return min(whole[START, b] for b in ENDS if (START, b) in whole)


# --------------------------------------------------------------------- damage
def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` after damage by
    ``crc32(conv_id:turn) % 20``: 0 drops a row, 1 empties its text, 2 takes
    ``[.!?]`` out of it, 3 repeats it, 4 makes its role user. Null roles and texts,
    and null ids and turns in the hash, are one space."""
    how = F.crc32(F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn"))).cast("binary")) % 20
    text = _or_space(F.col("text"))
    rows = conversations.select("conv_id", "turn", _or_space(F.col("role")).alias("role"), text.alias("text"), how.alias("how"))
    return rows.where("how <> 0").select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("how") == 3, 2).otherwise(1).alias("copies"))


def _text_key(text: str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


ORDER = ("known", "turn", "role", "text_key")


def faults(rows: DataFrame) -> DataFrame:
    """The distinct rows of :func:`damaged` without their texts: ``conv_id, known
    (turn is not null), turn, role, text_key, copies, blank, repeats (an earlier
    turn has this role and text), cut``."""
    last = F.regexp_extract("text", rf"({BLANK_CLASS})[\x20\x09-\x0D]*\z", 1)
    slim = rows.select("conv_id", F.col("turn").isNotNull().alias("known"), "turn", "role", _text_key("text").alias("text_key"),
                       "copies", (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("cut"))
    one = persist(slim.groupBy("conv_id", "known", "turn", "role", "text_key")
                  .agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut")), "turns")
    first = (one.groupBy("conv_id", "role", "text_key").agg(F.min(F.struct("known", "turn")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_key").alias("k"), "first"))
    first = persist(first, "turns-said-again")
    said = one.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_key") == F.col("k")), "left")
    return said.select("conv_id", "known", "turn", "role", "text_key", "copies", "blank", "cut",
                       (F.col("first").isNotNull() & ~F.struct("known", "turn").eqNullSafe(F.col("first"))).alias("repeats"))


# ---------------------------------------------------------------------- tasks
PART = StructType([StructField("conv_id", StringType()), StructField("part", IntegerType()), StructField("entry", IntegerType()),
                   StructField("exit", IntegerType()), StructField("cost", LongType()), StructField("audit", StringType()),
                   StructField("first", StringType()), StructField("last", StringType()), StructField("illegal", LongType()),
                   StructField("whole", IntegerType())])


class _Run:
    """The rows of one conversation that stand in one partition."""

    def __init__(self, key, part: int, entries: tuple[int, ...]):
        self.key, self.part, self.entries = key, part, entries
        self.rows: list[Item] = []
        self.done: Pieces | None = None
        self.first = self.last = None
        self.illegal = 0

    def add(self, initial: str, doomed: bool, truncated: bool) -> None:
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if len(self.rows) == PIECE:
            self._search(tuple(range(4)))
        self.rows.append((initial, doomed, truncated))

    def _search(self, exits: tuple[int, ...]) -> None:
        part = piece(self.rows, self.entries if self.done is None else tuple(range(4)), exits)
        self.done, self.rows = part if self.done is None else join_pieces(self.done, part), []

    def results(self, whole: bool) -> Iterator[tuple]:
        if whole and self.done is None:  # nearly always: one search
            cost, audit = search(self.rows)
            yield self.key, self.part, START, START, cost, audit, self.first, self.last, self.illegal, 1
            return
        self._search(ENDS if whole else tuple(range(4)))
        if whole:
            cost, audit = min(got for (a, b), got in self.done.items() if a == START)
            yield self.key, self.part, START, START, cost, audit, self.first, self.last, self.illegal, 1
            return
        for (a, b), (cost, audit) in self.done.items():
            yield self.key, self.part, a, b, cost, audit, self.first, self.last, self.illegal, 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Searches the conversations of one partition of rows in order. Only its first
    and last may reach into another partition."""
    schema = pa.schema([("conv_id", pa.string()), ("part", pa.int32()), ("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                        ("audit", pa.string()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()), ("whole", pa.int32())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    run, first = None, True
    for b in batches:
        out: list[tuple] = []
        for key, part, initial, copies, blank, cut, repeats in zip(*[c.to_pylist() for c in b.columns]):
            if run is None or run.key != key:
                if run is not None:
                    out += run.results(whole=not first)
                    first = False
                run = _Run(key, part, tuple(range(4)) if first else (START,))
            for i in range(copies):  # equal rows of one turn stand together; the later ones are duplicates
                doomed = blank or repeats or i > 0
                run.add(initial, doomed, cut and not doomed)
        if out:
            yield batch(out)
    if run is not None:
        yield batch(list(run.results(whole=False)))


def _stitched(parts: DataFrame) -> DataFrame:
    """Joins the runs of conversations at the borders of partitions: at most two
    runs a partition, so a conversation has no more than there are partitions."""
    names = [f.name for f in PART]

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*[table.column(c).to_pylist() for c in names]), key=lambda r: r[1])
        done, last, illegal = None, None, 0
        for part in dict.fromkeys(r[1] for r in rows):
            mine = [r for r in rows if r[1] == part]
            ways = {(r[2], r[3]): (r[4], r[5]) for r in mine}
            illegal += mine[0][8] + (last is not None and last + mine[0][6] not in LEGAL)
            last = mine[0][7]
            done = ways if done is None else join_pieces(done, ways)
        cost, audit = min(done[START, b] for b in ENDS if (START, b) in done)
        return pa.table({"conv_id": pa.array([rows[0][0]], pa.string()), "cost": [cost], "audit": [audit], "illegal": [illegal]})

    return parts.groupBy("conv_id").applyInArrow(join, "conv_id string, cost long, audit string, illegal long")


def plans(marked: DataFrame) -> DataFrame:
    """``(conv_id, cost, audit, illegal)`` per conversation of the :func:`faults`
    (its id as text)."""
    n_parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", *ORDER]
    dealt = marked.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    runs = dealt.select(F.col("conv_id").cast("string"), F.spark_partition_id().alias("part"), F.substring("role", 1, 1).alias("initial"),
                        "copies", "blank", "cut", "repeats").mapInArrow(_runs, PART)
    runs = persist(runs, "conversation-runs")
    cols = ("conv_id", "cost", "audit", "illegal")
    return runs.where("whole = 1").select(*cols).unionByName(_stitched(runs.where("whole = 0")).select(*cols))


REPAIRED = StructType([StructField("conv_id", StringType()), StructField("repaired_sha256", StringType())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows every conversation's audit over its rows in order, row by row."""
    key, ops, at, state, sha, any_yet = None, None, 0, START, None, False
    out: list[tuple] = []

    def emit(role: str, text: str) -> None:
        nonlocal any_yet
        sha.update((("\n" if any_yet else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        any_yet = True

    def inserted() -> None:
        nonlocal at, state
        while at < len(ops) and ops[at] == "I":
            turn = TURN_OF[state]
            emit("user" if turn == "u" else "assistant", "")
            state, at = NEXT[state, turn], at + 1

    def close() -> None:
        inserted()
        out.append((key, sha.hexdigest()))

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_pydict({"conv_id": pa.array([r[0] for r in out], pa.string()),
                                           "repaired_sha256": [r[1] for r in out]})
        out.clear()
        return rows

    for b in batches:
        for conv, audit, copies, role, text in zip(*[c.to_pylist() for c in b.columns]):
            if audit is not None:  # the first row of a conversation
                if ops is not None:
                    close()
                key, ops, at, state, sha, any_yet = conv, audit, 0, START, hashlib.sha256(), False
                continue
            for _ in range(copies):
                inserted()
                op, at = ops[at], at + 1
                if op == "D":
                    continue
                turn = TURN_OF[state] if op == "R" else role[:1]
                emit({"u": "user", "a": "assistant"}[turn] if op == "R" else role, text)
                state = NEXT[state, turn]
        if out:
            yield flush()
    if ops is not None:
        close()
        yield flush()


def repaired_digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: the digest of the repaired ``role:text`` lines.
    A digest runs over one conversation in order, so a conversation's rows pass one
    task as a sorted stream; the task holds its audit and one batch."""
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.select(F.col("conv_id").cast("string").alias("conv_id"), F.lit(None).cast("string").alias("audit"), "copies", "role", "text",
                        F.lit(1).alias("kind"), F.col("turn").isNotNull().alias("known"), "turn", _text_key("text").alias("text_key"))
    heads = planned.select("conv_id", "audit", F.lit(0).alias("copies"), F.lit("").alias("role"), F.lit("").alias("text"),
                           F.lit(0).alias("kind"), F.lit(False).alias("known"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                           F.lit(b"").alias("text_key"))
    dealt = heads.unionByName(texts).repartition(n_parts, "conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
    return small_batches(dealt.select("conv_id", "audit", "copies", "role", "text")).mapInArrow(_digests, REPAIRED)


def repair_conversations(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct ``conv_id`` of ``ids``, after the cheapest repair of
    ``rows(conv_id, turn, role, text, copies)``: ``conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256``.

    Rows go by turn, nulls first; within a turn by role and text hash, equal rows
    together. A row's first fault counts: blank, duplicate (role and text seen
    before), truncated (last character no ``[.!?]``). A null id is a conversation
    of its own. Conversations without rows, and empty tables, have zeros, an
    empty audit and the digest of the empty string.

    Counts combine before the shuffle. The rows without texts are dealt by ranges of
    (id, turn), so a conversation of any length is searched in many tasks; only the
    digest of its texts, which is one sequence, passes a single task as a stream.
    """
    marked = persist(faults(rows), "turns-marked")
    clean = F.when(F.col("blank") | F.col("repeats"), 0).otherwise(1)
    counted = marked.groupBy("conv_id").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("copies") - clean)).alias("duplicate"),
        F.sum(F.when(F.col("cut"), clean).otherwise(0)).alias("truncated"))
    turns = (marked.where("known").select("conv_id", "turn").distinct().groupBy("conv_id")
             .agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    planned = persist(plans(marked), "conversation-plans")
    texts = repaired_digests(rows, planned)
    found = planned.join(texts, planned.conv_id.eqNullSafe(texts.conv_id)).select(planned.conv_id, "cost", "audit", "illegal", "repaired_sha256")
    base = ids.select("conv_id").distinct().withColumn("__id", F.col("conv_id").cast("string"))

    def beside(df: DataFrame, other: DataFrame, cols: list[str], key: str) -> DataFrame:
        other = other.select(F.col("conv_id").alias("__other"), *cols)
        return df.join(other, F.col(key).eqNullSafe(F.col("__other")), "left").drop("__other")

    whole = beside(beside(beside(base, counted, ["blank", "duplicate", "truncated"], "conv_id"), turns, ["gaps"], "conv_id"),
                   found, ["cost", "audit", "illegal", "repaired_sha256"], "__id")
    zero = F.lit(0).cast("long")
    return whole.select("conv_id", *[F.coalesce(F.col(c).cast("long"), zero).alias(c)
                                     for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
