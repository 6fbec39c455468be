"""STR-3 as keyed state: data files that wait for a row that refers to them.

Every file is reported when something becomes of it: ``pending`` as it arrives
without a reference, ``published`` with the first reference inside its hold
period, ``expired`` when event time has passed that period. The state of a key
is its waiting files and the references young enough to matter. Keys share
their state by buckets of their hash, as the way of a group into Python and
back costs more than its few rows; an event-time timer stands at the earliest
end of a hold period, so a bucket that nothing happens to is woken then, and
forgotten when nothing waits in it."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.streaming.watch import start

STATUS = "id long, status string"
BUCKETS = 4096          # fixed for the life of a checkpoint
_STATE = "file_keys array<string>, file_ids array<bigint>, file_ats array<bigint>, ref_keys array<string>, ref_ats array<bigint>"
_NEVER = -(1 << 63)     # the time of a file that has none


def _follow(hold_ms: int):
    def run(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        files, refs = [], defaultdict(list)
        if state.exists:
            held = [x or () for x in state.get]
            files = list(zip(*held[:3]))
            for key, at in zip(*held[3:]):
                refs[key].append(at)
        out: list[tuple[int, str]] = []
        known = {f[:2] for f in files}
        for b in () if state.hasTimedOut else batches:
            for key, is_file, ident, at in zip(*[b[c].tolist() for c in ("key", "is_file", "id", "at")]):
                if is_file:
                    files.append((key, ident, at))
                else:
                    refs[key].append(at)
        for times in refs.values():
            times.sort()
        now, waiting = state.getCurrentWatermarkMs(), []
        for key, ident, at in files:
            # nothing refers to a file without a key, or ends the wait of one without a time
            k = _first_from(refs[key], at) if key in refs and at != _NEVER else None
            if k is not None and k <= at + hold_ms:
                out.append((ident, "published"))
            elif at != _NEVER and at + hold_ms < now:
                out.append((ident, "expired"))
            else:
                if at != _NEVER:
                    waiting.append((key, ident, at))
                if (key, ident) not in known:
                    out.append((ident, "pending"))
        # a file may still come that is as old as the watermark
        young = [(key, r) for key, times in refs.items() for r in times if r >= now]
        if waiting or young:
            state.update((*_columns(waiting, 3), *_columns(young, 2)))
            ends = [at + hold_ms for _, _, at in waiting] + [r for _, r in young]
            state.setTimeoutTimestamp(max(min(ends), now + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["id", "status"])

    return run


def _columns(rows: list[tuple], width: int) -> list[list]:
    return [list(c) for c in zip(*rows)] or [[] for _ in range(width)]


def _first_from(times: list[int], at: int) -> int | None:
    k = bisect_left(times, at)
    return times[k] if k < len(times) else None


def follow_held_files(files: DataFrame, refs: DataFrame, key: str, hold: str, delay: str = "0 seconds",
                      clock: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The changes of status ``(id, status)`` of the streamed ``files(id, key, at)``, by
    streamed ``refs(key, at)`` of the same key (compared as text) at most ``hold``
    after them. Times are event times; events later than ``delay`` behind the
    newest are dropped. ``clock(at)`` are other events: they move event time and
    go no further, like references without a key. A file without a time stays
    pending."""
    hold_ms = int(pd.Timedelta(hold).total_seconds() * 1000)
    at, text, none = F.col("at").cast("timestamp").alias("when"), F.col(key).cast("string").alias("key"), F.lit(None)
    refers = F.when(F.col(key).isNotNull(), False).alias("is_file")
    both = (files.select(text, at, F.lit(True).alias("is_file"), F.col("id").cast("long").alias("id"))
            .unionByName(refs.select(text, at, refers, none.cast("long").alias("id"))))
    if clock is not None:
        both = both.unionByName(clock.select(none.cast("string").alias("key"), at, none.cast("boolean").alias("is_file"), none.cast("long").alias("id")))
    both = both.withWatermark("when", delay)
    # one condition that hangs on the event time: a filter that did not would be moved below the watermark
    ms = F.unix_millis("when")
    both = both.where(F.coalesce(ms >= F.when(F.col("is_file").isNull(), (1 << 63) - 1).otherwise(_NEVER), F.col("is_file")))
    both = both.withColumn("at", F.coalesce(ms, F.lit(_NEVER))).withColumn("id", F.coalesce("id", F.lit(-1)))
    spread = F.when(F.col("key").isNull(), F.xxhash64("id")).otherwise(F.xxhash64("key"))
    return (both.withColumn("bucket", F.pmod(spread, F.lit(buckets))).groupBy("bucket")
            .applyInPandasWithState(_follow(hold_ms), STATUS, _STATE, "update", GroupStateTimeout.EventTimeTimeout))


def run_held(changes: DataFrame, out: str, checkpoint: str, trigger="available"):
    """Writes the changes of every micro-batch under ``out``, numbered; a batch that is
    replayed overwrites itself."""
    def apply(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = start(changes.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint), trigger)
    if trigger == "available":
        q.awaitTermination()
    return q


def statuses(spark, out: str) -> DataFrame:
    """The last status of every file: one aggregate over the changes."""
    rank = F.when(F.col("status") == "pending", 0).otherwise(1)
    return (spark.read.parquet(out).groupBy("id")
            .agg(F.max_by("status", F.struct(F.col("batch"), rank.alias("rank"))).alias("status")))
