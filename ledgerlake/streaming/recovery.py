"""Streams that recover: ordered exactly-once application, idempotent sinks, leases.

Batch and stream give the same state: the stream holds back operations until their
sequence is next, and forgets nothing on restart, as state and offsets are in its
checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

APPLIED = "key string, sequence long, op_id string, state long"
_STATE = "next long, state long, sequences array<long>, deltas array<long>, ids array<string>"


def in_order(ops: DataFrame) -> DataFrame:
    """key, sequence, op_id and the state after it, for a stream of increments (key,
    sequence from 0, op_id, delta), however they are repeated and reordered.

    An operation waits in the key's state until all before it have come; one that comes
    again is ignored.
    """

    def apply(key: tuple, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        following, state, sequences, deltas, ids = held.get if held.exists else (0, 0, [], [], [])
        waiting = {s: (d, i) for s, d, i in zip(sequences, deltas, ids)}
        for batch in batches:
            for r in batch.itertuples():
                if r.sequence >= following:
                    waiting.setdefault(r.sequence, (r.delta, r.op_id))
        out = []
        while following in waiting:
            delta, op_id = waiting.pop(following)
            state += int(delta)
            out.append((key[0], following, op_id, state))
            following += 1
        left = sorted(waiting)
        held.update((following, state, [int(s) for s in left], [int(waiting[s][0]) for s in left], [waiting[s][1] for s in left]))
        yield pd.DataFrame(out, columns=["key", "sequence", "op_id", "state"])

    return ops.groupBy("key").applyInPandasWithState(apply, APPLIED, _STATE, "append", "NoTimeout")


def in_order_batch(ops: DataFrame) -> DataFrame:
    """The same for a table: deduplicated, and ending before the first gap."""
    once = ops.dropDuplicates(["key", "sequence"])
    w = Window.partitionBy("key").orderBy("sequence")
    n = once.withColumn("i", F.row_number().over(w) - 1).filter(F.col("i") == F.col("sequence"))
    return n.select("key", "sequence", "op_id", F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("state"))


def exactly_once(ops: DataFrame, time: str, late: str) -> DataFrame:
    """Each op_id once within the watermark: bounded state for endless streams."""
    return ops.withWatermark(time, late).dropDuplicatesWithinWatermark(["op_id"])


def windowed_counts(events: DataFrame, time: str, late: str, width: str, *by: str) -> DataFrame:
    """Counts by event-time window, final once the watermark has passed."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))


def idempotent(folder: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: a batch that is written again replaces itself."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    return write


def route(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters): the same input, split by whether there is a reason."""
    marked = df.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def lease_holders(leases: DataFrame) -> DataFrame:
    """resource, holder, epoch: the highest fencing epoch wins."""
    return leases.groupBy("resource").agg(F.max_by("holder", "epoch").alias("holder"), F.max("epoch").alias("epoch"))


def lease_findings(leases: DataFrame) -> DataFrame:
    """Leases (resource, epoch, granted_at) whose epoch doesn't rise over the one before."""
    before = F.lag("epoch").over(Window.partitionBy("resource").orderBy("granted_at"))
    return leases.withColumn("before", before).filter(F.col("before") >= F.col("epoch")).select("resource", "epoch", F.lit("LEASE_EPOCH").alias("code"))


def receipts(new: DataFrame, known: DataFrame) -> DataFrame:
    """What to do with operation receipts (batch_id, digest): apply, noop, or conflict."""
    old = known.select("batch_id", F.col("digest").alias("old"))
    action = F.when(F.col("old").isNull(), "apply").when(F.col("old") == F.col("digest"), "noop").otherwise("conflict")
    return new.join(old, "batch_id", "left").select("batch_id", "digest", action.alias("action"))


def checkpoint_findings(steps: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """Worker checkpoints (worker, at, state, cursor, epoch): transitions that aren't allowed,
    cursors that go back, and epochs that fall."""
    w = Window.partitionBy("worker").orderBy("at")
    before = F.lag(F.struct("state", "cursor", "epoch")).over(w)
    pairs = [F.lit(f"{a}>{b}") for a, bs in allowed.items() for b in bs]
    s = steps.withColumn("b", before).filter(F.col("b").isNotNull())
    step = F.concat(F.col("b.state"), F.lit(">"), F.col("state"))
    codes = F.array(
        F.when(~step.isin(*pairs), F.lit("STATE_TRANSITION")), F.when(F.col("b.cursor") > F.col("cursor"), F.lit("CURSOR_BACK")), F.when(F.col("b.epoch") > F.col("epoch"), F.lit("EPOCH_BACK"))
    )
    return s.select("worker", "at", F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code"))
