"""Runs that can stop anywhere: input fingerprints, checkpoints, resumption, dead letters, handoff.

A checkpoint is a small JSON file, replaced by a rename. A run writes a folder per step and
then its checkpoint, so what is written beyond the checkpoint is of a step that
didn't end: it isn't read, and the next run writes it again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.canonical import canonical_text
from ledgerlake.sources.jsonl import _hadoop

VERSION = 1


class CheckpointMismatch(ValueError):
    """The code of what doesn't fit is its first argument."""


def fingerprint(df: DataFrame, body: Column | str) -> str:
    """A digest of a table's rows that doesn't depend on their order or partitions: sha256 of
    their count and of the sums of the four quarters of their digests."""
    h = F.sha2(F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit("")), 256)
    lanes = [F.sum(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")) for i in range(4)]
    text = F.concat_ws(",", F.count("*").cast("string"), *[F.coalesce(x, F.lit(0)).cast("string") for x in lanes])
    return df.agg(F.sha2(text, 256).alias("f")).first().f


def save(spark: SparkSession, file: str, value: dict) -> None:
    """Write a checkpoint beside its place and rename it there."""
    fs, path = _hadoop(spark, file)
    staged = path(f"{file}.next")
    out = fs.create(staged, True)
    out.write(bytearray((canonical_text({**value, "checkpoint_version": VERSION}) + "\n").encode()))
    out.close()
    fs.delete(path(file), False)
    fs.rename(staged, path(file))


def _value(spark: SparkSession, file: str) -> dict | None:
    row = spark.read.text(file, wholetext=True).first()
    try:
        value = json.loads(row.value) if row else None
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def load(spark: SparkSession, file: str, **expected) -> dict | None:
    """The checkpoint, or None if there is none. It has to say what is ``expected``
    (dataset, seed, count, input), and its next_index lies within its count."""
    fs, path = _hadoop(spark, file)
    if not fs.exists(path(file)):
        # ``save`` was stopped: before its rename the new file is whole, before that it doesn't count
        if not fs.exists(path(f"{file}.next")) or _value(spark, f"{file}.next") is None:
            return None
        fs.rename(path(f"{file}.next"), path(file))
    value = _value(spark, file)
    if value is None:
        raise CheckpointMismatch("CHECKPOINT_INVALID")
    if value.get("checkpoint_version") != VERSION:
        raise CheckpointMismatch("CHECKPOINT_VERSION")
    for name, want in expected.items():
        if value.get(name) != want:
            raise CheckpointMismatch(f"CHECKPOINT_{name.upper()}")
    n, last = value.get("next_index"), value.get("count")
    if type(n) is not int or type(last) is not int or not 0 <= n <= last:
        raise CheckpointMismatch("CHECKPOINT_INDEX")
    return value


def once(spark: SparkSession, file: str, dataset: str, source: DataFrame, body: str, make: Callable[[DataFrame], None]) -> bool:
    """All or nothing: ``make`` runs unless a checkpoint says that it has, on this very input.
    Another input, or another dataset's checkpoint, is refused. True if it ran."""
    seen = fingerprint(source, body)
    if load(spark, file, dataset=dataset, input=seen):
        return False
    make(source)
    n = source.count()
    save(spark, file, {"dataset": dataset, "input": seen, "count": n, "next_index": n, "complete": True})
    return True


def run(spark: SparkSession, folder: str, dataset: str, seed: int, count: int, step: int, make: Callable[[int, int], DataFrame], most: int | None = None) -> int:
    """Make records 0 to ``count`` in steps (``make(start, end)``), from where the checkpoint is;
    at most ``most`` steps. The next index. Seed and count have to be the checkpoint's."""
    file = f"{folder}/checkpoint.json"
    at = load(spark, file, dataset=dataset, seed=seed, count=count)
    start, done = at["next_index"] if at else 0, 0
    while start < count and (most is None or done < most):
        end = min(start + step, count)
        make(start, end).write.mode("overwrite").parquet(f"{folder}/out/start={start:012d}")
        save(spark, file, {"dataset": dataset, "seed": seed, "count": count, "next_index": end})
        start, done = end, done + 1
    return start


def written(spark: SparkSession, folder: str) -> DataFrame:
    """What a run has finished: steps beyond the checkpoint aren't read."""
    at = load(spark, f"{folder}/checkpoint.json")
    rows = spark.read.parquet(f"{folder}/out")
    return rows.filter(F.col("start") < F.lit(at["next_index"] if at else 0)).drop("start")


def dead_letters(failed: DataFrame, payload: str, code: str, actions: dict[str, str], namespace: str) -> DataFrame:
    """``failed`` without its payload, and what a queue of dead letters says of it: dlq_id, input_digest, input_bytes,
    retryable, recovery_action, redacted. ``actions`` gives the codes that can be tried
    again their action; others wait for a person."""
    known = F.map_from_entries(F.array(*[F.struct(F.lit(c), F.lit(a)) for c, a in actions.items()])) if actions else F.lit(None).cast("map<string,string>")
    action = F.try_element_at(known, F.col(code))
    digest = F.sha2(F.coalesce(F.col(payload), F.lit("")), 256)
    out = failed.withColumn("input_digest", digest).withColumn("input_bytes", F.coalesce(F.octet_length(payload), F.lit(0)))
    out = out.withColumn("retryable", action.isNotNull()).withColumn("recovery_action", F.coalesce(action, F.lit("human_review"))).withColumn("redacted", F.lit(True))
    return out.withColumn("dlq_id", F.concat(F.lit(f"urn:{namespace}:dlq:sha256:"), F.sha2(F.concat_ws("\x1f", code, "input_digest"), 256))).drop(payload)


def handoff(steps: DataFrame) -> DataFrame:
    """What takes over a worker: its last checkpoint (worker, at, state, cursor, epoch), as worker,
    state, cursor, epoch, next_epoch, finished. One row per worker."""
    last = steps.groupBy("worker").agg(F.max_by(F.struct("state", "cursor", "epoch"), F.struct("at", "epoch", "cursor")).alias("s"))
    return last.select("worker", "s.state", "s.cursor", "s.epoch", (F.col("s.epoch") + 1).alias("next_epoch"), F.col("s.state").isin("completed", "failed", "cancelled").alias("finished"))


def set_path(state: Column, path: Column, value: Column) -> Column:
    """A flat state map<pointer, long> with ``value`` at ``path``; what lay below it is gone."""
    rest = F.map_filter(state, lambda k, v: (k != path) & ~F.startswith(k, F.concat(path, F.lit("/"))))
    return F.map_concat(rest, F.map_from_entries(F.array(F.struct(path, value.cast("long")))))


def increment_path(state: Column, path: Column, delta: Column) -> Column:
    """The same with ``delta`` added to what is there, or to 0."""
    return set_path(state, path, F.coalesce(F.try_element_at(state, path), F.lit(0)) + delta)
