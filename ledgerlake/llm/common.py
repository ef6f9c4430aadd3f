"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import ship

SHARED_DIR = "spark.checkpoint.dir"

#: A side of a join is broadcast only if it has at most so many narrow rows
#: (two longs or so each, some tens of MB); beyond it both sides are shuffled.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset (tests
    in one JVM) a temporary folder of this machine is used.
    """
    named = spark.sparkContext.getConf().get(SHARED_DIR) or spark.conf.get(SHARED_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"{SHARED_DIR} must name a folder that all executors share")
    made = getattr(shared_dir, "made", None)
    if made is None:
        made = shared_dir.made = "file://" + tempfile.mkdtemp(prefix="ledgerlake-")
    return made


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Lineage ends here: a lost executor costs a reread, not a recomputation, and
    values that depend on the partitioning (row numbers) stay as written.
    """
    path = f"{shared_dir(df.sparkSession)}/ledgerlake/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``rows`` rows.

    Call it on a written table: the count is then read from Parquet footers.
    Larger tables come back unhinted, so the join shuffles both sides and AQE
    splits its skewed partitions.
    """
    return F.broadcast(df) if df.count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks_for(n: int, per: int) -> int:
    """How many blocks of ``per`` hold ``n`` things, one at least."""
    return max(1, -(-n // per))


#: Rows that a Python function gets at once: what it makes of them is held in memory.
BATCH_ROWS = 1_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

Batches = Iterator[pa.RecordBatch]


def map_arrow(df: DataFrame, run: Callable[[Batches], Batches], schema) -> DataFrame:
    """``mapInArrow`` in small batches; a worker gives its memory back when a task ends.

    Workers live on for the next stages. Without this the allocators keep the peak of
    every stage that they have run, beside the JVM's heap. The session's Arrow batches
    are lowered to the same size if they are larger, as they are held outside the heap
    on one side and in the worker on the other.
    """
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        conf.set(ARROW_ROWS, str(BATCH_ROWS))

    def bounded(batches: Batches) -> Batches:
        yield from run(batch.slice(at, BATCH_ROWS) for batch in batches for at in range(0, batch.num_rows, BATCH_ROWS))
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return df.mapInArrow(bounded, schema)
