"""Session helpers: a configured session, tables, and lineage cuts in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARED_DIR = "spark.checkpoint.dir"
#: A side of a join is broadcast only if it is counted to have at most so many rows.
BROADCAST_ROWS = 100_000


def session(app: str = "ledgerlake", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides (dots as __)."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: Python functions are
    loaded there by name, and it needn't be installed on their machines."""
    sc = spark.sparkContext
    if getattr(sc, "ledgerlake_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if not root.is_dir():  # imported from an archive that has been sent already
        return
    path = Path(tempfile.mkdtemp(prefix="ledgerlake-")) / "ledgerlake.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc.ledgerlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a single JVM."""
    named = spark.sparkContext.getConf().get(SHARED_DIR) or spark.conf.get(SHARED_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"{SHARED_DIR} must name a folder that all executors share")
    if "dir" not in _made:
        _made["dir"] = "file://" + tempfile.mkdtemp(prefix="ledgerlake-")
    return _made["dir"]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage."""
    path = f"{shared_dir(df.sparkSession)}/ledgerlake/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a written table that is counted to be small, else none."""
    return F.broadcast(df) if df.count() <= rows else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row. An expression that is merely
    used inside a lambda would be computed again for every element."""
    return F.transform(F.array(value), body)[0]


Query = Callable[[SparkSession, str], DataFrame]
