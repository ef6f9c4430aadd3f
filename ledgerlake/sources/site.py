"""The catalogue: its page (a small table as an HTML document) and its files."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def page(title: str, rows: DataFrame, columns: list[str], order: list[str], most: int = 10_000) -> str:
    """The sorted rows as a table; text is escaped, integers have thousands separators.

    A page is for a catalogue, not for data: more than ``most`` rows are refused.
    """
    found = rows.select(*columns).orderBy(*order).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError("too many rows for a page")
    show = lambda v: "" if v is None else f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else html.escape(str(v))
    cells = lambda tag, vs: "".join(f"<{tag}>{v}</{tag}>" for v in vs)
    body = "\n".join(f"<tr>{cells('td', map(show, r))}</tr>" for r in found)
    head = cells("th", map(html.escape, columns))
    return f'<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>{html.escape(title)}</title></head>\n<body><h1>{html.escape(title)}</h1>\n<table>\n<tr>{head}</tr>\n{body}\n</table></body></html>\n'


def run_manifest(records: DataFrame, line: str, order: list[str], dataset: str, seed: int) -> dict:
    """count, seed and the digest of a run's canonical lines in order."""
    from ledgerlake.operators.sharding import content_hash

    return {"count": records.count(), "datasetId": dataset, "seed": seed, "sha256": content_hash(records.withColumn("body", F.col(line)), *order)}


def catalogue(spark: SparkSession, folder: str, entries: str = "datasets") -> tuple[DataFrame, dict]:
    """(a row per entry of ``catalog.json``, what ``latest.json`` points at). Both are JSON files of one object."""
    whole = spark.read.option("multiLine", True)
    listed = whole.json(f"{folder}/catalog.json").select(F.explode(entries).alias("e")).select("e.*")
    return listed, whole.json(f"{folder}/latest.json").first().asDict(True)
