"""A corpus pipeline of five stages over ``documents``.

Each stage reads what the one before it wrote. All but the last return the columns
of ``documents``; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import line_dedup, minhash, packing, secret_scan, toxicity
from ledgerlake.llm.common import cut, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    models = toxicity.fit_labels(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_probabilities(docs.select(*COLUMNS), models)
    return scored.filter(F.col(f"__p_{toxicity.CHAIN[-1]}") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay only where they come first; every document stays."""
    return _documents(line_dedup.line_dedup(docs.select(*COLUMNS)))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest doc_id stays."""
    found = cut(minhash.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct(), "dropped")
    return docs.select(*COLUMNS).join(found, "doc_id", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in any layer of a text are replaced by a mark; every document stays."""
    return _documents(secret_scan.redact(docs.select(*COLUMNS)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: The first and the last stage can't be expressed in SQL; the tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each one's result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
