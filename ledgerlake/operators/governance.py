"""Gates, rates and withdrawal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(metrics: DataFrame, by: list[str], least: dict[str, float] | None = None, most: dict[str, float] | None = None) -> DataFrame:
    """A row per metric: its value and whether it keeps its threshold; a missing value doesn't."""
    least, most = least or {}, most or {}

    def row(name: str, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))

    rows = [row(m, F.col(m) >= v) for m, v in least.items()] + [row(m, F.col(m) <= v) for m, v in most.items()]
    return metrics.select(*by, F.inline(F.array(*rows)))


def duplicate_rate(df: DataFrame, body: str) -> DataFrame:
    """records, distinct_records and the share of records that repeat another (0 if empty)."""
    n = df.groupBy(F.sha2(body, 256)).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("records"), F.count("*").alias("distinct_records"))
    return n.withColumn("duplicate_rate", F.coalesce(F.try_divide(F.col("records") - F.col("distinct_records"), F.col("records")), F.lit(0.0)))


def served(records: DataFrame, tombstones: DataFrame, key: str) -> DataFrame:
    """Records without those that a tombstone withdraws."""
    return records.join(tombstones.select(key), key, "left_anti")


def withdrawal_findings(tombstones: DataFrame, records: DataFrame, old_index: DataFrame, new_index: DataFrame, key: str) -> DataFrame:
    """(key, code): tombstones without a target, with another hash than the target's, or
    that the new removal index lacks; and entries of the old index that the new one lacks.

    ``tombstones`` and ``records`` have ``key`` and sha256; the indexes have ``key``.
    """
    t = tombstones.select(key, F.col("sha256").alias("claimed")).join(records.select(key, "sha256"), key, "left")
    target = F.when(F.col("sha256").isNull(), "WITHDRAWAL_TARGET").when(F.col("sha256") != F.col("claimed"), "WITHDRAWAL_HASH")
    out = t.select(key, target.alias("code")).filter(F.col("code").isNotNull())
    out = out.unionByName(tombstones.join(new_index, key, "left_anti").select(key, F.lit("REMOVAL_INDEX_COVERAGE").alias("code")))
    return out.unionByName(old_index.join(new_index, key, "left_anti").select(key, F.lit("REMOVAL_INDEX_APPEND_ONLY").alias("code")))


def is_prefix(old: Column, new: Column) -> Column:
    """An append-only list: the old one is the beginning of the new one."""
    return F.slice(new, F.lit(1), F.greatest(F.size(old), F.lit(0))).eqNullSafe(old)


def change_set_findings(changes: DataFrame, diff_bytes: int, max_files: int, max_diff_bytes: int, immutable: Column) -> DataFrame:
    """(path, code) for a change set (status, path, old_path): too many files, too large a
    diff, a path twice, and changes or deletions of immutable paths."""
    spark = changes.sparkSession
    limit = changes.agg(F.count_distinct("path").alias("n")).filter(F.col("n") > max_files).select(F.lit("").alias("path"), F.lit("PUBLICATION_FILE_LIMIT").alias("code"))
    twice = changes.groupBy("path").count().filter("count > 1").select("path", F.lit("PATH_DUPLICATE").alias("code"))
    frozen = changes.filter(immutable & ~F.col("status").startswith("A")).select("path", F.lit("RELEASE_IMMUTABLE").alias("code"))
    large = [("", "PR_DIFF_LIMIT")] if diff_bytes > max_diff_bytes else []
    return limit.unionByName(twice).unionByName(frozen).unionByName(spark.createDataFrame(large, "path string, code string"))
