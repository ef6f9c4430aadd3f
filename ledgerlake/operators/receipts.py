"""Review receipts: what they may approve, what their evidence binds, and what depends on them.

Receipts and what they list are tables, a row per artifact, so that one with very many
is spread like any other. Every function returns findings (subject, code).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: what identifies an artifact, whoever lists it
RAW = ("path", "artifactKind", "mediaType", "bytes", "sha256")

# fixed values: what a receipt of each scope may approve
SCOPES = {
    "dataset-leaves": (
        "record-shard", "transcript-shard", "deliberation-shard", "provider-reasoning-shard", "data-card",
        "provider-terms", "review-evidence", "projection-recipe", "world-pack-source",
    ),
    "dataset-manifests": ("dataset-manifest",),
    "release": ("release-manifest", "active-review-set"),
    "catalog-pointer": ("catalog-release-pointer",),
}
APPROVES = "approve_public"
REASONING = "provider-reasoning-shard"


def raw_descriptor(df: DataFrame, *keep: str) -> DataFrame:
    """The five fields of descriptors that identify an artifact, and ``keep``."""
    return df.select(*keep, *RAW)


def _row(df: DataFrame, subject: str, code: str) -> DataFrame:
    return df.select(F.col(subject).alias("subject"), F.lit(code).alias("code"))


def _unsorted(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """Rows that don't come after the one before them."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy("pos"))
    return df.withColumn("before", before).filter(F.col("before").isNotNull() & ~(F.col("before") < value))


def receipt_findings(receipts: DataFrame, artifacts: DataFrame, evidence: DataFrame, signed: bool = False) -> DataFrame:
    """receipts: receipt, scope, disposition, predecessor, governed, signature (null if none).
    artifacts: receipt, pos and the five fields. evidence: receipt, check, pos, path, sha256.

    The scope permits every kind; lists are sorted and without repeats; evidence is an
    approved artifact; what is used approves; a receipt outside of the review set
    replaces none; signatures are refused unless ``signed``.
    """
    kinds = F.map_from_entries(F.array(*[F.struct(F.lit(s), F.array(*[F.lit(k) for k in ks])) for s, ks in SCOPES.items()]))
    allowed = F.coalesce(F.try_element_at(kinds, F.col("scope")), F.array().cast("array<string>"))
    scoped = artifacts.join(receipts.select("receipt", allowed.alias("allowed")), "receipt")
    out = _row(scoped.filter(~F.coalesce(F.array_contains("allowed", F.col("artifactKind")), F.lit(False))), "receipt", "RECEIPT_SCOPE")
    out = out.unionByName(_row(_unsorted(artifacts, ["receipt"], F.struct("path", "sha256")), "receipt", "ARTIFACT_ORDER"))
    out = out.unionByName(_row(_unsorted(evidence, ["receipt", "check"], F.struct("path", "sha256")), "receipt", "RECEIPT_EVIDENCE_ORDER"))
    out = out.unionByName(_row(evidence.join(artifacts, ["receipt", "path", "sha256"], "left_anti"), "receipt", "RECEIPT_EVIDENCE"))
    rules = {
        "RECEIPT_REJECT": ~F.col("disposition").eqNullSafe(F.lit(APPROVES)),
        "RECEIPT_PREDECESSOR_UNTRACKED": ~F.coalesce("governed", F.lit(False)) & F.col("predecessor").isNotNull(),
        "SIGNED_APPROVAL_NOT_ENABLED": F.col("signature").isNotNull() & F.lit(not signed),
    }
    codes = F.filter(F.array(*[F.when(bad, F.lit(c)) for c, bad in rules.items()]), lambda c: c.isNotNull())
    return out.unionByName(receipts.select(F.col("receipt").alias("subject"), F.explode(codes).alias("code"))).distinct()


def exact_closure(artifacts: DataFrame, references: DataFrame) -> DataFrame:
    """A receipt lists exactly the descriptors that name it, all five fields, repeats included."""
    cols = ["receipt", *RAW]
    a, b = artifacts.select(*cols), references.select(*cols)
    return _row(a.exceptAll(b).unionByName(b.exceptAll(a)), "receipt", "RECEIPT_ARTIFACT_CLOSURE").distinct()


def provider_findings(receipts: DataFrame, references: DataFrame, terms: DataFrame) -> DataFrame:
    """receipts: receipt, disposition, approved (null without a provider approval), terms (struct of
    the five fields or null). references: receipt and the five fields of what names it.
    terms: receipt and the five fields of the redistribution terms that reasoning under it names.

    Provider reasoning needs an approval whose terms are those, all of them, and are
    listed too; without reasoning there is none.
    """
    same = F.forall(F.array(*[F.col("terms")[c].eqNullSafe(F.col(c)) for c in RAW]), lambda ok: ok)
    given = receipts.select("receipt", "terms")
    seen = references.join(given, "receipt").groupBy("receipt").agg(F.bool_or(F.col("artifactKind") == REASONING).alias("reasoning"), F.bool_or(F.col("terms").isNotNull() & same).alias("listed"))
    named = terms.join(given, "receipt").groupBy("receipt").agg(F.bool_and(F.col("terms").isNotNull() & same).alias("exact"))
    j = receipts.join(seen, "receipt").join(named, "receipt", "left")
    fine = (F.col("disposition") == APPROVES) & F.col("approved") & F.col("terms").isNotNull() & F.col("listed") & F.col("exact")
    needs = F.coalesce("reasoning", F.lit(False))
    code = F.when(needs & ~F.coalesce(fine, F.lit(False)), "PROVIDER_APPROVAL").when(~needs & F.col("approved").isNotNull(), "PROVIDER_APPROVAL_UNNEEDED")
    return j.select(F.col("receipt").alias("subject"), code.alias("code")).filter(F.col("code").isNotNull())


def reasoning_closure(records: DataFrame, reasoning: DataFrame) -> DataFrame:
    """records: record_id, dataset_id, transcript_id, reasoning_id (null if it has none).
    reasoning: reasoning_id, record_id, dataset_id, transcript_id."""
    cols = ["reasoning_id", "record_id", "dataset_id", "transcript_id"]
    return _row(records.filter(F.col("reasoning_id").isNotNull()).join(reasoning.select(*cols), cols, "left_anti"), "record_id", "PROVIDER_REASONING_CLOSURE")


def dependency_findings(dependencies: DataFrame, artifacts: DataFrame, receipts: DataFrame) -> DataFrame:
    """dependencies: receipt and the five fields of descriptors nested in a batch's documents. Each has
    to be listed, just so, by the receipt it names, and that one has to approve."""
    approving = receipts.filter(F.col("disposition") == APPROVES).select("receipt")
    approved = artifacts.select("receipt", *RAW).join(approving, "receipt", "left_semi").distinct()
    left = dependencies.select("receipt", *RAW).distinct().join(approved, ["receipt", *RAW], "left_anti")
    return _row(left, "path", "BATCH_DEPENDENCY_REVIEW").distinct()


def anchored(releases: DataFrame, anchors: DataFrame) -> DataFrame:
    """releases: chain, release_id, sequence (from 1), previous_id, previous_sha256 (of the pointer before).
    anchors: chain, release_id, sequence, pointer_sha256 of the latest trusted release of a chain.

    A release extends the trusted one by one. A chain without an anchor may only begin;
    one with an anchor can't begin again.
    """
    a = anchors.select("chain", F.col("release_id").alias("a_id"), F.col("sequence").alias("a_seq"), F.col("pointer_sha256").alias("a_sha"))
    j = releases.join(a, "chain", "left")
    first, known = F.col("sequence") == 1, F.col("a_id").isNotNull()
    complete = F.col("previous_id").isNotNull() & F.col("previous_sha256").isNotNull()
    later = ~first & complete
    rules = {
        "PREVIOUS_RELEASE_REQUIRED": ~first & (~complete | (F.col("sequence") < 1)),
        "PREDECESSOR_ANCHOR_REQUIRED": later & ~known,
        "PREDECESSOR_ANCHOR_MISMATCH": later & known & (F.col("previous_sha256") != F.col("a_sha")),
        "PREDECESSOR_ANCHOR_ID": later & known & (F.col("previous_id") != F.col("a_id")),
        "RELEASE_ROLLBACK": (first & known) | (later & (F.col("sequence") <= F.col("a_seq"))),
        "RELEASE_FORK": later & (F.col("sequence") > F.col("a_seq") + 1),
    }
    codes = F.filter(F.array(*[F.when(bad, F.lit(c)) for c, bad in rules.items()]), lambda c: c.isNotNull())
    return j.select(F.col("release_id").alias("subject"), F.explode(codes).alias("code"))
