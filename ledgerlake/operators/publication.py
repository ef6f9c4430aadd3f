"""Publication rules: what changes, manifests, records, cards and tombstones must state.

Documents are JSON text in a column, read as VARIANT; a rule is a column, so a table of
documents is judged in one pass over it. What documents refer to (files, stored objects)
is looked up by joins. The policy is configuration of a few kilobytes and becomes
literals. A finding has a path, a line and a code, never a value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.canonical import JsonRejected, canonical_text, strict_parse
from ledgerlake.functions.ids import is_utc_timestamp
from ledgerlake.functions.paths import is_safe_relative, matches_any
from ledgerlake.functions.scan import PATTERNS, has

# fixed values: shapes of identifiers and references, splits, roles, and the folders of stored objects by role
HEX40, HEX64, REFERENCE = r"\A[0-9a-f]{40}\z", r"\A[0-9a-f]{64}\z", r"\Asha256:[0-9a-f]{64}\z"
DATASET_ID = r"\Ad(?:0[1-9]|10)-[a-z0-9]+(?:-[a-z0-9]+)*\z"
REVIEWER_ID = r"\A[a-z0-9][a-z0-9._-]{2,63}\z"
SPLITS = ("train", "validation", "test", "unsplit")
ROLES = (
    "records", "visible-transcript", "public-deliberation", "provider-reasoning", "verifier",
    "data-card", "dataset-manifest", "release-manifest", "world-pack", "catalog-index",
)
STORES = {"records": "records", "transcripts": "visible-transcript", "deliberations": "public-deliberation", "reasoning": "provider-reasoning"}
OUTSIDE = ("url", "externalUrl", "downloadUrl", "corpusUrl")
SYNTHETIC = ("deterministic-synthetic", "model-generated-synthetic")
TOMBSTONES = "append-only-tombstone"
TRUST_LAYER = ("policies/", "schemas/v2/", "scripts/contracts/", "scripts/governance/")
NO_CODES = "array<string>"


@dataclass(frozen=True)
class Policy:
    """The policy documents, as parsed, and the namespace of URNs and schema names."""

    namespace: str
    publication: dict
    sources: dict
    rights: dict
    safety: dict
    quality: dict
    fields: dict
    withdrawal: dict

    @property
    def version(self) -> str:
        return self.publication["policyVersion"]

    def urn(self, kind: str) -> str:
        return rf"\Aurn:{self.namespace}:{kind}:sha256:[0-9a-f]{{64}}\z"


# -- values of a document


def _kind(doc: Column, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(doc, path, "variant")), F.lit("ABSENT"))


def _text(doc: Column, path: str = "$") -> Column:
    """A string; null if it is of another type or absent."""
    return F.when(_kind(doc, path) == "STRING", F.try_variant_get(doc, path, "string"))


def _number(doc: Column, path: str) -> Column:
    return F.when(_kind(doc, path).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(doc, path, "double"))


def _whole(doc: Column, path: str) -> Column:
    return F.when(_kind(doc, path) == "BIGINT", F.try_variant_get(doc, path, "long"))


def _is(doc: Column, path: str, value: bool) -> Column:
    return (_kind(doc, path) == "BOOLEAN") & (F.try_variant_get(doc, path, "boolean") == F.lit(value))


def _object(doc: Column, path: str = "$") -> Column:
    return _kind(doc, path).startswith("OBJECT")


def _items(doc: Column, path: str) -> Column:
    """array<variant>; null if it isn't an array."""
    return F.try_variant_get(doc, path, "array<variant>")


def _missing(doc: Column, path: str) -> Column:
    return _kind(doc, path).isin("ABSENT", "VOID")


def _broken(*rules: tuple[str, Column]) -> Column:
    """The codes of the rules that don't hold; null is not holding."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules]), lambda c: c.isNotNull())


def _under(code: str, holds: Column, codes: Column) -> Column:
    """``codes`` where ``holds``, else ``code`` alone: nothing below it can be judged."""
    return F.when(F.coalesce(holds, F.lit(False)), codes).otherwise(F.array(F.lit(code)))


def _named(values: list[str] | tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def member_digest(raw: Column | str, name: str) -> Column:
    """sha256 of the canonical text of an object's member ``name``; null if there is none."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(t: str | None) -> str | None:
            try:
                value = strict_parse(t, "policy") if t is not None else None
                return hashlib.sha256(canonical_text(value[name]).encode()).hexdigest() if isinstance(value, dict) and name in value else None
            except JsonRejected:
                return None

        for texts in batches:
            yield texts.map(one).astype(object)

    return run(raw)


# -- parts that several documents have


def label_codes(g: Column, policy: Policy) -> Column:
    labels, quality = _items(g, "$.safetyLabels"), policy.quality
    return _broken(
        ("PRIVACY_LABEL", _text(g, "$.privacy") == policy.safety["requiredPrivacyLabel"]),
        ("SAFETY_STATUS", _text(g, "$.safetyStatus") == policy.safety["requiredSafetyStatus"]),
        ("SAFETY_LABEL", (F.size(labels) > 0) & F.forall(labels, lambda x: F.coalesce(_text(x).isin(policy.safety["allowedSafetyLabels"]), F.lit(False)))),
        ("CONTAMINATION_LABEL", _text(g, "$.contamination.label").isin(quality["requiredContaminationLabels"])),
        ("PUBLIC_EXPOSURE_LABEL", _text(g, "$.publicExposure.label") == quality["requiredPublicExposureLabel"]),
        ("EVALUATION_USE_LABEL", _text(g, "$.evaluationUse") == quality["requiredEvaluationUseLabel"]),
    )


def quality_codes(doc: Column, path: str, policy: Policy) -> Column:
    limits = policy.quality["publicationThresholds"]
    metric = lambda name: _number(doc, f"{path}.metrics.{name}")
    rules = [("QUALITY_MINIMUM", metric(n) >= v) for n, v in limits["minimum"].items()] + [("QUALITY_MAXIMUM", metric(n) <= v) for n, v in limits["maximum"].items()]
    count = _broken(("QUALITY_RECORD_COUNT", _whole(doc, f"{path}.recordCount") >= limits["minimumRecordCount"]))
    return _under("QUALITY_REQUIRED", _object(doc, path), F.concat(count, _under("QUALITY_METRICS", _object(doc, f"{path}.metrics"), F.array_distinct(_broken(*rules)))))


def receipt_codes(doc: Column, path: str, dispositions: list[str], policy: Policy) -> Column:
    """An approval binds the document's candidate and public digests, is current, and by a known reviewer."""
    at = lambda name: _text(doc, f"{path}.{name}")
    bound = lambda name: F.to_json(F.try_variant_get(doc, f"{path}.{name}", "variant")).eqNullSafe(F.to_json(F.try_variant_get(doc, f"$.{name}", "variant")))
    return _under(
        "REVIEW_RECEIPT_REQUIRED",
        _object(doc, path),
        _broken(
            ("REVIEW_RECEIPT_CANDIDATE", bound("candidateSha256")),
            ("REVIEW_RECEIPT_PUBLIC", bound("publicArtifactSha256")),
            ("REVIEW_RECEIPT_POLICY", at("policyVersion") == policy.version),
            ("REVIEW_RECEIPT_DISPOSITION", at("disposition").isin(dispositions)),
            ("REVIEW_RECEIPT_REVIEWER", at("reviewer").rlike(REVIEWER_ID) & at("reviewer").isin(policy.publication["approvedReviewerIds"])),
            ("REVIEW_RECEIPT_TIME", is_utc_timestamp(at("reviewedAt"))),
            ("REVIEW_RECEIPT_SUPERSEDED", ~_is(doc, f"{path}.superseded", True)),
        ),
    )


def layer_codes(doc: Column, policy: Policy) -> Column:
    """Transcript and deliberation are included by reference; provider reasoning is absent, or approved with its terms."""
    p = "$.layers.providerExposedReasoning"
    included = lambda n: (_text(doc, f"$.layers.{n}.status") == "included") & _text(doc, f"$.layers.{n}.ref").rlike(REFERENCE)
    status, receipt = _text(doc, f"{p}.status"), f"{p}.approvalReceipt"
    absent = _broken(("PROVIDER_REASONING_ABSENT", _missing(doc, f"{p}.ref") & _missing(doc, receipt)))
    terms = _broken(("PROVIDER_TERMS", _is(doc, f"{receipt}.termsVerified", True)), ("PROVIDER_REDISTRIBUTION", _is(doc, f"{receipt}.redistributionPermitted", True)))
    approved = F.concat(
        _broken(("PROVIDER_REASONING_REF", _text(doc, f"{p}.ref").rlike(REFERENCE)), ("PROVIDER_REASONING_FORMAT", _text(doc, f"{p}.providerFormat") != "")),
        receipt_codes(doc, receipt, ["approve_public"], policy),
        F.when(_object(doc, receipt), terms).otherwise(F.array().cast(NO_CODES)),
    )
    provider = F.when(status == "not-provided", absent).when(status == "approved-public", approved).otherwise(F.array(F.lit("PROVIDER_REASONING_STATUS")))
    both = _broken(("REASONING_LAYER_REQUIRED", included("visibleTranscript") & included("publicDeliberation")))
    return _under("REASONING_LAYERS", _object(doc, "$.layers"), F.concat(both, _under("PROVIDER_REASONING_METADATA", _object(doc, p), provider)))


def _source_codes(s: Column, allowed: Column, policy: Policy) -> Column:
    kind = _text(s, "$.type")
    blobs, own, consent = _items(s, "$.blobs"), "$.ownershipAttestation", "$.consentReceipt"
    data = policy.publication["licenses"]["data"]
    blob = lambda b: F.coalesce(_object(b) & is_safe_relative(_text(b, "$.path"), normalised=False) & _text(b, "$.gitBlob").rlike(rf"{HEX40}|{HEX64}"), F.lit(False))
    synthetic = _broken(
        ("SOURCE_SYNTHETIC_ID", _text(s, "$.sourceId").startswith(f"urn:{policy.namespace}:synthetic:")), ("SOURCE_GENERATOR_COMMIT", _text(s, "$.generatorCommit").rlike(HEX40))
    )
    repository = _broken(
        ("SOURCE_REPOSITORY", _text(s, "$.repository").isin(policy.sources["allowedRepositories"])), ("SOURCE_COMMIT", _text(s, "$.commit").rlike(HEX40)),
        ("SOURCE_BLOBS", F.size(blobs) > 0), ("SOURCE_BLOB", F.coalesce(F.forall(blobs, blob), F.lit(True))),
    )
    attested = _is(s, f"{own}.attested", True) & (_text(s, f"{own}.license") == data) & is_utc_timestamp(_text(s, f"{own}.attestedAt")) & _text(s, f"{own}.attestedBy").rlike(REVIEWER_ID)
    agent = _broken(("SOURCE_AGENT", _text(s, "$.agentId") != ""), ("SOURCE_OWNERSHIP", attested))
    consented = _is(s, f"{consent}.publicDataConsent", True) & (_text(s, f"{consent}.license") == data) & is_utc_timestamp(_text(s, f"{consent}.consentedAt")) & _text(s, f"{consent}.receiptSha256").rlike(HEX64)
    own_rules = (
        F.when(kind.isin(*SYNTHETIC), synthetic)
        .when(kind == f"{policy.namespace}-repository", repository)
        .when(kind == "system-controlled-agent", agent)
        .when(kind == "consented-human-judgment", _broken(("SOURCE_CONSENT", consented)))
        .otherwise(F.array().cast(NO_CODES))
    )
    outside = ~_any([_kind(s, f"$.{k}") != "ABSENT" for k in OUTSIDE])
    judged = F.concat(_broken(("SOURCE_EXTERNAL", outside)), own_rules)
    return _under("SOURCE_INVALID", _object(s), _under("SOURCE_TYPE", F.array_contains(allowed, kind), judged))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def provenance_codes(doc: Column, path: str, policy: Policy, sources: str = "sources") -> Column:
    """The rights basis is allowed, its statement applies and is quoted, and each source keeps the rules of its type."""
    bases, statements = policy.sources["allowedRightsBases"], policy.rights["statements"]
    types = F.create_map(*[x for k, v in bases.items() for x in (F.lit(k), _named(v["sourceTypes"]))])
    stated = F.create_map(
        *[x for k, v in statements.items() for x in (F.lit(k), F.struct(F.lit(v["rightsBasis"]).alias("basis"), F.lit(v["statement"]).alias("text"), _named(v["sourceTypes"]).alias("types")))]
    )
    basis, items = _text(doc, f"{path}.rightsBasis"), _items(doc, f"{path}.{sources}")
    statement = F.try_element_at(stated, _text(doc, f"{path}.rightsStatementId"))
    allowed = F.array_intersect(F.try_element_at(types, basis), statement["types"])
    of_sources = _under("SOURCES_REQUIRED", F.size(items) > 0, F.flatten(F.transform(items, lambda s: _source_codes(s, allowed, policy))))
    quoted = _broken(("RIGHTS_STATEMENT_TEXT", _text(doc, f"{path}.rightsStatement") == statement["text"]))
    applies = _under("RIGHTS_STATEMENT", statement["basis"] == basis, F.concat(quoted, of_sources))
    return _under("PROVENANCE_REQUIRED", _object(doc, path), _under("SOURCE_RIGHTS_BASIS", basis.isin(*bases), applies))


def _unresolved(refs: DataFrame, objects: DataFrame) -> DataFrame:
    """Of ``refs`` (.., role, ref, code) those that no object (role, sha256) answers."""
    asked = refs.filter(F.col("ref").rlike(REFERENCE)).withColumn("sha256", F.substring("ref", 8, 64))
    return asked.join(objects.select("role", "sha256"), ["role", "sha256"], "left_anti")


# -- documents


def record_findings(records: DataFrame, objects: DataFrame, policy: Policy) -> DataFrame:
    """(path, line, code) for ``records`` (path, line, json) of the public-record contract, version 1.

    ``objects`` (role, sha256) are the stored transcripts, deliberations and provider
    reasoning that records may refer to. Text that isn't a JSON object is RECORD_OBJECT.
    """
    rows = records.select("path", "line", F.try_parse_json("json").alias("d"), member_digest("json", "payload").alias("payload"))
    d, quality = F.col("d"), policy.quality["recordThresholds"]
    claimed = _text(d, "$.integrity.payloadSha256")
    envelope = _broken(
        ("RECORD_FIELDS", ~_any([_kind(d, f"$.{name}") == "ABSENT" for name in policy.fields["requiredRecordSections"]])),
        ("RECORD_SCHEMA", _text(d, "$.schemaVersion") == f"{policy.namespace}.public-record/v1"),
        ("DATASET_ID", _text(d, "$.datasetId").rlike(DATASET_ID)),
        ("RECORD_TYPE", _text(d, "$.recordType") != ""),
        ("RECORD_ID", _text(d, "$.recordId").rlike(policy.urn("record"))),
        ("EPISODE_ID", _text(d, "$.episodeId") != ""),
        ("RECORD_SEQUENCE", _whole(d, "$.sequence") >= 0),
        ("RECORD_SPLIT", _text(d, "$.split").isin(*SPLITS)),
        ("RECORD_TIME", is_utc_timestamp(_text(d, "$.eventTime"))),
        ("RECORD_PAYLOAD", _object(d, "$.payload")),
    )
    provider = _kind(d, "$.generation.providerReasoningRef")
    absent = provider.isin("ABSENT", "VOID")
    approval = _text(d, "$.generation.providerReasoningApprovalReceiptRef").rlike(REFERENCE)
    generation = _broken(
        ("REASONING_LAYER_REQUIRED", _text(d, "$.generation.transcriptRef").rlike(REFERENCE) & _text(d, "$.generation.deliberationRef").rlike(REFERENCE)),
        ("PROVIDER_REASONING_REF", absent | F.coalesce(_text(d, "$.generation.providerReasoningRef").rlike(REFERENCE), F.lit(False))),
        ("PROVIDER_REASONING_APPROVAL", absent | F.coalesce(approval, F.lit(False)) | _object(d, "$.generation.providerReasoningApprovalReceipt")),
    )
    passed = (_text(d, "$.governance.quality.status") == quality["status"]) & _is(d, "$.governance.quality.verifierPassed", quality["verifierPassed"])
    governance = F.concat(
        _broken(
            ("LICENSE_METADATA", _text(d, "$.governance.license") == policy.publication["licenses"]["data"]),
            ("RECORD_QUALITY", passed & (_number(d, "$.governance.quality.score") >= quality["minimumScore"])),
        ),
        label_codes(F.try_variant_get(d, "$.governance", "variant"), policy),
    )
    integrity = _broken(
        ("PAYLOAD_HASH", claimed.rlike(HEX64) & (~_object(d, "$.payload") | (claimed == F.col("payload")))), ("RECORD_HASH", _text(d, "$.integrity.recordSha256").rlike(HEX64))
    )
    codes = F.concat(
        envelope,
        provenance_codes(d, "$.provenance", policy),
        _under("GENERATION_REQUIRED", _object(d, "$.generation"), generation),
        _under("GOVERNANCE_REQUIRED", _object(d, "$.governance"), governance),
        _under("INTEGRITY_REQUIRED", _object(d, "$.integrity"), integrity),
    )
    own = rows.select("path", "line", F.explode(F.array_distinct(_under("RECORD_OBJECT", _object(d), codes))).alias("code"))
    ref = lambda name, role, code: F.struct(F.lit(role).alias("role"), _text(d, f"$.generation.{name}").alias("ref"), F.lit(code).alias("code"))
    refs = F.array(
        ref("transcriptRef", "visible-transcript", "REASONING_LAYER_UNRESOLVED"),
        ref("deliberationRef", "public-deliberation", "REASONING_LAYER_UNRESOLVED"),
        ref("providerReasoningRef", "provider-reasoning", "PROVIDER_REASONING_UNRESOLVED"),
    )
    lost = _unresolved(records.select("path", "line", F.try_parse_json("json").alias("d")).select("path", "line", F.inline(refs)), objects)
    return own.unionByName(lost.select("path", "line", "code").distinct())


def _licensed(d: Column, policy: Policy) -> Column:
    both = policy.publication["licenses"]
    return F.to_json(F.try_variant_get(d, "$.licenses", "variant")) == canonical_text({k: both[k] for k in ("code", "data")})


def card_findings(cards: DataFrame, policy: Policy) -> DataFrame:
    """(path, code) for data ``cards`` (path, json)."""
    rows, d = cards.select("path", F.try_parse_json("json").alias("d")), F.col("d")
    quality = policy.quality
    layers = (_text(d, "$.reasoningLayers.visibleTranscript") == "included") & (_text(d, "$.reasoningLayers.publicDeliberation") == "included")
    safe = (_text(d, "$.privacyAndSafety.privacy") == policy.safety["requiredPrivacyLabel"]) & (_text(d, "$.privacyAndSafety.safetyStatus") == policy.safety["requiredSafetyStatus"])
    for flag in ("realPii", "secrets", "unownedContent"):
        safe = safe & _is(d, f"$.privacyAndSafety.{flag}", False)
    contamination = (
        _text(d, "$.contamination.label").isin(quality["requiredContaminationLabels"])
        & (_text(d, "$.contamination.publicExposure") == quality["requiredPublicExposureLabel"])
        & (_text(d, "$.contamination.evaluationUse") == quality["requiredEvaluationUseLabel"])
    )
    codes = F.concat(
        _broken(
            ("POLICY_VERSION", _text(d, "$.policyVersion") == policy.version),
            ("DATASET_ID", _text(d, "$.datasetId").rlike(DATASET_ID)),
            ("LICENSE_METADATA", _licensed(d, policy)),
            ("SOURCE_BOUNDARY", ~_object(d, "$.sources") | F.coalesce(_text(d, "$.sources.boundary") == f"synthetic-or-{policy.namespace}-owned-only", F.lit(False))),
            ("REASONING_LAYERS", layers & _text(d, "$.reasoningLayers.providerExposedReasoning").isin("not-provided", "approved-public")),
            ("DATA_CARD_SAFETY", safe),
            ("DATA_CARD_CONTAMINATION", contamination),
            ("WITHDRAWAL_POLICY", _text(d, "$.withdrawal.policy") == TOMBSTONES),
        ),
        provenance_codes(d, "$.sources", policy, "lineage"),
        quality_codes(d, "$.quality", policy),
    )
    schema = _text(d, "$.schema") == f"{policy.namespace}.data-card/v1"
    return rows.select("path", F.explode(F.array_distinct(_under("DATA_CARD_SCHEMA", schema, codes))).alias("code"))


def manifest_findings(manifests: DataFrame, files: DataFrame, objects: DataFrame, policy: Policy) -> DataFrame:
    """(path, code) for publication ``manifests`` (change, path, json).

    ``files`` (change, path, content) are the files that a change adds: its manifest has
    to declare every other one of them with digest, size and role, and nothing else.
    References to layers are answered by declared artifacts or by ``objects`` (role, sha256).
    """
    rows = manifests.select("change", "path", F.try_parse_json("json").alias("d"))
    d, p = F.col("d"), "$.layers.providerExposedReasoning"
    items = F.filter(F.coalesce(_items(d, "$.artifacts"), F.array().cast("array<variant>")), lambda a: _object(a))
    entry = lambda a: F.struct(F.try_variant_get(a, "$.path", "string").alias("path"), _whole(a, "$.bytes").alias("bytes"), _text(a, "$.sha256").alias("sha256"))
    ordered = F.transform(F.array_sort(F.transform(items, entry)), lambda e: F.struct(e["bytes"].alias("bytes"), e["path"].alias("path"), e["sha256"].alias("sha256")))
    digest = F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)
    reasoned = F.exists(items, lambda a: F.coalesce(_text(a, "$.role") == "provider-reasoning", F.lit(False)))
    governed = F.concat(
        label_codes(F.try_variant_get(d, "$.governance", "variant"), policy),
        quality_codes(d, "$.governance.quality", policy),
        receipt_codes(d, "$.governance.reviewReceipt", policy.publication["reviewDispositions"], policy),
        _broken(("WITHDRAWAL_POLICY", _text(d, "$.withdrawal.policy") == TOMBSTONES)),
    )
    codes = F.concat(
        _broken(
            ("POLICY_VERSION", _text(d, "$.policyVersion") == policy.version),
            ("PUBLICATION_ID", _text(d, "$.publicationId") != ""),
            ("DATASET_ID", _text(d, "$.datasetId").rlike(DATASET_ID)),
            ("LICENSE_METADATA", _licensed(d, policy)),
            ("CANDIDATE_HASH", _text(d, "$.candidateSha256").rlike(HEX64)),
            ("ARTIFACTS_REQUIRED", F.size(_items(d, "$.artifacts")) > 0),
            ("ARTIFACT_INVALID", F.size(items) == F.coalesce(F.size(_items(d, "$.artifacts")), F.lit(0))),
            ("PUBLIC_ARTIFACT_HASH", _text(d, "$.publicArtifactSha256") == digest),
            ("PROVIDER_REASONING_UNAPPROVED", ~(_object(d, p) & reasoned) | F.coalesce(_text(d, f"{p}.status") == "approved-public", F.lit(False))),
        ),
        provenance_codes(d, "$.provenance", policy),
        layer_codes(d, policy),
        _under("GOVERNANCE_REQUIRED", _object(d, "$.governance"), governed),
    )
    out = rows.select("path", F.explode(F.array_distinct(codes)).alias("code"))

    a = F.col("a")
    listed = rows.select("change", F.col("path").alias("manifest"), F.posexplode(items).alias("n", "a"))
    listed = listed.select("change", "manifest", "n", _text(a, "$.path").alias("path"), _text(a, "$.sha256").alias("claimed"), _whole(a, "$.bytes").alias("bytes"), _text(a, "$.role").alias("role"), _text(a, "$.mediaType").alias("media"))
    first = F.row_number().over(Window.partitionBy("change", "manifest", "path").orderBy("n")) == 1
    listed = listed.withColumn("ok", is_safe_relative(F.col("path")) & (F.col("path") != F.col("manifest")) & first)
    bad_path = listed.filter(~F.coalesce("ok", F.lit(False))).select(F.col("manifest").alias("path"), F.lit("ARTIFACT_PATH").alias("code"))
    declared = listed.filter("ok")
    actual = files.select("change", "path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("size"))
    there = declared.join(actual, ["change", "path"], "left")
    role_of = F.coalesce(*[F.when(F.col("path").startswith(f"objects/{folder}/"), F.lit(role)) for folder, role in STORES.items()])
    stored = rf"\Aobjects/(?:{'|'.join(STORES)})/sha256/([0-9a-f]{{2}})/([0-9a-f]{{64}})(?:\.[^/]*)?\z"
    address = (F.regexp_extract("path", stored, 1) == F.substring("claimed", 1, 2)) & (F.regexp_extract("path", stored, 2) == F.col("claimed"))
    gone = F.col("size").isNull()
    per_artifact = _broken(
        ("ARTIFACT_HASH", F.col("claimed").rlike(HEX64) & (gone | (F.col("sha256") == F.col("claimed")))),
        ("ARTIFACT_UNAVAILABLE", ~gone),
        ("ARTIFACT_BYTES", gone | (F.col("size") == F.col("bytes"))),
        ("ARTIFACT_ROLE", F.col("role").isin(*ROLES) & (role_of.isNull() | (role_of == F.col("role")))),
        ("ARTIFACT_MEDIA_TYPE", F.col("media") != ""),
        ("ARTIFACT_CONTENT_ADDRESS", ~F.col("path").startswith("objects/") | (F.col("claimed").rlike(HEX64) & address)),
    )
    out = out.unionByName(bad_path).unionByName(there.select(F.col("manifest").alias("path"), F.explode(per_artifact).alias("code")))

    wanted = rows.select("change", F.col("path").alias("manifest")).join(files.select("change", "path"), "change").filter("path <> manifest")
    covers = ["change", "manifest", "path"]
    uncovered = wanted.join(declared.select(*covers), covers, "left_anti").unionByName(declared.select(*covers).join(wanted, covers, "left_anti"))
    out = out.unionByName(uncovered.select(F.col("manifest").alias("path"), F.lit("ARTIFACT_COVERAGE").alias("code")))

    ref = lambda name, role, code: F.struct(F.lit(role).alias("role"), _text(d, f"$.layers.{name}.ref").alias("ref"), F.lit(code).alias("code"))
    approved = F.when(_text(d, f"{p}.status") == "approved-public", _text(d, f"{p}.ref"))
    asked = F.array(
        ref("visibleTranscript", "visible-transcript", "REASONING_LAYER_UNRESOLVED"),
        ref("publicDeliberation", "public-deliberation", "REASONING_LAYER_UNRESOLVED"),
        F.struct(F.lit("provider-reasoning").alias("role"), approved.alias("ref"), F.lit("PROVIDER_REASONING_UNRESOLVED").alias("code")),
    )
    lost = _unresolved(rows.select("change", "path", F.inline(asked)), objects)
    lost = lost.join(listed.select("change", F.col("manifest").alias("path"), "role", F.col("claimed").alias("sha256")), ["change", "path", "role", "sha256"], "left_anti")
    return out.unionByName(lost.select("path", "code")).distinct()


# -- withdrawal


def tombstone_findings(tombstones: DataFrame, released: DataFrame, policy: Policy) -> DataFrame:
    """(path, code) for ``tombstones`` (path, json) of ``released`` files (path, sha256)."""
    w = policy.withdrawal
    rows = tombstones.select("path", F.try_parse_json("json").alias("d"))
    rows = rows.withColumn("target", _text(F.col("d"), "$.target.path"))
    rows = rows.join(released.select(F.col("path").alias("target"), F.col("sha256").alias("actual")), "target", "left")
    d, target, claimed = F.col("d"), F.col("target"), _text(F.col("d"), "$.target.sha256")
    ids, reason = _items(d, "$.target.recordIds"), _text(d, "$.publicReason")
    of_target = _broken(
        ("TOMBSTONE_TARGET", is_safe_relative(target) & is_immutable(target, policy) & F.col("actual").isNotNull()),
        ("TOMBSTONE_TARGET_HASH", claimed.rlike(HEX64) & (F.col("actual").isNull() | (F.col("actual") == claimed))),
        ("TOMBSTONE_RECORD_IDS", F.forall(ids, lambda i: F.coalesce(_text(i).rlike(policy.urn("record")), F.lit(False)))),
    )
    codes = F.concat(
        _broken(
            ("POLICY_VERSION", _text(d, "$.policyVersion") == policy.version),
            ("TOMBSTONE_ID", _text(d, "$.tombstoneId").rlike(policy.urn("tombstone"))),
            ("TOMBSTONE_STATUS", _text(d, "$.status") == w["requiredStatus"]),
            ("TOMBSTONE_REASON", _text(d, "$.reasonCode").isin(w["allowedReasonCodes"])),
            ("TOMBSTONE_PUBLIC_REASON", (F.trim(reason) != "") & (F.length(reason) <= 500)),
            ("TOMBSTONE_TIME", is_utc_timestamp(_text(d, "$.requestedAt")) & is_utc_timestamp(_text(d, "$.reviewedAt"))),
            ("TOMBSTONE_REVIEWER", _text(d, "$.reviewer").rlike(REVIEWER_ID) & _text(d, "$.reviewer").isin(policy.publication["approvedReviewerIds"])),
            ("TOMBSTONE_PRESERVATION", _is(d, "$.originalRemainsAvailable", True)),
            ("LICENSE_METADATA", _text(d, "$.license") == policy.publication["licenses"]["data"]),
        ),
        _under("TOMBSTONE_TARGET", _object(d, "$.target"), of_target),
    )
    schema = _text(d, "$.schema") == w["tombstoneSchema"]
    return rows.select("path", F.explode(_under("TOMBSTONE_SCHEMA", schema, codes)).alias("code")).distinct()


def removal_index_findings(indexes: DataFrame, tombstones: DataFrame, policy: Policy) -> DataFrame:
    """(path, code) for removal ``indexes`` (change, path, json, before: the earlier text or null).

    Every one of the change's new ``tombstones`` (change, path) is referred to, and what
    was there before stays, in its order, at the beginning.
    """
    rows = indexes.select("change", "path", F.try_parse_json("json").alias("d"), F.try_parse_json("before").alias("b"), F.col("before").isNotNull().alias("had"))
    d, items = F.col("d"), _items(F.col("d"), "$.removals")
    texts = lambda a: F.transform(a, lambda x: F.to_json(x))
    old = _items(F.col("b"), "$.removals")
    kept = ~F.col("had") | F.coalesce(F.slice(texts(items), F.lit(1), F.greatest(F.size(old), F.lit(0))) == texts(old), F.lit(False))
    list_ = _under("REMOVAL_INDEX", items.isNotNull(), _broken(("REMOVAL_INDEX_APPEND_ONLY", kept)))
    codes = F.concat(_broken(("POLICY_VERSION", _text(d, "$.policyVersion") == policy.version)), list_)
    good = _text(d, "$.schema") == f"{policy.namespace}.removals/v1"
    out = rows.select("path", F.explode(_under("REMOVAL_INDEX_SCHEMA", good, codes)).alias("code"))
    named = rows.filter(good).select("path", F.explode(items).alias("i")).filter(_text(F.col("i"), "$.status") == policy.withdrawal["requiredStatus"]).select("path", _text(F.col("i"), "$.tombstone").alias("tombstone"))
    due = rows.filter(good & items.isNotNull()).select("change", "path").join(tombstones.select("change", F.col("path").alias("tombstone")), "change")
    lost = due.join(named, ["path", "tombstone"], "left_anti").select("path", F.lit("REMOVAL_INDEX_COVERAGE").alias("code"))
    return out.unionByName(lost.distinct())


# -- changes


def _prefixed(path: Column, prefixes) -> Column:
    return _any([path.startswith(p) for p in prefixes]) if prefixes else F.lit(False)


def _classified(path: Column, globs: list[str], sources: list[str], prefixes: list[str]) -> Column:
    return matches_any(path, globs) | (~_prefixed(path, sources) & _prefixed(path, prefixes))


def is_candidate(path: Column, policy: Policy) -> Column:
    """Paths that are public data."""
    p = policy.publication
    return _classified(path, p.get("publicationPathGlobs", []), p.get("sourcePathPrefixes", []), p["candidatePathPrefixes"])


def is_immutable(path: Column, policy: Policy) -> Column:
    """Paths that never change once they are released."""
    p = policy.publication
    return F.coalesce(_classified(path, p.get("immutablePathGlobs", []), p.get("sourcePathPrefixes", []), p["immutablePathPrefixes"]), F.lit(False))


def is_withdrawal(path: Column, policy: Policy) -> Column:
    return path.startswith(policy.withdrawal["tombstonePathPrefix"]) | (path == policy.withdrawal["removalIndexPath"])


def candidate_findings(changes: DataFrame, policy: Policy) -> DataFrame:
    """(change, path, code) for change sets (change, status, path, old_path); a finding about a whole set has the path ``.``.

    Sets are judged by one aggregation per change, so any number of them is one plan.
    """
    path, op = F.col("path"), F.substring("status", 1, 1)
    c = changes.withColumn("op", op).withColumn("public", is_candidate(path, policy)).withColumn("withdraws", is_withdrawal(path, policy))
    unsafe = ~is_safe_relative(path) | ~F.coalesce(is_safe_relative(F.col("old_path")), F.lit(True)) & F.col("old_path").isNotNull()
    sensitive = _any([has(path, p) for p in PATTERNS]) & ~path.rlike(r"\Aobjects/[a-z0-9-]+/sha256/")
    immutable = is_immutable(path, policy) & (F.col("op") != "A") | F.col("old_path").isNotNull() & is_immutable(F.col("old_path"), policy)
    per_path = _broken(
        ("PATH_UNSAFE", ~unsafe),
        ("PATH_SENSITIVE", unsafe | ~sensitive),
        ("RELEASE_IMMUTABLE", ~immutable),
        ("POLICY_REQUIRED", ~((F.col("op") == "D") & path.startswith("policies/"))),
        ("PUBLICATION_DELETE", ~(F.col("public") & (F.col("op") == "D"))),
        ("TOMBSTONE_IMMUTABLE", ~(path.startswith(policy.withdrawal["tombstonePathPrefix"]) & (F.col("op") != "A"))),
    )
    out = c.select("change", "path", F.explode(per_path).alias("code"))
    sums = c.groupBy("change").agg(
        F.count_if("public").alias("n"),
        F.count_distinct(F.when(F.col("public"), path)).alias("paths"),
        F.count_if(F.col("public") & F.col("withdraws")).alias("withdrawn"),
        F.count_if(path.startswith(policy.withdrawal["tombstonePathPrefix"])).alias("tombstones"),
        F.count_if(path == policy.withdrawal["removalIndexPath"]).alias("indexed"),
        F.count_if(_prefixed(path, TRUST_LAYER)).alias("trust"),
    )
    n, some = F.col("n"), F.col("withdrawn") > 0
    mixes = F.lit(policy.publication.get("rejectMixedPolicyAndPublicationChanges", True)) & (n > 0) & (F.col("trust") > 0)
    per_set = _broken(
        ("POLICY_PUBLICATION_MIXED", ~mixes),
        ("PUBLICATION_FILE_LIMIT", F.col("paths") <= policy.publication["limits"]["publicationFilesHard"]),
        ("WITHDRAWAL_MIXED", ~some | (F.col("withdrawn") == n)),
        ("WITHDRAWAL_ATOMIC", ~some | (F.col("withdrawn") < n) | ((F.col("tombstones") > 0) & (F.col("indexed") > 0))),
    )
    return out.unionByName(sums.select("change", F.lit(".").alias("path"), F.explode(per_set).alias("code"))).distinct()


def report(findings: DataFrame, most: int = 200) -> dict:
    """ok, findingCount and the first ``most`` distinct findings (path, code and, if there are, line and column) in order.

    Paths with control characters or sensitive parts are redacted. The driver gets ``most`` rows and a count.
    """
    path = F.col("path")
    hidden = path.rlike(r"[\x00-\x1f\x7f]") | _any([has(path, p) for p in PATTERNS])
    columns = ["code", "path", *(c for c in ("line", "column") if c in findings.columns)]
    shown = findings.withColumn("path", F.when(hidden, F.lit("<redacted-path>")).otherwise(path)).select(*columns).distinct()
    rows = [r.asDict() for r in shown.orderBy(*columns).limit(most).collect()]
    return {"ok": not rows, "findingCount": shown.count() if len(rows) == most else len(rows), "findings": rows}


def exit_code(result: dict | None) -> int:
    """What a command ends with: 0 if nothing was found, 1 with findings, 2 if it couldn't be run (no report)."""
    return 2 if result is None else 0 if result["ok"] else 1


def as_text(result: dict) -> str:
    """A report as lines, ``path:line:column code``; places that a finding lacks are 0."""
    rows = [f"{f['path']}:{f.get('line') or 0}:{f.get('column') or 0} {f['code']}" for f in result["findings"]]
    more = result["findingCount"] - len(rows)
    return "\n".join([*rows, *([f"and {more} more"] if more else []), "ok" if result["ok"] else f"{result['findingCount']} findings"])
