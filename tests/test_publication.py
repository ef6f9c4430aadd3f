"""Publication rules: one good document of each kind, and a broken one for each code."""

import copy
import hashlib
import json

import pytest

from ledgerlake.operators import publication as pub

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
dumps = lambda v: json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
NOW, REF = "2024-05-06T07:08:09Z", "sha256:" + sha("t")
TEXT = "Made by this project."
POLICY = pub.Policy(
    namespace="lake",
    publication={
        "policyVersion": "1", "licenses": {"data": "D-1", "code": "C-1"}, "reviewDispositions": ["approve_public"], "approvedReviewerIds": ["rev-1"], "limits": {"publicationFilesHard": 3},
        "candidatePathPrefixes": ["objects/", "catalog/", "datasets/"], "sourcePathPrefixes": ["datasets/"], "publicationPathGlobs": ["datasets/*/shards/**"],
        "immutablePathPrefixes": ["objects/", "catalog/tombstones/"], "immutablePathGlobs": ["datasets/*/shards/**"], "rejectMixedPolicyAndPublicationChanges": True,
    },
    sources={"allowedRightsBases": {"synthetic": {"sourceTypes": ["deterministic-synthetic"]}, "own": {"sourceTypes": ["lake-repository", "system-controlled-agent", "consented-human-judgment"]}}, "allowedRepositories": ["me/lake"]},
    rights={"statements": {"s": {"rightsBasis": "synthetic", "sourceTypes": ["deterministic-synthetic"], "statement": TEXT}, "o": {"rightsBasis": "own", "sourceTypes": ["lake-repository", "system-controlled-agent", "consented-human-judgment"], "statement": "Ours."}}},
    safety={"requiredPrivacyLabel": "nobody", "requiredSafetyStatus": "pass", "allowedSafetyLabels": ["none"]},
    quality={
        "recordThresholds": {"status": "pass", "verifierPassed": True, "minimumScore": 0.9}, "publicationThresholds": {"minimumRecordCount": 1, "minimum": {"passRate": 1.0}, "maximum": {"dupRate": 0.01}},
        "requiredContaminationLabels": ["open"], "requiredPublicExposureLabel": "public", "requiredEvaluationUseLabel": "unclean",
    },
    fields={"requiredRecordSections": ["schemaVersion", "payload", "integrity"]},
    withdrawal={"tombstonePathPrefix": "catalog/tombstones/", "removalIndexPath": "catalog/removals.json", "tombstoneSchema": "lake.tombstone/v1", "requiredStatus": "withdrawn", "allowedReasonCodes": ["privacy-risk"]},
)
PROVENANCE = {"rightsBasis": "synthetic", "rightsStatementId": "s", "rightsStatement": TEXT, "sources": [{"type": "deterministic-synthetic", "sourceId": "urn:lake:synthetic:1", "generatorCommit": "a" * 40}]}
OWN = {
    "rightsBasis": "own", "rightsStatementId": "o", "rightsStatement": "Ours.",
    "sources": [
        {"type": "lake-repository", "repository": "me/lake", "commit": "b" * 40, "blobs": [{"path": "a/b", "gitBlob": "c" * 40}]},
        {"type": "system-controlled-agent", "agentId": "a", "ownershipAttestation": {"attested": True, "license": "D-1", "attestedAt": NOW, "attestedBy": "rev-1"}},
        {"type": "consented-human-judgment", "consentReceipt": {"publicDataConsent": True, "license": "D-1", "consentedAt": NOW, "receiptSha256": sha("r")}},
    ],
}
LABELS = {"privacy": "nobody", "safetyStatus": "pass", "safetyLabels": ["none"], "contamination": {"label": "open"}, "publicExposure": {"label": "public"}, "evaluationUse": "unclean"}
PAYLOAD = {"b": 1.0, "a": "é"}
RECORD = {
    "schemaVersion": "lake.public-record/v1", "datasetId": "d01-ledger", "recordType": "event", "recordId": "urn:lake:record:sha256:" + sha("x"), "episodeId": "e", "sequence": 0, "split": "train", "eventTime": NOW,
    "payload": PAYLOAD, "provenance": PROVENANCE, "generation": {"transcriptRef": REF, "deliberationRef": REF}, "governance": LABELS | {"license": "D-1", "quality": {"status": "pass", "verifierPassed": True, "score": 0.95}},
    "integrity": {"payloadSha256": sha(dumps(PAYLOAD)), "recordSha256": sha("r")},
}
DROP = object()


def changed(doc, path, value):
    out = copy.deepcopy(doc)
    at = out
    *way, last = path.split(".")
    for k in way:
        at = at[int(k) if isinstance(at, list) else k]
    last = int(last) if isinstance(at, list) else last
    if value is DROP:
        del at[last]
    else:
        at[last] = value
    return out


def judged(df):
    out = {}
    for r in df.select("path", "code").distinct().collect():
        out.setdefault(r.path, set()).add(r.code)
    return out


RECORDS = [
    ("schemaVersion", "x", "RECORD_SCHEMA"), ("integrity", DROP, "INTEGRITY_REQUIRED"), ("integrity", DROP, "RECORD_FIELDS"), ("datasetId", "d99", "DATASET_ID"), ("recordType", "", "RECORD_TYPE"), ("recordId", "x", "RECORD_ID"), ("episodeId", None, "EPISODE_ID"),
    ("sequence", -1, "RECORD_SEQUENCE"), ("sequence", True, "RECORD_SEQUENCE"), ("split", "dev", "RECORD_SPLIT"), ("eventTime", "2024-02-30T00:00:00Z", "RECORD_TIME"), ("payload", [], "RECORD_PAYLOAD"),
    ("provenance", 1, "PROVENANCE_REQUIRED"), ("provenance.rightsBasis", "found", "SOURCE_RIGHTS_BASIS"), ("provenance.rightsStatementId", "o", "RIGHTS_STATEMENT"), ("provenance.rightsStatement", "x", "RIGHTS_STATEMENT_TEXT"),
    ("provenance.sources", [], "SOURCES_REQUIRED"), ("provenance.sources.0", 3, "SOURCE_INVALID"), ("provenance.sources.0.type", "lake-repository", "SOURCE_TYPE"), ("provenance.sources.0.url", "u", "SOURCE_EXTERNAL"),
    ("provenance.sources.0.sourceId", "u", "SOURCE_SYNTHETIC_ID"), ("provenance.sources.0.generatorCommit", "a", "SOURCE_GENERATOR_COMMIT"), ("generation", None, "GENERATION_REQUIRED"), ("generation.transcriptRef", "x", "REASONING_LAYER_REQUIRED"),
    ("generation.deliberationRef", "sha256:" + sha("none"), "REASONING_LAYER_UNRESOLVED"), ("generation.providerReasoningRef", "x", "PROVIDER_REASONING_REF"), ("generation.providerReasoningRef", REF, "PROVIDER_REASONING_APPROVAL"),
    ("generation.providerReasoningRef", REF, "PROVIDER_REASONING_UNRESOLVED"), ("governance", "x", "GOVERNANCE_REQUIRED"), ("governance.license", "x", "LICENSE_METADATA"), ("governance.quality.score", 0.5, "RECORD_QUALITY"),
    ("governance.privacy", "x", "PRIVACY_LABEL"), ("governance.safetyStatus", "x", "SAFETY_STATUS"), ("governance.safetyLabels", ["none", 1], "SAFETY_LABEL"), ("governance.contamination", "x", "CONTAMINATION_LABEL"),
    ("governance.publicExposure.label", "x", "PUBLIC_EXPOSURE_LABEL"), ("governance.evaluationUse", "x", "EVALUATION_USE_LABEL"), ("payload.b", 2, "PAYLOAD_HASH"), ("integrity.recordSha256", "x", "RECORD_HASH"),
]
SOURCES = [
    ("provenance.sources.0.repository", "x", "SOURCE_REPOSITORY"), ("provenance.sources.0.commit", "x", "SOURCE_COMMIT"), ("provenance.sources.0.blobs", [], "SOURCE_BLOBS"), ("provenance.sources.0.blobs.0.path", "../x", "SOURCE_BLOB"),
    ("provenance.sources.1.agentId", "", "SOURCE_AGENT"), ("provenance.sources.1.ownershipAttestation.attested", False, "SOURCE_OWNERSHIP"), ("provenance.sources.2.consentReceipt.receiptSha256", "x", "SOURCE_CONSENT"),
]


def test_records(spark):
    rows, want = [("good", dumps(RECORD)), ("own", dumps(RECORD | {"provenance": OWN})), ("text", "{"), ("null", None), ("list", "[]")], {"text": "RECORD_OBJECT", "null": "RECORD_OBJECT", "list": "RECORD_OBJECT"}
    for base, cases in ((RECORD, RECORDS), (RECORD | {"provenance": OWN}, SOURCES)):
        for path, value, code in cases:
            name = f"{code} {path} {value if value is not DROP else ''}"
            rows.append((name, dumps(changed(base, path, value))))
            want[name] = code
    objects = spark.createDataFrame([("visible-transcript", sha("t")), ("public-deliberation", sha("t"))], "role string, sha256 string")
    df = spark.createDataFrame([(p, 1, j) for p, j in rows], "path string, line long, json string")
    got = judged(pub.record_findings(df, objects, POLICY))
    assert "good" not in got and "own" not in got
    assert not {n: (c, got.get(n)) for n, c in want.items() if c not in got.get(n, ())}


CARD = {
    "schema": "lake.data-card/v1", "policyVersion": "1", "datasetId": "d01-ledger", "licenses": {"data": "D-1", "code": "C-1"}, "sources": {**{k: v for k, v in PROVENANCE.items() if k != "sources"}, "lineage": PROVENANCE["sources"], "boundary": "synthetic-or-lake-owned-only"},
    "reasoningLayers": {"visibleTranscript": "included", "publicDeliberation": "included", "providerExposedReasoning": "not-provided"}, "privacyAndSafety": {"privacy": "nobody", "realPii": False, "secrets": False, "unownedContent": False, "safetyStatus": "pass"},
    "contamination": {"label": "open", "publicExposure": "public", "evaluationUse": "unclean"}, "quality": {"recordCount": 1, "metrics": {"passRate": 1.0, "dupRate": 0}}, "withdrawal": {"policy": "append-only-tombstone"},
}
CARDS = [
    ("schema", "x", "DATA_CARD_SCHEMA"), ("policyVersion", "0", "POLICY_VERSION"), ("datasetId", 1, "DATASET_ID"), ("licenses.code", "x", "LICENSE_METADATA"), ("sources", 1, "PROVENANCE_REQUIRED"), ("sources.boundary", "x", "SOURCE_BOUNDARY"),
    ("reasoningLayers.publicDeliberation", "x", "REASONING_LAYERS"), ("privacyAndSafety.secrets", True, "DATA_CARD_SAFETY"), ("contamination.label", "x", "DATA_CARD_CONTAMINATION"), ("quality", None, "QUALITY_REQUIRED"),
    ("quality.recordCount", 0, "QUALITY_RECORD_COUNT"), ("quality.metrics", [], "QUALITY_METRICS"), ("quality.metrics.passRate", 0.5, "QUALITY_MINIMUM"), ("quality.metrics.dupRate", True, "QUALITY_MAXIMUM"), ("withdrawal.policy", "x", "WITHDRAWAL_POLICY"),
]


def test_cards(spark):
    rows = [("good", dumps(CARD))] + [(f"{c} {p}", dumps(changed(CARD, p, v))) for p, v, c in CARDS]
    got = judged(pub.card_findings(spark.createDataFrame(rows, "path string, json string"), POLICY))
    assert "good" not in got
    assert not {f"{c} {p}": got.get(f"{c} {p}") for p, _, c in CARDS if c not in got.get(f"{c} {p}", ())}


RECEIPT = {"policyVersion": "1", "disposition": "approve_public", "reviewer": "rev-1", "reviewedAt": NOW}


def manifest():
    body = b"one"
    address = f"objects/transcripts/sha256/{sha('one')[:2]}/{sha('one')}.json"
    artifacts = [{"path": address, "sha256": sha("one"), "bytes": 3, "role": "visible-transcript", "mediaType": "m"}, {"path": "catalog/x.json", "sha256": sha("two"), "bytes": 3, "role": "catalog-index", "mediaType": "m"}]
    aggregate = sha(dumps(sorted(({"bytes": a["bytes"], "path": a["path"], "sha256": a["sha256"]} for a in artifacts), key=lambda a: a["path"])))
    both = {"candidateSha256": sha("c"), "publicArtifactSha256": aggregate}
    layer = {"status": "included", "ref": REF}
    doc = {
        "policyVersion": "1", "publicationId": "p", "datasetId": "d02-x", "licenses": {"data": "D-1", "code": "C-1"}, **both, "provenance": PROVENANCE, "artifacts": artifacts,
        "layers": {"visibleTranscript": {"status": "included", "ref": "sha256:" + sha("one")}, "publicDeliberation": layer, "providerExposedReasoning": {"status": "not-provided"}},
        "governance": LABELS | {"quality": {"recordCount": 1, "metrics": {"passRate": 1.0, "dupRate": 0.0}}, "reviewReceipt": RECEIPT | both}, "withdrawal": {"policy": "append-only-tombstone"},
    }
    return doc, [(address, body), ("catalog/x.json", b"two")]


MANIFESTS = [
    ("policyVersion", 1, "POLICY_VERSION"), ("publicationId", "", "PUBLICATION_ID"), ("datasetId", "x", "DATASET_ID"), ("licenses", {}, "LICENSE_METADATA"), ("candidateSha256", "x", "CANDIDATE_HASH"), ("candidateSha256", sha("z"), "REVIEW_RECEIPT_CANDIDATE"),
    ("publicArtifactSha256", sha("z"), "PUBLIC_ARTIFACT_HASH"), ("publicArtifactSha256", sha("z"), "REVIEW_RECEIPT_PUBLIC"), ("artifacts", [], "ARTIFACTS_REQUIRED"), ("artifacts", [], "ARTIFACT_COVERAGE"), ("artifacts.0", 1, "ARTIFACT_INVALID"),
    ("artifacts.1.path", "a//b", "ARTIFACT_PATH"), ("artifacts.1.path", "catalog/none.json", "ARTIFACT_UNAVAILABLE"), ("artifacts.1.sha256", sha("z"), "ARTIFACT_HASH"), ("artifacts.1.bytes", 4, "ARTIFACT_BYTES"), ("artifacts.1.role", "x", "ARTIFACT_ROLE"),
    ("artifacts.0.role", "records", "ARTIFACT_ROLE"), ("artifacts.1.mediaType", None, "ARTIFACT_MEDIA_TYPE"), ("artifacts.0.sha256", sha("z"), "ARTIFACT_CONTENT_ADDRESS"), ("artifacts.1.role", "provider-reasoning", "PROVIDER_REASONING_UNAPPROVED"),
    ("layers", 1, "REASONING_LAYERS"), ("layers.visibleTranscript.status", "x", "REASONING_LAYER_REQUIRED"), ("layers.publicDeliberation.ref", "sha256:" + sha("none"), "REASONING_LAYER_UNRESOLVED"), ("layers.providerExposedReasoning", DROP, "PROVIDER_REASONING_METADATA"),
    ("layers.providerExposedReasoning.ref", REF, "PROVIDER_REASONING_ABSENT"), ("layers.providerExposedReasoning.status", "x", "PROVIDER_REASONING_STATUS"), ("layers.providerExposedReasoning", {"status": "approved-public"}, "PROVIDER_REASONING_REF"),
    ("layers.providerExposedReasoning", {"status": "approved-public"}, "PROVIDER_REASONING_FORMAT"), ("layers.providerExposedReasoning", {"status": "approved-public", "ref": REF}, "PROVIDER_REASONING_UNRESOLVED"),
    ("layers.providerExposedReasoning", {"status": "approved-public", "approvalReceipt": {}}, "PROVIDER_TERMS"), ("layers.providerExposedReasoning", {"status": "approved-public", "approvalReceipt": {}}, "PROVIDER_REDISTRIBUTION"),
    ("governance", None, "GOVERNANCE_REQUIRED"), ("governance.reviewReceipt", None, "REVIEW_RECEIPT_REQUIRED"), ("governance.reviewReceipt.policyVersion", "x", "REVIEW_RECEIPT_POLICY"), ("governance.reviewReceipt.disposition", "x", "REVIEW_RECEIPT_DISPOSITION"),
    ("governance.reviewReceipt.reviewer", "who", "REVIEW_RECEIPT_REVIEWER"), ("governance.reviewReceipt.reviewedAt", "x", "REVIEW_RECEIPT_TIME"), ("governance.reviewReceipt.superseded", True, "REVIEW_RECEIPT_SUPERSEDED"), ("withdrawal", None, "WITHDRAWAL_POLICY"),
]


def test_manifests(spark):
    doc, own = manifest()
    rows = [("good", doc)] + [(f"{c} {p} {i}", changed(doc, p, v)) for i, (p, v, c) in enumerate(MANIFESTS)]
    ms = spark.createDataFrame([(n, n, dumps(d)) for n, d in rows], "change string, path string, json string")
    fs = spark.createDataFrame([(n, p, bytearray(b)) for n, _ in rows for p, b in [*own, (n, b"{}")]], "change string, path string, content binary")
    objects = spark.createDataFrame([("public-deliberation", sha("t"))], "role string, sha256 string")
    got = judged(pub.manifest_findings(ms, fs, objects, POLICY))
    assert "good" not in got
    assert not {n: got.get(n) for n, _ in rows[1:] if n.split()[0] not in got.get(n, ())}


TOMB = {
    "schema": "lake.tombstone/v1", "policyVersion": "1", "tombstoneId": "urn:lake:tombstone:sha256:" + sha("x"), "target": {"path": "objects/a.json", "sha256": sha("a"), "recordIds": []}, "status": "withdrawn", "reasonCode": "privacy-risk", "publicReason": "Asked for.",
    "requestedAt": NOW, "reviewedAt": NOW, "reviewer": "rev-1", "originalRemainsAvailable": True, "license": "D-1",
}
TOMBS = [
    ("schema", "x", "TOMBSTONE_SCHEMA"), ("policyVersion", "x", "POLICY_VERSION"), ("tombstoneId", "x", "TOMBSTONE_ID"), ("target", 1, "TOMBSTONE_TARGET"), ("target.path", "objects/none", "TOMBSTONE_TARGET"), ("target.sha256", sha("z"), "TOMBSTONE_TARGET_HASH"),
    ("target.recordIds", ["x"], "TOMBSTONE_RECORD_IDS"), ("status", "x", "TOMBSTONE_STATUS"), ("reasonCode", "x", "TOMBSTONE_REASON"), ("publicReason", " ", "TOMBSTONE_PUBLIC_REASON"), ("requestedAt", 1, "TOMBSTONE_TIME"), ("reviewer", "x", "TOMBSTONE_REVIEWER"),
    ("originalRemainsAvailable", False, "TOMBSTONE_PRESERVATION"), ("license", "x", "LICENSE_METADATA"),
]


def test_withdrawal(spark):
    rows = [("good", dumps(TOMB))] + [(f"{c} {p}", dumps(changed(TOMB, p, v))) for p, v, c in TOMBS]
    released = spark.createDataFrame([("objects/a.json", sha("a"))], "path string, sha256 string")
    got = judged(pub.tombstone_findings(spark.createDataFrame(rows, "path string, json string"), released, POLICY))
    assert "good" not in got and all(n.split()[0] in got[n] for n, _ in rows[1:])
    one, two = {"tombstone": "t1", "status": "withdrawn"}, {"tombstone": "t2", "status": "withdrawn"}
    index = lambda *r, **k: dumps({"schema": "lake.removals/v1", "policyVersion": "1", "removals": list(r)} | k)
    rows = [("good", index(one, two), index(one)), ("new", index(two), None), ("REMOVAL_INDEX_APPEND_ONLY", index(two, one), index(one)), ("REMOVAL_INDEX_COVERAGE", index(one), None), ("REMOVAL_INDEX_SCHEMA", index(two, schema="x"), None), ("POLICY_VERSION", index(two, policyVersion="x"), None), ("REMOVAL_INDEX", index(removals=1), None)]
    got = judged(pub.removal_index_findings(spark.createDataFrame([("c", *r) for r in rows], "change string, path string, json string, before string"), spark.createDataFrame([("c", "t2")], "change string, path string"), POLICY))
    assert "good" not in got and "new" not in got and all(n in got[n] for n, _, _ in rows[2:])


@pytest.mark.parametrize("none", [False, True])
def test_changes_and_reports(spark, none):
    rows = [
        ("ok", "A", "objects/a.json", None), ("del", "D", "catalog/a.json", None), ("mix", "A", "catalog/a.json", None), ("mix", "M", "policies/p.json", None), ("w", "A", "catalog/tombstones/t.json", None), ("w", "M", "catalog/x.json", None),
        ("atom", "A", "catalog/tombstones/t.json", None), ("both", "A", "catalog/tombstones/t.json", None), ("both", "M", "catalog/removals.json", None), ("imm", "M", "datasets/d/shards/1", None), ("tomb", "M", "catalog/tombstones/t.json", None),
        ("pol", "D", "policies/p.json", None), ("bad", "A", "catalog/../x", None), ("pii", "A", "catalog/a.b" + "@" + "host.io", None), ("src", "M", "datasets/d/code.py", None), ("ren", "R", "catalog/n.json", "objects/o.json"),
    ] + [("many", "A", f"catalog/{i}.json", None) for i in range(4)]
    df = spark.createDataFrame([] if none else rows, "change string, status string, path string, old_path string")
    found = pub.candidate_findings(df, POLICY)
    got = {}
    for r in found.collect():
        got.setdefault(r.change, set()).add(r.code)
    want = {
        "del": {"PUBLICATION_DELETE"}, "mix": {"POLICY_PUBLICATION_MIXED"}, "w": {"WITHDRAWAL_MIXED"}, "atom": {"WITHDRAWAL_ATOMIC"}, "imm": {"RELEASE_IMMUTABLE"}, "tomb": {"TOMBSTONE_IMMUTABLE", "RELEASE_IMMUTABLE", "WITHDRAWAL_ATOMIC"},
        "pol": {"POLICY_REQUIRED"}, "bad": {"PATH_UNSAFE"}, "pii": {"PATH_SENSITIVE"}, "ren": {"RELEASE_IMMUTABLE"}, "many": {"PUBLICATION_FILE_LIMIT"},
    }
    assert got == ({} if none else want)
    r = pub.report(found, most=5)
    assert r["ok"] == none and r["findingCount"] == (0 if none else len({(x.code, x.path) for x in found.collect()})) and "host.io" not in json.dumps(r)
