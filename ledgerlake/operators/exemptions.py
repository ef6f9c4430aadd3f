"""Scans of JSON values and paths, with digests at proven places exempt from the card test.

64 hexadecimal digits can hold a run that passes as a card number. A digest is exempt
only in a document that other rules have accepted, at a place that its version
gives to digests, and where what stands beside it fits. Only the card test is waived.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.paths import CONTENT_ADDRESS, is_content_address
from ledgerlake.functions.scan import PATTERNS, has
from ledgerlake.functions.walk import walk
from ledgerlake.session import cut

CARD_CODE = "PII_PAYMENT_CARD"
HEX_64 = r"^[0-9a-f]{64}$"
BESIDE = ("path", "artifactKind", "mediaType", "bytes", "sha256", "policyId", "artifactPath", "artifactSha256", "summary")


@dataclass(frozen=True)
class DigestPlaces:
    """Where documents of a version (without its namespace) hold descriptors, references to
    receipts, and evidence: pointers of the objects, ``*`` for any one step."""

    descriptors: dict[str, tuple[str, ...]] = field(default_factory=dict)
    receipts: dict[str, tuple[str, ...]] = field(default_factory=dict)
    evidence: dict[str, tuple[str, ...]] = field(default_factory=dict)


# fixed values: the places of the formal documents
FORMAL_PLACES = DigestPlaces(
    descriptors={
        "dataset-manifest/v2": ("/dataCard", "/shards/*", "/supportingArtifacts/*"),
        "release-manifest/v2": ("/previousReleasePointer", "/datasets/*/manifest", "/worldPackSources/*"),
        "catalog-release-pointer/v2": ("/activeReviewSet", "/releaseManifest"),
        "catalog-latest-pointer/v2": ("/releasePointer",),
        "public-review-receipt/v2": ("/approvalReference", "/approvedArtifacts/*", "/providerRedistributionApproval/termsReference"),
        "provider-reasoning/v2": ("/source/redistributionTermsRef",),
        "world-pack-source/v2": ("/projectionRecipe",),
    },
    receipts={"active-review-set/v2": ("/heads/*", "/receipts/*"), "public-review-receipt/v2": ("/approvalReference", "/predecessor")},
    evidence={
        "public-review-receipt/v2": ("/checks/*/evidence/*",),
        "public-record/v2": ("/provenance/sources/*/consentEvidence", "/provenance/sources/*/ownershipEvidence"),
    },
)
POINTER = "catalog-release-pointer/v2"
TRUST_POLICY = "policies/publication-trust-v2.json"


def _within(version: Column, place: Column, places: dict[str, tuple[str, ...]], namespace: str) -> Column:
    """Whether ``place`` is one that the document's version allows."""
    out = F.lit(False)
    for name, patterns in places.items():
        regex = "^(" + "|".join(p.replace("*", "[^/]+") for p in patterns) + ")$"
        out = out | ((version == f"{namespace}.{name}") & place.rlike(regex))
    return F.coalesce(out, F.lit(False))


def values(docs: DataFrame, key: str, raw: str, namespace: str, places: DigestPlaces = FORMAL_PLACES) -> DataFrame:
    """``walk`` of the documents with proven: whether a value is a digest, or an address with one, at
    a place of its document's version. The fields beside a value come by a join on its parent.

    An object's children are those of the value, so a long list costs rows, not one wide row.
    """
    above = F.regexp_replace("path", "/[^/]*$", "")
    w = cut(walk(docs.select(key, raw), raw).withColumn("above", above), "walked")
    text = F.col("kind") == "string"
    of = lambda n, what=F.col("value"): F.max(F.when(F.col("key") == n, what))
    beside = w.filter(F.col("key").isin(*BESIDE)).groupBy(key, "above").agg(*[of(n, F.when(text | (F.lit(n) == "bytes"), F.col("value"))).alias(f"b_{n}") for n in BESIDE])
    version = w.filter((F.col("path") == "/schemaVersion") & text & F.col("value").rlike(rf"^{namespace}\.[a-z0-9-]+/v2$")).select(key, F.col("value").alias("version"))
    j = w.join(beside, [key, "above"], "left").join(version, key, "left")
    b = lambda n: F.col(f"b_{n}")
    at = lambda p: _within(F.col("version"), F.col("above"), p, namespace)
    described, receipt, evidence = at(places.descriptors), at(places.receipts), at(places.evidence)
    whole = b("path").isNotNull() & b("artifactKind").isNotNull() & b("mediaType").isNotNull() & b("bytes").isNotNull() & b("sha256").isNotNull()
    value, name = F.col("value"), F.col("key")
    digest = value.rlike(HEX_64)
    policy = (F.col("above") == "/policy") & (b("policyId") == f"{namespace}-publication-trust") & (b("path") == TRUST_POLICY)
    addressed = F.regexp_extract(value, CONTENT_ADDRESS, 2) != ""
    proven = (
        ((name == "sha256") & digest & ((described & whole) | policy | (receipt & is_content_address(b("path"), value))))
        | ((name == "path") & described & whole & b("sha256").rlike(HEX_64) & is_content_address(value, b("sha256")))
        | ((name == "path") & receipt & is_content_address(value, b("sha256")))
        | ((name == "reviewReceiptRef") & described & addressed & value.startswith("objects/review-receipts/"))
        | ((name == "artifactSha256") & evidence & digest & b("artifactPath").isNotNull() & b("summary").isNotNull())
        | ((name == "artifactPath") & evidence & is_content_address(value, b("artifactSha256")))
        | ((F.col("path") == "/previousReleasePointerSha256") & (F.col("version") == f"{namespace}.{POINTER}") & digest)
    )
    return j.select(key, "path", "key", "kind", "value", F.coalesce(F.col("version").isNotNull() & text & proven, F.lit(False)).alias("proven"))


def _codes(text: Column, exempt: Column) -> Column:
    found = F.array(*[F.when(has(text, p) & ~(exempt & F.lit(p.code == CARD_CODE)), F.lit(p.code)) for p in PATTERNS])
    return F.filter(found, lambda c: c.isNotNull())


def scan_json(docs: DataFrame, key: str, raw: str, namespace: str, verified: str | None = None, places: DigestPlaces = FORMAL_PLACES) -> DataFrame:
    """key, path, part (key or value), code for each finding in the keys and strings of JSON documents.

    ``verified`` names a boolean column: the document has passed its own rules. Where it
    isn't true, and without it, no digest is exempt.
    """
    v = values(docs, key, raw, namespace, places)
    if verified:
        v = v.join(docs.select(key, F.coalesce(F.col(verified), F.lit(False)).alias("passed")), key)
    exempt = F.col("proven") & F.col("passed") if verified else F.lit(False)
    texts = F.array(
        F.struct(F.lit("key").alias("part"), F.col("key").alias("text"), F.lit(False).alias("exempt")),
        F.struct(F.lit("value").alias("part"), F.when(F.col("kind") == "string", F.col("value")).alias("text"), exempt.alias("exempt")),
    )
    t = v.select(key, "path", F.explode(texts).alias("t")).select(key, "path", "t.*").filter(F.col("text").isNotNull())
    return t.select(key, "path", "part", F.explode(_codes(F.col("text"), F.col("exempt"))).alias("code")).distinct()


def scan_paths(files: DataFrame, path: str, sha256: str) -> DataFrame:
    """path, code for each finding in paths; the digits of a content address are exempt if they are the file's."""
    return files.select(path, F.explode(_codes(F.col(path), is_content_address(F.col(path), F.col(sha256)))).alias("code")).distinct()


def formal_documents(docs: DataFrame, key: str, raw: str, namespace: str) -> DataFrame:
    """The keys of documents with a formal version at any depth."""
    w = walk(docs.select(key, raw), raw)
    return w.filter((F.col("key") == "schemaVersion") & (F.col("kind") == "string") & F.col("value").rlike(rf"^{namespace}\.[a-z0-9-]+/v2$")).select(key).distinct()


# fixed values: the folders whose files are meant to break rules
FIXTURE_FOLDERS = ("tests/fixtures/contracts/invalid", "tests/fixtures/contracts/v2/release-graph")


def is_fixture(path: Column, folders: tuple[str, ...] = FIXTURE_FOLDERS) -> Column:
    """Whether a path is of a file below exactly one of ``folders``."""
    plain = F.regexp_replace(F.regexp_replace(path, r"(^|/)(?:\./+)+", "$1"), "/{2,}", "/")
    return F.coalesce(plain.rlike("^(?:" + "|".join(folders) + ")/+[^/]"), F.lit(False))
