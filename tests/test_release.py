"""A small release: as it should be, and with one thing wrong at a time."""

import hashlib
import json

import pytest

from ledgerlake.operators import release

DATASETS = ["d01-a", "d02-b"]


def ref(path, body):
    return {"path": path, "bytes": len(body), "sha256": hashlib.sha256(body).hexdigest()}


def tree(change=None):
    c = dict(change or {})
    files, entries, name = {}, [], c.get("id", "release-2024-01-02-x")
    for i, d in enumerate(DATASETS):
        shard = json.dumps({"recordId": f"r{i}"}).encode() + b"\n"
        files[f"objects/{d}.jsonl"] = shard
        same = {"datasetId": d, "datasetVersion": "1", "counts": {"records": 1, "transcripts": 2}, "contentBytes": 10}
        path = c.get("manifest", f"releases/{name}/datasets/{d}.json") if i else f"releases/{name}/datasets/{d}.json"
        body = json.dumps(same | {"shards": [ref(f"objects/{d}.jsonl", shard)]} | (c.get("of_manifest", {}) if i else {})).encode()
        files[path] = body
        entries.append(same | {"manifest": ref(path, body)})
    shared = {"releaseId": name, "createdAt": "t", "sequence": 0, "previousReleaseId": None, "policy": {"v": 1}}
    shared["totals"] = {"datasets": 2, "records": 2, "transcripts": 4, "deliberations": 0, "providerReasoning": 0, "worldPackSources": 0, "contentBytes": 20} | c.get("totals", {})
    at = c.get("release", f"releases/{name}/manifest.json")
    files[at] = body = json.dumps(shared | {"datasets": entries[:: c.get("step", 1)], "worldPackSources": []}).encode()
    pointer = c.get("pointer", f"catalog/releases/{name}.json")
    files[pointer] = body = json.dumps(shared | {"releaseManifest": ref(at, body)} | c.get("of_pointer", {})).encode()
    files["catalog/latest.json"] = json.dumps({"releasePointer": ref(pointer, body) | c.get("of_latest", {})}).encode()
    return files | c.get("files", {})


def frame(spark, files):
    return spark.createDataFrame([(p, bytearray(b)) for p, b in files.items()], "path string, content binary")


@pytest.mark.parametrize(
    ("change", "codes"),
    [
        ({}, set()), ({"pointer": "catalog/releases/release-2024-01-02-y.json"}, {"CATALOG_POINTER_PATH"}), ({"release": "releases/x/manifest.json"}, {"RELEASE_MANIFEST_PATH"}), ({"of_pointer": {"sequence": 1}}, {"CATALOG_RELEASE_MISMATCH"}),
        ({"totals": {"records": 3}}, {"RELEASE_TOTALS"}), ({"step": -1}, {"RELEASE_DATASETS", "ARTIFACT_ORDER"}), ({"manifest": "releases/z.json"}, {"DATASET_MANIFEST_PATH"}), ({"of_manifest": {"contentBytes": 9}}, {"DATASET_RELEASE_MISMATCH"}),
        ({"of_latest": {"sha256": "0" * 64, "bytes": 1}}, {"DESCRIPTOR_HASH", "DESCRIPTOR_BYTES"}), ({"files": {"objects/d01-a.jsonl": b"other"}}, {"DESCRIPTOR_HASH", "DESCRIPTOR_BYTES"}),
    ],
)
def test_a_release(spark, change, codes):
    assert {r.code for r in release.release_findings(frame(spark, tree(change)), DATASETS).collect()} == codes


def test_coverage(spark):
    files = tree() | {"objects/alone.json": b"{}", "objects/bad.json": b"\xff", "objects/ring.json": json.dumps(ref("objects/ring.json", b"")).encode()}
    df = frame(spark, files)
    found = release.coverage(df, release.references(df)).collect()
    assert {(r.subject, r.code) for r in found} == {(f"objects/{n}.json", "ARTIFACT_COVERAGE") for n in ("alone", "bad", "ring")}
