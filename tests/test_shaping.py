"""Shaping, receipts, exemptions, checkpoints: nulls, faults, empty tables, and one failing case per code."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import council, exemptions, gate, publication, receipts, sharding
from ledgerlake.plans import datasets, shaping, simulate
from ledgerlake.sources import jsonl, policy, site
from ledgerlake.streaming import checkpoints


def codes(df):
    return sorted((r[0], r[1]) for r in df.collect())


def made(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# -- shaping


def test_unwrap_of_nulls_and_of_what_is_no_json(spark):
    raws = [None, "", "no", "7", "[]", "{}", '{"value":{"id":"a","x":1.50}}', '{"value":[1],"id":"b"}']
    d = made(spark, list(enumerate(raws)), "i int, raw string")
    rows = {r.i: r for r in shaping.ledger_records(shaping.unwrap(d, "raw", "own"), ["own", shaping.EXPORT_TYPE]).collect()}
    assert len(rows) == len(raws)
    assert [rows[i].source_id for i in range(8)] == [None, None, None, None, None, None, "a", "b"]
    assert [rows[i].wrapped for i in (5, 6, 7)] == [False, True, False]
    assert set(rows[0].errors) == {"SOURCE_ID", "TIMESTAMP"} and rows[5].text == "unknown-agent performed unknown in unknown."
    import hashlib

    assert rows[6].content_sha256 == hashlib.sha256(b'{"id":"a","x":1.5}').hexdigest() and rows[0].content_sha256 is None


def test_deliberation_and_references_of_null(spark):
    d = made(spark, [(None,), ("{}",), ("[null, {}]",)], "raw string").select(
        shaping.deliberation(F.try_parse_json("raw"), F.lit("d")).alias("d"), shaping.public_references(F.try_parse_json("raw")).alias("r")
    )
    rows = d.collect()
    assert [r.d.status for r in rows] == ["not_recorded", "explicit", "not_recorded"] and rows[1].d.errors == ["SUMMARY"] and all(r.r == [] for r in rows)


def test_blinding(spark):
    rows = made(spark, [('{"label":1,"a":{"label":2}}',), ("[1]",), (None,)], "raw string").select(shaping.blinded(F.col("raw")).alias("b")).collect()
    assert [r.b for r in rows] == ['{"a":{"label":2}}', None, None]
    left = shaping.private_leaks(made(spark, [(1, '{"exposed_reasoning_refs":[{"owner":1}],"model":{"owner":2},"labels":[{"label":null}]}'), (2, None)], "i int, raw string"), "raw")
    assert codes(left) == [(1, "/labels/0/label"), (1, "/model")]


def test_consent_needs_every_part(spark):
    whole = {"status": "granted", "scopes": ["public_dataset_label"], "evidence_ref": "e", "granted_at": "2024-01-01T00:00:00Z"}
    faults = [whole, *[{k: v for k, v in whole.items() if k != gone} for gone in whole], {**whole, "status": "no"}, {**whole, "scopes": "public_dataset_label"}, {**whole, "granted_at": "x"}]
    d = made(spark, [(i, json.dumps(f)) for i, f in enumerate(faults)] + [(99, None)], "i int, raw string")
    assert [r.i for r in d.filter(shaping.consent(F.try_parse_json("raw")).isNotNull()).collect()] == [0]


def test_steps_of_null_and_empty(spark):
    d = made(spark, [(1, None), (2, "[]"), (3, "{}")], "i int, raw string").withColumn("v", F.try_parse_json("raw"))
    assert [len(r.c or []) for r in d.select(shaping.tool_calls(F.col("v")).alias("c")).collect()] == [0, 0, 0]
    assert shaping.patches(d.select("i", "v"), "v").count() == 0
    one = made(spark, [('[{"command":"c","exit_code":0,"output":"o"}]',)], "raw string").select(shaping.verifier_evidence(F.try_parse_json("raw")).alias("e")).first().e[0]
    assert (one.passed, one.error, one.name) == (True, None, "verifier-1")


def test_ticks_that_connect(spark):
    life = {
        "birth_event": {"observed_at": "2024-01-01T00:00:00Z", "initial_state": {"n": 0}},
        "ticks": [
            {"sequence": 0, "observed_at": "2024-01-01T00:00:01Z", "kind": "decision", "action": "go", "state_before": {"n": 0}, "state_after": {"n": 1, "world": "w"}, "m": [1, {"b": 2}]},
            {"sequence": 1, "observed_at": "2024-01-01T00:00:01Z", "kind": "idle", "state_before": {"n": 1, "world": "w"}, "state_after": 5, "world": "w"},
            {"sequence": 2, "observed_at": "2024-01-01T00:00:03Z", "kind": "decision", "action": "", "state_before": {"n": 2}, "state_after": {"n": 3, "world": "v"}, "world": "w", "m": ["x"]},
        ],
    }
    lives = made(spark, [("a", json.dumps(life)), ("b", None), ("c", "{}")], "agent_id string, raw string")
    rows = {r.sequence: r for r in shaping.ticks(lives, "raw").collect()}
    assert rows[0].errors == [] and rows[0].world == "w"
    assert rows[1].errors == ["TICK_TIME", "TICK_STATE", "TICK_IDLE_REASON"]
    assert rows[2].errors == ["STATE_CONTINUITY", "TICK_ACTION", "TICK_WORLD"]
    assert [tuple(r) for r in shaping.updates(lives, "raw", "m").orderBy("place").collect()] == [("a", 0, "1"), ("a", 1, '{"b":2}'), ("a", 2, '"x"')]


def test_recipe_reads_by_name_and_place(spark):
    d = made(spark, [(1, "it's", '{"m":{"it\'s":[5,6]},"a":null}'), (0, "x", None), (0, "", "{}"), (0, "a'\"?.", "{}")], "n int, name string, raw string")
    got = [tuple(r) for r in shaping.project(d, "raw", {"v": "/m/{name}/{n}", "all": "", "none": "/q/r", "null": "/a"}).collect()]
    assert got == [("6", '{"a":null,"m":{"it\'s":[5,6]}}', None, "null"), (None, None, None, None), (None, "{}", None, None), (None, "{}", None, None)]


# -- receipts


DESCRIPTOR = "receipt string, pos int, path string, artifactKind string, mediaType string, bytes long, sha256 string"


def test_receipts_that_are_right_and_wrong(spark):
    r = made(spark, [("a", "release", "approve_public", None, True, None), ("b", "nowhere", None, "p", None, "s")], "receipt string, scope string, disposition string, predecessor string, governed boolean, signature string")
    a = made(spark, [("a", 0, "p", "release-manifest", "m", 1, "x"), ("a", 1, "q", "active-review-set", "m", 1, "y"), ("b", 0, "p", "data-card", "m", 1, "x"), ("b", 1, "p", "data-card", "m", 1, "x")], DESCRIPTOR)
    e = made(spark, [("a", "one", 0, "p", "x"), ("a", "one", 1, "q", "y"), ("b", "one", 0, "q", "x"), ("b", "one", 1, "p", "x")], "receipt string, check string, pos int, path string, sha256 string")
    wrong = ["ARTIFACT_ORDER", "RECEIPT_EVIDENCE", "RECEIPT_EVIDENCE_ORDER", "RECEIPT_PREDECESSOR_UNTRACKED", "RECEIPT_REJECT", "RECEIPT_SCOPE", "SIGNED_APPROVAL_NOT_ENABLED"]
    assert codes(receipts.receipt_findings(r, a, e)) == [("b", c) for c in wrong]
    assert ("b", "SIGNED_APPROVAL_NOT_ENABLED") not in codes(receipts.receipt_findings(r, a, e, signed=True))
    assert codes(receipts.exact_closure(a, a)) == [] and codes(receipts.exact_closure(a, a.limit(3))) == [("b", "RECEIPT_ARTIFACT_CLOSURE")]
    assert receipts.receipt_findings(r.limit(0), a.limit(0), e.limit(0)).count() == 0


def test_dependencies_match_in_every_field(spark):
    a = made(spark, [("a", 0, "p", "k", "m", 1, "x"), ("b", 0, "q", "k", "m", 1, "x")], DESCRIPTOR)
    r = made(spark, [("a", "approve_public"), ("b", "reject")], "receipt string, disposition string")
    for column in receipts.RAW:
        other = a.withColumn(column, F.lit(7) if column == "bytes" else F.lit("zz"))
        assert receipts.dependency_findings(other.filter("receipt = 'a'"), a, r).count() == 1
    assert codes(receipts.dependency_findings(a, a, r)) == [("q", "BATCH_DEPENDENCY_REVIEW")]


# -- exemptions


def test_digests_are_exempt_in_their_places_only(spark):
    sha = "4111111111111111" + "ab" * 24
    address = f"objects/cards/sha256/41/{sha}.json"
    receipt = f"objects/review-receipts/sha256/41/{sha}.json"
    whole = {"path": address, "artifactKind": "k", "mediaType": "m", "bytes": 1, "sha256": sha, "reviewReceiptRef": receipt}
    docs = {
        1: {"schemaVersion": "lake.dataset-manifest/v2", "dataCard": whole, "shards": [whole]},
        2: {"schemaVersion": "lake.dataset-manifest/v1", "dataCard": whole},
        3: {"schemaVersion": "lake.dataset-manifest/v2", "dataCard": {k: v for k, v in whole.items() if k != "bytes"}},
        4: {"schemaVersion": "lake.dataset-manifest/v2", "dataCard": {**whole, "path": address.replace("/41/", "/42/")}},
        5: {"schemaVersion": "lake.active-review-set/v2", "heads": [{"path": address, "sha256": sha}]},
        6: {"schemaVersion": "lake.public-record/v2", "provenance": {"sources": [{"consentEvidence": {"artifactPath": address, "artifactSha256": sha, "summary": "s"}}]}},
        7: {"schemaVersion": "lake.catalog-release-pointer/v2", "previousReleasePointerSha256": sha},
        8: {"schemaVersion": "lake.release-manifest/v2", "policy": {"policyId": "lake-publication-trust", "path": exemptions.TRUST_POLICY, "sha256": sha}},
        9: {"schemaVersion": "lake.release-manifest/v2", "previousReleasePointerSha256": sha, "dataCard": whole},
    }
    d = made(spark, [(i, json.dumps(v), True) for i, v in docs.items()] + [(10, None, True), (11, "no", None)], "i int, raw string, ok boolean")
    got = {}
    for r in exemptions.scan_json(d, "i", "raw", "lake", "ok").collect():
        assert (r.code, r.part) == (exemptions.CARD_CODE, "value")
        got.setdefault(r.i, set()).add(r.path)
    card = {f"/dataCard/{n}" for n in ("path", "sha256", "reviewReceiptRef")}
    assert got == {2: card, 3: {"/dataCard/path", "/dataCard/sha256"}, 4: {"/dataCard/path"}, 9: card | {"/previousReleasePointerSha256"}}
    strict = exemptions.scan_json(d, "i", "raw", "lake")
    assert strict.filter("i = 7").count() == 1


# -- shards, manifests, catalogue


def test_key_order_across_shards(spark):
    rows = [("part-00000.jsonl", 0, 1), ("part-00000.jsonl", 1, 2), ("part-00001.jsonl", 0, 2), ("part-00001.jsonl", 1, 3), ("part-00003.jsonl", 0, 0)]
    lines = made(spark, rows, "path string, line_no long, key int")
    assert codes(sharding.key_order_findings(lines, "key")) == [("part-00001.jsonl", 0)]
    declared = made(spark, [("part-00000.jsonl", 1, 2), ("part-00001.jsonl", 1, 4), ("part-00009.jsonl", 0, 0)], "path string, first_key int, last_key int")
    assert codes(sharding.shard_edge_findings(lines, declared, "key")) == [("part-00001.jsonl", "SHARD_FIRST_KEY"), ("part-00001.jsonl", "SHARD_LAST_KEY"), ("part-00009.jsonl", "SHARD_MISSING")]


def test_manifest_header_summary_and_resolution(spark, tmp_path):
    raw = made(spark, [('{"id":1}',), ('{"id":2}',)], "raw string")
    rows, manifest = sharding.plan(raw, "raw", "lake")
    assert sharding.header_findings(manifest, "lake") == []
    assert sharding.summary(manifest)["records"] == 2
    wrong = {**manifest, "encoding": "latin-1", "lineMaxBytes": 10**9, "keyPath": ""}
    del wrong["lines"]
    assert sharding.header_findings(wrong, "lake") == ["HEADER_LIMIT:lineMaxBytes", "HEADER_MISSING:lines", "HEADER_VALUE:encoding", "HEADER_VALUE:keyPath"]
    assert "HEADER_SIZE:shardMaxBytes" in sharding.header_findings({**manifest, "shardMaxBytes": True}, "lake")
    folder = str(tmp_path / "out")
    jsonl.write_shards(rows, manifest, folder)
    for root, name in ((folder, "manifest.json"), (folder, f"{folder}/manifest.json"), (f"{folder}/manifest.json", "x")):
        assert jsonl.resolve_manifest(spark, root, name) == (folder, manifest)
    assert jsonl.resolve_manifest(spark, folder, manifest) == (folder, manifest)
    (tmp_path / "loose.json").write_text('{"a": 1}\n')
    with pytest.raises(ValueError):
        jsonl.resolve_manifest(spark, str(tmp_path), "loose.json")


def test_catalogue_and_split(spark, tmp_path):
    (tmp_path / "catalog.json").write_text(json.dumps({"datasets": [{"id": "a", "n": 1}, {"id": "b", "n": 2}]}, indent=2))
    (tmp_path / "latest.json").write_text(json.dumps({"release": {"id": "r"}}, indent=2))
    rows, latest = site.catalogue(spark, str(tmp_path))
    assert codes(rows) == [("a", 1), ("b", 2)] and latest == {"release": {"id": "r"}}
    d = made(spark, [(1, "x"), (2, None), (3, "y")], "i int, label string")
    a, b = str(tmp_path / "candidates"), str(tmp_path / "labels")
    jsonl.write_split(d, F.col("label") == "x", a, b)
    assert sorted(r.i for r in spark.read.json(a).collect()) == [2, 3] and [r.i for r in spark.read.json(b).collect()] == [1]


def test_report_codes_and_text(spark):
    none = publication.report(made(spark, [], "path string, code string"))
    some = publication.report(made(spark, [("a", "X", 3)], "path string, code string, line int"))
    assert [publication.exit_code(r) for r in (none, some, None)] == [0, 1, 2]
    assert publication.as_text(some) == "a:3:0 X\n1 findings" and publication.as_text(none) == "ok"


def test_ballots_need_whole_members(spark):
    m = made(spark, [(c, i, mode) for c, mode in ((1, "approved"), (2, "quorum_failure"), (3, "none")) for i in range(7)], "c int, m int, mode string").withColumn("p", F.lit(51))
    got = {}
    for r in council.ballots(m, "c", "m", "mode", "p", "p").orderBy("m").collect():
        got.setdefault(r.c, []).append(r.vote)
    assert got == {1: ["yes"] * 4 + ["no"] * 3, 2: ["yes"] * 3 + [None] * 4, 3: ["no"] * 7}


# -- checkpoints


def test_fingerprint_is_of_the_rows_not_their_order(spark):
    d = made(spark, [("a",), ("b",), (None,), ("a",)], "x string")
    first = checkpoints.fingerprint(d, "x")
    assert first == checkpoints.fingerprint(d.orderBy(F.desc("x")).repartition(3), "x")
    assert len({first, checkpoints.fingerprint(d.distinct(), "x"), checkpoints.fingerprint(d.limit(0), "x")}) == 3


def test_all_or_nothing(spark, tmp_path):
    d, made_of = made(spark, [("a",), ("b",)], "x string"), []
    file = str(tmp_path / "c.json")
    assert [checkpoints.once(spark, file, "d", d, "x", made_of.append) for _ in range(2)] == [True, False] and len(made_of) == 1
    for dataset, source in (("e", d), ("d", d.limit(1))):
        with pytest.raises(checkpoints.CheckpointMismatch):
            checkpoints.once(spark, file, dataset, source, "x", made_of.append)
    (tmp_path / "c.json").write_text("{")
    (tmp_path / ".c.json.crc").unlink(missing_ok=True)
    with pytest.raises(checkpoints.CheckpointMismatch, match="CHECKPOINT_INVALID"):
        checkpoints.load(spark, file)
    (tmp_path / "n.json.next").write_text("{")
    assert checkpoints.load(spark, str(tmp_path / "n.json")) is None
    checkpoints.save(spark, str(tmp_path / "n.json"), {"count": 1, "next_index": 2})
    with pytest.raises(checkpoints.CheckpointMismatch, match="CHECKPOINT_INDEX"):
        checkpoints.load(spark, str(tmp_path / "n.json"))


def test_a_run_goes_on_where_it_stopped(spark, tmp_path):
    folder = str(tmp_path / "run")
    make = lambda a, b: spark.range(a, b).withColumnRenamed("id", "n")
    assert checkpoints.run(spark, folder, "d", 1, 10, 4, make, most=1) == 4
    make(4, 6).write.parquet(f"{folder}/out/start={4:012d}")
    assert sorted(r.n for r in checkpoints.written(spark, folder).collect()) == [0, 1, 2, 3]
    with pytest.raises(checkpoints.CheckpointMismatch, match="CHECKPOINT_SEED"):
        checkpoints.run(spark, folder, "d", 2, 10, 4, make)
    assert checkpoints.run(spark, folder, "d", 1, 10, 4, make) == 10
    assert sorted(r.n for r in checkpoints.written(spark, folder).collect()) == list(range(10))


def test_dead_letters_hold_no_payload(spark):
    d = made(spark, [(1, "E", "secret"), (2, "F", None)], "i int, code string, payload string")
    out = checkpoints.dead_letters(d, "payload", "code", {"E": "split"}, "lake")
    assert "payload" not in out.columns
    assert [(r.i, r.retryable, r.recovery_action, r.input_bytes) for r in out.orderBy("i").collect()] == [(1, True, "split", 6), (2, False, "human_review", 0)]
    assert checkpoints.dead_letters(d, "payload", "code", {}, "lake").filter("retryable").count() == 0


# -- generators and files


def test_generated_records_hold_their_rules_and_faults_are_seen(spark):
    work = simulate.trajectories(spark, 3, 40)
    assert {r.status for r in work.collect()} == {"succeeded", "failed"} and datasets.trajectory_findings(work).count() == 0
    late = work.withColumn("completed_at", F.col("started_at"))
    assert {r.code for r in datasets.trajectory_findings(late).collect()} == {"CALL_INTERVAL"}
    faults = simulate.recoveries(spark, 3, 8)
    assert sorted(r.fault_type for r in faults.collect()) == sorted(simulate.FAULTS * 2)
    assert datasets.recovery_findings(faults.withColumn("fault_type", F.lit("none"))).count() == 8
    assert simulate.recoveries(spark, 3, 3, start=5).collect() == faults.filter("record_index >= 5").collect()
    nodes, edges = simulate.lineages(spark, 3, 30)
    assert nodes.filter(F.size("parents") == 2).count() > 0 and datasets.lineage_findings(nodes, edges).count() == 0
    assert {r.code for r in datasets.lineage_findings(nodes, edges.filter("relation = 'fork'")).collect()} == {"EDGE_SET"}
    two = simulate.counterfactuals(spark, 3, 5)
    assert {r.code for r in datasets.counterfactual_findings(two.withColumn("treatment_sha256", F.col("control_sha256"))).collect()} == {"TREATMENT_REPLAY"}


def test_files_over_the_cap_and_links_have_a_code(spark, tmp_path):
    folder = tmp_path / "a.b+c"
    folder.mkdir()
    for name, size in (("x y+%20.txt", 3), ("large", 9)):
        (folder / name).write_bytes(b"x" * size)
    (folder / "link").symlink_to(folder / "x y+%20.txt")
    assert codes(policy.artifact_findings(spark, str(folder), 5)) == [("large", "FILE_SIZE_LIMIT"), ("link", "SYMLINK_FORBIDDEN")]
    assert {r.path for r in policy.artifacts(spark, str(folder), 5).collect()} == {"x y+%20.txt"}


def test_gate_of_odd_files(spark):
    policy = publication.Policy(
        namespace="lake", sources={}, rights={}, safety={}, quality={}, fields={}, withdrawal={"tombstonePathPrefix": "gone/", "removalIndexPath": "removals.json"},
        publication={"policyVersion": "1", "limits": {"publicationFilesHard": 9, "pullRequestDiffHardBytes": 10}, "candidatePathPrefixes": ["data/"], "immutablePathPrefixes": ["data/kept/"]},
    )
    sha = "4111111111111111" + "ab" * 24
    pointer = json.dumps({"schemaVersion": "lake.catalog-release-pointer/v2", "previousReleasePointerSha256": sha}).encode()
    files = {"a.bin": b"x\0y", "b.txt": b"\xff", "c.jsonl": b"", "data/p.json": pointer, "data/q.json": pointer, "e.json": b'{"k": "' + b"415-555" + b'-2671"'}
    changes = made(spark, [("A", p, None) for p in [*files, "c.jsonl"]] + [("R100", "../f", "g")], "status string, path string, old_path string")
    contents = made(spark, list(files.items()), "path string, content binary")
    found, routed = gate.gate(changes, contents, policy, 11, made(spark, [("data/p.json",)], "path string"))
    assert codes(found.select("path", "code")) == sorted([
        ("../f", "FILE_MISSING"), ("../f", "PATH_UNSAFE"), (".", "PR_DIFF_LIMIT"), ("a.bin", "BINARY_FORBIDDEN"), ("b.txt", "TEXT_UTF8"),
        ("c.jsonl", "JSON_INVALID"), ("c.jsonl", "PATH_DUPLICATE"), ("data/q.json", "PII_PAYMENT_CARD"), ("e.json", "JSON_INVALID"), ("e.json", "PII_PHONE"),
    ])
    assert dict(codes(routed))["data/p.json"] == "formal"
    none, empty = gate.gate(changes.limit(0), contents.limit(0), policy)
    assert none.filter("path != '.'").count() == 0 and empty.count() == 0
