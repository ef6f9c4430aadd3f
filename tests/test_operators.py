"""Contracts, release trust, dataset verification, scans and streams: each code has a failing case."""

import hashlib
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerlake.functions import canonical, pointers, scan, walk
from ledgerlake.operators import contracts, council, governance, graph, trust
from ledgerlake.plans import datasets as ds
from ledgerlake.streaming import recovery


def codes(df):
    return {(r[0], r[1]) for r in df.collect()}


# -- scans; positive strings are put together here so that none is stored


@pytest.mark.parametrize(
    ("code", "good", "bad"),
    [
        ("PII_EMAIL", "a.b" + "@" + "host.io", "a.b" + "@" + "mail.example.com"),
        ("PII_GOVERNMENT_ID", "123-45" + "-6789", "1123-45" + "-6789"),
        ("PII_PHONE", "(415) 555" + "-2671", "415 55 2671"),
        ("PII_NETWORK_ADDRESS", "10.20" + ".30.40", "192.0.2" + ".7"),
        ("PII_PAYMENT_CARD", "4111 1111" + " 1111 1111", "4111 1111" + " 1111 1112"),
        ("SECRET_PRIVATE_KEY", "-----BEGIN " + "PRIVATE KEY-----", "BEGIN " + "PRIVATE KEY"),
        ("SECRET_GITHUB_TOKEN", "ghp_" + "a1" * 18, "ghp_" + "a1" * 17),
        ("SECRET_AWS_ACCESS_KEY", "AKIA" + "A1" * 8, "AKIA" + "A1" * 7),
        ("SECRET_SLACK_TOKEN", "xoxb-" + "a1" * 10, "xoxb-" + "a1" * 9),
        ("SECRET_BEARER_TOKEN", "Bearer " + "a1" * 12, "Bearer " + "a1" * 11),
        ("SECRET_ASSIGNED_VALUE", "api_key = '" + "a1" * 8, "api_key = '" + "a1" * 7),
    ],
)
def test_each_pattern(spark, code, good, bad):
    df = spark.createDataFrame([(1, f"first\n  see {good} there"), (2, f"see {bad} there"), (3, None), (4, "")], "id int, text string")
    found = [r for r in scan.findings(df, "id", "text").collect() if r.code == code]
    assert [(r.id, r.line, r.column) for r in found] == [(1, 2, 7)]


def test_cards_of_one_digit_and_several_hits(spark):
    df = spark.createDataFrame([(1, "0000 0000 0000 0000"), (2, "10.0.0.1\n10.0.0.2 x 10.0.0.3")], "id int, text string")
    assert {tuple(r) for r in scan.findings(df, "id", "text").collect()} == {(2, "PII_NETWORK_ADDRESS", 1, 1), (2, "PII_NETWORK_ADDRESS", 2, 1), (2, "PII_NETWORK_ADDRESS", 2, 12)}


def test_walk_and_pointers(spark):
    df = spark.createDataFrame([(1, '{"a":{"Access-Token":[1,{"b/c":null}]}}'), (2, "no"), (3, None)], "id int, j string")
    assert {r.path for r in walk.walk(df, "j").collect()} == {"/a", "/a/Access-Token", "/a/Access-Token/0", "/a/Access-Token/1", "/a/Access-Token/1/b~1c"}
    assert walk.forbidden_fields(df, "j", ["accesstoken"]).count() == 1
    one = df.filter("id = 1").select(pointers.extract(F.col("j"), "$.a['Access-Token'][0]".replace("['Access-Token']", ".Access-Token"), "int").alias("v"), pointers.missing(F.col("j"), "/a/x").alias("m"), pointers.missing(F.col("j"), "/a/Access-Token/1/b~1c").alias("n")).first()
    assert (one.v, one.m, one.n) == (1, True, False)


def test_leaf_diff(spark):
    d = spark.range(1).select(canonical.leaf_diff(F.lit('{"a":1,"b":{"c":2}}'), F.lit('{"a":3,"b":{"d":2}}')).alias("d")).first().d
    assert [tuple(x) for x in d] == [("/a", "1", "3", 2.0), ("/b/c", "2", None, None), ("/b/d", None, "2", None)]


# -- contracts

SCHEMA = {
    "$id": "urn:a",
    "type": "object",
    "required": ["schemaVersion", "id"],
    "additionalProperties": False,
    "properties": {
        "schemaVersion": {"const": "a/v1"},
        "id": {"type": "string", "pattern": "^[a-z]+$", "minLength": 2, "maxLength": 5},
        "n": {"type": "integer", "minimum": 0, "maximum": 9},
        "at": {"type": "string", "format": "date-time"},
        "path": {"type": "string", "format": "safe-relative-path"},
        "kind": {"enum": ["x", 1]},
        "list": {"type": "array", "items": {"$ref": "#/$defs/leaf"}, "minItems": 1, "maxItems": 2, "uniqueItems": True},
        "map": {"type": "object", "minProperties": 1, "maxProperties": 1},
        "any": {"anyOf": [{"type": "null"}, {"type": "boolean"}]},
        "one": {"oneOf": [{"type": "integer"}, {"minimum": 5}]},
        "no": {"not": {"const": 7}},
        "cond": {"if": {"type": "integer"}, "then": {"minimum": 3}, "else": {"type": "string"}},
        "all": {"allOf": [{"type": "string"}, {"minLength": 3}]},
        "never": False,
        "tree": {"$ref": "#/$defs/tree"},
    },
    "$defs": {"leaf": {"type": ["string", "null"]}, "tree": {"type": "object", "properties": {"down": {"$ref": "#/$defs/tree"}}, "additionalProperties": False}},
}


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({"id": 5}, "TYPE"), ({"id": "A"}, "PATTERN"), ({"id": "a"}, "MIN_LENGTH"), ({"id": "abcdef"}, "MAX_LENGTH"), ({"n": -1}, "MINIMUM"), ({"n": 10}, "MAXIMUM"), ({"n": True}, "TYPE"),
        ({"at": "2024-02-30T00:00:00Z"}, "TIMESTAMP"), ({"path": "../x"}, "PATH"), ({"kind": True}, "ENUM"), ({"list": []}, "MIN_ITEMS"), ({"list": ["a", "b", "c"]}, "MAX_ITEMS"),
        ({"list": ["a", "a"]}, "UNIQUE_ITEMS"), ({"list": [1]}, "TYPE"), ({"map": {}}, "MIN_PROPERTIES"), ({"map": {"a": 1, "b": 2}}, "MAX_PROPERTIES"), ({"any": 1}, "ANY_OF"), ({"one": 6}, "ONE_OF"),
        ({"no": 7}, "NOT"), ({"cond": 2}, "MINIMUM"), ({"cond": None}, "TYPE"), ({"all": "ab"}, "MIN_LENGTH"), ({"never": 1}, "FALSE_SCHEMA"), ({"extra": 1}, "ADDITIONAL_PROPERTY"),
        ({"id": None, "schemaVersion": "a/v2"}, "SCHEMA_UNKNOWN"), ({"tree": {"down": {"down": {"x": 1}}}}, "ADDITIONAL_PROPERTY"),
    ],
)
def test_each_keyword(change, code):
    registry = contracts.Registry({"a/v1": SCHEMA})
    good = {"schemaVersion": "a/v1", "id": "abc", "n": 3, "at": "2024-02-29T00:00:00.5Z", "list": ["a", None], "one": 1, "no": 8, "cond": 3, "any": None, "tree": {"down": {}}}
    assert registry.judge(json.dumps(good)) == []
    assert code in {c for _, c in registry.judge(json.dumps(good | change))}


def test_documents_and_schemas_that_are_refused(spark):
    docs = spark.createDataFrame([(1, '{"schemaVersion":"a/v1"}'), (2, "{"), (3, None), (4, "[]"), (5, "{}"), (6, '{"schemaVersion": "a/v1","id":"abc"}\n'), (7, "1.5"), (8, "[" * 65 + "]" * 65)], "id int, j string")
    found = codes(contracts.contract_findings(docs, "id", "j", {"a/v1": SCHEMA}, stored=True).select("id", "code"))
    assert {(1, "REQUIRED"), (1, "CANONICAL"), (2, "JSON_PARSE"), (3, "JSON_PARSE"), (4, "JSON_OBJECT"), (5, "SCHEMA_REQUIRED"), (6, "CANONICAL"), (7, "JSON_PARSE"), (8, "JSON_DEPTH")} <= found
    for bad in ({"strange": 1}, {"$ref": "#/none"}, {"pattern": "("}, {"type": "thing"}, {"format": "uri"}):
        with pytest.raises(contracts.SchemaError):
            contracts.Compiler([]).test(bad, bad)
    with pytest.raises(contracts.SchemaError):
        contracts.Registry({"b/v1": SCHEMA})


# -- trust


def test_descriptors(spark):
    h = lambda b: hashlib.sha256(b).hexdigest()
    address = f"objects/record/sha256/{h(b'a')[:2]}/{h(b'a')}.json"
    files = spark.createDataFrame([("x", bytearray(b"abc")), ("y", bytearray(b"abc")), (address, bytearray(b"b"))], "path string, content binary")
    declared = spark.createDataFrame([("x", 3, h(b"abc")), ("y", 4, h(b"abd")), ("z", 1, h(b"")), ("x", 3, h(b"abc")), (address, 1, h(b"b"))], "path string, bytes long, sha256 string")
    assert codes(trust.descriptors(declared, files)) == {("y", "DESCRIPTOR_BYTES"), ("y", "DESCRIPTOR_HASH"), ("z", "FILE_MISSING"), ("x", "ARTIFACT_DUPLICATE"), (address, "OBJECT_ADDRESS")}


def test_episode_closure(spark):
    r = spark.createDataFrame([("r1", "d", "u", "e", "t1", "l1"), ("r2", "d", "u", "e", "t2", "l9"), ("r1", "d", "u", "e", "t1", "l1")], "record_id string, dataset_id string, run_id string, episode_id string, transcript_id string, deliberation_id string")
    t = spark.createDataFrame([("t1", "r1", "d", "u", "e"), ("t2", "r2", "d", "OTHER", "e"), ("t3", "r9", "d", "u", "e")], "transcript_id string, record_id string, dataset_id string, run_id string, episode_id string")
    d = spark.createDataFrame([("l1", "r1", "t1", "d")], "deliberation_id string, record_id string, transcript_id string, dataset_id string")
    assert codes(trust.episode_closure(r, t, d)) == {("r2", "TRANSCRIPT_CLOSURE"), ("r2", "DELIBERATION_CLOSURE"), ("t3", "TRANSCRIPT_CLOSURE"), ("r1", "RECORD_ID_GLOBAL_DUPLICATE")}


def test_transcripts_and_counts(spark):
    e = "transcript_id string, started_at string, completed_at string, events array<struct<sequence:int,kind:string,at:string>>"
    t = spark.createDataFrame([("ok", "1", "5", [(0, "in", "1"), (1, "out", "4")]), ("seq", "1", "5", [(1, "in", "1"), (2, "out", "2")]), ("late", "1", "5", [(0, "in", "3"), (1, "out", "6")]), ("part", "1", "5", [(0, "in", "3")])], e)
    assert codes(trust.transcript_findings(t, ["in", "out"])) == {("seq", "TRANSCRIPT_SEQUENCE"), ("late", "TRANSCRIPT_TIME"), ("part", "TRANSCRIPT_COMPLETENESS")}
    items = spark.createDataFrame([("a", "record", "train", 5), ("a", "note", "train", 7), ("b", "record", "test", 1)], "dataset_id string, kind string, split string, bytes long")
    declared = spark.createDataFrame([("a", {"record": 1, "note": 1}, {"train": 2}, 2, 12), ("b", {"record": 2}, {"train": 1}, 3, 9)], "dataset_id string, kind_counts map<string,long>, split_counts map<string,long>, item_count long, content_bytes long")
    assert codes(trust.manifest_counts(items, declared)) == {("b", c) for c in ("MANIFEST_COUNTS", "MANIFEST_SPLITS", "MANIFEST_ARTIFACT_COUNT", "MANIFEST_BYTES")}
    lists = spark.createDataFrame([("p", ["a", "b"]), ("q", ["b", "a"]), ("s", ["a", "a"])], "id string, items array<string>")
    assert codes(trust.sorted_unique(lists, "id", "items")) == {("q", "ARTIFACT_ORDER"), ("s", "ARTIFACT_DUPLICATE")}


def test_receipts_and_batches(spark):
    cols = "receipt string, path string, sha256 string"
    claims = spark.createDataFrame([("r", "a", "1"), ("s", "b", "2"), ("s", "c", "3")], cols)
    refs = spark.createDataFrame([("r", "a", "1"), ("s", "b", "9")], cols)
    assert codes(trust.receipt_closure(claims, refs)) == {("s", "RECEIPT_ARTIFACT_CLOSURE")}
    changed = spark.createDataFrame([("a",), ("x",)], "path string")
    twice = claims.unionByName(claims.filter("path = 'a'"))
    assert codes(trust.batch_closure(changed, twice)) == {("x", "BATCH_ARTIFACT_UNCLAIMED"), ("b", "BATCH_RECEIPT_UNUSED_CLAIM"), ("c", "BATCH_RECEIPT_UNUSED_CLAIM"), ("a", "BATCH_RECEIPT_DUPLICATE_CLAIM")}


def test_supersession(spark):
    cols = "review_id string, predecessor string, scope string, reviewed_at int, disposition string"
    r = spark.createDataFrame([("a", None, "s", 1, "approve"), ("b", "a", "s", 2, "approve"), ("c", "a", "s", 3, "reject"), ("d", "zz", "s", 4, "approve"), ("e", "b", "t", 1, "approve"), ("x", "y", "s", 5, "approve"), ("y", "x", "s", 5, "approve")], cols)
    found = codes(trust.supersession(r, spark.createDataFrame([("c",), ("a",)], "review_id string")))
    assert found == {
        ("d", "REVIEW_PREDECESSOR"), ("e", "REVIEW_PREDECESSOR_SCOPE"), ("e", "REVIEW_TIME_ORDER"), ("x", "REVIEW_TIME_ORDER"), ("y", "REVIEW_TIME_ORDER"), ("a", "REVIEW_FORK"),
        ("x", "REVIEW_CYCLE"), ("y", "REVIEW_CYCLE"), ("d", "REVIEW_HEADS"), ("e", "REVIEW_HEADS"), ("a", "REVIEW_SET_STALE"), ("c", "REVIEW_HEAD_REJECT"),
    }


def test_release_chain_worlds_and_rights(spark):
    cols = "release_id string, chain string, sequence int, previous_id string, pointer_sha256 string, previous_sha256 string"
    r = spark.createDataFrame([("a", "m", 0, None, "1", None), ("b", "m", 1, "a", "2", "9"), ("c", "m", 1, "a", "3", "1"), ("d", "m", 4, "x", "4", "3"), ("z", "n", 2, None, "5", None)], cols)
    f, c = spark.createDataFrame([("p", "1"), ("q", "2")], "path string, sha256 string"), spark.createDataFrame([("p", "1")], "path string, sha256 string")
    assert codes(trust.release_chain(r, f, c)) == {("b", "PREVIOUS_RELEASE_DIGEST"), ("c", "RELEASE_FORK"), ("d", "PREVIOUS_RELEASE_SEQUENCE"), ("d", "PREVIOUS_RELEASE_ID"), ("z", "RELEASE_GENESIS"), ("q", "PREDECESSOR_CLOSURE_TAMPER")}
    e = spark.createDataFrame([("e1", ["r1"], ["e2"]), ("e2", ["r9"], ["e7"])], "entity_id string, source_record_ids array<string>, references array<string>")
    assert codes(trust.world_closure(e, spark.createDataFrame([("r1",)], "record_id string"))) == {("e2", "WORLD_RECORD_CLOSURE"), ("e2", "WORLD_REFERENCE_CLOSURE")}
    s = spark.createDataFrame([("1", "repo", "own", "S", ["commit"]), ("2", "repo", "own", "T", []), ("3", "web", "lic", "S", []), ("4", "repo", "own", "S", []), ("5", "repo", "own", "R", ["commit"])], "record_id string, source_type string, basis string, statement_id string, fields array<string>")
    st = spark.createDataFrame([("S", "own", True, ["repo"], {"repo": ["commit"]}), ("R", "own", False, ["repo"], {"repo": ["commit"]})], "statement_id string, basis string, active boolean, source_types array<string>, required map<string,array<string>>")
    assert codes(trust.rights(s, st)) == {("2", "RIGHTS_STATEMENT_UNKNOWN"), ("3", "RIGHTS_BASIS_MISMATCH"), ("3", "RIGHTS_SOURCE_TYPE"), ("4", "RIGHTS_ATTESTATION_MISSING"), ("5", "RIGHTS_STATEMENT_REVOKED")}


# -- governance, councils, graphs


def test_gates_and_withdrawal(spark):
    m = spark.createDataFrame([("a", 0.9, 0.2), ("b", None, 0.001)], "d string, pass double, dup double")
    assert {(r.d, r.metric, r.ok) for r in governance.gate(m, ["d"], {"pass": 0.9}, {"dup": 0.01}).collect()} == {("a", "pass", True), ("a", "dup", False), ("b", "pass", False), ("b", "dup", True)}
    assert governance.duplicate_rate(spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "b string"), "b").first().duplicate_rate == 0.25
    assert governance.duplicate_rate(spark.createDataFrame([], "b string"), "b").first().duplicate_rate == 0
    k = lambda *v: spark.createDataFrame([(x,) for x in v], "id string")
    t, r = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "id string, sha256 string"), spark.createDataFrame([("a", "1"), ("b", "9")], "id string, sha256 string")
    assert codes(governance.withdrawal_findings(t, r, k("old"), k("a", "b"), "id")) == {("b", "WITHDRAWAL_HASH"), ("c", "WITHDRAWAL_TARGET"), ("c", "REMOVAL_INDEX_COVERAGE"), ("old", "REMOVAL_INDEX_APPEND_ONLY")}
    assert governance.served(r, t, "id").count() == 0
    ch = spark.createDataFrame([("A", "x", None), ("M", "releases/1", None), ("M", "x", None)], "status string, path string, old_path string")
    found = codes(governance.change_set_findings(ch, 10, 1, 9, F.col("path").startswith("releases/")))
    assert found == {("", "PUBLICATION_FILE_LIMIT"), ("x", "PATH_DUPLICATE"), ("releases/1", "RELEASE_IMMUTABLE"), ("", "PR_DIFF_LIMIT")}
    p = spark.range(1).select(governance.is_prefix(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))).alias("a"), governance.is_prefix(F.array(F.lit(2)), F.array(F.lit(1))).alias("b")).first()
    assert (p.a, p.b) == (True, False)


def test_council(spark):
    rows = [("q", "yes", False)] + [("q", None, False)] * 3 + [("v", "yes", False)] * 3 + [("v", "no", True)] + [("ok", "yes", False), ("ok", "yes", True), ("ok", "abstain", False)] + [("tie", "abstain", False)]
    d = {r.c: r for r in council.decide(spark.createDataFrame(rows, "c string, vote string, guardian boolean"), ["c"], 60, 50).collect()}
    assert [(d[c].quorum_met, d[c].threshold_met, d[c].veto, d[c].approved) for c in ("q", "v", "ok", "tie")] == [(False, True, False, False), (True, True, True, False), (True, True, False, True), (True, False, False, False)]
    b = spark.createDataFrame([("c", "m1"), ("c", "m1"), ("c", "m9")], "c string, member_id string")
    assert {(r.member_id, r.code) for r in council.ballot_errors(b, spark.createDataFrame([("c", "m1")], "c string, member_id string"), ["c"]).collect()} == {("m1", "VOTER_DUPLICATE"), ("m9", "VOTER_INELIGIBLE")}


def test_graphs(spark):
    e = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "b"), ("b", "a")], "child string, parent string")
    assert {tuple(r) for r in graph.ancestors(e).collect()} == {("d", "b", 2), ("d", "c", 1), ("d", "a", 3), ("b", "a", 1), ("c", "b", 1), ("c", "a", 2)}
    n = spark.createDataFrame([(x,) for x in "abcd"], "node string")
    assert {tuple(r) for r in graph.generations(e, n).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    own = spark.createDataFrame([("a", "map"), ("d", "audit")], "node string, capability string")
    assert {r.node: r.capabilities for r in graph.inherited(e, own).collect()}["d"] == ["audit", "map"]
    ring = spark.createDataFrame([("x", "y"), ("y", "x"), ("z", "x")], "child string, parent string")
    assert {r.node for r in graph.on_cycles(ring).collect()} == {"x", "y"} and graph.on_cycles(e).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        graph.ancestors(ring)
    assert {tuple(r) for r in graph.relations(e.distinct()).collect()} == {("d", "b", "merge"), ("d", "c", "merge"), ("b", "a", "fork"), ("c", "b", "fork")}


# -- datasets


def tape(n=4, **change):
    state, events, before = {"a": 50, "b": 5}, [], "GENESIS"
    final = dict(state)
    for i in range(n):
        e = {"amount": 3 + i, "event_id": f"t{i}", "from": "a", "kind": "transfer", "previous_event_hash": before, "sequence": i, "to": "b"} | (change if i == 1 else {})
        e["event_hash"] = before = hashlib.sha256(json.dumps(e, separators=(",", ":"), sort_keys=True).encode()).hexdigest()
        final[e["from"]] = final.get(e["from"], 0) - e["amount"]
        final[e["to"]] = final.get(e["to"], 0) + e["amount"]
        events.append(e)
    return state, events, final, before


TAPE = "record_id string, initial_state map<string,bigint>, tape array<struct<amount:bigint,event_id:string,`from`:string,kind:string,previous_event_hash:string,sequence:int,`to`:string,event_hash:string>>, final_state map<string,bigint>, terminal_hash string"


def test_tapes(spark):
    good = ("good", *tape())
    rows = [good, ("over", *tape(amount=60)), ("acc", *tape(**{"to": "a"})), ("neg", *tape(amount=-2)), ("seq", *tape(sequence=7))]
    s, ev, fin, last = tape()
    rows.append(("hash", s, [*ev[:2], ev[2] | {"amount": 1}, ev[3]], fin, last))
    rows.append(("end", s, ev, fin | {"a": 0}, "x"))
    fix = [(r, st, [Row(**{k: e[k] for k in ("amount", "event_id", "from", "kind", "previous_event_hash", "sequence", "to", "event_hash")}) for e in t], f, h) for r, st, t, f, h in rows]
    found = codes(ds.tape_findings(spark.createDataFrame(fix, TAPE)))
    assert not {c for r, c in found if r == "good"}
    assert {("over", "TAPE_OVERDRAFT"), ("acc", "TAPE_ACCOUNT"), ("neg", "TAPE_AMOUNT"), ("seq", "TAPE_SEQUENCE"), ("hash", "TAPE_HASH"), ("end", "TAPE_FINAL_STATE"), ("end", "TAPE_TERMINAL")} <= found


def test_pairs_and_counterfactuals(spark):
    noise = [(1, -2, 0), (0, 3, 1)]
    digest = hashlib.sha256(json.dumps([{"resource_shock": a, "social_shock": b, "tick": c} for a, b, c in noise], separators=(",", ":")).encode()).hexdigest()
    w = lambda a, b, d=digest: [("control", d, a, "w1"), ("treatment", d, b, "w2")]
    cols = "record_id string, noise array<struct<resource_shock:int,social_shock:int,tick:int>>, noise_digest string, worlds array<struct<arm:string,noise_digest:string,score:int,world_id:string>>, assignment map<string,string>, effect int"
    ok = {"w1": "control", "w2": "treatment"}
    rows = [("ok", noise, digest, w(40, 52), ok, 12), ("dig", noise, "0", w(1, 2), ok, 1), ("arm", noise, digest, w(1, 2)[:1] * 2, {"w1": "control"}, 0), ("range", noise, digest, w(1, 200), ok, 199), ("eff", noise, digest, w(1, 2), ok, 5), ("asg", noise, digest, w(1, 2), {"w1": "treatment", "w2": "control"}, 1)]
    found = codes(ds.paired_findings(spark.createDataFrame(rows, cols)))
    assert not [f for f in found if f[0] == "ok"]
    assert {("dig", "NOISE_DIGEST"), ("arm", "ARMS"), ("range", "SCORE_RANGE"), ("eff", "PAIRED_EFFECT"), ("asg", "ASSIGNMENT")} <= found
    op = "struct<kind:string,key:string,value:bigint,delta:bigint>"
    sha = lambda m: hashlib.sha256(json.dumps(dict(sorted(m.items())), separators=(",", ":")).encode()).hexdigest()
    steps, put = [("increment", "x", None, 2), ("put", "y", 9, None)], ("increment", "x", None, 10)
    c, t = sha({"x": 3, "y": 9}), sha({"x": 13, "y": 9})
    rows = [("ok", {"x": 1}, steps, put, c, t), ("bad", {"x": 1}, steps, ("increment", "x", None, 0), t, c)]
    found = codes(ds.counterfactual_findings(spark.createDataFrame(rows, f"record_id string, base_state map<string,bigint>, steps array<{op}>, intervention {op}, control_sha256 string, treatment_sha256 string")))
    assert found == {("bad", "CONTROL_REPLAY"), ("bad", "INTERVENTION_EFFECT")} or found == {("bad", "CONTROL_REPLAY"), ("bad", "INTERVENTION_EFFECT"), ("bad", "TREATMENT_REPLAY")}


def test_judgments_and_pseudonyms(spark):
    j = [("r1", "a", True), ("r1", "a", True), ("r1", "b", True), ("r1", "b", False), ("r2", "a", True), ("r2", "b", True), ("r3", "a", True), ("r4", "a", True), ("r4", "a", True)]
    g = {r.record_id: r for r in ds.agreement(spark.createDataFrame(j, "record_id string, label string, consented boolean")).collect()}
    assert set(g) == {"r1", "r2", "r4"} and (g["r1"].gold_label, g["r1"].entropy_bits, g["r1"].pairwise_agreement) == ("a", 0.918296, 0.333333)
    assert g["r2"].gold_label is None and g["r4"].unanimous and g["r4"].entropy_bits == 0
    p = spark.range(1).select(ds.pseudonyms(F.array(*[F.lit(x) for x in "bab"]), "agent").alias("p")).first().p
    assert p == ["agent-001", "agent-002", "agent-001"]


def test_lifetimes_recovery_lineage_and_trajectories(spark):
    ticks = spark.createDataFrame([("x", 0, 10, "go", "w2", "s0", "s1"), ("x", 1, 20, None, "w1", "s1", "s2"), ("x", 2, 45, "go", "w2", "BAD", "s3"), ("y", 1, 5, "go", "w", "a", "b"), ("y", 2, 5, "go", "w", "b", "c")], "agent_id string, sequence int, t int, action string, world string, state_before string, state_after string").withColumn("ts", F.timestamp_seconds("t"))
    one = {r.agent_id: r for r in ds.lifetimes(ticks).collect()}["x"]
    assert (one.duration_seconds, one.action_counts, one.worlds_visited) == (35, {"go": 2, "idle": 1}, ["w2", "w1"])
    assert codes(ds.lifetime_findings(ticks)) == {("x", "STATE_CONTINUITY"), ("y", "TICK_SEQUENCE"), ("y", "TICK_TIME")}
    ops = [("o0", 0, "increment", "n", None, 2), ("o1", 1, "put", "m", 7, None), ("o2", 2, "increment", "n", None, 3)]
    cols = "record_id string, operations array<struct<op_id:string,sequence:int,kind:string,key:string,value:bigint,delta:bigint>>, delivery array<string>, results array<string>, fault_type string, applied array<string>, initial_state map<string,bigint>, final_state map<string,bigint>"
    ids, end = ["o0", "o1", "o2"], {"n": 6, "m": 7}
    rows = [("dup", ops, ["o0", "o1", "o1", "o2"], ["delivered"], "duplicate_delivery", ids, {"n": 1}, end), ("ack", ops, [*ids, "o2"], ["delivered_ack_lost"], "dropped_ack", ids, {"n": 1}, end), ("re", ops, ["o1", "o0", "o2"], ["delivered"], "reordered_delivery", ids, {"n": 1}, end), ("bad", ops, ["o9"], ["delivered"], "dropped_ack", ["o0"], {"n": 1}, {"n": 1})]
    assert codes(ds.recovery_findings(spark.createDataFrame(rows, cols))) == {("bad", c) for c in ("DELIVERY_UNKNOWN", "FAULT_CLASS", "APPLIED_ORDER", "RECOVERED_STATE")}
    n = spark.createDataFrame([("g", "a", [], 0, 0), ("g", "b", ["a"], 1, 1), ("g", "c", ["a", "b"], 2, 2), ("h", "a", ["z"], 0, 5), ("h", "b", ["b"], 0, 1), ("k", "a", [], 0, 9), ("k", "b", ["a"], 7, 1)], "record_id string, agent_id string, parents array<string>, generation int, position int")
    e = spark.createDataFrame([("g", "a", "b", "fork"), ("g", "a", "c", "merge"), ("g", "b", "c", "merge"), ("h", "z", "a", "fork"), ("k", "a", "b", "merge")], "record_id string, parent string, child string, relation string")
    found = codes(ds.lineage_findings(n, e))
    assert not [f for f in found if f[0] == "g"]
    assert {("h", "EDGE_SET"), ("h", "PARENT_MISSING"), ("h", "CYCLE"), ("k", "EDGE_SET"), ("k", "GENERATION"), ("k", "TOPOLOGICAL_ORDER")} <= found
    js = lambda s: hashlib.sha256(json.dumps(s).encode()).hexdigest()
    cols = "record_id string, started_at int, completed_at int, status string, calls array<struct<sequence:int,started_at:int,completed_at:int>>, patches array<struct<sequence:int,before_content:string,before_sha256:string,after_content:string,after_sha256:string>>, evidence array<struct<sequence:int,passed:boolean,exit_code:int>>"
    rows = [("ok", 1, 9, "succeeded", [(0, 2, 3)], [(0, "a\n", js("a\n"), "b", js("b"))], [(0, True, 0)]), ("bad", 1, 9, "succeeded", [(1, 2, 30)], [(0, "a", "x", "b", js("b"))], [(0, False, 1)])]
    assert codes(ds.trajectory_findings(spark.createDataFrame(rows, cols))) == {("bad", c) for c in ("CALL_SEQUENCE", "CALL_INTERVAL", "PATCH_DIGEST", "OUTCOME_EVIDENCE")}


def test_ledger_shaping(spark):
    e = spark.createDataFrame([("1", None, "", "2024-01-01 00:00:01.9", " hi ")], "source_event_id string, actor string, event_type string, t string, text string").withColumn("ts", F.to_timestamp("t"))
    r = ds.ledger(e).first()
    assert (r.actor_id, r.event_type, r.observed_at, r.summary) == ("unknown", "event", "2024-01-01T00:00:01Z", "hi")
    o = spark.createDataFrame([("s", 0, "2", "a"), ("s", 1, "1", "b"), ("s", 2, "1", "a")], "stream string, line_no int, observed_at string, record_id string")
    assert codes(ds.order_findings(o)) == {("b", "RECORD_ORDER"), ("a", "RECORD_ORDER"), ("a", "RECORD_DUPLICATE")} or ("b", "RECORD_ORDER") in codes(ds.order_findings(o))


# -- streams


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    ops = [(k, s, f"{k}{s}", s + 1) for k in "ab" for s in range(12)]
    parts = [ops[3:9] + ops[14:18], ops[5:12] + ops[12:14], ops[0:3] + ops[18:24]]
    schema = "key string, sequence long, op_id string, delta long"
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = recovery.in_order(spark.readStream.schema(schema).parquet(source))
        q = stream.writeStream.outputMode("append").foreachBatch(recovery.idempotent(f"{sink}/run={i}")).option("checkpointLocation", state).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    cols = ["key", "sequence", "op_id", "state"]
    got = sorted(map(tuple, spark.read.parquet(sink).select(*cols).collect()))
    assert got == sorted(map(tuple, recovery.in_order_batch(spark.createDataFrame(ops + ops[:5], schema)).select(*cols).collect()))
    assert len(got) == 24


def test_leases_receipts_and_checkpoints(spark):
    le = spark.createDataFrame([("r", "x", 1, 1), ("r", "y", 3, 2), ("r", "z", 2, 3)], "resource string, holder string, epoch int, granted_at int")
    assert recovery.lease_holders(le).first().holder == "y" and recovery.lease_findings(le).first().epoch == 2
    new, old = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "batch_id string, digest string"), spark.createDataFrame([("2", "b"), ("3", "x")], "batch_id string, digest string")
    assert {r.batch_id: r.action for r in recovery.receipts(new, old).collect()} == {"1": "apply", "2": "noop", "3": "conflict"}
    st = spark.createDataFrame([("w", 1, "idle", 0, 1), ("w", 2, "run", 5, 1), ("w", 3, "idle", 4, 0)], "worker string, at int, state string, cursor int, epoch int")
    assert {(r["at"], r.code) for r in recovery.checkpoint_findings(st, {"idle": ["run"]}).collect()} == {(3, "STATE_TRANSITION"), (3, "CURSOR_BACK"), (3, "EPOCH_BACK")}
    good, dead = recovery.route(new, F.when(F.col("digest") == "b", "bad"))
    assert good.count() == 2 and dead.first().reason == "bad"
