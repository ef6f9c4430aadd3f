"""Canonical text, fragments, layouts, shards and their verification."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import canonical, ids
from ledgerlake.operators import sharding as sh
from ledgerlake.sources import jsonl

NS = "test-ns"


def raw(spark, values):
    return spark.createDataFrame([(json.dumps(v),) for v in values], "raw string").repartition(3)


RECORDS = [{"id": f"record-{i:03d}", "payload": "x" * (70 + i % 11)} for i in range(30)]
LIMITS = sh.Limits(420, 600, 300, 300)


def reference_groups(sizes, target):
    if sum(sizes) <= target or len(sizes) == 1:
        return [len(sizes)]
    total = sum(sizes)
    best = min(range(1, len(sizes)), key=lambda i: (abs(total - 2 * sum(sizes[:i])), i))
    return reference_groups(sizes[:best], target) + reference_groups(sizes[best:], target)


def test_layout_is_the_recursive_halving_and_doesnt_depend_on_input_order(spark):
    rows, m = sh.plan(raw(spark, RECORDS), "raw", NS, limits=LIMITS)
    _, again = sh.plan(raw(spark, random.Random(1).sample(RECORDS, 30)), "raw", NS, limits=LIMITS)
    assert m == again
    lines = [canonical.canonical_text(r) for r in RECORDS]
    assert [s["records"] for s in m["shards"]] == reference_groups([len(x) + 1 for x in lines], 420)
    import hashlib

    assert m["contentHash"] == "sha256:" + hashlib.sha256("".join(x + "\n" for x in lines).encode()).hexdigest()
    assert m["shards"][0]["minKey"] == "record-000" and m["shards"][-1]["maxKey"] == "record-029"
    _, other = sh.plan(raw(spark, RECORDS), "raw", NS, limits=sh.Limits(800, 900, 300, 300))
    assert other["contentHash"] == m["contentHash"] and len(other["shards"]) < len(m["shards"])


def test_fragments_are_within_their_caps_and_go_back_together(spark, tmp_path):
    big = {"id": "big", "text": 'é"\\\n🎉' * 400}
    limits = sh.Limits(3000, 4000, 900, 300)
    rows, m = sh.plan(raw(spark, [*RECORDS[:3], big]), "raw", NS, limits=limits)
    lines = [r.line for r in rows.orderBy("pos").collect()]
    frags = [json.loads(x) for x in lines if '"data"' in x]
    assert all(len(x.encode()) + 1 <= 900 for x in lines) and all(f["utf8Bytes"] <= 300 for f in frags)
    assert "".join(f["data"] for f in frags) == canonical.canonical_text(big) and {f["count"] for f in frags} == {len(frags)}
    assert m["records"] == 4 and m["lines"] == 3 + len(frags)
    folder = f"file://{tmp_path}/out"
    jsonl.write_shards(rows, m, folder)
    back = jsonl.shard_lines(spark, folder)
    assert sh.verify(back, jsonl.read_manifest(spark, folder), NS).count() == 0
    bodies = {r.body for r in sh.logical_records(back, NS).collect()}
    assert bodies == {canonical.canonical_text(r) for r in [*RECORDS[:3], big]}


def test_boundaries_and_refusals(spark):
    with pytest.raises(ValueError):
        sh.Limits(700, 600)
    with pytest.raises(ValueError):
        sh.Limits(True)
    with pytest.raises(sh.ShardingError, match="KEY_MISSING"):
        sh.plan(raw(spark, [{"a": 1}]), "raw", NS)
    with pytest.raises(sh.ShardingError, match="RESERVED"):
        sh.plan(raw(spark, [{"id": 1, "schemaVersion": f"{NS}.artifact-fragment/v1"}]), "raw", NS)
    with pytest.raises(sh.ShardingError, match="too small"):
        sh.fragment("x" * 1000, "urn:a", sh.Limits(420, 600, 200, 200), NS)
    _, m = sh.plan(raw(spark, [{"a": 2}, {"a": 1}]), "raw", NS, key_path=None)
    assert m["shards"][0]["minKey"].startswith(f"urn:{NS}:record:sha256:")
    _, empty = sh.plan(raw(spark, RECORDS).limit(0), "raw", NS)
    assert empty["shards"] == [] and empty["records"] == 0


def test_resume_writes_what_is_missing_and_verify_finds_tampering(spark, tmp_path):
    rows, m = sh.plan(raw(spark, RECORDS), "raw", NS, limits=LIMITS)
    folder = tmp_path / "out"
    jsonl.write_shards(rows, m, f"file://{folder}")
    first = {p.name: p.read_bytes() for p in folder.iterdir() if p.suffix == ".jsonl"}
    (folder / "part-00001.jsonl").write_bytes(b"broken\n")
    (folder / "part-00099.jsonl").write_bytes(b"stale\n")
    (folder / ".part-00001.jsonl.crc").unlink(missing_ok=True)
    codes = {(r.path, r.code) for r in sh.verify(jsonl.shard_lines(spark, f"file://{folder}"), m, NS).collect()}
    assert ("part-00001.jsonl", "SHARD_HASH") in codes and ("part-00099.jsonl", "SHARD_UNDECLARED") in codes
    assert {"LINE_JSON_INVALID", "TOTAL_RECORDS"} <= {c for _, c in codes}
    assert jsonl.write_shards(rows, m, f"file://{folder}", resume=True) == ["part-00001.jsonl"]
    assert {p.name: p.read_bytes() for p in folder.iterdir() if p.suffix == ".jsonl"} == first
    key = '"record-010"'
    some = jsonl.pruned(spark, f"file://{folder}", m, key, key)
    assert some.filter(F.contains("line", F.lit("record-010"))).count() == 1 and some.select("path").distinct().count() == 1


@pytest.mark.parametrize(
    ("text", "mode", "error"),
    [
        ('{"a":1,"a":2}', "lake", "JSON_DUPLICATE_KEY"),
        ('{"a":NaN}', "lake", "JSON_NON_FINITE"),
        ("1e999", "lake", "JSON_NON_FINITE"),
        ('{"a":1} x', "lake", "JSON_INVALID"),
        ('"\\ud800"', "lake", "JSON_SURROGATE"),
        ('{"e\\u0301":1,"\\u00e9":2}', "lake", "JSON_KEY_COLLISION"),
        ("1.5", "formal", "JSON_FLOAT"),
        ("﻿1", "formal", "JSON_BOM"),
        ("[" * 65 + "]" * 65, "formal", "JSON_DEPTH"),
        ("[" * 100_000, "policy", "JSON_DEPTH"),
        (None, "lake", "JSON_NULL"),
    ],
)
def test_strict_parsing_refuses(spark, text, mode, error):
    row = spark.createDataFrame([(text,)], "t string").select(canonical.parsed("t", mode).alias("p")).first().p
    assert not row.ok and row.error == error and row.canonical is None


def test_canonical_text_sorts_by_code_point_and_normalises(spark):
    t = '{"\\ud83d\\ude00":1,"\\uff5e":2,"e\\u0301":[1.0,1e16,-0.0]}'
    row = spark.createDataFrame([(t,)], "t string").select(canonical.canonical_json("t").alias("c")).first()
    assert row.c == '{"é":[1.0,1e+16,-0.0],"～":2,"😀":1}'


def test_ids(spark):
    import hashlib

    row = spark.range(1).select(
        ids.stable_id("d01", F.lit('a"b')).alias("s"), ids.record_id("d06", F.lit(7), F.lit(12)).alias("r"), ids.json_string_digest(F.lit('x"\n')).alias("j"),
        ids.is_utc_timestamp(F.lit("2024-02-30T00:00:00Z")).alias("bad"), ids.is_utc_timestamp(F.lit("2024-02-29T00:00:00.5Z")).alias("good"),
    ).first()
    assert row.s == "d01-" + hashlib.sha256(b'["d01","a\\"b"]').hexdigest()[:20]
    assert row.r == "d06-000012-" + hashlib.sha256(b"7:12").hexdigest()[:12]
    assert row.j == hashlib.sha256(b'"x\\"\\n"').hexdigest()
    assert (row.bad, row.good) == (False, True)
