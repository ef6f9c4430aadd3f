"""Small sources, the catalogue page, file findings, and simulated records that verify."""

import subprocess

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import scan
from ledgerlake.operators import council
from ledgerlake.plans import datasets, queries, simulate
from ledgerlake.sources import jsonl, policy, site


def test_changes_between_revisions(spark, tmp_path):
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=a", "-c", "user.email=a", *a], check=True, capture_output=True)
    git("init", "-q")
    for name, text in (("a", "1\n" * 50), ("b", "2\n")):
        (tmp_path / name).write_text(text)
    git("add", "-A"), git("commit", "-qm", "x")
    git("mv", "a", "c"), (tmp_path / "b").write_text("3\n"), git("add", "-A"), git("commit", "-qm", "y")
    df, size = policy.git_changes(spark, str(tmp_path), "HEAD~1")
    assert {tuple(r) for r in df.collect()} == {("R", "c", "a"), ("M", "b", None)} and size > 0
    assert policy.git_blob(str(tmp_path), "HEAD~1", "b") == b"2\n" and policy.git_blob(str(tmp_path), "HEAD~1", "zz") is None and policy.git_blob(str(tmp_path), "HEAD", "c", 5) is None


def test_policies_and_registries(tmp_path):
    (tmp_path / "p.json").write_text('{"policyVersion":"1"}\n')
    (tmp_path / "q.json").write_text('{"policyVersion": "2"}\n')
    assert policy.load_documents(str(tmp_path), ["p.json"], canonical=True)
    for names, canonical in ((["p.json", "q.json"], False), (["q.json"], True)):
        with pytest.raises(ValueError):
            policy.load_documents(str(tmp_path), names, canonical)
    assert policy.check_policy({"default": "deny", "n": 5, "r": ["a"]}, caps={"n": 5}, rosters={"r": {"a"}}) == []
    assert policy.check_policy({"default": "allow", "n": True, "r": []}, caps={"n": 5}, rosters={"r": {"a"}}) == ["POLICY_DEFAULT", "POLICY_CAP:n", "POLICY_ROSTER:r"]
    (tmp_path / "x.schema.json").write_text('{"properties":{"schemaVersion":{"const":"x/v1"}}}')
    assert policy.load_registry(str(tmp_path), {"x/v1": "x.schema.json"}).judge('{"schemaVersion":"x/v1"}') == []
    with pytest.raises(ValueError):
        policy.load_registry(str(tmp_path), {})


def test_page_escapes_sorts_and_separates(spark):
    df = spark.createDataFrame([("b<", 1234567), ("a&", None)], "name string, n long")
    out = site.page("T<", df, ["name", "n"], ["name"])
    assert out.index("a&amp;") < out.index("b&lt;") and "1,234,567" in out and "<title>T&lt;</title>" in out
    with pytest.raises(ValueError):
        site.page("T", df, ["name"], ["name"], most=1)


def test_file_findings(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"a":1}\n\n{"a":}\n' + b"[" * 65 + b"]" * 65 + b"\n" + b'"' + b"x" * 99 + b'"')
    (tmp_path / "b.txt").write_bytes(b"\xff\x00")
    found = {(r.path[-5:], r.line_no, r.code) for r in jsonl.file_findings(spark, f"file://{tmp_path}", max_line=90 + 50).collect()}
    assert found == {("jsonl", None, "JSONL_LF"), ("jsonl", 1, "JSONL_EMPTY_LINE"), ("jsonl", 2, "JSON_INVALID"), ("jsonl", 3, "JSON_DEPTH"), ("b.txt", None, "TEXT_UTF8"), ("b.txt", None, "BINARY_FORBIDDEN")}
    lines = spark.createDataFrame([("p", 0, '{"b":1, "a":2}'), ("p", 1, " "), ("p", 2, "[1]"), ("p", 3, "x")], "path string, line_no long, line string")
    assert {(r.line_no, r.canonical, r.error) for r in jsonl.records(lines).collect()} == {(0, '{"a":2,"b":1}', None), (2, "[1]", "JSON_OBJECT"), (3, None, "JSON_INVALID")}


def test_simulated_records_repeat_resume_and_verify(spark):
    pairs, tapes = simulate.pairs(spark, 7, 20), simulate.tapes(spark, 7, 20)
    assert datasets.paired_findings(pairs).count() == 0
    assert datasets.tape_findings(tapes).count() == 0
    assert tapes.select(F.size("tape")).first()[0] == 12
    again = simulate.tapes(spark, 7, 10, start=10)
    assert {r.terminal_hash for r in again.collect()} <= {r.terminal_hash for r in tapes.collect()}
    assert simulate.pending(spark, pairs.filter("record_index < 15"), "d06", 7, 20).count() == 5
    d = council.decide(simulate.councils(spark, 3, 30), ["record_id"], 60, 60).collect()
    assert len(d) == 30 and all(r.eligible == 9 for r in d) and len({r.approved for r in d}) == 2


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = queries.QUERIES[name](spark, folder)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want))


def test_personal_data_is_counted_as_in_sql(spark, tmp_path):
    import duckdb

    good, wrong = "4111 1111" + " 1111 1111", "4111 1111" + " 1111 1112"
    texts = {
        "one separator between cards": (f"{wrong} {good}", "PII_PAYMENT_CARD", 0),
        "two separators": (f"{wrong}, {good}", "PII_PAYMENT_CARD", 1),
        "card at both ends": (good, "PII_PAYMENT_CARD", 1),
        "one separator between addresses": ("192.0.2" + ".7 10.20" + ".30.40", "PII_NETWORK_ADDRESS", 0),
        "two separators between addresses": ("192.0.2" + ".7, 10.20" + ".30.40", "PII_NETWORK_ADDRESS", 1),
        "other digits": ("١٢٣-45" + "-6789", "PII_GOVERNMENT_ID", 0),
        "a digit of another script before": ("١" + "123-45" + "-6789", "PII_GOVERNMENT_ID", 1),
        "no-break space": ("415\u00a0555" + "-2671", "PII_PHONE", 0),
        "right behind a match": ("a@b." + "q" * 70 + "@" + "host.io", "PII_EMAIL", 1),
        "many labels": ("a@" + "b." * 50_000 + "io", "PII_EMAIL", 1),
        "null": (None, "PII_EMAIL", 0),
    }
    for name, (text, code, hits) in texts.items():
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
        got = {tuple(r) for r in queries.QUERIES["q01_pii_scan_by_code"](spark, folder).collect()}
        assert got == set(con.execute(queries.ORACLE_SQL["q01_pii_scan_by_code"]).fetchall()) and (code, hits) in got, name
    # the scan itself still finds what the SQL passes over
    df = spark.createDataFrame([(1, f"{wrong} {good}")], "id int, text string")
    assert [(r.code, r.column) for r in scan.findings(df, "id", "text").collect()] == [("PII_PAYMENT_CARD", len(wrong) + 2)]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert queries.QUERIES["q01_pii_scan_by_code"](spark, f"{tmp_path}/empty").count() == 0
