"""The stages of the pipeline, each on its own input, and the queries' SQL."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from ledgerlake.llm import minhash, queries, secret_scan
from tests.llm.test_operators import SECRET, brute_components

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_do_their_work(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == list(corpus_pipeline.COLUMNS)
        after = corpus_pipeline.cut(after, name)
        was, now = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in after.collect()}
        assert set(now) <= set(was)
        if name == "near_dedup":
            assert set(now) == {i for i, (_, _, kept) in brute_components(was, 80).items() if kept}
        if name == "secret_scan":
            assert now == {i: secret_scan.redacted(t) for i, t in was.items()}
        if name == "line_dedup":
            assert set(now) == set(was)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(now)
    assert corpus_pipeline.run(spark, SMALL).count() == packed.count()


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    columns = ", ".join(sorted(got.columns))
    want = con.execute(f"SELECT {columns} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect()), key=repr) == sorted(want, key=repr)


def test_entry_registers_each_operator_once():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert minhash.WORDS == 5
