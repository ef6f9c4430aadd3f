"""One gate over the files of a change: paths, contents, scans and what each file is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import scan
from ledgerlake.functions.canonical import parsed
from ledgerlake.operators.exemptions import formal_documents, is_fixture, scan_json
from ledgerlake.operators.publication import Policy, candidate_findings, is_candidate, is_withdrawal
from ledgerlake.session import cut


def routes(changes: DataFrame, formal: DataFrame, policy: Policy) -> DataFrame:
    """path, route of changed files: withdrawal, formal (a path of ``formal``), candidate (other public data), or source."""
    known = formal.select("path", F.lit(True).alias("formal")).distinct()
    path = F.col("path")
    route = F.when(is_withdrawal(path, policy), "withdrawal").when(F.col("formal") & is_candidate(path, policy), "formal").when(is_candidate(path, policy), "candidate").otherwise("source")
    return changes.select("path").distinct().join(known, "path", "left").select("path", route.alias("route"))


def gate(changes: DataFrame, files: DataFrame, policy: Policy, diff_bytes: int = 0, verified: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings (path, line, code), routes) of a change set (status, path, old_path).

    files: path and content (binary; null where a file can't be taken). verified: paths of
    formal documents that their own rules have accepted, whose digests are exempt from
    the card test. Deleted files have no content rules; faulty examples needn't be
    valid JSON, but are scanned like all others. The line is null where it says nothing.
    """
    bare = lambda df, code: df.select("path", F.lit(None).cast("int").alias("line"), F.lit(code).alias("code"))
    out = candidate_findings(changes.withColumn("change", F.lit(0)), policy).select("path", F.lit(None).cast("int").alias("line"), "code")
    if diff_bytes > policy.publication["limits"].get("pullRequestDiffHardBytes", diff_bytes):
        out = out.unionByName(bare(changes.sparkSession.createDataFrame([(".",)], "path string"), "PR_DIFF_LIMIT"))
    out = out.unionByName(bare(changes.groupBy("path").count().filter("count > 1"), "PATH_DUPLICATE"))
    present = changes.filter(~F.col("status").startswith("D")).select("path").distinct()
    read = cut(present.join(files.select("path", "content"), "path", "left"), "read")
    utf8 = F.call_function("is_valid_utf8", F.col("content"))
    out = out.unionByName(bare(read.filter(F.col("content").isNull()), "FILE_MISSING"))
    out = out.unionByName(bare(read.filter(F.expr("position(X'00', content)") > 0), "BINARY_FORBIDDEN"))
    out = out.unionByName(bare(read.filter(~utf8), "TEXT_UTF8"))
    texts = read.filter(utf8).select("path", F.decode("content", "UTF-8").alias("text"))
    ending = F.regexp_extract("path", r"\.(jsonl?)$", 1)
    plain = texts.filter(ending == "").select("path", "text")
    lines = texts.filter(ending == "jsonl").select("path", F.posexplode(F.split(F.regexp_replace("text", r"\n\z", ""), "\n")).alias("n", "raw"))
    docs = lines.unionByName(texts.filter(ending == "json").select("path", F.lit(0).alias("n"), F.col("text").alias("raw")))
    docs = cut(docs.withColumn("p", parsed("raw", "policy")).withColumn("id", F.concat_ws(":", "n", "path")), "documents")
    wrong = docs.filter(~F.col("p.ok") & ~is_fixture(F.col("path")))
    out = out.unionByName(wrong.select("path", (F.col("n") + 1).alias("line"), F.col("p.error").alias("code")))
    passed = verified.select("path", F.lit(True).alias("passed")).distinct() if verified is not None else docs.select("path").limit(0).withColumn("passed", F.lit(True))
    good = docs.filter("p.ok").join(passed, "path", "left").select("id", "path", "n", "raw", "passed")
    place = good.select("id", "path", (F.col("n") + 1).alias("line"))
    hits = scan_json(good.drop("path"), "id", "raw", policy.namespace, "passed").select("id", "code").distinct().join(place, "id").select("path", "line", "code")
    unread = docs.filter(~F.col("p.ok")).select("id", F.col("raw").alias("text"))
    seen = scan.findings(plain, "path", "text").select("path", "line", "code")
    more = scan.findings(unread, "id", "text").select("id", "code").join(docs.select("id", "path", (F.col("n") + 1).alias("line")), "id").select("path", "line", "code")
    formal = formal_documents(good.select("id", "raw"), "id", "raw", policy.namespace).join(place, "id").select("path").distinct()
    return out.unionByName(hits).unionByName(seen).unionByName(more).distinct(), routes(changes, cut(formal, "formal"), policy)
