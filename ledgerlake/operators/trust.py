"""Release trust: closures between documents, receipts and release chains, as anti-joins and windows.

Every function returns findings (subject, code); none means that the closure holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.graph import on_cycles


def _findings(df: DataFrame, subject: str, *rules: tuple[str, Column]) -> DataFrame:
    """A row per broken rule; a rule that is null is broken too."""
    codes = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules]), lambda c: c.isNotNull())
    return df.select(F.col(subject).alias("subject"), F.explode(codes).alias("code"))


def descriptors(declared: DataFrame, files: DataFrame) -> DataFrame:
    """``declared`` (path, bytes, sha256) against ``files`` (path, content): existence,
    size, digest, double declaration, and a content address that isn't the digest's."""
    actual = files.select("path", F.length("content").cast("long").alias("n"), F.sha2("content", 256).alias("h"))
    j = declared.join(actual, "path", "left")
    address = F.regexp_extract("path", r"/sha256/[0-9a-f]{2}/([0-9a-f]{64})\.", 1)
    found = _findings(
        j.filter(F.col("h").isNotNull()),
        "path",
        ("DESCRIPTOR_BYTES", F.col("n") == F.col("bytes")),
        ("DESCRIPTOR_HASH", F.col("h") == F.col("sha256")),
        ("OBJECT_ADDRESS", (address == "") | ((address == F.col("sha256")) & F.contains("path", F.concat(F.lit("/sha256/"), F.substring("sha256", 1, 2), F.lit("/"))))),
    )
    missing = j.filter(F.col("h").isNull()).select(F.col("path").alias("subject"), F.lit("FILE_MISSING").alias("code"))
    twice = declared.groupBy("path").count().filter("count > 1").select(F.col("path").alias("subject"), F.lit("ARTIFACT_DUPLICATE").alias("code"))
    return found.unionByName(missing).unionByName(twice)


def sorted_unique(lists: DataFrame, subject: str, items: str) -> DataFrame:
    """Lists that aren't sorted or repeat an item."""
    c = F.col(items)
    return _findings(lists, subject, ("ARTIFACT_ORDER", c == F.array_sort(c)), ("ARTIFACT_DUPLICATE", F.size(F.array_distinct(c)) == F.size(c)))


def episode_closure(records: DataFrame, transcripts: DataFrame, deliberations: DataFrame) -> DataFrame:
    """Records, transcripts and deliberations refer to each other on id, dataset, run and episode.

    records: record_id, dataset_id, run_id, episode_id, transcript_id, deliberation_id.
    transcripts: transcript_id, record_id, dataset_id, run_id, episode_id.
    deliberations: deliberation_id, record_id, transcript_id, dataset_id.
    """
    same = lambda a, b, *cs: F.forall(F.array(*[F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cs]), lambda x: x)
    r, t, d = records.alias("r"), transcripts.alias("t"), deliberations.alias("d")
    rt = r.join(t, F.col("r.transcript_id") == F.col("t.transcript_id"), "left")
    keeps = F.col("t.transcript_id").isNotNull() & same("r", "t", "record_id", "dataset_id", "run_id", "episode_id")
    out = _findings(rt.select(F.col("r.record_id").alias("subject"), keeps.alias("ok")), "subject", ("TRANSCRIPT_CLOSURE", F.col("ok")))
    rd = r.join(d, F.col("r.deliberation_id") == F.col("d.deliberation_id"), "left")
    keeps = F.col("d.deliberation_id").isNotNull() & same("r", "d", "record_id", "dataset_id", "transcript_id")
    out = out.unionByName(_findings(rd.select(F.col("r.record_id").alias("subject"), keeps.alias("ok")), "subject", ("DELIBERATION_CLOSURE", F.col("ok"))))
    lone = lambda df, key, code: df.join(records.select(key), key, "left_anti").select(F.col(key).alias("subject"), F.lit(code).alias("code"))
    out = out.unionByName(lone(transcripts, "transcript_id", "TRANSCRIPT_CLOSURE")).unionByName(lone(deliberations, "deliberation_id", "DELIBERATION_CLOSURE"))
    twice = records.groupBy("record_id").count().filter("count > 1")
    return out.unionByName(twice.select(F.col("record_id").alias("subject"), F.lit("RECORD_ID_GLOBAL_DUPLICATE").alias("code")))


def transcript_findings(transcripts: DataFrame, required: list[str]) -> DataFrame:
    """transcript_id, started_at, completed_at, events array<struct<sequence, kind, at>>:
    events are numbered from 0, lie within the interval, in order, and have all required kinds."""
    e = F.col("events")
    numbered = F.forall(F.transform(e, lambda x, i: x["sequence"] == i), lambda ok: ok)
    within = F.forall(e, lambda x: (x["at"] >= F.col("started_at")) & (x["at"] <= F.col("completed_at")))
    times = F.transform(e, lambda x: x["at"])
    complete = F.size(F.array_except(F.array(*[F.lit(k) for k in required]), F.transform(e, lambda x: x["kind"]))) == 0
    return _findings(
        transcripts, "transcript_id",
        ("TRANSCRIPT_SEQUENCE", numbered), ("TRANSCRIPT_TIME", within & (times == F.array_sort(times))), ("TRANSCRIPT_COMPLETENESS", complete),
    )


def manifest_counts(items: DataFrame, declared: DataFrame) -> DataFrame:
    """items: dataset_id, kind, split, bytes. declared: dataset_id, kind_counts map, split_counts
    map, item_count, content_bytes. Measured in one pass with grouping sets."""
    sums = items.groupingSets([["dataset_id", "kind"], ["dataset_id", "split"], ["dataset_id"]], "dataset_id", "kind", "split").agg(
        F.grouping_id().alias("level"), F.count("*").alias("n"), F.sum("bytes").alias("b")
    )
    pairs = lambda level, c: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("level") == level, F.struct(c, "n")))))
    seen = sums.groupBy("dataset_id").agg(
        pairs(1, "kind").alias("kinds"), pairs(2, "split").alias("splits"),
        F.max(F.when(F.col("level") == 3, F.col("n"))).alias("n"), F.max(F.when(F.col("level") == 3, F.col("b"))).alias("b"),
    )
    j = declared.join(seen, "dataset_id", "left")
    same = lambda a, b: F.array_sort(F.map_entries(F.col(a))) == F.array_sort(F.map_entries(F.col(b)))
    return _findings(
        j, "dataset_id",
        ("MANIFEST_COUNTS", same("kinds", "kind_counts")), ("MANIFEST_SPLITS", same("splits", "split_counts")),
        ("MANIFEST_ARTIFACT_COUNT", F.col("n") == F.col("item_count")), ("MANIFEST_BYTES", F.col("b") == F.col("content_bytes")),
    )


def receipt_closure(claims: DataFrame, references: DataFrame) -> DataFrame:
    """What receipts approve equals what refers to them, as multisets of (receipt, path, sha256)."""
    cols = ["receipt", "path", "sha256"]
    a, b = claims.select(*cols), references.select(*cols)
    return a.exceptAll(b).unionByName(b.exceptAll(a)).select(F.col("receipt").alias("subject"), F.lit("RECEIPT_ARTIFACT_CLOSURE").alias("code")).distinct()


def batch_closure(changed: DataFrame, claims: DataFrame) -> DataFrame:
    """Changed paths are claimed by exactly one receipt each, and nothing else is claimed."""
    paths, claimed = changed.select("path").distinct(), claims.select("path")
    row = lambda df, code: df.select(F.col("path").alias("subject"), F.lit(code).alias("code"))
    out = row(paths.join(claimed, "path", "left_anti"), "BATCH_ARTIFACT_UNCLAIMED")
    out = out.unionByName(row(claimed.distinct().join(paths, "path", "left_anti"), "BATCH_RECEIPT_UNUSED_CLAIM"))
    return out.unionByName(row(claimed.groupBy("path").count().filter("count > 1"), "BATCH_RECEIPT_DUPLICATE_CLAIM"))


def supersession(receipts: DataFrame, heads: DataFrame) -> DataFrame:
    """receipts: review_id, predecessor, scope, reviewed_at, disposition; heads: review_id.

    Predecessors exist, are of the same scope and older; none has two successors or is
    on a cycle; the declared heads are the receipts without a successor and approve.
    """
    r, p = receipts.alias("r"), receipts.alias("p")
    j = r.filter(F.col("r.predecessor").isNotNull()).join(p, F.col("r.predecessor") == F.col("p.review_id"), "left")
    known = F.col("p.review_id").isNotNull()
    out = _findings(
        j.select(
            F.col("r.review_id").alias("subject"), known.alias("known"),
            (~known | F.col("r.scope").eqNullSafe(F.col("p.scope"))).alias("scoped"), (~known | (F.col("r.reviewed_at") > F.col("p.reviewed_at"))).alias("later"),
        ),
        "subject",
        ("REVIEW_PREDECESSOR", F.col("known")), ("REVIEW_PREDECESSOR_SCOPE", F.col("scoped")), ("REVIEW_TIME_ORDER", F.col("later")),
    )
    after = receipts.filter(F.col("predecessor").isNotNull())
    row = lambda df, c, code: df.select(F.col(c).alias("subject"), F.lit(code).alias("code"))
    out = out.unionByName(row(after.groupBy("predecessor").count().filter("count > 1"), "predecessor", "REVIEW_FORK"))
    out = out.unionByName(row(receipts.groupBy("review_id").count().filter("count > 1"), "review_id", "REVIEW_ID_DUPLICATE"))
    edges = after.select(F.col("review_id").alias("child"), F.col("predecessor").alias("parent"))
    out = out.unionByName(row(on_cycles(edges), "node", "REVIEW_CYCLE"))
    actual = receipts.select("review_id").join(after.select(F.col("predecessor").alias("review_id")), "review_id", "left_anti")
    out = out.unionByName(row(actual.join(heads, "review_id", "left_anti"), "review_id", "REVIEW_HEADS"))
    out = out.unionByName(row(heads.join(actual, "review_id", "left_anti"), "review_id", "REVIEW_SET_STALE"))
    bad = heads.join(receipts.filter(F.col("disposition") != "approve").select("review_id"), "review_id", "left_semi")
    return out.unionByName(row(bad, "review_id", "REVIEW_HEAD_REJECT")).distinct()


def release_chain(releases: DataFrame, frozen: DataFrame | None = None, current: DataFrame | None = None) -> DataFrame:
    """releases: release_id, chain, sequence, previous_id, pointer_sha256, previous_sha256.

    The first of a chain has sequence 0 and nothing before it; each later one follows
    the one before by one, by id and by digest. Two of one sequence are a fork.
    ``frozen`` and ``current`` (path, sha256): what was released is still the same.
    """
    w = Window.partitionBy("chain").orderBy("sequence", "release_id")
    r = releases.withColumn("before", F.lag(F.struct("release_id", "sequence", "pointer_sha256")).over(w))
    b, first = F.col("before"), F.col("before").isNull()
    fork = b["sequence"] == F.col("sequence")
    out = _findings(
        r, "release_id",
        ("RELEASE_GENESIS", ~first | ((F.col("sequence") == 0) & F.col("previous_id").isNull())),
        ("RELEASE_FORK", first | ~fork),
        ("PREVIOUS_RELEASE_SEQUENCE", first | fork | (b["sequence"] + 1 == F.col("sequence"))),
        ("PREVIOUS_RELEASE_ID", first | fork | b["release_id"].eqNullSafe(F.col("previous_id"))),
        ("PREVIOUS_RELEASE_DIGEST", first | fork | b["pointer_sha256"].eqNullSafe(F.col("previous_sha256"))),
    )
    if frozen is None or current is None:
        return out
    changed = frozen.join(current.select("path", F.col("sha256").alias("now")), "path", "left").filter(~F.col("sha256").eqNullSafe(F.col("now")))
    return out.unionByName(changed.select(F.col("path").alias("subject"), F.lit("PREDECESSOR_CLOSURE_TAMPER").alias("code")))


def world_closure(entities: DataFrame, records: DataFrame) -> DataFrame:
    """entities: entity_id, source_record_ids, references; both have to exist."""
    sources = entities.select("entity_id", F.explode("source_record_ids").alias("record_id")).join(records.select("record_id"), "record_id", "left_anti")
    ids = entities.select(F.col("entity_id").alias("reference"))
    refs = entities.select("entity_id", F.explode("references").alias("reference")).join(ids, "reference", "left_anti")
    row = lambda df, code: df.select(F.col("entity_id").alias("subject"), F.lit(code).alias("code"))
    return row(sources, "WORLD_RECORD_CLOSURE").unionByName(row(refs, "WORLD_REFERENCE_CLOSURE")).distinct()


def rights(sources: DataFrame, statements: DataFrame) -> DataFrame:
    """sources: record_id, source_type, basis, statement_id, fields (names that are present).
    statements: statement_id, basis, active, source_types, required (map of type to fields)."""
    j = sources.join(statements.withColumnRenamed("basis", "allowed"), "statement_id", "left")
    known = F.col("allowed").isNotNull()
    needed = F.coalesce(F.try_element_at("required", F.col("source_type")), F.array().cast("array<string>"))
    return _findings(
        j, "record_id",
        ("RIGHTS_STATEMENT_UNKNOWN", known),
        ("RIGHTS_STATEMENT_REVOKED", ~known | F.col("active")),
        ("RIGHTS_BASIS_MISMATCH", ~known | (F.col("basis") == F.col("allowed"))),
        ("RIGHTS_SOURCE_TYPE", ~known | F.array_contains("source_types", F.col("source_type"))),
        ("RIGHTS_ATTESTATION_MISSING", ~known | (F.size(F.array_except(needed, "fields")) == 0)),
    )
