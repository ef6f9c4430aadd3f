"""Queries that run the library's audits over the driver tables.

Faults are planted by the keys' remainders, so that every rule has rows that break it;
the SQL says which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions import ids, paths
from ledgerlake.operators import council, governance, graph, sharding, trust
from ledgerlake.plans import datasets
from ledgerlake.plans.catalogue import query
from ledgerlake.session import cut, table
from ledgerlake.streaming import recovery


def _named(prefix: str, column) -> F.Column:
    return F.concat(F.lit(prefix), column.cast("string") if not isinstance(column, str) else F.col(column).cast("string"))


def _nth(key: str, n: int) -> F.Column:
    return F.col(key) % n == 0


@query("""
WITH ch AS (SELECT DISTINCT 'p' || l_partkey AS path FROM lineitem),
cl AS (SELECT 'p' || p_partkey AS path FROM part WHERE p_partkey % 7 <> 0 UNION ALL SELECT 'p' || p_partkey FROM part WHERE p_partkey % 10 = 0 AND p_partkey % 7 <> 0)
SELECT path AS subject, 'BATCH_ARTIFACT_UNCLAIMED' AS code FROM ch WHERE path NOT IN (SELECT path FROM cl)
UNION ALL SELECT DISTINCT path, 'BATCH_RECEIPT_UNUSED_CLAIM' FROM cl WHERE path NOT IN (SELECT path FROM ch)
UNION ALL SELECT path, 'BATCH_RECEIPT_DUPLICATE_CLAIM' FROM cl GROUP BY 1 HAVING count(*) > 1
""")
def q51_batch_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts on order lines as changed files, the part list as receipts' claims."""
    changed = table(spark, sf_dir, "lineitem").select(_named("p", "l_partkey").alias("path"))
    times = F.when(_nth("p_partkey", 10), 2).otherwise(1)
    claims = table(spark, sf_dir, "part").filter(~_nth("p_partkey", 7)).select(_named("p", "p_partkey").alias("path"), F.explode(F.sequence(F.lit(1), times)))
    return trust.batch_closure(changed, claims)


@query("""
WITH c AS (SELECT 'r' || o_custkey AS receipt, 'o' || o_orderkey AS path, o_orderstatus AS sha256 FROM orders),
r AS (SELECT 'r' || o_custkey AS receipt, 'o' || o_orderkey AS path, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS sha256 FROM orders
      UNION ALL SELECT 'r' || o_custkey, 'o' || o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 13 = 0)
SELECT DISTINCT receipt AS subject, 'RECEIPT_ARTIFACT_CLOSURE' AS code FROM ((SELECT * FROM c EXCEPT ALL SELECT * FROM r) UNION ALL (SELECT * FROM r EXCEPT ALL SELECT * FROM c))
""")
def q52_receipt_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What receipts (customers) approve against what refers to them, as multisets."""
    o = table(spark, sf_dir, "orders")
    columns = [_named("r", "o_custkey").alias("receipt"), _named("o", "o_orderkey").alias("path")]
    claims = o.select(*columns, F.col("o_orderstatus").alias("sha256"))
    refs = o.select(*columns, F.when(_nth("o_orderkey", 11), "X").otherwise(F.col("o_orderstatus")).alias("sha256"))
    return trust.receipt_closure(claims, refs.unionByName(claims.filter(F.substring("path", 2, 20).cast("long") % 13 == 0)))


@query("""
WITH d AS (SELECT doc_id, 'files/' || doc_id || '.txt' AS path, strlen(text) + CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END AS bytes,
             CASE WHEN doc_id % 19 = 0 THEN sha256('') ELSE sha256(text) END AS h, text FROM documents),
twice AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE doc_id % 23 = 0)
SELECT path AS subject, 'DESCRIPTOR_BYTES' AS code FROM twice WHERE text IS NOT NULL AND doc_id % 29 <> 0 AND bytes <> strlen(text)
UNION ALL SELECT path, 'DESCRIPTOR_HASH' FROM twice WHERE text IS NOT NULL AND doc_id % 29 <> 0 AND h <> sha256(text)
UNION ALL SELECT path, 'FILE_MISSING' FROM twice WHERE text IS NULL OR doc_id % 29 = 0
UNION ALL SELECT path, 'ARTIFACT_DUPLICATE' FROM d WHERE doc_id % 23 = 0
""")
def q53_descriptor_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, against what is declared of them."""
    d = table(spark, sf_dir, "documents").withColumn("path", F.concat(_named("files/", "doc_id"), F.lit(".txt")))
    size = F.octet_length("text").cast("long") + F.when(_nth("doc_id", 17), 1).otherwise(0)
    declared = d.select("doc_id", "path", size.alias("bytes"), F.when(_nth("doc_id", 19), F.sha2(F.lit(""), 256)).otherwise(F.sha2("text", 256)).alias("sha256"))
    declared = declared.select("path", "bytes", "sha256", F.explode(F.sequence(F.lit(1), F.when(_nth("doc_id", 23), 2).otherwise(1))))
    files = d.filter(~_nth("doc_id", 29)).select("path", F.encode("text", "UTF-8").alias("content"))
    return trust.descriptors(declared.select("path", "bytes", "sha256"), files)


@query("""
WITH l AS (SELECT l_orderkey AS subject, list(l_partkey ORDER BY l_linenumber, l_partkey) AS a FROM lineitem GROUP BY 1)
SELECT subject, 'ARTIFACT_ORDER' AS code FROM l WHERE a <> list_sort(a)
UNION ALL SELECT subject, 'ARTIFACT_DUPLICATE' FROM l WHERE len(list_distinct(a)) <> len(a)
""")
def q54_sorted_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of an order as a list that should be sorted and without repeats."""
    placed = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(placed, lambda x: x["l_partkey"]).alias("a"))
    return trust.sorted_unique(lists, "l_orderkey", "a")


@query("""
WITH r AS (SELECT 'r' || o_orderkey AS record_id, 's' || (o_custkey % 5) AS dataset_id, 't' || (o_orderkey + CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END) AS transcript_id, 'd' || o_orderkey AS deliberation_id FROM orders),
t AS (SELECT 't' || o_orderkey AS transcript_id, 'r' || o_orderkey AS record_id, CASE WHEN o_orderkey % 41 = 0 THEN 'x' ELSE 's' || (o_custkey % 5) END AS dataset_id FROM orders WHERE o_orderkey % 37 <> 0),
d AS (SELECT 'd' || o_orderkey AS deliberation_id, 'r' || o_orderkey AS record_id, 't' || o_orderkey AS transcript_id, 's' || (o_custkey % 5) AS dataset_id FROM orders WHERE o_orderkey % 43 <> 0)
SELECT r.record_id AS subject, 'TRANSCRIPT_CLOSURE' AS code FROM r LEFT JOIN t ON r.transcript_id = t.transcript_id WHERE NOT coalesce(t.record_id = r.record_id AND t.dataset_id = r.dataset_id, false)
UNION ALL SELECT r.record_id, 'DELIBERATION_CLOSURE' FROM r LEFT JOIN d ON r.deliberation_id = d.deliberation_id
  WHERE NOT coalesce(d.record_id = r.record_id AND d.dataset_id = r.dataset_id AND d.transcript_id = r.transcript_id, false)
UNION ALL SELECT transcript_id, 'TRANSCRIPT_CLOSURE' FROM t WHERE transcript_id NOT IN (SELECT transcript_id FROM r)
UNION ALL SELECT deliberation_id, 'DELIBERATION_CLOSURE' FROM d WHERE deliberation_id NOT IN (SELECT deliberation_id FROM r)
""")
def q55_episode_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records with transcripts and deliberations that refer to each other."""
    k = "o_orderkey"
    same = [F.lit("run").alias("run_id"), F.lit("one").alias("episode_id")]
    o = table(spark, sf_dir, "orders").withColumn("dataset_id", F.concat(F.lit("s"), (F.col("o_custkey") % 5).cast("string"))).withColumn("record_id", _named("r", k))
    records = o.select("record_id", "dataset_id", *same, _named("t", F.col(k) + F.when(_nth(k, 31), 1).otherwise(0)).alias("transcript_id"), _named("d", k).alias("deliberation_id"))
    transcripts = o.filter(~_nth(k, 37)).select(_named("t", k).alias("transcript_id"), "record_id", F.when(_nth(k, 41), "x").otherwise(F.col("dataset_id")).alias("dataset_id"), *same)
    deliberations = o.filter(~_nth(k, 43)).select(_named("d", k).alias("deliberation_id"), "record_id", _named("t", k).alias("transcript_id"), "dataset_id")
    return trust.episode_closure(records, transcripts, deliberations)


@query("""
WITH u AS (SELECT user_id, min(ts) AS a, max(ts) AS b, bool_or(event_type = 'signup') AND user_id % 11 <> 0 AS s, bool_or(event_type = 'purchase') AS p FROM events GROUP BY 1)
SELECT user_id AS subject, 'TRANSCRIPT_SEQUENCE' AS code FROM u WHERE user_id % 5 = 0
UNION ALL SELECT user_id, 'TRANSCRIPT_TIME' FROM u WHERE user_id % 7 = 0 AND a < b
UNION ALL SELECT user_id, 'TRANSCRIPT_COMPLETENESS' FROM u WHERE NOT (s AND p)
""")
def q56_transcript_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events as a transcript: numbered, within its interval, in order, complete."""
    kind = F.when(_nth("user_id", 11) & (F.col("event_type") == "signup"), "view").otherwise(F.col("event_type"))
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", kind.alias("kind"))
    g = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "kind"))).alias("e"), F.min("ts").alias("first"), F.max("ts").alias("completed_at"))
    off = F.when(_nth("user_id", 5), 1).otherwise(0)
    events = F.transform("e", lambda x, i: F.struct((i + off).alias("sequence"), x["kind"].alias("kind"), x["ts"].alias("at")))
    started = F.when(_nth("user_id", 7), F.col("completed_at")).otherwise(F.col("first"))
    return trust.transcript_findings(g.select("user_id", started.alias("started_at"), "completed_at", events.alias("events")).withColumnRenamed("user_id", "transcript_id"), ["signup", "purchase"])


@query("""
WITH s AS (SELECT source AS subject, max(doc_id) AS m, bool_or(lang = 'en') AS en FROM documents WHERE source IS NOT NULL GROUP BY 1)
SELECT subject, 'MANIFEST_BYTES' AS code FROM s WHERE m % 2 = 0
UNION ALL SELECT subject, 'MANIFEST_ARTIFACT_COUNT' FROM s WHERE m % 3 = 0
UNION ALL SELECT subject, 'MANIFEST_COUNTS' FROM s WHERE m % 5 = 0 AND en
""")
def q57_manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the items of a dataset per source, against the counts that its manifest declares."""
    kind, split = F.coalesce("lang", F.lit("und")), F.when(_nth("doc_id", 10), "test").otherwise("train")
    items = table(spark, sf_dir, "documents").filter("source is not null").select(
        F.col("source").alias("dataset_id"), kind.alias("kind"), split.alias("split"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"), "doc_id"
    )
    counted = lambda c: items.groupBy("dataset_id", c).count().groupBy("dataset_id").agg(F.map_from_entries(F.collect_list(F.struct(c, "count"))).alias(f"{c}_counts"))
    totals = items.groupBy("dataset_id").agg(F.max("doc_id").alias("m"), F.count("*").alias("n"), F.sum("bytes").alias("b"))
    declared = totals.join(counted("kind"), "dataset_id").join(counted("split"), "dataset_id").select(
        "dataset_id",
        F.when(_nth("m", 5), F.map_filter("kind_counts", lambda k, v: k != "en")).otherwise(F.col("kind_counts")).alias("kind_counts"),
        "split_counts", (F.col("n") + F.when(_nth("m", 3), 1).otherwise(0)).alias("item_count"), (F.col("b") + F.when(_nth("m", 2), 1).otherwise(0)).alias("content_bytes"),
    )
    return trust.manifest_counts(items.drop("doc_id"), declared)


@query("""
WITH e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT DISTINCT user_id AS record_id, 'TICK_SEQUENCE' AS code FROM e WHERE user_id % 13 = 0
UNION ALL SELECT DISTINCT user_id, 'TICK_TIME' FROM e WHERE before >= ts
UNION ALL SELECT DISTINCT user_id, 'STATE_CONTINUITY' FROM e WHERE before IS NOT NULL AND event_id % 89 = 0
""")
def q58_lifetime_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks of lifetimes: without a gap, time going on, states that connect."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ticks = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("agent_id"), "ts", F.col("event_type").alias("state_after"),
        (F.row_number().over(w) - F.when(_nth("user_id", 13), 0).otherwise(1)).alias("sequence"),
        F.when(_nth("event_id", 89), "other").otherwise(F.lag("event_type").over(w)).alias("state_before"),
    )
    return datasets.lifetime_findings(ticks)


@query("""
SELECT event_type AS resource, epoch, 'LEASE_EPOCH' AS code FROM (
  SELECT event_type, event_id // 50 AS epoch, lag(event_id // 50) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM events) WHERE before >= epoch
""")
def q59_lease_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grants of leases whose fencing epoch doesn't rise."""
    leases = table(spark, sf_dir, "events").select(F.col("event_type").alias("resource"), F.floor(F.col("event_id") / 50).alias("epoch"), F.struct("ts", "event_id").alias("granted_at"))
    return recovery.lease_findings(leases)


_STEPS = {"view": ["click", "purchase", "view", "signup", "error"], "click": ["view", "purchase", "click"], "error": ["view"], "purchase": ["view", "signup"], "signup": ["view", "click"]}
_ALLOWED = ", ".join(f"'{a}>{b}'" for a, bs in _STEPS.items() for b in bs)


@query(f"""
WITH s AS (SELECT user_id AS worker, event_id, event_type, event_id // 100 AS epoch, lag(event_type) OVER w AS t, lag(event_id) OVER w AS c, lag(event_id // 100) OVER w AS e
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT worker, event_id, 'STATE_TRANSITION' AS code FROM s WHERE t IS NOT NULL AND t || '>' || event_type NOT IN ({_ALLOWED})
UNION ALL SELECT worker, event_id, 'CURSOR_BACK' FROM s WHERE c > event_id UNION ALL SELECT worker, event_id, 'EPOCH_BACK' FROM s WHERE e > epoch
""")
def q60_worker_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoints of workers: transitions that aren't allowed, cursors and epochs that go back."""
    steps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("worker"), F.struct("ts", "event_id").alias("at"), F.col("event_type").alias("state"), F.col("event_id").alias("cursor"), F.floor(F.col("event_id") / 100).alias("epoch")
    )
    return recovery.checkpoint_findings(steps, _STEPS).select("worker", "at.event_id", "code")


@query("""
SELECT event_id AS batch_id, sha256(event_type) AS digest, CASE WHEN event_id % 3 <> 0 THEN 'apply' WHEN event_id % 9 = 0 THEN 'conflict' ELSE 'noop' END AS action FROM events
""")
def q61_operation_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations against the receipts of earlier ones: apply, no-op or conflict."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("batch_id"), F.sha2("event_type", 256).alias("digest"))
    known = e.filter(_nth("batch_id", 3)).withColumn("digest", F.when(_nth("batch_id", 9), "other").otherwise(F.col("digest")))
    return recovery.receipts(e, known)


@query("""
WITH b AS (SELECT o_orderkey % 25 AS council, o_custkey AS member_id FROM orders)
SELECT DISTINCT council, member_id, 'VOTER_INELIGIBLE' AS code FROM b WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = council AND c_custkey = member_id)
UNION ALL SELECT council, member_id, 'VOTER_DUPLICATE' FROM b GROUP BY 1, 2 HAVING count(*) > 1
""")
def q62_ballot_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ballots of voters that aren't members, and second ballots."""
    ballots = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 25).alias("council"), F.col("o_custkey").alias("member_id"))
    members = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("council"), F.col("c_custkey").alias("member_id"))
    return council.ballot_errors(ballots, members, ["council"])


@query("""
WITH t AS (SELECT l.doc_id, CASE WHEN l.doc_id % 5 = 0 THEN 'x' ELSE sha256(text) END AS claimed, sha256(text) AS sha256 FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id WHERE toxic = 1)
SELECT doc_id, CASE WHEN sha256 IS NULL THEN 'WITHDRAWAL_TARGET' ELSE 'WITHDRAWAL_HASH' END AS code FROM t WHERE sha256 IS NULL OR claimed <> sha256
UNION ALL SELECT doc_id, 'REMOVAL_INDEX_COVERAGE' FROM t WHERE doc_id % 2 <> 0
UNION ALL SELECT doc_id, 'REMOVAL_INDEX_APPEND_ONLY' FROM t WHERE doc_id % 3 = 0 AND doc_id % 2 <> 0
""")
def q63_withdrawal_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic documents as withdrawn ones: their targets, hashes and the removal index."""
    records = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    gone = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    stones = gone.join(records, "doc_id", "left").withColumn("sha256", F.when(_nth("doc_id", 5), "x").otherwise(F.col("sha256")))
    return governance.withdrawal_findings(stones, records, gone.filter(_nth("doc_id", 3)), gone.filter(_nth("doc_id", 2)), "doc_id")


@query("""
WITH c AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'M' ELSE 'D' END AS status, CASE WHEN doc_id % 7 = 0 THEN 'releases/' ELSE 'data/' END || (doc_id // 2) || '.json' AS path FROM documents)
SELECT '' AS path, 'PUBLICATION_FILE_LIMIT' AS code FROM c HAVING count(DISTINCT path) > 5
UNION ALL SELECT path, 'PATH_DUPLICATE' FROM c GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT path, 'RELEASE_IMMUTABLE' FROM c WHERE path LIKE 'releases/%' AND status <> 'A'
UNION ALL SELECT '', 'PR_DIFF_LIMIT'
""")
def q64_change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a change set: too many files, paths twice, immutable paths changed."""
    status = F.when(_nth("doc_id", 3), "A").when(F.col("doc_id") % 3 == 1, "M").otherwise("D")
    path = F.concat(F.when(_nth("doc_id", 7), "releases/").otherwise("data/"), F.floor(F.col("doc_id") / 2).cast("string"), F.lit(".json"))
    changes = table(spark, sf_dir, "documents").select(status.alias("status"), path.alias("path"), F.lit(None).cast("string").alias("old_path"))
    return governance.change_set_findings(changes, 900_001, 5, 900_000, paths.matches_any(F.col("path"), ["releases/*"]))


_PATHS = ("a/b.txt", "/abs", "a/../b", "a//b", "a\\b", "./a", "a/.", "ü/x")


@query(f"""
SELECT page_id, p[page_id % 8 + 1] AS path, page_id % 8 IN (0, 7) AS safe, page_id % 9 <> 0 AS shard
FROM (SELECT page_id, [{", ".join(f"'{p}'" for p in _PATHS)}] AS p FROM pages)
""")
def q65_safe_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which relative paths are safe, and which names are a shard's."""
    path = F.element_at(F.array(*[F.lit(p) for p in _PATHS]), (F.col("page_id") % 8 + 1).cast("int"))
    name = F.when(_nth("page_id", 9), "part-1.jsonl").otherwise(F.format_string("part-%05d.jsonl", F.col("page_id") % 100_000))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), paths.is_safe_relative(path).alias("safe"), paths.is_shard_name(name).alias("shard"))


@query("""
SELECT event_id, 'd06-' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(6, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') || '-' || substr(sha256('7:' || event_id), 1, 12) AS record_id,
       sha256('"' || event_type || '"') AS json_digest, 'sha256:' || sha256(event_type) AS digest, event_id % 4 <> 0 AS is_time,
       'reviewer-' || substr(sha256('["' || event_id || '","' || event_type || '"]'), 1, 16) AS reviewer
FROM events
""")
def q66_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record ids, digests of JSON strings, pseudonyms, and what is a UTC time."""
    e = table(spark, sf_dir, "events")
    at = F.when(_nth("event_id", 4), "2024-02-30T00:00:00Z").otherwise(ids.utc_seconds(F.col("ts")))
    return e.select(
        "event_id", ids.record_id("d06", F.lit(7), F.col("event_id")).alias("record_id"), ids.json_string_digest(F.col("event_type")).alias("json_digest"),
        ids.sha256_digest(F.col("event_type")).alias("digest"), ids.is_utc_timestamp(at).alias("is_time"), ids.pseudonym("reviewer", F.col("event_id").cast("string"), F.col("event_type")).alias("reviewer"),
    )


@query("""
SELECT 'c' || c_custkey AS child, 'n' || c_nationkey AS parent, CASE WHEN c_custkey % 2 = 0 THEN 'merge' ELSE 'fork' END AS relation FROM customer
UNION ALL SELECT 'c' || c_custkey, 's' || c_mktsegment, 'merge' FROM customer WHERE c_custkey % 2 = 0
""")
def q67_edge_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges as forks or merges, by how many parents a node has."""
    c = table(spark, sf_dir, "customer").withColumn("child", _named("c", "c_custkey"))
    edges = c.select("child", _named("n", "c_nationkey").alias("parent")).unionByName(c.filter(_nth("c_custkey", 2)).select("child", _named("s", "c_mktsegment").alias("parent")))
    return graph.relations(edges)


@query("""
SELECT 'c' || c_custkey AS node, CASE WHEN n_name < r_name THEN n_name || ',' || r_name ELSE r_name || ',' || n_name END AS capabilities
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'n' || n_nationkey, CASE WHEN n_name < r_name THEN n_name || ',' || r_name ELSE r_name || ',' || n_name END FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'r' || r_regionkey, r_name FROM region
""")
def q68_inherited_capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a node can do by itself or through any ancestor."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    edges = table(spark, sf_dir, "customer").select(_named("c", "c_custkey").alias("child"), _named("n", "c_nationkey").alias("parent"))
    edges = edges.unionByName(n.select(_named("n", "n_nationkey").alias("child"), _named("r", "n_regionkey").alias("parent")))
    own = n.select(_named("n", "n_nationkey").alias("node"), F.col("n_name").alias("capability")).unionByName(r.select(_named("r", "r_regionkey").alias("node"), F.col("r_name").alias("capability")))
    return graph.inherited(edges, own).select("node", F.array_join("capabilities", ",").alias("capabilities"))


@query("""
WITH RECURSIVE e AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey > 1 UNION ALL SELECT 1, 8),
w AS (SELECT child AS node, parent AS ancestor FROM e UNION SELECT w.node, e.parent FROM w JOIN e ON w.ancestor = e.child)
SELECT node FROM w WHERE node = ancestor
""")
def q69_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of a graph that are on a cycle: a tree of parts and one edge back."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part")
    edges = p.filter(k > 1).select(k.alias("child"), F.floor(k / 2).alias("parent"))
    return graph.on_cycles(edges.unionByName(p.filter(k == 1).select(k.alias("child"), F.lit(8).cast("long").alias("parent"))))


#: (what a document adds, where it breaks the contract and how); its place is the variant.
_VARIANTS = (
    ("", None, None),
    (',"name":"ab"', "/name", "MIN_LENGTH"),
    (',"name":"abcdefghi"', "/name", "MAX_LENGTH"),
    (',"name":"ABC"', "/name", "PATTERN"),
    (',"name":7', "/name", "TYPE"),
    (',"at":"2024-13-01T00:00:00Z"', "/at", "TIMESTAMP"),
    (',"path":"../x"', "/path", "PATH"),
    (',"tags":[]', "/tags", "MIN_ITEMS"),
    (',"tags":["a","b","c"]', "/tags", "MAX_ITEMS"),
    (',"tags":["a","a"]', "/tags", "UNIQUE_ITEMS"),
    (',"tags":[1]', "/tags/0", "TYPE"),
    (',"never":1', "/never", "FALSE_SCHEMA"),
    (',"other":1', "", "ADDITIONAL_PROPERTY"),
    (',"any":"y"', "/any", "ANY_OF"),
    (',"one":6', "/one", "ONE_OF"),
    (',"no":0', "/no", "NOT"),
    (',"level":0', "/level", "MINIMUM"),
    (',"level":10', "/level", "MAXIMUM"),
    (',"kind":"Z"', "/kind", "ENUM"),
    (',"fixed":2', "/fixed", "CONST"),
    (',"bag":{}', "/bag", "MIN_PROPERTIES"),
    (',"bag":{"a":1,"b":2}', "/bag", "MAX_PROPERTIES"),
    (',"ref":"x"', "/ref", "TYPE"),
    (',"case":{"on":true}', "/case/why", "REQUIRED"),
)
_ORDER_CONTRACT = {
    "type": "object", "required": ["schemaVersion", "id"], "additionalProperties": False, "$defs": {"count": {"type": "integer"}},
    "properties": {
        "schemaVersion": {"const": "order/v1"}, "id": {"type": "integer"}, "kind": {"enum": ["F", "O", "P"]}, "name": {"type": "string", "minLength": 3, "maxLength": 8, "pattern": "^[a-z]+$"},
        "at": {"type": "string", "format": "date-time"}, "path": {"type": "string", "format": "safe-relative-path"}, "tags": {"type": "array", "minItems": 1, "maxItems": 2, "uniqueItems": True, "items": {"type": "string"}},
        "never": False, "any": {"anyOf": [{"type": "integer"}, {"const": "x"}]}, "one": {"oneOf": [{"type": "integer", "minimum": 5}, {"type": "integer", "maximum": 7}]}, "no": {"not": {"const": 0}},
        "level": {"type": "integer", "minimum": 1, "maximum": 9}, "fixed": {"const": 1}, "bag": {"type": "object", "minProperties": 1, "maxProperties": 1}, "ref": {"$ref": "#/$defs/count"},
        "case": {"type": "object", "if": {"properties": {"on": {"const": True}}}, "then": {"required": ["why"]}, "else": {"allOf": [{"type": "object"}]}},
    },
}


def contract_documents(orders: DataFrame) -> DataFrame:
    """Orders as documents, each with what its variant adds."""
    variant = F.element_at(F.array(*[F.lit(v) for v, _, _ in _VARIANTS]), (F.col("o_orderkey") % len(_VARIANTS) + 1).cast("int"))
    raw = F.concat(F.lit('{"schemaVersion":"order/v1","id":'), F.col("o_orderkey").cast("string"), variant, F.lit("}"))
    return orders.select("o_orderkey", raw.alias("raw"))


@query(f"""
SELECT o_orderkey, path, code FROM orders JOIN (VALUES {", ".join(f"({i}, '{p}', '{c}')" for i, (_, p, c) in enumerate(_VARIANTS) if c)}) v(k, path, code) ON o_orderkey % {len(_VARIANTS)} = k
""")
def q70_contract_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents of which each variant breaks another keyword of a contract."""
    from ledgerlake.operators.contracts import contract_findings

    return contract_findings(contract_documents(table(spark, sf_dir, "orders")), "o_orderkey", "raw", {"order/v1": _ORDER_CONTRACT})


@query("SELECT sha256(nfc_normalize(text)) AS text_sha256, count(*) AS records FROM documents GROUP BY 1")
def q71_fragment_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into chains of fragments and put together again: each text is whole."""
    raw = table(spark, sf_dir, "documents").select(F.to_json(F.struct(F.col("doc_id").alias("id"), "text")).alias("raw"))
    records = cut(sharding.prepare(raw, "raw", "id", "ledgerlake").filter(F.col("error").isNull()), "records")
    lines = sharding.physical_lines(records, sharding.Limits(target=4096, cap=8192, line=2048, fragment=512), "ledgerlake")
    lines = lines.select(F.col("key").alias("path"), F.col("part").cast("long").alias("line_no"), "line")
    whole = sharding.logical_records(cut(lines, "lines"), "ledgerlake")
    return whole.groupBy(F.sha2(F.from_json("body", "text string")["text"], 256).alias("text_sha256")).agg(F.count("*").alias("records"))


_IN_ORDER = """
SELECT CAST(event_id % 50 AS VARCHAR) AS key, event_id // 50 AS sequence, CAST(event_id AS VARCHAR) AS op_id,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY event_id % 50 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS state
FROM events
"""


def _operations(events: DataFrame) -> DataFrame:
    """Increments per key, every third of them delivered twice."""
    times = F.when(_nth("event_id", 3), 2).otherwise(1)
    return events.select(
        (F.col("event_id") % 50).cast("string").alias("key"), F.floor(F.col("event_id") / 50).alias("sequence"), F.col("event_id").cast("string").alias("op_id"),
        F.round(F.col("value") * 100).cast("long").alias("delta"), F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


@query(_IN_ORDER)
def q72_ordered_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations that come twice, each applied once and in order."""
    return recovery.in_order_batch(_operations(table(spark, sf_dir, "events")))


@query(_IN_ORDER)
def q73_stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream with its state in a checkpoint, written by an idempotent sink."""
    import uuid

    from ledgerlake.session import shared_dir

    schema = table(spark, sf_dir, "events").schema
    folder = f"{shared_dir(spark)}/ledgerlake/{uuid.uuid4().hex}"
    stream = recovery.in_order(_operations(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")))
    started = stream.writeStream.foreachBatch(recovery.idempotent(f"{folder}/out")).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.schema(recovery.APPLIED).parquet(f"{folder}/out").select("key", "sequence", "op_id", "state")
