"""Queries that run shaping, receipts, exemptions and checkpoints over the driver tables.

Raw JSON is put together by one SQL expression that both engines read (``F.expr``), with
faults by the keys' remainders; the expected rows are computed from the columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import contracts, council, exemptions, gate, publication, receipts, sharding
from ledgerlake.plans import datasets, shaping, simulate
from ledgerlake.plans.audits import _ORDER_CONTRACT, _VARIANTS, contract_documents
from ledgerlake.plans.catalogue import query
from ledgerlake.session import shared_dir, table
from ledgerlake.streaming import checkpoints

_NAMES = """
CASE WHEN event_id % 2 = 0 THEN '"agentId":"u' || user_id || '",' ELSE '"actor_id":"u' || user_id || '",' END
|| CASE WHEN event_id % 5 = 0 THEN '"description":"seen",' ELSE '' END
|| CASE WHEN event_id % 2 = 0 THEN '' ELSE '"event_type":"' || event_type || '",' END
|| '"id":"e' || event_id || '","message":"' || CASE WHEN event_id % 7 = 0 THEN 'said' ELSE '' END || '",'
|| CASE WHEN event_id % 11 = 0 THEN '"outcome":7,' ELSE '"outcome":{},' END
"""
_REST = """
'"timestamp":"' || CASE WHEN event_id % 13 = 0 THEN 'soon' ELSE '2024-01-0' || (event_id % 9 + 1) || 'T00:00:00.5Z' END || '"'
|| CASE WHEN event_id % 2 = 0 THEN ',"type":"' || event_type || '","world":"w' || (user_id % 3) || '"}' ELSE ',"world_id":"w' || (user_id % 3) || '"}' END
"""
_EXPORT = f"""
CASE WHEN event_id % 3 = 0 THEN '{{"lineage":"old","naturalId":"n' || event_id || '","value":{{' || {_NAMES} || {_REST} || '}}'
ELSE '{{' || {_NAMES} || CASE WHEN event_id % 4 = 0 THEN '"source_type":"foreign",' ELSE '' END || {_REST} END
"""


@query(f"""
WITH e AS (SELECT event_id, event_id % 3 = 0 AS wrapped, 'u' || user_id AS actor_id, event_type, 'w' || (user_id % 3) AS world, {_EXPORT} AS raw, '{{' || {_NAMES} || {_REST} AS inside FROM events),
f AS (SELECT *, CASE WHEN wrapped THEN 'n' ELSE 'e' END || event_id AS source_id, CASE WHEN wrapped THEN 'old' ELSE 'unassigned' END AS lineage, sha256(CASE WHEN wrapped THEN inside ELSE raw END) AS content_sha256,
  CASE WHEN wrapped THEN 'legacy_action_export' WHEN event_id % 4 = 0 THEN 'foreign' ELSE 'owned_event' END AS source_type FROM e)
SELECT event_id, wrapped, actor_id, event_type, world, source_id, source_type, lineage, content_sha256,
  CASE WHEN event_id % 13 <> 0 THEN '2024-01-0' || (event_id % 9 + 1) || 'T00:00:00Z' END AS observed_at,
  CASE WHEN event_id % 7 = 0 THEN 'said' WHEN event_id % 5 = 0 THEN 'seen' ELSE actor_id || ' performed ' || event_type || ' in ' || world || '.' END AS text,
  'd01-' || substr(sha256('["d01","' || lineage || '","' || source_id || '","' || content_sha256 || '"]'), 1, 20) AS record_id,
  array_to_string(list_filter([CASE WHEN source_type = 'foreign' THEN 'SOURCE_TYPE' END, CASE WHEN event_id % 13 = 0 THEN 'TIMESTAMP' END, CASE WHEN event_id % 11 = 0 THEN 'OUTCOME' END], lambda x: x IS NOT NULL), ',') AS errors
FROM f
""")
def q74_ledger_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as exports, bare or in an envelope, under either set of names."""
    sources = table(spark, sf_dir, "events").select("event_id", F.expr(_EXPORT).alias("raw"))
    r = shaping.ledger_records(shaping.unwrap(sources, "raw", "owned_event"), ["legacy_action_export", "owned_event"])
    return r.select("event_id", "wrapped", "actor_id", "event_type", "world", "source_id", "source_type", "lineage", "content_sha256", "observed_at", "text", "record_id", F.array_join("errors", ",").alias("errors"))


#: what was said of a decision, and what is made of it: status, confidence, decision, summary, options, errors
_SAID = (
    ("null", "not_recorded", None, "go", shaping.NOT_RECORDED, "", ""),
    ('"because"', "not_recorded", None, "go", shaping.NOT_RECORDED, "", ""),
    ('{"confidence":0.5,"decision":"stay","options_considered":["a","b"],"summary":" why "}', "explicit", 0.5, "stay", "why", "a,b", ""),
    ('{"alternatives":["c"],"rationale":"so","summary":""}', "explicit", None, "go", "so", "c", ""),
    ('{"confidence":2,"summary":"x"}', "explicit", 2.0, "go", "x", "", "CONFIDENCE"),
    ('{"confidence":true,"summary":"x"}', "explicit", None, "go", "x", "", "CONFIDENCE"),
    ('{"options_considered":[1],"summary":7}', "explicit", None, "go", None, "", "SUMMARY,OPTIONS"),
    ('{"options_considered":"a","summary":"   "}', "explicit", None, "go", None, "", "SUMMARY,OPTIONS"),
)


def _sql(v) -> str:
    return "NULL" if v is None else repr(v) if not isinstance(v, str) else "'" + v + "'"


@query(f"""
SELECT o_orderkey, status, confidence, decision, summary, options, errors FROM orders
JOIN (VALUES {", ".join(f"({i}, {', '.join(_sql(x) for x in row[1:2])}, CAST({_sql(row[2])} AS DOUBLE), {', '.join(_sql(x) for x in row[3:])})" for i, row in enumerate(_SAID))}) v(k, status, confidence, decision, summary, options, errors)
ON o_orderkey % {len(_SAID)} = k
""")
def q75_deliberations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what was said about a decision, in every form."""
    raw = F.element_at(F.array(*[F.lit(r[0]) for r in _SAID]), (F.col("o_orderkey") % len(_SAID) + 1).cast("int"))
    d = table(spark, sf_dir, "orders").select("o_orderkey", shaping.deliberation(F.try_parse_json(raw), F.lit("go")).alias("d"))
    return d.select("o_orderkey", "d.status", "d.confidence", "d.decision", "d.summary", F.array_join("d.options_considered", ",").alias("options"), F.array_join("d.errors", ",").alias("errors"))


_REFERENCES = """
CASE WHEN o_orderkey % 10 = 0 THEN '{}' ELSE '[{"consent":"public","uri":"x/' || o_orderkey || '"},{"consent":"private","uri":"y"},{"consent":"public","uri":""},{"consent":"public","uri":4},7,{"consent":"public","kind":"note","uri":"' || o_orderstatus || '"}]' END
"""


@query("""
SELECT o_orderkey, 'participant_exposed' AS kind, 'x/' || o_orderkey AS uri FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL SELECT o_orderkey, 'note', o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0
""")
def q76_public_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each order's references, those that are public and lead somewhere."""
    refs = shaping.public_references(F.try_parse_json(F.expr(_REFERENCES)))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(refs)).drop("consent")


_CANDIDATE = """
'{"context":{"agent_id":"a' || c_custkey || '"' || CASE WHEN c_custkey % 2 = 0 THEN ',"list":[{"label":1,"x":{"owner":2}}]' ELSE '' END || '},"exposed_reasoning_refs":[{"owner":"open"}],"id":"c' || c_custkey || '","judgments":[{"label":"y"}],"owner":"' || c_mktsegment || '"}'
"""


@query("""
SELECT c_custkey, '{"context":{"agent_id":"a' || c_custkey || '"' || CASE WHEN c_custkey % 2 = 0 THEN ',"list":[{"label":1,"x":{"owner":2}}]' ELSE '' END || '},"exposed_reasoning_refs":[{"owner":"open"}],"id":"c' || c_custkey || '"}' AS blinded,
  CASE WHEN c_custkey % 2 = 0 THEN '/context/agent_id,/context/list/0/label,/context/list/0/x/owner' ELSE '/context/agent_id' END AS leaks
FROM customer
""")
def q77_blinded_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as candidates of a review: without private names, and where such names remain."""
    c = table(spark, sf_dir, "customer").select("c_custkey", shaping.blinded(F.expr(_CANDIDATE)).alias("blinded"))
    left = shaping.private_leaks(c, "blinded").groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_list("path")), ",").alias("leaks"))
    return c.join(left, "c_custkey", "left")


_JUDGMENT = """
'{"label":"' || l_returnflag || '"' || CASE WHEN l_partkey % 6 = 0 THEN '' ELSE ',"reviewer_id":"s' || l_suppkey || '"' END || ',"consent":{"status":"' || CASE WHEN l_partkey % 5 = 0 THEN 'withdrawn' ELSE 'granted' END
|| '","scopes":["z",' || CASE WHEN l_partkey % 7 = 0 THEN '' ELSE '"public_dataset_label",' END || '"a"],"evidence_ref":"' || CASE WHEN l_partkey % 8 = 0 THEN '' ELSE 'form' END || '","granted_at":"' || CASE WHEN l_partkey % 9 = 0 THEN '' ELSE '2024-02-01T10:00:00Z' END || '"}}'
"""


@query("""
SELECT 'r' || l_orderkey AS record_id, l_returnflag AS label, 'reviewer-' || substr(sha256('["r' || l_orderkey || '","s' || l_suppkey || '"]'), 1, 16) AS reviewer_ref, 'a,public_dataset_label,z' AS scopes, '2024-02-01T10:00:00Z' AS granted_at
FROM lineitem WHERE l_partkey % 5 <> 0 AND l_partkey % 6 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 8 <> 0 AND l_partkey % 9 <> 0
""")
def q78_consented_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as judgments: those with a reviewer and consent to publish, under pseudonyms."""
    j = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("r"), "l_orderkey").alias("record_id"), F.try_parse_json(F.expr(_JUDGMENT)).alias("judgment"))
    return shaping.consented_judgments(j).select("record_id", "label", "reviewer_ref", F.array_join("consent.scopes", ",").alias("scopes"), "consent.granted_at")


_CALLS = """
'[{"call_id":"c' || o_orderkey || '","tool_name":"edit","started_at":"2024-03-01T00:00:01Z","completed_at":"2024-03-01T00:00:0' || (o_orderkey % 4) || 'Z","arguments":{"b":1,"a":[2]}},'
|| CASE WHEN o_orderkey % 5 = 0 THEN '7' ELSE '{"call_id":"","tool_name":"run"}' END || ',{"call_id":"x","tool_name":"' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'run' END || '","started_at":"no","status":"failed","result":3}]'
"""


@query("""
SELECT o_orderkey, 0 AS sequence, 'c' || o_orderkey AS call_id, 'succeeded' AS status, '{"a":[2],"b":1}' AS arguments, 'null' AS result, CASE WHEN o_orderkey % 4 = 0 THEN 'CALL_INTERVAL' END AS error FROM orders
UNION ALL SELECT o_orderkey, 1, CASE WHEN o_orderkey % 5 <> 0 THEN '' END, 'succeeded', '{}', 'null', CASE WHEN o_orderkey % 5 = 0 THEN 'CALL_OBJECT' ELSE 'CALL_ID' END FROM orders
UNION ALL SELECT o_orderkey, 2, 'x', 'failed', '{}', '3', CASE WHEN o_orderkey % 3 = 0 THEN 'CALL_TOOL' ELSE 'CALL_TIME' END FROM orders
""")
def q79_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered tool calls of a trajectory, with what is wrong with each."""
    calls = shaping.tool_calls(F.try_parse_json(F.expr(_CALLS)))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(calls)).select("o_orderkey", "sequence", "call_id", "status", "arguments", "result", "error")


_PATCHES = """
'[{"path":"' || CASE WHEN p_partkey % 4 = 0 THEN '../' WHEN p_partkey % 4 = 1 THEN '/' ELSE '' END || 'src/' || p_partkey || '","before_content":"","after_content":"' || p_brand || '","unified_diff":"+"},{"patch_id":"own","path":"b","before_content":"x","after_content":'
|| CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE '"y"' END || ',"unified_diff":"-+","applied":' || CASE WHEN p_partkey % 5 = 0 THEN '"yes"' ELSE 'false' END || '}]'
"""
_EVIDENCE = """
'[{"command":"test","exit_code":' || (p_partkey % 2) || ',"output":"' || p_brand || '"},{"command":"","exit_code":0,"output":""},{"command":"c","exit_code":true,"output":"o"},{"command":"c","exit_code":0,"name":"n","output":4}]'
"""


@query("""
SELECT p_partkey, 0 AS sequence, 'patch-001' AS name, sha256('"' || p_brand || '"') AS digest, true AS flag, CASE WHEN p_partkey % 4 < 2 THEN 'PATCH_PATH' END AS error FROM part
UNION ALL SELECT p_partkey, 1, 'own', CASE WHEN p_partkey % 3 <> 0 THEN sha256('"y"') END, p_partkey % 5 = 0, CASE WHEN p_partkey % 3 = 0 THEN 'PATCH_CONTENT' WHEN p_partkey % 5 = 0 THEN 'PATCH_APPLIED' END FROM part
UNION ALL SELECT p_partkey, 0, 'verifier-1', sha256('"' || p_brand || '"'), p_partkey % 2 = 0, NULL FROM part
UNION ALL SELECT p_partkey, 1, 'verifier-2', sha256('""'), true, 'EVIDENCE_COMMAND' FROM part
UNION ALL SELECT p_partkey, 2, 'verifier-3', sha256('"o"'), NULL, 'EVIDENCE_EXIT' FROM part
UNION ALL SELECT p_partkey, 3, 'n', NULL, true, 'EVIDENCE_OUTPUT' FROM part
""")
def q80_patches_and_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trajectory's patches and its verifiers' evidence, numbered, with their digests."""
    p = table(spark, sf_dir, "part")
    patched = shaping.patches(p.select("p_partkey", F.try_parse_json(F.expr(_PATCHES)).alias("v")), "v")
    proved = p.select("p_partkey", F.inline(shaping.verifier_evidence(F.try_parse_json(F.expr(_EVIDENCE)))))
    columns = lambda df, name, digest, flag: df.select("p_partkey", "sequence", F.col(name).alias("name"), F.col(digest).alias("digest"), F.col(flag).alias("flag"), "error")
    return columns(patched, "patch_id", "after_sha256", "applied").unionByName(columns(proved, "name", "output_sha256", "passed"))


_TICK = """
'{"sequence":' || CASE WHEN event_id % 17 = 0 THEN i + 1 ELSE i END || ',"observed_at":"' || at || '","kind":"' || CASE WHEN event_id % 3 = 0 THEN 'idle","idle_reason":"rest"' WHEN event_id % 19 = 0 THEN 'nap"' ELSE 'decision","action":"' || event_type || '"' END
|| ',"state_before":{"n":' || CASE WHEN event_id % 23 = 0 THEN i + 5 ELSE i END || '},"state_after":{"n":' || (i + 1) || ',"m":1}' || CASE WHEN event_id % 2 = 0 THEN ',"world":"w"' ELSE '' END || ',"goal_updates":[' || CASE WHEN event_id % 4 = 0 THEN '"g' || event_id || '",2' ELSE '' END || ']}'
"""


def _lives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as agents whose events are ticks of one second each."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long") - 1)
    e = e.withColumn("at", F.date_format(F.timestamp_seconds(F.col("i") + 1704067201), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("i", F.expr(_TICK).alias("t")))), lambda x: x["t"])
    whole = F.concat(F.lit('{"birth_event":{"observed_at":"2024-01-01T00:00:00Z","initial_state":{"n":0}},"ticks":['), F.array_join(parts, ","), F.lit("]}"))
    return e.groupBy(F.col("user_id").alias("agent_id")).agg(whole.alias("raw"))


_NUMBERED = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events"


@query(f"""
WITH e AS ({_NUMBERED})
SELECT user_id AS agent_id, CAST(i AS INTEGER) AS sequence, CASE WHEN event_id % 3 <> 0 AND event_id % 19 <> 0 THEN event_type END AS action, CASE WHEN event_id % 2 = 0 THEN 'w' ELSE 'unknown' END AS world,
  sha256('{{"m":1,"n":' || (i + 1) || '}}') AS state_after_sha256,
  array_to_string(list_filter([CASE WHEN event_id % 17 = 0 THEN 'TICK_SEQUENCE' END, CASE WHEN event_id % 3 <> 0 AND event_id % 19 = 0 THEN 'TICK_KIND' END, CASE WHEN i > 0 OR event_id % 23 = 0 THEN 'STATE_CONTINUITY' END], lambda x: x IS NOT NULL), ',') AS errors
FROM e
""")
def q81_lifetime_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks of lifetimes, checked against the one before; states gain a field, so none but the first connects."""
    t = shaping.ticks(_lives(spark, sf_dir), "raw")
    return t.select("agent_id", "sequence", "action", "world", "state_after_sha256", F.array_join("errors", ",").alias("errors"))


@query(f"""
WITH e AS ({_NUMBERED}), u AS (SELECT user_id, i, 0 AS j, '"g' || event_id || '"' AS u FROM e WHERE event_id % 4 = 0 UNION ALL SELECT user_id, i, 1, '2' FROM e WHERE event_id % 4 = 0)
SELECT user_id AS agent_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY i, j) - 1 AS INTEGER) AS place, u AS "update" FROM u
""")
def q82_goal_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All goal updates of a lifetime in the order of its ticks."""
    return shaping.updates(_lives(spark, sf_dir), "raw", "goal_updates")


# receipts: orders as receipts, their lines as artifacts


_ARTIFACTS = """
SELECT 'o' || l_orderkey AS receipt, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber) AS INTEGER) AS pos, 'p' || lpad(CAST(l_partkey AS {text}), 9, '0') AS path,
  CASE WHEN l_partkey % 97 = 0 THEN 'dataset-manifest' WHEN l_partkey % 31 = 0 THEN 'provider-reasoning-shard' ELSE 'record-shard' END AS "artifactKind", 'application/x-ndjson' AS "mediaType", CAST(l_suppkey AS BIGINT) AS bytes, 'h' || (l_partkey % 1000) AS sha256, l_partkey, l_orderkey FROM lineitem
"""
_DUCK = _ARTIFACTS.format(text="VARCHAR")


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("ledgerlake_lineitem")
    return spark.sql(_ARTIFACTS.format(text="STRING").replace('"', "`").replace("FROM lineitem", "FROM ledgerlake_lineitem"))


def _receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("o"), k).alias("receipt"), F.lit("dataset-leaves").alias("scope"), F.when(k % 29 == 0, "reject").otherwise("approve_public").alias("disposition"),
        F.when(k % 37 == 0, "before").alias("predecessor"), (k % 2 == 0).alias("governed"), F.when(k % 41 == 0, "signed").alias("signature"),
    )


@query(f"""
WITH a AS ({_DUCK}), l AS (SELECT *, lag(path) OVER w AS bp, lag(sha256) OVER w AS bs FROM a WINDOW w AS (PARTITION BY receipt ORDER BY pos))
SELECT DISTINCT receipt AS subject, 'RECEIPT_SCOPE' AS code FROM a WHERE "artifactKind" = 'dataset-manifest'
UNION ALL SELECT DISTINCT receipt, 'ARTIFACT_ORDER' FROM l WHERE bp IS NOT NULL AND NOT (bp < path OR (bp = path AND bs < sha256))
UNION ALL SELECT DISTINCT receipt, 'RECEIPT_EVIDENCE' FROM a WHERE l_partkey % 53 = 0
UNION ALL SELECT DISTINCT receipt, 'RECEIPT_EVIDENCE_ORDER' FROM (SELECT receipt FROM a WHERE l_partkey % 3 = 0 GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'o' || o_orderkey, 'RECEIPT_REJECT' FROM orders WHERE o_orderkey % 29 = 0
UNION ALL SELECT 'o' || o_orderkey, 'RECEIPT_PREDECESSOR_UNTRACKED' FROM orders WHERE o_orderkey % 37 = 0 AND o_orderkey % 2 <> 0
UNION ALL SELECT 'o' || o_orderkey, 'SIGNED_APPROVAL_NOT_ENABLED' FROM orders WHERE o_orderkey % 41 = 0
""")
def q83_receipt_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as receipts, their lines as what they approve; evidence stands backwards and of another digest."""
    a = _artifacts(spark, sf_dir)
    bound = a.select("receipt", F.lit("one").alias("check"), (-F.col("pos")).alias("pos"), "path", F.col("sha256").alias("s"), "l_partkey")
    wrong = bound.filter("l_partkey % 53 = 0").withColumn("check", F.concat(F.lit("w"), F.col("pos").cast("string"))).withColumn("s", F.lit("other"))
    evidence = bound.filter("l_partkey % 3 = 0").unionByName(wrong).withColumnRenamed("s", "sha256")
    known = _receipts(spark, sf_dir)
    lone = a.join(known.select("receipt"), "receipt", "left_semi")
    return receipts.receipt_findings(known, lone, evidence.join(known.select("receipt"), "receipt", "left_semi"))


@query(f"""
WITH a AS ({_DUCK}), d AS (SELECT * FROM a WHERE l_partkey % 2 = 0)
SELECT DISTINCT path AS subject, 'BATCH_DEPENDENCY_REVIEW' AS code FROM d WHERE l_orderkey % 29 = 0 OR l_partkey % 10 = 0 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)
""")
def q84_dependency_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptors nested in a batch: every tenth part's size isn't the approved one, every 29th receipt rejects."""
    a = _artifacts(spark, sf_dir)
    nested = a.filter("l_partkey % 2 = 0").withColumn("bytes", F.when(F.col("l_partkey") % 10 == 0, -1).otherwise(F.col("bytes")))
    return receipts.dependency_findings(nested, a, _receipts(spark, sf_dir))


@query(f"""
WITH a AS ({_DUCK}), r AS (SELECT receipt, l_orderkey, bool_or("artifactKind" = 'provider-reasoning-shard') AS reasoning FROM a WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1, 2)
SELECT receipt AS subject, CASE WHEN reasoning THEN 'PROVIDER_APPROVAL' ELSE 'PROVIDER_APPROVAL_UNNEEDED' END AS code FROM r
WHERE (reasoning AND (l_orderkey % 29 = 0 OR l_orderkey % 3 = 0 OR l_orderkey % 5 = 0 OR l_orderkey % 7 = 0 OR l_orderkey % 11 = 0)) OR (NOT reasoning AND l_orderkey % 3 <> 0)
""")
def q85_provider_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider reasoning under receipts: not approved (3), other terms named (5), terms not listed (7), none named (11)."""
    a, known, k = _artifacts(spark, sf_dir), _receipts(spark, sf_dir), F.col("o_orderkey")
    fields = [F.lit(v).alias(c) for c, v in zip(receipts.RAW, ("terms.txt", "provider-terms", "text/plain"))]
    fields += [F.lit(9).cast("long").alias("bytes"), F.concat(F.lit("t"), k).alias("sha256")]
    terms = known.filter(k % 11 != 0).select("receipt", *fields[:4], F.when(k % 5 == 0, "other").otherwise(F.concat(F.lit("t"), k)).alias("sha256"))
    listed = known.filter(k % 7 != 0).select("receipt", *fields)
    given = known.select("receipt", "disposition", F.when(k % 3 != 0, True).alias("approved"), F.struct(*fields).alias("terms"))
    refs = a.select("receipt", *receipts.RAW)
    return receipts.provider_findings(given, refs.unionByName(listed.join(refs.select("receipt").distinct(), "receipt", "left_semi")), terms)


@query("""
SELECT 'r' || o_orderkey AS subject, 'PROVIDER_REASONING_CLOSURE' AS code FROM orders WHERE o_orderkey % 2 = 0 AND (o_orderkey % 3 = 0 OR o_orderkey % 5 = 0)
""")
def q86_reasoning_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other order has reasoning; some of it is missing (3), some is of another record (5)."""
    k = F.col("o_orderkey")
    named = lambda p, c=k: F.concat(F.lit(p), c)
    o = table(spark, sf_dir, "orders").select(k, named("r").alias("record_id"), F.lit("d").alias("dataset_id"), named("t").alias("transcript_id"), F.when(k % 2 == 0, named("g")).alias("reasoning_id"))
    there = o.filter((k % 2 == 0) & (k % 3 != 0)).withColumn("record_id", F.when(k % 5 == 0, "r").otherwise(F.col("record_id")))
    return receipts.reasoning_closure(o, there)


@query("""
WITH r AS (SELECT c_custkey AS k, c_custkey % 6 AS m FROM customer)
SELECT 'c' || k AS subject, code FROM r JOIN (VALUES (0, 'RELEASE_ROLLBACK'), (2, 'RELEASE_FORK'), (3, 'RELEASE_ROLLBACK'), (4, 'PREDECESSOR_ANCHOR_ID'), (4, 'PREDECESSOR_ANCHOR_MISMATCH'), (5, 'PREVIOUS_RELEASE_REQUIRED')) v(m2, code) ON m = m2 WHERE k % 7 <> 0
UNION ALL SELECT 'c' || k, 'PREDECESSOR_ANCHOR_REQUIRED' FROM r WHERE k % 7 = 0 AND m BETWEEN 1 AND 4
UNION ALL SELECT 'c' || k, 'PREVIOUS_RELEASE_REQUIRED' FROM r WHERE k % 7 = 0 AND m = 5
""")
def q87_anchored_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases that should extend a trusted one at sequence 4: right (1), begun again (0), too far (2),
    behind (3), after another (4), without a predecessor (5); every seventh chain has no anchor."""
    k = F.col("c_custkey")
    m = k % 6
    c = table(spark, sf_dir, "customer")
    sequence = F.when(m == 0, 1).when(m == 2, 6).when(m == 3, 4).otherwise(5)
    previous = lambda right: F.when(m == 4, "other").when(~m.isin(0, 5), right)
    releases = c.select(k.alias("chain"), F.concat(F.lit("c"), k).alias("release_id"), sequence.alias("sequence"), previous("four").alias("previous_id"), previous("sha").alias("previous_sha256"))
    anchors = c.filter(k % 7 != 0).select(k.alias("chain"), F.lit("four").alias("release_id"), F.lit(4).alias("sequence"), F.lit("sha").alias("pointer_sha256"))
    return receipts.anchored(releases, anchors)


# shards


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by key, 100 to a shard; every 50th key is put back by 3."""
    k = F.col("o_orderkey")
    d = table(spark, sf_dir, "orders").select(F.format_string("part-%05d.jsonl", F.floor(k / 100)).alias("path"), (k % 100).alias("line_no"), (k - F.when(k % 50 == 0, 3).otherwise(0)).alias("key"))
    return d


_SHARDS = "SELECT 'part-' || lpad(CAST(o_orderkey // 100 AS VARCHAR), 5, '0') || '.jsonl' AS path, o_orderkey % 100 AS line_no, o_orderkey - CASE WHEN o_orderkey % 50 = 0 THEN 3 ELSE 0 END AS key, o_orderkey FROM orders"


@query(f"""
WITH l AS ({_SHARDS}), w AS (SELECT *, lag(key) OVER (ORDER BY o_orderkey) AS b, lag(o_orderkey // 100) OVER (ORDER BY o_orderkey) AS s FROM l)
SELECT path, line_no, 'KEY_ORDER' AS code FROM w WHERE b >= key AND s >= o_orderkey // 100 - 1
""")
def q88_key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that don't rise, within shards and from one to the next."""
    return sharding.key_order_findings(_lines(spark, sf_dir), "key")


@query(f"""
WITH l AS ({_SHARDS}), e AS (SELECT path, arg_min(key, line_no) AS a, arg_max(key, line_no) AS b, min(o_orderkey) // 100 AS s FROM l GROUP BY 1)
SELECT path, 'SHARD_FIRST_KEY' AS code FROM e WHERE s % 3 = 0 UNION ALL SELECT path, 'SHARD_LAST_KEY' FROM e WHERE s % 4 = 0 UNION ALL SELECT 'x' || path, 'SHARD_MISSING' FROM e WHERE s % 5 = 0
""")
def q89_shard_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last keys that descriptors claim for shards, some of them off by one, some shards absent."""
    lines = _lines(spark, sf_dir)
    s = F.regexp_extract("path", "[0-9]+", 0).cast("long")
    e = lines.groupBy("path").agg(F.min_by("key", "line_no").alias("a"), F.max_by("key", "line_no").alias("b"))
    off = lambda n: F.when(s % n == 0, 1).otherwise(0)
    declared = e.select("path", (F.col("a") + off(3)).alias("first_key"), (F.col("b") + off(4)).alias("last_key"))
    return sharding.shard_edge_findings(lines, declared.unionByName(declared.filter(s % 5 == 0).withColumn("path", F.concat(F.lit("x"), "path"))), "key")


@query("""
WITH RECURSIVE l AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_orderkey * 7919 % 9973 + 1 AS bytes FROM orders),
r AS (SELECT *, CAST(sum(bytes) OVER (ORDER BY pos) AS BIGINT) AS until FROM l),
g(lo, hi) AS (
  SELECT min(pos), max(pos) FROM r HAVING count(*) > 0
  UNION ALL
  SELECT unnest([c.lo, c.at.p + 1]), unnest([c.at.p, c.hi]) FROM (
    SELECT g.lo, g.hi, min({'o': abs(h.until - f.until + f.bytes - 2 * (r.until - f.until + f.bytes)), 'p': r.pos}) AS at
    FROM g JOIN r f ON f.pos = g.lo JOIN r h ON h.pos = g.hi JOIN r ON r.pos >= g.lo AND r.pos < g.hi
    WHERE h.until - f.until + f.bytes > 768000 AND g.hi > g.lo GROUP BY g.lo, g.hi
  ) c
)
SELECT CAST(row_number() OVER (ORDER BY g.lo) - 1 AS INTEGER) AS shard, f.o_orderkey AS first_key, h.o_orderkey AS last_key, g.hi - g.lo + 1 AS records, h.until - f.until + f.bytes AS bytes
FROM g JOIN r f ON f.pos = g.lo JOIN r h ON h.pos = g.hi WHERE h.until - f.until + f.bytes <= 768000 OR g.hi = g.lo
""")
def q102_balanced_halving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of all sizes in the order of their keys, halved by size until no group of several is over the target."""
    k = F.col("o_orderkey")
    lines = sharding.ordered(table(spark, sf_dir, "orders").select(k, (k * 7919 % 9973 + 1).alias("bytes")), "o_orderkey")
    rows = sharding.layout(lines, sharding.Limits())
    return rows.groupBy("shard").agg(F.min(k).alias("first_key"), F.max(k).alias("last_key"), F.count("*").alias("records"), F.sum("bytes").alias("bytes"))


# scans of JSON and paths

_FORMAL = """
'{"schemaVersion":"lake.dataset-manifest/v2","note' || CASE WHEN o_orderkey % 5 = 0 THEN '4111111111111111' ELSE '' END || '":"' || CASE WHEN o_orderkey % 3 = 0 THEN 'call 415-555-2671' ELSE '' END
|| '","dataCard":{"path":"p","artifactKind":"data-card","mediaType":"application/json","bytes":1,"sha256":"aaaaaaaa4111111111111111aaaaaaaa' || repeat('ab', 16) || '"},"other":{"sha256":"aaaaaaaa4111111111111111aaaaaaaa' || repeat('ab', 16) || '"}}'
"""


@query("""
SELECT o_orderkey, '/note4111111111111111' AS path, 'key' AS part, 'PII_PAYMENT_CARD' AS code FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, '/note' || CASE WHEN o_orderkey % 5 = 0 THEN '4111111111111111' ELSE '' END, 'value', 'PII_PHONE' FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, '/dataCard/sha256', 'value', 'PII_PAYMENT_CARD' FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT o_orderkey, '/other/sha256', 'value', 'PII_PAYMENT_CARD' FROM orders
""")
def q90_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and strings of manifests; a digest with a card number in it is exempt in its place, if the manifest is valid."""
    docs = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_FORMAL).alias("raw"), (F.col("o_orderkey") % 7 != 0).alias("valid"))
    return exemptions.scan_json(docs, "o_orderkey", "raw", "lake", "valid")


_ADDRESS = "'objects/cards/sha256/41/4111111111111111' || repeat('ab', 24) || '.json'"


@query("""
SELECT 'objects/cards/sha256/41/4111111111111111' || repeat('ab', 24) || '.json' AS path, 'PII_PAYMENT_CARD' AS code FROM part WHERE p_partkey % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'tmp/' || p_partkey || '/415-555-2671', 'PII_PHONE' FROM part WHERE p_partkey % 3 = 1
""")
def q91_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of files: an address with a card number in its digest is exempt where the digest is the file's."""
    k = F.col("p_partkey")
    path = F.when(k % 3 == 1, F.concat(F.lit("tmp/"), k, F.lit("/415-555-2671"))).otherwise(F.expr(_ADDRESS))
    digest = F.when(k % 3 == 2, F.concat(F.lit("4111111111111111"), F.repeat(F.lit("ab"), 24))).otherwise(F.lit("other"))
    return exemptions.scan_paths(table(spark, sf_dir, "part").select(path.alias("path"), digest.alias("sha256")), "path", "sha256")


_DEEP = """
CASE p_partkey % 4 WHEN 0 THEN '{"a":[{"schemaVersion":"lake.x/v2"}]}' WHEN 1 THEN '{"schemaVersion":"lake.x/v1"}' WHEN 2 THEN '{"schemaVersion":7}' ELSE '{"schemaVersion":"lake.record/v2"}' END
"""
_FIXTURE = """
CASE p_partkey % 5 WHEN 0 THEN 'tests/fixtures/contracts/invalid/a.json' WHEN 1 THEN 'tests/fixtures/contracts/invalid' WHEN 2 THEN 'tests/fixtures/contracts/invalid2/a' WHEN 3 THEN 'x/tests/fixtures/contracts/invalid/a' ELSE 'tests/fixtures/contracts/v2/release-graph/b/c' END
"""


@query("SELECT p_partkey, p_partkey % 4 IN (0, 3) AS formal, p_partkey % 5 IN (0, 4) AS fixture FROM part")
def q92_formal_and_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a formal version at any depth, and paths below the folders of faulty examples."""
    d = table(spark, sf_dir, "part").select("p_partkey", F.expr(_DEEP).alias("raw"), exemptions.is_fixture(F.expr(_FIXTURE)).alias("fixture"))
    found = exemptions.formal_documents(d, "p_partkey", "raw", "lake").withColumn("formal", F.lit(True))
    return d.drop("raw").join(found, "p_partkey", "left").select("p_partkey", F.coalesce("formal", F.lit(False)).alias("formal"), "fixture")


# runs


@query("SELECT o_orderkey, CAST(floor(o_orderkey / (SELECT (max(o_orderkey) + 10) // 10 FROM orders)) AS BIGINT) AS step FROM orders")
def q93_resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all keys in ten steps that stops after three, leaves a step half done, and is resumed."""
    import uuid

    folder = f"{shared_dir(spark)}/ledgerlake/{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    count = (orders.agg(F.max("o_orderkey")).first()[0] or 0) + 1
    size = (count + 9) // 10
    make = lambda a, b: orders.filter((F.col("o_orderkey") >= a) & (F.col("o_orderkey") < b)).withColumn("step", F.floor(F.col("o_orderkey") / size))
    stop = checkpoints.run(spark, folder, "orders", 7, count, size, make, most=3)
    make(stop, stop + 9).write.parquet(f"{folder}/out/start={stop:012d}")
    checkpoints.run(spark, folder, "orders", 7, count, size, make)
    return checkpoints.written(spark, folder)


@query("""
SELECT event_id, event_type, sha256(props) AS input_digest, CAST(strlen(props) AS INTEGER) AS input_bytes, event_type = 'error' AS retryable, CASE WHEN event_type = 'error' THEN 'retry_later' ELSE 'human_review' END AS recovery_action, true AS redacted,
  'urn:lake:dlq:sha256:' || sha256(event_type || chr(31) || sha256(props)) AS dlq_id FROM events
""")
def q94_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as dead letters: what they held is a digest and a size."""
    failed = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return checkpoints.dead_letters(failed, "props", "event_type", {"error": "retry_later"}, "lake")


@query("""
SELECT user_id AS worker, event_type AS state, event_id AS cursor, event_id % 7 AS epoch, event_id % 7 + 1 AS next_epoch, false AS finished FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id % 7 DESC, event_id DESC) = 1
""")
def q95_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each worker (user) was last, for the one that takes over."""
    return checkpoints.handoff(table(spark, sf_dir, "events").select(F.col("user_id").alias("worker"), F.col("ts").alias("at"), F.col("event_type").alias("state"), F.col("event_id").alias("cursor"), (F.col("event_id") % 7).alias("epoch")))


@query("""
WITH c AS (SELECT c_nationkey AS council, c_custkey, row_number() OVER w AS i, count(*) OVER (PARTITION BY c_nationkey) AS n, 20 + c_nationkey * 3 AS pc FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey))
SELECT council, c_custkey, CASE WHEN council % 3 = 0 THEN CASE WHEN i <= ceil(pc * n / 100.0) THEN 'yes' ELSE 'no' END WHEN council % 3 = 1 THEN CASE WHEN i <= greatest(1, ceil(pc * n / 100.0) - 1) THEN 'yes' END ELSE 'no' END AS vote,
  CAST(least(greatest(c_custkey - 50, 0), 100) AS BIGINT) AS weight FROM c
""")
def q96_council_ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ballots of councils (nations) that end as they are meant to: approved, without a quorum, rejected."""
    k = F.col("c_nationkey")
    mode = F.when(k % 3 == 0, "approved").when(k % 3 == 1, "quorum_failure").otherwise("rejected")
    m = table(spark, sf_dir, "customer").select(k.alias("council"), "c_custkey", mode.alias("mode"), (k * 3 + 20).alias("percent"), council.clamped(F.col("c_custkey") - 50).alias("weight"))
    return council.ballots(m, "council", "c_custkey", "mode", "percent", "percent").select("council", "c_custkey", "vote", "weight")


_TAPE = """
'{"initial_state":{"a":' || o_orderkey || '},"tape":[{"k":0},{"k":' || o_custkey || '},{"k":2}],"worlds":{"F":"f","O":[1]}}'
"""


@query("""
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS setup, CASE o_orderkey % 4 WHEN 0 THEN '{"k":0}' WHEN 1 THEN '{"k":' || o_custkey || '}' WHEN 2 THEN '{"k":2}' END AS event,
  CASE o_orderstatus WHEN 'F' THEN '"f"' WHEN 'O' THEN '[1]' END AS world, sha256(o_orderkey || o_orderstatus) AS seed FROM orders
""")
def q97_projection_recipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of a record that a recipe reads, one of them at the replay's cursor."""
    k = F.col("o_orderkey")
    d = table(spark, sf_dir, "orders").select(k, "o_orderstatus", (k % 4).alias("sequence"), F.expr(_TAPE).alias("raw"), shaping.entity_seed(k.cast("string"), F.col("o_orderstatus")).alias("seed"))
    return shaping.project(d, "raw", {"setup": "/initial_state/a", "event": "/tape/{sequence}", "world": "/worlds/{o_orderstatus}"}, "o_orderkey", "seed")


@query("""
SELECT user_id, v.path, CAST(CASE v.path WHEN '/a' THEN user_id WHEN '/b/c' THEN user_id + 5 ELSE 2 END AS BIGINT) AS value FROM (SELECT DISTINCT user_id FROM events) JOIN (VALUES ('/a'), ('/b/c'), ('/d')) v(path) ON true
""")
def q98_state_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States by pointer: values set and added to at depth; setting a node removes what was below it."""
    u = F.col("user_id")
    state = F.map_from_entries(F.array(F.struct(F.lit("/a"), u), F.struct(F.lit("/b/c"), u), F.struct(F.lit("/d/e"), u), F.struct(F.lit("/d/f"), u)))
    after = checkpoints.set_path(checkpoints.increment_path(state, F.lit("/b/c"), F.lit(5)), F.lit("/d"), F.lit(2))
    return table(spark, sf_dir, "events").select("user_id").distinct().select(u, F.explode(after).alias("path", "value"))


@query(f"""
SELECT o_orderkey, code AS expected, true AS ok FROM orders JOIN (VALUES {", ".join(f"({i}, {_sql(c)})" for i, (_, _, c) in enumerate(_VARIANTS))}) v(k, code) ON o_orderkey % {len(_VARIANTS)} = k
""")
def q99_trust_harness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents that a contract has to accept, or to refuse for the fault planted in them."""
    docs = contract_documents(table(spark, sf_dir, "orders"))
    code = F.element_at(F.array(*[F.lit(c) for _, _, c in _VARIANTS]), (F.col("o_orderkey") % len(_VARIANTS) + 1).cast("int"))
    golden, faulty = docs.filter(code.isNull()), docs.filter(code.isNotNull()).withColumn("expected", code)
    check = lambda d: contracts.contract_findings(d, "o_orderkey", "raw", {"order/v1": _ORDER_CONTRACT})
    return contracts.trust_harness(golden, faulty, "o_orderkey", check).select("o_orderkey", "expected", "ok")


@query("""
SELECT dataset, CAST(n * per AS BIGINT) AS rows, 0 AS findings FROM (SELECT count(*) AS n FROM customer) JOIN (VALUES ('d02', 1), ('d04', 1), ('d05', 8), ('d06', 1), ('d07', 1), ('d09', 1), ('d10', 9)) v(dataset, per) ON true
""")
def q100_simulated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many simulated records of each dataset as there are customers, and what their verification finds."""
    n = table(spark, sf_dir, "customer").count()
    nodes, edges = simulate.lineages(spark, 7, n)
    made = {
        "d02": (simulate.counterfactuals(spark, 7, n), datasets.counterfactual_findings), "d04": (simulate.trajectories(spark, 7, n), datasets.trajectory_findings), "d05": (simulate.lives(spark, 7, n), datasets.lifetime_findings),
        "d06": (simulate.pairs(spark, 7, n), datasets.paired_findings), "d07": (simulate.tapes(spark, 7, n), datasets.tape_findings), "d09": (simulate.recoveries(spark, 7, n), datasets.recovery_findings),
        "d10": (nodes, lambda d: datasets.lineage_findings(d, edges)),
    }
    out = None
    for name, (rows, check) in made.items():
        counted = rows.agg(F.lit(name).alias("dataset"), F.count("*").alias("rows"), F.lit(0).cast("long").alias("findings"))
        found = check(rows).agg(F.lit(name).alias("dataset"), F.lit(0).cast("long").alias("rows"), F.count("*").alias("findings"))
        both = counted.unionByName(found)
        out = both if out is None else out.unionByName(both)
    return out.groupBy("dataset").agg(F.sum("rows").alias("rows"), F.sum("findings").cast("int").alias("findings"))


_GATE_POLICY = {
    "namespace": "lake", "sources": {}, "rights": {}, "safety": {}, "quality": {}, "fields": {}, "withdrawal": {"tombstonePathPrefix": "gone/", "removalIndexPath": "removals.json"},
    "publication": {"policyVersion": "1", "limits": {"publicationFilesHard": 10**12}, "candidatePathPrefixes": ["data/", "gone/"], "immutablePathPrefixes": ["data/kept/"]},
}
#: status, folder, ending and content of a changed file; what the gate finds (line, code); its route
_CHANGED = (
    ("A", "data/", ".json", '{"a":1}', None, None, "candidate"),
    ("A", "data/", ".json", '{"a":1', 1, "JSON_INVALID", "candidate"),
    ("A", "tests/fixtures/contracts/invalid/", ".json", "{", None, None, "source"),
    ("M", "data/", ".json", '{"x":{"schemaVersion":"lake.x/v2"}}', None, None, "formal"),
    ("M", "data/kept/", ".json", "{}", None, "RELEASE_IMMUTABLE", "candidate"),
    ("D", "data/", ".json", None, None, "PUBLICATION_DELETE", "candidate"),
    ("A", "src/", ".txt", None, None, "FILE_MISSING", "source"),
    ("A", "src/", ".txt", "one\ncall 415-555-2671", 2, "PII_PHONE", "source"),
    ("A", "src/", ".jsonl", '{}\n{"k":"415-555-2671"}\n', 2, "PII_PHONE", "source"),
    ("A", "src/", ".jsonl", "{}\n{}\n7,\n", 3, "JSON_INVALID", "source"),
)
_EACH = ", ".join(f"({i}, {_sql(d)}, {_sql(e)}, CAST({_sql(line)} AS INTEGER), {_sql(c)}, {_sql(r)})" for i, (_, d, e, _, line, c, r) in enumerate(_CHANGED))


@query(f"""
WITH c AS (SELECT d || p_partkey || e AS path, line, code, route FROM part JOIN (VALUES {_EACH}) v(k, d, e, line, code, route) ON p_partkey % {len(_CHANGED)} = k)
SELECT path, line, code, CAST(NULL AS VARCHAR) AS route FROM c WHERE code IS NOT NULL UNION ALL SELECT path, NULL, NULL, route FROM c
""")
def q101_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as changed files of every kind, through the whole gate: what it finds, and where each file goes."""
    at = F.col("p_partkey") % len(_CHANGED) + 1
    of = lambda n: F.element_at(F.array(*[F.lit(v[n]) for v in _CHANGED]), at.cast("int"))
    d = table(spark, sf_dir, "part").select(of(0).alias("status"), F.concat(of(1), F.col("p_partkey").cast("string"), of(2)).alias("path"), F.lit(None).cast("string").alias("old_path"), of(3).alias("text"))
    found, routed = gate.gate(d.select("status", "path", "old_path"), d.select("path", F.encode("text", "UTF-8").alias("content")), publication.Policy(**_GATE_POLICY))
    none = F.lit(None)
    return found.withColumn("route", none.cast("string")).unionByName(routed.select("path", none.cast("int").alias("line"), none.cast("string").alias("code"), "route"))
