"""A release as a graph of files: from the latest pointer to all that it reaches.

``files`` (path, content) is the tree. The walk goes by rounds of equi-joins over the
references of all documents, so its number is the depth of the graph; the rules of the
pointer, the release and its dataset entries are columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.walk import walk
from ledgerlake.operators import trust
from ledgerlake.session import cut

LATEST = "catalog/latest.json"
# fixed values: where a pointer lies, the fields that it repeats, those that an entry repeats, and the counts that add up
POINTER_PATH = r"\Acatalog/releases/(release-[0-9]{4}-[0-9]{2}-[0-9]{2}-[a-z0-9][a-z0-9.-]{0,63})\.json\z"
REPEATED = ("releaseId", "createdAt", "sequence", "previousReleaseId", "totals", "policy")
ENTRY = ("datasetId", "datasetVersion", "counts", "contentBytes")
COUNTS = ("records", "transcripts", "deliberations", "providerReasoning")


def _json(doc: Column, path: str) -> Column:
    return F.to_json(F.try_variant_get(doc, path, "variant"))


def _sum(items: Column, path: str) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda n, x: n + F.coalesce(F.try_variant_get(x, path, "long"), F.lit(0)))


def references(files: DataFrame) -> DataFrame:
    """(parent, path, sha256, bytes): each object in a JSON or JSONL file that names a path and a digest.

    Every line of a JSONL file is a document; what isn't JSON has no references.
    """
    text = F.decode("content", "UTF-8")
    docs = files.filter(F.call_function("is_valid_utf8", F.col("content"))).select(F.col("path").alias("parent"), F.when(F.col("path").endswith(".jsonl"), F.split(text, "\n")).otherwise(F.array(text)).alias("lines"))
    rows = walk(docs.select("parent", F.posexplode("lines").alias("line", "raw")), "raw").filter(F.col("key").isin("path", "sha256", "bytes"))
    at = F.regexp_replace("w_path", r"/[^/]*\z", "")
    value = lambda k: F.max(F.when(F.col("key") == k, F.col("value"))).alias(k)
    found = rows.withColumnRenamed("path", "w_path").groupBy("parent", "line", at.alias("at")).agg(value("path"), value("sha256"), value("bytes"))
    return found.filter("path is not null and sha256 is not null").select("parent", "path", "sha256", F.col("bytes").try_cast("long").alias("bytes"))


def reachable(edges: DataFrame, root: str = LATEST) -> DataFrame:
    """(path): ``root`` and all that references lead to; cycles end, as no path is visited twice."""
    spark = edges.sparkSession
    edges = cut(edges.select("parent", "path").distinct(), "references")
    seen = frontier = cut(spark.createDataFrame([(root,)], "path string"), "reached")
    while not frontier.isEmpty():
        step = edges.join(frontier.select(F.col("path").alias("parent")), "parent", "left_semi").select("path").distinct()
        frontier = cut(step.join(seen, "path", "left_anti"), "reached")
        seen = seen.unionByName(frontier)
    return seen


def coverage(changed: DataFrame, edges: DataFrame, root: str = LATEST) -> DataFrame:
    """(subject, code): ``changed`` paths that the release doesn't reach."""
    return changed.select("path").distinct().join(reachable(edges, root), "path", "left_anti").select(F.col("path").alias("subject"), F.lit("ARTIFACT_COVERAGE").alias("code"))


def release_findings(files: DataFrame, datasets: list[str], latest: str = LATEST) -> DataFrame:
    """(subject, code) for the release that ``latest`` points to and its ``datasets``, in their order.

    Every reference of a JSON or JSONL file is to a file of the right size and digest; the
    pointer repeats the release, entries repeat their manifests, and totals add up.
    """
    docs = files.filter(F.col("path").endswith(".json")).select("path", F.try_parse_json(F.decode("content", "UTF-8")).alias("d"))
    get = lambda c, p: F.try_variant_get(F.col(c), p, "string")
    top = files.filter(F.col("path") == latest).select(F.try_parse_json(F.decode("content", "UTF-8")).alias("l"))
    p = top.select(get("l", "$.releasePointer.path").alias("pointer")).join(docs.select(F.col("path").alias("pointer"), F.col("d").alias("p")), "pointer")
    p = p.withColumn("id", get("p", "$.releaseId")).withColumn("release", get("p", "$.releaseManifest.path"))
    r = p.join(docs.select(F.col("path").alias("release"), F.col("d").alias("r")), "release")
    doc, entries, worlds = F.col("r"), F.try_variant_get("r", "$.datasets", "array<variant>"), F.try_variant_get("r", "$.worldPackSources", "array<variant>")
    sums = {"datasets": F.size(entries).cast("long"), "worldPackSources": F.size(worlds).cast("long"), "contentBytes": _sum(entries, "$.contentBytes") + _sum(worlds, "$.bytes")}
    sums |= {c: _sum(entries, f"$.counts.{c}") for c in COUNTS}
    total = F.try_variant_get("r", "$.totals", "map<string,bigint>")
    expected = F.create_map(*[x for k, v in sums.items() for x in (F.lit(k), v)])
    same = F.forall(F.array(*[_json(F.col("p"), f"$.{f}").eqNullSafe(_json(doc, f"$.{f}")) for f in REPEATED]), lambda x: x)
    ids = F.transform(entries, lambda e: F.try_variant_get(e, "$.datasetId", "string"))
    paths = F.transform(entries, lambda e: F.try_variant_get(e, "$.manifest.path", "string"))
    rule = trust._findings
    out = rule(p, "pointer", ("CATALOG_POINTER_PATH", F.regexp_extract("pointer", POINTER_PATH, 1) == F.col("id")))
    out = out.unionByName(rule(r, "pointer", ("CATALOG_RELEASE_MISMATCH", same)))
    out = out.unionByName(
        rule(
            r, "release",
            ("RELEASE_MANIFEST_PATH", F.col("release") == F.concat(F.lit("releases/"), "id", F.lit("/manifest.json"))),
            ("RELEASE_DATASETS", ids == F.array(*[F.lit(x) for x in datasets])),
            ("RELEASE_TOTALS", F.array_sort(F.map_entries(total)) == F.array_sort(F.map_entries(expected))),
            ("ARTIFACT_ORDER", paths == F.array_sort(paths)),
            ("ARTIFACT_DUPLICATE", F.size(F.array_distinct(paths)) == F.size(paths)),
        )
    )
    e = r.select("id", F.explode(entries).alias("e")).withColumn("manifest", get("e", "$.manifest.path"))
    e = e.join(docs.select(F.col("path").alias("manifest"), F.col("d").alias("m")), "manifest")
    repeats = F.forall(F.array(*[_json(F.col("m"), f"$.{f}").eqNullSafe(_json(F.col("e"), f"$.{f}")) for f in ENTRY]), lambda x: x)
    placed = F.col("manifest") == F.concat(F.lit("releases/"), "id", F.lit("/datasets/"), get("e", "$.datasetId"), F.lit(".json"))
    out = out.unionByName(rule(e, "manifest", ("DATASET_MANIFEST_PATH", placed), ("DATASET_RELEASE_MISMATCH", repeats)))
    links = trust.descriptors(references(files).select("path", "bytes", "sha256").distinct(), files)
    return out.unionByName(links.filter("code <> 'ARTIFACT_DUPLICATE'")).distinct()
