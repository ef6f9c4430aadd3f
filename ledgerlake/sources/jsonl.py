"""JSONL sources and sinks with strict, per-line errors."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.canonical import canonical_text, parsed
from ledgerlake.session import cut


def shard_lines(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """path (file name), line_no (from 0) and line of JSONL files.

    Files are read whole, as shards are capped at a megabyte; a last line without LF
    is a line, and what follows the last LF is none.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    text = F.decode("content", "UTF-8")
    name = F.element_at(F.split("path", "/"), -1)
    lines = files.select(name.alias("path"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"), F.length(text).alias("n"), F.size(F.split(text, "\n")).alias("k"))
    return lines.filter(~((F.col("line_no") == F.col("k") - 1) & (F.col("line") == ""))).select("path", F.col("line_no").cast("long"), "line")


def records(lines: DataFrame, mode: str = "policy") -> DataFrame:
    """path, line_no, canonical and error of the lines that aren't blank; a value that
    isn't an object is an error."""
    p = lines.filter(F.trim("line") != "").withColumn("p", parsed("line", mode))
    error = F.coalesce("p.error", F.when(~F.col("p.canonical").startswith("{"), F.lit("JSON_OBJECT")))
    return p.select("path", "line_no", "p.canonical", error.alias("error"))


def file_findings(spark: SparkSession, folder: str, max_file: int = 1_000_000, max_line: int = 262_144, max_depth: int = 64) -> DataFrame:
    """(path, line_no, code) for files of a folder: size, UTF-8, NUL bytes, a missing last LF,
    and for lines: empty, too long, invalid JSON, too deep."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    whole = F.array(
        F.when(F.col("length") > max_file, F.lit("FILE_SIZE_LIMIT")),
        F.when(F.expr("position(X'00', content)") > 0, F.lit("BINARY_FORBIDDEN")),
        F.when(~F.call_function("is_valid_utf8", F.col("content")), F.lit("TEXT_UTF8")),
        F.when(F.col("path").endswith(".jsonl") & (F.col("length") > 0) & (F.substring("content", -1, 1) != F.lit(b"\n")), F.lit("JSONL_LF")),
    )
    of_files = files.select("path", F.lit(None).cast("long").alias("line_no"), F.explode(F.filter(whole, lambda c: c.isNotNull())).alias("code"))
    good = files.filter(F.col("path").endswith(".jsonl") & F.call_function("is_valid_utf8", F.col("content")))
    parts = F.split(F.regexp_replace(F.decode("content", "UTF-8"), r"\n\z", ""), "\n")
    lines = good.select("path", F.posexplode(parts).alias("line_no", "line")).withColumn("p", parsed("line", "policy"))
    code = (
        F.when(F.octet_length("line") + 1 > max_line, "JSONL_LINE_LIMIT")
        .when(F.col("line") == "", "JSONL_EMPTY_LINE")
        .when(F.col("p.error") == "JSON_DEPTH", "JSON_DEPTH")
        .when(~F.col("p.ok"), "JSON_INVALID")
        .when(F.col("p.depth") > max_depth, "JSON_DEPTH")
    )
    return of_files.unionByName(lines.select("path", F.col("line_no").cast("long"), code.alias("code")).filter(F.col("code").isNotNull()))


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def listing(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _hadoop(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path(folder))) if fs.exists(path(folder)) else []


def write_shards(rows: DataFrame, manifest: dict, folder: str, resume: bool = False) -> list[str]:
    """Write a plan's shards and then its manifest; the names of the files written.

    Executors write a file per shard into a staging folder; the driver renames them,
    which is all that it does per shard, and writes the manifest last. With ``resume``
    shards that are there with the same digest stay, and others are replaced; shards
    that the plan lacks go in any case.
    """
    spark = rows.sparkSession
    fs, path = _hadoop(spark, folder)
    fs.mkdirs(path(folder))
    have: set[str] = set()
    wanted = {s["path"]: s for s in manifest["shards"]}
    if resume and any(n.startswith("part-") for n in listing(spark, folder)):
        seen = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.jsonl").load(folder)
        digests = seen.select(F.element_at(F.split("path", "/"), -1).alias("n"), F.sha2("content", 256).alias("h")).collect()
        have = {r.n for r in digests if r.n in wanted and wanted[r.n]["sha256"] == f"sha256:{r.h}"}
    for name in listing(spark, folder):
        if name.startswith("part-") and name not in have:
            fs.delete(path(f"{folder}/{name}"), False)
    todo = [s["index"] for n, s in sorted(wanted.items()) if n not in have]
    staging = f"{folder}/.staging"
    fs.delete(path(staging), True)
    if todo:
        missing = spark.createDataFrame([(i,) for i in todo], "shard int")
        dealt = rows.join(missing, "shard", "left_semi").repartition("shard").sortWithinPartitions("shard", "pos")
        dealt.select("shard", "line").write.option("lineSep", "\n").partitionBy("shard").text(staging)
    written = []
    for i in todo:
        source = next(f.getPath() for f in fs.listStatus(path(f"{staging}/shard={i}")) if f.getPath().getName().startswith("part-"))
        name = f"part-{i:05d}.jsonl"
        fs.rename(source, path(f"{folder}/{name}"))
        written.append(name)
    fs.delete(path(staging), True)
    temporary, final = path(f"{folder}/.manifest.tmp"), path(f"{folder}/manifest.json")
    out = fs.create(temporary, True)
    out.write(bytearray((canonical_text(manifest) + "\n").encode()))
    out.close()
    fs.delete(final, False)
    fs.rename(temporary, final)
    return written


def read_manifest(spark: SparkSession, folder: str) -> dict:
    """The manifest of a folder; refused unless its bytes are canonical JSON and one LF."""
    return _canonical_file(spark, f"{folder}/manifest.json")


def resolve_manifest(spark: SparkSession, root: str, manifest: str | dict = "manifest.json") -> tuple[str, dict]:
    """(folder, manifest): a mapping is taken as it is, once it has a canonical form; a path is
    of a file, and relative to ``root`` unless it is absolute; ``root`` may itself be the file."""
    if isinstance(manifest, dict):
        return root, json.loads(canonical_text(manifest))
    fs, path = _hadoop(spark, root)
    if fs.exists(path(root)) and fs.getFileStatus(path(root)).isFile():
        file = root
    else:
        file = manifest if path(manifest).isAbsolute() else f"{root}/{manifest}"
    return file.rsplit("/", 1)[0], _canonical_file(spark, file)


def _canonical_file(spark: SparkSession, file: str) -> dict:
    text = spark.read.text(file, wholetext=True).first().value
    value = json.loads(text)
    if not isinstance(value, dict) or canonical_text(value) + "\n" != text:
        raise ValueError("the manifest isn't canonical")
    return value


def pruned(spark: SparkSession, folder: str, manifest: dict, low: str, high: str) -> DataFrame:
    """Lines of the shards whose key range (canonical text) meets [low, high]: the
    manifest is a zone map, and other files aren't opened."""
    names = [s["path"] for s in manifest["shards"] if canonical_text(s["maxKey"]) >= low and canonical_text(s["minKey"]) <= high]
    if not names:
        return spark.createDataFrame([], "path string, line_no long, line string")
    return shard_lines(spark, folder, "{" + ",".join(names) + "}")


def write_split(rows: DataFrame, is_second: Column, first: str, second: str) -> None:
    """One table as two JSON Lines folders, such as candidates and labels: rows for which ``is_second``
    is true go to ``second``, all others to ``first``. What made them runs once."""
    both = cut(rows.withColumn("__second", F.coalesce(is_second, F.lit(False))), "split")
    for folder, mine in ((first, ~F.col("__second")), (second, F.col("__second"))):
        both.filter(mine).drop("__second").write.mode("overwrite").json(folder)
