"""Line dedup by the number of distinct sites that a line appears on.

HyperLogLog sketches of the sites are merged per line hash; where the estimate lies
near the threshold the sites are counted exactly. A line on enough sites is
boilerplate: it stays where it comes first in the corpus and goes everywhere else. The
list of boilerplate lines is sent to the documents, which stay where they are; only a
list too long for that is joined with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlake.llm.common import cut, map_arrow, small, table

MIN_SITES = 10
#: Lines of fewer characters (after trimming) don't count; blank ones never do.
MIN_CHARS = 1
#: log2 of the sketch's size, and how far from the threshold (as a share, some five
#: standard errors of 1.04 / sqrt(2 ** LG_K)) an estimate is trusted.
LG_K, NEAR = 10, 0.17
#: The white space that is trimmed from a line.
SPACES = " \t\x0b\x0c\r"
#: The boilerplate lines are sent to all documents if they take so many bytes at most,
#: with so many for each line beside its text.
LIST_BYTES, LINE_BYTES = 32 << 20, 300


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _occurrences(docs: DataFrame, key: str, text: str, site: str, min_chars: int) -> DataFrame:
    """key, of (the text's hash), site, pos, the trimmed line, and h and g (128 bits of its
    hash) of each line that is long enough."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("of"), F.col(site).alias("site"), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(SPACES))).filter(F.length("line") >= max(1, min_chars))
    return rows.withColumn("h", F.xxhash64("line")).withColumn("g", F.xxhash64(F.lit(1), "line"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """h, g, line and ``first`` (key, pos), the first place, of each line on ``min_sites``
    sites or more.

    A line needs as many occurrences as sites, so lines with fewer never get a
    sketch. Null is no site.
    """
    line = ["h", "g"]
    often = cut(lines.groupBy(*line).agg(F.count("site").alias("n")).filter(F.col("n") >= min_sites).select(*line), "often")
    lines = lines.join(small(often), line)
    spread = lines.groupBy(*line).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"), F.min(F.struct("key", "pos", "line")).alias("first")
    )
    spread = cut(spread.filter(F.col("sites") >= min_sites * (1 - NEAR)), "spread")
    near = F.col("sites") <= min_sites * (1 + NEAR)
    doubtful = lines.filter(F.col("site").isNotNull()).join(small(cut(spread.filter(near).select(*line), "near")), line)
    exact = doubtful.select(*line, "site").distinct().groupBy(*line).agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites)
    found = spread.filter(~near).unionByName(spread.join(exact, line, "left_semi"))
    return found.select(*line, "first.line", F.struct("first.key", "first.pos").alias("first"))


def line_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
    list_bytes: int = LIST_BYTES,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and removed_lines (long).

    All rows and columns stay; a column named removed_lines is replaced. A null text
    stays null; a text of which nothing is left is empty. A line counts as equal to
    another when they are identical after trimming white space; blank lines stay. The
    first place is the one with the smallest key (null before all), then position; rows
    that repeat it keep the line too. An empty table comes back empty.
    """
    docs = docs.drop("removed_lines")
    lines = _occurrences(docs, key, text, site, min_chars)
    found = cut(boilerplate(lines, min_sites), "boilerplate")
    size = found.agg(F.sum(F.octet_length("line") + LINE_BYTES)).first()[0] or 0
    if size <= list_bytes:
        return _removed_in_place(docs, found, key, text)
    return _removed_by_join(docs, lines, found, key, text)


def _removed_in_place(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    firsts = {r.line: (r.key, r.pos) for r in found.select("line", "first.key", "first.pos").toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(firsts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = shared.value
        for batch in batches:
            at = batch.schema.get_field_index(text)
            keys = batch.column(batch.schema.get_field_index(key))
            new, removed = [], []
            for i, t in enumerate(batch.column(at).to_pylist()):
                n = 0
                if t and firsts:
                    lines = t.split("\n")
                    hits = [p for p, x in enumerate(lines) if x.strip(SPACES) in firsts]
                    if hits:
                        own = keys[i].as_py()
                        gone = {p for p in hits if firsts[lines[p].strip(SPACES)] != (own, p)}
                        if n := len(gone):
                            t = "\n".join([x for p, x in enumerate(lines) if p not in gone])
                new.append(t)
                removed.append(n)
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64())], [*batch.schema.names, "removed_lines"])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField("removed_lines", LongType())]))


def _removed_by_join(docs: DataFrame, lines: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """The same for a list of any length: the places of its lines are joined with the documents."""
    where = lines.drop("line").join(found, ["h", "g"]).filter(~F.struct("key", "pos").eqNullSafe(F.col("first")))
    drops = cut(where.groupBy("key", "of").agg(F.collect_set("pos").alias("__drop")), "drops")
    drops = drops.withColumnsRenamed({"key": "__key", "of": "__of"})
    both = docs.join(drops, F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__of")), "left")

    def kept(parts: Column) -> Column:
        at = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__drop"))
        return F.array_join(F.transform(at, lambda i: F.get(parts, i)), "\n")

    # the lines are bound to a lambda's variable: split once, not once per line
    left = F.transform(F.array(_lines(F.col(text))), kept)[0]
    hit = F.col("__drop").isNotNull()
    removed = F.when(hit, F.size("__drop")).otherwise(F.lit(0)).cast("long")
    out = both.withColumn("removed_lines", removed).withColumn(text, F.when(hit, left).otherwise(F.col(text)))
    return out.drop("__key", "__of", "__drop")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, removed_lines and the cleaned text of every document."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "removed_lines", "text")


def cleaned_sql(source: str) -> str:
    """SQL for ``line_dedup`` of the DuckDB relation ``source``: its doc_id, source, text, removed."""
    return f"""
SELECT d.doc_id, d.source, d.lang,
       CASE WHEN r.n IS NULL THEN d.text ELSE coalesce(r.kept, '') END AS text,
       coalesce(r.n, 0) AS removed_lines
FROM {source} d LEFT JOIN (
  WITH l AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM {source}
  ), b AS (
    SELECT trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k, count(DISTINCT source) AS sites, min(struct_pack(a := doc_id, b := pos)) AS first
    FROM l WHERE length(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13))) >= {MIN_CHARS} GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}
  ), m AS (
    SELECT l.*, (b.k IS NOT NULL AND struct_pack(a := doc_id, b := pos) <> b.first) AS gone FROM l LEFT JOIN b ON trim(l.line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) = b.k
  )
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept
  FROM m GROUP BY doc_id HAVING count(*) FILTER (gone) > 0
) r ON d.doc_id = r.doc_id
"""


SQL = "SELECT doc_id, removed_lines, text FROM (" + cleaned_sql("documents") + ")"
