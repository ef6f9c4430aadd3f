"""Exact dedup by deterministic block naming, in DataFrame operations only.

The normalised text is cut into blocks of a fixed number of code points. Equal
blocks get equal integer names by sorting; then adjacent names are paired and the
pairs are named in the same way, level by level, until each document has a single
name. A name stands for exactly one string, so equality of (number of blocks,
name) is equality of texts, without any chance of a collision.

What is sorted are the distinct blocks and pairs, so a block that a third of all rows
hold is one row there. Names go back by a join on a block's hash, which is narrow;
blocks that share their hash with another are joined by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import blocks_for, cut, small, table

#: What normalisation deletes: space, tab, LF, VT, FF and CR.
SPACES = r"[\x20\x09-\x0D]+"
BLOCK = 1024
#: Names are given per bucket of the keys' hash; one bucket has about so many distinct keys.
BUCKET_ROWS = 2_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _parts(text: Column, block: int) -> Column:
    norm = normalised(text)
    return F.when(norm == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))


def _named(distinct: DataFrame, key: list[str], rows: int) -> DataFrame:
    """``distinct`` with the column ``name``, a positive number that is another for each row.

    Rows are dealt by the key's hash into buckets; within a bucket they are sorted by
    ``key`` and numbered, and the bucket's number makes the name unique.
    """
    n = blocks_for(rows, BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64(*key), F.lit(n))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*key)).cast("long")
    return distinct.withColumn("bucket", bucket).withColumn("name", rank * F.lit(n) + F.col("bucket")).drop("bucket")


def _name_blocks(docs: DataFrame, level: DataFrame, block: int, hashed) -> DataFrame:
    """``level`` (with the hash h of each block) with the blocks' names in its place.

    Blocks sort by (hash, text). ``docs`` are read again for the distinct blocks, which
    are shuffled once to see whose hash is theirs alone: such a hash stands for its block,
    and only those are narrow rows from there on. Where blocks share a hash, the rows are
    joined by their text; their names are negative.
    """
    rows = max(1, level.count())
    texts = docs.select(F.explode(_parts(F.col("text"), block)).alias("block")).distinct().select("block", hashed(F.col("block")).alias("h"))
    hashes = cut(texts.groupBy("h").agg(F.count("*").alias("n")), "hashes")
    names = cut(_named(hashes.filter("n = 1").select("h"), ["h"], rows), "names")
    shared = hashes.filter("n > 1").select("h")
    if shared.isEmpty():
        return level.join(small(names), "h").drop("h")
    level = cut(_rows(docs, block, hashed, text=True), "blocks-with-text")
    others = _named(texts.join(shared, "h", "left_semi"), ["h", "block"], rows).select("block", (-F.col("name")).alias("name"))
    clash = level.join(shared, "h", "left_semi").drop("h").join(cut(others, "other-names"), "block").drop("block")
    return level.drop("block").join(names, "h").drop("h").unionByName(clash)


def _name_pairs(level: DataFrame, rows: int) -> DataFrame:
    """One level up: two adjacent names become the name of their pair."""
    carried = [F.max(c).alias(c) for c in ("doc_id", "n_cp", "text_sha256", "blocks")]
    pairs = level.groupBy("uid", F.shiftright("pos", 1).alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0)).alias("right"),
        *carried,
    )
    pairs = cut(pairs, "pairs")
    names = cut(_named(pairs.select("left", "right").distinct(), ["left", "right"], rows), "pair-names")
    return pairs.join(small(names), ["left", "right"]).drop("left", "right")


def _rows(docs: DataFrame, block: int, hashed, text: bool = False) -> DataFrame:
    """A row per block: uid (the document's number), pos, h (the block's hash), doc_id,
    blocks, and with the first of them n_cp and text_sha256."""
    norm = docs.select(
        F.col("doc_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_cp"), normalised(F.col("text")).alias("norm"), _parts(F.col("text"), block).alias("parts")
    )
    norm = norm.withColumn("text_sha256", F.sha2(F.encode("norm", "UTF-8"), 256)).withColumn("uid", F.monotonically_increasing_id())
    rows = norm.select("uid", "doc_id", "n_cp", "text_sha256", F.size("parts").cast("long").alias("blocks"), F.posexplode("parts").alias("pos", "block"))
    only_first = F.col("pos") == 0
    for c in ("n_cp", "text_sha256"):
        rows = rows.withColumn(c, F.when(only_first, F.col(c)))
    rows = rows.withColumn("h", hashed(F.col("block")))
    return rows if text else rows.drop("block")


def identities(docs: DataFrame, block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_cp (code points of the original text),
    text_sha256 (of the normalised text), and (blocks, name), the text's identity.

    Null text counts as empty; the empty text has 1 block, the empty string.
    Repeated rows and repeated or null doc_ids stay separate rows. Other columns
    of ``docs`` are not read.
    """
    docs = docs.select("doc_id", "text")
    # the rows' numbers are written with them: they hold whatever is computed again
    level = cut(_rows(docs, block, hashed), "blocks")
    most = level.agg(F.coalesce(F.max("pos"), F.lit(0))).first()[0] + 1
    level = cut(_name_blocks(docs, level, block, hashed), "level")
    done: list[DataFrame] = []
    keep = ["doc_id", "n_cp", "text_sha256", "blocks", "name"]
    # A document is done when its name is alone; which level that is follows from
    # its number of blocks, so (blocks, name) can't mix names of two levels.
    width = 1
    while True:
        done.append(level.filter(F.col("blocks") <= width).select(*keep))
        if width >= most:
            break
        rest = level.filter(F.col("blocks") > width)
        width *= 2
        level = cut(_name_pairs(rest, max(1, level.count())), "level")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return cut(out, "identities")


def exact_dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Which documents stay of each group of equal texts.

    Texts are equal when identical after deleting space, tab, LF, VT, FF and CR;
    null is the empty text. Of equal texts stays the row with the most code points
    in the original text, then the smallest doc_id (null after all numbers); of
    rows that repeat that doc_id and length exactly, all are ``kept``. Returns
    doc_id, keep_id, group_size, kept, text_sha256, one row per row of ``docs``;
    an empty table gives an empty result, and other columns are ignored.
    """
    rows = identities(docs, block)
    best = F.max(F.struct(F.col("n_cp"), (-F.col("doc_id")).alias("d")))
    groups = rows.groupBy("blocks", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    groups = small(cut(groups.filter("group_size > 1"), "groups"))
    found = rows.join(groups, ["blocks", "name"], "left")
    best_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(-F.col("best.d"))
    same_length = F.col("group_size").isNull() | (F.col("n_cp") == F.col("best.n_cp"))
    return found.select(
        "doc_id",
        best_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (best_id.eqNullSafe(F.col("doc_id")) & same_length).alias("kept"),
        "text_sha256",
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``exact_dedup`` of all documents."""
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), n AS (
  SELECT doc_id, length(t) AS n_cp, regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM d
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM n
WINDOW w AS (PARTITION BY norm ORDER BY n_cp DESC, doc_id)
"""
