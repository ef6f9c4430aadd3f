"""Canonical shards: order, fragment, lay out, write and verify.

Records are ordered by the canonical text of their key and then their body. A line
over its cap becomes a chain of fragments. The layout halves the ordered lines by
bytes, again and again, until every group is within its target; each round is one
aggregation over line sizes, so nothing but the number of shards limits it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.canonical import canonical_text, parsed, strict_parse
from ledgerlake.functions.ids import content_id, sha256_digest
from ledgerlake.functions.pointers import parts
from ledgerlake.session import cut

HARD_LINE = 262_144
HARD_SHARD = 1_000_000
FRAGMENT_KIND = "artifact-fragment/v1"
MANIFEST_KIND = "canonical-shards/v1"


@dataclass(frozen=True)
class Limits:
    """Bytes: target and cap of a shard, cap of a line (with its LF), target of a fragment's text."""

    target: int = 768_000
    cap: int = HARD_SHARD
    line: int = HARD_LINE
    fragment: int = 128_000

    def __post_init__(self) -> None:
        values = (self.target, self.cap, self.line, self.fragment)
        if any(type(v) is not int or v < 1 for v in values):
            raise ValueError("limits are positive integers")
        if not (self.target <= self.cap <= HARD_SHARD and self.line <= min(self.cap, HARD_LINE) and self.fragment <= self.line):
            raise ValueError("limits must be fragment <= line <= cap and target <= cap, within the hard caps")


class ShardingError(ValueError):
    pass


def prepare(raw: DataFrame, column: str, key_path: str | None, namespace: str) -> DataFrame:
    """body, key (canonical text) and id of each JSON record of ``column``, ``error`` where
    it is refused. Without a key path the id is the key."""
    steps = None if key_path is None else parts(key_path)
    reserved = f"{namespace}.{FRAGMENT_KIND}"

    @F.pandas_udf("key string, error string")
    def keyed(bodies):
        import pandas as pd

        rows = []
        for b in bodies:
            key, error = None, None
            if b is not None:
                value = strict_parse(b)
                if isinstance(value, dict) and value.get("schemaVersion") == reserved:
                    error = "RESERVED_SCHEMA"
                elif steps is not None:
                    try:
                        for s in steps:
                            value = value[int(s)] if isinstance(value, list) else value[s]
                        key = canonical_text(value)
                    except (KeyError, IndexError, TypeError, ValueError):
                        error = "KEY_MISSING"
            rows.append((key, error))
        return pd.DataFrame(rows, columns=["key", "error"])

    p = raw.select(parsed(column, "lake").alias("p")).select(F.col("p.canonical").alias("body"), F.col("p.error").alias("e"))
    k = p.select("body", "e", keyed("body").alias("k"))
    urn = content_id(F.col("body"), "record", namespace)
    own = F.to_json(F.array(urn))
    key = F.coalesce(F.col("k.key"), own.substr(F.lit(2), F.length(own) - 2)) if steps is None else F.col("k.key")
    return k.select("body", key.alias("key"), urn.alias("id"), F.coalesce("e", "k.error").alias("error"))


def fragment(body: str, record: str, limits: Limits, namespace: str) -> list[str]:
    """The lines (without LF) of a record that is too long for one.

    Each fragment takes as much text as its target and the line's cap allow. The
    sizes of all prefixes, as text and as escaped JSON, are cumulated once, so that a
    cut is a search in them. A fragment names how many there are, which changes its
    own size, so the number is repeated until it holds.
    """
    chars = np.array([len(c.encode()) for c in body], np.int64)
    escaped = np.array([len(json.dumps(c, ensure_ascii=False).encode()) - 2 for c in body], np.int64)
    text_to, json_to = np.concatenate([[0], np.cumsum(chars)]), np.concatenate([[0], np.cumsum(escaped)])

    def line(data: str, index: int, count: int, before: str | None) -> str:
        own = data.encode()
        return canonical_text(
            {
                "artifactId": record,
                "artifactKind": "record",
                "count": count,
                "data": data,
                "encoding": "utf-8",
                "index": index,
                "mediaType": "application/json",
                "previousFragmentSha256": before,
                "schemaVersion": f"{namespace}.{FRAGMENT_KIND}",
                "sha256": "sha256:" + hashlib.sha256(own).hexdigest(),
                "utf8Bytes": len(own),
            }
        )

    count = 1
    for _ in range(64):
        lines: list[str] = []
        at, before = 0, None
        while at < len(body):
            empty = len(line("", len(lines), count, before).encode())
            to = int(np.searchsorted(text_to, text_to[at] + limits.fragment, "right")) - 1
            # the number of digits of utf8Bytes is part of the size: allow for it, then fix it
            room = limits.line - 1 - empty + 1
            fits = lambda n: json_to[n] - json_to[at] + len(str(text_to[n] - text_to[at])) <= room  # noqa: B023, E731
            to = min(to, int(np.searchsorted(json_to, json_to[at] + room, "right")) - 1)
            while to > at and not fits(to):
                to -= 1
            if to <= at:
                raise ShardingError("the line cap is too small for a fragment")
            data = body[at:to]
            lines.append(line(data, len(lines), count, before))
            before = "sha256:" + hashlib.sha256(data.encode()).hexdigest()
            at = to
        if len(lines) == count:
            return lines
        count = len(lines)
    raise ShardingError("the number of fragments doesn't settle")


def physical_lines(records: DataFrame, limits: Limits, namespace: str) -> DataFrame:
    """key, body, part, line, bytes (with LF) of each physical line; only long records go through Python."""
    size = F.octet_length("body") + 1
    short = records.filter(size <= limits.line).select("key", "body", F.lit(0).alias("part"), F.col("body").alias("line"))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, body, record in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lines = fragment(body, record, limits, namespace)
                n = len(lines)
                yield pa.RecordBatch.from_arrays([pa.array([key] * n), pa.array([body] * n), pa.array(range(n), pa.int32()), pa.array(lines)], ["key", "body", "part", "line"])

    long = records.filter(size > limits.line).select("key", "body", "id").mapInArrow(cut_up, "key string, body string, part int, line string")
    return short.unionByName(long).withColumn("bytes", (F.octet_length("line") + 1).cast("long"))


def ordered(lines: DataFrame, *by: str) -> DataFrame:
    """``lines`` with pos (their place in the order ``by``) and until (bytes up to and with them).

    Rows are dealt by range, sorted and written; the totals of the parts, a few numbers
    each, give the parts' offsets.
    """
    dealt = lines.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rid", F.monotonically_increasing_id())
    dealt = cut(dealt, "ordered").withColumn("chunk", F.shiftright("rid", 33))
    totals = dealt.groupBy("chunk").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    w = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    offsets = totals.select("chunk", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n0"), F.coalesce(F.sum("b").over(w), F.lit(0)).alias("b0"))
    own = Window.partitionBy("chunk").orderBy("rid").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.join(offsets, "chunk").withColumn("until", F.col("b0") + F.sum("bytes").over(own))
    return placed.withColumn("pos", F.col("n0") + F.col("rid").bitwiseAND((1 << 33) - 1)).drop("rid", "chunk", "n0", "b0")


def layout(placed: DataFrame, limits: Limits) -> DataFrame:
    """``placed`` (pos, bytes, until) with shard, by halving.

    A group over the target is cut where twice the bytes before the cut are nearest to
    its own, at the first such place. A line alone may be over the target, never over
    the cap. Only places and sizes are halved; the lines get their shard by one join.
    """
    placed = cut(placed, "placed")
    rows = cut(placed.select("pos", "bytes", "until", F.lit(0).cast("long").alias("group")), "groups")
    if not rows.filter(F.col("bytes") > limits.cap).isEmpty():
        raise ShardingError("a line is over the cap of a shard")
    while True:
        first = F.min(F.col("until") - F.col("bytes"))
        groups = rows.groupBy("group").agg(first.alias("from"), F.sum("bytes").alias("total"), F.count("*").alias("n"), F.max("pos").alias("last"))
        large = cut(groups.filter((F.col("total") > limits.target) & (F.col("n") > 1)), "large")
        if large.isEmpty():
            break
        inside = rows.join(large, "group").filter(F.col("pos") < F.col("last"))
        off = F.abs(F.col("total") - 2 * (F.col("until") - F.col("from")))
        cuts = inside.groupBy("group").agg(F.min(F.struct(off.alias("off"), F.col("pos").alias("pos"))).alias("c")).select("group", F.col("c.pos").alias("at"))
        split = rows.join(cuts, "group", "left")
        # a group is named by its first position
        named = F.when(F.col("at").isNotNull() & (F.col("pos") > F.col("at")), F.col("at") + 1).otherwise(F.col("group"))
        rows = cut(split.withColumn("group", named).drop("at"), "groups")
    names = rows.select("group").distinct()
    shards = names.withColumn("shard", F.row_number().over(Window.orderBy("group")) - 1)  # a row per shard
    return placed.join(rows.join(shards, "group").select("pos", "shard"), "pos")


def shard_entries(rows: DataFrame) -> DataFrame:
    """One row per shard: path, bytes, records (lines), logicalRecords, minKey, maxKey, sha256.

    A shard's lines, one cap in bytes at most, meet in one task for the digest.
    """
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    return rows.groupBy("shard").agg(
        F.format_string("part-%05d.jsonl", F.first("shard")).alias("path"),
        F.sum("bytes").alias("bytes"),
        F.count("*").alias("records"),
        F.count_if(F.col("part") == 0).alias("logicalRecords"),
        F.min_by("key", "pos").alias("minKey"),
        F.max_by("key", "pos").alias("maxKey"),
        sha256_digest(F.concat(text, F.lit("\n"))).alias("sha256"),
    )


def content_hash(bodies: DataFrame, *by: str) -> str:
    """sha256 of all canonical lines in order, whatever the layout. The digest is
    sequential by definition: one task streams the sorted bodies and holds none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = hashlib.sha256()
        for b in batches:
            for body in b.column(b.num_columns - 1).to_pylist():
                h.update(body.encode() + b"\n")
        yield pa.RecordBatch.from_arrays([pa.array(["sha256:" + h.hexdigest()])], ["digest"])

    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(by)]
    one = bodies.orderBy(*by).select(*keys, "body").coalesce(1).mapInArrow(run, "digest string")
    row = one.first()
    return row.digest if row else "sha256:" + hashlib.sha256().hexdigest()


def merkle_digest(entries: DataFrame) -> str:
    """A digest of the shards' digests in order: what to use where one task can't read all."""
    digests = F.transform(F.array_sort(F.collect_list(F.struct("shard", "sha256"))), lambda x: x["sha256"])
    return entries.agg(F.sha2(F.array_join(digests, "\n"), 256).alias("digest")).first().digest


def plan(raw: DataFrame, column: str, namespace: str, key_path: str | None = "id", limits: Limits = Limits()) -> tuple[DataFrame, dict]:
    """The lines with their shard, and the manifest. Refused records end in a ShardingError."""
    records = cut(prepare(raw, column, key_path, namespace), "records")
    bad = records.filter(F.col("error").isNotNull()).select("error").first()
    if bad:
        raise ShardingError(bad.error)
    rows = cut(layout(ordered(physical_lines(records, limits, namespace), "key", "body", "part"), limits), "layout")
    entries = shard_entries(rows).orderBy("shard").collect()  # a row per shard, without text
    n, size = records.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("body") + 1), F.lit(0))).first()
    manifest = {
        "canonicalBytes": size,
        "compression": "none",
        "contentHash": content_hash(records, "key", "body"),
        "encoding": "utf-8",
        "fragmentTargetBytes": limits.fragment,
        "keyPath": key_path,
        "layoutBytes": sum(e.bytes for e in entries),
        "lineMaxBytes": limits.line,
        "lines": sum(e.records for e in entries),
        "records": n,
        "schemaVersion": f"{namespace}.{MANIFEST_KIND}",
        "shardMaxBytes": limits.cap,
        "shardTargetBytes": limits.target,
        "shards": [
            {"bytes": e.bytes, "index": e.shard, "logicalRecords": e.logicalRecords, "maxKey": json.loads(e.maxKey), "minKey": json.loads(e.minKey), "path": e.path, "records": e.records, "sha256": e.sha256}
            for e in entries
        ],
        "unicodeNormalization": "NFC",
    }
    return rows, manifest


def verify(lines: DataFrame, manifest: dict, namespace: str) -> DataFrame:
    """(path, line, code) of everything wrong with shards.

    ``lines`` has path, line_no (from 0) and line (without LF), as ``sources.jsonl.shard_lines``
    reads them. Checked are the set of files, sizes, digests, counts, caps, the
    soft target, canonical text, fragment chains, key order and the totals.
    """
    spark = lines.sparkSession
    declared = spark.createDataFrame([(s["path"], s["bytes"], s["records"], s["sha256"]) for s in manifest["shards"]], "path string, bytes long, records long, sha256 string")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    seen = lines.groupBy("path").agg(
        F.sum(F.octet_length("line") + 1).alias("b"), F.count("*").alias("n"), sha256_digest(F.concat(text, F.lit("\n"))).alias("h")
    )
    both = declared.join(seen, "path", "full_outer")
    rules = [
        ("SHARD_MISSING", F.col("n").isNull()),
        ("SHARD_UNDECLARED", F.col("records").isNull()),
        ("SHARD_BYTES", F.col("b") != F.col("bytes")),
        ("SHARD_COUNT", F.col("n") != F.col("records")),
        ("SHARD_HASH", F.col("h") != F.col("sha256")),
        ("SHARD_CAP", F.col("b") > manifest["shardMaxBytes"]),
        ("SHARD_TARGET", (F.col("b") > manifest["shardTargetBytes"]) & (F.col("n") > 1)),
        ("SHARD_NAME", ~F.col("path").rlike(r"^part-[0-9]{5}\.jsonl$")),
    ]
    codes = F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(c)) for c, t in rules]), lambda c: c.isNotNull())
    of_files = both.select("path", F.lit(None).cast("long").alias("line_no"), F.explode(codes).alias("code"))
    p = lines.withColumn("p", parsed("line", "lake"))
    bad_line = F.when(~F.col("p.ok"), F.concat(F.lit("LINE_"), "p.error")).when(F.col("p.canonical") != F.col("line"), F.lit("LINE_CANONICAL"))
    bad_line = F.when(F.octet_length("line") + 1 > manifest["lineMaxBytes"], F.lit("LINE_BYTES")).otherwise(bad_line)
    of_lines = p.select("path", "line_no", bad_line.alias("code")).filter(F.col("code").isNotNull())
    return of_files.unionByName(of_lines).unionByName(_chain_findings(lines, namespace)).unionByName(_total_findings(lines, manifest, namespace))


def fragments_of(lines: DataFrame, namespace: str) -> DataFrame:
    """The fragment lines, with their fields as columns."""
    fields = "artifactId string, count int, data string, index int, previousFragmentSha256 string, schemaVersion string, sha256 string, utf8Bytes int"
    f = lines.filter(F.contains("line", F.lit(f'"schemaVersion":"{namespace}.{FRAGMENT_KIND}"'))).withColumn("f", F.from_json("line", fields))
    return f.filter(F.col("f.schemaVersion") == f"{namespace}.{FRAGMENT_KIND}").select("path", "line_no", "f.*")


def _chain_findings(lines: DataFrame, namespace: str) -> DataFrame:
    w = Window.partitionBy("artifactId").orderBy("path", "line_no")
    before = lambda c: F.lag(c).over(w)
    f = fragments_of(lines, namespace)
    start = F.col("index") == 0
    digest = F.concat(F.lit("sha256:"), F.sha2("data", 256))
    wrong = (
        F.when((F.col("sha256") != digest) | (F.octet_length("data") != F.col("utf8Bytes")), "FRAGMENT_HASH")
        .when(start & F.col("previousFragmentSha256").isNotNull(), "FRAGMENT_CHAIN")
        .when(~start & ~(before("index") + 1).eqNullSafe(F.col("index")), "FRAGMENT_ORDER")
        .when(~start & ~before("sha256").eqNullSafe(F.col("previousFragmentSha256")), "FRAGMENT_CHAIN")
        .when(~start & (before("count") != F.col("count")), "FRAGMENT_COUNT")
    )
    of_chain = f.groupBy("artifactId").agg(F.min("path").alias("path"), F.min("line_no").alias("line_no"), F.count("*").alias("n"), F.max("count").alias("count"))
    short = of_chain.filter(F.col("n") % F.col("count") != 0).select("path", "line_no", F.lit("FRAGMENT_COUNT").alias("code"))
    return f.select("path", "line_no", wrong.alias("code")).filter(F.col("code").isNotNull()).unionByName(short)


def logical_records(lines: DataFrame, namespace: str) -> DataFrame:
    """path, line_no and body of each record, fragments put together again."""
    is_fragment = F.contains("line", F.lit(f'"schemaVersion":"{namespace}.{FRAGMENT_KIND}"'))
    whole = lines.filter(~is_fragment).select("path", "line_no", F.col("line").alias("body"))
    f = fragments_of(lines, namespace)
    chain = F.sum(F.when(F.col("index") == 0, 1).otherwise(0)).over(Window.partitionBy("artifactId").orderBy("path", "line_no"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "data"))), lambda x: x["data"]), "")
    again = f.withColumn("chain", chain).groupBy("artifactId", "chain").agg(F.min(F.struct("path", "line_no")).alias("at"), joined.alias("body"))
    return whole.unionByName(again.select("at.path", "at.line_no", "body"))


def _total_findings(lines: DataFrame, manifest: dict, namespace: str) -> DataFrame:
    records = logical_records(lines, namespace)
    keyed = prepare(records.select("body"), "body", manifest["keyPath"], namespace)
    n, size = keyed.agg(F.count_if(F.col("error").isNull()), F.coalesce(F.sum(F.octet_length("body") + 1), F.lit(0))).first()
    found = []
    if n != manifest["records"]:
        found.append((None, None, "TOTAL_RECORDS"))
    if size != manifest["canonicalBytes"]:
        found.append((None, None, "TOTAL_BYTES"))
    if not found and content_hash(keyed, "key", "body") != manifest["contentHash"]:
        found.append((None, None, "CONTENT_HASH"))
    spark = lines.sparkSession
    return spark.createDataFrame(found, "path string, line_no long, code string")


def key_order_findings(lines: DataFrame, *key: str) -> DataFrame:
    """(path, line_no, code) where logical keys don't rise from line to line, across shards too.

    ``lines`` has path (``part-NNNNN.jsonl``), line_no and the columns ``key``. A shard's
    number is in its name, so its first line meets the last of the shard before by a
    join: no task sees more than one shard's lines.
    """
    here = F.struct(*key)
    before = F.lag(here).over(Window.partitionBy("path").orderBy("line_no"))
    inside = lines.withColumn("before", before).filter(F.col("before").isNotNull() & ~(F.col("before") < here)).select("path", "line_no")
    number = F.regexp_extract("path", r"part-([0-9]+)", 1).cast("long")
    edges = lines.groupBy("path").agg(F.min_by(here, "line_no").alias("first"), F.max_by(here, "line_no").alias("last"), F.min("line_no").alias("line_no")).withColumn("n", number)
    ahead = edges.select((F.col("n") + 1).alias("n"), F.col("last").alias("before"))
    across = edges.join(ahead, "n").filter(~(F.col("before") < F.col("first"))).select("path", "line_no")
    return inside.unionByName(across).withColumn("code", F.lit("KEY_ORDER"))


def shard_edge_findings(lines: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """(path, code) of shards whose first or last key isn't the declared one (path, first_key, last_key), or that aren't there."""
    seen = lines.groupBy("path").agg(F.min_by(key, "line_no").alias("a"), F.max_by(key, "line_no").alias("b"))
    j = declared.join(seen, "path", "left")
    rules = {
        "SHARD_MISSING": F.col("a").isNull(),
        "SHARD_FIRST_KEY": F.col("a").isNotNull() & ~F.col("a").eqNullSafe(F.col("first_key")),
        "SHARD_LAST_KEY": F.col("b").isNotNull() & ~F.col("b").eqNullSafe(F.col("last_key")),
    }
    codes = F.filter(F.array(*[F.when(bad, F.lit(c)) for c, bad in rules.items()]), lambda c: c.isNotNull())
    return j.select("path", F.explode(codes).alias("code"))


#: what a manifest has to say, and for some fields what
HEADER = {
    "canonicalBytes": None, "compression": "none", "contentHash": None, "encoding": "utf-8", "fragmentTargetBytes": None, "keyPath": None, "layoutBytes": None,
    "lineMaxBytes": None, "lines": None, "records": None, "schemaVersion": None, "shardMaxBytes": None, "shardTargetBytes": None, "shards": None, "unicodeNormalization": "NFC",
}


def header_findings(manifest: dict, namespace: str, limits: Limits = Limits()) -> list[str]:
    """Codes of what is wrong with a manifest itself: missing fields, versions, and sizes that
    aren't whole, don't nest or exceed ``limits``."""
    out = [f"HEADER_MISSING:{f}" for f in HEADER if f not in manifest]
    out += [f"HEADER_VALUE:{f}" for f, v in {**HEADER, "schemaVersion": f"{namespace}.{MANIFEST_KIND}"}.items() if v is not None and f in manifest and manifest[f] != v]
    names = ("fragmentTargetBytes", "lineMaxBytes", "shardTargetBytes", "shardMaxBytes")
    whole = {n: manifest.get(n) for n in names}
    wrong = [n for n, v in whole.items() if n in manifest and (isinstance(v, bool) or not isinstance(v, int) or v < 1)]
    out += [f"HEADER_SIZE:{n}" for n in wrong]
    if not wrong and all(n in manifest for n in names):
        nested = [("shardTargetBytes", whole["shardMaxBytes"]), ("shardMaxBytes", limits.cap), ("lineMaxBytes", min(whole["shardMaxBytes"], limits.line)), ("fragmentTargetBytes", whole["lineMaxBytes"])]
        out += [f"HEADER_LIMIT:{n}" for n, most in nested if whole[n] > most]
    key = manifest.get("keyPath")
    return sorted(out + ([] if key is None or (isinstance(key, str) and key) else ["HEADER_VALUE:keyPath"]))


def summary(manifest: dict) -> dict:
    """What a verified dataset is: its digest, counts and sizes."""
    return {"content_hash": manifest["contentHash"], "shards": len(manifest["shards"]), **{k: manifest[f] for k, f in {"records": "records", "lines": "lines", "canonical_bytes": "canonicalBytes", "layout_bytes": "layoutBytes"}.items()}}
