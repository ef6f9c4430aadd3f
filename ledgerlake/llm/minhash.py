"""Near-duplicate documents by an inverted join on MinHash signature coordinates.

A document's signature has K coordinates. Posting every document under each of its
coordinate-value pairs, two documents with Jaccard similarity s meet in about K * s
lists. A pair counts if it meets in at least t of K lists; such a pair must share one
of the K - t + 1 rarest pairs of either document (prefix filter), so only those are
posted, the common lists are skipped, and the collisions of the documents that meet
are counted on the signatures. What is above the match threshold is confirmed on the
full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, map_arrow, small, table
from ledgerlake.llm.components import components

WORDS = 5
COORDINATES = 64
#: A linked pair is missed with at most this probability.
MISS = 1e-7
#: Documents that are compared side by side in one task: posted ones, and full sets
#: by number and by shingles. Larger lists and groups are cut into blocks.
POSTED, SET_DOCS, SET_SHINGLES = 1024, 512, 1 << 20
#: About so many documents of a large group are compared with all others of it first.
PIVOTS = 16
#: The words of a longer text (in bytes) aren't held all at once.
LONG_TEXT = 1 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_ODD, _XOR = (np.random.default_rng(20).integers(0, 1 << 32, (2, 512), dtype=np.uint64).astype(np.uint32))
_ODD |= np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int = WORDS, most: int = 150_000):
        self.words, self.most, self.known = words, most, {}

    def _hashed(self, word: bytes) -> int:
        h = self.known.get(word)
        if h is None:
            h = xxhash.xxh3_64_intdigest(word)
            if len(self.known) <= self.most:
                self.known[word] = h
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes split exactly at space and \t \n \v \f \r, and lower only A-Z
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        words = data.split() if len(data) < LONG_TEXT else (m[0] for m in _WORD.finditer(data))
        a = np.fromiter(map(self._hashed, words), np.uint64)
        if len(self.known) > self.most:
            self.known.clear()
        n = min(self.words, len(a))
        if not n:
            return a
        x = np.full(len(a) - n + 1, n, np.uint64)
        for i in range(n):
            x = _mix(x) + a[i : i + len(x)]
        return np.unique(_mix(x))


def signature(shingles: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The minima of ``k`` hash functions over a set that isn't empty."""
    h = (shingles ^ (shingles >> np.uint64(29))).astype(np.uint32)
    least = None
    for at in range(0, len(h), 4096):
        m = ((h[None, at : at + 4096] ^ _XOR[:k, None]) * _ODD[:k, None]).min(axis=1)
        least = m if least is None else np.minimum(least, m)
    return least


def match_threshold(similarity: float, k: int = COORDINATES, miss: float = MISS) -> int:
    """The largest t for which a pair of this similarity has t equal coordinates
    of ``k`` but for a probability of ``miss``."""
    below, t = 0.0, 0
    while t < k:
        below += math.comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def _signed(docs: DataFrame, key: str, text: str, words: int, k: int) -> DataFrame:
    """id, n_shingles, h (the set's identity) and sig per row; h is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingler(words)
        for batch in batches:
            n, h, sig = [], [], []
            for t in batch.column(1):
                s = of(t.as_py())
                n.append(len(s))
                h.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s, k).view(np.int32) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(h, pa.binary()), pa.array(sig, pa.list_(pa.int32()))],
                ["id", "n_shingles", "h", "sig"],
            )

    return map_arrow(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")), run, "id long, n_shingles long, h binary, sig array<int>")


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key; they come sorted by it."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        k = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
        cuts = [0, *(np.flatnonzero((np.diff(k, axis=0) != 0).any(axis=1)) + 1).tolist(), len(k)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if (here := tuple(k[a])) != at:
                if held:
                    yield pa.Table.from_batches(held)
                at, held = here, []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class _Labels:
    """Which rows of a group are linked so far; an edge comes out once per merge."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.label = ids, np.arange(len(ids))
        self.edges: list[tuple[int, int]] = []

    def link(self, row: int, others: np.ndarray) -> None:
        for x in np.unique(self.label[others]):
            if x != self.label[row]:
                other = others[self.label[others] == x][0]
                self.edges.append((int(self.ids[row]), int(self.ids[other])))
                self.label[self.label == x] = self.label[row]


class _Signatures:
    """Documents of a group that agree in ``t`` coordinates, and whose sizes allow it."""

    def __init__(self, rows: pa.Table, similarity: float, t: int):
        self.size, self.similarity, self.t = rows["n_shingles"].to_numpy(), similarity, t
        self.sig = rows["sig"].combine_chunks().values.to_numpy().reshape(rows.num_rows, -1)

    def linked(self, row: int, others: np.ndarray) -> np.ndarray:
        a, b = self.size[row], self.size[others]
        others = others[np.minimum(a, b) >= self.similarity * np.maximum(a, b)]
        return others[(self.sig[others] == self.sig[row]).sum(axis=1) >= self.t]


class _Sets:
    """Documents of a group whose full sets have 100 * intersection >= percent * union."""

    def __init__(self, rows: pa.Table, percent: int):
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in rows["set"]]
        self.percent, self.size = percent, np.array([len(s) for s in sets])
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.here = flat.astype(np.int32), np.zeros(len(names), bool)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])
        self.owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.size)

    def linked(self, row: int, others: np.ndarray) -> np.ndarray:
        a, b = self.size[row], self.size[others]
        others = others[(100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)) & (b > 0)]
        if not len(others):
            return others
        own = self.flat[self.begin[row] : self.begin[row + 1]]
        self.here[own] = True
        part = slice(self.begin[others[0]], self.begin[others[-1] + 1])
        both = np.bincount(self.owner[part][self.here[self.flat[part]]], minlength=len(self.size))[others]
        self.here[own] = False
        return others[100 * both >= self.percent * (a + self.size[others] - both)]


def _compared(ids: np.ndarray, kernel, rows: int, after: int = 0) -> _Labels:
    """Links of the first ``rows`` documents with those behind them, from ``after`` on."""
    labels = _Labels(ids)
    for r in range(rows):
        others = np.arange(max(r + 1, after), len(ids))
        others = others[labels.label[others] != labels.label[r]]
        if len(others) and len(found := kernel.linked(r, others)):
            labels.link(r, found)
    return labels


def _linked(rows: DataFrame, kernel, payload: list[str], pivots: int) -> DataFrame:
    """(a, b): edges that connect all documents of each group which ``kernel`` links.

    ``rows``: g (the group), id, n (its documents), blocks (into how many it is cut) and
    ``payload``, of which ``kernel`` is made for the documents of a task. A block is
    compared within itself after its documents have been compared with about ``pivots``
    of the whole group, which come to all of its blocks. Documents that are linked with
    the same pivot as most needn't be compared with each other any more; all others are
    compared with the whole group. So a group of copies costs in proportion to its size.
    """
    blocks, none = F.col("blocks").cast("int"), F.array().cast("array<struct<i:int,role:int>>")
    at = lambda i, role: F.struct(i.cast("int").alias("i"), F.lit(role).alias("role"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    own = F.pmod(F.xxhash64("id"), blocks)
    pivot = (blocks > 1) & (F.pmod(F.xxhash64("id", "g"), F.ceil(F.col("n") / pivots)) == 0)
    copies = F.concat(F.array(at(own, 1)), F.when(pivot, F.transform(every(blocks), lambda i: at(i, 0))).otherwise(none))
    dealt = rows.select("g", "id", (blocks > 1).alias("large"), *payload, F.inline(copies))
    dealt = dealt.repartition("g", "i").sortWithinPartitions("g", "i", "role", "id").select("g", "i", "role", "large", "id", *payload)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for here in _grouped(batches, ["g", "i"]):
            if here.num_rows < 2 and not here["large"][0].as_py():
                continue
            ids, role = here["id"].to_numpy(), here["role"].to_numpy()
            labels = _compared(ids, kernel(here), len(ids) - 1)
            yield _found(labels.edges)
            if here["large"][0].as_py():
                pivot_of: dict[int, int] = {}
                for x, i in zip(labels.label[role == 0].tolist(), ids[role == 0].tolist(), strict=True):
                    pivot_of[x] = min(i, pivot_of.get(x, i))
                mine = role == 1
                yield _found(list(zip(ids[mine].tolist(), map(pivot_of.get, labels.label[mine].tolist()), strict=True)), here["g"][0].as_py())

    found = cut(map_arrow(dealt, first, "g long, a long, b long"), "linked")
    edges, labelled = found.filter("g is null").select("a", "b"), found.filter("g is not null")
    if labelled.isEmpty():
        return edges
    most = labelled.filter("b is not null").groupBy("g", "b").count().groupBy("g").agg(F.max_by("b", "count").alias("most"))
    rest = labelled.join(small(cut(most, "most")), "g", "left").filter(~F.coalesce(F.col("b") == F.col("most"), F.lit(False)))
    rest = cut(rest.select("g", F.col("a").alias("id")).distinct(), "rest")
    if rest.isEmpty():
        return edges
    sizes = cut(rest.groupBy("g").agg(F.count("*").alias("r")), "rest-sizes")
    again = rows.join(small(sizes), "g").join(rest.withColumn("rest", F.lit(True)), ["g", "id"], "left")
    others = F.ceil(F.col("r") * F.col("blocks") / F.col("n")).cast("int")
    pair = lambda i, j, role: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(role).alias("role"))
    none = F.array().cast("array<struct<i:int,j:int,role:int>>")
    copies = F.concat(
        F.transform(every(others), lambda j: pair(own, j, 1)),
        F.when(F.col("rest"), F.transform(every(blocks), lambda i: pair(i, F.pmod(F.xxhash64("id"), others), 0))).otherwise(none),
    )
    dealt = again.select("g", "id", *payload, F.inline(copies))
    dealt = dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "role", "id").select("g", "i", "j", "role", "id", *payload)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for here in _grouped(batches, ["g", "i", "j"]):
            n = int((here["role"].to_numpy() == 0).sum())
            if 0 < n < here.num_rows:
                yield _found(_compared(here["id"].to_numpy(), kernel(here), n, n).edges)

    return edges.unionByName(map_arrow(dealt, second, "g long, a long, b long").select("a", "b"))


def _found(pairs: list[tuple[int, int | None]], group: int | None = None) -> pa.RecordBatch:
    a, b = ([p[i] for p in pairs] for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array([group] * len(pairs), pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["g", "a", "b"])


def candidate_edges(reps: DataFrame, similarity: float, k: int = COORDINATES) -> DataFrame:
    """(a, b): edges that connect all ``reps`` (id, n_shingles, sig) whose signatures
    agree in the match threshold's number of coordinates, directly or over others.

    Only documents of which that many coordinate-value pairs are shared by anything
    at all are posted, and those under their rarest shared pairs.
    """
    t = match_threshold(similarity, k)
    pair = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posted = reps.select("id", F.posexplode("sig").alias("pos", "value")).select("id", pair.alias("pair"))
    lists = cut(posted.groupBy("pair").agg(F.count("*").alias("n")).filter("n > 1"), "lists")
    mine = posted.join(small(lists), "pair").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "pair"))).alias("shared"))
    mine = mine.filter(F.size("shared") >= t)
    prefix = F.slice("shared", F.lit(1), F.size("shared") - (t - 1))
    posts = cut(mine.select("id", F.explode(prefix).alias("p")).select("id", "p.n", "p.pair"), "posts")
    posts = posts.join(reps, "id").withColumn("blocks", F.ceil(F.col("n") / POSTED)).withColumnRenamed("pair", "g")
    return _linked(posts, lambda rows: _Signatures(rows, similarity, t), ["n_shingles", "sig"], PIVOTS)


def confirmed_edges(docs: DataFrame, groups: DataFrame, percent: int, key: str, text: str, words: int) -> DataFrame:
    """(a, b): edges that connect the documents of each of ``groups`` (node, root, n_shingles)
    whose shingle sets have 100 * intersection >= percent * union, directly or over others."""
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / SET_DOCS), F.ceil(F.col("s") / SET_SHINGLES))
    groups = groups.join(sizes, "root").select(F.col("node").alias("id"), F.col("root").alias("g"), "n", blocks.alias("blocks"))
    groups = small(cut(groups, "groups"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(groups, "id")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingler(words)
        for batch in batches:
            sets = pa.array([of(t.as_py()).tobytes() for t in batch.column(4)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], sets], ["id", "g", "n", "blocks", "set"])

    sets = map_arrow(rows.select("id", "g", "n", "blocks", "text"), shingled, "id long, g long, n long, blocks long, set binary")
    return _linked(sets, lambda rows: _Sets(rows, percent), ["set"], PIVOTS)


def near_duplicates(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text", words: int = WORDS, k: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Two documents are linked when their sets of ``words``-word shingles have
    100 * intersection >= percent * union; a component is what links connect, its id
    its smallest doc_id, and that document is kept. With fewer words the whole
    sequence is one shingle; null, empty and blank texts have none and are linked with
    nothing. doc_id identifies a document: rows that repeat one are in its component
    and share its verdict; rows without a doc_id are alone, have no component id and
    are kept. Other columns are ignored; an empty table gives an empty result.
    """
    signed = cut(_signed(docs, key, text, words, k), "signed")
    known = signed.filter(F.col("h").isNotNull() & F.col("id").isNotNull())
    classes = cut(known.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = known.join(classes.select(F.col("rep").alias("id"), "h"), ["h", "id"], "left_semi").dropDuplicates(["id"])
    reps = cut(reps.select("id", "n_shingles", "sig"), "reps")
    rough = components(candidate_edges(reps, percent / 100, k))
    rough = rough.join(reps.select(F.col("id").alias("node"), "n_shingles"), "node")
    exact = cut(components(confirmed_edges(docs, cut(rough, "rough"), percent, key, text, words)), "components")
    found = signed.join(small(classes.filter("copies > 1").select("h", "rep")), "h", "left")
    found = found.withColumn("rep", F.coalesce("rep", "id"))
    found = found.join(small(exact.select(F.col("node").alias("rep"), "root")), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "rep"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of all documents at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def components_sql(source: str, percent: int) -> str:
    """SQL for ``near_duplicates`` of the DuckDB relation ``source`` (WITH RECURSIVE bodies)."""
    return f"""
w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS a
  FROM {source}
), sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(a) < {WORDS} THEN array_to_string(a, ' ') ELSE array_to_string(a[i : i + {WORDS - 1}], ' ') END AS g
  FROM (SELECT doc_id, a, unnest(range(1, greatest(len(a) - {WORDS - 1}, 1) + 1)) AS i FROM w WHERE len(a) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY 1
), lnk AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= {percent} * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT r.a, lnk.b FROM reach r JOIN lnk ON r.b = lnk.a
), comp AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1
)"""


SQL = f"""
WITH RECURSIVE {components_sql('documents', 85)}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN comp ON comp.doc_id = d.doc_id
"""
