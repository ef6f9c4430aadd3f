"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors stay where they are read. Each partition takes them in blocks and keeps a block
sorted by every dimension; the queries come to all partitions in waves of a bounded
size. A query reads the lists of a block from the ends that its own components favour,
scores every vector that it meets (random access), and stops as soon as the sum of its
products with the next values of the lists, the most that an unread vector can reach,
is below its k-th score. Lists whose next entries lower that sum most are read first,
and the k-th score is carried from block to block. What leaves a partition are the k
best of each query; a window over those gives the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, map_arrow, table

K = 5
#: Vectors in a block, and queries that go to all partitions at once (of 64 dimensions: 8 MB).
VECTORS, WAVE = 8192, 16_384
SCALE = 256.0
#: Entries of a list that are read at once: so many at first, then twice as many each time.
CHUNK = 64


class SortedLists:
    """A block of integer vectors with their sorted per-dimension lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        by = np.argsort(self.vectors, axis=0, kind="stable")
        self.values = np.ascontiguousarray(np.take_along_axis(self.vectors, by, axis=0).T)
        self.by = np.ascontiguousarray(by.T.astype(np.int32))

    def top(self, query: np.ndarray, own: int | None, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int, int]:
        """(ids, scores, sorted accesses, random accesses) of the k best for ``query``, ties
        to the smaller id.

        ``own`` is an id that takes no part. ``floor`` is a score that k candidates of
        other blocks reach: what is below it may be left out.
        """
        n = len(self.ids)
        dims = np.flatnonzero(query)
        unseen = np.ones(n, bool)
        best = np.empty(0, np.int64)
        score = np.empty(0, self.vectors.dtype)
        kth = floor

        def met(fresh: np.ndarray) -> None:
            nonlocal best, score, kth
            new = self.vectors.take(fresh, axis=0) @ query
            if own is not None:
                new, fresh = new[mine := self.ids[fresh] != own], fresh[mine]
            if len(new) > k:
                kth = max(kth, np.partition(new, len(new) - k)[len(new) - k])
            ok = np.flatnonzero(new >= kth)
            best, score = np.concatenate([best, fresh[ok]]), np.concatenate([score, new[ok]])
            order = np.lexsort((best, -score))[:k]  # rows are in the order of their ids
            best, score = best[order], score[order]
            if len(score) == k:
                kth = max(kth, score[-1])

        if not len(dims):  # every score is 0: the lists say nothing
            met(np.arange(n))
            return self.ids[best], score, 0, n
        q = query[dims]
        down = q > 0  # read from the large end
        # an entry's place in the flat lists is its list's favoured end and a step per entry read
        step = np.where(down, -1, 1)
        end = dims * n + np.where(down, n - 1, 0)
        depth = np.zeros(len(dims), np.int64)
        chunk, reads, left = CHUNK, 0, n
        values, by, half = self.values.ravel(), self.by.ravel(), (len(dims) + 1) // 2
        head = q * values[end]
        while left and head.sum() >= kth:
            # the lists whose next entries lower the bound most
            until = np.minimum(depth + chunk, n)
            ahead = q * values[end + step * np.minimum(until, n - 1)]
            read = np.argpartition(ahead - head, half - 1)[:half]
            lo = np.where(down[read], end[read] - until[read] + 1, end[read] + depth[read])
            size = until[read] - depth[read]
            entries = np.concatenate([by[x : x + y] for x, y in zip(lo.tolist(), size.tolist(), strict=True)])
            reads += len(entries)
            depth[read], head[read] = until[read], ahead[read]
            met_now = np.zeros(n, bool)
            met_now[entries] = True
            met_now &= unseen
            fresh = np.flatnonzero(met_now)
            if len(fresh):
                unseen[fresh] = False
                left -= len(fresh)
                met(fresh)
            if until[read].max() == n:
                break  # a list read to its end has shown every vector
            chunk *= 2
        return self.ids[best], score, reads, n - left


def _matrix(lists: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows; missing components are 0."""
    width = max((len(x) for x in lists), default=0)
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest type in which all sums of products are exact: floats, doubles or
    64-bit integers."""
    most = (np.abs(a).max(initial=0) + 1) * (np.abs(b).max(initial=0) + 1) * max(1, a.shape[1])
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return a.astype(kind), b.astype(kind)


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``key`` as vec_id, and v: floor(scale * x) of each component as double.

    Vectors that are null or hold null, infinite or NaN components are left out, and
    so are rows without a key.
    """
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    v = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    return vectors.filter(F.col(vector).isNotNull() & F.col(key).isNotNull() & whole).select(F.col(key).cast("long").alias("vec_id"), v.alias("v"))


def _carried(ids: np.ndarray, score: np.ndarray, more_ids: np.ndarray, more: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    ids, score = np.concatenate([ids, more_ids]), np.concatenate([score, more])
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = VECTORS, wave: int = WAVE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` for each of ``queries``.

    Both have (vec_id, v). A query's own id is no candidate; with fewer candidates
    than k, all come. Ties go to the smaller id; rows that repeat an id are all
    candidates, and a repeated query is answered once. Vectors of other lengths count
    as padded with zeros. Empty tables give an empty result.

    The vectors aren't shuffled: queries, ``wave`` at a time, are sent to the partitions,
    and each partition returns k rows per query at most.
    """
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    waves = -(-queries.count() // wave)
    queries = cut(queries.withColumn("wave", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, waves)))), "queries")
    found = None
    for i in range(max(1, waves)):
        part = _wave(vectors, queries.filter(F.col("wave") == i), k, block)
        part = cut(part, "wave") if waves > 1 else part
        found = part if found is None else found.unionByName(part)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _wave(vectors: DataFrame, queries: DataFrame, k: int, block: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each partition for the queries, of which there are few."""
    rows = queries.select("vec_id", "v").toArrow().sort_by("vec_id")
    asked = rows["vec_id"].to_numpy()
    matrix = _matrix([v.values.to_numpy() for v in rows["v"]])
    shared = vectors.sparkSession.sparkContext.broadcast((asked, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, matrix = shared.value
        if not len(asked):
            return
        best = [(np.empty(0, np.int64), np.empty(0)) for _ in asked]
        ids: list[np.ndarray] = []
        vs: list[np.ndarray] = []

        def answer() -> None:
            a, b = _same_width(_matrix(vs), matrix)
            a, b = _exact(a, b)
            lists = SortedLists(np.concatenate(ids), a)
            for i, query in enumerate(b):
                held, score = best[i]
                floor = score[-1] if len(score) == k else -np.inf
                more, its, _, _ = lists.top(query, int(asked[i]), k, floor)
                if len(more):
                    best[i] = _carried(held, score, more, its, k)

        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            vs += [v.values.to_numpy() for v in batch.column(1)]
            if len(vs) >= block:
                answer()
                ids, vs = [], []
        if vs:
            answer()
        sizes = [len(i) for i, _ in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(asked, sizes)),
                pa.array(np.concatenate([i for i, _ in best]).astype(np.int64)),
                pa.array(np.concatenate([s for _, s in best]).astype(np.int64)),
            ],
            ["query_id", "vec_id", "score"],
        )

    return map_arrow(vectors.select("vec_id", "v"), run, "query_id long, vec_id long, score long")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for each vector whose id is divisible by 50."""
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
