"""Sum-of-squares packing of documents into sequences of a fixed length.

Documents come one after another and each is placed where the sum of the squared
counts of partially filled windows, by fill level, ends up smallest; that keeps no
fill level common and so leaves little space. The counts are a level array. When a
packer has placed all of its documents, the windows still open are repacked once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import encode, encoding
from ledgerlake.llm.common import blocks_for, cut, map_arrow, table

WINDOW = 1024
#: One packer sees about so many documents; packers work side by side.
LANE = 16384
#: Sequences of one whole window are numbered from here, those of packers below it.
ALONE = 1 << 62
END = 0


class LevelPacker:
    """Online sum-of-squares packing into windows of ``size`` tokens.

    ``where[i]`` is the (window, offset) of the i-th piece placed; ``close`` may
    move the pieces of windows that are still partially filled at the end.
    """

    def __init__(self, size: int = WINDOW):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.held: dict[int, list[tuple[int, int]]] = {}
        self.windows = 0
        self.where: list[tuple[int, int]] = []

    def _put(self, piece: int, n: int, level: int) -> tuple[int, int]:
        """Put a piece into a window of ``level``, a new one for level 0."""
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window, self.windows = self.windows, self.windows + 1
        held = self.held.setdefault(window, [])
        held.append((piece, n))
        if level + n < self.size:
            self.open[level + n].append(window)
            self.count[level + n] += 1
        else:
            del self.held[window]
        return window, level

    def place(self, n: int) -> None:
        """Place a piece of ``n`` tokens, 1 <= n <= size.

        Raising the number of windows at level h + n and lowering that at h changes
        the sum of squares by 2 * (count[h + n] - count[h]) + 2; a full window
        leaves the array, and a new one has no old level. Ties go to the fullest.
        """
        size, count = self.size, self.count
        level = 0
        if n < size:
            best = 2 * count[n] + 1
            old, new = count[1 : size - n + 1], count[n + 1 : size + 1]
            change = 2 * (new - old) + 2
            change[-1] -= 1
            change[old == 0] = best + 1
            at = size - n - 1 - int(np.argmin(change[::-1]))
            if change[at] <= best:
                level = at + 1
        self.where.append(self._put(len(self.where), n, level))

    def close(self) -> None:
        """No more pieces come: repack the partially filled windows, which the
        level array keeps few, largest piece first into the fullest that has room."""
        left = sorted((x for held in self.held.values() for x in held), key=lambda x: (-x[1], x[0]))
        free = iter(sorted(self.held))
        renamed: dict[int, int] = {}
        self.held.clear()
        self.count[:] = 0
        self.open = [[] for _ in range(self.size + 1)]
        for piece, n in left:
            room = self.count[: self.size - n + 1]
            fits = np.flatnonzero(room)
            window, level = self._put(piece, n, int(fits[-1]) if len(fits) else 0)
            if window not in renamed:
                renamed[window] = next(free)
            self.where[piece] = renamed[window], level


_PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(docs: DataFrame, path: str, size: int, key: str, text: str, keep_ids: bool) -> DataFrame:
    """A row per piece: whole windows of a document and then what is left of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(path)
        for batch in batches:
            rows: list[tuple] = []
            doc: list[int] = []
            ids_of: list[np.ndarray] = []
            for i, t in enumerate(batch.column(1)):
                ids = np.array([*encode(t.as_py(), bpe), END], "<u4")
                for a in range(0, len(ids), size):
                    part = ids[a : a + size]
                    rows.append((a, len(part), zlib.crc32(part.tobytes()), len(ids)))
                    doc.append(i)
                    if keep_ids:
                        ids_of.append(part.astype(np.int32))
            cols = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)]
            names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
            out = [batch.column(0).take(pa.array(doc, pa.int64())), *cols]
            if keep_ids:
                out.append(pa.array(ids_of, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = f"key {docs.schema[key].dataType.simpleString()}, {_PIECES}" + ", ids array<int>" * keep_ids
    return map_arrow(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run, schema)


def pack(
    docs: DataFrame,
    path: str = public_tokenizers.path("byte_bpe_50k.json"),
    size: int = WINDOW,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Where each piece of each document goes.

    A document is its ids and then id 0; null and empty texts are that one id. It
    is cut every ``size`` ids: whole windows stand alone and the rest is placed by
    ``LevelPacker``, among about ``LANE`` others. Rows are dealt to lanes by a number
    written with them, not by ``key``, so a task holds one lane's rests and no more,
    also where a third of all rows have one key or none. Returns
    ``key``, start, length, ids_crc32, doc_tokens, sequence_id and offset (and the
    ids of the piece with ``keep_ids``). Repeated rows are packed each; an empty
    table gives an empty result; other columns of ``docs`` are not read.
    """
    made = _pieces(docs, path, size, key, text, keep_ids).withColumn("row", F.monotonically_increasing_id())
    made = cut(made, "pieces")
    rests = made.filter(F.col("length") < size)
    lane = F.pmod(F.xxhash64("row"), F.lit(blocks_for(rests.count(), LANE)))
    dealt = rests.withColumn("lane", lane).repartition("lane").sortWithinPartitions("lane", "key", "start", "doc_tokens", "ids_crc32", "row").drop("row")
    # whole windows are full as they are, and aren't shuffled
    alone = made.filter(F.col("length") == size).withColumn("sequence_id", F.col("row") + F.lit(ALONE)).withColumn("offset", F.lit(0).cast("long"))

    def packed(lane: int, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = LevelPacker(size)
        for batch in rows:
            for n in batch.column("length").to_pylist():
                packer.place(n)
        packer.close()
        at = 0
        for batch in rows:
            where = packer.where[at : at + batch.num_rows]
            at += batch.num_rows
            names = [name for name in batch.schema.names if name != "lane"]
            sequence = pa.array([(lane << 40) + window for window, _ in where], pa.int64())
            offset = pa.array([level for _, level in where], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), sequence, offset], [*names, "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, rows = None, []
        for batch in batches:
            lanes_here = batch.column("lane").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(lanes_here)) + 1), len(lanes_here)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a and lanes_here[a] != lane:
                    if rows:
                        yield from packed(lane, rows)
                    lane, rows = int(lanes_here[a]), []
                if b > a:
                    rows.append(batch.slice(a, b - a))
        if rows:
            yield from packed(lane, rows)

    schema = f"key {docs.schema[key].dataType.simpleString()}, {_PIECES}" + ", ids array<int>" * keep_ids + ", sequence_id long, offset long"
    return map_arrow(dealt, run, schema).unionByName(alone.drop("row")).withColumnRenamed("key", key)


def padding(packed: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row: tokens, sequences and how many tokens of padding they need."""
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    bare = F.col("fill").bitwiseAND(F.col("fill") - 1) == 0
    return fill.agg(
        F.sum("fill").alias("tokens"),
        F.count("*").alias("sequences"),
        F.sum(F.when(bare, 0).otherwise(size - F.col("fill"))).alias("padding"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
