"""Language identification by bit-sliced Bloom filters of letter n-grams.

One filter serves all languages: a slot holds a bit per language, and the AND of an
n-gram's slots is the set of languages that contain it (and, now and then, one that
doesn't). A text's n-grams are looked up, the set bits are counted per language, the
expected false positives are taken off, and the language with the most is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, table

ORDERS = (3, 4)
SLOTS = 1 << 21
HASHES = 3
#: The filters learn from about so many labelled documents at most, a hash sample.
TRAIN_DOCS = 20_000
#: A language contains an n-gram that is in so many of its training documents, and
#: at a rate of at least this share of the highest rate of any language.
LEAST_DOCS, LEAST_SHARE = 2, 0.4
UNKNOWN = "und"
_SPACE = np.uint32(32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """Hashes of the n-grams of the lower-cased letters, each run of other
    characters being one space, with a space at both ends. Empty without letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint64)
    points = np.concatenate([[_SPACE], np.where(letter, points, _SPACE), [_SPACE]])
    gap = points == _SPACE
    points = points[~(gap & np.roll(gap, 1)) | (np.arange(len(points)) == 0)].astype(np.uint64)
    out = []
    for n in ORDERS:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, n, np.uint64)
            for i in range(n):
                h = (h ^ points[i : i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out.append(h)
    return np.concatenate(out)


def _slots(h: np.ndarray, slots: int) -> list[np.ndarray]:
    other = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * other) & np.uint64(slots - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass
class LanguageFilters:
    """``planes[b]`` has the bits of languages 8b to 8b + 7 for each slot."""

    languages: list[str]
    planes: np.ndarray
    false_positive: np.ndarray

    @classmethod
    def build(cls, languages: list[str], members: list[np.ndarray], slots: int = SLOTS) -> LanguageFilters:
        """``members[i]`` are the hashes of the n-grams that languages[i] contains."""
        planes = np.zeros((max(1, -(-len(languages) // 8)), slots), np.uint8)
        for i, h in enumerate(members):
            for at in _slots(h, slots):
                planes[i // 8, at] |= np.uint8(1 << i % 8)
        filled = [np.count_nonzero(planes[i // 8] & np.uint8(1 << i % 8)) / slots for i in range(len(languages))]
        return cls(languages, planes, np.array(filled) ** HASHES)

    def counts(self, h: np.ndarray) -> np.ndarray:
        """n-grams of ``h`` that each language contains, corrected for false positives."""
        slots = _slots(h, self.planes.shape[1])
        raw = []
        for plane in self.planes:
            bits = plane[slots[0]]
            for at in slots[1:]:
                bits = bits & plane[at]
            by_value = np.bincount(bits, minlength=256)
            raw += [by_value[np.arange(256) >> b & 1 == 1].sum() for b in range(8)]
        found = np.array(raw[: len(self.languages)], float)
        return np.maximum(0, (found - len(h) * self.false_positive) / np.maximum(1e-9, 1 - self.false_positive))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its share of all languages' corrected counts); ties go to the
        first language; ``und`` and 0 for texts without letters."""
        h = grams(text)
        if not len(h) or not self.languages:
            return UNKNOWN, 0.0
        found = self.counts(h)
        best = int(np.argmax(found))
        return self.languages[best], float(found[best] / found.sum()) if found.any() else 0.0


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", train_docs: int = TRAIN_DOCS) -> LanguageFilters:
    """Filters from the rows of ``labelled`` that have both a text and a language.

    If there are more than ``train_docs`` such rows, a sample of about that many is
    taken by the text's hash. n-grams are counted in the executors; what reaches the
    driver are the n-grams of the sample, so it is bounded by ``train_docs``. Without
    rows the filters know no language and predict ``und``.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    n = rows.count()
    if n > train_docs:
        rows = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < round(1_000_000 * train_docs / n))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_of, lang_of = batch.column(0), batch.column(1).to_pylist()
            for name in sorted(set(lang_of)):
                own = [np.unique(grams(text_of[i].as_py())) for i, x in enumerate(lang_of) if x == name]
                h, c = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(h)), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "gram", "docs"]
                )

    sums = map_arrow(rows, counted, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    found = sums.filter(F.col("docs") >= LEAST_DOCS).toPandas()
    totals = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    found["rate"] = found["docs"] / found["lang"].map(totals)
    highest = found.groupby("gram")["rate"].transform("max")
    found = found[found["rate"] >= LEAST_SHARE * highest]
    by_lang: dict[str, pd.Series] = dict(iter(found.groupby("lang")["gram"]))
    members = [by_lang[x].to_numpy().view(np.uint64) if x in by_lang else np.empty(0, np.uint64) for x in languages]
    return LanguageFilters.build(languages, members)


def predict(docs: DataFrame, filters: LanguageFilters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, lang_pred and score per row of ``docs``, from the text alone.

    Repeated rows stay; an empty table gives an empty result. The filters (a few MB,
    by their number of slots) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["key", "lang_pred", "score"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = fit(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs, filters).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
