"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. The model of a category sees the words
of a document and the probabilities of the categories before it in the chain. In
training those probabilities are out-of-fold predictions, as the model would get
them for a document it hasn't learnt from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlake.llm.common import cut, map_arrow, small, table

#: The chain: what ``labels`` knows about a document, in this order.
CHAIN = ("low_quality", "toxic")
#: The models learn from about so many labelled documents at most, a hash sample.
TRAIN_DOCS = 12_000
FOLDS = 3
FEATURES = 6_000
THRESHOLD = 0.5
_EDGE = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()) + "…“”«»¿¡"


def _of_token(token: str) -> tuple[int, ...]:
    """Hashes of a lower-cased token's features: the word, its beginning, and a run
    of two or more marks at its end."""
    core = token.strip(_EDGE)
    out = []
    if core:
        out.append(zlib.crc32(b"w" + core.encode("utf-8", "surrogatepass")))
        if len(core) > 4:
            out.append(zlib.crc32(b"p" + core[:4].encode("utf-8", "surrogatepass")))
    end = token[len(token.rstrip(_EDGE)) :]
    if len(end) > 1 or not core:
        out.append(zlib.crc32(b"e" + end[:3].encode("utf-8", "surrogatepass")))
    return tuple(out)


class Featuriser:
    """Distinct features of a whole text; a bounded memory of tokens seen before.

    With ``places`` they are the places of the features in it, and others are left out.
    """

    def __init__(self, places: dict[int, int] | None = None, most: int = 100_000):
        self.places, self.most, self.known = places, most, {}

    def __call__(self, text: str | None) -> set[int]:
        out: set[int] = set()
        known = self.known
        for token in set((text or "").lower().split()):
            h = known.get(token)
            if h is None:
                h = _of_token(token)
                if self.places is not None:
                    h = tuple(self.places[x] for x in h if x in self.places)
                if len(known) >= self.most:
                    known.clear()
                known[token] = h
            if h:
                out.update(h)
        return out


@dataclass
class Linear:
    """Logistic regression on the presence of features and on earlier probabilities."""

    bias: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    chained: list[float] = field(default_factory=list)

class Chain:
    """The models as one matrix: a row of weights for each, a column for each feature."""

    def __init__(self, models: list[tuple[str, Linear]]):
        names = sorted(frozenset().union(*(m.weights for _, m in models)))
        self.of = Featuriser({f: i for i, f in enumerate(names)})
        self.weights = np.array([[m.weights.get(f, 0.0) for f in names] for _, m in models]).reshape(len(models), len(names))
        self.models = [m for _, m in models]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities: a row for each text, a column for each category."""
        found = [np.fromiter(f, np.int64, len(f)) for f in map(self.of, texts)]
        row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        column = np.concatenate(found) if found else np.empty(0, np.int64)
        out = np.zeros((len(texts), len(self.models)))
        for i, model in enumerate(self.models):
            z = model.bias + np.bincount(row, self.weights[i, column], len(texts)) + out[:, :i] @ np.array(model.chained)
            out[:, i] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


class _Rows:
    """Documents as runs of feature columns in one array."""

    def __init__(self, docs: list[np.ndarray]):
        self.names, columns = np.unique(np.concatenate(docs) if docs else np.empty(0, np.uint32), return_inverse=True)
        self.columns = columns.astype(np.int32)
        self.row = np.repeat(np.arange(len(docs), dtype=np.int32), [len(d) for d in docs])
        self.n = len(docs)


def _fit(rows: _Rows, use: np.ndarray, y: np.ndarray, earlier: np.ndarray, features: int = FEATURES, rounds: int = 100) -> tuple[Linear, np.ndarray]:
    """A model from the documents ``use`` is true of, and its probabilities for all.

    The features are those in three documents or more whose log-odds between the two
    classes lie furthest from 0 by their standard error.
    """
    prior = np.log((y[use].sum() + 1) / ((1 - y[use]).sum() + 1))
    taught = use[rows.row]
    yes = np.bincount(rows.columns[taught], weights=y[rows.row[taught]], minlength=len(rows.names))
    every = np.bincount(rows.columns[taught], minlength=len(rows.names))
    no = every - yes
    a, b = y[use].sum() - yes, (1 - y[use]).sum() - no
    odds = np.log((yes + 0.5) * (b + 0.5) / ((no + 0.5) * (a + 0.5)))
    z = np.abs(odds) / np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5) + 1 / (a + 0.5) + 1 / (b + 0.5))
    z[every < 3] = 0
    kept = np.sort(np.argsort(-z, kind="stable")[:features])
    kept = kept[z[kept] > 2]
    position = np.full(len(rows.names), -1)
    position[kept] = np.arange(len(kept))
    has = position[rows.columns] >= 0
    col, row = position[rows.columns[has]], rows.row[has]
    # Adam on the mean log-loss with a small L2 penalty
    w, c, bias = np.zeros(len(kept)), np.zeros(earlier.shape[1]), float(prior)
    m = [np.zeros_like(w), np.zeros_like(c), 0.0]
    v = [np.zeros_like(w), np.zeros_like(c), 0.0]
    n = max(1, use.sum())

    def scores() -> np.ndarray:
        return bias + np.bincount(row, weights=w[col], minlength=rows.n) + earlier @ c

    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(scores(), -30, 30)))
        e = np.where(use, p - y, 0) / n
        g = [np.bincount(col, weights=e[row], minlength=len(kept)) + 1e-5 * w, earlier.T @ e + 1e-5 * c, e.sum()]
        params = [w, c, bias]
        for i in range(3):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            v[i] = 0.99 * v[i] + 0.01 * g[i] ** 2
            params[i] = params[i] - 0.2 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-9)
        w, c, bias = params
    p = 1 / (1 + np.exp(-np.clip(scores(), -30, 30)))
    return Linear(float(bias), dict(zip(rows.names[kept].tolist(), w.tolist(), strict=True)), c.tolist()), p


def fit(labelled: DataFrame, text: str, categories: list[tuple[str, Column]], train_docs: int = TRAIN_DOCS, folds: int = FOLDS) -> list[tuple[str, Linear]]:
    """The chain's models from the rows of ``labelled``, one per (name, label column).

    Rows whose text or a label is null don't teach. If more than ``train_docs`` are
    left, a sample of about that many is taken by a hash of the row's number, so a text
    that many rows repeat fills no more of it than of the rows; the documents' features,
    not their texts, go to the driver. A category without both classes gets a constant
    model.
    """
    names = [f"y{i}" for i in range(len(categories))]
    rows = labelled.select(F.col(text).alias("text"), *[c.cast("double").alias(n) for n, (_, c) in zip(names, categories, strict=True)]).dropna()
    n = rows.count()
    if n > train_docs:
        rows = rows.filter(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1_000_000)) < round(1_000_000 * train_docs / n))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Featuriser()
        for batch in batches:
            found = pa.array([sorted(of(t.as_py())) for t in batch.column(0)], pa.list_(pa.int64()))
            fold = pa.array([zlib.crc32(t.as_py().encode("utf-8", "surrogatepass")) % folds for t in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([found, fold, *batch.columns[1:]], ["features", "fold", *names])

    taught = map_arrow(rows, featured, "features array<long>, fold long, " + ", ".join(f"{n} double" for n in names)).toArrow()
    order = np.lexsort([taught[n].to_numpy() for n in ("fold", *names)])
    features = taught["features"].combine_chunks()
    # hashes are 32 bits; the driver holds them as such
    docs = _Rows([features[i].values.to_numpy().astype(np.uint32) for i in order])
    fold = taught["fold"].to_numpy()[order]
    labels = {n: taught[n].to_numpy()[order] for n in names}
    del features, taught
    pa.default_memory_pool().release_unused()
    earlier = np.zeros((docs.n, 0))
    models = []
    for name, (category, _) in zip(names, categories, strict=True):
        y = labels[name]
        model, _ = _fit(docs, np.ones(docs.n, bool), y, earlier)
        models.append((category, model))
        out_of_fold = np.zeros(docs.n)
        if name != names[-1]:
            for f in range(folds):
                _, p = _fit(docs, fold != f, y, earlier)
                out_of_fold[fold == f] = p[fold == f]
        earlier = np.column_stack([earlier, out_of_fold])
    return models


def predict(docs: DataFrame, models: list[tuple[str, Linear]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``p_<category>`` for each category, per row of ``docs``.

    Null and empty texts get what the models say without any feature. Repeated rows
    stay; an empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, " + ", ".join(f"p_{c} double" for c, _ in models)
    return map_arrow(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), _scorer(models, lambda b: [b.column(0)], 1), schema).withColumnRenamed("key", key)


def _scorer(models: list[tuple[str, Linear]], first, at: int):
    """A mapInArrow function: the columns ``first(batch)`` and then the probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(models)
        for batch in batches:
            kept, p = first(batch), chain(batch.column(at).to_pylist())
            names = [f"c{i}" for i in range(len(kept))] + [f"p_{c}" for c, _ in models]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(p[:, i]) for i in range(len(models)))], names)

    return run


def with_probabilities(docs: DataFrame, models: list[tuple[str, Linear]], text: str = "text", prefix: str = "__p_") -> DataFrame:
    """``docs`` with a column ``<prefix><category>`` for each category, in place of one of that name."""
    names = [f"{prefix}{c}" for c, _ in models]
    docs = docs.drop(*names)
    schema = StructType([*docs.schema.fields, *(StructField(n, DoubleType()) for n in names)])
    return map_arrow(docs, _scorer(models, lambda b: list(b.columns), docs.columns.index(text)), schema)


def labelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``text``, ``quality`` and ``toxic`` of the documents that have labels; a document
    that repeats, or has different labels, comes with each of them."""
    known = labels.select("doc_id", "quality", "toxic").filter(F.col("doc_id").isNotNull())
    return documents.select("doc_id", "text").join(known, "doc_id")


def fit_labels(documents: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> list[tuple[str, Linear]]:
    """The chain ``CHAIN`` from the distinct labels. Where there are more of them than
    ``train_docs``, they are thinned by their doc_id's hash before the join; what is left
    is written and, being counted to be small, broadcast, so no text is shuffled."""
    labels = labels.select("doc_id", "quality", "toxic").distinct()
    n = labels.count()
    if n > train_docs:
        labels = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(1_000_000 * train_docs / n))
    rows = labelled_documents(documents, small(cut(labels, "labels")))
    return fit(rows, "text", [(CHAIN[0], F.col("quality") == 0), (CHAIN[1], F.col("toxic") == 1)], train_docs)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, a probability for each category, and ``toxic``, the verdict, of every whole
    text; null is empty, repeated rows stay, other columns are not read."""
    docs = table(spark, sf_dir, "documents")
    models = fit_labels(docs, table(spark, sf_dir, "labels"))
    return predict(docs, models).withColumn("toxic", F.col("p_toxic") >= THRESHOLD)
