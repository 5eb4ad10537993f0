"""Quality classifier: Bradley-Terry ranking of documents.

A document's score is linear in text features.  It is learnt from preference
pairs (a document labelled 1 beats one labelled 0) by logistic loss on the
difference of the two feature vectors.  The threshold is the score quantile
that rejects as large a share of the labelled documents as is labelled 0; the
published score is a logistic of the distance to it, so that ``THRESHOLD``
falls on that quantile.

Fitting uses a bounded, documented sample of labelled rows (``max_labelled``,
those with the least hash of the id); scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

THRESHOLD = 0.3
MAX_LABELLED = 16_000
MAX_PAIRS = 40_000
RIDGE = 1e-3
BINS = 8

_UPPER = np.arange(ord("A"), ord("Z") + 1)
_LOWER = np.arange(ord("a"), ord("z") + 1)
_DIGIT = np.arange(ord("0"), ord("9") + 1)
_MARKS = [ord(c) for c in "#$%&*|!@~^=+<>{}[]\\_"]
FEATURES = ("log_bytes", "log_words", "upper", "digit", "non_ascii", "space", "full_stop", "comma", "symbols",
            *(f"mark_{chr(m)}" for m in _MARKS), "mean_word", "spread_word", "longest_word", "short_words",
            "distinct_words", "repeated_lines", "line_words", "entropy")


def features(data: bytes) -> list[float]:
    """Shape of a whole text in UTF-8; all zero without words."""
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, n_words = len(data), len(words)
    letters = max(1, counts[_UPPER].sum() + counts[_LOWER].sum())
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = counts[counts > 0] / n
    plain = counts[_UPPER].sum() + counts[_LOWER].sum() + counts[_DIGIT].sum() + counts[128:].sum()
    white = counts[9:14].sum() + counts[32]
    return [
        np.log1p(n), np.log1p(n_words), counts[_UPPER].sum() / letters, counts[_DIGIT].sum() / n,
        counts[128:].sum() / n, white / n, counts[ord(".")] / n_words, counts[ord(",")] / n_words,
        (n - plain - white) / n_words, *(counts[m] / n_words for m in _MARKS),
        lengths.mean(), lengths.std(), np.log1p(lengths.max()), (lengths <= 3).mean(),
        len(set(words)) / n_words, 1 - len(set(lines)) / len(lines), np.log1p(n_words / len(lines)),
        float(-(share * np.log2(share)).sum())]


@dataclass(frozen=True)
class Ranker:
    """Weights over binned features; small, so it travels with the tasks."""

    edges: np.ndarray  # (features, BINS - 1), ascending
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Standardised features and one indicator per quantile edge passed."""
        steps = (x[:, :, None] > self.edges[None]).reshape(len(x), -1)
        return np.hstack([np.clip((x - self.mean) / self.scale, -5, 5), steps.astype(float)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.raw(x) - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD))
        # The threshold itself passes in spite of rounding.
        return np.where(self.raw(x) >= self.threshold, np.maximum(1 / (1 + np.exp(-np.clip(z, -40, 40))), THRESHOLD),
                        np.minimum(1 / (1 + np.exp(-np.clip(z, -40, 40))), np.nextafter(THRESHOLD, 0)))


def fit_ranker(x: np.ndarray, label: np.ndarray, seed: int = 7) -> Ranker:
    """Bradley-Terry fit on pairs drawn from the sample; without both labels every score is alike."""
    x = np.asarray(x, float).reshape(-1, len(FEATURES))
    label = np.asarray(label, int)
    if not len(x):
        zero = np.zeros(len(FEATURES))
        edges = np.zeros((len(FEATURES), BINS - 1))
        return Ranker(edges, zero, zero + 1, np.zeros(len(FEATURES) * BINS), 0.0)
    edges = np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T
    ranker = Ranker(edges, x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9), np.zeros(len(FEATURES) * BINS), 0.0)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranker(ranker.edges, ranker.mean, ranker.scale, ranker.weights, 0.0 if len(good) else 1.0)
    wide = ranker.expand(x)
    rng = np.random.default_rng(seed)
    n = min(MAX_PAIRS, 20 * len(x))
    diff = wide[rng.choice(good, n)] - wide[rng.choice(bad, n)]
    w = np.zeros(diff.shape[1])
    for _ in range(12):  # Newton steps on the mean logistic loss
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        slope = RIDGE * w - (diff.T @ p) / n
        bend = (diff * (p * (1 - p))[:, None]).T @ diff / n + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    raw = wide @ w
    cut = float(np.quantile(raw, len(bad) / len(label), method="higher"))
    return Ranker(ranker.edges, ranker.mean, ranker.scale, w, cut)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text is divisible by 5 (a null id counts as such)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def _featured(rows: DataFrame, keep: str | StructType, make) -> DataFrame:
    """``make(columns before the text, features)`` of each batch; the text is the last column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            x = np.array([features(t or b"") for t in texts], float).reshape(-1, len(FEATURES))
            yield make(batch, x)
    return rows.mapInArrow(run, keep)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          id_col: str = "doc_id", text_col: str = "text") -> Ranker:
    """Learn from labelled rows that are not held out, at most ``max_labelled`` of them.

    Labels without id or quality are ignored; of contradicting labels of an id
    the majority counts, a tie as 1; of texts that repeat an id one counts (least
    features), so the driver gets at most ``max_labelled`` rows.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")) \
        .join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")

    def make(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))],
                                          ["doc_id", "quality", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    fitted = _featured(rows, f"doc_id {kind}, quality int, x array<double>", make) \
        .groupBy("doc_id").agg(F.min(F.struct("x", "quality")).alias("f")).select("doc_id", "f.*").collect()
    fitted.sort(key=lambda r: r.doc_id)
    return fit_ranker([r.x for r in fitted], [r.quality for r in fitted])


def score_rows(docs: DataFrame, ranker: Ranker, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score of its text as a further column ``name``."""
    def make(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ranker.score(x))],
                                          [*batch.schema.names[:-1], name])

    kinds = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return _featured(docs.withColumn("__text", F.col(text_col).cast("binary")), kinds, make)


def quality_scores(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    ``score`` is in 0..1, higher for likelier quality 1; ``predicted`` is 1 from
    ``THRESHOLD`` on.  Null and empty texts get the score of all-zero features;
    without labels of both kinds every document scores alike.  Repeated rows
    come back repeated, other columns are ignored.
    """
    ranker = train(docs, labels, max_labelled, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text"))
    return score_rows(rows, ranker).select("doc_id", "held_out", "score",
                                           (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
