"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

A text is the set of its hashed character n-grams.  From the labelled sample,
each n-gram gets the log ratio of its smoothed frequencies in toxic and clean
texts; a logistic regression is fitted on the n-grams so scaled, and its
weights are kept between the plain ratios and the fitted ones.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ngrams
from .common import at_most, in_remainder, raw_bytes, read_table, slices


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled texts of each class that the classifier
    is fitted on (picked by hash).  An n-gram counts if it is in ``least``
    texts and in that share of them, and its log ratio exceeds ``cut``;
    ``damping`` weakens the sums of texts with many n-grams."""

    sample: int = 1500
    widths: tuple[int, ...] = (4, 5, 6)
    bits: int = 18
    smoothing: float = 1.0
    least: int = 3
    least_share: float = 0.006
    cut: float = 1.5
    damping: float = 0.5
    steps: int = 60
    rate: float = 0.02
    decay: float = 0.02
    threshold: float = 0.5


def _sets(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> list[np.ndarray]:
    return ngrams.present(ngrams.fold(data), offsets, settings.widths, settings.bits)


def _damping(sizes, settings: Settings) -> np.ndarray:
    """Divisor of a text's sum: grows with its number of distinct n-grams."""
    return (1 + np.asarray(sizes) / 1000) ** settings.damping


def fit(texts: list[bytes], labels: list[int], settings: Settings = Settings()) -> dict[str, np.ndarray]:
    """Weights by bucket and bias.  Equal texts count once (toxic if any copy
    is); with one class only, the score is that class's everywhere."""
    marked: dict[bytes, int] = {}
    for text, label in zip(texts, labels, strict=True):
        marked[text] = max(label, marked.get(text, 0))
    pairs = sorted(marked.items())
    y = np.array([label for _, label in pairs], np.float64)
    size = 1 << settings.bits
    weights = np.zeros(size, np.float32)
    if not len(y) or y.min() == y.max():
        return {"weights": weights, "bias": np.float64(0 if not len(y) else (6.0 if y[0] else -6.0))}
    sets = [_sets(np.frombuffer(t, np.uint8), np.array([0, len(t)]), settings)[0] for t, _ in pairs]
    sizes = np.array([len(s) for s in sets])
    at, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    seen = np.bincount(at, minlength=size)
    toxic = np.bincount(at, weights=y[row], minlength=size)
    p, q = settings.smoothing + toxic, settings.smoothing + seen - toxic
    ratio = np.log((p / (2 * settings.smoothing + y.sum())) / (q / (2 * settings.smoothing + (1 - y).sum())))
    ratio[(seen < max(settings.least, settings.least_share * len(y))) | (np.abs(ratio) < settings.cut)] = 0.0
    held = ratio[at]
    use = held != 0
    at, row, held = at[use], row[use], (held / _damping(sizes, settings)[row])[use]
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b, m, v = np.zeros(size), 0.0, np.zeros(size), np.zeros(size)
    for step in range(1, settings.steps + 1):                    # Adam on the class-balanced logistic loss
        margin = np.bincount(row, weights=w[at] * held, minlength=len(y)) + b
        pull = share * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        grad = np.bincount(at, weights=pull[row] * held, minlength=size) + settings.decay * 1e-3 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= settings.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        b -= 0.5 * pull.sum()
    return {"weights": (w * ratio).astype(np.float32), "bias": np.float64(b)}


def margins(data: np.ndarray, offsets: np.ndarray, model: dict[str, np.ndarray], settings: Settings) -> np.ndarray:
    weights = model["weights"]
    sets = _sets(data, offsets, settings)
    return np.array([float(weights[s].sum()) for s in sets]) / _damping([len(s) for s in sets], settings) + float(model["bias"])


def _fit_task(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            texts += batch.column(1).cast(pa.binary()).to_pylist()
        sink = io.BytesIO()
        np.savez_compressed(sink, **fit(texts, labels, settings))
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue()], pa.binary())], names=["model"])
    return run


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> dict[str, np.ndarray]:
    """Fit on at most ``settings.sample`` distinct texts of each class: ``labels``
    (doc_id, toxic) joined to ``docs`` (doc_id, text).  A document labelled
    more than once counts as toxic if any label says so; null labels and null
    texts teach nothing, and copies of a text or of a document teach once."""
    marks = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
             .agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    share = F.element_at(F.create_map(*[F.lit(v) for k in (0, 1) for v in (k, min(1.0, settings.sample / max(1, sizes.get(k, 0))))]), F.col("toxic"))
    picked = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    few = F.broadcast(picked)                                    # at most about two samples of ids
    picked = at_most(texts.join(few, "doc_id"), "toxic", settings.sample)
    model = picked.repartition(1).mapInArrow(_fit_task(settings), "model binary").first()
    return dict(np.load(io.BytesIO(model[0]))) if model else fit([], [], settings)


def _score(model: dict[str, np.ndarray], settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            data, offsets, _ = raw_bytes(part.column(part.schema.get_field_index("text")))
            score = 1 / (1 + np.exp(-np.clip(margins(data, offsets, model, settings), -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array((score >= settings.threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def score_toxicity(docs: DataFrame, model: dict[str, np.ndarray], held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only the text decides; a null or empty text gets the score of the bias
    alone.  Very long texts are scored whole.  Repeated rows give repeated results, an empty table an empty one;
    further columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        _score(model, settings), f"doc_id {kind}, held_out boolean, score double, predicted int")


def op4_toxicity_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_remainder("doc_id", 5, 0)
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return score_toxicity(docs, train(docs, labels.filter(~held_out)), held_out)
