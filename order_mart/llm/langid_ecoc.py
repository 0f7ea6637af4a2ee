"""Language identification with error-correcting output codes.

Every language has a binary codeword.  One linear classifier per bit, over
hashed character n-grams, tells the languages whose bit is 1 from the others.
Decoding sums, for each codeword, the logistic loss of the bits' margins,
weighted by how well each bit classified the training texts; the codeword with
the least loss wins and a small lead over the second flags the text ambiguous.
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

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the training texts of a language (distinct, picked by
    hash), ``languages`` the number of languages (the most frequent ones);
    ``lead`` is the least difference of two languages' scores."""

    sample: int = 500
    languages: int = 64
    widths: tuple[int, ...] = (1, 2, 3)
    bits: int = 12
    steps: int = 80
    rate: float = 40.0
    decay: float = 1e-4
    lead: float = 0.2
    seed: int = 11


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n codewords of -1 and 1, one row each.  Up to seven classes: every
    split of the classes once.  Beyond: random distinct splits, the best of 20
    draws by least distance between two codewords."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    rng, length, best = np.random.default_rng(seed), 12 * int(np.ceil(np.log2(n))), None
    for _ in range(20):
        code = rng.choice([-1.0, 1.0], (n, length))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        agree = code @ code.T - 2 * code.shape[1] * np.eye(n)
        if best is None or agree.max() < best[0]:
            best = (agree.max(), code)
    return best[1]


def features(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> np.ndarray:
    """Square roots of n-gram counts, each row of length one."""
    x = np.sqrt(ngrams.counts(ngrams.fold(data), offsets, settings.widths, settings.bits).astype(np.float32))
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row has a letter."""
    folded = ngrams.fold(data)
    plain = np.concatenate(([0], np.cumsum((folded >= 97) & (folded <= 122))))
    has = plain[offsets[1:]] > plain[offsets[:-1]]
    for r in np.flatnonzero(~has).tolist():
        has[r] = any(c.isalpha() for c in data[offsets[r]: offsets[r + 1]].tobytes().decode("utf-8", "replace"))
    return has


def fit(texts: list[bytes], langs: list[str], settings: Settings = Settings()) -> dict[str, np.ndarray]:
    """Model: languages, code, weights and bias of the bits' classifiers, and
    the weights of the bits in decoding.  Equal texts count once a language."""
    pairs = sorted(set(zip(langs, texts, strict=True)))
    names = sorted({lang for lang, _ in pairs})
    code = codewords(len(names), settings.seed)
    size, n_bits = 1 << settings.bits, code.shape[1]
    weights, bias = np.zeros((size, n_bits), np.float32), np.zeros(n_bits, np.float32)
    trust = np.ones((len(names), n_bits))
    if n_bits:
        which = np.array([names.index(lang) for lang, _ in pairs])
        x = np.concatenate([features(np.frombuffer(t, np.uint8), np.array([0, len(t)]), settings) for _, t in pairs])
        target = code[which].astype(np.float32)
        share = (len(pairs) / (len(names) * np.bincount(which, minlength=len(names))))[which].astype(np.float32)[:, None]
        look_w, look_b = weights.copy(), bias.copy()
        for step in range(settings.steps):                       # accelerated gradient descent on logistic loss
            margin = target * (x @ look_w + look_b)
            pull = share * target / (1 + np.exp(np.clip(margin, -30, 30)))
            new_w = look_w + settings.rate * (x.T @ pull / len(pairs) - settings.decay * look_w)
            new_b = look_b + 0.1 * settings.rate * pull.mean(axis=0)
            push = step / (step + 3)
            look_w, look_b = new_w + push * (new_w - weights), new_b + push * (new_b - bias)
            weights, bias = new_w, new_b
        right = target * (x @ weights + bias) > 0
        for k in range(len(names)):
            trust[k] = right[which == k].mean(axis=0)
        trust = np.maximum(trust, 1e-3)
    trust = trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    return {"names": np.array(names), "code": code, "weights": weights, "bias": bias, "trust": trust}


def decode(margins: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Score of every language (rows sum to one) from the bits' margins."""
    code, trust = model["code"], model["trust"]
    if code.shape[1] == 0:
        return np.ones((len(margins), len(code)))
    loss = np.stack([(trust[k] * np.logaddexp(0, -code[k] * margins)).sum(axis=1) for k in range(len(code))], axis=1)
    odds = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * code.shape[1] / 2)
    return odds / odds.sum(axis=1, keepdims=True)


def _fit_task(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs = [], []
        for batch in batches:
            langs += batch.column(0).to_pylist()
            texts += batch.column(1).cast(pa.binary()).to_pylist()
        sink = io.BytesIO()
        np.savez_compressed(sink, **fit(texts, langs, settings))
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue()], pa.binary())], names=["model"])
    return run


def train(labelled: DataFrame, settings: Settings = Settings()) -> dict[str, np.ndarray]:
    """Fit on at most ``settings.sample`` distinct texts of each language in
    ``labelled`` (lang, text), those with the smallest hashes, of the
    ``settings.languages`` most frequent languages; null languages and null
    texts teach nothing.  So what one task fits is bounded by the settings,
    whatever ids, copies and languages the table has."""
    rows = labelled.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    often = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.languages)
    sizes = {r["lang"]: r["count"] for r in often.collect()}
    if not sizes:
        return fit([], [], settings)
    # about twice the sample by hash first, so that few texts move
    share = F.element_at(F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, 2 * settings.sample / n))]), F.col("lang"))
    some = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.coalesce(share, F.lit(0.0)) * (1 << 20))
    picked = at_most(some, "lang", settings.sample)
    model = picked.repartition(1).mapInArrow(_fit_task(settings), "model binary").first()
    return dict(np.load(io.BytesIO(model[0]))) if model else fit([], [], settings)


def _predict(model: dict[str, np.ndarray], settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = model["names"].tolist()
        for part in slices(batches, "text", 1 << 19):
            data, offsets, _ = raw_bytes(part.column(part.schema.get_field_index("text")))
            n = len(offsets) - 1
            lang, score, unsure = np.full(n, UNDETERMINED, object), np.zeros(n), np.ones(n, bool)
            known = _letters(data, offsets) if names else np.zeros(n, bool)
            if known.any():
                odds = decode(features(data, offsets, settings) @ model["weights"] + model["bias"], model)
                order = np.sort(odds, axis=1)
                lead = order[:, -1] - (order[:, -2] if len(names) > 1 else 0)
                best = odds.argmax(axis=1)
                lang[known] = np.array(names, object)[best[known]]
                score[known], unsure[known] = odds.max(axis=1)[known], lead[known] < settings.lead
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(unsure)],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])
    return run


def identify_languages(docs: DataFrame, model: dict[str, np.ndarray], held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of ``docs``.

    Only the text decides.  A null text, a text without letters, or a model
    that learned no language gives ``und`` with score 0, ambiguous.  Of tied
    languages the first by name wins, ambiguous.  Very long texts are scored
    whole, one at a time.  Repeated rows give repeated results, an empty table
    an empty one; further columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        _predict(model, settings), f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")


def op2_langid_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_remainder("doc_id", 4, 2)
    return identify_languages(docs, train(docs.filter(~held_out)), held_out)
