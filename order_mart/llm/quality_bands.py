"""Quality rules with compression bands.

Besides two base rules (too few words, too many repeated three-word windows),
the zstandard ratio (bytes / compressed bytes) of the whole text and of its
chunks must lie in a band that depends on the length: text below the band is
incompressible (noise), above it is repetitive.  The whole-text ratio finds
repetition at a distance, the chunk ratios find local noise and repetition that
a long varied text would hide.  Chunks cover every byte: full ones first, then
shorter ones over what is left, so short texts and tails are judged too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .blocks import FOLLOWS, SPACE, Rolling, bounds, pieces, windows_of
from .common import raw_bytes, read_table, slices

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Bands:
    """Limits: ``whole`` holds (least length in bytes, lowest, highest ratio)
    rows, the last whose length fits counts; ``chunk`` the band of full chunks;
    ``short`` the (length in bytes, lowest, highest ratio) of the chunks that
    the rest after the full chunks is cut into, longest first.
    ``max_bad_chunks`` is the share of the bytes that may lie in chunks outside
    their band."""

    min_words: int = 50
    max_repeat_percent: int = 50
    level: int = 3
    chunk_bytes: int = 4096
    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 3.0), (256, 1.1, 3.0), (1024, 1.35, 3.2), (4096, 1.45, 3.5), (16384, 1.5, 4.0), (65536, 1.5, 5.0))
    chunk: tuple[float, float] = (1.35, 3.5)
    short: tuple[tuple[int, float, float], ...] = ((1024, 1.35, 3.2), (256, 1.05, 3.0))
    max_bad_chunks: float = 0.25


FIGURES = StructType([StructField(n, t) for n, t in (
    ("n_words", LongType()), ("word_chars", LongType()), ("n_symbols", LongType()), ("n_dup_lines", LongType()),
    ("n_repeat_words", LongType()), ("base_failed", BooleanType()), ("whole_ratio", DoubleType()),
    ("bad_chunks", DoubleType()), ("kept", BooleanType()))])


def _counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1

    def per_row(mask):
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[offsets[1:]] - total[offsets[:-1]]

    space = SPACE[data]
    rolling = Rolling(data)
    starts, ends, rows = pieces(space, offsets)
    hashes = rolling.of(starts, ends)
    n_words = np.bincount(rows, minlength=n)
    solid = np.concatenate(([0], np.cumsum(~space)))
    begin, end, of = pieces(data == 10, offsets)
    with_word = solid[end] > solid[begin]
    lines, line_rows = rolling.of(begin, end)[with_word], of[with_word]
    window, at = windows_of(hashes, rows, 3)
    line_at, window_at = bounds(line_rows, n), bounds(rows[at], n)
    dup, repeat = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in range(n):
        own = lines[line_at[r]: line_at[r + 1]]
        if len(own) > 1:
            dup[r] = len(own) - len(np.unique(own))
        own = window[window_at[r]: window_at[r + 1]]
        if len(own) > 1:
            order = np.argsort(own)
            ranked = own[order]
            same = ranked[1:] == ranked[:-1]
            if same.any():
                twice = np.zeros(len(own), bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                covered = np.zeros(len(own) + 2, bool)
                for k in range(3):
                    covered[k: k + len(own)] |= twice
                repeat[r] = covered.sum()
    return {"n_words": n_words, "word_chars": per_row(~space & ~FOLLOWS[data]), "n_symbols": per_row(_SYMBOL[data]),
            "n_dup_lines": dup, "n_repeat_words": repeat}


def _chunks(length: int, bands: Bands) -> Iterator[tuple[int, int, int, float, float]]:
    """(start, size, bytes judged, lowest, highest) of the chunks of a text.
    A rest below the least size is judged by the last chunk of that size that
    ends with the text; a text below the least size has no chunk, its
    whole-text ratio is all there is."""
    at = 0
    for size, lowest, highest in ((bands.chunk_bytes, *bands.chunk), *(s for s in bands.short if s[0] < bands.chunk_bytes)):
        while length - at >= size:
            yield at, size, size, lowest, highest
            at += size
    if at < length and length >= size:
        yield length - size, size, length - at, lowest, highest


def _ratios(text: bytes, bands: Bands, compressor) -> tuple[float, float]:
    """Whole-text ratio, and the share of the text's bytes in chunks outside
    their band.  An empty text has ratio 0 and no chunks."""
    if not text:
        return 0.0, 0.0
    whole = len(text) / len(compressor.compress(text))
    view, bad = memoryview(text), 0
    for start, size, judged, lowest, highest in _chunks(len(text), bands):
        ratio = size / len(compressor.compress(view[start: start + size]))
        bad += judged * (not lowest <= ratio <= highest)
    return whole, bad / len(text)


def in_band(length: int, whole: float, bad_chunks: float, bands: Bands) -> bool:
    lowest, highest = [(lo, hi) for least, lo, hi in bands.whole if length >= least][-1]
    return lowest <= whole <= highest and bad_chunks <= bands.max_bad_chunks


def _figures(bands: Bands, schema: pa.Schema, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
        for part in slices(batches, "text"):
            data, offsets, _ = raw_bytes(part.column(part.schema.get_field_index("text")))
            counts = _counts(data, offsets)
            blob = data.tobytes()
            ratios = [_ratios(blob[a:b], bands, compressor) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            failed = (counts["n_words"] < bands.min_words) | (
                100 * counts["n_repeat_words"] > bands.max_repeat_percent * counts["n_words"])
            kept = [not f and in_band(int(size), *r, bands) for f, size, r in zip(failed, np.diff(offsets), ratios, strict=True)]
            made = [*counts.values(), failed, np.array([r[0] for r in ratios]), np.array([r[1] for r in ratios]), np.array(kept, bool)]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(c)).cast(schema.field(c).type) for c in keep] + [pa.array(x) for x in made], schema=schema)

    return run


def quality_bands(docs: DataFrame, bands: Bands = Bands(), with_text: bool = True) -> DataFrame:
    """``docs`` with the base figures, the compression figures and ``kept``.

    A null text has no words and fails the base rules; the order and number of
    rows stay as they are, repeated rows included.  Columns of ``docs`` that
    bear a result's name are replaced.  ``with_text=False`` leaves out the
    text.  Very long texts are judged whole, one at a time.  An empty table
    gives an empty result.
    """
    columns = [c for c in docs.columns if c not in FIGURES.names]
    out = [c for c in columns if with_text or c != "text"]
    schema = StructType([docs.schema[c] for c in out] + FIGURES.fields)
    return docs.select(*[f"`{c}`" for c in columns]).mapInArrow(_figures(bands, to_arrow_schema(schema), out), schema)


def op8_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_bands(docs, with_text=False)
