"""Removal of long repeated substrings with run-length (r-index) indexes.

Every window of ``WIDTH`` bytes is assigned to one anchor, the rightmost
minimum among the hashes of its ``GRAM``-byte substrings, so equal windows
have equal anchors at equal distances.  The windows of an anchor's occurrence
form its context, a string of less than twice ``WIDTH`` bytes.  Occurrences
are counted by (anchor hash, context hash); equal contexts collapse into one
string with a multiplicity, as equal runs do in a run-compressed transform.

Anchors that occur in different contexts go to index shards, whole anchors to
one shard.  A shard builds the Burrows-Wheeler transform of its contexts,
keeps its runs with text positions sampled at the run ends, computes match
lengths at the sampled positions only, and streams them over the contexts as
matching statistics: within a run, the match of the next position is one byte
shorter.  Windows that match elsewhere over their whole width are marked, and
the marks are carried back to every occurrence.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .blocks import Rolling
from .common import raw_bytes, read_table, slices, stage

WIDTH, GRAM = 200, 64
#: Windows that are hashed at once: bounds the memory for very long texts.
SEGMENT = 1 << 20
#: Context bytes in one index.
SHARD_BYTES = 1 << 20
#: An anchor with more context bytes than this is decided window by window.
CROWDED_BYTES = 8 << 20

_PACK = 1 << 20


# ------------------------------------------------------------- anchors
def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, rows = len(x) - width + 1, -(-len(x) // width)
    padded = np.full(rows * width, x.max(), x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def anchors(text: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, context start, context length) of a text."""
    parts = []
    for begin in range(0, max(0, len(text) - width + 1), SEGMENT):
        part = text[begin: begin + SEGMENT + width - 1]
        rolling = Rolling(part)
        hashes = rolling.windows(gram)
        low = np.uint64((1 << 24) - 1)
        ranked = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
        chosen = (low - (_sliding_min(ranked, width - gram + 1) & low)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = np.concatenate((first[1:], [len(chosen)])) - 1
        at = chosen[first]
        context = rolling.of(first, last + width) + (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        parts.append((hashes[at].view(np.int64), context.view(np.int64), first + begin, last - first + width))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _occurrences(batches: Iterator[pa.RecordBatch], width: int, gram: int):
    """(row id, anchors of its text) over a task's rows."""
    for part in slices(batches, "text", 4 << 20):
        data, offsets, _ = raw_bytes(part.column(1))
        for row, start, end in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if end - start >= width:
                yield row, anchors(data[start:end], width, gram)


def _batch(names, arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)


def _count_task(width: int, gram: int):
    """Occurrences of a task by (anchor, context): pre-aggregated, so a
    frequent passage leaves each task as one row."""
    def flush(held):
        rows = np.concatenate([np.full(len(a[0]), r) for r, a in held])
        h, c, start, size = (np.concatenate([a[k] for _, a in held]) for k in range(4))
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]))))
        n = np.diff(np.concatenate((first, [len(h)])))
        keep = order[first]
        return _batch(["h", "c", "n", "row", "span"], [h[first], c[first], n, rows[keep], start[keep] * _PACK + size[keep]])

    def run(batches):
        held, total = [], 0
        for row, made in _occurrences(batches, width, gram):
            held.append((row, made))
            total += len(made[0])
            if total >= 1 << 20:
                yield flush(held)
                held, total = [], 0
        if held:
            yield flush(held)
    return run


def _locate_task(width: int, gram: int):
    def run(batches):
        for row, (h, c, start, _) in _occurrences(batches, width, gram):
            if len(h):
                yield _batch(["h", "c", "row", "start"], [h, c, np.full(len(h), row), start])
    return run


# ------------------------------------------------------------- the index
@dataclass
class RunIndex:
    """Run-compressed transform of a collection of strings: the byte and the
    length of every run, and the text positions at its first and last row."""

    heads: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray
    ends: np.ndarray

    @classmethod
    def build(cls, text: np.ndarray, offsets: np.ndarray) -> RunIndex:
        ends = np.repeat(offsets[1:], np.diff(offsets))
        order = suffix_order(text, ends)
        before = np.where(np.isin(order, offsets), -1 - order, text[order - 1].astype(np.int64))
        head = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        tail = np.concatenate((head[1:], [len(order)])) - 1
        return cls(before[head], tail - head + 1, order[head], order[tail], text, ends)

    def matches(self) -> np.ndarray:
        """Matching statistics: for every position the length of the longest
        match with another place, within its string.  Lengths are computed
        between neighbouring runs' ends; every other position continues the
        match of the position before it."""
        n = len(self.text)
        reach = np.zeros(n, np.int64)
        above, below = self.last[:-1], self.first[1:]
        common = common_prefix(self.text, above, below, self.ends)
        np.maximum.at(reach, above, above + common)
        np.maximum.at(reach, below, below + common)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(n), 0)


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions sorted by the rest of their string; equal rests by position.

    A rank is the first place of a group of rests that agree so far.  Groups
    of more than one are sorted again by the ranks that follow at multiples of
    the depth, as many as fit into 63 bits, which multiplies the depth."""
    n = len(text)
    here = np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(7):                                           # first seven bytes, with 0 beyond the end
        value = np.zeros(n, np.uint64)
        value[: max(0, n - k)] = text[k:]
        value += np.uint64(1)
        value[here + k >= ends] = 0
        key = (key << np.uint64(9)) | value
    order = np.argsort(key)
    rank, width = np.empty(n, np.int64), max(1, int(n + 1).bit_length())
    places, depth, longest = here, 7, int((ends - here).max()) if n else 0
    members, ranked = order, key[order]
    while True:
        changed = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
        group = np.maximum.accumulate(np.where(changed, places, 0))
        rank[members] = group
        tied = ~(changed & np.concatenate((changed[1:], [True])))
        places, members = places[tied], members[tied]
        if not len(places) or depth >= longest:
            break
        ranked, parts = rank[members], 63 // width
        for part in range(1, parts):
            at = members + part * depth
            following = rank[np.minimum(at, n - 1)] + 1
            following[at >= ends[members]] = 0
            ranked = (ranked << width) | following
        sort = np.argsort(ranked)
        members, ranked = members[sort], ranked[sort]
        order[places] = members
        depth *= parts
    order[places] = members[np.lexsort((members, rank[members]))]
    return order


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rests at ``a`` and ``b``."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.as_strided(padded, (len(text) + 1, 8), (1, 1))
    most = np.minimum(ends[a] - a, ends[b] - b) if len(a) else np.zeros(0, np.int64)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x = np.ascontiguousarray(words[a[live] + out[live]]).view(np.uint64).ravel()
        y = np.ascontiguousarray(words[b[live] + out[live]]).view(np.uint64).ravel()
        differ = x ^ y
        low = differ & (~differ + np.uint64(1))                  # lowest differing bit: the first byte that differs
        equal = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        out[live] += equal
        live = live[(equal == 8) & (out[live] < most[live])]
    return np.minimum(out, most)


def marked_spans(contexts: list[bytes], width: int) -> list[list[int]]:
    """For each string of a collection the spans (start * 2^20 + length) of
    its bytes in windows that occur at another place of the collection."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    text = np.frombuffer(b"".join(contexts), np.uint8)
    hit = np.flatnonzero(RunIndex.build(text, offsets).matches() >= width)
    out: list[list[int]] = [[] for _ in contexts]
    if not len(hit):
        return out
    of = np.searchsorted(offsets, hit, side="right") - 1
    begin = np.concatenate(([True], (hit[1:] > hit[:-1] + width) | (of[1:] != of[:-1])))
    first = np.flatnonzero(begin)
    last = np.concatenate((first[1:], [len(hit)])) - 1
    for k, start, end in zip(of[first].tolist(), hit[first].tolist(), hit[last].tolist(), strict=True):
        out[k].append((start - int(offsets[k])) * _PACK + end - start + width)
    return out


_MARKS = "h long, c long, spans array<long>"


def _index_task(width: int):
    """Build an index for each run of whole anchors in a sorted partition."""
    def emit(held):
        spans = marked_spans([r[3] for r in held], width)
        rows = [(h, c, [len(text)] if n > 1 else own) for (h, c, n, text), own in zip(held, spans, strict=True)]
        rows = [r for r in rows if r[2]]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["h", "c", "spans"])

    def run(batches):
        held, total = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if total >= SHARD_BYTES and row[0] != held[-1][0]:
                    yield emit(held)
                    held, total = [], 0
                held.append(row)
                total += len(row[3])
        if held:
            yield emit(held)
    return run


def _window_task(width: int, gram: int):
    """(anchor, context, window start, window hashes) of crowded anchors."""
    def run(batches):
        for batch in batches:
            for h, c, n, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                windows = Rolling(np.frombuffer(text, np.uint8)).windows(width).view(np.int64)
                m = len(windows)
                yield _batch(["h", "c", "n", "at", "w"], [np.full(m, h), np.full(m, c), np.full(m, n), np.arange(m), windows])
    return run


# ------------------------------------------------------------- the operator
def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a stored row id, bucketed by it in the shared folder, so
    that the later joins by row do not shuffle the texts again."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"repeats_{uuid.uuid4().hex}"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_doc"), "text")
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).repartition(buckets, "_row")
    (numbered.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, "repeats-texts"))
     .bucketBy(buckets, "_row").saveAsTable(table))
    return spark.table(table), table


def repeated_spans(rows: DataFrame, width: int = WIDTH, gram: int = GRAM, crowded: int = CROWDED_BYTES) -> DataFrame:
    """(_row, _spans): for every row of ``rows`` (_row, text) with a repeated
    window, the spans of its bytes in windows that start anywhere else too."""
    texts = rows.select("_row", "text")
    counted = texts.mapInArrow(_count_task(width, gram), "h long, c long, n long, row long, span long")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    contexts = counted.repartition(parts, "h").groupBy("h", "c").agg(
        F.sum("n").alias("n"), F.max(F.struct("row", "span")).alias("at")).select("h", "c", "n", "at.*")
    shared = contexts.selectExpr("*", "count(*) OVER (PARTITION BY h) AS kinds",
                                 f"sum(span % {_PACK}) OVER (PARTITION BY h) AS bytes").filter("n > 1 OR kinds > 1")
    shared = stage(shared, "repeats-contexts")
    whole = shared.filter("kinds = 1").select("h", "c", F.array(F.col("span") % _PACK).alias("spans"))
    start = F.floor(F.col("span") / _PACK).cast("int")
    cut = (shared.filter("kinds > 1").join(texts.withColumnRenamed("_row", "row"), "row")
           .select("h", "c", "n", F.substring(F.col("text").cast("binary"), start + 1, (F.col("span") % _PACK).cast("int")).alias("context"),
                   (F.col("bytes") > crowded).alias("crowded")))
    cut = stage(cut, "repeats-index-input")
    few = (cut.filter("NOT crowded").drop("crowded").repartition(parts, "h").sortWithinPartitions("h")
           .mapInArrow(_index_task(width), _MARKS))
    marks = stage(whole.unionByName(few).unionByName(_crowded(cut.filter("crowded").drop("crowded"), width, gram)), "repeats-marks")
    places = texts.mapInArrow(_locate_task(width, gram), "h long, c long, row long, start long")
    found = places.join(marks, ["h", "c"]).select(
        F.col("row").alias("_row"), F.transform("spans", lambda s: F.col("start") * _PACK + s).alias("_some"))
    return found.groupBy("_row").agg(F.flatten(F.collect_list("_some")).alias("_spans"))


def _crowded(cut: DataFrame, width: int, gram: int) -> DataFrame:
    """Marks of anchors too frequent for one shard: equal windows are counted
    by an aggregate over (anchor, window) instead of an index."""
    windows = cut.mapInArrow(_window_task(width, gram), "h long, c long, n long, at long, w long")
    twice = windows.groupBy("h", "w").agg(F.sum("n").alias("times")).filter("times > 1").select("h", "w")
    return (windows.join(twice, ["h", "w"]).groupBy("h", "c")
            .agg(F.collect_set(F.col("at") * _PACK + width).alias("spans")))


def _removal(schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            data, offsets, _ = raw_bytes(batch.column(batch.schema.get_field_index("text")))
            blob, spans = data.tobytes(), batch.column(batch.schema.get_field_index("_spans"))
            cells = []
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                text, own = blob[a:b], spans[k]
                removed = runs = 0
                if own.is_valid and len(own):
                    packed = np.sort(own.values.to_numpy(zero_copy_only=False))
                    start = packed // _PACK
                    reach = np.maximum.accumulate(start + packed % _PACK)
                    first = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
                    ends = reach[np.concatenate((first[1:], [len(start)])) - 1]
                    starts = start[first]
                    runs, removed = len(first), int((ends - starts).sum())
                    kept = [text[i:j] for i, j in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True)]
                    text = b"".join(kept)
                cells.append((b - a, removed, runs, hashlib.sha256(text).hexdigest(), text.decode("utf-8", "ignore")))
            columns = [batch.column(batch.schema.get_field_index("_doc")), *(pa.array(c) for c in zip(*cells, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=schema_names)
    return run


FIGURES = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, crowded: int = CROWDED_BYTES) -> DataFrame:
    """Every row of ``docs`` without its text, plus n_bytes, n_removed,
    n_spans, kept_sha256 (of the remaining bytes) and kept_text (the remaining
    bytes as text; halves of a cut character are left out).

    Every byte that lies in a ``width``-byte string which also starts anywhere
    else, in the same row or another, is removed from all its places.  A null
    text is empty; texts shorter than ``width`` stay whole; repeated rows
    repeat each other.  Columns of ``docs`` that bear a result's name are
    replaced.  An empty table gives an empty result.
    """
    docs = docs.drop(*FIGURES)
    rows, _ = _keyed(docs)
    spans = repeated_spans(rows, width, gram, crowded)
    joined = rows.join(spans, "_row", "left").select("_doc", "text", "_spans")
    doc = joined.schema["_doc"].dataType.simpleString()
    made = joined.mapInArrow(_removal(["_doc", *FIGURES]), f"_doc {doc}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return made.select("_doc.*", *FIGURES)


def op3_rindex_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).drop("kept_text")
