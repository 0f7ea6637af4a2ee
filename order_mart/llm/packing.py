"""Best-fit packing of tokenised documents with certified bin counts.

Pieces are dealt into partitions by a hash of their row number and each partition is packed by
best-fit decreasing.  Dual-feasible functions give each partition a lower
bound on its number of sequences, so a partition whose count equals the bound
is certified.  Partitions with a gap exchange what lies in their unfilled
sequences (certified ones give their emptiest sequence, the cost of rounding
up), which is dealt anew and packed again, until a round saves nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import raw_bytes, read_table, slices, stage
from .tokens import default_path, encoder

CAPACITY = 4096
END_ID = 1
#: Of the hash that deals pieces.
DEAL_SEED = 1
#: Pieces of a partition, which one task packs.
PARTITION_PIECES = 20_000
#: Rounds of exchange at most; each has to save a sequence to be followed by another.
ROUNDS = 6


# ------------------------------------------------------------- tokenised pieces
def _cut(path: str, capacity: int, remember: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        words, tail = encoder(path), np.array([END_ID], "<u4").tobytes()
        for part in slices(batches, "text", 8 << 20):
            data, offsets, _ = raw_bytes(part.column(1))
            blob = data.tobytes()
            texts = [blob[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            ids_of = words.table(set().union(*texts)).__getitem__
            rows = []
            for n, text in enumerate(texts):
                ids = b"".join(map(ids_of, text)) + tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at: at + 4 * capacity]
                    rows.append((n, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            of, piece, start, length, crc = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        if not remember:
            words.forget()
    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, remember: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a text's ids and the end id,
    cut after every ``capacity`` ids.  A null text is empty (the end id alone).
    Words are remembered for a worker's next tasks (some 200 MB) unless
    ``remember`` is false, which spares that memory for the stages to come."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _cut(path or default_path(), capacity, remember), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------- one partition
def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Largest of the bounds by dual-feasible functions: each maps sizes so
    that whatever fits a bin maps to at most one bin's worth."""
    sizes, counts = np.unique(lengths, return_counts=True)
    if not len(sizes):
        return 0
    best = -(-int((sizes * counts).sum()) // capacity)
    half = capacity // 2
    for e in sizes[sizes <= half].tolist():                     # large items fill a bin, small ones vanish
        mapped = np.where(sizes > capacity - e, capacity, np.where(sizes >= e, sizes, 0))
        best = max(best, -(-int((mapped * counts).sum()) // capacity))
    for k in range(1, 21):                                      # rounding down to multiples of 1/k
        scaled = (k + 1) * sizes
        mapped = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((mapped * counts).sum()) // (k * capacity)))
    for step in {capacity // d for d in range(3, 33)}:          # counting steps from both ends
        whole = 2 * (capacity // step)
        mapped = np.where(2 * sizes > capacity, whole - 2 * ((capacity - sizes) // step),
                          np.where(2 * sizes == capacity, capacity // step, 2 * (sizes // step)))
        best = max(best, -(-int((mapped * counts).sum()) // whole))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin.  Open bins are
    stacked by free room; a bit set finds the smallest room that suffices."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, target = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = target, fills[target]
        fills[target] += size
        by_room[room - size].append(target)
        rooms |= 1 << (room - size)
    return bins, offsets, np.array(fills, np.int64)


_PLACE = [StructField("_bin", LongType()), StructField("offset", LongType()), StructField("_gap", LongType()),
          StructField("_open", BooleanType())]


_WORKING = ("_row", "_part", "_bin", "offset", "_gap", "_open", "sequence_id")


def _pack_partition(capacity: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy().astype(np.int64)
        bins, offsets, fills = best_fit_decreasing(lengths, capacity)
        gap = len(fills) - lower_bound(lengths, capacity)
        emptiest = np.arange(len(fills)) == int(np.argmin(fills))
        open_bin = (fills < capacity) & (emptiest | (gap > 0))
        for name, values in (("_bin", bins), ("offset", offsets), ("_gap", np.full(len(bins), gap)), ("_open", open_bin[bins])):
            table = table.append_column(name, pa.array(values))
        return table.select(schema.names).cast(schema)
    return run


def _round(items: DataFrame, number: int, capacity: int, partition_pieces: int) -> tuple[DataFrame, dict]:
    parts = max(1, -(-items.count() // partition_pieces))
    dealt = items.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(DEAL_SEED + number), "_row"), F.lit(parts)))
    schema = StructType(dealt.schema.fields + _PLACE)
    packed = stage(dealt.groupBy("_part").applyInArrow(_pack_partition(capacity, to_arrow_schema(schema)), schema),
                   f"packing-round-{number}")
    opened = F.col("offset") == 0
    figures = packed.agg(F.count_if(opened).alias("bins"), F.count_if(opened & F.col("_open")).alias("open_bins")).first()
    return packed, figures.asDict()


def pack(items: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``items`` (length, at most ``capacity``, and further columns) plus
    sequence_id and offset.  Every item is placed once; sequences are gapless
    from offset 0.  Columns of ``items`` that bear a result's or a working
    name (``_row``, ``_part``, ``_bin``, ``_gap``, ``_open``) are replaced.
    Equal rows are dealt apart, by the number that staging gives each.  After
    ``rounds`` exchanges a partition may stay above its lower bound.  An empty
    table gives an empty result."""
    items = items.drop(*_WORKING)
    columns = items.columns
    items = stage(items.withColumn("_row", F.monotonically_increasing_id()), "packing-items")
    sequence = [F.col(c) for c in columns] + [F.col("sequence_id"), F.col("offset")]
    numbered = lambda df, n: df.withColumn("sequence_id", F.lit(n << 56) + F.shiftleft("_part", 28) + F.col("_bin"))
    full = items.filter(F.col("length") == capacity)
    packed, figures = _round(items.filter(F.col("length") < capacity), 1, capacity, partition_pieces)
    settled, current, at = [], numbered(packed, 1), figures["open_bins"]
    for number in range(2, rounds + 2):
        if at < 2:
            break
        pool = current.filter("_open")
        again, figures = _round(pool.select(*columns, "_row"), number, capacity, partition_pieces)
        if figures["bins"] >= at:
            break
        settled.append(current.filter("NOT _open").select(*sequence))
        current, at = numbered(again, number), figures["open_bins"]
    alone = full.select(*[F.col(c) for c in columns], (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = current.select(*sequence)
    for part in [*settled, alone]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES,
                   remember: bool = True) -> DataFrame:
    """Pieces of every document with their sequence and place in it: doc_id,
    piece, start, length, ids_crc32, sequence_id, offset.  Repeated rows are
    packed each; a very long text is cut into many pieces by one task; an empty
    table gives an empty result; further columns of ``docs`` are ignored."""
    return pack(token_pieces(docs, path, capacity, remember), capacity, partition_pieces)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
