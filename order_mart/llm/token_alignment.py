"""Alignment of two tokenizers' tokens over the same bytes.

Every text is encoded by both tokenizers and the ends of their tokens, as byte
offsets, are aligned by divide and conquer.  An interval between two shared
ends is divided near its middle: a bisect in one tokenizer's ends gives the
next candidate, a bisect in the other's ends confirms it or gives the next
one, until both agree, upwards and downwards.  What lies between the two
shared ends so found is cutless and becomes a leaf group, and both sides are
divided again.  The intervals of all texts in a slice are divided together,
level by level, so the depth follows the longest text's logarithm.

Id pairs that end together are counted per block of documents first.  Blocks
are staged once with their distinct pairs; the corpus counts are an aggregate
over those, and come back to a block by a join on the pair.  Every shuffle
carries distinct pairs of blocks or packed frames, not token occurrences.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw_bytes, read_table, slices, stage

#: Text bytes aligned at once, and text bytes of a block.
SLICE_BYTES, BLOCK_BYTES = 1 << 20, 4 << 20
#: Longer texts are encoded in parts, cut where no token of either tokenizer crosses.
PART_CHARS = 1 << 20
#: White-space runs from this length go to the plain (slower) encoder of A.
LONG_RUN = 100_000
#: Before a space between two characters that are not white space, both tokenizers begin anew.
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_RUN = re.compile(r"\s{%d}" % LONG_RUN)

_BLOCKS = "docs binary, links binary, a array<int>, b array<int>, n array<long>"
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# ------------------------------------------------------------- tokenizers
class ByteTokens:
    """Byte-level BPE.  The rank file holds the vocabulary of the JSON file
    as bytes and is the quicker encoder of the same ids."""

    def __init__(self, ranks: str, plain: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            by_bytes = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=by_bytes, special_tokens={})
        self.pieces = [b""] * (max(by_bytes.values()) + 1)
        for piece, i in by_bytes.items():
            self.pieces[i] = piece
        self.path, self.slow = plain, None

    def encode(self, text: str) -> list[int]:
        if len(text) >= LONG_RUN and _RUN.search(text):
            return self._plain().encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)

    def _plain(self):
        if self.slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.no_truncation()
            self.slow.no_padding()
            self.slow.encode_special_tokens = True
        return self.slow


class PieceTokens:
    """Sentence pieces with byte fallback; the model adds the first space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                       for i, n in enumerate(names)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text[1:], num_threads=1)


@lru_cache(maxsize=1)
def tokenizers(ranks: str, plain: str, model: str) -> tuple[ByteTokens, PieceTokens]:
    """One pair for each Python worker, reused by its tasks."""
    return ByteTokens(ranks, plain), PieceTokens(model)


def default_paths() -> tuple[str, str, str]:
    import public_tokenizers

    return tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def _parts(text: str) -> list[str]:
    """``text`` in parts of about PART_CHARS that begin with a space each."""
    out, start = [], 0
    while len(text) - start > PART_CHARS and (cut := _SAFE.search(text, start + PART_CHARS)):
        out.append(text[start: cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def encode_both(text: str, pair: tuple[ByteTokens, PieceTokens]) -> tuple[list[int], list[int]]:
    """Ids of both tokenizers; none if either one's bytes are not the text's."""
    if not text:
        return [], []
    spaced, made = " " + text, []
    for one in pair:
        ids = one.encode(spaced) if len(spaced) <= PART_CHARS else [i for p in _parts(spaced) for i in one.encode(p)]
        pieces = one.pieces
        if b"".join([pieces[i] for i in ids]) != spaced.encode():
            return [], []
        made.append(ids)
    return made[0], made[1]


# ------------------------------------------------------------- divide and conquer
def _next_shared(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Least shared end at or after each offset; the last ends are shared."""
    found, live = at.copy(), np.arange(len(at))
    while len(live):
        one = a[np.searchsorted(a, found[live])]
        two = b[np.searchsorted(b, one)]
        found[live] = two
        live = live[one != two]
    return found


def _last_shared(a: np.ndarray, b: np.ndarray, at: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Greatest shared end at or before each offset, ``low`` if none is above it."""
    found, live = at.copy(), np.flatnonzero(at > low)
    while len(live):
        one = np.searchsorted(a, found[live], side="right") - 1
        one = np.where(one >= 0, a[np.maximum(one, 0)], -1)
        two = np.searchsorted(b, one, side="right") - 1
        two = np.where(two >= 0, b[np.maximum(two, 0)], -1)
        found[live] = two
        live = live[(one != two) & (two > low[live])]
    return np.maximum(found, low)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sorted shared ends of the intervals (low, high] of one byte axis, whose
    bounds are shared."""
    keep = low < high
    low, high, leaves = low[keep], high[keep], []
    while len(low):
        middle = (low + high + 1) // 2
        above = _next_shared(ends_a, ends_b, middle)
        below = _last_shared(ends_a, ends_b, middle - 1, low)
        leaves.append(above)                                      # (below, above] holds no further cut
        left, right = below > low, above < high
        low, high = np.concatenate((low[left], above[right])), np.concatenate((below[left], high[right]))
    return np.sort(np.concatenate(leaves)) if leaves else np.zeros(0, np.int64)


class Aligned:
    """Groups of a list of texts: tokens of both sides in order and the last
    token of every group."""

    def __init__(self, ids: list[tuple[list[int], list[int]]], pair: tuple[ByteTokens, PieceTokens]):
        sizes, flat = [], []
        for side in range(2):
            own = [i[side] for i in ids]
            sizes.append(np.array([len(x) for x in own], np.int64))
            flat.append(np.fromiter((i for x in own for i in x), np.int64, int(sizes[-1].sum())))
        lengths = [np.array([len(p) for p in one.pieces], np.int64) for one in pair]
        ends = [np.cumsum(n[x]) for n, x in zip(lengths, flat, strict=True)]
        self.ids, self.first = flat, [np.concatenate(([0], np.cumsum(n))) for n in sizes]
        total = np.concatenate(([0], ends[0]))[self.first[0]]     # both sides cover the same bytes
        cuts = shared_cuts(ends[0], ends[1], total[:-1], total[1:])
        self.last = [np.searchsorted(e, cuts) for e in ends]
        self.groups = np.searchsorted(cuts, total, side="right")  # each text's first group

    def texts(self, words: np.ndarray, offset: int) -> list[str]:
        """``a1,a2|b1;...`` of every text.  ``words`` holds each id's decimal
        text with its four possible followers."""
        a, b = self.last
        na, nb = (np.diff(np.concatenate(([-1], x))) for x in self.last)
        merged = np.empty(len(self.ids[0]) + len(self.ids[1]), np.int64)
        before_b = np.concatenate(([0], b[:-1] + 1)) if len(b) else b
        at_a = np.arange(len(self.ids[0])) + np.repeat(before_b, na)
        at_b = np.arange(len(self.ids[1])) + np.repeat(a + 1, nb)
        merged[at_a], merged[at_b] = 4 * self.ids[0], 4 * (self.ids[1] + offset) + 2
        merged[at_a[a]] += 1
        merged[at_b[b]] += 1
        said = words[merged].tolist()
        bound = (self.first[0] + self.first[1]).tolist()
        return ["".join(said[i:j])[:-1] for i, j in zip(bound[:-1], bound[1:], strict=True)]


@lru_cache(maxsize=1)
def _words(n_a: int, n_b: int) -> np.ndarray:
    """Decimal ids followed by a comma, or by the sign after a group's last."""
    return np.array([f"{i}{c}" for i in range(n_a) for c in ",|,|"] + [f"{i}{c}" for i in range(n_b) for c in ",;,;"], object)


def align(texts: list[str | None], paths: tuple[str, str, str] | None = None) -> list[list[tuple[list[int], list[int]]]]:
    """Groups (ids of A, ids of B) of each text."""
    pair = tokenizers(*(paths or default_paths()))
    made = Aligned([encode_both(t or "", pair) for t in texts], pair)
    out = []
    for g0, g1 in zip(made.groups[:-1], made.groups[1:], strict=True):
        start = [int(x[g0 - 1]) + 1 if g0 else 0 for x in made.last]
        own = []
        for g in range(g0, g1):
            own.append(tuple(made.ids[s][start[s]: made.last[s][g] + 1].tolist() for s in range(2)))
            start = [int(x[g]) + 1 for x in made.last]
        out.append(own)
    return out


# ------------------------------------------------------------- blocks
def _align_task(paths: tuple[str, str, str], block_bytes: int):
    """One row a block: its documents' figures, the pair of every link as an
    index into the block's distinct pairs, and those pairs with their counts."""
    def emit(held) -> pa.RecordBatch:
        import zstandard

        pairs, at, n = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")                     # frequent pairs get small numbers
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        pairs, n = pairs[order], n[order]
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches([h[0] for h in held])
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        pack = zstandard.ZstdCompressor(level=3).compress
        return pa.RecordBatch.from_arrays(
            [pa.array([pack(sink.getvalue().to_pybytes())], pa.binary()), pa.array([pack(place[at].tobytes())], pa.binary()),
             pa.array([(pairs >> 32).astype(np.int32)], pa.list_(pa.int32())),
             pa.array([(pairs & 0xFFFFFFFF).astype(np.int32)], pa.list_(pa.int32())), pa.array([n], pa.list_(pa.int64()))],
            names=["docs", "links", "a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(*paths)
        words, offset = _words(len(pair[0].pieces), len(pair[1].pieces)), len(pair[0].pieces)
        held, size = [], 0
        for part in slices(batches, "text", SLICE_BYTES):
            data, offsets, _ = raw_bytes(part.column(1))
            blob = data.tobytes()
            texts = [blob[i:j].decode("utf-8", "replace") for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            made = Aligned([encode_both(t, pair) for t in texts], pair)
            said = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in made.texts(words, offset)]
            links = (made.ids[0][made.last[0]] << 32) | made.ids[1][made.last[1]]
            n_a, n_b, groups = np.diff(made.first[0]), np.diff(made.first[1]), np.diff(made.groups)
            held.append((pa.RecordBatch.from_arrays([part.column(0), pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(said)],
                                                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]), links))
            size += len(data)
            if size >= block_bytes:
                yield emit(held)
                held, size = [], 0
        if held:
            yield emit(held)
    return run


def _finish(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Figures of a block's documents from the corpus counts of its pairs."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    place = answers.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place] = answers.column("count").to_numpy()
    best[place] = answers.column("best").to_numpy()
    out = []
    for docs, links in zip(block.column("docs").to_pylist(), block.column("links").to_pylist(), strict=True):
        docs = pa.ipc.open_stream(unpack(docs)).read_all()
        links = np.frombuffer(unpack(links), np.uint32)
        bound = np.concatenate(([0], np.cumsum(docs.column("n_groups").to_numpy())))
        sums = [np.concatenate(([0], np.cumsum(v[links])))[bound] for v in (best, count)]
        groups = docs.column("n_groups")
        out.append(pa.Table.from_arrays(
            [docs.column("doc_id"), docs.column("n_a"), docs.column("n_b"), groups, groups,
             pa.array(np.diff(sums[0])), pa.array(np.diff(sums[1])), docs.column("groups_sha256")], names=["doc_id", *FIGURES]))
    return pa.concat_tables(out)


def aligned_blocks(docs: DataFrame, paths: tuple[str, str, str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Staged blocks of ``docs``: block, docs, links, a, b, n."""
    made = docs.select("doc_id", "text").mapInArrow(_align_task(paths or default_paths(), block_bytes), _BLOCKS)
    return stage(made.withColumn("block", F.monotonically_increasing_id()), "alignment-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): links of every id pair in the corpus, and whether
    no other pair of its b has more."""
    pairs = blocks.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def align_documents(docs: DataFrame, paths: tuple[str, str, str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of
    every row of ``docs``.

    ``paths``: rank file and JSON file of A, model file of B.  A null or empty
    text, and one whose tokens' bytes are not space+text on either side, has
    no tokens: zeros and ''.  Repeated rows give repeated results and count
    each.  Tied pairs of a B id are all its best.  Very long texts are encoded
    in parts but aligned whole; a block holds one text at least.  An empty
    table gives an empty result; further columns are ignored.
    """
    blocks = aligned_blocks(docs, paths, block_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    places = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("place", "p")).select("block", "place", "p.*")
    answers = places.join(pair_counts(blocks), ["a", "b"]).select("block", "place", "count", "best")
    packed = blocks.select(F.col("block").alias("own"), "docs", "links")
    return (packed.groupBy("own").cogroup(answers.groupBy("block")).applyInArrow(
        _finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"))
