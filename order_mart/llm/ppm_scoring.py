"""Language-model scores by prediction by partial matching.

A text is its words (A-Z lower-cased) with one space between and an end sign,
as bytes.  The model is a trie of byte contexts up to ``order`` bytes with the
counts of the bytes that follow them in all training texts.  A byte is coded
in its longest known context; a context that has not seen the byte pays its
escape probability, distinct followers over occurrences plus followers
(method C), and the next shorter context is asked without the followers
already ruled out (symbol exclusion).  Below the empty context all symbols
left are equally likely.

What a byte costs depends on the bytes before it within ``order``, so every
distinct gram (context and byte) is priced once.  Blocks of documents list
their distinct grams and words with training counts, dealt into buckets; a
bucket holds all contexts that end in the same two bytes, with their part of
the trie.  Its task adds up the counts of all blocks, prices its grams and
answers every block's lists in order.  The counts of the two shortest
contexts, 65,792 numbers whatever the data, go to all tasks.

Lists and answers travel as zstandard frames.  The plan of ``docs`` has to be
deterministic (a table scan or a staged table), since it is read twice; a
block whose answers are missing fails.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_remainder, raw_bytes, read_table, slices, stage

#: Longest context; a bucket then holds at most 2^24 grams for each two-byte ending.
ORDER = 4
#: Every byte but the six of ASCII white space, the space between words, and the end sign.
SYMBOLS = 256 - 6 + 2
#: Text bytes of a block, and grams that are handled at once within it.
BLOCK_BYTES, SEGMENT = 8 << 20, 4 << 20
#: Entries of a table that numbers grams by their place; above, they are sorted.
TABLE = 1 << 25
#: Buckets for each shuffle partition, and at most.
BUCKETS_PER_PARTITION, MOST_BUCKETS = 4, 4096

_LISTS = "block long, kind int, bucket int, items binary, counts binary, tokens long"
_COUNTS, _GRAMS, _WORDS = 0, 1, 2


# ------------------------------------------------------------- grams
_SPELLED = bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\v\f\r", b"     "))
_SPACE, _END, _PAD = b" "[0], b"\n"[0], b"\t"[0]


def symbols_of(texts: list[bytes]) -> bytes:
    """Words of every text, lower-cased, with one space between and the end
    sign after each text."""
    data = np.frombuffer(b"\n".join([t.translate(_SPELLED) for t in texts]) + b"\n", np.uint8)
    space = data == _SPACE
    ends = space | (data == _END)
    space[1:] &= ends[:-1]                                       # leading and repeated spaces
    data = data[~space]
    space = data == _SPACE
    space[:-1] &= data[1:] == _END                               # trailing spaces
    return data[~space].tobytes()


def _sizes(symbols: bytes) -> np.ndarray:
    """Symbols of every text."""
    return np.diff(np.flatnonzero(np.frombuffer(symbols, np.uint8) == _END), prepend=-1)


def _numbered(data: np.ndarray, order: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams, and the place among them of the gram that ends at
    each byte marked ``own`` after the first ``order``: grams one byte longer
    are numbered by the place of the shorter gram and the byte."""
    values = np.flatnonzero(np.bincount(data, minlength=256))
    rank = np.zeros(256, np.int64)
    rank[values] = np.arange(len(values))
    place = symbol = rank[data]
    byte, width = values, len(values)
    for k in range(1, order + 1):
        key = place[:-1] * width
        key += symbol[k:]
        if k == order:
            key = key[own]
        if len(values) * width <= TABLE:
            there = np.zeros(len(values) * width, bool)
            there[key] = True
            found = np.flatnonzero(there)
            to = np.empty(len(there), np.int32)
            to[found] = np.arange(len(found), dtype=np.int32)
            place = to[key].astype(np.int64)
        else:
            found, place = np.unique(key, return_inverse=True)
        values = (values[found // width] << 8) | byte[found % width]
    return values, place


def _segments(symbols: bytes, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted distinct grams, each symbol's place among them), ``SEGMENT``
    bytes at a time.  A gram is a symbol with the ``order`` bytes before it as
    one number; the spaces that no text holds stand before its first symbol."""
    pad = bytes([_PAD]) * order
    data = np.frombuffer(pad + symbols.replace(b"\n", b"\n" + pad), np.uint8)
    for at in range(order, len(data) - order, SEGMENT):
        window = data[at - order: min(at + SEGMENT, len(data) - order)]
        padding = window == _PAD
        yield _numbered(np.where(padding, np.uint8(_SPACE), window), order, ~padding[order:])


def grams_of(texts: list[list[bytes]], order: int) -> np.ndarray:
    """Every symbol's gram, of texts given as words."""
    symbols = b"".join([b" ".join(words) + b"\n" for words in texts])
    return np.concatenate([np.zeros(0, np.int64), *(u[place] for u, place in _segments(symbols, order))])


def _bucket_of(gram: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a gram by the last two bytes of its context."""
    ending = ((gram >> 8) & 0xFFFF).astype(np.uint64)
    return ((ending * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % buckets


def _distinct(symbols: bytes, order: int, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams with their numbers of symbols marked ``train``."""
    own, parts, at = [], [], 0
    for u, place in _segments(symbols, order):
        own.append(u)
        parts.append(np.bincount(place[train[at: at + len(place)]], minlength=len(u)))
        at += len(place)
    return (own[0], parts[0]) if len(own) == 1 else _summed(np.concatenate(own), np.concatenate(parts))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their values added up."""
    u, inverse = np.unique(keys, return_inverse=True)
    out = np.zeros(len(u), np.int64)
    np.add.at(out, inverse, values)
    return u, out


# ------------------------------------------------------------- the model
class Level:
    """Contexts of one length: sorted keys with their followers' counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        context = keys >> 8
        first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.contexts = context[first]
        self.total = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        self.kinds = np.diff(np.concatenate((first, [len(keys)])))
        self.first = first

    def excluded(self, shorter: np.ndarray) -> None:
        """``shorter``: each key's count in the next shorter context; its sum
        is what exclusion takes from that context."""
        self.gone = np.add.reduceat(shorter, self.first) if len(self.first) else np.zeros(0, np.int64)


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there)."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def prices(asked: np.ndarray, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of every asked gram.

    ``keys`` and ``counts``: the training grams of whole two-byte endings, all
    that ``asked`` has; ``pairs``: the counts of the two shortest contexts.

    The followers of a context are followers of its suffixes too, so what is
    excluded at a length are just the followers of the next longer context."""
    levels: list[Level] = []
    for k in range(order + 1):
        if k >= 2:
            mask = (1 << (8 * (k + 1))) - 1
            levels.append(Level(*_summed(keys & mask, counts)))
        else:
            flat = pairs.ravel() if k else pairs.sum(axis=0)
            at = np.flatnonzero(flat)
            levels.append(Level(at, flat[at]))
        if k:
            shorter = levels[-2]
            place, found = _find(shorter.keys, levels[-1].keys & ((1 << (8 * k)) - 1))
            levels[-1].excluded(np.where(found, shorter.counts[place] if len(shorter.counts) else 0, 0))
        else:
            levels[-1].excluded(np.zeros(len(levels[-1].keys), np.int64))
    out = np.zeros(len(asked))
    live = np.arange(len(asked))
    gone, ruled = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)   # of the next shorter context
    for k in range(order, -1, -1):
        level = levels[k]
        gram = asked[live] & ((1 << (8 * (k + 1))) - 1)
        node, known = _find(level.contexts, gram >> 8)
        place, seen = _find(level.keys, gram)
        zero = np.zeros(len(live), np.int64)
        total = np.where(known, level.total[node] - gone[live], 0) if len(level.total) else zero
        kinds = np.where(known, level.kinds[node] - ruled[live], 0) if len(level.total) else zero
        coded = np.where(seen, level.counts[place], 0) if len(level.counts) else zero
        some = kinds > 0
        whole = np.where(some, total + kinds, 1)
        out[live] += np.where(some, np.log10(np.where(seen, coded, np.where(some, kinds, 1)) / whole), 0.0)
        if len(level.total):
            gone[live] = np.where(known, level.gone[node], gone[live])
            ruled[live] = np.where(known, level.kinds[node], ruled[live])
        live = live[~seen]
    out[live] -= np.log10(SYMBOLS - ruled[live])
    return out


# ------------------------------------------------------------- blocks
@cache
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _pack(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def _unpack(frame: bytes) -> bytes:
    return _zstd()[1].decompress(frame)


def _deltas(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0).tobytes())


def _from_deltas(frame: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(_unpack(frame), np.int64))


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int):
    """(block id, rows, symbols of the texts): the id is a hash of the content."""
    import xxhash

    for part in slices(batches, "text", block_bytes):
        data, offsets, _ = raw_bytes(part.column(1))
        h = xxhash.xxh3_64(np.ascontiguousarray(data))
        h.update(np.ascontiguousarray(offsets))
        h.update(repr(part.column(0)[0].as_py()).encode())
        blob = data.tobytes()
        texts = [blob[i:j] for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield h.intdigest() - (1 << 63), part, symbols_of(texts)


def _words_of(symbols: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, each token's place among them, tokens of each text);
    the empty word is the end sign, the last token of every text."""
    data = np.frombuffer(symbols, np.uint8)
    end = data == _END
    apart = end | (data == _SPACE)
    at = np.flatnonzero(apart)
    length, last = np.diff(at, prepend=-1) - 1, end[at]
    whole = np.insert(length, np.flatnonzero(last & (length > 0)) + 1, 0)
    offsets = np.concatenate(([0], np.cumsum(whole)))
    words = pa.Array.from_buffers(pa.large_binary(), len(whole), [None, pa.py_buffer(offsets), pa.py_buffer(data[~apart])]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.diff(np.flatnonzero(whole == 0), prepend=-1)


def _dealt(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by bucket, bounds of the buckets); ties keep their order."""
    order = np.argsort(bucket.astype(np.uint16), kind="stable")   # by radix
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _dealt_words(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A word's bucket is a weighted sum of its bytes; weights return after 1,024 bytes."""
    data, offsets, _ = raw_bytes(words)
    weight = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))
    terms = weight[(np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))) & 1023]
    terms *= data
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
    mixed = (total[offsets[1:]] - total[offsets[:-1]]) * np.uint64(0xD6E8FEB86659FD93)
    return _dealt(((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), buckets)


def _dealt_grams(distinct: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Within a bucket grams ascend."""
    return _dealt(_bucket_of(distinct, buckets), buckets)


def _list_task(order: int, buckets: int, block_bytes: int):
    """A block's rows: its distinct grams and words by bucket with their
    counts in training texts, and one row with its counts of byte pairs."""
    def run(batches):
        for block, part, symbols in _blocks(batches, block_bytes):
            train = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            distinct, counts = _distinct(symbols, order, np.repeat(train, _sizes(symbols)))
            words, places, n_tokens = _words_of(symbols)
            pairs, n = _summed(distinct & 0xFFFF, counts)
            rows = [(_COUNTS, 0, _deltas(pairs), _pack(n.tobytes()), int(n_tokens[train].sum()))]
            at, bound = _dealt_grams(distinct, buckets)
            distinct, counts = distinct[at], counts[at]
            for k, (i, j) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)):
                if i < j:
                    rows.append((_GRAMS, k, _deltas(distinct[i:j]), _pack(counts[i:j].tobytes()), 0))
            times = np.bincount(places[np.repeat(train, n_tokens)], minlength=len(words))
            at, bound = _dealt_words(words, buckets)
            lines = pc.binary_join_element_wise(words.take(at), pa.scalar(b"", words.type), pa.scalar(b"\n", words.type))
            lines, ends, _ = raw_bytes(lines)
            times = times[at]
            for k, (i, j) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)):
                if i < j:
                    rows.append((_WORDS, k, _pack(lines[ends[i]: ends[j] - 1].tobytes()), _pack(times[i:j].tobytes()), 0))
            kind, bucket, items, seen, tokens = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(rows), pa.int64()), pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()),
                 pa.array(items, pa.binary()), pa.array(seen, pa.binary()), pa.array(tokens, pa.int64())],
                names=["block", "kind", "bucket", "items", "counts", "tokens"])
    return run


def _pair_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = np.zeros(1 << 16, np.int64), 0
    for batch in batches:
        for items, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[_from_deltas(items)] += np.frombuffer(_unpack(counts), np.int64)
        tokens += sum(batch.column(2).to_pylist())
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], tokens))], names=["pair", "n"])


class _GramTable:
    """A bucket's training grams, added up from the blocks' lists."""

    def __init__(self, pairs: np.ndarray, order: int):
        self.pairs, self.order, self.parts, self.pending = pairs, order, [], 0
        self.done = None

    def add(self, items: bytes, counts: bytes) -> None:
        keys, n = _from_deltas(items), np.frombuffer(_unpack(counts), np.int64)
        self.parts.append((keys, n))
        self.pending += len(keys)
        if self.pending > SEGMENT + len(self.parts[0][0]):        # the table doubles between merges
            self._merge()

    def _merge(self) -> None:
        self.parts = [_summed(*(np.concatenate(c) for c in zip(*self.parts, strict=True)))]
        self.pending = 0

    def answer(self, items: bytes) -> bytes:
        if self.done is None:                                     # every gram of the bucket is priced once
            self._merge()
            keys, n = self.parts[0]
            learned = n > 0
            self.done = keys, prices(keys, keys[learned], n[learned], self.pairs, self.order)
        keys, priced = self.done
        return _pack(priced[np.searchsorted(keys, _from_deltas(items))].tobytes())

    def distinct(self) -> int:
        return 0


class _WordTable:
    """A bucket's words with their counts in all training texts."""

    def __init__(self):
        self.times: dict[bytes, int] = {}

    def add(self, items: bytes, counts: bytes) -> None:
        times = self.times
        for word, n in zip(_unpack(items).split(b"\n"), np.frombuffer(_unpack(counts), np.int64).tolist(), strict=True):
            times[word] = times.get(word, 0) + n

    def answer(self, items: bytes) -> bytes:
        times = self.times
        return _pack(np.array([times[w] for w in _unpack(items).split(b"\n")], np.int64).tobytes())

    def distinct(self) -> int:
        return sum(n > 0 for n in self.times.values())


def _bucket_task(pairs: np.ndarray, order: int):
    """Rows come sorted by kind, bucket and ``asks``: first all lists that
    add to a bucket's table, then the same lists to be answered.  A bucket's
    distinct training words leave as a row without a block."""
    def run(batches):
        now, table = None, None
        for batch in batches:
            out = []
            for block, kind, bucket, items, counts, asks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (kind, bucket) != now:
                    if table is not None:
                        out.append((None, now[0], now[1], None, table.distinct()))
                    now, table = (kind, bucket), _GramTable(pairs, order) if kind == _GRAMS else _WordTable()
                if asks:
                    out.append((block, kind, bucket, table.answer(items), 0))
                else:
                    table.add(items, counts)
            yield _answers(out)
        if table is not None:
            yield _answers([(None, now[0], now[1], None, table.distinct())])
    return run


_ANSWERS = "block long, kind int, bucket int, answer binary, words long"


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                      names=["block", "kind", "bucket", "answer", "words"])


def _text_task(block_bytes: int):
    """A block's document ids and texts, packed."""
    def run(batches):
        for block, part, symbols in _blocks(batches, block_bytes):
            sink = pa.BufferOutputStream()
            ids = pa.RecordBatch.from_arrays([part.column(0), part.column(2)], names=["doc_id", "train"])
            with pa.ipc.new_stream(sink, ids.schema) as w:
                w.write_batch(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                 pa.array([_pack(symbols)], pa.binary())], names=["own", "docs", "texts"])
    return run


def _score_task(order: int, buckets: int):
    """Join a block's texts with the answers to its lists, by position."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        found = {(k, b): a for k, b, a in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "answer")), strict=True)}
        out = []
        for docs, frame in zip(texts.column("docs").to_pylist(), texts.column("texts").to_pylist(), strict=True):
            docs = pa.ipc.open_stream(docs).read_all()
            symbols = _unpack(frame)
            words, places, n_tokens = _words_of(symbols)
            times = _answered(found, _WORDS, *_dealt_words(words, buckets), np.int64)[places]
            first = np.cumsum(n_tokens) - n_tokens
            out.append(pa.table({
                "doc_id": docs.column("doc_id"), "train": docs.column("train"),
                "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(np.add.reduceat(times > 0, first, dtype=np.int64)),
                "logs": pa.array(np.add.reduceat(np.log10(times + 0.5), first)), "score": pa.array(_text_costs(symbols, found, order, buckets))}))
        return pa.concat_tables(out)
    return run


def _answered(found: dict, kind: int, place: np.ndarray, bound: np.ndarray, dtype) -> np.ndarray:
    """The answers of all buckets, in the order of what was asked."""
    out = np.empty(len(place), dtype)
    for k, (i, j) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)):
        if i < j:
            out[place[i:j]] = np.frombuffer(_unpack(found[kind, k]), dtype)
    return out


def _text_costs(symbols: bytes, found: dict, order: int, buckets: int) -> np.ndarray:
    """log10 probability of each text: its grams' prices added up."""
    parts = list(_segments(symbols, order))
    distinct = parts[0][0] if len(parts) == 1 else np.unique(np.concatenate([u for u, _ in parts]))
    priced = _answered(found, _GRAMS, *_dealt_grams(distinct, buckets), np.float64)
    price = np.concatenate([priced[np.searchsorted(distinct, u)][place] for u, place in parts])
    sizes = _sizes(symbols)
    return np.add.reduceat(price, np.cumsum(sizes) - sizes)


# ------------------------------------------------------------- the operator
def score_documents(docs: DataFrame, held_out: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row of ``docs``; rows where ``held_out`` is not true are learned from.

    ``score`` is the model's log10 probability of the text's symbols with its
    end sign, ``base_score`` that of its tokens under add-half word counts.  A
    null or empty text is one token, the end.  Without training rows every
    symbol is equally likely and train_tokens is 0.  Repeated rows count each
    and are scored each.  Very long texts are handled in segments; a block
    holds one text at least.  An empty table gives an empty result; further
    columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", (~F.coalesce(held_out, F.lit(False))).alias("train"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MOST_BUCKETS, BUCKETS_PER_PARTITION * parts)
    lists = stage(rows.mapInArrow(_list_task(order, buckets, block_bytes), _LISTS), "ppm-lists", "none")

    pairs, train_tokens = np.zeros((256, 256), np.int64), 0
    short = (lists.filter(F.col("kind") == _COUNTS).select("items", "counts", "tokens").mapInArrow(_pair_task, "pair long, n long")
             .groupBy("pair").agg(F.sum("n").alias("n")))
    for r in short.collect():                                     # 65,537 numbers at most
        if r.pair < 0:
            train_tokens = r.n
        else:
            pairs[r.pair >> 8, r.pair & 255] = r.n
    both = (lists.filter(F.col("kind") != _COUNTS).select("block", "kind", "bucket", "items", "counts", F.explode(F.array(F.lit(0), F.lit(1))).alias("asks"))
            .withColumn("counts", F.when(F.col("asks") == 0, F.col("counts"))))
    answers = (both.repartition(parts, "kind", "bucket").sortWithinPartitions("kind", "bucket", "asks")
               .mapInArrow(_bucket_task(pairs, order), _ANSWERS))
    answers = stage(answers, "ppm-answers", "none")
    words = answers.filter(F.col("block").isNull()).agg(F.coalesce(F.sum("words"), F.lit(0)).alias("n")).first().n
    texts = rows.mapInArrow(_text_task(block_bytes), "own long, docs binary, texts binary")
    scored = texts.groupBy("own").cogroup(answers.filter(F.col("block").isNotNull()).groupBy("block")).applyInArrow(
        _score_task(order, buckets), f"doc_id {kind}, train boolean, n_tokens long, n_known long, logs double, score double")
    whole = float(np.log10(train_tokens + 0.5 * (words + 1)))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
                         (F.col("logs") - F.col("n_tokens") * F.lit(whole)).alias("base_score"), "score")


def op11_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_documents(docs, in_remainder("doc_id", 5, 1))
