"""BPE encoding and decoding through a distinct-word table.

Documents are cut into blocks; every block lists its distinct words, dealt
into buckets by word hash.  The bucket tasks form the distinct-word table and
encode each distinct word once, however many blocks hold it.  The distinct ids
of a task are joined with the id-to-piece table, which the vocabulary file
bounds.  Each block is answered with its words' ids and those ids' pieces; it
joins the ids back by the words' positions and decodes each distinct word once.

Word lists and texts travel as zstandard frames, so the shuffles carry a
fraction of the text.  The plan of ``docs`` has to be deterministic (a table
scan or a staged table), since it is read twice; a block whose words are
missing fails.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw_bytes, read_table, slices
from .tokens import default_path, encoder

#: Text bytes of a block: bounds the memory of a task.
BLOCK_BYTES = 8 << 20
#: Buckets for each shuffle partition.  A block sends a frame for each bucket
#: that it has words in, so more of them would mean more and smaller frames.
BUCKETS_PER_PARTITION = 1

_LISTS = "block long, bucket int, words binary"
_IDS = "block long, bucket int, ids binary"
_TEXTS = "block long, doc_ids binary, sizes binary, texts binary"


def _block_id(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> int:
    """Content hash of a block, the same whenever the block is read again."""
    import xxhash

    h = xxhash.xxh3_64(np.ascontiguousarray(data))
    h.update(np.ascontiguousarray(offsets))
    h.update(repr(part.column(0)[0].as_py()).encode())
    return h.intdigest() - (1 << 63)


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int):
    for part in slices(batches, "text", block_bytes):
        data, offsets, _ = raw_bytes(part.column(part.schema.get_field_index("text")))
        yield _block_id(part, data, offsets), part, data, offsets


def _pack(parts: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(parts)


def _unpack(frame: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(frame)


def _deal(texts: list[list[bytes]], buckets: int) -> list[list[bytes]]:
    """A block's distinct words by bucket, sorted: a word's position in its
    list is the key that its ids come back by."""
    import zlib

    dealt: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in {w for text in texts for w in text}:
        dealt[zlib.crc32(word) % buckets].append(word)
    for words in dealt:
        words.sort()
    return dealt


def _word_lists(buckets: int, block_bytes: int):
    def run(batches):
        for block, _, data, offsets in _blocks(batches, block_bytes):
            blob = data.tobytes()
            texts = [blob[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            rows = [(k, _pack(b"\n".join(words))) for k, words in enumerate(_deal(texts, buckets)) if words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.binary())], names=["block", "bucket", "words"])
    return run


#: Rows between encoding and answering, in their partition's order (``_at``):
#: the ids that the partition meets for the first time (at most the
#: vocabulary), then the list's answer (ids of each word) without pieces.
_STEPS = "_at long, block long, bucket int, ids binary, id int"


def _encode_lists(path: str):
    """Answer word lists of a partition sorted by bucket.  A distinct word is
    encoded once, when its bucket first holds it; a bucket's words are
    forgotten after it, the encoder's memory after the task."""
    def run(batches):
        words_of = encoder(path)
        encode, table, seen, current, at = words_of.encode, {}, set(), None, 0
        for batch in batches:
            for block, bucket, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    table, current = {}, bucket
                words = _unpack(frame).split(b"\n")
                new = [w for w in words if w not in table]
                table.update(zip(new, encode(new), strict=True))
                own = [table[w] for w in words]
                counts, ids = np.fromiter(map(len, own), np.uint32, len(own)), b"".join(own)
                fresh = [i for i in np.unique(np.frombuffer(ids, np.int32)).tolist() if i not in seen]
                seen.update(fresh)
                n = len(fresh) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(at, at + n)), pa.array(np.full(n, block)), pa.array(np.full(n, bucket, np.int32)),
                     pa.array([None] * len(fresh) + [len(own).to_bytes(4, "little") + counts.tobytes() + ids], pa.binary()),
                     pa.array([*fresh, None], pa.int32())], names=["_at", "block", "bucket", "ids", "id"])
                at += n
        words_of.forget()
    return run


def _add_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Give each answer the pieces of its distinct ids."""
    piece_of, after = {}, 0
    for batch in batches:
        order = batch.column("_at").to_numpy()
        if len(order) and not (order[0] == after and (np.diff(order) == 1).all()):
            raise ValueError("the join with the pieces changed the order of rows")
        after += len(order)
        out = []
        for block, bucket, answer, i, piece in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "ids", "id", "piece")), strict=True):
            if i is not None:
                piece_of[i] = (piece or "").encode()
            if answer is None:
                continue
            words = int.from_bytes(answer[:4], "little")
            own = np.unique(np.frombuffer(answer, np.uint32, offset=4 + 4 * words))
            pieces = [piece_of[k] for k in own.tolist()]
            sizes = np.fromiter(map(len, pieces), np.uint32, len(pieces))
            out.append((block, bucket, _pack(b"".join([len(own).to_bytes(4, "little"), own.tobytes(), sizes.tobytes(), *pieces, answer[4:]]))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)],
                                             names=["block", "bucket", "ids"])


def _slices(data: bytes, start: int, sizes: np.ndarray) -> list[bytes]:
    ends = (start + np.cumsum(sizes, dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([start, *ends], ends, strict=False)]


def _texts(block_bytes: int):
    def run(batches):
        for block, part, data, offsets in _blocks(batches, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("doc_id", part.schema.field(0).type)])) as w:
                w.write_batch(pa.RecordBatch.from_arrays([part.column(0)], names=["doc_id"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                 pa.array([np.diff(offsets).astype(np.int64).tobytes()], pa.binary()), pa.array([_pack(data.tobytes())], pa.binary())],
                names=["block", "doc_ids", "sizes", "texts"])
    return run


def _join_back(emit, buckets: int):
    """Join a block's texts with its words' ids by position."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        by_bucket = dict(zip(answers.column("bucket").to_pylist(), answers.column("ids").to_pylist(), strict=True))
        for doc_ids, sizes, frame in zip(*(texts.column(c).to_pylist() for c in ("doc_ids", "sizes", "texts")), strict=True):
            doc_ids = pa.ipc.open_stream(doc_ids).read_all().column(0)
            blob, ends = _unpack(frame), np.cumsum(np.frombuffer(sizes, np.int64)).tolist()
            split = [blob[a:b].split() for a, b in zip([0, *ends], ends, strict=False)]
            ids_of, said_of = {}, {}
            for bucket, words in enumerate(_deal(split, buckets)):
                if not words:
                    continue
                answer = _unpack(by_bucket[bucket])
                n = int.from_bytes(answer[:4], "little")
                lengths = np.frombuffer(answer, np.uint32, n, 4 + 4 * n)
                pieces = dict(zip(np.frombuffer(answer, np.uint32, n, 4).tolist(), _slices(answer, 4 + 8 * n, lengths), strict=True))
                start = 4 + 8 * n + int(lengths.sum())
                counts = np.frombuffer(answer, np.uint32, len(words), start)
                for word, own in zip(words, _slices(answer, start + 4 * len(words), counts), strict=True):
                    ids_of[word] = own
                    said_of[word] = b" ".join([pieces[i] for i in memoryview(own).cast("I")])
            out.append(emit.table(doc_ids, [emit.row(b"".join([ids_of[w] for w in words]), b" ".join([s for w in words if (s := said_of[w])]))
                                            for words in split]))
        return pa.concat_tables(out) if out else emit.table(pa.array([], pa.int64()), [])
    return run


class Tokens:
    """Output columns ids (array of int) and decoded (string)."""

    fields = "ids array<int>, decoded string"

    @staticmethod
    def row(ids: bytes, decoded: bytes):
        return np.frombuffer(ids, np.int32), decoded.decode("utf-8", "replace")

    @staticmethod
    def table(doc_ids, rows) -> pa.Table:
        return pa.table({"doc_id": doc_ids, "ids": pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                         "decoded": pa.array([r[1] for r in rows], pa.string())})


class Digests:
    """Output columns n_tokens, ids_sha256 (of little-endian unsigned 32-bit
    ids) and decoded_sha256 (of UTF-8)."""

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @staticmethod
    def row(ids: bytes, decoded: bytes):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    @staticmethod
    def table(doc_ids, rows) -> pa.Table:
        n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"doc_id": doc_ids, "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids, pa.string()),
                         "decoded_sha256": pa.array(decoded, pa.string())})


def encode_documents(docs: DataFrame, emit=Tokens, path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id and the columns of ``emit`` for every row of ``docs``.

    A null or empty text has no ids and decodes to the empty string.  Repeated
    rows give repeated results, an empty table an empty result, and further
    columns are ignored.  A block holds one text at least, so a very long text
    is a block of its own.
    """
    path = path or default_path()
    rows = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = rows.mapInArrow(_word_lists(buckets, block_bytes), _LISTS)
    steps = lists.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(_encode_lists(path), _STEPS)
    answers = with_pieces(steps, path).mapInArrow(_add_pieces, _IDS)
    texts = rows.mapInArrow(_texts(block_bytes), _TEXTS)
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _join_back(emit, buckets), f"doc_id {kind}, {emit.fields}")


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, piece): one row for each entry of the vocabulary file."""
    pieces = encoder(path or default_path()).pieces()
    return spark.createDataFrame([(i, p.decode()) for i, p in enumerate(pieces)], "id int, piece string")


def with_pieces(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` and the piece of their ``id``, null for unknown and null ids:
    the id-to-piece join.  The table is as large as the vocabulary, whatever
    the data, and broadcast, so that rows stay in their place and order."""
    return rows.join(F.broadcast(piece_table(rows.sparkSession, path)), "id", "left")


def decode_ids(rows: DataFrame, key: str, ids: str, path: str | None = None) -> DataFrame:
    """(key, decoded) of an array column of ids, through a join with the
    id-to-piece table; ``key`` identifies a row.  Null or empty arrays decode
    to the empty string and unknown ids to nothing."""
    said = with_pieces(rows.select(key, F.posexplode_outer(ids).alias("_pos", "id")), path)
    return said.groupBy(key).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("_pos", "piece")))), lambda p: p["piece"]), " ").alias("decoded"))


def op1_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), Digests)
