"""Encoding, decoding and packing against the tokenizers library."""

import hashlib
import random
import zlib
from array import array

import numpy as np
import pytest
from llm_helpers import HARD, SF0001, hard, none, rows  # noqa: F401

from order_mart.llm import packing
from order_mart.llm.bpe_words import decode_ids, encode_documents, op1_bpe_words
from order_mart.llm.common import read_table
from order_mart.llm.packing import best_fit_decreasing, lower_bound, op7_best_fit_packing, pack, pack_documents
from order_mart.llm.tokens import encoder


def ids_of(text):
    return encoder().full.encode(text or "", add_special_tokens=False).ids


def test_words_are_encoded_like_whole_texts():
    rng = random.Random(2)
    letters = "aZßÉéÿŸ'’sStT0123½²ª<|endoftext|>!$%._~×÷İıḰ  漢😀\x00\x1c\x85ë \n"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert b"".join(encoder().encode(text.encode().split())) == array("I", ids_of(text)).tobytes(), text


def test_query_is_the_library(spark):
    want = set()
    for r in read_table(spark, SF0001, "documents").select("doc_id", "text").collect():
        ids = ids_of(r.text)
        said = encoder().full.decode(ids, skip_special_tokens=False)
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    assert {tuple(r) for r in op1_bpe_words(spark, SF0001).collect()} == want


def test_hard_texts_and_round_trip(spark, hard, none):
    got = encode_documents(hard, block_bytes=1000)
    assert rows(got.selectExpr("doc_id", "ids")) == sorted(
        [(i, ids_of(t)) for i, t in HARD], key=lambda r: tuple((v is not None, str(v)) for v in r))
    numbered = got.selectExpr("monotonically_increasing_id() AS k", "*").checkpoint()
    back = decode_ids(numbered, "k", "ids")
    assert numbered.join(back.withColumnRenamed("decoded", "said"), "k").filter("said <> decoded").count() == 0
    assert back.count() == len(HARD)
    assert encode_documents(none).count() == 0
    assert encode_documents(hard.filter("text IS NULL")).collect()[0].ids == []


def check_sequences(got, capacity):
    used = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values(), default=0) <= capacity
    return len(used)


def test_packing_query(spark):
    got = op7_best_fit_packing(spark, SF0001).collect()
    want = set()
    for r in read_table(spark, SF0001, "documents").select("doc_id", "text").collect():
        ids = ids_of(r.text) + [1]
        want |= {(r.doc_id, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes())) for k in range(0, len(ids), 4096)}
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    assert check_sequences(got, 4096) == lower_bound(np.array([r.length for r in got]), 4096)


def test_packing_hard_texts(hard, none):
    got = pack_documents(hard, capacity=64, partition_pieces=10).collect()
    assert sum(r.length for r in got) == sum(len(ids_of(t)) + 1 for _, t in HARD)
    check_sequences(got, 64)
    assert pack_documents(none).count() == 0


@pytest.mark.parametrize("low,high", [(1, 100), (34, 60), (30, 36), (51, 70)])
def test_bound_is_never_above_the_packing(low, high):
    rng = np.random.default_rng(low)
    for _ in range(50):
        lengths = rng.integers(low, high, rng.integers(1, 40))
        bins, offsets, fills = best_fit_decreasing(lengths, 100)
        assert lower_bound(lengths, 100) <= len(fills) and fills.max() <= 100 and fills.sum() == lengths.sum()


def test_bound_is_never_above_the_optimum():
    """Bins filled by construction: as many bins suffice."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 6))
        cuts = [np.diff(np.concatenate(([0], np.sort(rng.choice(np.arange(1, 100), rng.integers(0, 5), replace=False)), [100]))) for _ in range(n)]
        assert lower_bound(np.concatenate(cuts), 100) == n


def test_exchange_saves_sequences(spark):
    items = spark.createDataFrame([(k, 0, 0, 30) for k in range(40)], "doc_id long, piece int, ids_crc32 long, length long")
    apart = check_sequences(pack(items, 100, partition_pieces=2, rounds=0).collect(), 100)
    together = check_sequences(pack(items, 100, partition_pieces=2).collect(), 100)
    assert together < apart


def test_equal_rows_are_dealt_apart(spark):
    from pyspark.sql import functions as F

    rows = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(10).cast("long").alias("length"),
                                    F.lit(5).cast("long").alias("ids_crc32"), F.lit("x").alias("_part"), F.lit(1).alias("offset"))
    placed = packing.pack(rows, 4096, 500)
    assert placed.columns == ["doc_id", "piece", "length", "ids_crc32", "sequence_id", "offset"]
    assert placed.count() == 6000 and placed.select("sequence_id", "offset").distinct().count() == 6000
    numbered = rows.drop("_part", "offset").withColumn("_row", F.monotonically_increasing_id())
    made, _ = packing._round(numbered, 1, 4096, 500)
    sizes = [r["count"] for r in made.groupBy("_part").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1000


def test_pieces_of_many_words_are_learned_once(monkeypatch):
    """Words of one batch that share pieces send each piece to the model once,
    and no piece that is known; letters outside ASCII and words that need the
    whole tokenizer keep their places between plain ones."""
    from order_mart.llm.tokens import WordEncoder, default_path
    made, sent = WordEncoder(default_path()), []
    learn = made._learn
    monkeypatch.setattr(made, "_learn", lambda fresh: (sent.append(list(fresh)), learn(fresh))[1])
    words = ["Haus", "haus,", "HAUS.", "Ünö", "日本", "don't", "x1y2", "ünö"]
    assert made.encode([]) == [] and made.table(set()) == {}
    table = made.table({w.encode() for w in words})
    assert all(table[w.encode()] == array("I", ids_of(w)).tobytes() for w in words)
    made.encode([w.encode() for w in words])
    assert sorted(p for batch in sent for p in batch) == sorted({"haus", ",", ".", "ünö", "don", "'t", "x", "1", "y", "2"})
