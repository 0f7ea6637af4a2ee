"""op11 against a dictionary trie, DuckDB word counts and hard rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_compare import duckdb_connection
from order_mart.llm import ppm_scoring as ppm
from llm_helpers import HARD, SF0001, hard, none, rows  # noqa: F401

BASE_SQL = r"""
WITH d AS (SELECT doc_id, crc32 % 5 = 1 AS held_out, list_append(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), '') AS words
           FROM documents JOIN crcs USING (doc_id)),
t AS (SELECT doc_id, held_out, unnest(words) AS w FROM d),
c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
f AS (SELECT sum(c) AS n, count(*) AS v FROM c)
SELECT doc_id, any_value(held_out), count(*), count(c.c), any_value(f.n), sum(log10((coalesce(c.c, 0) + 0.5) / (f.n + 0.5 * (f.v + 1))))
FROM t LEFT JOIN c USING (w), f GROUP BY doc_id ORDER BY doc_id
"""


def _symbols(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"


def _trie(texts, order):
    trie = defaultdict(Counter)
    for text in texts:
        data = b" " * order + text
        for i in range(order, len(data)):
            for k in range(order + 1):
                trie[data[i - k: i]][data[i]] += 1
    return trie


def _cost(trie, context, symbol, order):
    """log10 probability, followers of every context in full."""
    gone, out = set(), 0.0
    for k in range(order, -1, -1):
        seen = trie.get(context[len(context) - k:])
        left = {s: n for s, n in (seen or {}).items() if s not in gone}
        if left:
            whole = sum(left.values()) + len(left)
            if symbol in left:
                return out + math.log10(left[symbol] / whole)
            out += math.log10(len(left) / whole)
            gone |= set(left)
    return out - math.log10(ppm.SYMBOLS - len(gone))


def _brute(docs, order=ppm.ORDER):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    texts = [_symbols(t) for _, t in docs]
    trie, known = _trie([t for t, h in zip(texts, held, strict=True) if not h], order), {}
    out = []
    for (doc_id, _), text, h in zip(docs, texts, held, strict=True):
        data, total = b" " * order + text, 0.0
        for i in range(order, len(data)):
            gram = data[i - order: i + 1]
            if gram not in known:
                known[gram] = _cost(trie, gram[:-1], gram[-1], order)
            total += known[gram]
        out.append((doc_id, h, total))
    return out


def _same_scores(got, want):
    key = lambda r: (r[0] is not None, str(r[0]), r[-1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[-1] for r in got], [r[-1] for r in want], rtol=1e-9, atol=1e-9)


@pytest.fixture(scope="module")
def scored(spark):
    return ppm.op11_ppm_scores(spark, SF0001).collect()


def test_scores_equal_a_plain_trie(spark, scored):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    _same_scores([(r.doc_id, r.held_out, r.score) for r in scored], _brute(docs))


def test_base_columns_equal_sql(scored):
    con = duckdb_connection(SF0001)
    import pandas as pd
    ids = [r[0] for r in con.execute("SELECT doc_id FROM documents").fetchall()]
    con.register("crcs", pd.DataFrame({"doc_id": ids, "crc32": [zlib.crc32(str(i).encode()) for i in ids]}))
    want = con.execute(BASE_SQL).fetchall()
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_longer_contexts_cost_less_on_held_out_texts(spark, scored):
    from order_mart.llm.common import in_remainder

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    held = {r.doc_id: r.score for r in scored if r.held_out and r.n_tokens > 20}
    short = {r.doc_id: r.score for r in ppm.score_documents(docs, in_remainder("doc_id", 5, 1), order=1).collect()}
    assert sum(held.values()) > 1.2 * sum(short[i] for i in held)
    turned = ppm.score_documents(docs.unionByName(docs.withColumn("doc_id", -1 - F.col("doc_id")).withColumn("text", F.reverse("text"))),
                                 (F.col("doc_id") < 0) | in_remainder("doc_id", 5, 1)).collect()
    cost = {r.doc_id: r.score for r in turned}
    assert np.mean([cost[i] > cost[-1 - i] for i in held]) > 0.95


@pytest.mark.parametrize("block_bytes,order", [(1, 4), (ppm.BLOCK_BYTES, 2), (50_000, 5)])
def test_hard_rows(hard, none, monkeypatch, block_bytes, order):
    from order_mart.llm.common import in_remainder

    monkeypatch.setattr(ppm, "SEGMENT", 1000)
    held = in_remainder("doc_id", 5, 1)
    got = [(r.doc_id, r.held_out, r.score) for r in ppm.score_documents(hard, held, order, block_bytes).collect()]
    _same_scores(got, _brute(HARD, order))
    assert ppm.score_documents(none, held).collect() == []


def test_no_training_rows(hard):
    got = ppm.score_documents(hard, F.lit(True)).collect()
    assert {r.train_tokens for r in got} == {0} and {r.n_known for r in got} == {0}
    empty = [r for r in got if r.doc_id == 2]
    assert math.isclose(empty[0].score, -math.log10(ppm.SYMBOLS)) and math.isclose(empty[0].base_score, 0.0, abs_tol=1e-12)


def test_prices_of_a_context_add_up_to_one():
    rng = np.random.default_rng(3)
    texts = [[bytes(rng.choice(list(b"abc\xc3\xa9"), int(rng.integers(1, 6))).tolist()) for _ in range(40)] for _ in range(5)]
    grams = ppm.grams_of(texts, 4)
    distinct, n = np.unique(grams, return_counts=True)
    pairs = np.zeros((256, 256), np.int64)
    np.add.at(pairs, ((grams >> 8) & 255, grams & 255), 1)
    symbols = np.array([s for s in range(256) if s not in b"\t\x0b\x0c\r"])
    for context in [*np.unique(distinct >> 8)[:30], int.from_bytes(b"zzab"), int.from_bytes(b"zzzz")]:
        got = ppm.prices((int(context) << 8) | symbols, distinct, n, pairs, 4)
        assert math.isclose((10.0 ** got).sum(), 1.0, rel_tol=1e-9)


def test_symbols_are_lowered_words_with_single_spaces():
    texts = [b"", b"  ", b"A  b\tC\n", b"\x0b\x0c x\r\n\r y \xc3\x89Z", b"\x1c\x00 \x85 end", b"one"]
    assert ppm.symbols_of(texts) == b"".join(b" ".join(t.lower().split()) + b"\n" for t in texts)
    words, places, n_tokens = ppm._words_of(ppm.symbols_of(texts))
    got = [words[i].as_py() for i in places.tolist()]
    assert got == [w for t in texts for w in [*t.lower().split(), b""]]
    assert n_tokens.tolist() == [len(t.split()) + 1 for t in texts]


@pytest.mark.parametrize("table", [0, 3000, 1 << 25])
@pytest.mark.parametrize("order", [1, 2, 4, 5])
def test_grams_equal_plain_windows(monkeypatch, table, order):
    monkeypatch.setattr(ppm, "TABLE", table)
    monkeypatch.setattr(ppm, "SEGMENT", 37)
    rng = np.random.default_rng(5)
    texts = [b"", *(bytes(rng.choice(list(b"ab \x00\xff"), int(n)).tolist()) for n in rng.integers(0, 90, 12))]
    want = []
    for words in (t.split() for t in texts):
        data = b" " * order + b" ".join(words) + b"\n"
        want += [int.from_bytes(data[i - order: i + 1]) for i in range(order, len(data))]
    assert ppm.grams_of([t.split() for t in texts], order).tolist() == want
    symbols = ppm.symbols_of(texts)
    train = np.repeat(np.arange(len(texts)) % 3 > 0, ppm._sizes(symbols))
    distinct, n = ppm._distinct(symbols, order, train)
    times = Counter(g for g, t in zip(want, train.tolist(), strict=True) if t)
    assert distinct.tolist() == sorted(set(want)) and n.tolist() == [times[g] for g in sorted(set(want))]


def test_listing_and_scoring_sort_distinct_grams_only(monkeypatch):
    """Sorting every symbol's gram, twice, took most of the CPU time."""
    import pyarrow as pa

    text = "the quick brown fox jumps over the lazy dog " * 500
    block = pa.record_batch({"doc_id": pa.array([1, 2]), "text": [text, text], "train": [True, False]})
    sizes = []
    for name in ("unique", "argsort", "sort"):
        monkeypatch.setattr(np, name, lambda a, *args, _plain=getattr(np, name), **kw: (sizes.append(len(a)), _plain(a, *args, **kw))[1])
    lists = pa.Table.from_batches(list(ppm._list_task(4, 8, ppm.BLOCK_BYTES)(iter([block])))).to_pylist()
    texts = pa.Table.from_batches(list(ppm._text_task(ppm.BLOCK_BYTES)(iter([block]))))
    tables = {(r["kind"], r["bucket"]): r["items"] for r in lists if r["kind"]}
    answers = pa.table({"kind": [k for k, _ in tables], "bucket": [b for _, b in tables],
                        "answer": [ppm._pack(np.zeros(len(ppm._from_deltas(v)) if k == ppm._GRAMS else len(ppm._unpack(v).split(b"\n")), np.int64).tobytes())
                                   for (k, _), v in tables.items()]})
    scored = ppm._score_task(4, 8)(texts, answers).to_pylist()
    assert [r["n_tokens"] for r in scored] == [4501, 4501]
    assert sizes and max(sizes) < 1000
