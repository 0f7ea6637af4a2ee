"""Exact, near and substring deduplication against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from llm_helpers import HARD, SF0001, hard, none, rows  # noqa: F401
from pyspark.sql import functions as F

from order_mart.llm import exact_dedup, ngram_join, rindex_dedup
from order_mart.llm.common import read_table
from order_mart.llm.components import connected_components

WORD = "[^\x20\x09-\x0D]+"


def order(found):
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


# ------------------------------------------------------------- exact
def brute_exact(docs):
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[re.sub("[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), first, hashlib.sha256(norm.encode()).hexdigest()))
            first = False
    return order(out)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda n: F.substring(F.md5(n.cast("binary")), 1, 1)])
def test_exact_hard_texts(hard, digest):
    """Also with a digest so weak that different texts collide."""
    got = exact_dedup.exact_dedup(hard, digest)
    assert got.columns == ["doc_id", "text", "lang", "sequence_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(HARD)


def test_exact_many_batches_and_replicas(spark, monkeypatch, none):
    monkeypatch.setattr(exact_dedup, "COPIES_PER_REPLICA", 3)
    docs = [(k, f"t {k % 7}" if k % 3 else "copy") for k in range(200)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), max_files=1)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(docs)
    assert exact_dedup.exact_dedup(none).count() == 0


# ------------------------------------------------------------- shingle sets
def brute_classes(docs, width=4, percent=85):
    sets = []
    for _, t in docs:
        w = re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for j, b in enumerate(sets):
        for k in range(j):
            both = len(sets[k] & b)
            if both and 100 * both >= percent * (len(sets[k]) + len(b) - both):
                up[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[find(k)] = min((v for v in (least.get(find(k)), i) if v is not None), default=None)
    return order((i, len(s), least[find(k)] if s else i) for k, ((i, _), s) in enumerate(zip(docs, sets, strict=True)))


def near_copies(n, seed=1):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 90))] for _ in range(12)]
    out = []
    for k in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "n" + str(rng.randint(0, 9))
        out.append((k, " ".join(w[: rng.randint(1, len(w))] if rng.random() < 0.3 else w)))
    return out


def test_blocks_keep_what_sizes_and_positions_allow():
    rng = np.random.default_rng(11)
    for percent in (50, 80, 85):
        sizes = rng.integers(1, 60, 200)
        place = np.sort((sizes << 24) + (rng.random(200) * sizes).astype(np.int64))
        size, position = place >> 24, place & ((1 << 24) - 1)
        blocks = ngram_join._Blocks(place, percent)
        for i in range(200):
            least = ngram_join.need(size[i], size, percent)
            want = [j for j in range(i + 1, 200) if min(size[i] - position[i], size[j] - position[j]) >= least[j]]
            assert blocks.after(i).tolist() == want


def test_maps_never_show_more_than_the_difference():
    rng = np.random.default_rng(12)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[:n], rng.integers(0, 1 << 63, m, dtype=np.uint64))))
            for n, m in ((3, 1), (400, 30), (500, 9), (600, 0), (1000, 100), (2900, 300), (3000, 9000))]
    sets.sort(key=len)
    made = [ngram_join.parity(x, ngram_join.map_bits(len(x))) for x in sets]
    maps = ngram_join._Maps(np.frombuffer(b"".join(made), np.uint8), np.concatenate(([0], np.cumsum([len(m) for m in made]))))
    for i in range(len(sets)):
        later = np.arange(i + 1, len(sets))
        for j, apart in zip(later.tolist(), maps.apart(i, later).tolist(), strict=True):
            assert apart <= len(np.setxor1d(sets[i], sets[j]))
            folded = ngram_join.parity(sets[j], ngram_join.map_bits(len(sets[i])))
            assert apart == int(np.bitwise_count(np.frombuffer(folded, np.uint8) ^ np.frombuffer(made[i], np.uint8)).sum())


@pytest.mark.parametrize("small", [256, 5])
@pytest.mark.parametrize("cuts", [[7], [1, 2, 3, 4], [3, 5], list(range(10, 300, 10))])
def test_entries_without_a_partner_go(monkeypatch, cuts, small):
    import pyarrow as pa
    monkeypatch.setattr(ngram_join, "SMALL_LIST", small)
    rng = np.random.default_rng(13)
    token = np.sort(np.concatenate((rng.integers(0, 100, 270), np.full(30, 50))))
    size = rng.integers(1, 40, 300)
    place = (size << 24) + (rng.random(300) * size).astype(np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.arange(300)), pa.array(place)], names=["token", "sid", "place"])
    parts = [batch.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, 300], strict=True)]
    got = [x for b in ngram_join._shared_task(85)(iter([batch.slice(0, 0), *parts])) for x in b.column(1).to_pylist()]
    rest = size - (place & ((1 << 24) - 1))
    meets = lambda i, j: token[i] == token[j] and i != j and min(rest[i], rest[j]) >= ngram_join.need(size[i], size[j], 85)
    want = [i for i in range(300) if (token == token[i]).sum() > small or any(meets(i, j) for j in range(300))]
    assert got == want


@pytest.mark.parametrize("cluster", [ngram_join.CLUSTER_SETS, 2])
def test_join_of_near_copies(spark, monkeypatch, cluster):
    """Also with clusters that count as too large for one task."""
    monkeypatch.setattr(ngram_join, "CLUSTER_SETS", cluster)
    docs = near_copies(400)
    got = ngram_join.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(got) == brute_classes(docs)


def test_join_hard_texts(hard, none):
    assert rows(ngram_join.jaccard_classes(hard)) == brute_classes(HARD)
    assert ngram_join.jaccard_classes(none).count() == 0


def test_lists_are_cut_between_tokens(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 5)
    monkeypatch.setattr(ngram_join, "LIST_STEP", 3)
    docs = near_copies(150, seed=3)
    got = ngram_join.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), width=5, percent=80)
    assert rows(got) == brute_classes(docs, 5, 80)


def test_links_within_a_cluster():
    rng = np.random.default_rng(2)
    for _ in range(40):
        base = [rng.integers(0, 1 << 63, rng.integers(5, 80)).astype(np.uint64) for _ in range(3)]
        sets = []
        for _ in range(25):
            own = base[rng.integers(3)]
            own = own[rng.random(len(own)) > 0.08 * rng.random()]
            sets.append(np.unique(np.concatenate((own, rng.integers(0, 1 << 63, rng.integers(0, 4)).astype(np.uint64)))))

        def closed(links):
            up = list(range(len(sets)))
            for a, b in links:
                up = [up[a] if u == up[b] else u for u in up]
            return {frozenset(k for k, v in enumerate(up) if v == u) for u in up}

        every = [(a, b) for b in range(len(sets)) for a in range(b)
                 if len(np.intersect1d(sets[a], sets[b])) >= ngram_join.need(len(sets[a]), len(sets[b]), 85)]
        assert closed(ngram_join.cluster_links(sets, 85)) == closed(every)


def test_linked_sets_share_a_prefix_shingle():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5000, 1 << ngram_join.COUNT_BITS)
    for _ in range(300):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 60)).astype(np.uint64))
        drop = rng.random(len(x)) < 0.08
        y = np.unique(np.concatenate((x[~drop], rng.integers(0, 1 << 63, rng.integers(0, 4)).astype(np.uint64))))
        both = len(np.intersect1d(x, y))
        if both and both >= ngram_join.need(len(x), len(y), 85):
            assert len(np.intersect1d(ngram_join.prefix(x, counts, 85), ngram_join.prefix(y, counts, 85)))


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 200), (200, 100), (7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(got) == order([(k, 0) for k in range(61)] + [(100, 100), (200, 100)])


# ------------------------------------------------------------- substrings
def brute_repeats(texts, width):
    seen = collections.Counter(t[k:k + width] for t in texts for k in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - width + 1):
            if seen[t[k:k + width]] > 1:
                gone[k:k + width] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_index_streams_the_longest_matches():
    rng = random.Random(3)
    for _ in range(150):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(1, 7))]
        offsets = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
        index = rindex_dedup.RunIndex.build(np.frombuffer(b"".join(strings), np.uint8), offsets)
        rest = [s[k:] for s in strings for k in range(len(s))]

        def common(a, b):
            return next((k for k, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))

        assert index.matches().tolist() == [max([common(a, b) for m, b in enumerate(rest) if m != n] or [0]) for n, a in enumerate(rest)]
        assert index.lengths.sum() == offsets[-1]


@pytest.mark.parametrize("crowded", [rindex_dedup.CROWDED_BYTES, 50])
def test_repeats_hard_texts(hard, crowded):
    """Also with anchors that are decided window by window."""
    got = rindex_dedup.remove_repeats(hard, crowded=crowded)
    want = [(i, *r) for (i, _), r in zip(HARD, brute_repeats([(t or "").encode() for _, t in HARD], 200), strict=True)]
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == order(want)


def test_repeats_in_segments(spark, monkeypatch, none):
    monkeypatch.setattr(rindex_dedup, "SEGMENT", 500)
    monkeypatch.setattr(rindex_dedup, "SHARD_BYTES", 2000)
    rng = random.Random(9)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(150, 900))) for _ in range(8)]
    docs = [(k, "".join(rng.choice(passages)[rng.randint(0, 100):] + str(rng.random()) for _ in range(rng.randint(1, 5)))) for k in range(80)]
    got = rindex_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    want = [(i, *r) for (i, _), r in zip(docs, brute_repeats([t.encode() for _, t in docs], 200), strict=True)]
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == order(want)
    assert rindex_dedup.remove_repeats(none).count() == 0


def test_repeats_query(spark):
    docs = read_table(spark, SF0001, "documents").select("doc_id", "text").collect()
    want = [(r.doc_id, *x) for r, x in zip(docs, brute_repeats([(r.text or "").encode() for r in docs], 200), strict=True)]
    assert rows(rindex_dedup.op3_rindex_dedup(spark, SF0001)) == order(want)
