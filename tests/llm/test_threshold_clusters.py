"""op12 against SQL, all-distances numpy and small cases."""

import hashlib

import numpy as np
import pytest

from oracle_compare import compare, duckdb_connection
from order_mart.llm import threshold_clustering as tc
from llm_helpers import SF0001, rows

KIND = "vec_id long, embedding array<float>, cluster string, v int"


def test_equals_sql(spark):
    res = compare(tc.op12_threshold_clusters(spark, SF0001), duckdb_connection(SF0001), tc.OP12_SQL)
    assert res["columns_match"] and res["values_match"], res


def _all(x, c):
    far = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    return far.argmin(axis=1), far.min(axis=1)


@pytest.mark.parametrize("seed", range(6))
def test_walk_finds_the_nearest(seed):
    rng = np.random.default_rng(seed)
    k, d, spread = int(rng.integers(1, 40)), int(rng.integers(1, 20)), int(rng.choice([2, 30, 5000]))
    c = rng.integers(-spread, spread, (k, d))
    x = np.concatenate((rng.integers(-spread, spread, (300, d)), c))          # small spreads: many ties
    who, far, asked = tc.nearest(x, c)
    assert (who == _all(x, c)[0]).all() and (far == _all(x, c)[1]).all() and (asked <= k).all()


def test_walk_stops_early():
    rng = np.random.default_rng(1)
    c = np.sort(rng.integers(-10**6, 10**6, 500))[:, None] + rng.integers(-5, 5, (500, 3))
    x = c[rng.integers(0, 500, 200)] + rng.integers(-3, 3, (200, 3))
    who, far, asked = tc.nearest(x, c)
    assert (far == _all(x, c)[1]).all() and asked.mean() < 20


def test_rounds_by_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 64)).round(2)
    data = [(i, v.tolist(), "x", 1) for i, v in enumerate(x)] + [(3, x[3].tolist(), "x", 1), (None, x[5].tolist(), "x", 1)]
    bad = [(900, None, "x", 1), (901, [1.0] * 63, "x", 1), (902, [1.0] * 65, "x", 1), (903, [None] + [1.0] * 63, "x", 1),
           (904, [float("nan")] + [1.0] * 63, "x", 1), (905, [float("inf")] + [1.0] * 63, "x", 1), (906, [], "x", 1)]
    got = tc.cluster_vectors(spark.createDataFrame(data + bad, KIND).repartition(5))
    ids = [r[0] for r in data]
    v = np.floor(1024 * np.array([r[1] for r in data], np.float32).astype(float)).astype(np.int64)
    order = sorted(range(len(v)), key=lambda i: (hashlib.sha256(f"3:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), v[i].tolist()))
    c = v[order[:8]].copy()
    for _ in range(10):
        who = _all(v, c)[0]
        for j in set(who.tolist()):
            c[j] = v[who == j].sum(axis=0) // (who == j).sum()
    who, far = _all(v, c)
    sha = [hashlib.sha256(",".join(map(str, r.tolist())).encode()).hexdigest() for r in c]
    want = [(i, int(w), int(f), int(far[who == w].sum()), int(far.sum()), sha[w]) for i, w, f in zip(ids, who, far, strict=True)]
    assert rows(got) == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_few_and_no_vectors(spark):
    one = [(1, [0.5] * 64, "x", 1)] * 3
    got = tc.cluster_vectors(spark.createDataFrame(one, KIND)).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)} and len(got) == 3
    assert tc.cluster_vectors(spark.createDataFrame([], KIND)).collect() == []
    assert tc.cluster_vectors(spark.createDataFrame([(1, [1.0], "x", 1)], KIND)).collect() == []


def test_components_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        tc.cluster_vectors(spark.createDataFrame([(1, [2e5] * 64, "x", 1)], KIND)).collect()
