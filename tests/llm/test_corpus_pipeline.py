"""The corpus pipeline, stage by stage, against brute force."""

import corpus_pipeline
from llm_helpers import SF0001, hard, none  # noqa: F401
from test_dedup import brute_classes, brute_exact, brute_repeats
from test_filters_models import brute_verdict
from test_tokens_packing import check_sequences, ids_of


def stages(spark, docs, sf_dir):
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stage(function(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check(frames):
    raw, good, single, apart, cut, packed = frames
    for frame in frames[1:-1]:
        assert frame.columns == corpus_pipeline.COLUMNS
    assert sorted(texts(good), key=str) == sorted(((i, t) for i, t in texts(raw) if brute_verdict(t)[1]), key=str)
    stays = {r[0] for r in brute_exact(texts(good)) if r[3]}
    assert {i for i, _ in texts(single)} == stays and single.count() == sum(r[3] for r in brute_exact(texts(good)))
    stays = {i for i, _, least in brute_classes(texts(single), 5, 80) if i == least}
    assert {i for i, _ in texts(apart)} == stays
    want = {i: n - gone for (i, _), (n, gone, _, _) in zip(texts(apart), brute_repeats([(t or "").encode() for _, t in texts(apart)], 200), strict=True)}
    got = texts(cut)
    assert set(want) == {i for i, _ in got} and all(want[i] - 8 <= len(t.encode()) <= want[i] for i, t in got)
    pieces = packed.collect()
    check_sequences(pieces, 4096)
    assert sum(r.length for r in pieces) == sum(len(ids_of(t)) + 1 for _, t in got)


def test_stages(spark):
    check(stages(spark, corpus_pipeline.read_table(spark, SF0001, "documents"), SF0001))


def test_stages_with_hard_rows(spark, none):
    words = " ".join(f"w{k % 70}{k * 7919 % 101}" for k in range(120))
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 2), (3, words, "en", None, 5, 3), (3, words, "en", None, 5, 3),
            (4, words + " more", None, "s", 5, 4), (None, words + " x y", "en", "s", 5, 5), (5, words.replace("w1", "v1 é"), "en", "s", 1, 6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row long"
    frames = stages(spark, spark.createDataFrame(rows, schema), SF0001)
    assert [r.doc_id for r in frames[2].orderBy("doc_id").collect()] == [None, 3, 4, 5]
    assert frames[-1].count() >= 1
    empty = stages(spark, spark.createDataFrame([], schema), SF0001)
    assert [f.count() for f in empty] == [0] * 6
