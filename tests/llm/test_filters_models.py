"""Quality rules, URL filter, chat formatting, language and toxicity models."""

import collections
import re

import duckdb
import numpy as np
import pytest
from llm_helpers import HARD, SF0001, hard, none, rows  # noqa: F401
from pyspark.sql import functions as F

from order_mart.llm import chat_format, langid_ecoc, quality_bands, toxicity_nbsvm, url_filter
from order_mart.llm.common import in_remainder, read_table
from order_mart.llm.queries import ORACLES, QUERIES


def view(con, name):
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF0001}/{name}.parquet')")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages", "labels", "embeddings"):
        view(con, table)
    found = con.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    got = QUERIES[name](spark, SF0001)
    assert sorted(got.columns) == sorted(columns)
    assert collections.Counter(map(tuple, got.select(*columns).collect())) == collections.Counter(found.fetchall())


# ------------------------------------------------------------- quality
def brute_base(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times, cover, seen, dup = collections.Counter(grams), set(), set(), 0
    for k, g in enumerate(grams):
        if times[g] > 1:
            cover |= {k, k + 1, k + 2}
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute_verdict(text, bands=quality_bands.Bands()):
    import zstandard

    pack = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
    raw, base = (text or "").encode(), brute_base(text)
    failed = base[0] < bands.min_words or 100 * base[4] > bands.max_repeat_percent * base[0]
    if failed:
        return True, False
    limits = [(lo, hi) for least, lo, hi in bands.whole if len(raw) >= least][-1]
    chunks = [raw[k:k + bands.chunk_bytes] for k in range(0, len(raw) - bands.chunk_bytes + 1, bands.chunk_bytes)]
    bad = sum(not bands.chunk[0] <= len(c) / len(pack.compress(c)) <= bands.chunk[1] for c in chunks)
    return False, limits[0] <= len(raw) / len(pack.compress(raw)) <= limits[1] and bad <= bands.max_bad_chunks * len(chunks)


def test_quality_hard_texts(hard, none):
    got = quality_bands.quality_bands(hard)
    assert "lang" in got.columns and got.columns.count("kept") == 1
    assert rows(got, "doc_id", *BASE, "base_failed", "kept") == sorted(
        [(i, *brute_base(t), *brute_verdict(t)) for i, t in HARD], key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert quality_bands.quality_bands(none).count() == 0


def test_quality_query(spark):
    want = {(r.doc_id, *brute_base(r.text), *brute_verdict(r.text)) for r in read_table(spark, SF0001, "documents").collect()}
    got = QUERIES["op8_quality_bands"](spark, SF0001).select("doc_id", *BASE, "base_failed", "kept").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_bands_reject_noise_and_repetition(spark):
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)).decode() for _ in range(400)]
    prose = " ".join(rng.choice(words, 900))
    noise = " ".join(bytes(rng.integers(33, 127, 40).astype(np.uint8)).decode() for _ in range(200))
    line = " ".join(rng.choice(words, 60))
    repeated = "\n".join(f"{k} {line}" for k in range(60))
    got = quality_bands.quality_bands(spark.createDataFrame([(1, prose), (2, noise), (3, repeated)], "doc_id long, text string"))
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert kept == {1: True, 2: False, 3: False}


def test_noise_in_short_texts_and_tails(spark):
    """Whole ratios in their band, full chunks clean or absent, and noise in the rest."""
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)).decode() for _ in range(400)]
    prose = " ".join(rng.choice(words, 4000))
    noise = bytes(rng.integers(33, 127, 4000).astype(np.uint8)).decode()
    clean = [prose[:n] for n in (255, 256, 400, 700, 1023, 1024, 2500, 4095, 4096, 4100, 6000, 8191, 9000)]
    part = [prose[:n] + noise[:k] for n, k in ((4096, 2500), (4096, 3200), (4096, 4000), (8192, 4000), (1500, 1500), (1000, 600), (400, 300))]
    got = quality_bands.quality_bands(spark.createDataFrame(list(enumerate(clean + part)), "doc_id long, text string")).collect()
    verdicts = {r.doc_id: (r.base_failed, r.kept, r.bad_chunks > 0.25) for r in got}
    short = [k for k, c in enumerate(clean) if len(c.split()) < 50]
    assert all(verdicts[k] == (k in short, k not in short, False) for k in range(len(clean)))
    assert all(verdicts[len(clean) + k] == (False, False, True) for k in range(len(part)))


@pytest.mark.parametrize("size", [4096, 1024, 600, 256])
def test_chunks_judge_every_byte_once(size):
    bands = quality_bands.Bands(chunk_bytes=size)
    for length in [*range(0, 1400, 7), 255, 256, 1023, 1024, 4095, 4096, 4097, 8191, 9000]:
        chunks = list(quality_bands._chunks(length, bands))
        assert sum(judged for _, _, judged, _, _ in chunks) == (length if length >= min(256, size) else 0)
        assert not chunks or (chunks[0][0] == 0 and chunks[-1][0] + chunks[-1][1] == length)


# ------------------------------------------------------------- URLs
URLS = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://A.Example.ORG/en/12?x=1"), (5, "http://org"), (6, "http://x.com/fr/a#b"),
        (6, "http://x.com/fr/a#b"), (7, "http://x.com/FR/"), (8, "ftp://y.com/de/?a=/"), (None, "http://myexample.org/es/"), (9, "a://É.ORG/"), (10, "x://a://b.com/de/")]


def test_rules_and_parts(spark):
    frame = spark.createDataFrame([(i, u, "h", "p") for i, u in URLS], "page_id long, url string, host string, verdict string")
    got = {r.page_id: r for r in url_filter.filter_urls(frame).collect()}
    said = {i: (got[i].host, got[i].path, got[i].rule) for i in got}
    assert said == {1: ("", "", None), 2: ("", "", None), 3: ("", "", None), 4: ("a.example.org", "/en/12", "example.org/en/1"), 5: ("org", "", None),
                    6: ("x.com", "/fr/a", "com/fr/"), 7: ("x.com", "/FR/", None), 8: ("y.com", "/de/", "com/de/"), None: ("myexample.org", "/es/", "org/"),
                    9: ("É.org", "/", "org/"), 10: ("a:", "//b.com/de/", None)}
    assert got[4].verdict == "block" and got[6].verdict == "allow" and got[8].verdict == "block"
    assert {r.verdict for r in got.values()} <= {"allow", "block"}
    assert url_filter.filter_urls(frame).count() == len(URLS) and url_filter.filter_urls(frame.limit(0)).count() == 0


def test_trees_learn_from_labels(spark):
    rng = np.random.default_rng(5)
    bad = [f"http://cheap-{k}-pills.example.biz/{rng.integers(10**9)}?ref={k}&id={k}" for k in range(120)]
    good = [f"https://www.site.example.net/en/page-{'abc'[k % 3]}" for k in range(120)]
    labelled = spark.createDataFrame([(u, 1) for u in bad[:80]] + [(u, 0) for u in good[:80]], "url string, block int")
    pages = spark.createDataFrame(list(enumerate(bad[80:] + good[80:])), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules=(), labelled=labelled).collect()}
    assert sum(got[k] == ("block" if k < 40 else "allow") for k in got) >= 78


def test_copies_of_a_hot_url_do_not_fill_the_sample(spark):
    rng = np.random.default_rng(7)
    bad = [f"http://cheap-{k}-pills.example.biz/{rng.integers(10**9)}?ref={k}&id={k}" for k in range(120)]
    good = [f"https://www.site.example.net/en/{bytes(rng.integers(97, 123, 8).astype(np.uint8)).decode()}" for k in range(120)]
    learned = spark.createDataFrame([(u, 1) for u in bad[:80]] + [(u, 0) for u in good[:80]], "url string, block int")
    first = learned.filter("block = 1").orderBy(F.xxhash64("url")).first().url
    hot = spark.range(400).select(F.lit(first).alias("url"), F.lit(1).alias("block"))
    settings = url_filter.Settings(sample=50)
    known = learned.unionByName(hot).withColumnRenamed("block", "_block")
    picked = url_filter._sample(known, settings.sample).collect()
    assert len({(r.url, r._block) for r in picked}) == len(picked) == 100 and {r._weight for r in picked} == {80 / 50}
    pages = spark.createDataFrame(list(enumerate(bad[80:] + good[80:])), "page_id long, url string")
    got = url_filter.filter_urls(pages, rules=(), labelled=learned.unionByName(hot), settings=settings).collect()
    assert sum(r.verdict == ("block" if r.page_id < 40 else "allow") for r in got) >= 78


def test_rare_domains_have_their_own_rate(spark):
    """1,200 domains: the 200 least frequent are told apart by their rate alone."""
    rng = np.random.default_rng(6)
    names = sorted({bytes(rng.integers(97, 123, 12).astype(np.uint8)).decode() for _ in range(1200)})

    def url(name):
        return f"http://{name}.biz/{bytes(rng.integers(97, 123, 8).astype(np.uint8)).decode()}"

    labelled = spark.createDataFrame([(url(n), i % 2) for i, n in enumerate(names) for _ in range(3 if i < 1000 else 2)], "url string, block int")
    pages = spark.createDataFrame([(i, url(n)) for i, n in enumerate(names) if i >= 1000], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules=(), labelled=labelled).collect()}
    assert len(got) == len(names) - 1000 and sum(got[i] == ("block" if i % 2 else "allow") for i in got) >= 0.95 * len(got)


def test_rates_to_learn_from_leave_the_own_fold_out(spark):
    """A domain's rate leaves out every label of the row's fold, copies too."""
    rows = [(f"http://a.biz/{k}", k % 3 == 0) for k in range(40)] + [("http://b.biz/x", True)] * 9 + [("http://c.net/1", False)]
    known = spark.createDataFrame([(u, int(y)) for u, y in rows], "url string, _block int").selectExpr(
        "url", "regexp_extract(url, '//([^/]*)', 1) AS host", "_block").withColumn("_fold", url_filter._fold(F.col("url")))
    settings = url_filter.Settings()
    overall, rates, others = url_filter._rates(known, settings)
    labels = [(r.host, r._fold, r._block) for r in known.collect()]
    base = sum(y for *_, y in labels) / len(labels)

    def smoothed(own):
        return (sum(own) + settings.prior * base) / (len(own) + settings.prior) if own else base

    want = {(h, f): (smoothed([y for g, e, y in labels if g[-3:] == h[-3:] and e != f]), smoothed([y for g, e, y in labels if g == h and e != f]))
            for h, f, _ in labels}
    got = {(r.domain, r._fold): (r.suffix_rate, r.domain_rate) for r in others.collect()}
    assert overall == base and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert {r.domain: r.domain_rate for r in rates.collect()}["b.biz"] == pytest.approx(smoothed([1] * 9))
    assert [got[k][1] for k in got if k[0] == "b.biz"] == [base]


# ------------------------------------------------------------- chats
def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "a\\l<b\\\\[x\\n\n"), (1, 1, "assi<stant\n\\", None), (2, None, None, "x"), (2, 0, "assistant", "</s><|im_end|>\n<|im_start|>user\n"),
             (None, 1, "assistant", "\\"), (3, 0, "system", "s"), (3, 1, "user", "é😀"), (3, 2, "assistant", "q" * 50000), (4, 0, "user", "u"), (4, 0, "user", "u")]
    frame = spark.createDataFrame([(*t, "z") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    made = chat_format.format_chats(frame)
    got = {r.conv_id: r for r in chat_format.parse(made).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in got[conv].turns] == [(t[2] or "", t[3] or "") for t in own]
        assert got[conv].loss_text == "".join(t[3] or "" for t in own if t[2] == "assistant")
        assert got[conv].formatted == "".join(s.text for s in got[conv].segments)
    assert {c: got[c].valid for c in got} == {1: False, 2: False, None: False, 3: True, 4: False}
    inner = [s.text for s in got[2].segments if s.kind == "text"]
    assert not any(c in t for t in inner for c in chat_format.Template().control + ("<|im_end|>", "<|im_start|>"))
    assert chat_format.format_chats(frame.limit(0)).count() == 0


def test_template_needs_an_opener():
    with pytest.raises(ValueError):
        chat_format.Template(begin="### ")


# ------------------------------------------------------------- models
@pytest.mark.parametrize("n", [2, 3, 5, 9, 30])
def test_codewords_differ(n):
    code = langid_ecoc.codewords(n)
    apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
    assert min(apart) >= (1 if n < 4 else 3) and (np.abs(code.sum(axis=0)) < n).all()


def test_decoding_corrects_one_wrong_bit():
    code = langid_ecoc.codewords(5)
    model = {"code": code, "trust": np.ones_like(code) / code.shape[1]}
    for k in range(5):
        for bit in range(code.shape[1]):
            margin = 3 * code[k].copy()
            margin[bit] *= -1
            assert langid_ecoc.decode(margin[None, :], model).argmax() == k


def test_language_of_held_out_texts(spark):
    docs = read_table(spark, SF0001, "documents")
    got = QUERIES["op2_langid_ecoc"](spark, SF0001).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_language_hard_texts(spark, hard, none):
    learned = hard.withColumn("lang", F.when(F.col("doc_id") == 5, "de").when(F.col("doc_id") == 7, "en"))
    held = in_remainder("doc_id", 4, 2)
    model = langid_ecoc.train(learned)
    got = langid_ecoc.identify_languages(hard, model, held).collect()
    assert len(got) == len(HARD)
    assert {r.lang_pred for r in got} == {"und", "en", "de"}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 4}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    empty = langid_ecoc.train(none)
    assert {r.lang_pred for r in langid_ecoc.identify_languages(hard, empty, held).collect()} == {"und"}
    assert langid_ecoc.identify_languages(none, model, held).count() == 0


def toxic_texts(n):
    rng = np.random.default_rng(8)
    plain = [bytes(rng.integers(97, 123, rng.integers(2, 8)).astype(np.uint8)).decode() for _ in range(300)]
    out = []
    for k in range(n):
        words = list(rng.choice(plain, rng.integers(5, 200)))
        if k % 4 == 0:
            for _ in range(2):
                words[rng.integers(len(words))] = str(rng.choice(["vilezzor", "grubbnak", "moxxith"]))
        out.append((k, " ".join(words), int(k % 4 == 0)))
    return out


def test_toxicity_of_held_out_texts(spark):
    marked = toxic_texts(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in marked], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in marked], "doc_id long, toxic int")
    held = in_remainder("doc_id", 5, 0)
    got = {r.doc_id: r for r in toxicity_nbsvm.score_toxicity(docs, toxicity_nbsvm.train(docs, labels.filter(~held)), held).collect()}
    own = [(got[i].predicted, y) for i, _, y in marked if got[i].held_out]
    assert len(own) > 80 and np.mean([p == y for p, y in own]) >= 0.97


def test_toxicity_hard_texts(spark, hard, none):
    labels = spark.createDataFrame([(1, 1), (3, 1), (7, 0), (7, 1), (8, 0), (None, 1), (9, None), (99, 1)], "doc_id long, toxic int")
    held = in_remainder("doc_id", 5, 0)
    for marks in (labels, labels.limit(0), labels.filter("toxic = 1")):
        got = toxicity_nbsvm.score_toxicity(hard, toxicity_nbsvm.train(hard, marks), held)
        assert got.count() == len(HARD)
        assert got.filter("score IS NULL OR score < 0 OR score > 1 OR (score >= 0.5) <> (predicted = 1)").count() == 0
    assert toxicity_nbsvm.score_toxicity(none, toxicity_nbsvm.train(none, labels), held).count() == 0


def test_remainders_are_crc32(spark):
    import zlib

    got = spark.range(50).select("id", in_remainder("id", 4, 2).alias("is")).collect()
    assert all(r["is"] == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_samples_are_bounds_whatever_ids_and_copies(spark):
    from order_mart.llm.common import at_most

    texts = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 400).alias("text"),
                                     F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 7)).alias("lang"))
    picked = at_most(texts, "lang", 50).groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("text").alias("d")).collect()
    assert {r.lang: (r.n, r.d) for r in picked} == {lang: (50, 50) for lang in ("hot", *(f"l{k}" for k in range(7)))}
    model = langid_ecoc.train(texts, langid_ecoc.Settings(sample=20, languages=3, steps=2))
    assert len(model["names"]) == 3 and "hot" in model["names"]
    labels = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    docs = texts.withColumn("doc_id", F.lit(1).cast("long"))
    assert toxicity_nbsvm.train(docs, labels, toxicity_nbsvm.Settings(sample=30))["weights"].shape


URL_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
r AS (SELECT page_id, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM p),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rule, domain, start, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM s JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start) GROUP BY page_id)
SELECT page_id, host, path, rule, f.verdict FROM s LEFT JOIN f USING (page_id)
"""


def test_url_rules_equal_sql(spark):
    con = duckdb.connect()
    view(con, "pages")
    want = {r[0]: r[1:] for r in con.execute(URL_SQL).fetchall()}
    got = QUERIES["op9_url_filter"](spark, SF0001).collect()
    assert len(got) == len(want)
    for r in got:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ((verdict,) if rule else ("allow", "block"))


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, k, [ws[k], ws[k + 1], ws[k + 2]] AS g FROM w, range(1, len(ws) - 1) AS x(k)),
t AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT k + j) AS n FROM t, range(0, 3) AS y(j) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
m AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id)
SELECT doc_id, len(ws), length(array_to_string(ws, '')), length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')), coalesce(m.n, 0), coalesce(c.n, 0),
       len(ws) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(ws)
FROM w LEFT JOIN m USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def test_quality_base_columns_equal_sql(spark):
    con = duckdb.connect()
    view(con, "documents")
    want = con.execute(QUALITY_SQL).fetchall()
    got = QUERIES["op8_quality_bands"](spark, SF0001).select("doc_id", *BASE, "base_failed").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
