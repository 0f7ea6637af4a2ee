"""URL filter: an allow/block rule list, and gradient-boosted trees for the rest.

Rules name a host and a path prefix; the longest rule that fits a URL decides.
URLs that no rule fits are judged by boosted trees over lexical features
(lengths, depth, digit ratio, character entropy, parameter counts, smoothed
block rate of host suffixes, joined from a table of all suffixes).  The trees learn from labelled URLs: by default
those the rules decide.  Only DataFrame operations and Spark ML run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stage

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))


#: Folds of URLs, by hash: block rates to learn from leave the row's fold out.
FOLDS = 5


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the distinct labelled URLs of each class that the
    trees are fitted on (those with the smallest hash, weighted by the class's
    number of distinct URLs); ``prior`` is the weight of the overall block rate
    in a suffix's rate."""

    sample: int = 8000
    prior: float = 20.0
    trees: int = 12
    depth: int = 3
    threshold: float = 0.5
    seed: int = 7


FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "hyphens",
            "entropy", "parameters", "has_fragment", "is_https", "has_port", "longest_segment", "suffix_rate", "domain_rate")


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path).  Null or no ``://``: both empty.  The scheme separator is
    the first one; host letters A-Z are lower-cased, the path stays as is."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.char_length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _ascii_lower(host), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; both null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _suffix(host: Column, n: int) -> Column:
    return F.substring_index(host, ".", -n)


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    size = F.greatest(F.char_length(text), F.lit(1))
    chars = F.split(text, "")
    counts = F.transform(F.array_distinct(chars), lambda c: (F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))) / size)
    entropy = F.aggregate(counts, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return {
        "url_length": F.char_length(text), "host_length": F.char_length(host), "path_length": F.char_length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")), "labels": _count(host, "."),
        "digit_ratio": _count(text, "0123456789") / size,
        "host_digit_ratio": _count(host, "0123456789") / F.greatest(F.char_length(host), F.lit(1)),
        "hyphens": _count(text, "-_"), "entropy": entropy,
        "parameters": F.when(query == "", 0).otherwise(1 + _count(query, "&")),
        "has_fragment": text.contains("#").cast("int"), "is_https": text.startswith("https:").cast("int"),
        "has_port": host.contains(":").cast("int"),
        "longest_segment": F.array_max(F.transform(F.split(path, "/"), lambda p: F.char_length(p))),
    }


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(FOLDS))


def _rates(marked: DataFrame, settings: Settings) -> tuple[float | None, DataFrame, DataFrame]:
    """Overall block rate (null without labels), and a row (domain, suffix_rate,
    domain_rate) for every two-label host suffix of ``marked`` (host, _fold,
    _block; null without a label): the smoothed rates of its last label and of
    itself.  A suffix without labels has the overall rate.  The second frame
    has the same by (domain, _fold) from the labels of all other folds, so that
    a row to learn from does not see its own label, nor those of its copies."""
    by_fold = stage(marked.groupBy(_suffix(F.col("host"), 2).alias("domain"), "_fold")
                    .agg(F.coalesce(F.sum("_block"), F.lit(0)).alias("blocked"), F.count("_block").alias("n"))
                    .withColumn("_top", _suffix(F.col("domain"), 1)), "url-filter-counts")
    blocked, n = by_fold.agg(F.sum("blocked"), F.sum("n")).first()
    overall = blocked / n if n else None

    def smoothed(blocked: Column, n: Column) -> Column:
        base = F.lit(0.5 if overall is None else overall)
        return F.when(n > 0, (blocked + settings.prior * base) / (n + settings.prior)).otherwise(base)

    def sums(of: str, *by: str) -> DataFrame:
        return by_fold.groupBy(*by).agg(F.sum("blocked").alias(f"_{of}_blocked"), F.sum("n").alias(f"_{of}_n"))

    tops = sums("top", "_top")
    rates = sums("all", "domain", "_top").join(tops, "_top").select(
        "domain", smoothed(F.col("_top_blocked"), F.col("_top_n")).alias("suffix_rate"),
        smoothed(F.col("_all_blocked"), F.col("_all_n")).alias("domain_rate"))
    others = (by_fold.filter("n > 0").join(sums("all", "domain"), "domain").join(tops, "_top").join(sums("own", "_top", "_fold"), ["_top", "_fold"])
              .select("domain", "_fold",
                      smoothed(F.col("_top_blocked") - F.col("_own_blocked"), F.col("_top_n") - F.col("_own_n")).alias("suffix_rate"),
                      smoothed(F.col("_all_blocked") - F.col("blocked"), F.col("_all_n") - F.col("n")).alias("domain_rate")))
    return overall, stage(rates, "url-filter-rates"), others


def _sample(known: DataFrame, size: int) -> DataFrame:
    """Distinct (url, _block) rows of ``known``, at most ``size`` of each
    class, with the weight (distinct URLs of the class / those picked)."""
    distinct = known.distinct()
    found = {r["_block"]: r["count"] for r in distinct.groupBy("_block").count().collect()}
    parts = [distinct.filter(F.col("_block") == block).orderBy(F.xxhash64("url"), "url").limit(size)
             .withColumn("_weight", F.lit(n / min(n, size))) for block, n in sorted(found.items())]
    return reduce(DataFrame.unionByName, parts)


def filter_urls(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score of every page.

    ``labelled`` (url, block 0/1) trains the trees; without it the URLs that
    ``rules`` decide do.  With fewer than two classes to learn from, the score
    is the overall block rate.  A null URL has empty host and path and is
    judged by the method.  Rules of equal length: the last one listed wins.
    An empty table gives an empty result; repeated rows stay; very long URLs
    are judged whole; further columns are ignored.
    """
    host, path = split_url(F.col("url"))
    base = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("_says", says)
    if labelled is None:
        marked = base.withColumn("_fold", _fold(F.col("url"))).withColumn("_block", F.when(F.col("rule").isNotNull(), (F.col("_says") == "block").cast("int")))
        known = marked.filter("_block IS NOT NULL")
    else:
        known = labelled.select("url", host.alias("host"), path.alias("path"), F.col("block").cast("int").alias("_block")).filter("_block IS NOT NULL")
        marked = (base.select("host", _fold(F.col("url")).alias("_fold"), F.lit(None).cast("int").alias("_block"))
                  .unionByName(known.select("host", _fold(F.col("url")).alias("_fold"), "_block")))
    known = known.select("url", "host", "path", "_block")
    known_rate, rates, others = _rates(marked, settings)
    overall = 0.5 if known_rate is None else known_rate
    domain = _suffix(F.col("host"), 2)
    made = {n: c.cast("double") for n, c in lexical_features(F.col("url"), F.col("host"), F.col("path")).items()}
    made |= {n: F.col(n) for n in ("suffix_rate", "domain_rate")}
    assemble = VectorAssembler(inputCols=[f"_{n}" for n in FEATURES], outputCol="_x")
    score = F.lit(overall)
    scored = base
    if 0.0 < overall < 1.0 and known_rate is not None:
        picked = _sample(known, settings.sample).withColumn("domain", domain).withColumn("_fold", _fold(F.col("url")))
        picked = others.join(F.broadcast(picked), ["domain", "_fold"])
        train = stage(picked.select("url", "_block", "_weight", *[made[n].alias(f"_{n}") for n in FEATURES]).coalesce(1)
                      .sortWithinPartitions(F.xxhash64("url"), "url", "_block"), "url-filter-train")
        model = GBTClassifier(featuresCol="_x", labelCol="_block", weightCol="_weight", maxIter=settings.trees, maxDepth=settings.depth,
                              seed=settings.seed, cacheNodeIds=False).fit(assemble.transform(train).select("_x", "_block", "_weight"))
        rated = base.withColumn("domain", domain).join(rates, "domain", "left")
        scored = model.transform(assemble.transform(rated.select(*base.columns, *[made[n].alias(f"_{n}") for n in FEATURES])))
        score = vector_to_array(F.col("probability"))[1]
    verdict = F.coalesce(F.col("_says"), F.when(score >= settings.threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("block_score"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"))
