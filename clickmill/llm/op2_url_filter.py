"""URL filters: rules first, then gradient-boosted trees on lexical features.

A rule fits its host and all subdomains if the url's path starts with the rule's; of those
that fit the longest (host and path together) decides. Urls without a rule are judged by
boosted trees (the session's own GBTClassifier) on lexical features: length, host and path
depth, hyphens, digit ratio, character entropy, parameter count, and how often labelled urls
with the same host suffix (last two and last three labels) were bad.

Every url is labelled: it is bad if a part of its host between dots and hyphens is one of
BAD_PARTS. The trees do not see these words. Suffix statistics count all urls, in FOLDS folds
drawn by hash; a url's own are those of the other folds, in training and in judging, so its
own label is in neither (less it alone, the rest would tell its label). Only the rows that
the trees are fitted on are a bounded sample of LABELLED urls. If that has only one kind of
label, the method allows all.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: from there
up to `?`, `#` or the end.

 - A missing url or one without `://` has an empty host and path, so no rule; the trees
   judge it by its other features (all zero if missing).
 - Rows are judged one by one; repeated or missing page ids keep a row each. An empty table
   gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BAD_PARTS = ("ads", "adult", "bets", "betting", "bonus", "casino", "cheap", "click", "crack", "farm", "gamble", "jackpot", "loan",
             "loans", "lottery", "pharma", "pills", "poker", "porn", "promo", "spam", "slots", "track", "tracker", "viagra",
             "warez", "win", "winner", "xxx")
LABELLED = 20_000
TREES, DEPTH, RATE = 12, 3, 0.3
FOLDS = 10
PRIOR = 2.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SYMBOLS = _LOWER + "0123456789-./:?=&_#%"
FEATURES = ("length", "host_length", "host_depth", "path_depth", "hyphens", "digit_ratio", "entropy", "parameters", "rate2", "rate3")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The first `://` decides; what has none is empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and as verdict; both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for where, begins, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(begins)
        rule, verdict = F.when(fits, where + begins).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _times(text: Column, symbol: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(symbol), F.lit("")))


def with_features(pages: DataFrame) -> DataFrame:
    """pages (url, host, path) with the lexical features and the host suffixes."""
    url = F.translate(F.coalesce(F.col("url"), F.lit("")), _UPPER, _LOWER)
    size = F.greatest(F.length("lowered"), F.lit(1))
    counted = pages.withColumn("lowered", url).withColumn(
        "counts", F.array(*[_times(F.col("lowered"), c) for c in _SYMBOLS]))
    share = [F.col("counts")[i] / size for i in range(len(_SYMBOLS))]
    other = (size - sum((F.col("counts")[i] for i in range(1, len(_SYMBOLS))), F.col("counts")[0])) / size
    entropy = sum((F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in [*share[1:], other]),
                  F.when(share[0] > 0, -share[0] * F.log2(share[0])).otherwise(0.0))
    labels = F.split("host", r"\.")
    return counted.select(
        *pages.columns,
        F.length("lowered").cast("double").alias("length"), F.length("host").cast("double").alias("host_length"),
        _times(F.col("host"), ".").cast("double").alias("host_depth"), _times(F.col("path"), "/").cast("double").alias("path_depth"),
        _times(F.col("host"), "-").cast("double").alias("hyphens"),
        (F.length("lowered") - F.length(F.translate("lowered", "0123456789", ""))).cast("double").__truediv__(size).alias("digit_ratio"),
        entropy.alias("entropy"),
        F.when(F.instr("lowered", "?") > 0, 1 + _times(F.substring_index("lowered", "?", -1), "&")).otherwise(0).cast("double").alias("parameters"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("suffix2"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".").alias("suffix3"),
    )


def with_labels(featured: DataFrame) -> DataFrame:
    """featured with the columns `label` and `fold`."""
    bad = F.arrays_overlap(F.split("host", r"[.-]"), F.array(*map(F.lit, BAD_PARTS)))
    return featured.withColumns({"label": bad.cast("double"), "fold": F.pmod(F.xxhash64("page_id", "url"), F.lit(FOLDS)).cast("int")})


def labelled(featured: DataFrame, rows: int, most: int = LABELLED) -> DataFrame:
    """A bounded sample."""
    return featured.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(1_000_000)) < min(1.0, most / max(1, rows)) * 1_000_000)


def suffix_counts(rows: DataFrame) -> DataFrame:
    """Number of urls and of bad ones of each host suffix and fold; suffix3 ends in suffix2."""
    return rows.groupBy("suffix3", "suffix2", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("bad"))


def suffix_rates(counts: DataFrame, base: Column) -> DataFrame:
    """rate2 and rate3 of each suffix3 and fold, from the urls of the other folds."""
    out = counts.select("suffix3", "suffix2", "fold")
    for suffix, name in (("suffix2", "rate2"), ("suffix3", "rate3")):
        own = counts.groupBy(suffix, "fold").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        whole = own.groupBy(suffix).agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"))
        rate = (F.col("all_bad") - F.col("bad") + PRIOR * base) / (F.col("all_n") - F.col("n") + PRIOR)
        out = out.join(own.join(whole, suffix).select(suffix, "fold", rate.alias(name)), [suffix, "fold"])
    return out.select("suffix3", "fold", "rate2", "rate3")


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    split = pages.withColumns({"host": host, "path": path})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    featured = with_labels(with_features(split.withColumns({"rule": rule, "ruled": verdict})))
    counts = settle(suffix_counts(featured), "suffixes")
    folds = counts.groupBy("fold").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).collect()
    rows, bad = sum(r["n"] for r in folds), sum(r["bad"] for r in folds)
    answer = F.lit("allow")
    if 0 < bad < rows:
        # The share of bad urls in the other folds.
        base = F.create_map(*[F.lit(x) for r in folds for x in (r["fold"], (bad - r["bad"]) / max(1, rows - r["n"]))])[F.col("fold")]
        rated = featured.join(settle(suffix_rates(counts, base), "rates"), ["suffix3", "fold"])
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        training = assembler.transform(labelled(rated, rows)).select("features", "label").persist()
        kinds = training.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("bad")).first()
        if 0 < kinds["bad"] < kinds["n"]:
            model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=1).fit(training)
            featured = model.transform(assembler.transform(rated))
            answer = F.when(F.col("prediction") == 1, "block").otherwise("allow")
        training.unpersist()
    return featured.select("page_id", "host", "path", "rule", F.coalesce("ruled", answer).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
