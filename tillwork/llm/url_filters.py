"""URL filters: rules first, else gradient-boosted trees on lexical features.

DataFrame functions and Spark ML only.  The features are lengths, depth, digit and hyphen
ratios, character entropy, parameter counts, and the block rates of host suffixes and of the
first path segment among all labelled rows of *other hosts*: a row never sees its own label or
its host's, neither in the fit nor when it is judged.  Only the trees are fitted on a sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tillwork.llm.spark_util import free_name, materialise

#: training URLs at most: of each class those with the least hash
TRAIN_URLS = 10_000
#: a statistic is broadcast up to this many keys and characters of keys; a larger one is joined by shuffle
BROADCAST_KEYS, BROADCAST_CHARS = 50_000, 5_000_000
TREES, DEPTH = 10, 4
AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEAD = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# The rules (verdict, host, path), and host words of hosts that are blocked as labels.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BLOCKED_HOST_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "viagra", "xxx")

STATISTICS = ("suffix1", "suffix2", "suffix3", "segment")
LEXICAL = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters", "query_length", "secure")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, HEAD, 1), AZ, az), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, HEAD, 2), F.lit(""))


def rule_choice(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null without one; a rule fits its host and
    all subdomains of it if the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer ones are tested first
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character of a string; 0 for an empty one."""
    n = F.char_length(text)
    share = lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / n
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(chars, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    length = F.char_length(url)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern))
    out = {
        "url_length": length, "host_length": F.char_length(host), "path_length": F.char_length(path),
        "depth": count(path, "/"), "labels": count(host, r"\.") + 1,
        "digit_ratio": count(url, "[0-9]") / F.greatest(length, F.lit(1)), "hyphens": count(host, "-"),
        "entropy": entropy(url), "parameters": count(query, "[^&]+"), "query_length": F.char_length(query),
        "secure": url.startswith("https:").cast("int"),
    }
    return {k: v.cast("double") for k, v in out.items()}


def statistic_keys(host: Column, path: Column) -> dict[str, Column]:
    return {**{f"suffix{k}": F.substring_index(host, ".", -k) for k in (1, 2, 3)}, "segment": F.regexp_extract(path, r"(?s)^/?([^/]*)", 1)}


@dataclass
class Rates:
    """Of each statistic: (key, blocked, n) of all labelled rows, and (key, host, blocked, n) of
    a host's own."""

    of_key: dict[str, DataFrame]
    of_host: dict[str, DataFrame]
    small: frozenset[str]  # the statistics that are broadcast


@dataclass
class UrlModel:
    rates: Rates | None
    prior: float
    trees: GBTClassificationModel | None  # None: one class only, the prior decides

    def block_probability(self, urls: DataFrame, url_col: str, host_col: str, path_col: str, out: str) -> DataFrame:
        """``urls`` with the probability of ``block`` in column ``out``."""
        if self.trees is None:
            return urls.withColumn(out, F.lit(self.prior))
        keep = urls.columns
        with_features = _features(urls, F.col(url_col), F.col(host_col), F.col(path_col), self.rates, self.prior)
        scored = self.trees.transform(with_features)
        return scored.select(*keep, vector_to_array(self.trees.getProbabilityCol())[1].alias(out))


def _features(urls: DataFrame, url: Column, host: Column, path: Column, rates: Rates, prior: float) -> DataFrame:
    keys = statistic_keys(host, path)
    df = urls.withColumns({f"__{k}": v for k, v in keys.items()} | {f"__{k}": v for k, v in lexical_features(url, host, path).items()} | {"__host": host})
    for name in STATISTICS:
        sized = (lambda t: F.broadcast(t)) if name in rates.small else (lambda t: t)
        every = rates.of_key[name].select(F.col("key").alias(f"__{name}"), F.col("blocked").alias("__all"), F.col("n").alias("__all_n"))
        own = rates.of_host[name].select(F.col("key").alias(f"__{name}"), F.col("host").alias("__host"), F.col("blocked").alias("__own"), F.col("n").alias("__own_n"))
        df = df.join(sized(every), f"__{name}", "left").join(sized(own), [f"__{name}", "__host"], "left")
        less = lambda all_, own_: F.coalesce(all_, F.lit(0.0)) - F.coalesce(own_, F.lit(0.0))
        # drawn to the prior by two rows' weight
        rate = (less("__all", "__own") + F.lit(2.0 * prior)) / (less("__all_n", "__own_n") + 2)
        df = df.withColumn(f"__{name}_rate", rate).drop("__all", "__all_n", "__own", "__own_n")
    columns = [f"__{k}" for k in LEXICAL] + [f"__{k}_rate" for k in STATISTICS]
    return VectorAssembler(inputCols=columns, outputCol="__features").transform(df)


def block_rates(labelled: DataFrame) -> Rates:
    """Blocked and all rows of every key, and of every key and host, of all labelled (url, blocked)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    keys = F.explode(F.array(*(F.struct(F.lit(k).alias("name"), v.alias("key")) for k, v in statistic_keys(host, path).items())))
    own = materialise(labelled.select("blocked", host.alias("host"), keys.alias("k")).groupBy("k.name", "k.key", "host")
                      .agg(F.sum("blocked").alias("blocked"), F.count("*").cast("double").alias("n")))
    every = materialise(own.groupBy("name", "key").agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n")))
    sizes = own.groupBy("name").agg(F.count("*").alias("n"), F.sum(F.char_length("key") + F.char_length("host")).alias("chars")).collect()
    small = frozenset(r["name"] for r in sizes if r.n <= BROADCAST_KEYS and r.chars <= BROADCAST_CHARS)
    of = lambda table: {name: table.where(F.col("name") == name).drop("name") for name in STATISTICS}
    return Rates(of(every), of(own), small)


def training_urls(labelled: DataFrame, classes: dict[float, tuple[int, int]], train_urls: int) -> DataFrame:
    """(url, blocked, weight) of at most ``train_urls`` distinct (url, blocked): of each class those
    with the least hash, the rarer class up to half.  A url weighs as many rows as it has, and a
    class as many as it has in all.

    classes -- by label its rows and about its distinct urls.
    """
    out, left = [], train_urls
    for label, (rows, urls) in sorted(classes.items(), key=lambda c: c[1][1]):
        wanted, share = left if out else max(1, train_urls // 2), 1.0
        of_class = labelled.where(F.col("blocked") == label)
        if urls > 2 * wanted:  # only hashes below a bound are grouped, with enough urls among them
            share = 1.5 * wanted / urls
        while True:
            low = of_class if share >= 1 else of_class.where(F.xxhash64("url") < F.lit(int(-(2**63) + share * 2**64)))
            picked = materialise(low.groupBy("url", "blocked").agg(F.count("*").alias("n")).orderBy(F.xxhash64("url"), "url").limit(wanted))
            got, n = picked.agg(F.count("*"), F.sum("n")).first()
            if got == wanted or share >= 1:
                break
            share *= 2
        left -= got
        out.append(picked.select("url", "blocked", (F.col("n") * (rows / n)).alias("weight")))
    return out[0].union(out[1])


def fit_urls(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", train_urls: int = TRAIN_URLS) -> UrlModel:
    """Block rates of all labelled URLs, and trees fitted on at most ``train_urls`` distinct ones
    (label 1: block, 0: allow; null urls and labels are left out; a repeated URL counts as often as
    it comes)."""
    labelled = (labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("blocked"))
                .where("url IS NOT NULL AND blocked IS NOT NULL"))
    classes = {r.blocked: (r.n, r.urls) for r in labelled.groupBy("blocked").agg(F.count("*").alias("n"), F.approx_count_distinct("url").alias("urls")).collect()}
    n = sum(rows for rows, _ in classes.values())
    prior = classes.get(1.0, (0, 0))[0] / n if n else 0.0
    if not 0 < prior < 1:
        return UrlModel(None, prior, None)
    rates = block_rates(labelled)
    picked = training_urls(labelled, classes, train_urls).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    train = _features(picked, F.col("url"), F.col("host"), F.col("path"), rates, prior).orderBy("url", "blocked").coalesce(1)
    trees = GBTClassifier(labelCol="blocked", featuresCol="__features", predictionCol="__prediction", weightCol="weight",
                          maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.3)
    return UrlModel(rates, prior, trees.setRawPredictionCol("__raw").setProbabilityCol("__probability").fit(train))


def filter_urls(pages: DataFrame, labelled: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, block_probability`` (underscores appended where
    ``pages`` has such a column).

    The verdict is the longest fitting rule's, else ``block`` from probability 0.5.  A null url,
    or one without ``://``, has an empty host and path, and features of the text it has.  Equal
    urls get equal verdicts.  Without labelled urls of both kinds the commoner kind decides,
    without any ``allow``.
    """
    model = fit_urls(labelled)
    host, path, rule, verdict, probability = free_name(pages, "host", "path", "rule", "verdict", "block_probability")
    df = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    df = model.block_probability(df, url_col, host, path, probability)
    which, says = rule_choice(F.col(host), F.col(path), rules)
    df = df.withColumns({rule: which, verdict: F.coalesce(says, F.when(F.col(probability) >= 0.5, "block").otherwise("allow"))})
    return df.select(*pages.columns, host, path, rule, verdict, probability)


def rule_labels(pages: DataFrame, url_col: str = "url", rules=RULES, words=BLOCKED_HOST_WORDS) -> DataFrame:
    """Labelled URLs of a crawl: blocked where a block rule wins or the host has a blocked word,
    else allowed."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    _, says = rule_choice(host, path, rules)
    listed = host.rlike(rf"(^|[.-])({'|'.join(words)})([.-]|$)")
    return pages.select(F.col(url_col).alias("url"), F.when((says == "block") | (says.isNull() & listed), 1).otherwise(0).alias("blocked"))
