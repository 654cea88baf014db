"""URL filters: path rules first, then gradient-boosted trees on lexical features."""

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitparade.llm.stored import stored

#: Intervals of a feature at most, between quantiles of all urls; the trees split between these.
INTERVALS = 32

# Whole words of host names, between dots and hyphens, that label a url as unwanted, as block lists for
# advertising, gambling, pharmacies, adult content and link farms have them.
SEEDS = (
    "ad", "ads", "adserver", "adservice", "banner", "banners", "popup", "popups", "track", "tracker", "trackers", "tracking",
    "bet", "bets", "betting", "casino", "casinos", "gambling", "jackpot", "lottery", "poker", "roulette", "slots",
    "cialis", "pill", "pills", "viagra", "adult", "escort", "escorts", "porn", "porno", "sex", "xxx",
    "linkfarm", "malware", "phishing", "spam", "spammer", "warez",
)

FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio", "entropy",
    "host_entropy", "hyphens", "parameters", "fragment", "secure", "suffix_rows", "suffix_rate",
)


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains where the path starts with the rule's."""

    pattern: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.pattern.partition("/")
        return ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    start = F.locate("://", url)
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")


def ruled(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))
    pick = lambda value: F.coalesce(*(F.when(r.fits(host, path), F.lit(value(r))) for r in ordered), F.lit(None).cast("string"))
    return pick(lambda r: r.pattern), pick(lambda r: r.verdict)


def _ratio(text: Column, characters: str) -> Column:
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.translate(text, characters, ""))) / n).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Bits per character, from the number of times that each distinct character occurs."""
    letters = F.array_sort(F.array_remove(F.split(text, ""), ""))
    n = F.length(text)

    def bits(a: Column) -> Column:
        counts = F.transform(F.array_distinct(a), lambda c: F.length(text) - F.length(F.replace(text, c, F.lit(""))))
        return F.aggregate(counts, F.lit(0.0), lambda total, k: total - k / n * F.log2(k / n))

    return F.when(n > 0, F.transform(F.array(letters), lambda a: bits(a))[0]).otherwise(0.0)


def suffix_of(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def features(urls: DataFrame) -> DataFrame:
    """The columns of urls (with url, host and path) with the lexical features; a null url counts as empty."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    count = lambda text, character: F.length(text) - F.length(F.translate(text, character, ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns(
        {
            "url_length": F.length(url),
            "host_length": F.length(host),
            "path_length": F.length(path),
            "host_depth": count(host, "."),
            "path_depth": count(path, "/"),
            "digit_ratio": F.round(_ratio(url, string.digits), 3),
            "host_digit_ratio": F.round(_ratio(host, string.digits), 3),
            "entropy": F.round(_entropy(url), 2),
            "host_entropy": F.round(_entropy(host), 2),
            "hyphens": count(host, "-"),
            "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1),
            "fragment": url.contains("#").cast("int"),
            "secure": url.startswith("https").cast("int"),
            "suffix": suffix_of(host),
        }
    )


def seed_label(host: Column) -> Column:
    """1 where a word of the host, between dots and hyphens, is a seed."""
    return F.when(F.arrays_overlap(F.split(host, "[.-]"), F.array(*(F.lit(seed) for seed in SEEDS))), 1.0).otherwise(0.0)


def labelled(urls: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """The rows of urls (host and other columns) with label 1 for unwanted ones and else 0.

    hosts is a table of host and label: each stands for itself and its subdomains, the longest that fits counts, and of the
    labels of one host the largest. Seeds label the rest.
    """
    seeded = urls.withColumn("label", seed_label(F.col("host")))
    if hosts is None:
        return seeded
    parts = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    each = urls.where("host != ''").select("host").distinct().select("host", F.explode(above).alias("listed"))
    listed = F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("listed")
    given = hosts.select(listed, F.col("label").cast("double").alias("label")).groupBy("listed").agg(F.max("label").alias("given"))
    best = each.join(given, "listed").groupBy("host").agg(F.max_by("given", F.length("listed")).alias("given"))
    rows = seeded.join(best, "host", "left")
    return rows.select(*urls.columns, F.coalesce("given", "label").alias("label"))


@dataclass
class UrlModel:
    """Fitted trees with the suffix statistics and the intervals of all urls; constant where these have one label only."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    constant: float
    intervals: Bucketizer | None = None

    def _with_suffixes(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.suffixes, "suffix", "left").na.fill({"suffix_rows": 0, "suffix_rate": 0.5})

    def _assembled(self, rows: DataFrame, *kept: str) -> DataFrame:
        names = self.intervals.getOutputCols()
        return VectorAssembler(inputCols=names, outputCol="features").transform(self.intervals.transform(rows)).select(*kept, "features")

    def score(self, urls: DataFrame) -> DataFrame:
        """The rows of urls (url, host, path and other columns) with the probability that a url is unwanted."""
        kept = urls.select(F.struct("*").alias("row"), "url", "host", "path")
        if self.trees is None:
            return kept.select("row.*", F.lit(self.constant).alias("probability"))
        scored = self.trees.transform(self._assembled(self._with_suffixes(features(kept)), "row"))
        return scored.select("row.*", vector_to_array("probability")[1].alias("probability"))


def intervals(rows: DataFrame, n: int = INTERVALS) -> Bucketizer:
    """At most n intervals of each feature, between the exact quantiles of all rows.

    Ratios, entropies and rates are rounded and the other features are counts, so a task counts few distinct values. The
    intervals are nominal to the trees: splits come from sums over all rows, where MLlib would look for those of a continuous
    feature in a sample.
    """
    fractions = F.array(*(F.lit(i / n) for i in range(1, n)))
    found = rows.agg(*(F.percentile(name, fractions).alias(name) for name in FEATURES)).first()
    splits = [[float("-inf"), *sorted(set(found[name])), float("inf")] for name in FEATURES]
    return Bucketizer(splitsArray=splits, inputCols=list(FEATURES), outputCols=[f"{name}_interval" for name in FEATURES])


def fit(labelled: DataFrame, trees: int = 20, depth: int = 4, seed: int = 42) -> UrlModel:
    """Trees on all distinct labelled urls (url, host, path, label 0 or 1), either label with the same total weight."""
    distinct = labelled.select("url", "host", "path", "label").distinct()
    rows = stored(features(distinct).drop("host", "path").sortWithinPartitions("url"), "url-rows")
    suffixes = stored(rows.groupBy("suffix").agg(
        F.round(F.log1p(F.count("*")), 2).alias("suffix_rows"),
        F.round((F.sum("label") + 1) / (F.count("*") + 2), 3).alias("suffix_rate"),
    ), "url-suffixes")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    model = UrlModel(None, suffixes, 1.0 if set(sizes) == {1.0} else 0.0)
    if len(sizes) < 2:
        return model
    total = sum(sizes.values())
    weight = F.when(F.col("label") == 1, total / 2 / sizes[1.0]).otherwise(total / 2 / sizes[0.0])
    weighted = model._with_suffixes(rows).withColumn("weight", weight)
    model.intervals = intervals(weighted)
    classifier = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, weightCol="weight", maxBins=INTERVALS)
    model.trees = classifier.fit(model._assembled(weighted, "label", "weight"))
    return model


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path of the pages."""
    url = F.col("url").cast("string")
    return pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))


def judged(pages: DataFrame, rules: tuple[Rule, ...], model: UrlModel, least: float = 0.5) -> DataFrame:
    """page_id, url, host, path, rule, verdict and probability of every page.

    The verdict is that of the longest rule that fits, else block where the probability is at least `least`. A null url, or
    one without ://, has neither host nor path; rows that repeat are judged alike.
    """
    scored = model.score(with_parts(pages))
    rule, verdict = ruled(rules, F.col("host"), F.col("path"))
    by_model = F.when(F.col("probability") >= least, "block").otherwise("allow")
    return scored.select("page_id", "url", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "probability")
