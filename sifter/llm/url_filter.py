"""URL filters: host and path rules, and boosted trees on lexical features.

``fit`` trains gradient-boosted trees on labelled URLs: lengths, depth,
digit ratio, character entropy, parameter counts and statistics of the
host's suffixes (how often a suffix was blocked among all labelled URLs).
``judge`` gives a rule's verdict where a rule fits a URL and the trees'
verdict elsewhere.  All of it is column expressions and Spark ML; nothing
runs in Python on the executors.

At most ``MAX_TRAIN`` labelled URLs (those with the least hashes) train
the trees.  The suffix statistics count all labelled URLs in a hash aggregate;
their tables grow with the suffixes, so they are joined without a hint: small
ones are broadcast, the rest sort-merged.

Results defined for odd input: a null URL, or one without ``://``, has an
empty host and path, fits no rule and is judged by its features (a null
as empty text); repeated URLs are judged each on its own; without
labelled URLs the verdict is allow, and with one class only, that class;
of the input only the id and URL columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.stage import staged

#: Labelled URLs that the trees are fitted on, at most.
MAX_TRAIN = 20_000
TREES, DEPTH, SEED = 20, 4, 17
#: Weight of the overall rate in a suffix' rate, in URLs.
SMOOTHING = 5.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEXICAL = ("url_chars", "host_chars", "path_chars", "query_chars", "depth", "host_labels", "digit_ratio",
           "entropy", "n_params", "n_hyphens", "n_odd_chars", "has_fragment", "is_https")
SUFFIX = ("top_rate", "top_log_n", "site_rate", "site_log_n")


def _rest(url: Column) -> Column:
    found = F.instr(url, "://")
    return F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Between ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits the host or one of its
    parents and that the path starts with; null if none does."""
    def fits(rule: str) -> Column:
        rule_host, _, rest = rule.partition("/")
        return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)

    tries = [F.when(fits(r), F.lit(r)) for r in sorted(rules, key=lambda r: (-len(r), r))]
    return F.coalesce(*tries, F.lit(None).cast("string"))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.char_length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")),
                         lambda c: F.when(c == "", 0.0).otherwise(
                             (n - F.char_length(F.replace(text, c, F.lit("")))) / F.greatest(n, F.lit(1))))
    return F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds host, path, their suffixes and the lexical features to rows with a ``url``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    df = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "_query": query})
    labels = F.split(F.col("host"), r"\.")
    return (df.withColumns({
        "top": F.element_at(labels, -1),
        "site": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "url_chars": F.char_length(url).cast("double"),
        "host_chars": F.char_length("host").cast("double"),
        "path_chars": F.char_length("path").cast("double"),
        "query_chars": F.char_length("_query").cast("double"),
        "depth": count(F.col("path"), "/[^/]"),
        "host_labels": count(F.col("host"), r"[^.]+"),
        "digit_ratio": count(url, "[0-9]") / F.greatest(F.char_length(url), F.lit(1)),
        "entropy": entropy(url),
        "n_params": count(F.col("_query"), "[^&]+"),
        "n_hyphens": count(url, "-"),
        "n_odd_chars": count(url, r"[^A-Za-z0-9:/?#&=._-]"),
        "has_fragment": (F.instr(url, "#") > 0).cast("double"),
        "is_https": url.startswith("https").cast("double"),
    }).drop("_query"))


@dataclass
class UrlModel:
    """Fitted trees, suffix rates by level and the rate of the labelled URLs;
    without trees the verdict is that rate's."""
    trees: GBTClassificationModel | None
    suffixes: dict[str, DataFrame] | None
    rate: float

    def features(self, urls: DataFrame) -> DataFrame:
        df = lexical(urls)
        for level in ("top", "site"):
            table = self.suffixes[level].select(
                F.col("suffix").alias(level), F.col("rate").alias(f"{level}_rate"), F.col("log_n").alias(f"{level}_log_n"))
            df = df.join(table, level, "left")
        df = df.fillna({"top_rate": self.rate, "site_rate": self.rate, "top_log_n": 0.0, "site_log_n": 0.0})
        return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features").transform(df)

    def score(self, urls: DataFrame) -> DataFrame:
        """Adds host, path, features and ``blocked`` (0 or 1) to rows with a ``url``."""
        if self.trees is None:
            return lexical(urls).withColumn("blocked", F.lit(float(self.rate >= 0.5)))
        return self.trees.transform(self.features(urls)).withColumnRenamed("prediction", "blocked")


def fit(labelled: DataFrame, max_train: int = MAX_TRAIN, trees: int = TREES, depth: int = DEPTH,
        seed: int = SEED) -> UrlModel:
    """Trains on rows (url, label 0 or 1); rows with a null are left out."""
    labelled = labelled.select("url", F.col("label").cast("double").alias("label")).dropna()
    counted = staged(lexical(labelled).groupBy("top", "site").agg(F.count("*").alias("n"), F.sum("label").alias("blocked")),
                     "url-suffixes")
    n, blocked = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        return UrlModel(None, None, blocked / n if n else 0.0)
    rate = blocked / n
    suffixes = {level: staged(
        counted.groupBy(F.col(level).alias("suffix")).agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"))
        .select("suffix", F.log1p("n").alias("log_n"),
                ((F.col("blocked") + SMOOTHING * rate) / (F.col("n") + SMOOTHING)).alias("rate")), f"url-{level}")
        for level in ("top", "site")}
    sample = labelled.orderBy(F.xxhash64("url"), "url", "label").limit(max_train).persist()
    model = UrlModel(None, suffixes, rate)
    train = model.features(sample).select("features", "label")
    model.trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth,
                                seed=seed).fit(train)
    sample.unpersist()
    return model


def judge(pages: DataFrame, rules: dict[str, str], model: UrlModel, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every URL."""
    urls = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"))
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    by_rule = reduce(lambda c, kv: c.when(F.col("rule") == kv[0], kv[1]), rules.items(), F.when(F.lit(False), ""))
    return (model.score(urls).withColumn("rule", rule)
            .select(F.col("_id").alias(id_col), "host", "path", "rule",
                    F.coalesce(by_rule, F.when(F.col("blocked") == 1, "block").otherwise("allow")).alias("verdict")))


def labelled_by_rules(pages: DataFrame, rules: dict[str, str], url_col: str = "url") -> DataFrame:
    """(url, label) of the URLs that a rule fits: 1 for block."""
    rule = fitting_rule(host_of(F.col(url_col)), path_of(F.col(url_col)), rules)
    blocks = [r for r, verdict in rules.items() if verdict == "block"]
    return (pages.select(F.col(url_col).alias("url"), rule.alias("rule")).filter("rule IS NOT NULL")
            .select("url", F.col("rule").isin(blocks).cast("int").alias("label")))
