"""URL filters: a rule list, and boosted trees on lexical features for what no rule fits."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import lower_ascii
from tidepanel.session import write_table

FEATURES = (
    "url_chars", "host_chars", "path_chars", "depth", "digit_ratio", "entropy", "n_params", "n_labels",
    "n_hyphens", "host_digit_ratio", "longest_label", "suffix_rate", "suffix_seen",
)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits a character of the distribution of characters; 0 for an empty text."""
    n = F.length(text)
    kinds = F.array_distinct(F.split(text, "", -1))
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    shares = F.filter(F.transform(F.filter(kinds, lambda c: c != ""), share), lambda p: p > 0)
    return F.when(n > 0, -F.aggregate(shares, F.lit(0.0), lambda a, p: a + p * F.log2(p))).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (with url, host, path) and the features that the url alone gives, and its suffix."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    digits = lambda c: F.length(c) - F.length(F.translate(c, "0123456789", ""))
    count = lambda c, s: F.length(c) - F.length(F.replace(c, F.lit(s), F.lit("")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.", -1)
    return pages.withColumns({
        "url_chars": F.length(url), "host_chars": F.length(host), "path_chars": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/", -1), lambda s: s != "")),
        "digit_ratio": digits(url) / F.greatest(F.length(url), F.lit(1)), "entropy": entropy(url),
        "n_params": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "n_labels": F.size(labels), "n_hyphens": count(host, "-"),
        "host_digit_ratio": digits(host) / F.greatest(F.length(host), F.lit(1)),
        "longest_label": F.array_max(F.transform(labels, lambda s: F.length(s))),
        "suffix": F.element_at(labels, -1),
    })


class UrlModel:
    """Fitted trees and the table of suffix statistics that they were trained with."""

    def __init__(self, trees: PipelineModel | None, suffixes: DataFrame, rate: float):
        self.trees, self.suffixes, self.rate = trees, suffixes, rate

    def features(self, pages: DataFrame) -> DataFrame:
        known = lexical(pages).join(self.suffixes, "suffix", "left")
        return known.withColumns({
            "suffix_rate": F.coalesce("suffix_rate", F.lit(self.rate)), "suffix_seen": F.coalesce("suffix_seen", F.lit(0.0)),
        })

    def blocks(self, pages: DataFrame) -> DataFrame:
        """``pages`` with a boolean ``blocked``; without trees everything is allowed."""
        known = self.features(pages)
        if self.trees is None:
            return known.withColumn("blocked", F.lit(False))
        return self.trees.transform(known).withColumn("blocked", F.col("prediction") == 1)


def train(labelled: DataFrame, max_rows: int = 20_000, rounds: int = 20, depth: int = 4) -> UrlModel:
    """Fit on (url, host, path, label), label 1 for block.

    Suffixes are counted over all different urls. The trees are fitted on at most about
    ``max_rows`` of them, chosen by a hash of the url. With one class only, or no row, nothing is
    blocked.
    """
    urls = labelled.where(F.col("url").isNotNull()).groupBy("url", "host", "path").agg(F.max("label").cast("double").alias("label"))
    by = write_table(lexical(urls).groupBy("suffix").agg(F.sum("label").alias("b"), F.count("*").alias("m")), "counts")
    sums = by.agg(F.sum("m").alias("n"), F.sum("b").alias("blocked")).first()
    total = sums["n"] or 0
    rate = (sums["blocked"] or 0.0) / total if total else 0.0
    suffixes = by.select("suffix", ((F.col("b") + 5 * rate) / (F.col("m") + 5)).alias("suffix_rate"), F.log1p("m").alias("suffix_seen"))
    share = min(1.0, max_rows / max(1, total))
    rows = write_table(urls.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30))), "urls")
    own = rows.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = own["n"], own["blocked"] or 0.0
    model = UrlModel(None, write_table(suffixes, "suffixes"), rate)
    if 0 < blocked < n:
        table = write_table(model.features(rows).select(*FEATURES, "label"), "features")
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="lexical_vector")
        trees = GBTClassifier(featuresCol="lexical_vector", labelCol="label", maxIter=rounds, maxDepth=depth, checkpointInterval=-1, seed=7)
        model.trees = PipelineModel([assembler, trees.fit(assembler.transform(table))])
    return model


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], model: UrlModel | None = None, **training) -> DataFrame:
    """(page_id, url, host, path, rule, verdict): the longest fitting rule's verdict, else the trees'.

    Without ``model`` the urls that a rule fits are the labelled ones. A null url or one without
    ``://`` has empty host and path and no rule; repeated rows are each returned; an empty table
    gives no rows; other columns are ignored; a very long url is taken whole. Of rules that fit equally
    long the last given wins.
    """
    host, path = parts(F.col("url"))
    known = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    known = known.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    if model is None:
        ruled = known.where(F.col("found").isNotNull())
        model = train(ruled.select("url", "host", "path", (F.col("found.verdict") == "block").cast("int").alias("label")), **training)
    judged = model.blocks(known)
    verdict = F.coalesce("found.verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return judged.select("page_id", "url", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))
