"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for the rest.

A rule ``example.net/en/`` fits its host and all subdomains if the url's path starts with the
rule's path; of the rules that fit, the longest decides. All other urls are judged by boosted
trees (Spark ML) on lengths, depth, digit ratio, entropy, parameter counts and how often labelled urls
with the same host suffixes were bad. All of it is DataFrame expressions.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule, and is
judged like any other; labels of null urls are left out; with labels of one kind only, the trees'
verdict is that kind, without labels ``allow``. Repeated rows are judged alike; empty tables give an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.order import computed_once
from kinfold.llm.registry import query, table
from kinfold.llm.store import written

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens", "entropy",
    "parameters", "query_length", "has_fragment", "secure", "rate_1", "rate_2", "rate_3",
]


@dataclass
class UrlParams:
    rules: dict[str, str] = field(
        default_factory=lambda: {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    )
    max_rows: int = 20000  # bound of the labelled sample the trees are fitted on
    rounds: int = 12
    depth: int = 4
    prior: float = 20.0  # labelled urls at the overall rate that every suffix starts with


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host is lower-cased A-Z, both are empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits, else null; equally long rules cannot both fit."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    chars = F.split(text, "")
    return F.when(
        n > 0,
        F.aggregate(
            F.array_distinct(chars),
            F.lit(0.0),
            lambda acc, c: acc
            - F.when(c == "", 0.0).otherwise(
                _share(text, c, n) * F.log2(_share(text, c, n))
            ),
        ),
    ).otherwise(F.lit(0.0))


def _share(text: Column, c: Column, n: Column) -> Column:
    return (n - F.length(F.replace(text, c, F.lit("")))) / n


def suffixes(host: Column) -> Column:
    """The last one, two and three labels of the host."""
    return F.array(*[F.substring_index(host, ".", -k) for k in (1, 2, 3)])


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``url``) and host, path, suffixes and the features that need no labels."""
    host, path = split_url(F.col("url"))
    url = F.coalesce("url", F.lit(""))
    named = computed_once(urls, host=host, path=path)
    asked = F.when(F.instr(url, "?") > 0, F.regexp_extract(url, "\\?([^#]*)", 1)).otherwise(F.lit(""))
    digits = F.length(F.regexp_replace(url, "[^0-9]+", ""))
    return named.select(
        "*",
        suffixes(F.col("host")).alias("suffixes"),
        F.length(url).cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double").alias("depth"),
        F.size(F.split("host", "\\.")).cast("double").alias("labels"),
        (digits / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"),
        F.length(F.regexp_replace("host", "[^0-9]+", "")).cast("double").alias("host_digits"),
        F.length(F.regexp_replace("host", "[^-]+", "")).cast("double").alias("hyphens"),
        entropy(url).alias("entropy"),
        F.size(F.filter(F.split(asked, "&"), lambda x: x != "")).cast("double").alias("parameters"),
        F.length(asked).cast("double").alias("query_length"),
        (F.instr(url, "#") > 0).cast("double").alias("has_fragment"),
        url.startswith("https").cast("double").alias("secure"),
    )


def suffix_rates(labelled: DataFrame, p: UrlParams) -> tuple[DataFrame, float]:
    """(suffix, n, bad) of the labelled urls, counted before they are shuffled, and the overall rate."""
    total = labelled.agg(F.avg("bad")).first()[0] or 0.0
    rates = (
        labelled.select(F.explode(F.array_distinct("suffixes")).alias("suffix"), "bad")
        .groupBy("suffix")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    )
    return rates, float(total)


def with_rates(features: DataFrame, rates: DataFrame, total: float, p: UrlParams, leave_out: bool = False) -> DataFrame:
    """rate_1 to rate_3 by equi-joins on the suffixes; a training row's own label is left out of its rates."""
    out = features
    for k in (1, 2, 3):
        mine = rates.select(F.col("suffix").alias(f"_s{k}"), F.col("n").alias(f"_n{k}"), F.col("bad").alias(f"_b{k}"))
        out = out.withColumn(f"_s{k}", F.col("suffixes")[k - 1]).join(mine, f"_s{k}", "left")
        n, bad = F.coalesce(f"_n{k}", F.lit(0)), F.coalesce(f"_b{k}", F.lit(0))
        if leave_out:
            n, bad = n - 1, bad - F.col("bad")
        out = out.withColumn(f"rate_{k}", (bad + p.prior * total) / (n + p.prior)).drop(f"_s{k}", f"_n{k}", f"_b{k}")
    return out


def judged(pages: DataFrame, labelled: DataFrame, p: UrlParams) -> DataFrame:
    """page_id, host, path, rule, verdict and model_blocks (the trees' own verdict).

    labelled has ``url`` and ``bad`` (0 or 1).
    """
    known = labelled.filter(F.col("url").isNotNull() & F.col("bad").isNotNull()).select("url", F.col("bad").cast("double").alias("bad"))
    known = lexical(known)
    rates, total = suffix_rates(known, p)
    # Written: joins on a very common suffix then have two plain inputs, and a small table is broadcast by its size.
    rates = written(rates, "suffix-rates")
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sample = known.orderBy(F.xxhash64("url"), "url").limit(p.max_rows)
    fitting = with_rates(sample, rates, total, p, leave_out=True)
    base = lexical(pages.select("page_id", "url"))
    if 0.0 < total < 1.0:
        trees = GBTClassifier(labelCol="bad", maxIter=p.rounds, maxDepth=p.depth, maxBins=32, stepSize=0.2, seed=5)
        model = trees.fit(assemble.transform(fitting).select("features", "bad"))
        scored = model.transform(assemble.transform(with_rates(base, rates, total, p)))
        scored = scored.withColumn("model_blocks", F.col("prediction") > 0.5)
    else:
        scored = base.withColumn("model_blocks", F.lit(total >= 1.0))
    rule = fitting_rule(F.col("host"), F.col("path"), list(p.rules))
    verdict = F.when(F.col("model_blocks"), F.lit("block")).otherwise(F.lit("allow"))
    for name, word in p.rules.items():
        verdict = F.when(F.col("rule") == name, F.lit(word)).otherwise(verdict)
    return scored.withColumn("rule", rule).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "model_blocks")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Urls whose path ends in the number of a labelled document: bad if that is toxic or of low quality."""
    number = F.regexp_extract(F.col("url"), "://[^/?#]*/[^?#]*?([0-9]+)[^0-9/?#]*/?(?:[?#]|$)", 1)
    good = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("quality", F.lit(1))).alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    )
    return (
        pages.select("url", number.try_cast("long").alias("doc_id"))
        .filter(F.col("doc_id").isNotNull())
        .join(good, "doc_id")
        .select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    )


@query("op2_url_filters")
def op2_url_filters(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judged(pages, labelled_urls(pages, table(spark, folder, "labels")), UrlParams())
