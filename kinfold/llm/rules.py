"""Quality rules with risk-controlled thresholds.

Rules flag a document whose statistic lies above a cutoff; a lower limit is the upper one of a complement or an inverse, and a
two-sided rule is two of them. Cutoffs are not set by hand: for every stratum and
rule, the lowest cutoff of a fixed grid is taken for which the labelled holdout proves, by the
exact (Clopper-Pearson) binomial bound, that at most ``max_false`` of the good documents would
be rejected. The error level is divided by the number of (stratum, rule) pairs (Bonferroni); the cutoffs of a pair are tested from the
highest one down, and the first one that is not proven ends the row, so a fixed sequence needs no further division. All bounds hold
together with probability 1 - ``error``; a stratum's risk is divided among its rules. A rule without a proven cutoff
in a stratum rejects nothing there.

All of it is DataFrame expressions. Statistics of a text come from one row, never from an
exploded table, so a text of any length stays in its row.

Defined cases: a null text has no words and fails the base rules; null labels take no part in
calibration; the stratum of a null language is its own; repeated rows are judged alike; empty tables give an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.order import computed_once
from kinfold.llm.registry import query, table
from kinfold.llm.store import written

WHITE = "[\\x20\\x09-\\x0D]+"


@dataclass
class RuleParams:
    window: int = 5
    least_words: int = 10
    repeat_percent: int = 20
    max_false: float = 0.02  # of the good documents of a stratum, over all rules together
    error: float = 0.05
    grid: int = 24


#: name -> largest grid value; the grid is geometric down from it.
RULES = {
    "symbols": 2.0, "repeats": 1.0, "dup_lines": 1.0, "long_words": 1.0,
    "long_mean": 64.0, "short_mean": 1.0, "other_characters": 1.0, "open_lines": 1.0,
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, inside one expression."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, k: int) -> Column:
    """Words in k-word windows that occur twice or more in the text.

    Windows are sorted by hash with their places; places whose neighbour has the same hash are kept, and the
    words they cover are counted from the gaps between kept places.
    """
    n = F.size(words)
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(1), n - (k - 1)),
            lambda i: F.struct(F.xxhash64(*[F.get(words, i + (j - 1)) for j in range(k)]).alias("h"), i.alias("i")),
        )
    )

    def covered(s: Column) -> Column:
        m = F.size(s)
        places = F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                    | ((i < m - 1) & (F.get(s, i + 1)["h"] == x["h"])),
                ),
                lambda x: x["i"],
            )
        )
        return _let(
            places,
            lambda p: F.aggregate(
                p,
                F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last")),
                lambda acc, i: F.struct(
                    (acc["n"] + F.least(F.lit(k), i - acc["last"])).alias("n"), i.alias("last")
                ),
                lambda acc: acc["n"],
            ),
        )

    return F.when(n < k + 1, F.lit(0)).otherwise(_let(windows, covered))


def statistics(docs: DataFrame, p: RuleParams) -> DataFrame:
    """The frame (doc_id, lang, text) with the statistics in place of the text."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    words = computed_once(docs, _words=words_of(text), _lines=lines)
    return words.select(
        "doc_id",
        "lang",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(text, WHITE, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        repeated_words(F.col("_words"), p.window).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.char_length(w) > 20)).cast("long").alias("n_long_words"),
        F.char_length(F.regexp_replace(text, "[\\p{L}\\p{M}\\x20\\x09-\\x0D]+", "")).cast("long").alias("n_other_chars"),
        F.size(F.filter("_lines", lambda x: ~x.rlike("[.!?:;\\u2026\\u3002\"')\\]][\\x20\\x09-\\x0D]*$"))).cast("long").alias("n_open_lines"),
    )


def base_failed(p: RuleParams) -> Column:
    return (F.col("n_words") < p.least_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))


def shares() -> dict[str, Column]:
    """The rules' statistics: shares of words, characters or lines, and the mean length of a word and its inverse."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    characters = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / words,
        "repeats": F.col("n_repeat_words") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "long_words": F.col("n_long_words") / words,
        "long_mean": F.col("word_chars") / words,
        "short_mean": F.col("n_words") / characters,
        "other_characters": F.col("n_other_chars") / characters,
        "open_lines": F.col("n_open_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


def binomial_below(k: int, n: int, q: float) -> float:
    """Probability of at most k of n at rate q, by the continued fraction of the incomplete beta function.

    The number of steps grows with the root of n at most, and not with k.
    """
    if k >= n or q <= 0:
        return 1.0
    if q >= 1:
        return 0.0

    def fraction(a: float, b: float, x: float) -> float:
        """Lentz's algorithm; converges fast for x below (a + 1) / (a + b + 2)."""
        tiny = 1e-300
        c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
        h = d
        for m in range(1, 100_000):
            for step in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1 / ((1 + step * d) or tiny)
                c = (1 + step / c) or tiny
                h *= c * d
            if abs(c * d - 1) < 1e-15:
                break
        return h

    a, b, x = n - k, k + 1, 1 - q
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log1p(-q) + b * math.log(q))
    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1 - front * fraction(b, a, q) / b


def binomial_upper(k: int, n: int, error: float) -> float:
    """Exact upper bound of a rate: the largest q for which k or fewer of n have probability ``error``."""
    if k >= n:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_below(k, n, mid) > error else (low, mid)
    return high


def proven(k: int, n: int, limit: float, error: float) -> bool:
    """Whether the exact upper bound of a rate seen k times in n lies at the limit or below: one tail, no search."""
    return k < limit * n and binomial_below(k, n, limit) <= error


def grid_of(rule: str, p: RuleParams) -> list[float]:
    return [RULES[rule] * 0.75**i for i in range(p.grid)]


def calibrate(stats: DataFrame, labels: DataFrame, p: RuleParams) -> dict[str, dict[str, float]]:
    """rule -> stratum -> cutoff. Only counts per stratum, rule and cutoff reach the driver."""
    good = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .filter(F.col("quality") == 1)
        .select("doc_id")
    )
    held = stats.filter(~base_failed(p)).join(good, "doc_id", "left_semi")
    counts = [F.count(F.lit(1)).alias("n")]
    for rule, share in shares().items():
        counts += [F.sum((share > cut).cast("long")).alias(f"{rule}_{i}") for i, cut in enumerate(grid_of(rule, p))]
    rows = held.groupBy(F.coalesce("lang", F.lit("")).alias("stratum")).agg(*counts).collect()
    tests = max(1, len(rows)) * len(RULES)  # the cutoffs of one rule in one stratum are a fixed sequence
    out: dict[str, dict[str, float]] = {rule: {} for rule in RULES}
    for r in rows:
        for rule in RULES:
            for i, cut in enumerate(grid_of(rule, p)):  # downwards: rejections only grow
                if not proven(r[f"{rule}_{i}"], r["n"], p.max_false / len(RULES), p.error / tests):
                    break
                out[rule][r["stratum"]] = cut
    return out


def judged(stats: DataFrame, cutoffs: dict[str, dict[str, float]], p: RuleParams) -> DataFrame:
    """stats with base_failed, kept and the rules that reject."""
    stratum = F.coalesce("lang", F.lit(""))
    flags = []
    for rule, share in shares().items():
        limit = F.lit(float("inf"))
        for name, cut in cutoffs[rule].items():
            limit = F.when(stratum == name, F.lit(cut)).otherwise(limit)
        flags.append(F.when(share > limit, F.lit(rule)))
    rejected = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return (
        stats.withColumn("base_failed", base_failed(p))
        .withColumn("rejected_by", rejected)
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
    )


@query("op7_quality_rules")
def op7_quality_rules(spark, folder):
    p = RuleParams()
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    # The statistics are small beside the texts and serve both the calibration and the verdicts.
    stats = written(statistics(docs, p), "rule-statistics")
    return judged(stats, calibrate(stats, table(spark, folder, "labels"), p), p).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"
    )
