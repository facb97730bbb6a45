"""From overlaps and transcript estimates to counts, size factors and a two-group test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.order import computed_once, exact_median, running_count
from kinfold.functions.stats import two_sided_normal

# Floor of the dispersion and of a group mean, and steps that exhaust double precision.
MIN_DISPERSION = 1e-8
MIN_MEAN = 0.5
HALVINGS = 60
LEVELS = 7  # of bins, each eight times as wide as the one below; longer intervals share one bin per chromosome


def count_features(alignments: DataFrame, features: DataFrame, key: str = "gene_id", width: int = 4096) -> DataFrame:
    """Reads per feature key: every overlapped feature counts, every alignment counts.

    Interval join by nested bins: widths grow eightfold from level to level, and an interval lies in the smallest bin that holds it whole.
    Bins of two overlapping intervals are nested, so each side meets the bins around its own one, at most one per
    level however long it is, and a pair meets once: in the larger bin of both. Coordinates are 1-based and closed.
    """
    levels = range(LEVELS)

    def binned(rows: DataFrame, start: str, end: str, enclosing: int | None) -> DataFrame:
        """Rows at their own bin, or at the enclosing bins from ``enclosing`` levels above on."""
        level = F.lit(LEVELS)
        for k in reversed(levels):
            size = width * 8**k
            level = F.when(F.floor(F.col(start) / size) == F.floor(F.col(end) / size), F.lit(k)).otherwise(level)
        sizes = F.array(*[F.lit(width * 8**k).cast("long") for k in levels])
        if enclosing is None:
            at = rows.withColumn("level", level)
        else:
            # A descending sequence is never made: above the last level there is none.
            first = level + enclosing
            at = rows.withColumn("level", F.explode(F.when(first <= LEVELS, F.sequence(first, F.lit(LEVELS)))))
        return at.withColumn("bin", F.when(F.col("level") == LEVELS, F.lit(0)).otherwise(F.floor(F.col(start) / F.get(sizes, F.col("level")))))

    reads = alignments.select("sample", "chrom", "read_id", "hit_index", "start", "end")
    parts = features.select("chrom", F.col(key), F.col("start").alias("f_start"), F.col("end").alias("f_end"))
    overlap = (F.col("start") <= F.col("f_end")) & (F.col("f_start") <= F.col("end"))
    where = ["chrom", "level", "bin"]
    out = ["sample", key, "read_id", "hit_index"]
    in_feature_bin = binned(reads, "start", "end", 0).join(binned(parts, "f_start", "f_end", None), where).filter(overlap).select(*out)
    in_read_bin = binned(reads, "start", "end", None).join(binned(parts, "f_start", "f_end", 1), where).filter(overlap).select(*out)
    once = in_feature_bin.unionByName(in_read_bin).groupBy(*out).agg(F.count(F.lit(1)).alias("parts"))
    return once.groupBy("sample", key).agg(F.count(F.lit(1)).alias("count"))


def merge_counts(counts: DataFrame, samples: Sequence[str], keys: Sequence[str] = ("gene",)) -> DataFrame:
    """Long counts -> one column per sample; a gene missing in a sample is null."""
    cells = [F.sum(F.when(F.col("sample") == s, F.col("count"))).alias(s) for s in samples]
    return counts.groupBy(*keys).agg(*cells)


def tx_to_gene(quant: DataFrame, tx2gene: DataFrame, transcript_level: bool = False) -> DataFrame:
    """Transcript estimates -> genes: summed counts and abundance, abundance-weighted length."""
    if transcript_level:
        return quant.withColumnRenamed("transcript_id", "gene")
    weighted = F.sum(F.col("length") * F.col("abundance")) / F.nullif(F.sum("abundance"), F.lit(0.0))
    return (
        quant.join(tx2gene, "transcript_id")
        .groupBy("sample", F.col("gene_id").alias("gene"))
        .agg(
            F.sum("count").alias("count"),
            F.sum("abundance").alias("abundance"),
            F.coalesce(weighted, F.avg("length")).alias("length"),
        )
    )


def design_check(counts: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Sample names of the matrix that the design lacks, and the other way round."""
    found = counts.select("sample").distinct()
    listed = counts.sparkSession.createDataFrame([(s,) for s in samples], "sample string")
    return found.join(listed, "sample", "left_anti").select("sample", F.lit("matrix").alias("only_in")).unionByName(
        listed.join(found, "sample", "left_anti").select("sample", F.lit("design").alias("only_in"))
    )


def count_rows(counts: DataFrame, samples: Sequence[str]) -> DataFrame:
    """One row per gene with its counts as an array in design order; a missing count is 0.

    One shuffle on gene with partial sums; all per-gene numbers after it are row-wise.
    """
    cells = [F.coalesce(F.sum(F.when(F.col("sample") == s, F.col("count"))), F.lit(0)) for s in samples]
    return counts.groupBy("gene").agg(F.array(*[c.cast("double") for c in cells]).alias("counts"))


def size_factors(rows: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Median of count over geometric mean, from genes counted in every sample."""
    complete = rows.filter(~F.exists("counts", lambda c: c <= 0))
    logs = F.transform("counts", lambda c: F.log(c))
    mean = F.aggregate(logs, F.lit(0.0), lambda a, x: a + x) / len(samples)
    names = F.array(*[F.lit(s) for s in samples])
    ratios = F.zip_with(names, logs, lambda s, x: F.struct(s.alias("sample"), x.alias("log_count")))
    long = complete.select(mean.alias("log_mean"), F.inline(ratios)).select(
        "sample", (F.col("log_count") - F.col("log_mean")).alias("log_ratio")
    )
    return exact_median(long, ["sample"], "log_ratio", "log_factor").select(
        "sample", F.exp("log_factor").alias("size_factor")
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def with_factors(rows: DataFrame, factors: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Attach the factors in design order, and counts divided by them."""
    cells = [F.max(F.when(F.col("sample") == s, F.col("size_factor"))) for s in samples]
    in_order = factors.agg(F.array(*cells).alias("factors")).scalar()
    return rows.withColumn("factors", in_order).withColumn(
        "normalised", F.zip_with("counts", "factors", lambda c, f: c / f)
    )


def gene_dispersion(normalised: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Gene-wise moment estimate of the dispersion over all samples, not shrunken."""
    n = len(samples)
    mean = _total(F.col("normalised")) / n
    variance = F.aggregate(
        "normalised", F.lit(0.0), lambda a, x: a + (x - F.col("baseMean")) * (x - F.col("baseMean"))
    ) / (n - 1)
    inverse = _total(F.transform("factors", lambda f: 1.0 / f)) / n
    moment = (F.col("variance") - F.col("baseMean") * inverse) / F.nullif(
        F.col("baseMean") * F.col("baseMean"), F.lit(0.0)
    )
    return (
        normalised.withColumn("baseMean", mean)
        .withColumn("variance", variance)
        .withColumn("dispersion", F.greatest(F.coalesce(moment, F.lit(MIN_DISPERSION)), F.lit(MIN_DISPERSION)))
    )


def _fitted_mean(counts: Column, factors: Column) -> Column:
    """Negative binomial mean of a group, by halving the interval that holds the root of the likelihood equation.

    Every term (c - f mu) / (1 + dispersion f mu) falls in mu and changes sign at c / f, so the one root lies between the
    smallest and the largest of these; ``HALVINGS`` reach double precision for any data.
    """
    alpha = F.col("dispersion")
    pairs = F.zip_with(counts, factors, lambda c, f: F.struct(c.alias("c"), f.alias("f")))
    rates = F.transform(pairs, lambda p: (p["c"] / p["f"]).cast("double"))

    def halve(state: Column, _: Column) -> Column:
        mu = (state["low"] + state["high"]) / 2.0
        slope = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["c"] - p["f"] * mu) / (1.0 + alpha * mu * p["f"]))
        above = slope > 0
        return F.struct(
            F.when(above, mu).otherwise(state["low"]).alias("low"), F.when(above, state["high"]).otherwise(mu).alias("high")
        )

    ends = F.struct(F.array_min(rates).alias("low"), F.array_max(rates).alias("high"))
    root = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), ends, halve, lambda state: (state["low"] + state["high"]) / 2.0)
    return F.greatest(root, F.lit(MIN_MEAN))


def _information(mu: Column, factors: Column) -> Column:
    """Expected information about the log mean of a group."""
    alpha = F.col("dispersion")
    return _total(F.transform(factors, lambda f: mu * f / (1.0 + alpha * mu * f)))


def group_dispersion(normalised: DataFrame, samples: Sequence[str], condition: Mapping[str, str]) -> DataFrame:
    """Gene-wise dispersion around the group means, for tests between the groups.

    The excess of squared residuals over the means, relative to the squared means, per degree
    of freedom; a difference between the groups does not count as spread.
    """
    groups = sorted({condition[s] for s in samples})

    def values(level: str) -> Column:
        return F.array(*[F.get("normalised", F.lit(i)) for i, s in enumerate(samples) if condition[s] == level])

    excess = F.lit(0.0)
    for level in groups:
        size = sum(condition[s] == level for s in samples)
        mean = F.greatest(_total(values(level)) / size, F.lit(MIN_MEAN))
        squares = _total(F.transform(values(level), lambda x: (x - mean) * (x - mean)))
        excess = excess + (squares - size * mean) / (mean * mean)
    return normalised.withColumn("baseMean", _total(F.col("normalised")) / len(samples)).withColumn(
        "dispersion", F.greatest(excess / (len(samples) - len(groups)), F.lit(MIN_DISPERSION))
    )


def de_test(dispersed: DataFrame, samples: Sequence[str], condition: Mapping[str, str]) -> DataFrame:
    """Two-group negative binomial Wald test per gene; the alphabetically first group is the base.

    A group mean solves the likelihood equation; the standard error comes from the expected information of both groups.
    """
    levels = sorted({condition[s] for s in samples})
    if len(levels) != 2:
        raise ValueError(f"two conditions are needed, found {levels}")

    def pick(column: str, level: str) -> Column:
        at = [i for i, s in enumerate(samples) if condition[s] == level]
        return F.array(*[F.get(column, F.lit(i)) for i in at])

    base, other = ((pick("counts", level), pick("factors", level)) for level in levels)
    fitted = computed_once(dispersed, base_mean=_fitted_mean(*base), other_mean=_fitted_mean(*other))
    change = F.log2(F.col("other_mean") / F.col("base_mean"))
    error = F.sqrt(
        1.0 / _information(F.col("base_mean"), base[1]) + 1.0 / _information(F.col("other_mean"), other[1])
    ) / F.log(F.lit(2.0))
    counted = F.col("baseMean") > 0
    effects = computed_once(fitted, log2FoldChange=F.when(counted, change), lfcSE=F.when(counted, error))
    tested = computed_once(effects, stat=F.col("log2FoldChange") / F.col("lfcSE"))
    return computed_once(tested, pvalue=two_sided_normal(F.col("stat"))).select(
        "gene", "baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue"
    )


def bh_adjust(df: DataFrame, by: Sequence[str] = ("species",), p: str = "pvalue", out: str = "padj") -> DataFrame:
    """Benjamini-Hochberg per group; null p-values stay null and do not count.

    Works on distinct p-values with their running counts. The minimum over all larger values
    is taken inside each bucket and carried across buckets by their minima.
    """
    by = list(by)
    ranked = running_count(df, by, p).withColumn("raw", F.col(p) * F.col("n_group") / F.col("n_upto"))
    after = Window.partitionBy(*by).orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranked.groupBy(*by, "bucket")
        .agg(F.min("raw").alias("bucket_min"))
        .select(*by, "bucket", F.min("bucket_min").over(after).alias("carried"))
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(F.col(p).desc())
    adjusted = (
        ranked.withColumn("inside", F.min("raw").over(inside))
        .join(carried, [*by, "bucket"])
        .select(*by, p, F.least("inside", "carried", F.lit(1.0)).alias(out))
    )
    return df.drop(out).join(adjusted, [*by, p], "left")
