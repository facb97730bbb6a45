"""Family scores: over-representation, family-size p-value and their combination."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.stats import fisher_combine, with_hypergeom_upper
from kinfold.operators.expansion import RUN, flag_expansion
from kinfold.operators.expression import (
    de_with_hog,
    hog_with_sig,
    sig_counts,
    significance_flag,
    significant_members,
)
from kinfold.operators.orthogroups import column, hog_counts, sig, sig_column, total, total_column
from kinfold.sources.config import Hypothesis, all_hypothesis_species

# The resolution floor of family p-values and their fallback.
FAMILY_P_FLOOR = 0.001
FAMILY_P_FALLBACK = 0.999


def _sum(columns: Sequence[Column]) -> Column:
    total = F.lit(0).cast("long")
    for c in columns:
        total = total + c
    return total


def _by_hypothesis(hypotheses: Sequence[Hypothesis], value) -> Column:
    """One CASE on the hypothesis id, as each has its own species lists."""
    branch = F.lit(None)
    for h in hypotheses:
        branch = F.when(F.col("hypothesis") == h.hypothesis, value(h)).otherwise(branch)
    return branch


def total_sig(level: DataFrame, hypotheses: Sequence[Hypothesis], expressed: Sequence[str]) -> DataFrame:
    """Significant genes over the measured species of the hypothesis."""

    def value(h: Hypothesis) -> Column:
        return _sum([F.coalesce(sig(s), F.lit(0)) for s in h.species if s in expressed])

    return level.withColumn("total_sigDE", _by_hypothesis(hypotheses, value))


def _comparable(h: Hypothesis, expressed: Sequence[str]) -> bool:
    return any(s in expressed for s in h.expanded_in) and any(s in expressed for s in h.compared_to)


def norm_sums(level: DataFrame, hypotheses: Sequence[Hypothesis], expressed: Sequence[str]) -> DataFrame:
    """Significant genes per species of each side; the divisor is the full list of the side.

    Null for a hypothesis where one side has no expression data.
    """

    def side(members: str):
        def value(h: Hypothesis) -> Column:
            if not _comparable(h, expressed):
                return F.lit(None).cast("double")
            listed = getattr(h, members)
            return _sum([sig(s) for s in listed if s in expressed]) / F.lit(float(len(listed)))

        return value

    return level.withColumns(
        {
            "norm_sum_expanded_sigDE": _by_hypothesis(hypotheses, side("expanded_in")),
            "norm_sum_compared_sigDE": _by_hypothesis(hypotheses, side("compared_to")),
        }
    )


def urn_totals(hog_de: DataFrame, hypotheses: Sequence[Hypothesis], expressed: Sequence[str]) -> DataFrame:
    """Column totals of both normalised sums, one row per hypothesis.

    The sums are linear in the significant genes per species, so they come from one global
    count and need no second pass over the family table.
    """
    counts = significant_members(hog_de).agg(
        *[F.count_if(F.col("species") == s).alias(sig_column(s)) for s in expressed]
    )
    ids = F.array(*[F.lit(h.hypothesis) for h in hypotheses])
    rows = norm_sums(counts.withColumn("hypothesis", F.explode(ids)), hypotheses, expressed)
    return rows.select(
        "hypothesis",
        F.col("norm_sum_expanded_sigDE").alias("sum_white"),
        F.col("norm_sum_compared_sigDE").alias("sum_black"),
    )


def overrep_p(level: DataFrame, totals: DataFrame) -> DataFrame:
    """Chance of at least as many significant genes on the expanded side; 1 becomes null."""
    x = F.col("norm_sum_expanded_sigDE")
    urns = level.join(F.broadcast(totals), "hypothesis", "left")  # one row per hypothesis
    scored = with_hypergeom_upper(
        urns, x, x + F.col("norm_sum_compared_sigDE"), F.col("sum_white"), F.col("sum_black"), "oaes_hyper"
    )
    return scored.withColumn("oaes_hyper", F.nullif("oaes_hyper", F.lit(1.0))).drop("sum_white", "sum_black")


def default_family_pvalues(hogs: DataFrame) -> DataFrame:
    """Stand-in when the model fit gave nothing."""
    return hogs.select("hog", F.lit(FAMILY_P_FALLBACK).alias("pvalue"))


def hog_with_family_p(level: DataFrame, family: DataFrame, keys: Sequence[str] = ("hog",)) -> DataFrame:
    """Add the family p-value (null where there is none), lifted to the resolution floor."""
    p = F.when(F.col("pvalue") == 0, F.lit(FAMILY_P_FLOOR)).otherwise(F.col("pvalue"))
    return level.join(family.select(*keys, p.alias("cafe_pvalue")), list(keys), "left")


def tea_score(level: DataFrame) -> DataFrame:
    """Combine both p-values; null when either is missing."""
    return level.withColumn("tea_value", fisher_combine(F.col("oaes_hyper"), F.col("cafe_pvalue")))


def order_by_score(level: DataFrame) -> DataFrame:
    """Best families first; a global sort, for the report only."""
    return level.orderBy(
        F.col("tea_value").asc_nulls_last(), F.col("oaes_hyper").asc_nulls_last(), "hypothesis", "hog"
    )


def hog_level(
    hog_genes: DataFrame,
    de: DataFrame,
    family: DataFrame,
    hypotheses: Sequence[Hypothesis],
    ploidy: Mapping[str, int],
    expressed: Sequence[str],
    fdr: float,
    count_mode: str = RUN,
) -> DataFrame:
    """The family table: one row per (hypothesis, hog) with counts, flag, sums and scores."""
    species = all_hypothesis_species(hypotheses)
    measured = [s for s in species if s in expressed]
    hog_de = significance_flag(de_with_hog(de, hog_genes), fdr)
    both = hog_with_sig(hog_counts(hog_genes, species), sig_counts(hog_de, measured))
    level = flag_expansion(hog_with_family_p(both, family), hypotheses, ploidy, count_mode)
    level = norm_sums(total_sig(level, hypotheses, measured), hypotheses, measured)
    level = tea_score(overrep_p(level, urn_totals(hog_de, hypotheses, measured)))
    return level.select(
        "hypothesis",
        "hog",
        "expansion",
        *[total(s) for s in species],
        *[sig(s) for s in measured],
        "total_sigDE",
        "norm_sum_expanded_sigDE",
        "norm_sum_compared_sigDE",
        "oaes_hyper",
        "cafe_pvalue",
        "tea_value",
    )


def hypothesis_view(level: DataFrame, hyp: Hypothesis) -> DataFrame:
    """The family table of one hypothesis with the columns of its own species."""
    species = {c.removesuffix("_total") for c in level.columns if c.endswith("_total")}
    foreign = {name(s) for s in species - set(hyp.species) for name in (total_column, sig_column)}
    columns = [c for c in level.columns if c != "hypothesis" and c not in foreign]
    return level.filter(F.col("hypothesis") == hyp.hypothesis).select(*[column(c) for c in columns])


def all_species_overview(
    hog_genes: DataFrame, hog_de: DataFrame, species: Sequence[str], expressed: Sequence[str]
) -> DataFrame:
    """Counts and significant counts for the species of all hypotheses together."""
    measured = [s for s in species if s in expressed]
    return hog_with_sig(hog_counts(hog_genes, species), sig_counts(hog_de, measured))


def legacy_ratio_score(level: DataFrame, hyp: Hypothesis) -> DataFrame:
    """Earlier score of expanded families: expansion ratio x inverse expression ratio, by size.

    A side where some species has no significant gene counts as one.
    """
    grown = _sum([total(s) for s in hyp.expanded_in])
    base = _sum([total(s) for s in hyp.compared_to])

    def found_in(side: Sequence[str]) -> Column:
        found = [sig(s) if sig_column(s) in level.columns else F.lit(0) for s in side]
        return F.when(F.least(*found, F.lit(2**31)) == 0, F.lit(1)).otherwise(_sum(found))

    e_sig, c_sig = found_in(hyp.expanded_in), found_in(hyp.compared_to)
    score = (grown / F.nullif(base, F.lit(0))) * (c_sig / e_sig) / ((grown + base) * (e_sig + c_sig))
    return level.filter(F.col("expansion") == "yes").withColumn("ratio_score", score)
