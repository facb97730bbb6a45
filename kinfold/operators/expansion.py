"""The expansion rule: which families grew in some species against others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.orthogroups import total
from kinfold.sources.config import Hypothesis

RUN = "reference"  # counter restarts at a failed comparison: length of the last run of passes
SUM = "documented"  # counter is the number of passed comparisons


def _passes(hyp: Hypothesis, e: str, c: str, ploidy: Mapping[str, int]) -> Column:
    grown, base = total(e), total(c)
    if hyp.ploidy_normalization:
        have = grown / F.lit(ploidy[e]) * 2
        by_factor = F.lit(hyp.factor) * base / F.lit(ploidy[c]) * 2
        by_difference = F.lit(hyp.difference) + base / F.lit(ploidy[c]) * 2
    else:
        have = grown
        by_factor = F.lit(hyp.factor) * base
        by_difference = F.lit(hyp.difference) + base
    return (base > 0) & ((have >= by_factor) | (have >= by_difference))


def expansion_counter(hyp: Hypothesis, e: str, ploidy: Mapping[str, int], count_mode: str = RUN) -> Column:
    """How many compared species the expanded species ``e`` beats, in listed order."""
    if count_mode not in (RUN, SUM):
        raise ValueError(f"unknown count mode {count_mode!r}")
    counter = F.lit(0)
    for c in hyp.compared_to:
        missed = F.lit(0) if count_mode == RUN else counter
        counter = F.when(_passes(hyp, e, c, ploidy), counter + 1).otherwise(missed)
    return counter


def is_expanded(hyp: Hypothesis, ploidy: Mapping[str, int], count_mode: str = RUN) -> Column:
    """All criteria of one hypothesis as a single condition on a row of gene counts."""
    winners = F.lit(0)
    for e in hyp.expanded_in:
        beats_enough = expansion_counter(hyp, e, ploidy, count_mode) >= hyp.min_compared_to
        winners = winners + beats_enough.cast("int")
    condition = winners >= hyp.min_expanded_in
    for s in hyp.expanded_in if hyp.expanded_in_all_found else ():
        condition = condition & (total(s) >= 1)
    for s in hyp.compared_to if hyp.compared_to_all_found else ():
        condition = condition & (total(s) >= 1)
    for s in hyp.expanded_in:
        condition = condition & (total(s) >= hyp.min_expanded_genes)
    return condition


def flag_expansion(
    counts: DataFrame, hypotheses: Sequence[Hypothesis], ploidy: Mapping[str, int], count_mode: str = RUN
) -> DataFrame:
    """Every family under every hypothesis with expansion yes/no; one narrow pass over counts."""
    verdicts = [
        F.struct(
            F.lit(h.hypothesis).alias("hypothesis"),
            F.when(is_expanded(h, ploidy, count_mode), "yes").otherwise("no").alias("expansion"),
        )
        for h in hypotheses
    ]
    return counts.select("*", F.inline(F.array(*verdicts)))


def expanded_hogs(
    counts: DataFrame, hypotheses: Sequence[Hypothesis], ploidy: Mapping[str, int], count_mode: str = RUN
) -> DataFrame:
    """(hypothesis, hog) of the expanded families only."""
    flagged = flag_expansion(counts, hypotheses, ploidy, count_mode)
    return flagged.filter(F.col("expansion") == "yes").select("hypothesis", "hog")


def strict_expansion(counts: DataFrame, hyp: Hypothesis, expanded: str) -> DataFrame:
    """Earlier rule: every compared species is present and beaten by the factor."""
    grown = total(expanded)
    kept = counts.filter(grown >= hyp.factor)
    for c in hyp.compared_to:
        base = total(c)
        kept = kept.filter((base > 0) & (grown >= hyp.factor * base))
    return kept
