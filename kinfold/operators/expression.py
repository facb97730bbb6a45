"""Differential-expression results joined with families, and significant genes per family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.orthogroups import column, sig_column
from kinfold.sources.config import Hypothesis

SINGLETON = "singleton"
DE_COLUMNS = ["baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue", "padj"]


def combine_de(per_species: dict[str, DataFrame]) -> DataFrame:
    """Stack per-species results and keep which species each row came from."""
    frames = [df.select(F.lit(s).alias("species"), "gene", *DE_COLUMNS) for s, df in per_species.items()]
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


def add_unmeasured_species(de: DataFrame, annotation: DataFrame) -> DataFrame:
    """Append (gene, species) of annotated species that have no expression data at all."""
    measured = de.select("species").distinct()
    missing = annotation.select("gene", "species").join(measured, "species", "left_anti")
    return de.unionByName(missing, allowMissingColumns=True)


def de_with_hog(de: DataFrame, hog_genes: DataFrame) -> DataFrame:
    """Full outer join on the gene name alone; rows without a family become singletons.

    Written as a left join plus the genes that have no result, because adaptive execution can
    split a very frequent gene name in a left join but not in a full outer one.
    """
    members = hog_genes.select("gene", "hog")
    measured = de.join(members, "gene", "left")
    unmeasured = members.join(de.select("gene").distinct(), "gene", "left_anti")
    both = measured.unionByName(unmeasured, allowMissingColumns=True)
    return both.withColumn("hog", F.coalesce("hog", F.lit(SINGLETON)))


def significance_flag(de: DataFrame, fdr: float) -> DataFrame:
    """yes below the cut-off; no at or above it, and where there is no adjusted p-value."""
    below = F.coalesce(F.col("padj") < fdr, F.lit(False))
    return de.withColumn("significant", F.when(below, "yes").otherwise("no"))


def drop_singletons(hog_de: DataFrame) -> DataFrame:
    return hog_de.filter(F.col("hog") != SINGLETON)


def significant_members(hog_de: DataFrame) -> DataFrame:
    return drop_singletons(hog_de).filter(F.col("significant") == "yes")


def sig_counts(hog_de: DataFrame, species: Sequence[str]) -> DataFrame:
    """Significant genes per family, one ``<species>_sigDE`` column per species, zeros included."""
    counts = [F.count_if(F.col("species") == s).alias(sig_column(s)) for s in species]
    return significant_members(hog_de).groupBy("hog").agg(*counts)


def sig_counts_long(hog_de: DataFrame) -> DataFrame:
    return significant_members(hog_de).groupBy("hog", "species").agg(F.count(F.lit(1)).alias("n_sig"))


def genes_per_species(hog_de: DataFrame) -> DataFrame:
    return hog_de.groupBy("species").agg(F.count(F.lit(1)).alias("n_genes"))


def species_without_sig(hog_de: DataFrame) -> DataFrame:
    """Species of the table that have no significant gene inside any family."""
    everything = hog_de.filter(F.col("species").isNotNull()).select("species").distinct()
    return everything.join(significant_members(hog_de).select("species").distinct(), "species", "left_anti")


def expressed_species(de: DataFrame, hypotheses: Sequence[Hypothesis]) -> DataFrame:
    """Species of each hypothesis that have expression rows: (hypothesis, species)."""
    measured = de.select("species").distinct()
    listed = F.array_compact(
        F.array(*[F.when(F.col("species").isin(h.species), F.lit(h.hypothesis)) for h in hypotheses])
    )
    return measured.select(F.explode(listed).alias("hypothesis"), "species")


def hog_with_sig(counts: DataFrame, sig: DataFrame) -> DataFrame:
    """Families with both kinds of counts; what is missing on either side is 0."""
    return counts.join(sig, "hog", "full_outer").fillna(0)


def zero_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(column(c), F.lit(0)) for c in columns})
