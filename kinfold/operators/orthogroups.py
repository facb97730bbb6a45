"""Orthogroup tables: wide and long forms, gene counts and set sizes per family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.sources.config import Hypothesis

# Leading columns of the wide table and the family-size limit of the model fit.
WIDE_KEY = "HOG"
WIDE_EXTRA = ["OG", "Gene Tree Parent Clade"]
MAX_FAMILY_SIZE = 100


def total_column(species: str) -> str:
    return f"{species}_total"


def sig_column(species: str) -> str:
    return f"{species}_sigDE"


def column(name: str) -> Column:
    """A column by its exact name; species names may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def total(species: str) -> Column:
    return column(total_column(species))


def sig(species: str) -> Column:
    return column(sig_column(species))


def _genes_in(cell: Column) -> Column:
    return F.filter(F.transform(F.split(cell, ","), lambda gene: F.trim(gene)), lambda gene: gene != "")


def species_columns(wide: DataFrame) -> list[str]:
    return [c for c in wide.columns if c not in (WIDE_KEY, *WIDE_EXTRA)]


def hog_genes_long(wide: DataFrame) -> DataFrame:
    """Wide table -> one row per (hog, species, gene); nothing is shuffled."""
    lists = [column(c) for c in species_columns(wide)]
    cells = wide.unpivot([F.col(WIDE_KEY)], lists, "species", "cell")
    return cells.select(
        F.col(WIDE_KEY).alias("hog"), "species", F.explode(_genes_in(F.col("cell"))).alias("gene")
    )


def wide_gene_count(wide: DataFrame) -> DataFrame:
    """Wide gene lists -> wide gene counts, row by row; nothing is shuffled."""
    lists = species_columns(wide) if WIDE_KEY in wide.columns else wide.columns[1:]
    keep = [c for c in wide.columns if c not in lists]
    counts = [F.coalesce(F.size(_genes_in(column(c))), F.lit(0)).cast("long").alias(c) for c in lists]
    return wide.select(*[column(c) for c in keep], *counts)


def orthogroup_wide(hog_genes: DataFrame, species: Sequence[str]) -> DataFrame:
    """Long members -> wide table with sorted ", " lists, one row per family; a species without genes is null."""
    cells = [
        F.nullif(
            F.array_join(F.sort_array(F.collect_list(F.when(F.col("species") == s, F.col("gene")))), ", "),
            F.lit(""),
        ).alias(s)
        for s in species
    ]
    return hog_genes.groupBy(F.col("hog").alias(WIDE_KEY)).agg(*cells)


def hog_counts(hog_genes: DataFrame, species: Sequence[str]) -> DataFrame:
    """Genes per family and species as ``<species>_total``; families without any stay as zeros.

    Conditional counts combine before the one shuffle on hog, whatever the family size.
    """
    counts = [F.count_if(F.col("species") == s).alias(total_column(s)) for s in species]
    return hog_genes.groupBy("hog").agg(*counts)


def counts_long(counts: DataFrame, species: Sequence[str]) -> DataFrame:
    rows = [F.struct(F.lit(s).alias("species"), total(s).alias("n_genes")) for s in species]
    return counts.select("hog", F.inline(F.array(*rows)))


def hypothesis_gene_lists(hog_genes: DataFrame, hypotheses: Sequence[Hypothesis]) -> DataFrame:
    """Members restricted to the species of each hypothesis: (hypothesis, hog, species, gene)."""
    picked = F.array_compact(
        F.array(*[F.when(F.col("species").isin(h.species), F.lit(h.hypothesis)) for h in hypotheses])
    )
    return hog_genes.select(F.explode(picked).alias("hypothesis"), "hog", "species", "gene")


def family_size_filter(counts: DataFrame, hypothesis: Hypothesis, limit: int = MAX_FAMILY_SIZE) -> DataFrame:
    """Families below ``limit`` genes in every species of the hypothesis."""
    kept = counts
    for s in hypothesis.species:
        kept = kept.filter(total(s) < limit)
    return kept


def family_fit_tables(counts: DataFrame, hypothesis: Hypothesis, limit: int = MAX_FAMILY_SIZE) -> tuple[DataFrame, DataFrame]:
    """The two inputs of the family-size model fit: the size-limited and the complete set."""

    def shape(df: DataFrame) -> DataFrame:
        return df.select(
            F.lit("(null)").alias("Desc"),
            F.col("hog").alias(WIDE_KEY),
            *[total(s).alias(s) for s in hypothesis.species],
        )

    return shape(family_size_filter(counts, hypothesis, limit)), shape(counts)


def species_set_intersections(counts: DataFrame, species: Sequence[str]) -> DataFrame:
    """Exclusive intersections: families by the exact set of species they occur in."""
    present = F.array_join(
        F.array_compact(F.array(*[F.when(total(s) > 0, F.lit(s)) for s in species])), "&"
    )
    sizes = counts.groupBy(present.alias("species_set")).agg(F.count(F.lit(1)).alias("n_families"))
    n_all = counts.agg(F.count(F.lit(1)).alias("n_all")).scalar()
    return sizes.select("species_set", "n_families", (100.0 * F.col("n_families") / n_all).alias("percent"))


def species_pair_overlap(counts: DataFrame, species: Sequence[str]) -> DataFrame:
    """Families shared by two species, for every pair of the (short) species list."""
    pairs = [
        F.when(
            (total(a) > 0) & (total(b) > 0),
            F.struct(F.lit(a).alias("species_a"), F.lit(b).alias("species_b")),
        )
        for i, a in enumerate(species)
        for b in species[i + 1 :]
    ]
    return (
        counts.select(F.inline(F.array_compact(F.array(*pairs))))
        .groupBy("species_a", "species_b")
        .agg(F.count(F.lit(1)).alias("n_families"))
    )


def species_pair_orthology(counts: DataFrame, species: Sequence[str]) -> DataFrame:
    """Genes of a species with orthologues in another one, by the kind of relation.

    Inside a family every gene of one species is an orthologue of every gene of the other, so
    the kinds follow from the two counts and no pair of genes is ever built.
    """
    pairs = [
        F.struct(
            F.lit(a).alias("species_a"), F.lit(b).alias("species_b"),
            total(a).alias("in_a"), total(b).alias("in_b"),
        )
        for a in species
        for b in species
        if a != b
    ]
    both = counts.select(F.inline(F.array(*pairs))).filter("in_a > 0 and in_b > 0")

    def genes(one_in_a: bool, one_in_b: bool) -> Column:
        fits = ((F.col("in_a") == 1) == one_in_a) & ((F.col("in_b") == 1) == one_in_b)
        return F.sum(F.when(fits, F.col("in_a")).otherwise(0))

    return both.groupBy("species_a", "species_b").agg(
        F.sum("in_a").alias("n"),
        genes(True, True).alias("one_one"),
        genes(True, False).alias("one_many"),
        genes(False, True).alias("many_one"),
        genes(False, False).alias("many_many"),
    )


def pair_orthology(pairs: DataFrame) -> DataFrame:
    """The same summary from explicit orthologue pairs (species_a, gene_a, species_b, gene_b)."""
    edge = ["species_a", "species_b"]
    distinct = pairs.select(*edge, "gene_a", "gene_b").distinct()
    out_degree = distinct.groupBy(*edge, "gene_a").agg(F.count(F.lit(1)).alias("n_b"))
    in_degree = distinct.groupBy(*edge, "gene_b").agg(F.count(F.lit(1)).alias("n_a"))
    most = distinct.join(in_degree, [*edge, "gene_b"]).groupBy(*edge, "gene_a").agg(F.max("n_a").alias("n_a"))
    genes = out_degree.join(most, [*edge, "gene_a"])
    return genes.groupBy(*edge).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("n_b") == 1) & (F.col("n_a") == 1)).alias("one_one"),
        F.count_if((F.col("n_b") > 1) & (F.col("n_a") == 1)).alias("one_many"),
        F.count_if((F.col("n_b") == 1) & (F.col("n_a") > 1)).alias("many_one"),
        F.count_if((F.col("n_b") > 1) & (F.col("n_a") > 1)).alias("many_many"),
    )
