"""Functional terms per gene and family, term enrichment and term scores.

Annotation rows are (species, gene, terms), where terms is a ", " list that may hold NA.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.order import top_n
from kinfold.functions.stats import with_hypergeom_upper
from kinfold.operators.expression import SINGLETON
from kinfold.sources.config import Hypothesis

# The missing-term pattern and literal, list separator, report size,
# smallest number of significant genes and of genes per scored term.
MISSING_TERM = "(NA, )|(, NA)"
MISSING = "NA"
SEPARATOR = ", "
TOP_TERMS = 500
MIN_SIGNIFICANT = 10
MIN_TERM_GENES = 2


def clean_terms(annotation: DataFrame) -> DataFrame:
    """Drop NA entries inside lists, then rows that still hold NA or have no list."""
    cleaned = F.regexp_replace("terms", MISSING_TERM, "")
    return annotation.withColumn("terms", cleaned).filter(~F.contains(F.col("terms"), F.lit(MISSING)))


def _terms(column: str = "terms") -> Column:
    return F.filter(
        F.transform(F.split(column, ","), lambda t: F.trim(t)), lambda t: (t != "") & (t != MISSING)
    )


def gene_to_terms(annotation: DataFrame) -> DataFrame:
    """Universe: gene with its terms as an array."""
    return clean_terms(annotation).select("species", "gene", F.split("terms", SEPARATOR).alias("terms"))


def term_members(annotation: DataFrame) -> DataFrame:
    """One row per (species, term, gene)."""
    return gene_to_terms(annotation).select("species", F.explode("terms").alias("term"), "gene")


def terms_expressed(annotation: DataFrame, de: DataFrame) -> DataFrame:
    """Annotation of genes that have expression rows."""
    return annotation.join(de.select("species", "gene"), ["species", "gene"], "left_semi")


def genes_per_term(annotation: DataFrame, de: DataFrame) -> DataFrame:
    """Expressed genes of each term, one row per gene: a common term may hold very many."""
    return term_members(terms_expressed(annotation, de))


def annotation_with_hog(annotation: DataFrame, hog_genes: DataFrame) -> DataFrame:
    return annotation.join(hog_genes.select("gene", "hog"), "gene", "left")


def hog_term_members(annotated: DataFrame, hypotheses: Sequence[Hypothesis]) -> DataFrame:
    """Distinct (hypothesis, hog, term); a gene without a family is a group of its own."""
    picked = F.array_compact(
        F.array(*[F.when(F.col("species").isin(h.species), F.lit(h.hypothesis)) for h in hypotheses])
    )
    own = F.concat(F.lit(f"{SINGLETON}_"), F.col("gene"))
    return (
        annotated.select(
            F.explode(picked).alias("hypothesis"), F.coalesce("hog", own).alias("hog"), F.explode(_terms()).alias("term")
        )
        .distinct()
    )


def hog_terms(annotated: DataFrame, hypotheses: Sequence[Hypothesis]) -> DataFrame:
    """Non-redundant sorted term list per family; families without terms are left out.

    Terms are made distinct before they are collected, so a list is at most as long as the
    vocabulary, whatever the size of the family.
    """
    return (
        hog_term_members(annotated, hypotheses)
        .groupBy("hypothesis", "hog")
        .agg(F.array_join(F.sort_array(F.collect_list("term")), SEPARATOR).alias("terms"))
    )


def unique_terms(annotation: DataFrame) -> DataFrame:
    """All distinct terms of a table, one per row."""
    return annotation.select(F.explode(_terms()).alias("term")).distinct()


def collapse_terms(annotation: DataFrame) -> DataFrame:
    """All distinct terms of each species as one list, bounded by the vocabulary."""
    distinct = annotation.select("species", F.explode(_terms()).alias("term")).distinct()
    return distinct.groupBy("species").agg(
        F.array_join(F.sort_array(F.collect_list("term")), SEPARATOR).alias("terms")
    )


def truth_set_overlap(terms: DataFrame, truth: DataFrame) -> DataFrame:
    return terms.select("term").intersect(truth.select("term"))


def restrict_to_ontology(terms: DataFrame, ontology: DataFrame) -> DataFrame:
    return terms.join(ontology.select("term").distinct(), "term", "left_semi")


def with_ancestors(members: DataFrame, term_ancestors: DataFrame) -> DataFrame:
    """Count a gene for every ancestor of its terms too; ``term_ancestors`` has term, ancestor."""
    up = members.join(term_ancestors, "term").select("species", F.col("ancestor").alias("term"), "gene")
    return members.unionByName(up).distinct()


def enrichment_gate(de: DataFrame, fdr: float, minimum: int = MIN_SIGNIFICANT) -> DataFrame:
    """Species with at least ``minimum`` genes strictly below the cut-off."""
    counts = de.groupBy("species").agg(F.count_if(F.col("padj") < fdr).alias("n_significant"))
    return counts.filter(F.col("n_significant") >= minimum)


def term_enrichment(
    annotation: DataFrame, de: DataFrame, fdr: float, minimum: int = MIN_SIGNIFICANT,
    members: DataFrame | None = None,
) -> DataFrame:
    """Per species and term: annotated, significant and expected genes, one-sided Fisher p.

    The universe is all annotated genes of the species. Interesting genes have padj at or
    below the cut-off; only terms with at least one expressed gene are reported, and species
    under the gate not at all.
    """
    universe = clean_terms(annotation)
    members = term_members(annotation) if members is None else members
    calls = de.select(
        "species", "gene", F.lit(1).alias("expressed"), (F.col("padj") <= fdr).cast("int").alias("hit")
    )
    open_species = enrichment_gate(de, fdr, minimum).select("species")

    def called(df: DataFrame) -> DataFrame:
        return df.join(open_species, "species", "left_semi").join(calls, ["species", "gene"], "left")

    size = called(universe.select("species", "gene")).groupBy("species").agg(
        F.count(F.lit(1)).alias("n_universe"), F.coalesce(F.sum("hit"), F.lit(0)).alias("n_hits")
    )
    per_term = called(members).groupBy("species", "term").agg(
        F.count(F.lit(1)).alias("annotated"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("significant"),
        F.coalesce(F.sum("expressed"), F.lit(0)).alias("n_expressed"),
    )
    tested = with_hypergeom_upper(
        per_term.filter(F.col("n_expressed") > 0).join(size, "species"),
        F.col("significant").cast("double"), F.col("annotated").cast("double"),
        F.col("n_hits").cast("double"), (F.col("n_universe") - F.col("n_hits")).cast("double"), "p_value",
    )
    expected = F.col("annotated") * F.col("n_hits") / F.col("n_universe")
    return tested.select("species", "term", "annotated", "significant", expected.alias("expected"), "p_value")


def top_terms(enrichment: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    """The best n terms per species."""
    order = [F.col("p_value").asc(), F.col("annotated").desc(), F.col("term").asc()]
    return top_n(enrichment, ["species"], order, n)


def term_scores(members: DataFrame, de: DataFrame, minimum: int = MIN_TERM_GENES) -> DataFrame:
    """Mean log2 fold change and z-score (up - down) / sqrt(n) per term of expressed genes."""
    change = F.col("log2FoldChange")
    return (
        members.join(de.select("species", "gene", "log2FoldChange"), ["species", "gene"])
        .groupBy("species", "term")
        .agg(
            F.count(F.lit(1)).alias("n_genes"),
            F.avg(change).alias("mean_change"),
            ((F.count_if(change > 0) - F.count_if(change < 0)) / F.sqrt(F.count(F.lit(1)))).alias("z_score"),
        )
        .filter(F.col("n_genes") >= minimum)
    )


def random_sample(ids: DataFrame, key: str, n: int, seed: int, last: int = 10_000) -> DataFrame:
    """n rows without replacement: those with the smallest seeded hashes of their (unique) keys, so a rerun picks the same.

    Counts by the first characters of the hash, at most 65,536 of them, tell up to where all rows are taken and in which range the
    n-th one lies. That range is counted the same way until it holds at most ``last`` rows; only these are sorted.
    """
    rows = ids.withColumn("_order", F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed)))))
    before, prefix = 0, ""
    while True:
        width = len(prefix) + 4
        counts = (
            rows.filter(F.col("_order").startswith(prefix)).groupBy(F.substring("_order", 1, width).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("prefix").collect()
        )
        inside = None
        for r in counts:
            if before + r["n"] > n:
                inside = r
                break
            before += r["n"]
        if inside is None:  # only at the first look: there are no more than n rows
            return ids
        prefix = inside["prefix"]
        if before == n or inside["n"] <= last or width >= 32:
            break
    taken = rows.filter(F.col("_order") < prefix)
    if before < n:
        taken = taken.unionByName(rows.filter(F.col("_order").startswith(prefix)).orderBy("_order", key).limit(n - before))
    return taken.drop("_order")
