"""Similarity hits around expanded families: extended hits, closest families, gene sets.

Every step works on all families of all hypotheses at once, keyed (hypothesis, hog). Orders
are total: e-value up, bit score and identity down, then the two sequence ids. First
appearances and best hits are minima over that order, which combine before the shuffle, so a
family with very many hits never has to be sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.order import full_rank, top_n
from kinfold.operators.expression import SINGLETON
from kinfold.session import cut_lineage

GROUP = ["hypothesis", "hog"]
EVALUE_LIMIT = 1e-3  # fixed value: e-value cut-off of the search step


def hit_evalue_filter(hits: DataFrame, limit: float = EVALUE_LIMIT) -> DataFrame:
    return hits.filter(F.col("evalue") <= limit)


def name_hits(hits: DataFrame, id_map: DataFrame) -> DataFrame:
    """Attach the gene names of query and subject; unknown ids stay null."""
    query = id_map.select(F.col("seqid").alias("qseqid"), F.col("name").alias("qseqid_name"))
    subject = id_map.select(F.col("seqid").alias("sseqid"), F.col("name").alias("sseqid_name"))
    return hits.join(query, "qseqid", "left").join(subject, "sseqid", "left")


def hit_order() -> list[Column]:
    return [
        F.col("evalue").asc(),
        F.col("bitscore").desc(),
        F.col("pident").desc(),
        F.col("qseqid").asc(),
        F.col("sseqid").asc(),
    ]


def _hit_key(*more: Column) -> Column:
    """The hit order as one comparable struct, for use in minima."""
    return F.struct(
        F.col("evalue").alias("evalue"),
        (-F.col("bitscore")).alias("bitscore"),
        (-F.col("pident")).alias("pident"),
        F.col("qseqid").alias("qseqid"),
        F.col("sseqid").alias("sseqid"),
        *more,
    )


def hits_touching(hits: DataFrame, id_map: DataFrame, members: DataFrame) -> DataFrame:
    """Hits whose query or subject belongs to a family, with both names: one row per (hypothesis, hog, hit).

    ``members`` has hypothesis, hog and gene. Every sequence id gets its name and the families of that name as one array; the table is written,
    so that it is made once and the planner knows its size. A hit meets it twice, by query and by subject, and only then
    becomes one row per family, so it is shuffled twice however many families it touches. The table holds every sequence and grows
    with the input, so it is merged and never sent through the driver. A hit found by its subject is
    dropped when its query is in the same family too; both lists are in the row then, so nothing needs to be de-duplicated.
    """
    families = members.groupBy("gene").agg(F.collect_set(F.struct(*GROUP)).alias("families"))
    named = id_map.select("seqid", F.col("name").alias("gene")).join(families, "gene", "left")
    ids = cut_lineage(named.select("seqid", "gene", "families"))

    def end(side: str) -> DataFrame:
        return ids.select(
            F.col("seqid").alias(side), F.col("gene").alias(f"{side}_name"), F.col("families").alias(f"_{side}_families")
        ).hint("merge")

    def of(side: str) -> Column:
        none = F.array().cast(ids.schema["families"].dataType)
        return F.coalesce(F.col(f"_{side}_families"), none)

    def met_by_query(family: Column) -> Column:
        same = F.exists(of("qseqid"), lambda f: (f["hypothesis"] == family["hypothesis"]) & (f["hog"] == family["hog"]))
        return F.coalesce(same, F.lit(False))

    both = hits.join(end("qseqid"), "qseqid", "left").join(end("sseqid"), "sseqid", "left")
    touched = F.concat(of("qseqid"), F.filter(of("sseqid"), lambda family: ~met_by_query(family)))
    found = both.select(*hits.columns, "qseqid_name", "sseqid_name", F.inline(touched))
    return found.select(*GROUP, *hits.columns, "qseqid_name", "sseqid_name")


def rank_hits(touching: DataFrame) -> DataFrame:
    """Position of each hit inside its family."""
    return full_rank(touching, GROUP, "evalue", "bitscore", hit_order())


def first_seen_genes(touching: DataFrame) -> DataFrame:
    """Genes of a family's hits with the place of their first appearance.

    Reading the ordered hits as query, subject, query, subject, ... the first place of a gene
    is the smallest (hit, side) it occurs in.
    """
    ends = F.array(
        F.struct(F.col("qseqid_name").alias("gene"), F.lit(0).alias("side")),
        F.struct(F.col("sseqid_name").alias("gene"), F.lit(1).alias("side")),
    )
    seen = touching.select(*GROUP, "evalue", "bitscore", "pident", "qseqid", "sseqid", F.inline(ends))
    return (
        seen.filter(F.col("gene").isNotNull())
        .groupBy(*GROUP, "gene")
        .agg(F.min(_hit_key(F.col("side"))).alias("first_seen"))
    )


def extended_genes(touching: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """The first n genes outside the family in order of first appearance, ranked 1..n."""
    keys = members.select(*GROUP, "gene").distinct()
    outside = first_seen_genes(touching).join(keys, [*GROUP, "gene"], "left_anti")
    return top_n(outside, GROUP, [F.col("first_seen")], n).select(*GROUP, "gene", "rank")


def restrict_hits(touching: DataFrame, members: DataFrame, extended: DataFrame) -> DataFrame:
    """Hits with both ends inside members and extended genes of the family."""
    allowed = members.select(*GROUP, "gene").unionByName(extended.select(*GROUP, "gene")).distinct()
    query = allowed.withColumnRenamed("gene", "qseqid_name")
    subject = allowed.withColumnRenamed("gene", "sseqid_name")
    return touching.join(query, [*GROUP, "qseqid_name"], "left_semi").join(
        subject, [*GROUP, "sseqid_name"], "left_semi"
    )


def hits_to_hog(touching: DataFrame, hog_genes: DataFrame) -> DataFrame:
    """Family of each subject as ``target_hog``; null for genes without one."""
    target = hog_genes.select(F.col("gene").alias("sseqid_name"), F.col("hog").alias("target_hog"))
    return touching.join(target, "sseqid_name", "left")


def best_hit_per_subject(with_target: DataFrame) -> DataFrame:
    """Best hit of each subject name in a family; unnamed subjects count as one."""
    best = with_target.groupBy(*GROUP, "sseqid_name").agg(
        F.min(_hit_key(F.col("target_hog").alias("target_hog"))).alias("best")
    )
    return best.select(*GROUP, "sseqid_name", F.col("best.target_hog").alias("target_hog"), "best")


def closest_hogs(best: DataFrame, n: int) -> DataFrame:
    """The family itself and up to n next families or singletons, ranked from 1.

    A singleton is named by its number among the singletons in rank order.
    """
    per_target = best.groupBy(
        *GROUP, "target_hog", F.when(F.col("target_hog").isNull(), F.col("sseqid_name")).alias("gene")
    ).agg(F.min("best").alias("best"))
    ranked = top_n(per_target, GROUP, [F.col("best")], n + 1)
    singles = F.count_if(F.col("target_hog").isNull()).over(Window.partitionBy(*GROUP).orderBy("rank"))
    name = F.coalesce(F.col("target_hog"), F.concat(F.lit(f"{SINGLETON}-"), singles.cast("string")))
    return ranked.select(*GROUP, "rank", name.alias("closest"), "target_hog", "gene")


def cumulative_gene_sets(closest: DataFrame, hog_genes: DataFrame) -> DataFrame:
    """Set k holds the genes of ranks 1..k: (hypothesis, hog, set_num, gene).

    Families bring the genes of every species, singletons only themselves. The last set is
    the last rank that exists, so a family with fewer neighbours has fewer sets.
    """
    # at most n + 1 rows per family
    spread = closest.withColumn("last", F.max("rank").over(Window.partitionBy(*GROUP)))
    pool = hog_genes.select(F.col("hog").alias("target_hog"), F.col("gene").alias("member"))
    families = spread.filter(F.col("target_hog").isNotNull()).join(pool, "target_hog")
    genes = families.select(*GROUP, "rank", "last", F.col("member").alias("gene")).unionByName(
        spread.filter(F.col("target_hog").isNull()).select(*GROUP, "rank", "last", "gene")
    )
    return genes.select(*GROUP, F.explode(F.sequence("rank", "last")).alias("set_num"), "gene")


def pad_sets(sets: DataFrame, expanded: DataFrame, n: int) -> DataFrame:
    """Size of each set 1..n+1 of every expanded family; sets that do not exist have size 0."""
    sizes = sets.groupBy(*GROUP, "set_num").agg(F.count(F.lit(1)).alias("n_genes"))
    numbers = F.explode(F.sequence(F.lit(1), F.lit(n + 1))).alias("set_num")
    return expanded.select(*GROUP, numbers).join(sizes, [*GROUP, "set_num"], "left").fillna(0, ["n_genes"])


def extract_sequences(sets: DataFrame, sequences: DataFrame) -> DataFrame:
    """Records named in each gene set, all sets in one join."""
    return sets.join(sequences, "gene")


def unique_sequences(extracted: DataFrame) -> DataFrame:
    """Each record once, however many sets hold it."""
    return extracted.select("gene", "sequence").dropDuplicates(["gene", "sequence"])


def extended_hit_stats(touching: DataFrame, members: DataFrame, extended: DataFrame) -> DataFrame:
    """Member, extension and total gene counts of every family that has hits."""
    inside = members.select(*GROUP, "gene").distinct().groupBy(*GROUP).agg(F.count("gene").alias("n_members"))
    outside = extended.groupBy(*GROUP).agg(F.count("gene").alias("n_extended"))
    found = touching.select(*GROUP).distinct()
    return (
        found.join(inside, GROUP, "left")
        .join(outside, GROUP, "left")
        .fillna(0, ["n_members", "n_extended"])
        .withColumn("n_total", F.col("n_members") + F.col("n_extended"))
    )


def assemble_hypothesis(
    settings: DataFrame, table_sizes: DataFrame, extended: DataFrame, padded: DataFrame
) -> DataFrame:
    """One row per (hypothesis, hog): description, extended genes in order and set sizes.

    Nested parts are short by construction (n genes, n+1 sets). The hit table and the genes
    of the sets stay in their own flat tables, keyed the same way.
    """
    genes = extended.groupBy(*GROUP).agg(
        F.array_sort(F.collect_list(F.struct("rank", "gene"))).alias("extended_genes")
    )
    sets = padded.groupBy(*GROUP).agg(
        F.array_sort(F.collect_list(F.struct("set_num", "n_genes"))).alias("sets")
    )
    return (
        sets.join(genes, GROUP, "left")
        .join(table_sizes, GROUP, "left")
        .join(settings, "hypothesis", "left")
    )


def bitscore_normalise(hits: DataFrame, lengths: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bit scores relative to what their sequence lengths let expect, per species pair.

    The expectation is a straight line of log10 score on log10(len q x len s), fitted per
    group; ``lengths`` has seqid, species and seq_length.
    """
    def end(prefix: str) -> DataFrame:
        return lengths.select(
            F.col("seqid").alias(f"{prefix}seqid"),
            F.col("species").alias(f"{prefix}species"),
            F.col("seq_length").alias(f"{prefix}length"),
        )

    x = F.log10(F.col("qlength") * F.col("slength"))
    y = F.log10(F.col("bitscore"))
    scored = (
        hits.join(end("q"), "qseqid")
        .join(end("s"), "sseqid")
        .filter((F.col("bitscore") > 0) & (F.col("qlength") > 0) & (F.col("slength") > 0))
        .withColumns({"log_length": x, "log_score": y})
    )
    fit = scored.groupBy(*by).agg(
        F.regr_slope("log_score", "log_length").alias("slope"),
        F.regr_intercept("log_score", "log_length").alias("intercept"),
    )
    expected = F.pow(F.lit(10.0), F.col("slope") * F.col("log_length") + F.col("intercept"))
    return scored.join(fit, list(by)).withColumn("normalised", F.col("bitscore") / expected)
