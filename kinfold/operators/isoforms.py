"""Choosing one sequence per gene, and reports about FASTA headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.names import GENE_NAME, is_refseq_header
from kinfold.functions.order import top_n


def file_modes(seqs: DataFrame) -> DataFrame:
    """Naming mode of each file, told by its first header: refseq or tag."""
    first = seqs.groupBy("file").agg(F.min_by("header", "ord").alias("header"))
    return first.select("file", F.when(is_refseq_header(F.col("header")), "refseq").otherwise("tag").alias("mode"))


def with_gene(seqs: DataFrame, mode: str) -> DataFrame:
    """Gene name by one mode for all files, or (``mode="auto"``) by each file's own, which ``mode`` then names."""
    if mode != "auto":
        return seqs.withColumn("gene", GENE_NAME[mode](F.col("header")))
    header = F.col("header")
    by_file = F.when(F.col("mode") == "refseq", GENE_NAME["refseq"](header)).otherwise(GENE_NAME["tag"](header))
    return seqs.join(file_modes(seqs), "file").withColumn("gene", by_file)


def longest_isoform(seqs: DataFrame, mode: str = "tag") -> DataFrame:
    """Longest record per (file, gene), the first one on ties; unidentified records all stay.

    In tag mode the header of a chosen record becomes the gene name. ``mode="auto"`` tells the mode of
    each file by its first header.
    """
    named = with_gene(seqs, mode).withColumn("seq_length", F.length("sequence"))
    order = [F.col("seq_length").desc(), F.col("ord").asc()]
    identified = named.filter(F.col("gene").isNotNull() & (F.col("seq_length") > 0))
    chosen = top_n(identified, ["file", "gene"], order, 1).drop("rank")
    if mode in ("tag", "auto"):
        tagged = F.lit(True) if mode == "tag" else F.col("mode") == "tag"
        chosen = chosen.withColumn("header", F.when(tagged, F.col("gene")).otherwise(F.col("header")))
    return chosen.unionByName(named.filter(F.col("gene").isNull()))


def duplicate_headers(seqs: DataFrame, by: Sequence[str] = ("file", "header")) -> DataFrame:
    return seqs.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def header_tags(header: Column) -> Column:
    """The tag:id words of a header as an array of structs."""
    tagged = F.filter(F.split(F.trim(header), r"\s+"), lambda w: F.contains(w, F.lit(":")))
    return F.transform(
        tagged,
        lambda w: F.struct(
            F.substring_index(w, ":", 1).alias("tag"),
            F.regexp_replace(w, r"^[^:]*:", "").alias("id"),
        ),
    )


def header_tag_stats(seqs: DataFrame, n: int = 5) -> DataFrame:
    """The n most common ids of each header tag."""
    counts = seqs.select(F.inline(header_tags(F.col("header")))).groupBy("tag", "id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return top_n(counts, ["tag"], [F.col("n").desc(), F.col("id").asc()], n)


def gene_name_stats(seqs: DataFrame, mode: str) -> DataFrame:
    """Sequences and distinct gene names per file; a missing name counts as one name."""
    names = with_gene(seqs, mode).groupBy("file", "gene").agg(F.count(F.lit(1)).alias("n"))
    return names.groupBy("file").agg(
        F.sum("n").alias("n_sequences"), F.count(F.lit(1)).alias("n_genes")
    )


def longest_protein_of_gene(links: DataFrame) -> DataFrame:
    """Longest linked protein per gene; the first linked one on ties."""
    order = [F.col("seq_length").desc(), F.col("ord").asc()]
    return top_n(links, ["gene"], order, 1).drop("rank")


def sequences_per_species(seqs: DataFrame, species: Sequence[str]) -> DataFrame:
    """Record counts, and for the chosen species (in order) where their numbering starts."""
    per_species = seqs.groupBy("species").agg(F.count(F.lit(1)).alias("n_sequences"))
    place = F.array_position(F.array(*[F.lit(s) for s in species]), F.col("species"))
    placed = per_species.withColumn("place", F.nullif(place, F.lit(0)))
    chosen = F.when(F.col("place").isNotNull(), F.col("n_sequences"))
    before = Window.partitionBy(F.col("place").isNull()).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.when(F.col("place").isNotNull(), F.coalesce(F.sum(chosen).over(before), F.lit(0)))
    return placed.select("species", "n_sequences", start.alias("start"))
