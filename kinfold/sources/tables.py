"""Tabular inputs: hits, id maps, orthogroups, annotation, counts, estimates, family p-values.

Each ``read_*`` is a text scan followed by its ``parse_*``, which takes lines from anywhere: a column ``value`` and, where
the name of a file means something, ``file_path``. Blank lines are skipped.
"""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.names import file_stem, first_word, safe_id

# Column layouts and required names of the file formats.
HIT_SCHEMA = (
    "qseqid string, sseqid string, pident double, length double, mismatch double, gapopen double, "
    "qstart double, qend double, sstart double, send double, evalue double, bitscore double"
)
COUNT_KEYS = ["Geneid", "Chr", "Start", "End", "Strand", "Length"]
QUANT_SCHEMA = "target_id string, length double, eff_length double, est_counts double, tpm double"
ACCESSION = "Protein-Accession"
TERMS = "Gene-Ontology-Term"
QUALITY_CODE = "AHRD-Quality-Code"


def cells(lines: DataFrame, schema: str) -> DataFrame:
    """Tab-separated lines as typed columns, then the other columns of ``lines``; empty cells are null."""
    others = [c for c in lines.columns if c != "value"]
    row = F.from_csv("value", schema, {"sep": "\t"})
    return lines.filter(F.trim("value") != "").select(row.alias("row"), *others).select("row.*", *others)


def parse_table(lines: DataFrame, columns: Sequence[str] | None = None, comment: str | None = None) -> DataFrame:
    """Lines under a header as text columns. The first line is the header unless its columns are given; repeats of it are skipped."""
    lines = lines.filter(F.trim("value") != "")
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    if columns is None:
        first = lines.select("value").first()
        if first is None:
            raise ValueError("a table without a header")
        header = first["value"]
        columns = [c.strip().strip('"') for c in header.split("\t")]
    bare = F.translate("value", '"', "")
    return cells(lines.filter(bare != "\t".join(columns)), ", ".join(f"`{c}` string" for c in columns))


def read_hits(spark: SparkSession, glob: str | Sequence[str]) -> DataFrame:
    """All tabular hit files as one table."""
    return parse_hits(spark.read.text(glob))


def parse_hits(lines: DataFrame) -> DataFrame:
    return cells(lines, HIT_SCHEMA)


def read_id_map(spark: SparkSession, path: str, mode: str = "plain") -> DataFrame:
    return parse_id_map(spark.read.text(path), mode)


def parse_id_map(lines: DataFrame, mode: str = "plain") -> DataFrame:
    """``id: name`` lines.

    plain keeps the word after the id; full keeps the whole rest with reserved characters
    replaced; first_word keeps its first word, which must then be unique per species (the
    part of the id before "_"). Except in plain mode a repeated id is an error.
    """
    split = lines.filter(F.trim("value") != "").select(
        F.trim(F.translate(F.substring_index("value", ": ", 1), "#", "")).alias("seqid"),
        F.rtrim(F.regexp_replace("value", r"^[^:]*: ", "")).alias("rest"),
    )
    if mode == "plain":
        return split.select(F.translate("seqid", ":", "").alias("seqid"), first_word(F.col("rest")).alias("name"))
    if mode not in ("full", "first_word"):
        raise ValueError(f"unknown id map mode {mode!r}")
    text = F.col("rest") if mode == "full" else first_word(F.col("rest"))
    ids = split.select("seqid", safe_id(text).alias("name"))
    _reject_repeats(ids, [F.col("seqid")], "id")
    if mode == "first_word":
        _reject_repeats(ids, [F.substring_index("seqid", "_", 1).alias("species"), F.col("name")], "accession")
    return ids


def _reject_repeats(df: DataFrame, by: list, what: str) -> None:
    twice = df.groupBy(*by).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"repeated {what}: {twice[0].asDict()}")


def read_orthogroups(spark: SparkSession, path: str) -> DataFrame:
    """Wide orthogroup table; empty cells are missing."""
    return parse_table(spark.read.text(path))


def annotation_problems(columns: Sequence[str]) -> list[str]:
    return [c for c in (ACCESSION, TERMS) if c not in columns]


def read_annotation(spark: SparkSession, paths: Mapping[str, str], generated: bool = False) -> DataFrame:
    """Per-species annotation tables under one schema: species, gene, terms and free columns.

    Generated tables start with a comment and a blank line and hold a quality column that is
    dropped; user tables start with their header. ``paths`` maps species to files.
    """
    combined = None
    for species, path in paths.items():
        df = parse_annotation(spark.read.text(path), species, generated)
        combined = df if combined is None else combined.unionByName(df, allowMissingColumns=True)
    return combined


def parse_annotation(lines: DataFrame, species: str, generated: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """One species' annotation table under the common schema."""
    df = parse_table(lines, columns, "#" if generated else None)
    missing = annotation_problems(df.columns)
    if missing:
        raise ValueError(f"annotation of {species} lacks {missing}")
    return (
        df.drop(QUALITY_CODE)
        .withColumnsRenamed({ACCESSION: "gene", TERMS: "terms"})
        .withColumn("species", F.lit(species))
    )


def species_of_path(path: str) -> str:
    """Species a per-species file is named after: the part before the first dot."""
    return posixpath.basename(path).split(".", 1)[0]


def read_count_files(spark: SparkSession, glob: str | Sequence[str]) -> DataFrame:
    return parse_count_files(spark.read.text(glob).select("value", "_metadata.file_path"))


def parse_count_files(lines: DataFrame) -> DataFrame:
    """Per-sample count files as (sample, gene, chrom, start, end, strand, length, count).

    The comment line is skipped; the sample is named by the file.
    """
    schema = ", ".join(f"`{c}` string" for c in [*COUNT_KEYS, "count"])
    rows = cells(lines.filter(~F.col("value").startswith("#")), schema)
    return rows.filter(F.col("Geneid") != COUNT_KEYS[0]).select(
        file_stem(F.col("file_path"), r"_counts\.[^/]*").alias("sample"),
        F.col("Geneid").alias("gene"),
        F.col("Chr").alias("chrom"),
        F.col("Start").alias("start"),
        F.col("End").alias("end"),
        F.col("Strand").alias("strand"),
        F.col("Length").cast("long").alias("length"),
        F.col("count").cast("long").alias("count"),
    )


def read_quant(spark: SparkSession, glob: str | Sequence[str]) -> DataFrame:
    return parse_quant(spark.read.text(glob).select("value", "_metadata.file_path"))


def parse_quant(lines: DataFrame) -> DataFrame:
    """Per-sample transcript estimates; the sample is the folder that holds the file."""
    rows = cells(lines, QUANT_SCHEMA)
    return rows.filter(F.col("target_id") != "target_id").select(
        F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1).alias("sample"),
        F.col("target_id").alias("transcript_id"),
        F.col("est_counts").alias("count"),
        F.col("tpm").alias("abundance"),
        F.col("eff_length").alias("length"),
    )


def read_family_pvalues(spark: SparkSession, path: str) -> DataFrame:
    return parse_family_pvalues(spark.read.text(path))


def parse_family_pvalues(lines: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """First two columns of the model fit's result: family and p-value."""
    rows = parse_table(lines, columns)
    family, p = rows.columns[:2]
    return rows.select(F.col(f"`{family}`").alias("hog"), F.col(f"`{p}`").try_cast("double").alias("pvalue"))


def read_fit_rate(spark: SparkSession, path: str) -> float | None:
    """Rate estimate in the text report of the first model fit (one small file)."""
    found = (
        spark.read.text(path)
        .select(F.regexp_extract("value", r"Lambda: (\S+)", 1).alias("rate"))
        .filter("rate <> ''").limit(1).collect()
    )
    return float(found[0]["rate"]) if found else None
