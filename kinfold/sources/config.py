"""Species table, sample sheet and hypotheses.

These are small user-written settings. Hypotheses become plain Python objects, because
species lists decide which columns a plan has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.sources.tables import cells, parse_table

# Column names of the two tables and property names of the hypotheses file.
SPECIES_SCHEMA = (
    "species string, ploidy int, pep_fasta string, cDNA_fasta string, gen_fasta string, "
    "annotation string, function string"
)
SAMPLE_SCHEMA = (
    "species string, sample string, unit string, condition string, fq1 string, fq2 string, "
    "fragment_length_mean double, fragment_length_sd double"
)
HYPOTHESIS_PROPERTIES = [
    "hypothesis", "name", "expanded_in", "compared_to", "Nmin_expanded_in", "Nmin_compared_to",
    "min_expansion_factor", "min_expansion_difference", "Nmin_expanded_genes",
    "ploidy_normalization", "expanded_in_all_found", "compared_to_all_found",
]
GENERATED_ANNOTATION = "AHRD"


@dataclass(frozen=True)
class Hypothesis:
    """One question: which families grew in ``expanded_in`` against ``compared_to``?"""

    hypothesis: int
    name: str
    expanded_in: tuple[str, ...]
    compared_to: tuple[str, ...]
    min_expanded_in: int = 1
    min_compared_to: int = 1
    factor: float = 2.0
    difference: float = 10.0
    min_expanded_genes: int = 0
    ploidy_normalization: bool = False
    expanded_in_all_found: bool = False
    compared_to_all_found: bool = False

    @property
    def species(self) -> list[str]:
        return unique([*self.expanded_in, *self.compared_to])

    @property
    def key(self) -> str:
        return f"hypothesis_{self.hypothesis}"


def unique(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(names))


def all_hypothesis_species(hypotheses: Sequence[Hypothesis]) -> list[str]:
    """Every species of any hypothesis: first all expanded, then all compared ones."""
    expanded = [s for h in hypotheses for s in h.expanded_in]
    compared = [s for h in hypotheses for s in h.compared_to]
    return unique([*expanded, *compared])


def read_species(spark: SparkSession, path: str) -> DataFrame:
    return parse_species(spark.read.text(path))


def parse_species(lines: DataFrame) -> DataFrame:
    """Lines of the species table; its header is skipped."""
    return cells(lines, SPECIES_SCHEMA).filter(F.col("species") != "species")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return parse_samples(spark.read.text(path))


def parse_samples(lines: DataFrame) -> DataFrame:
    """Sample sheet; its header is skipped, and a repeated (sample, unit) is an error."""
    samples = cells(lines, SAMPLE_SCHEMA).filter(~((F.col("species") == "species") & (F.col("sample") == "sample")))
    twice = samples.groupBy("sample", "unit").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"repeated sample and unit: {[(r['sample'], r['unit']) for r in twice]}")
    return samples


def hypotheses_frame(spark: SparkSession, path: str) -> DataFrame:
    return parse_hypotheses(spark.read.text(path))


def parse_hypotheses(lines: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The transposed table as one typed row per hypothesis."""
    raw = parse_table(lines, columns)
    tidy = (
        raw.unpivot([raw.columns[0]], raw.columns[1:], "hypothesis_id", "value")
        .withColumnRenamed(raw.columns[0], "property")
        .groupBy("hypothesis_id")
        .pivot("property", HYPOTHESIS_PROPERTIES[1:])
        .agg(F.first("value"))
    )

    def yes(name: str):
        return F.coalesce(F.upper(F.trim(name)) == "YES", F.lit(False)).alias(name)

    def whole(name: str):
        return F.col(name).cast("double").cast("int").alias(name)

    return tidy.select(
        F.col("hypothesis_id").cast("int").alias("hypothesis"),
        F.regexp_replace("name", '^"|"$', "").alias("name"),
        F.split("expanded_in", ";").alias("expanded_in"),
        F.split("compared_to", ";").alias("compared_to"),
        whole("Nmin_expanded_in"),
        whole("Nmin_compared_to"),
        F.col("min_expansion_factor").cast("double"),
        F.col("min_expansion_difference").cast("double"),
        whole("Nmin_expanded_genes"),
        yes("ploidy_normalization"),
        yes("expanded_in_all_found"),
        yes("compared_to_all_found"),
    )


def read_hypotheses(spark: SparkSession, path: str) -> list[Hypothesis]:
    """Hypotheses as settings objects; ids must run 1..N."""
    rows = hypotheses_frame(spark, path).orderBy("hypothesis").collect()
    found = [
        Hypothesis(
            r["hypothesis"], r["name"], tuple(r["expanded_in"]), tuple(r["compared_to"]),
            r["Nmin_expanded_in"], r["Nmin_compared_to"],
            r["min_expansion_factor"], r["min_expansion_difference"],
            r["Nmin_expanded_genes"] or 0, r["ploidy_normalization"],
            r["expanded_in_all_found"], r["compared_to_all_found"],
        )
        for r in rows
    ]
    if [h.hypothesis for h in found] != list(range(1, len(found) + 1)):
        raise ValueError("hypothesis ids must run 1..N without gaps")
    return found


def ploidy_map(species: DataFrame) -> dict[str, int]:
    """Ploidy per species (one row per species of the settings table)."""
    return {r["species"]: r["ploidy"] for r in species.select("species", "ploidy").collect()}


def species_routes(species: DataFrame) -> DataFrame:
    """Which expression route a species takes, given the reference sequences it has."""
    return species.select(
        "species",
        F.col("gen_fasta").isNotNull().alias("genomic"),
        F.col("cDNA_fasta").isNotNull().alias("transcriptomic"),
        (F.col("gen_fasta").isNotNull() | F.col("cDNA_fasta").isNotNull()).alias("expressed"),
        (F.col("function") == GENERATED_ANNOTATION).alias("annotation_generated"),
    )


def samples_of_species(samples: DataFrame, species: DataFrame) -> DataFrame:
    return samples.join(species.select("species"), "species", "left_semi")


def sample_route(species: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples with their id, read layout and the route of their species."""
    routes = species_routes(species)
    return (
        samples.join(routes, "species", "left")
        .withColumn("sample_id", sample_id())
        .withColumn("layout", F.when(F.col("fq2").isNull(), "single").otherwise("paired"))
    )


def sample_id():
    return F.concat_ws("_", "sample", "unit")


def natural_sort(df: DataFrame, name: str) -> DataFrame:
    """Order by the number inside a name, so that hypothesis_10 follows hypothesis_2."""
    return df.orderBy(number_in(name).asc_nulls_last(), name)


def number_in(name: str):
    return F.regexp_extract(name, r"(\d+)", 1).try_cast("long")
