"""Gene feature files in both attribute dialects, as one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted suffixes and the nine columns.
SUFFIXES = (".gff", ".gff3", ".gtf", ".gff.gz", ".gff3.gz", ".gtf.gz")
FEATURE_SCHEMA = (
    "chrom string, source string, type string, start long, end long, score string, "
    "strand string, frame string, attribute_text string"
)


def attributes(text: Column) -> Column:
    """``key "value";`` and ``key=value;`` lists as a map; the first of a repeated key counts."""
    items = F.filter(F.transform(F.split(text, ";"), lambda item: F.trim(item)), lambda item: item != "")
    entries = F.transform(
        items,
        lambda item: F.struct(
            F.regexp_extract(item, r"^([^=\s]+)", 1).alias("key"),
            F.regexp_replace(F.regexp_replace(item, r"^[^=\s]+\s*[=\s]\s*", ""), '^"|"$', "").alias("value"),
        ),
    )
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    values = F.transform(keys, lambda k: F.get(F.filter(entries, lambda e: e["key"] == k), F.lit(0))["value"])
    return F.map_from_arrays(keys, values)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    if not path.endswith(SUFFIXES):
        raise ValueError(f"{path}: expected one of {', '.join(SUFFIXES)}")
    return parse_features(spark.read.text(path))


def parse_features(lines: DataFrame) -> DataFrame:
    """Feature lines of either dialect; comments and lines without a start are skipped. Quotes belong to the attributes."""
    text = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    row = F.from_csv("value", FEATURE_SCHEMA, {"sep": "\t", "quote": ""})
    rows = text.select(row.alias("row")).select("row.*")
    return rows.filter(F.col("start").isNotNull()).withColumn("attributes", attributes(F.col("attribute_text"))).drop(
        "attribute_text"
    )


def tx2gene(features: DataFrame) -> DataFrame:
    """Distinct transcript -> gene pairs."""
    return (
        features.select(
            F.col("attributes")["transcript_id"].alias("transcript_id"), F.col("attributes")["gene_id"].alias("gene_id")
        )
        .filter(F.col("transcript_id").isNotNull() & F.col("gene_id").isNotNull())
        .distinct()
    )


def exons(features: DataFrame, key: str = "gene_id") -> DataFrame:
    """Exon intervals with the attribute reads are counted by."""
    return features.filter(F.col("type") == "exon").select(
        "chrom", "start", "end", F.col("attributes")[key].alias(key)
    ).filter(F.col(key).isNotNull())
