"""Writers of the result tables and of the files other tools read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_family_table(table: DataFrame, path: str) -> None:
    """Input table of the family-size model fit, tab separated with a header."""
    table.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_gene_sets(sets: DataFrame, path: str) -> None:
    """Id lists, one folder per (hypothesis, hog, set_num).

    Rebalancing puts a small set in one file and lets a very large one have several.
    """
    keys = ["hypothesis", "hog", "set_num"]
    sets.select(*keys, "gene").hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).text(path)


def write_results(tables: Mapping[str, DataFrame], folder: str) -> None:
    """All result tables, one Parquet dataset each."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
