"""Labelled rows for fitting: a bounded sample, the same one on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, mod: int, held_out: int, extra: tuple[str, ...] = ()
) -> DataFrame:
    """At most ``max_rows`` labelled documents for fitting: ``doc_id, text, label`` and ``extra`` columns.

    max_rows is the documented bound of every classifier here. The rows with the smallest
    hashes of their ids are taken, so the choice depends on nothing but the ids. Rows whose
    crc32 remainder is ``held_out``, null labels and null ids never take part. A doc_id with several labels
    counts once with its largest, a repeated document once.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (crc_remainder(F.col("doc_id"), mod) != held_out))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = docs.select("doc_id", "text", *extra).join(F.broadcast(chosen), "doc_id")
    return rows.dropDuplicates(["doc_id"])
