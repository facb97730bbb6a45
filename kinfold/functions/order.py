"""Ranks, running totals, medians and top-n that never sort one group in one task.

A group may hold a large part of all rows, so an order inside a group is split into
*buckets*: a bucket is a monotone function of the ordered value, each (group, bucket) is
sorted on its own, and small per-bucket totals carry the running value across buckets.
Buckets depend on the value alone, so a recomputed task always agrees with the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.session import cut_lineage, cut_measured

_SLOTS = 1024  # slices per power of two
_TIE_SLOTS = 32  # the same for the second key of an order, which only has to spread ties
_LAST = 1 << 40  # bucket of a missing value, behind all others


def value_bucket(value: Column, slots: int = _SLOTS) -> Column:
    """Monotone bucket of a finite number: its power of two, cut into equal slices."""
    v = value.cast("double")
    size = F.abs(v)
    power = F.floor(F.log2(size))
    slot = F.floor((size / F.pow(F.lit(2.0), power) - 1.0) * slots)
    place = (power + 1100) * slots + slot
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, place).otherwise(-place)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later expressions and filters use many times.

    They pass through a one-row generator. The optimizer copies a plain column's expression
    into every filter above it; it never does so with a generated one.
    """
    values = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows per group; Spark cuts each input partition to n before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def running_count(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Per distinct value of a group: its rows, the rows up to it, and the rows of the group.

    Returns ``by``, ``value``, ``n``, ``n_upto``, ``n_group`` and the ``bucket``.
    """
    by = list(by)
    per_value = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", value_bucket(F.col(value)))
    )
    whole = Window.partitionBy(*by)
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = (
        per_value.groupBy(*by, "bucket")
        .agg(F.sum("n").alias("bucket_n"))
        .select(
            *by,
            "bucket",
            F.coalesce(F.sum("bucket_n").over(before), F.lit(0)).alias("offset"),
            F.sum("bucket_n").over(whole).alias("n_group"),
        )
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(value)
    return (
        per_value.withColumn("inside", F.sum("n").over(inside))
        .join(per_bucket, [*by, "bucket"])
        .select(*by, value, "n", (F.col("offset") + F.col("inside")).alias("n_upto"), "n_group", "bucket")
    )


def running_total(df: DataFrame, by: Sequence[str], position: str, value: Column, out: str, width: int = 4096) -> DataFrame:
    """Sum of ``value`` over the rows of a group up to each whole-numbered, unique ``position``.

    Positions are cut into slices of ``width``; a slice is summed on its own, after the totals of the slices before it.
    """
    by = list(by)
    cut = df.withColumns({"_slice": F.floor(F.col(position) / width), "_v": value})
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*by, "_slice").agg(F.sum("_v").alias("_n")).select(
        *by, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(position)
    summed = cut.withColumn("_in", F.sum("_v").over(inside)).join(offsets, [*by, "_slice"])
    return summed.withColumn(out, F.col("_off") + F.col("_in")).drop("_slice", "_v", "_in", "_off")


def exact_median(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median per group from running counts: at most two values per group survive."""
    middle = running_count(df, by, value).filter(
        (F.col("n_upto") - F.col("n") < F.floor((F.col("n_group") + 2) / 2))
        & (F.col("n_upto") >= F.floor((F.col("n_group") + 1) / 2))
    )
    return middle.groupBy(*by).agg(((F.min(value) + F.max(value)) / 2).alias(out))


def full_rank(
    df: DataFrame, by: Sequence[str], first: str, second: str, order: Sequence[Column], rank: str = "rank", heavy: int = 1 << 20
) -> DataFrame:
    """Row number per group over ``order``: ascending ``first``, then descending ``second``, then the rest.

    Missing values of both come last, whatever null order ``order`` names for the rest. Groups of up to ``heavy`` rows are
    sorted as they are; larger ones are cut by ``first``, and rows tied in it by ``second``, so that neither has to fit one task.
    """
    by = list(by)
    by_value = [F.col(first).asc_nulls_last(), F.col(second).desc_nulls_last(), *order]
    rows = cut_lineage(df)
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > heavy).select(*by)
    large, found = cut_measured(sizes, rows=F.count(F.lit(1)))
    if not found["rows"]:
        return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*by_value)))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    light = rows.alias("l").join(large.alias("r"), same, "left_anti")
    return light.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*by_value))).unionByName(
        _cut_rank(rows.alias("l").join(large.alias("r"), same, "left_semi"), by, first, second, order, rank)
    )


def _cut_rank(df: DataFrame, by: list[str], first: str, second: str, order: Sequence[Column], rank: str) -> DataFrame:
    """full_rank of groups that are too large to be sorted in one task."""
    missing = F.lit(_LAST).cast("long")
    cut = df.withColumn("_b1", F.coalesce(value_bucket(F.col(first)), missing)).withColumn(
        "_b2", F.coalesce(-value_bucket(F.col(second), _TIE_SLOTS), missing)
    )
    before = Window.partitionBy(*by).orderBy("_b1", "_b2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*by, "_b1", "_b2")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_b1", "_b2", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    inside = Window.partitionBy(*by, "_b1", "_b2").orderBy(*order)
    return (
        cut.withColumn("_in", F.row_number().over(inside))
        .join(offsets, [*by, "_b1", "_b2"])
        .withColumn(rank, F.col("_off") + F.col("_in"))
        .drop("_b1", "_b2", "_in", "_off")
    )
