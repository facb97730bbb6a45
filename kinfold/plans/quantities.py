"""Queries on counts and the two-group test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import counts
from kinfold.plans.domain import CONDITION, SAMPLES, Domain
from kinfold.plans.registry import big, fragment, query, r6

fragment("grid", """
SELECT g.gene, s.sample, coalesce(c.count, 0) AS count FROM (SELECT DISTINCT gene FROM counts) g
CROSS JOIN (SELECT DISTINCT sample FROM counts) s LEFT JOIN counts c ON c.gene = g.gene AND c.sample = s.sample""", "counts")
fragment("factors", """
SELECT sample, exp(median(ln(count) - m)) AS f FROM grid
JOIN (SELECT gene, avg(ln(count)) AS m FROM grid GROUP BY 1 HAVING min(count) > 0) USING (gene) GROUP BY 1""".replace(
    "avg(ln(count))", "avg(CASE WHEN count > 0 THEN ln(count) END)"), "grid")
fragment("dispersed", """
SELECT gene, avg(count / f) AS mean, var_samp(count / f) AS var,
  greatest(1e-8, coalesce((var_samp(count / f) - avg(count / f) * avg(1 / f)) / nullif(avg(count / f) * avg(count / f), 0), 1e-8)) AS alpha
FROM grid JOIN factors USING (sample) GROUP BY 1""", "grid", "factors")


def rows_with_factors(d: Domain) -> DataFrame:
    rows = counts.count_rows(d.counts, SAMPLES)
    return counts.with_factors(rows, counts.size_factors(rows, SAMPLES), SAMPLES)


@query("count_features", """
WITH e AS (SELECT event_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s,
  CASE WHEN event_id % 7 = 0 THEN 20100 ELSE 100 END AS n FROM events),
a AS (SELECT event_id // 2 AS read_id, event_type, 1 AS hit, s, s + n AS e FROM e UNION ALL
  SELECT event_id // 2, event_type, 2, s + 3600, s + 3600 + n FROM e WHERE event_id % 5 = 0),
x AS (SELECT DISTINCT event_type, s // 3600 * 3600 AS h FROM e)
SELECT 's' || (a.read_id % 3) AS sample, x.event_type || '_' || (x.h // 7200) AS gene_id, count(DISTINCT (a.read_id, a.hit)) AS count FROM a
JOIN x ON a.event_type = x.event_type AND a.s <= x.h + 1799 AND x.h <= a.e GROUP BY 1, 2
""".replace("WITH e AS", "SELECT * FROM (WITH e AS") + ")")
def _(d: Domain) -> DataFrame:
    return counts.count_features(d.alignments, d.exons).select("sample", "gene_id", "count")


@query("merge_counts", """
SELECT gene, max(count) FILTER (sample = 'A_F') AS "A_F", max(count) FILTER (sample = 'A_O') AS "A_O",
  max(count) FILTER (sample = 'N_F') AS "N_F", max(count) FILTER (sample = 'N_O') AS "N_O",
  max(count) FILTER (sample = 'R_F') AS "R_F", max(count) FILTER (sample = 'R_O') AS "R_O" FROM counts GROUP BY 1""", "counts")
def _(d: Domain) -> DataFrame:
    return counts.merge_counts(d.counts, SAMPLES)


@query("tx2gene", "SELECT DISTINCT 'p' || p_partkey AS transcript_id, p_brand AS gene_id FROM part")
def _(d: Domain) -> DataFrame:
    from kinfold.sources.features import attributes, tx2gene

    text = F.concat(
        F.lit('gene_id "'), F.col("p_brand"), F.lit('"; transcript_id "p'), F.col("p_partkey").cast("string"), F.lit('";')
    )
    return tx2gene(d.table("part").select(attributes(text).alias("attributes")))


@query("tx_to_gene", """
SELECT sample, p_brand AS gene, CAST(sum(count) AS BIGINT) AS count, round(sum(p_size), 6)::DOUBLE AS abundance,
  round(coalesce(sum(p_retailprice * p_size) / nullif(sum(p_size), 0), avg(p_retailprice)), 6) AS length
FROM counts JOIN part ON gene = 'p' || p_partkey GROUP BY 1, 2""", "counts")
def _(d: Domain) -> DataFrame:
    part = d.table("part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("transcript_id"),
        F.col("p_brand").alias("gene_id"), F.col("p_size").cast("double").alias("abundance"),
        F.col("p_retailprice").alias("length"),
    )
    quant = d.counts.withColumnRenamed("gene", "transcript_id").join(
        part.select("transcript_id", "abundance", "length"), "transcript_id"
    )
    genes = counts.tx_to_gene(quant, part.select("transcript_id", "gene_id"))
    return genes.select("sample", "gene", "count", r6("abundance"), r6("length"))


@query("design_check", "SELECT 'x_F' AS sample, 'design' AS only_in UNION ALL SELECT DISTINCT sample, 'matrix' FROM counts WHERE sample = 'R_O'",
       "counts")
def _(d: Domain) -> DataFrame:
    return counts.design_check(d.counts, [*SAMPLES[:5], "x_F"])


@query("size_factors", "SELECT sample, round(f, 6) AS size_factor FROM factors", "factors")
def _(d: Domain) -> DataFrame:
    return counts.size_factors(counts.count_rows(d.counts, SAMPLES), SAMPLES).select("sample", r6("size_factor"))


@query("gene_dispersion", """
SELECT gene, round(mean, 6) AS "baseMean", round(var, 4) AS variance, round(alpha, 6) AS dispersion FROM dispersed""", "dispersed")
def _(d: Domain) -> DataFrame:
    rows = counts.gene_dispersion(rows_with_factors(d), SAMPLES)
    return rows.select("gene", r6("baseMean"), F.round("variance", 4).alias("variance"), r6("dispersion"))


@query("de_test")
def _(d: Domain) -> DataFrame:
    rows = counts.group_dispersion(rows_with_factors(d), SAMPLES, CONDITION)
    tested = counts.de_test(rows, SAMPLES, CONDITION).withColumn("species", F.lit("one"))
    return counts.bh_adjust(tested)


@query("bh_adjust", """
SELECT species, gene, round(padj, 6) AS padj FROM (
  SELECT species, gene, min(least(1.0, pvalue * m / r)) OVER (PARTITION BY species ORDER BY pvalue DESC) AS padj FROM (
    SELECT species, gene, pvalue, count(*) OVER (PARTITION BY species) AS m,
      count(*) OVER (PARTITION BY species ORDER BY pvalue) AS r FROM de))""", "de")
def _(d: Domain) -> DataFrame:
    return counts.bh_adjust(d.de.select("species", "gene", "pvalue")).select("species", "gene", r6("padj"))


@query("running_count", """
SELECT DISTINCT species, pvalue, count(*) OVER (PARTITION BY species, pvalue) AS n,
  count(*) OVER (PARTITION BY species ORDER BY pvalue) AS n_upto FROM de""", "de")
def _(d: Domain) -> DataFrame:
    return counts.running_count(d.de, ["species"], "pvalue").select("species", "pvalue", big("n"), big("n_upto"))
