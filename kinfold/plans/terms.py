"""Queries on functional annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.stats import with_hypergeom_upper
from kinfold.operators import annotation
from kinfold.plans.domain import FDR, HYPOTHESES, Domain
from kinfold.plans.registry import big, fragment, query, r6

fragment("cleaned", """
SELECT species, gene, regexp_replace(terms, '(NA, )|(, NA)', '', 'g') AS terms FROM annotation
WHERE NOT contains(regexp_replace(terms, '(NA, )|(, NA)', '', 'g'), 'NA')""", "annotation")
fragment("term_genes", "SELECT species, gene, unnest(string_split(terms, ', ')) AS term FROM cleaned", "cleaned")
fragment("enrichment", """
WITH calls AS (SELECT species, gene, padj <= 0.1 AS hit FROM de),
u AS (SELECT c.species, count(*) AS big_n, count(*) FILTER (hit) AS hits FROM cleaned c
  LEFT JOIN calls USING (species, gene) GROUP BY 1),
t AS (SELECT g.species, g.term, count(*) AS annotated, count(*) FILTER (hit) AS significant, count(calls.gene) AS seen
  FROM term_genes g LEFT JOIN calls ON g.species = calls.species AND g.gene = calls.gene GROUP BY 1, 2),
gate AS (SELECT species FROM de WHERE padj < 0.1 GROUP BY 1 HAVING count(*) >= 10)
SELECT t.species, term, annotated, significant, annotated * hits / big_n AS expected,
  CASE WHEN significant <= greatest(0, annotated - (big_n - hits)) THEN 1.0 ELSE
  least(1.0, list_sum(list_transform(range(significant, least(annotated, hits) + 1), lambda k:
    exp(lgamma(hits + 1) - lgamma(k + 1) - lgamma(hits - k + 1) + lgamma(big_n - hits + 1) - lgamma(annotated - k + 1)
      - lgamma(big_n - hits - annotated + k + 1) - lgamma(big_n + 1) + lgamma(annotated + 1)
      + lgamma(big_n - annotated + 1))))) END AS p_value
FROM t JOIN u USING (species) SEMI JOIN gate ON t.species = gate.species WHERE seen > 0""", "cleaned", "term_genes", "de")


@query("clean_terms", "SELECT species, gene, terms FROM cleaned", "cleaned")
def _(d: Domain) -> DataFrame:
    return annotation.clean_terms(d.annotation)


@query("gene_to_terms", """
SELECT species, gene, len(string_split(terms, ', ')) AS n_terms, string_split(terms, ', ')[1] AS first FROM cleaned""", "cleaned")
def _(d: Domain) -> DataFrame:
    return annotation.gene_to_terms(d.annotation).select(
        "species", "gene", big(F.size("terms"), "n_terms"), F.get("terms", F.lit(0)).alias("first")
    )


@query("terms_expressed", """
SELECT species, gene, terms FROM annotation WHERE species <> 'MIDDLE_EAST'""", "annotation")
def _(d: Domain) -> DataFrame:
    return annotation.terms_expressed(d.annotation, d.de).select("species", "gene", "terms")


@query("genes_per_term", """
SELECT species, term, gene FROM term_genes WHERE species <> 'MIDDLE_EAST'""", "term_genes")
def _(d: Domain) -> DataFrame:
    return annotation.genes_per_term(d.annotation, d.de)


@query("annotation_with_hog", """
SELECT a.species, a.gene, hog, terms FROM annotation a LEFT JOIN hog_genes h ON a.gene = h.gene""", ("annotation", "hog_genes"))
def _(d: Domain) -> DataFrame:
    return annotation.annotation_with_hog(d.annotation, d.hog_genes).select("species", "gene", "hog", "terms")


@query("hog_terms", """
SELECT hypothesis, hog, string_agg(term, ', ' ORDER BY term) AS terms FROM (
  SELECT DISTINCT v.hypothesis, coalesce(h.hog, 'singleton_' || t.gene) AS hog, term FROM term_genes t
  LEFT JOIN hog_genes h ON t.gene = h.gene
  JOIN (VALUES (1, 'AFRICA'), (1, 'AMERICA'), (1, 'ASIA'), (2, 'AFRICA'), (2, 'EUROPE'), (2, 'AMERICA'),
    (3, 'AFRICA'), (3, 'AMERICA'), (3, 'ASIA'), (3, 'MIDDLE_EAST'), (4, 'ASIA'), (4, 'MIDDLE_EAST')) v(hypothesis, species)
    ON t.species = v.species) GROUP BY 1, 2""", ("term_genes", "hog_genes"))
def _(d: Domain) -> DataFrame:
    return annotation.hog_terms(annotation.annotation_with_hog(d.annotation, d.hog_genes), HYPOTHESES)


@query("unique_terms", "SELECT DISTINCT term FROM term_genes", "term_genes")
def _(d: Domain) -> DataFrame:
    return annotation.unique_terms(d.annotation)


@query("collapse_terms", """
SELECT species, string_agg(term, ', ' ORDER BY term) AS terms FROM (SELECT DISTINCT species, term FROM term_genes) GROUP BY 1""",
       "term_genes")
def _(d: Domain) -> DataFrame:
    return annotation.collapse_terms(d.annotation)


@query("truth_set_overlap", """
SELECT DISTINCT term FROM term_genes WHERE term IN (SELECT p_brand FROM part WHERE p_size > 40)""", "term_genes")
def _(d: Domain) -> DataFrame:
    truth = d.table("part").filter("p_size > 40").select(F.col("p_brand").alias("term"))
    return annotation.truth_set_overlap(annotation.unique_terms(d.annotation), truth)


@query("restrict_to_ontology", """
SELECT species, gene, term FROM term_genes WHERE term IN (SELECT p_brand FROM part WHERE p_type = 'PROMO')""", "term_genes")
def _(d: Domain) -> DataFrame:
    ontology = d.table("part").filter("p_type = 'PROMO'").select(F.col("p_brand").alias("term"))
    return annotation.restrict_to_ontology(annotation.term_members(d.annotation), ontology).select("species", "gene", "term")


@query("enrichment_gate", """
SELECT species, count(*) FILTER (padj < 0.1) AS n_significant FROM de GROUP BY 1 HAVING count(*) FILTER (padj < 0.1) >= 200""", "de")
def _(d: Domain) -> DataFrame:
    return annotation.enrichment_gate(d.de, FDR, 200)


@query("term_enrichment", """
SELECT species, term, annotated, significant, round(expected, 6) AS expected, round(p_value, 6) AS p_value FROM enrichment""",
       "enrichment")
def _(d: Domain) -> DataFrame:
    found = annotation.term_enrichment(d.annotation, d.de, FDR)
    return found.select("species", "term", "annotated", big("significant"), r6("expected"), r6("p_value"))


@query("top_terms", """
SELECT species, term, rank FROM (SELECT *, row_number() OVER (PARTITION BY species
  ORDER BY round(p_value, 9), annotated DESC, term) AS rank FROM enrichment) WHERE rank <= 5""", "enrichment")
def _(d: Domain) -> DataFrame:
    found = annotation.term_enrichment(d.annotation, d.de, FDR).withColumn("p_value", F.round("p_value", 9))
    return annotation.top_terms(found, 5).select("species", "term", big("rank"))


@query("term_scores", """
SELECT t.species, t.term, count(*) AS n_genes, round(round(avg("log2FoldChange"), 9), 6) AS mean_change,
  round((count(*) FILTER ("log2FoldChange" > 0) - count(*) FILTER ("log2FoldChange" < 0)) / sqrt(count(*)), 6) AS z_score
FROM term_genes t JOIN de ON t.species = de.species AND t.gene = de.gene GROUP BY 1, 2 HAVING count(*) >= 2""",
       ("term_genes", "de"))
def _(d: Domain) -> DataFrame:
    scores = annotation.term_scores(annotation.term_members(d.annotation), d.de)
    # Means of hundredths often end in an exact 5 at the seventh decimal; the ninth hides the order of the sum.
    return scores.select("species", "term", "n_genes", r6(F.round("mean_change", 9), "mean_change"), r6("z_score"))


@query("term_ancestors", """
SELECT species, term, count(DISTINCT gene) AS n_genes FROM (
  SELECT species, term, gene FROM term_genes UNION ALL
  SELECT g.species, p.p_type, g.gene FROM term_genes g JOIN (SELECT DISTINCT p_brand, p_type FROM part) p ON g.term = p.p_brand)
GROUP BY 1, 2""", "term_genes")
def _(d: Domain) -> DataFrame:
    up = d.table("part").select(F.col("p_brand").alias("term"), F.col("p_type").alias("ancestor")).distinct()
    wide = annotation.with_ancestors(annotation.term_members(d.annotation), up)
    return wide.groupBy("species", "term").agg(F.count("gene").alias("n_genes"))


@query("random_sample", "SELECT gene FROM annotation ORDER BY md5(gene || '|7'), gene LIMIT 100", "annotation")
def _(d: Domain) -> DataFrame:
    return annotation.random_sample(d.annotation.select("gene"), "gene", 100, seed=7)


@query("random_sample_share", """
SELECT gene, species FROM annotation ORDER BY md5(gene || '|8'), gene LIMIT (SELECT count(*) // 10 FROM annotation)""", "annotation")
def _(d: Domain) -> DataFrame:
    genes = d.annotation.select("gene", "species")
    return annotation.random_sample(genes, "gene", genes.count() // 10, seed=8, last=100)


@query("tail_at_half_the_hits", """
WITH t AS (SELECT p_brand AS term, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS k FROM lineitem
  JOIN part ON l_partkey = p_partkey GROUP BY 1),
u AS (SELECT sum(n)::BIGINT AS total, sum(k)::BIGINT AS w FROM t),
r AS (SELECT term, n, w, total - w AS b, unnest([k // 2, k, k + k // 10]) AS x FROM t, u)
SELECT term, x, round(CASE WHEN x <= greatest(0, n - b) THEN 1.0 ELSE least(1.0, list_sum(list_transform(
  range(x, least(n, w) + 1), lambda i: exp(lgamma(w + 1) - lgamma(i + 1) - lgamma(w - i + 1) + lgamma(b + 1) - lgamma(n - i + 1)
    - lgamma(b - n + i + 1) - lgamma(w + b + 1) + lgamma(n + 1) + lgamma(w + b - n + 1))))) END, 6) AS p_value FROM r""")
def _(d: Domain) -> DataFrame:
    """Terms with half their hits are strongly depleted: the tail is 1, however large the urn is."""
    rows = d.table("lineitem").join(d.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    terms = rows.groupBy(F.col("p_brand").alias("term")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("k")
    )
    urn = terms.agg(F.sum("n").alias("total"), F.sum("k").alias("w"))
    k = F.col("k")
    cases = F.explode(F.array(F.floor(k / 2), k, k + F.floor(k / 10))).alias("x")
    asked = terms.select("term", "n", cases).crossJoin(F.broadcast(urn))  # the urn is one row
    black = (F.col("total") - F.col("w")).cast("double")
    found = with_hypergeom_upper(asked, F.col("x").cast("double"), F.col("n").cast("double"), F.col("w").cast("double"), black, "p_value")
    return found.select("term", big("x"), r6("p_value"))
