"""Queries on families: counts, expansion, significant genes and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import expansion, expression, orthogroups, scoring
from kinfold.plans.domain import EXPRESSED, FDR, HYPOTHESES, PLOIDY, SPECIES, Domain
from kinfold.plans.registry import fragment, query, r6
from kinfold.sources.config import all_hypothesis_species

fragment("counts_long", """
SELECT h.hog, s.species, count(g.gene) AS n_genes FROM (SELECT DISTINCT hog FROM hog_genes) h
CROSS JOIN (SELECT DISTINCT species FROM genes) s
LEFT JOIN hog_genes g ON g.hog = h.hog AND g.species = s.species GROUP BY 1, 2""", "hog_genes")
fragment("c", """
SELECT hog, count(*) FILTER (species = 'AFRICA') AS af, count(*) FILTER (species = 'AMERICA') AS am,
       count(*) FILTER (species = 'ASIA') AS asi, count(*) FILTER (species = 'EUROPE') AS eu,
       count(*) FILTER (species = 'MIDDLE_EAST') AS me FROM hog_genes GROUP BY 1""", "hog_genes")
# Ploidies: AFRICA, AMERICA and EUROPE 2, ASIA 4, MIDDLE_EAST 6.
fragment("passes", """
SELECT *, am > 0 AND (af / 2 * 2 >= 2.0 * am / 2 * 2 OR af / 2 * 2 >= 4 + am / 2 * 2) AS h1_am,
       asi > 0 AND (af / 2 * 2 >= 2.0 * asi / 4 * 2 OR af / 2 * 2 >= 4 + asi / 4 * 2) AS h1_as,
       am > 0 AND (af >= 2 * am OR af >= 4 + am) AS h2_af, am > 0 AND (eu >= 2 * am OR eu >= 4 + am) AS h2_eu,
       am > 0 AND (af >= 2 * am OR af >= 100 + am) AS h3_am, asi > 0 AND (af >= 2 * asi OR af >= 100 + asi) AS h3_as,
       me > 0 AND (af >= 2 * me OR af >= 100 + me) AS h3_me,
       me > 0 AND (asi >= 2 * me OR asi >= 4 + me) AS h4_me
FROM c""", "c")
fragment("flags", """
SELECT 1 AS hypothesis, hog, h1_am AND h1_as AND af >= 2 AS run, h1_am AND h1_as AND af >= 2 AS doc FROM passes UNION ALL
SELECT 2, hog, (h2_af OR h2_eu) AND af >= 1 AND eu >= 1, (h2_af OR h2_eu) AND af >= 1 AND eu >= 1 FROM passes UNION ALL
SELECT 3, hog, h3_me AND af >= 2, (h3_am OR h3_as OR h3_me) AND af >= 2 FROM passes UNION ALL
SELECT 4, hog, h4_me AND asi >= 2 AND me >= 1, h4_me AND asi >= 2 AND me >= 1 FROM passes""", "passes")
fragment("hog_de", """
SELECT gene, species, padj, coalesce(hog, 'singleton') AS hog,
       CASE WHEN padj < 0.1 THEN 'yes' ELSE 'no' END AS significant
FROM (SELECT gene, hog FROM hog_genes) FULL JOIN de USING (gene)""", "hog_genes", "de")
fragment("sig", """
SELECT hog, count(*) FILTER (species = 'AFRICA') AS af, count(*) FILTER (species = 'AMERICA') AS am,
       count(*) FILTER (species = 'ASIA') AS asi, count(*) FILTER (species = 'EUROPE') AS eu
FROM hog_de WHERE significant = 'yes' AND hog <> 'singleton' GROUP BY 1""", "hog_de")
fragment("level0", """
SELECT f.hypothesis, f.hog, CASE WHEN f.run THEN 'yes' ELSE 'no' END AS expansion, coalesce(s.af, 0) AS s_af,
       coalesce(s.am, 0) AS s_am, coalesce(s.asi, 0) AS s_asi, coalesce(s.eu, 0) AS s_eu,
       c.af, c.am, c.asi, c.eu, c.me,
       CASE f.hypothesis WHEN 1 THEN coalesce(s.af, 0) WHEN 2 THEN (coalesce(s.af, 0) + coalesce(s.eu, 0)) / 2
            WHEN 3 THEN coalesce(s.af, 0) END AS xe,
       CASE f.hypothesis WHEN 1 THEN (coalesce(s.am, 0) + coalesce(s.asi, 0)) / 2 WHEN 2 THEN coalesce(s.am, 0)
            WHEN 3 THEN (coalesce(s.am, 0) + coalesce(s.asi, 0)) / 3 END AS xc
FROM flags f JOIN c USING (hog) LEFT JOIN sig s USING (hog)""", "flags", "c", "sig")
fragment("urn", """
SELECT hypothesis, hog, xe, xc, floor(xe + 1e-7) AS x, round_even(xe + xc, 0) AS n,
       round_even(sum(xe) OVER (PARTITION BY hypothesis), 0) AS w,
       round_even(sum(xc) OVER (PARTITION BY hypothesis), 0) AS b FROM level0""", "level0")
fragment("overrep", """
SELECT hypothesis, hog, nullif(CASE WHEN x <= greatest(0, n - b) THEN 1.0 WHEN x > least(n, w) THEN 0.0
  ELSE least(1.0, list_sum(list_transform(range(CAST(x AS BIGINT), CAST(least(n, w) AS BIGINT) + 1), lambda k:
    exp(lgamma(w + 1) - lgamma(k + 1) - lgamma(w - k + 1) + lgamma(b + 1) - lgamma(n - k + 1) - lgamma(b - n + k + 1)
        - lgamma(w + b + 1) + lgamma(n + 1) + lgamma(w + b - n + 1))))) END, 1.0) AS p FROM urn""", "urn")
fragment("scored", """
SELECT l.*, o.p AS oaes, CASE WHEN f.pvalue = 0 THEN 0.001 ELSE f.pvalue END AS famp
FROM level0 l JOIN overrep o USING (hypothesis, hog) LEFT JOIN family f USING (hog)""", "level0", "overrep", "family")


def counts(d: Domain) -> DataFrame:
    return orthogroups.hog_counts(d.hog_genes, SPECIES)


def flagged_de(d: Domain) -> DataFrame:
    return expression.significance_flag(expression.de_with_hog(d.de, d.hog_genes), FDR)


def level(d: Domain) -> DataFrame:
    return scoring.hog_level(d.hog_genes, d.de, d.family, HYPOTHESES, PLOIDY, EXPRESSED, FDR)


@query("hog_genes_long", "SELECT hog, species, gene FROM hog_genes", "hog_genes")
def _(d: Domain) -> DataFrame:
    return orthogroups.hog_genes_long(orthogroups.orthogroup_wide(d.hog_genes, SPECIES))


@query("orthogroup_wide", """
SELECT hog AS "HOG", string_agg(gene, ', ' ORDER BY gene) FILTER (species = 'AFRICA') AS "AFRICA",
  string_agg(gene, ', ' ORDER BY gene) FILTER (species = 'AMERICA') AS "AMERICA",
  string_agg(gene, ', ' ORDER BY gene) FILTER (species = 'ASIA') AS "ASIA",
  string_agg(gene, ', ' ORDER BY gene) FILTER (species = 'EUROPE') AS "EUROPE",
  string_agg(gene, ', ' ORDER BY gene) FILTER (species = 'MIDDLE_EAST') AS "MIDDLE_EAST"
FROM hog_genes GROUP BY 1""", "hog_genes")
def _(d: Domain) -> DataFrame:
    return orthogroups.orthogroup_wide(d.hog_genes, SPECIES)


@query("wide_gene_count", """
SELECT hog AS "HOG", af AS "AFRICA", am AS "AMERICA", asi AS "ASIA", eu AS "EUROPE", me AS "MIDDLE_EAST" FROM c""", "c")
def _(d: Domain) -> DataFrame:
    return orthogroups.wide_gene_count(orthogroups.orthogroup_wide(d.hog_genes, SPECIES))


@query("hog_counts", "SELECT hog, species, n_genes FROM counts_long", "counts_long")
def _(d: Domain) -> DataFrame:
    return orthogroups.counts_long(counts(d), SPECIES)


@query("hog_gene_string", """
SELECT 1 AS hypothesis, hog, species, gene FROM hog_genes WHERE species IN ('AFRICA', 'AMERICA', 'ASIA') UNION ALL
SELECT 2, hog, species, gene FROM hog_genes WHERE species IN ('AFRICA', 'EUROPE', 'AMERICA') UNION ALL
SELECT 3, hog, species, gene FROM hog_genes WHERE species IN ('AFRICA', 'AMERICA', 'ASIA', 'MIDDLE_EAST') UNION ALL
SELECT 4, hog, species, gene FROM hog_genes WHERE species IN ('ASIA', 'MIDDLE_EAST')""", "hog_genes")
def _(d: Domain) -> DataFrame:
    return orthogroups.hypothesis_gene_lists(d.hog_genes, HYPOTHESES)


@query("family_size_filter", "SELECT hog FROM c WHERE af < 5 AND am < 5 AND asi < 5", "c")
def _(d: Domain) -> DataFrame:
    return orthogroups.family_size_filter(counts(d), HYPOTHESES[0], 5).select("hog")


@query("family_fit_tables", """
SELECT 'complete' AS part, '(null)' AS "Desc", hog AS "HOG", af AS "AFRICA", am AS "AMERICA", asi AS "ASIA" FROM c UNION ALL
SELECT 'filtered', '(null)', hog, af, am, asi FROM c WHERE af < 100 AND am < 100 AND asi < 100""", "c")
def _(d: Domain) -> DataFrame:
    limited, complete = orthogroups.family_fit_tables(counts(d), HYPOTHESES[0])
    return complete.withColumn("part", F.lit("complete")).unionByName(limited.withColumn("part", F.lit("filtered")))


@query("species_set_intersections", """
SELECT concat_ws('&', CASE WHEN af > 0 THEN 'AFRICA' END, CASE WHEN am > 0 THEN 'AMERICA' END,
  CASE WHEN asi > 0 THEN 'ASIA' END, CASE WHEN eu > 0 THEN 'EUROPE' END,
  CASE WHEN me > 0 THEN 'MIDDLE_EAST' END) AS species_set, count(*) AS n_families,
  round(100.0 * count(*) / (SELECT count(*) FROM c), 6)::DOUBLE AS percent FROM c GROUP BY 1""", "c")
def _(d: Domain) -> DataFrame:
    sets = orthogroups.species_set_intersections(counts(d), SPECIES)
    return sets.select("species_set", "n_families", r6("percent"))


@query("species_pair_overlap", """
SELECT a.species AS species_a, b.species AS species_b, count(*) AS n_families FROM counts_long a JOIN counts_long b
  ON a.hog = b.hog AND a.species < b.species AND a.n_genes > 0 AND b.n_genes > 0 GROUP BY 1, 2""", "counts_long")
def _(d: Domain) -> DataFrame:
    return orthogroups.species_pair_overlap(counts(d), SPECIES)


@query("expansion_reference", "SELECT hypothesis, hog FROM flags WHERE run", "flags")
def _(d: Domain) -> DataFrame:
    return expansion.expanded_hogs(counts(d), HYPOTHESES, PLOIDY)


@query("expansion_documented", "SELECT hypothesis, hog FROM flags WHERE doc", "flags")
def _(d: Domain) -> DataFrame:
    return expansion.expanded_hogs(counts(d), HYPOTHESES, PLOIDY, expansion.SUM)


@query("expansion_counter", """
SELECT hog, CASE WHEN h1_as THEN CASE WHEN h1_am THEN 2 ELSE 1 END ELSE 0 END AS run_ploidy,
  CASE WHEN h3_me THEN CASE WHEN h3_as THEN CASE WHEN h3_am THEN 3 ELSE 2 END ELSE 1 END ELSE 0 END AS run_three,
  h3_am::INT + h3_as::INT + h3_me::INT AS sum_three FROM passes""", "passes")
def _(d: Domain) -> DataFrame:
    one, three = HYPOTHESES[0], HYPOTHESES[2]
    return counts(d).select(
        "hog",
        expansion.expansion_counter(one, "AFRICA", PLOIDY).alias("run_ploidy"),
        expansion.expansion_counter(three, "AFRICA", PLOIDY).alias("run_three"),
        expansion.expansion_counter(three, "AFRICA", PLOIDY, expansion.SUM).alias("sum_three"),
    )


@query("expansion_ploidy", "SELECT hog FROM flags WHERE run AND hypothesis = 1", "flags")
def _(d: Domain) -> DataFrame:
    return expansion.expanded_hogs(counts(d), HYPOTHESES[:1], PLOIDY).select("hog")


@query("expansion_all_found", "SELECT hog FROM flags WHERE run AND hypothesis = 4", "flags")
def _(d: Domain) -> DataFrame:
    return expansion.expanded_hogs(counts(d), HYPOTHESES[3:], PLOIDY).select("hog")


@query("expansion_flag", "SELECT hypothesis, hog, CASE WHEN run THEN 'yes' ELSE 'no' END AS expansion FROM flags", "flags")
def _(d: Domain) -> DataFrame:
    return expansion.flag_expansion(counts(d), HYPOTHESES, PLOIDY).select("hypothesis", "hog", "expansion")


@query("strict_expansion", """
SELECT hog FROM c WHERE af >= 2 AND am > 0 AND asi > 0 AND af >= 2 * am AND af >= 2 * asi""", "c")
def _(d: Domain) -> DataFrame:
    return expansion.strict_expansion(counts(d), HYPOTHESES[0], "AFRICA").select("hog")


@query("all_hypothesis_species", """
SELECT species, count(*) AS n_genes FROM hog_genes GROUP BY 1""", "hog_genes")
def _(d: Domain) -> DataFrame:
    listed = all_hypothesis_species(HYPOTHESES)
    return expression.genes_per_species(d.hog_genes.filter(F.col("species").isin(listed)))


@query("significance_flag", """
SELECT species, gene, CASE WHEN padj < 0.1 THEN 'yes' ELSE 'no' END AS significant FROM de""", "de")
def _(d: Domain) -> DataFrame:
    return expression.significance_flag(d.de, FDR).select("species", "gene", "significant")


@query("combine_de", """
SELECT species, gene, "baseMean", "log2FoldChange", pvalue, padj FROM de""", "de")
def _(d: Domain) -> DataFrame:
    parts = {s: d.de.filter(F.col("species") == s).drop("species") for s in EXPRESSED}
    return expression.combine_de(parts).select("species", "gene", "baseMean", "log2FoldChange", "pvalue", "padj")


@query("de_with_hog", "SELECT gene, species, hog, padj FROM hog_de", "hog_de")
def _(d: Domain) -> DataFrame:
    return expression.de_with_hog(d.de, d.hog_genes).select("gene", "species", "hog", "padj")


@query("fill_singleton", """
SELECT species, count(*) AS n_genes FROM hog_de WHERE hog = 'singleton' GROUP BY 1""", "hog_de")
def _(d: Domain) -> DataFrame:
    hog_de = expression.de_with_hog(d.de, d.hog_genes)
    return expression.genes_per_species(hog_de.filter(F.col("hog") == expression.SINGLETON))


@query("drop_singletons", "SELECT gene, hog FROM hog_de WHERE hog <> 'singleton'", "hog_de")
def _(d: Domain) -> DataFrame:
    return expression.drop_singletons(expression.de_with_hog(d.de, d.hog_genes)).select("gene", "hog")


@query("add_unmeasured_species", """
SELECT species, gene, padj FROM de UNION ALL
SELECT species, gene, NULL FROM annotation WHERE species NOT IN (SELECT species FROM de)""", ("de", "annotation"))
def _(d: Domain) -> DataFrame:
    return expression.add_unmeasured_species(d.de, d.annotation.select("species", "gene")).select("species", "gene", "padj")


@query("sig_counts", """
SELECT hog, species, count(*) AS n_sig FROM hog_de WHERE significant = 'yes' AND hog <> 'singleton' GROUP BY 1, 2""", "hog_de")
def _(d: Domain) -> DataFrame:
    return expression.sig_counts_long(flagged_de(d))


@query("hog_with_sig", """
SELECT hog, c.af AS "AFRICA_total", c.am AS "AMERICA_total", c.asi AS "ASIA_total", c.eu AS "EUROPE_total",
  c.me AS "MIDDLE_EAST_total", coalesce(s.af, 0) AS "AFRICA_sigDE", coalesce(s.am, 0) AS "AMERICA_sigDE",
  coalesce(s.asi, 0) AS "ASIA_sigDE", coalesce(s.eu, 0) AS "EUROPE_sigDE" FROM c LEFT JOIN sig s USING (hog)""", ("c", "sig"))
def _(d: Domain) -> DataFrame:
    return expression.hog_with_sig(counts(d), expression.sig_counts(flagged_de(d), EXPRESSED))


@query("zero_to_null", """
SELECT hog, nullif(af, 0) AS "AFRICA_sigDE", nullif(am, 0) AS "AMERICA_sigDE", nullif(asi, 0) AS "ASIA_sigDE",
  nullif(eu, 0) AS "EUROPE_sigDE" FROM sig""", "sig")
def _(d: Domain) -> DataFrame:
    sig = expression.sig_counts(flagged_de(d), EXPRESSED)
    return expression.zero_to_null(sig, [c for c in sig.columns if c != "hog"])


@query("genes_per_species", "SELECT species, count(*) AS n_genes FROM hog_de GROUP BY 1", "hog_de")
def _(d: Domain) -> DataFrame:
    return expression.genes_per_species(expression.de_with_hog(d.de, d.hog_genes))


@query("species_without_sig", """
SELECT DISTINCT species FROM (SELECT species FROM de UNION ALL SELECT species FROM genes)
EXCEPT SELECT species FROM hog_de WHERE significant = 'yes' AND hog <> 'singleton'""", "hog_de")
def _(d: Domain) -> DataFrame:
    full = expression.add_unmeasured_species(d.de, d.genes.select("species", "gene"))
    return expression.species_without_sig(expression.significance_flag(expression.de_with_hog(full, d.hog_genes), FDR))


@query("expressed_species", """
SELECT * FROM (VALUES (1, 'AFRICA'), (1, 'AMERICA'), (1, 'ASIA'), (2, 'AFRICA'), (2, 'EUROPE'), (2, 'AMERICA'),
  (3, 'AFRICA'), (3, 'AMERICA'), (3, 'ASIA'), (3, 'MIDDLE_EAST'), (4, 'ASIA'), (4, 'MIDDLE_EAST')) v(hypothesis, species)
WHERE species IN (SELECT species FROM de)""", "de")
def _(d: Domain) -> DataFrame:
    return expression.expressed_species(d.de, HYPOTHESES)


@query("total_sig", """
SELECT hypothesis, hog, CASE hypothesis WHEN 1 THEN s_af + s_am + s_asi WHEN 2 THEN s_af + s_eu + s_am
  WHEN 3 THEN s_af + s_am + s_asi ELSE s_asi END AS "total_sigDE" FROM level0""", "level0")
def _(d: Domain) -> DataFrame:
    both = expression.hog_with_sig(counts(d), expression.sig_counts(flagged_de(d), EXPRESSED))
    flags = expansion.flag_expansion(both, HYPOTHESES, PLOIDY)
    return scoring.total_sig(flags, HYPOTHESES, EXPRESSED).select("hypothesis", "hog", "total_sigDE")


@query("norm_sums", "SELECT hypothesis, hog, round(xe, 6) AS expanded, round(xc, 6) AS compared FROM level0", "level0")
def _(d: Domain) -> DataFrame:
    both = expression.hog_with_sig(counts(d), expression.sig_counts(flagged_de(d), EXPRESSED))
    sums = scoring.norm_sums(expansion.flag_expansion(both, HYPOTHESES, PLOIDY), HYPOTHESES, EXPRESSED)
    return sums.select(
        "hypothesis", "hog", r6("norm_sum_expanded_sigDE", "expanded"), r6("norm_sum_compared_sigDE", "compared")
    )


@query("urn_totals", """
SELECT hypothesis, round(sum(xe), 6) AS sum_white, round(sum(xc), 6) AS sum_black FROM level0 GROUP BY 1""", "level0")
def _(d: Domain) -> DataFrame:
    totals = scoring.urn_totals(flagged_de(d), HYPOTHESES, EXPRESSED)
    return totals.select("hypothesis", r6("sum_white"), r6("sum_black"))


@query("overrep_p", "SELECT hypothesis, hog, round(p, 6) AS oaes_hyper FROM overrep", "overrep")
def _(d: Domain) -> DataFrame:
    return level(d).select("hypothesis", "hog", r6("oaes_hyper"))


@query("hog_with_family_p", """
SELECT hog, round(CASE WHEN pvalue = 0 THEN 0.001 ELSE pvalue END, 6) AS cafe_pvalue FROM c LEFT JOIN family USING (hog)""",
       ("c", "family"))
def _(d: Domain) -> DataFrame:
    return scoring.hog_with_family_p(counts(d), d.family).select("hog", r6("cafe_pvalue"))


@query("default_family_pvalues", "SELECT DISTINCT hog, 0.999::DOUBLE AS pvalue FROM flags WHERE run", "flags")
def _(d: Domain) -> DataFrame:
    expanded = expansion.expanded_hogs(counts(d), HYPOTHESES, PLOIDY).select("hog").distinct()
    return scoring.default_family_pvalues(expanded)


@query("fisher_combine", """
SELECT a.species, a.gene, round(CASE WHEN a.pvalue * a.padj = 0 THEN 0
  ELSE a.pvalue * a.padj * (1 - ln(a.pvalue * a.padj)) END, 6) AS combined FROM de a""", "de")
def _(d: Domain) -> DataFrame:
    return d.de.select("species", "gene", r6(scoring.fisher_combine(F.col("pvalue"), F.col("padj")), "combined"))


@query("tea_score", """
SELECT hypothesis, hog, expansion, round(oaes, 6) AS oaes_hyper, round(famp, 6) AS cafe_pvalue,
  round(CASE WHEN oaes * famp = 0 THEN 0 ELSE oaes * famp * (1 - ln(oaes * famp)) END, 6) AS tea_value FROM scored""", "scored")
def _(d: Domain) -> DataFrame:
    columns = [r6(c) for c in ("oaes_hyper", "cafe_pvalue", "tea_value")]
    return level(d).select("hypothesis", "hog", "expansion", *columns)


@query("hog_level", """
SELECT hypothesis, hog, expansion, af AS "AFRICA_total", am AS "AMERICA_total", asi AS "ASIA_total",
  eu AS "EUROPE_total", me AS "MIDDLE_EAST_total", s_af AS "AFRICA_sigDE", s_am AS "AMERICA_sigDE",
  s_asi AS "ASIA_sigDE", s_eu AS "EUROPE_sigDE",
  CASE hypothesis WHEN 1 THEN s_af + s_am + s_asi WHEN 2 THEN s_af + s_eu + s_am
    WHEN 3 THEN s_af + s_am + s_asi ELSE s_asi END AS "total_sigDE",
  round(xe, 6) AS "norm_sum_expanded_sigDE", round(xc, 6) AS "norm_sum_compared_sigDE",
  round(oaes, 6) AS oaes_hyper, round(famp, 6) AS cafe_pvalue,
  round(CASE WHEN oaes * famp = 0 THEN 0 ELSE oaes * famp * (1 - ln(oaes * famp)) END, 6) AS tea_value
FROM scored""", "scored")
def hog_level_query(d: Domain) -> DataFrame:
    rounded = ["norm_sum_expanded_sigDE", "norm_sum_compared_sigDE", "oaes_hyper", "cafe_pvalue", "tea_value"]
    table = level(d)
    return scoring.order_by_score(table).select(*[r6(c) if c in rounded else F.col(c) for c in table.columns])


@query("hypothesis_view", """
SELECT hog, expansion, af AS "AFRICA_total", am AS "AMERICA_total", asi AS "ASIA_total", s_af AS "AFRICA_sigDE",
  s_am AS "AMERICA_sigDE", s_asi AS "ASIA_sigDE", s_af + s_am + s_asi AS "total_sigDE",
  round(xe, 6) AS "norm_sum_expanded_sigDE", round(xc, 6) AS "norm_sum_compared_sigDE",
  round(oaes, 6) AS oaes_hyper, round(famp, 6) AS cafe_pvalue,
  round(CASE WHEN oaes * famp = 0 THEN 0 ELSE oaes * famp * (1 - ln(oaes * famp)) END, 6) AS tea_value
FROM scored WHERE hypothesis = 1""", "scored")
def _(d: Domain) -> DataFrame:
    scores = ["norm_sum_expanded_sigDE", "norm_sum_compared_sigDE", "oaes_hyper", "cafe_pvalue", "tea_value"]
    view = scoring.hypothesis_view(level(d), HYPOTHESES[0])
    return view.select(*[r6(c) if c in scores else F.col(c) for c in view.columns])


@query("all_species_overview", """
SELECT hog, c.af AS "AFRICA_total", c.am AS "AMERICA_total", c.asi AS "ASIA_total", c.eu AS "EUROPE_total",
  c.me AS "MIDDLE_EAST_total", coalesce(s.af, 0) AS "AFRICA_sigDE", coalesce(s.am, 0) AS "AMERICA_sigDE",
  coalesce(s.asi, 0) AS "ASIA_sigDE", coalesce(s.eu, 0) AS "EUROPE_sigDE" FROM c LEFT JOIN sig s USING (hog)""", ("c", "sig"))
def _(d: Domain) -> DataFrame:
    return scoring.all_species_overview(d.hog_genes, flagged_de(d), SPECIES, EXPRESSED)


@query("legacy_ratio_score", """
SELECT hog, round((af / nullif(am + asi, 0)) * (csig / esig) / ((af + am + asi) * (esig + csig)), 6) AS ratio_score FROM (
  SELECT *, CASE WHEN s_af = 0 THEN 1 ELSE s_af END AS esig,
    CASE WHEN s_am = 0 OR s_asi = 0 THEN 1 ELSE s_am + s_asi END AS csig
  FROM level0 WHERE hypothesis = 1 AND expansion = 'yes')""", "level0")
def _(d: Domain) -> DataFrame:
    table = level(d).filter(F.col("hypothesis") == 1)
    return scoring.legacy_ratio_score(table, HYPOTHESES[0]).select("hog", r6("ratio_score"))
