"""Queries on similarity hits: extended hits, closest families, gene sets and their sequences."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import expansion, hits, orthogroups
from kinfold.plans.domain import ADDED_FAMILIES, HYPOTHESES, PLOIDY, SPECIES, Domain
from kinfold.plans.registry import big, fragment, query, r6
from kinfold.session import cut_lineage

fragment("named", """
SELECT h.*, q.name AS qname, s.name AS sname FROM hits h LEFT JOIN id_map q ON h.qseqid = q.seqid
LEFT JOIN id_map s ON h.sseqid = s.seqid""", "hits", "id_map")
fragment("members", """
SELECT f.hypothesis, f.hog, g.gene FROM flags f JOIN hog_genes g USING (hog) WHERE f.run AND (
  f.hypothesis = 1 AND species IN ('AFRICA', 'AMERICA', 'ASIA') OR f.hypothesis = 2 AND species IN ('AFRICA', 'EUROPE', 'AMERICA')
  OR f.hypothesis = 3 AND species IN ('AFRICA', 'AMERICA', 'ASIA', 'MIDDLE_EAST')
  OR f.hypothesis = 4 AND species IN ('ASIA', 'MIDDLE_EAST'))""", "flags", "hog_genes")
fragment("touching", """
SELECT m.hypothesis, m.hog, h.* FROM named h JOIN members m ON h.qname = m.gene UNION ALL
SELECT m.hypothesis, m.hog, h.* FROM named h JOIN members m ON h.sname = m.gene
WHERE NOT EXISTS (SELECT 1 FROM members q WHERE q.hypothesis = m.hypothesis AND q.hog = m.hog AND q.gene = h.qname)""",
         "named", "members")
fragment("ranked", """
SELECT *, row_number() OVER (PARTITION BY hypothesis, hog ORDER BY evalue, bitscore DESC, pident DESC, qseqid, sseqid) AS rank
FROM touching""", "touching")
fragment("seen", """
SELECT hypothesis, hog, gene, min(place) AS place FROM (
  SELECT hypothesis, hog, qname AS gene, 2 * rank AS place FROM ranked UNION ALL
  SELECT hypothesis, hog, sname, 2 * rank + 1 FROM ranked) WHERE gene IS NOT NULL GROUP BY 1, 2, 3""", "ranked")
fragment("extended", """
SELECT hypothesis, hog, gene, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY hypothesis, hog ORDER BY place) AS rank
  FROM seen ANTI JOIN members USING (hypothesis, hog, gene)) WHERE rank <= 3""", "seen", "members")
fragment("allowed", """
SELECT hypothesis, hog, gene FROM members UNION SELECT hypothesis, hog, gene FROM extended""", "members", "extended")
fragment("restricted", """
SELECT r.* FROM ranked r SEMI JOIN allowed a ON (r.hypothesis = a.hypothesis AND r.hog = a.hog AND r.qname = a.gene)
SEMI JOIN allowed b ON (r.hypothesis = b.hypothesis AND r.hog = b.hog AND r.sname = b.gene)""", "ranked", "allowed")
fragment("best", """
SELECT hypothesis, hog, sname, target_hog, rank FROM (
  SELECT r.hypothesis, r.hog, r.sname, g.hog AS target_hog, r.rank,
    row_number() OVER (PARTITION BY r.hypothesis, r.hog, r.sname ORDER BY r.rank) AS k
  FROM ranked r LEFT JOIN hog_genes g ON r.sname = g.gene) WHERE k = 1""", "ranked", "hog_genes")
fragment("labelled", """
SELECT *, coalesce(target_hog, 'singleton-' || count(*) FILTER (target_hog IS NULL)
  OVER (PARTITION BY hypothesis, hog ORDER BY rank)) AS closest FROM best""", "best")
fragment("closest", """
SELECT hypothesis, hog, closest, target_hog, gene, row_number() OVER (PARTITION BY hypothesis, hog ORDER BY first) AS rank FROM (
  SELECT hypothesis, hog, closest, any_value(target_hog) AS target_hog, min(rank) AS first,
    arg_min(CASE WHEN target_hog IS NULL THEN sname END, rank) AS gene FROM labelled GROUP BY 1, 2, 3)
QUALIFY rank <= 4""", "labelled")
fragment("sets", """
SELECT c.hypothesis, c.hog, n.k AS set_num, coalesce(g.gene, c.gene) AS gene FROM closest c
JOIN (SELECT hypothesis, hog, max(rank) AS last FROM closest GROUP BY 1, 2) l USING (hypothesis, hog)
JOIN (SELECT unnest(range(1, 5)) AS k) n ON n.k BETWEEN c.rank AND l.last
LEFT JOIN hog_genes g ON g.hog = c.target_hog""", "closest", "hog_genes")


class Neighbours:
    """The chain of frames the queries below read from. What is small or, where said, read more than once is written, so that it is made once."""

    def __init__(self, d: Domain, shared: bool = False):
        self.d = d
        self.shared = shared
        counts = orthogroups.hog_counts(d.hog_genes, SPECIES)
        self.expanded = cut_lineage(expansion.expanded_hogs(counts, HYPOTHESES, PLOIDY))
        grown = d.hog_genes.join(self.expanded.select("hog"), "hog", "left_semi")  # before genes are listed per hypothesis
        lists = orthogroups.hypothesis_gene_lists(grown, HYPOTHESES)
        self.members = cut_lineage(lists.join(self.expanded, ["hypothesis", "hog"], "left_semi"))

    @cached_property
    def touching(self) -> DataFrame:
        found = hits.hits_touching(self.d.hits, self.d.id_map, self.members)
        return cut_lineage(found) if self.shared else found

    @cached_property
    def extended(self) -> DataFrame:
        return cut_lineage(hits.extended_genes(self.touching, self.members, ADDED_FAMILIES))

    @cached_property
    def best(self) -> DataFrame:
        return hits.best_hit_per_subject(hits.hits_to_hog(self.touching, self.d.hog_genes))

    @cached_property
    def closest(self) -> DataFrame:
        return cut_lineage(hits.closest_hogs(self.best, ADDED_FAMILIES))

    @cached_property
    def sets(self) -> DataFrame:
        return hits.cumulative_gene_sets(self.closest, self.d.hog_genes)


HIT = ["hypothesis", "hog", "qseqid", "sseqid"]


@query("hit_evalue_filter", """
SELECT qseqid, sseqid, round(evalue, 6) AS evalue, round(bitscore, 4) AS bitscore FROM hits WHERE evalue <= 5e-4""", "hits")
def _(d: Domain) -> DataFrame:
    kept = hits.hit_evalue_filter(d.hits, 5e-4)
    return kept.select("qseqid", "sseqid", r6("evalue"), F.round("bitscore", 4).alias("bitscore"))


@query("name_hits", "SELECT qseqid, sseqid, qname AS qseqid_name, sname AS sseqid_name FROM named", "named")
def _(d: Domain) -> DataFrame:
    return hits.name_hits(d.hits, d.id_map).select("qseqid", "sseqid", "qseqid_name", "sseqid_name")


@query("hits_touching", "SELECT hypothesis, hog, qseqid, sseqid FROM touching", "touching")
def _(d: Domain) -> DataFrame:
    return Neighbours(d).touching.select(*HIT)


@query("rank_hits", "SELECT hypothesis, hog, qseqid, sseqid, rank FROM ranked", "ranked")
def _(d: Domain) -> DataFrame:
    return hits.rank_hits(Neighbours(d).touching).select(*HIT, big("rank"))


@query("first_seen_genes", """
SELECT hypothesis, hog, gene, row_number() OVER (PARTITION BY hypothesis, hog ORDER BY place) AS place FROM seen""", "seen")
def _(d: Domain) -> DataFrame:
    seen = hits.first_seen_genes(Neighbours(d).touching).select("hypothesis", "hog", "gene", "first_seen.*")
    # negated here and there: descending, as full_rank wants its second key, and ascending as the key of the minimum has it
    seen = seen.withColumn("bitscore", -F.col("bitscore"))
    order = [F.col("evalue"), F.col("bitscore").desc(), *[F.col(c) for c in ("pident", "qseqid", "sseqid", "side")]]
    placed = hits.full_rank(seen, hits.GROUP, "evalue", "bitscore", order, "place")
    return placed.select("hypothesis", "hog", "gene", big("place"))


@query("extended_genes", "SELECT hypothesis, hog, gene, rank FROM extended", "extended")
def _(d: Domain) -> DataFrame:
    return Neighbours(d).extended.select("hypothesis", "hog", "gene", big("rank"))


@query("restrict_hits", "SELECT hypothesis, hog, qseqid, sseqid FROM restricted", "restricted")
def _(d: Domain) -> DataFrame:
    n = Neighbours(d, shared=True)
    return hits.restrict_hits(n.touching, n.members, n.extended).select(*HIT)


@query("hits_to_hog", """
SELECT t.hypothesis, t.hog, t.qseqid, t.sseqid, g.hog AS target_hog FROM touching t LEFT JOIN hog_genes g ON t.sname = g.gene""",
       ("touching", "hog_genes"))
def _(d: Domain) -> DataFrame:
    return hits.hits_to_hog(Neighbours(d).touching, d.hog_genes).select(*HIT, "target_hog")


@query("best_hit_per_subject", "SELECT hypothesis, hog, sname AS sseqid_name, target_hog FROM best", "best")
def _(d: Domain) -> DataFrame:
    return Neighbours(d).best.select("hypothesis", "hog", "sseqid_name", "target_hog")


@query("best_row_per_hog", """
SELECT b.hypothesis, b.hog, target_hog, min_by(qseqid, b.rank) AS qseqid FROM best b
JOIN ranked r ON r.hypothesis = b.hypothesis AND r.hog = b.hog AND r.rank = b.rank
WHERE target_hog IS NOT NULL GROUP BY 1, 2, 3""", ("best", "ranked"))
def _(d: Domain) -> DataFrame:
    best = Neighbours(d).best.filter(F.col("target_hog").isNotNull())
    return best.groupBy("hypothesis", "hog", "target_hog").agg(F.min("best")["qseqid"].alias("qseqid"))


@query("number_singletons", """
SELECT hypothesis, hog, closest, gene FROM closest WHERE target_hog IS NULL""", "closest")
def _(d: Domain) -> DataFrame:
    return Neighbours(d).closest.filter(F.col("target_hog").isNull()).select("hypothesis", "hog", "closest", "gene")


@query("closest_hogs", "SELECT hypothesis, hog, rank, closest FROM closest", "closest")
def _(d: Domain) -> DataFrame:
    return Neighbours(d).closest.select("hypothesis", "hog", big("rank"), "closest")


@query("cumulative_gene_sets", "SELECT hypothesis, hog, set_num, gene FROM sets", "sets")
def _(d: Domain) -> DataFrame:
    return Neighbours(d).sets.select("hypothesis", "hog", big("set_num"), "gene")


@query("pad_sets", """
SELECT f.hypothesis, f.hog, k AS set_num, count(s.hog) AS n_genes FROM flags f
CROSS JOIN (SELECT unnest(range(1, 5)) AS k) n
LEFT JOIN sets s ON s.hypothesis = f.hypothesis AND s.hog = f.hog AND s.set_num = k WHERE f.run GROUP BY 1, 2, 3""",
       ("flags", "sets"))
def _(d: Domain) -> DataFrame:
    n = Neighbours(d)
    return hits.pad_sets(n.sets, n.expanded, ADDED_FAMILIES).select("hypothesis", "hog", big("set_num"), "n_genes")


@query("extract_sequences", """
SELECT hypothesis, hog, set_num, gene, md5(CAST(o_orderkey AS VARCHAR)) AS sequence FROM sets
JOIN orders ON gene = 'g' || o_orderkey""", "sets")
def _(d: Domain) -> DataFrame:
    extracted = hits.extract_sequences(Neighbours(d).sets, d.gene_sequences)
    return extracted.select("hypothesis", "hog", big("set_num"), "gene", "sequence")


@query("unique_sequences", """
SELECT DISTINCT gene, md5(CAST(o_orderkey AS VARCHAR)) AS sequence FROM sets JOIN orders ON gene = 'g' || o_orderkey""", "sets")
def _(d: Domain) -> DataFrame:
    return hits.unique_sequences(hits.extract_sequences(Neighbours(d).sets, d.gene_sequences))


@query("extended_hit_stats", """
SELECT t.hypothesis, t.hog, coalesce(m.n, 0) AS n_members, coalesce(e.n, 0) AS n_extended,
  coalesce(m.n, 0) + coalesce(e.n, 0) AS n_total FROM (SELECT DISTINCT hypothesis, hog FROM touching) t
LEFT JOIN (SELECT hypothesis, hog, count(DISTINCT gene) AS n FROM members GROUP BY 1, 2) m USING (hypothesis, hog)
LEFT JOIN (SELECT hypothesis, hog, count(*) AS n FROM extended GROUP BY 1, 2) e USING (hypothesis, hog)""",
       ("touching", "members", "extended"))
def _(d: Domain) -> DataFrame:
    n = Neighbours(d, shared=True)
    return hits.extended_hit_stats(n.touching, n.members, n.extended)


@query("assemble_hypothesis", """
SELECT f.hypothesis, f.hog, v.name, coalesce(h.n_hits, 0) AS n_hits, e.genes AS extended, s.sizes
FROM flags f JOIN (VALUES (1, 'AFRICA against two'), (2, 'AFRICA or EUROPE against AMERICA'), (3, 'AFRICA against three'),
  (4, 'ASIA against the unmeasured')) v(hypothesis, name) USING (hypothesis)
LEFT JOIN (SELECT hypothesis, hog, count(*) AS n_hits FROM restricted GROUP BY 1, 2) h USING (hypothesis, hog)
LEFT JOIN (SELECT hypothesis, hog, string_agg(gene, ',' ORDER BY rank) AS genes FROM extended GROUP BY 1, 2) e USING (hypothesis, hog)
LEFT JOIN (SELECT hypothesis, hog, string_agg(n, ',' ORDER BY k) AS sizes FROM (
  SELECT f.hypothesis, f.hog, k, CAST(count(s.hog) AS VARCHAR) AS n FROM flags f
  CROSS JOIN (SELECT unnest(range(1, 5)) AS k) r
  LEFT JOIN sets s ON s.hypothesis = f.hypothesis AND s.hog = f.hog AND s.set_num = k GROUP BY 1, 2, 3) GROUP BY 1, 2) s
  USING (hypothesis, hog)
WHERE f.run""", ("flags", "restricted", "extended", "sets"))
def _(d: Domain) -> DataFrame:
    n = Neighbours(d, shared=True)
    settings = d.spark.createDataFrame([(h.hypothesis, h.name) for h in HYPOTHESES], "hypothesis int, name string")
    kept = hits.restrict_hits(n.touching, n.members, n.extended)
    sizes = kept.groupBy(*hits.GROUP).agg(F.count(F.lit(1)).alias("n_hits"))
    nested = hits.assemble_hypothesis(settings, sizes, n.extended, hits.pad_sets(n.sets, n.expanded, ADDED_FAMILIES))
    return nested.select(
        "hypothesis", "hog", "name", F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
        F.array_join("extended_genes.gene", ",").alias("extended"),
        F.array_join(F.transform("sets", lambda s: s["n_genes"].cast("string")), ",").alias("sizes"),
    )


SCORED = """SELECT h.*, q.species AS qs, t.species AS ts, log10(q.n * t.n) AS x, log10(bitscore) AS y FROM hits h
JOIN lengths q ON h.qseqid = q.seqid JOIN lengths t ON h.sseqid = t.seqid"""
fragment("lengths", "SELECT 'q' || key AS seqid, species, 1 + CAST(round(price) AS BIGINT) % 997 AS n FROM genes", "genes")
fragment("scored_hits", SCORED, "hits", "lengths")


def scored_hits(d: Domain) -> DataFrame:
    lengths = d.genes.select(
        F.concat(F.lit("q"), F.col("key").cast("string")).alias("seqid"), "species",
        (1 + F.round("price").cast("long") % 997).alias("seq_length"),
    )
    return hits.bitscore_normalise(d.hits, lengths, ["qspecies", "sspecies"])


@query("bitscore_normalise", """
SELECT qs AS qspecies, ts AS sspecies, count(*) AS n_hits, round(regr_slope(y, x), 6) AS slope,
  round(regr_intercept(y, x), 6) AS intercept FROM scored_hits GROUP BY 1, 2""", "scored_hits")
def _(d: Domain) -> DataFrame:
    return scored_hits(d).groupBy("qspecies", "sspecies").agg(
        F.count(F.lit(1)).alias("n_hits"), r6(F.first("slope"), "slope"), r6(F.first("intercept"), "intercept")
    )


@query("bitscore_normalised_hits", """
SELECT qseqid, sseqid, qs AS qspecies, ts AS sspecies, bitscore, round(bitscore / pow(10, slope * x + intercept), 6) AS normalised
FROM scored_hits JOIN (SELECT qs, ts, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM scored_hits GROUP BY 1, 2)
USING (qs, ts)""", "scored_hits")
def _(d: Domain) -> DataFrame:
    return scored_hits(d).select("qseqid", "sseqid", "qspecies", "sspecies", "bitscore", r6("normalised"))


@query("species_pair_orthology", """
WITH p AS (SELECT DISTINCT a.species AS sa, b.species AS sb, a.gene AS ga, b.gene AS gb FROM hog_genes a
  JOIN hog_genes b ON a.hog = b.hog AND a.species <> b.species)
SELECT sa AS species_a, sb AS species_b, count(*) FILTER (true) AS n, count(*) FILTER (da = 1 AND mb = 1) AS one_one,
  count(*) FILTER (da > 1 AND mb = 1) AS one_many, count(*) FILTER (da = 1 AND mb > 1) AS many_one,
  count(*) FILTER (da > 1 AND mb > 1) AS many_many FROM (
  SELECT sa, sb, ga, count(*) AS da, max(db) AS mb FROM (
    SELECT *, count(*) OVER (PARTITION BY sa, sb, gb) AS db FROM p) GROUP BY 1, 2, 3) GROUP BY 1, 2
""".replace("WITH p AS", "SELECT * FROM (WITH p AS") + ")", "hog_genes")
def _(d: Domain) -> DataFrame:
    return orthogroups.species_pair_orthology(orthogroups.hog_counts(d.hog_genes, SPECIES), SPECIES)
