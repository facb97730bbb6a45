"""Queries on forests and clusters."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators import clustering, forest
from kinfold.plans.domain import Domain
from kinfold.plans.registry import big, fragment, query, r6
from kinfold.session import cut_lineage, cut_measured, kept_together
from kinfold.sources.newick import parse_newick, write_newick

# A tree has four levels: root, side (with this status or not), species, gene. A node is named by its level and first leaf.
for name, status in (("leaves", "F"), ("leaves_o", "O")):
    fragment(name, f"""
SELECT *, max(len) OVER (PARTITION BY tree_id, side) AS side_len, max(len) OVER (PARTITION BY tree_id, side, species) AS sp_len
FROM (SELECT hog AS tree_id, status = '{status}' AS side, species, gene, CAST(round(price * 100) AS BIGINT) AS len
  FROM genes WHERE priority <> '4-NOT SPECIFIED')""", "genes")
for name, leaves in (("clades", "leaves"), ("clades_o", "leaves_o")):
    fragment(name, f"""
SELECT DISTINCT tree_id, names, n FROM (
  SELECT tree_id, string_agg(gene, ',' ORDER BY gene) AS names, count(*) AS n FROM {leaves} GROUP BY tree_id UNION ALL
  SELECT tree_id, string_agg(gene, ',' ORDER BY gene), count(*) FROM {leaves} GROUP BY tree_id, side UNION ALL
  SELECT tree_id, string_agg(gene, ',' ORDER BY gene), count(*) FROM {leaves} GROUP BY tree_id, side, species) WHERE n > 1""", leaves)
fragment("species_texts", """
SELECT tree_id, side, species, max(len) AS len,
  '(' || string_agg(gene || ':' || len, ',' ORDER BY gene || ':' || len) || '):' || max(len) AS species_text
FROM leaves GROUP BY 1, 2, 3""", "leaves")
fragment("side_texts", """
SELECT tree_id, side, '(' || string_agg(species_text, ',' ORDER BY species_text) || '):' || max(len) AS side_text
FROM species_texts GROUP BY 1, 2""", "species_texts")
fragment("placed", """
SELECT *, min(pos) OVER (PARTITION BY tree_id, side) AS side_pos, min(pos) OVER (PARTITION BY tree_id, side, species) AS sp_pos FROM (
  SELECT l.*, row_number() OVER (PARTITION BY l.tree_id ORDER BY side_text, species_text, gene || ':' || l.len) AS pos
  FROM leaves l JOIN species_texts USING (tree_id, side, species) JOIN side_texts USING (tree_id, side))""",
         "leaves", "species_texts", "side_texts")
fragment("under", """
SELECT tree_id, 0 AS depth, '' AS node, gene, pos, side_len + sp_len + len AS dist, 0 AS own FROM placed UNION ALL
SELECT tree_id, 1, CAST(side AS VARCHAR), gene, pos, sp_len + len, side_len FROM placed UNION ALL
SELECT tree_id, 2, side || species, gene, pos, len, sp_len FROM placed UNION ALL
SELECT tree_id, 3, gene, gene, pos, 0, len FROM placed""", "placed")
fragment("spots", """
SELECT tree_id, depth, node, arg_min(gene, pos) AS first_leaf, arg_max(gene, pos) AS last_leaf, count(*) AS n_leaves, min(pos) AS place,
  any_value(own) AS own, avg(dist) AS mean FROM under GROUP BY 1, 2, 3""", "under")
fragment("kept", """
SELECT *, count(*) OVER (PARTITION BY tree_id, side, species) > 1 AS p, n_species > 1 AS s, n_sides > 1 AS r,
  arg_min(gene, pos) OVER (PARTITION BY tree_id, side, species) AS sp_first
FROM placed JOIN (SELECT tree_id, side, count(DISTINCT species) AS n_species FROM placed WHERE species IN ('AFRICA', 'EUROPE') GROUP BY 1, 2)
USING (tree_id, side) JOIN (SELECT tree_id, count(DISTINCT side) AS n_sides FROM placed WHERE species IN ('AFRICA', 'EUROPE') GROUP BY 1)
USING (tree_id) WHERE species IN ('AFRICA', 'EUROPE')""", "placed")
# The pruned trees: a node's level, its parent's and the branch in between.
fragment("pruned", """
SELECT k.tree_id, 3 AS depth, gene AS node, CASE WHEN p THEN 2 WHEN s THEN 1 WHEN r THEN 0 END AS parent_depth,
  CASE WHEN p THEN len WHEN s THEN len + sp_len WHEN r THEN len + sp_len + side_len ELSE 0 END AS dist FROM kept k UNION ALL
SELECT DISTINCT tree_id, 2, side || species, CASE WHEN s THEN 1 WHEN r THEN 0 END,
  CASE WHEN s THEN sp_len WHEN r THEN sp_len + side_len ELSE 0 END FROM kept WHERE p UNION ALL
SELECT DISTINCT tree_id, 1, CAST(side AS VARCHAR), CASE WHEN r THEN 0 END, CASE WHEN r THEN side_len ELSE 0 END FROM kept WHERE s UNION ALL
SELECT DISTINCT tree_id, 0, '', NULL, 0 FROM kept WHERE r""", "kept")
fragment("levels", """
SELECT *, max(CASE WHEN s THEN side_m WHEN p THEN 2 ELSE 1 END) OVER (PARTITION BY tree_id) + 1 AS root_m FROM (
  SELECT *, max(CASE WHEN p THEN 2 ELSE 1 END) OVER (PARTITION BY tree_id, side) + 1 AS side_m FROM kept)""", "kept")
fragment("verts", """
SELECT tree_id, 0 AS dv, CAST(NULL AS BOOLEAN) AS side, CAST(NULL AS VARCHAR) AS species, CAST(NULL AS VARCHAR) AS gene,
  0 AS l1, 0 AS l2, 0 AS l3, '' AS node FROM placed GROUP BY tree_id UNION ALL
SELECT tree_id, 1, side, NULL, NULL, side_len, 0, 0, CAST(side AS VARCHAR) FROM placed GROUP BY tree_id, side, side_len UNION ALL
SELECT tree_id, 2, side, species, NULL, side_len, sp_len, 0, side || species FROM placed GROUP BY tree_id, side, species, side_len, sp_len UNION ALL
SELECT tree_id, 3, side, species, gene, side_len, sp_len, len, gene FROM placed""", "placed")
for name, value, topological in (("far", "way", False), ("far_hops", "hops", True)):
    fragment(name, f"""
SELECT tree_id, dv AS depth, node, far_leaf, CAST({value} AS DOUBLE) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY tree_id, dv, node ORDER BY {value} DESC, lca DESC,
    CASE WHEN lca = dv THEN 0 WHEN lca = 0 THEN side_pos WHEN lca = 1 THEN sp_pos ELSE pos END, pos DESC) AS k FROM (
    SELECT *, CASE WHEN lca >= 1 THEN 0 ELSE l1 END + CASE WHEN lca >= 2 THEN 0 ELSE l2 END + CASE WHEN lca >= 3 THEN 0 ELSE l3 END
        + CASE WHEN lca >= 1 THEN 0 ELSE side_len END + CASE WHEN lca >= 2 THEN 0 ELSE sp_len END + CASE WHEN lca >= 3 THEN 0 ELSE len END AS way,
      CASE WHEN lca = dv THEN 3 - dv ELSE dv - lca - 1 + 3 - lca END AS hops FROM (
      SELECT v.tree_id, v.dv, v.node, v.l1, v.l2, v.l3, w.gene AS far_leaf, w.pos, w.side_pos, w.sp_pos, w.side_len, w.sp_len, w.len,
        CASE WHEN v.gene = w.gene THEN 3 WHEN v.side = w.side AND v.species = w.species THEN 2 WHEN v.side = w.side THEN 1 ELSE 0 END AS lca
      FROM verts v JOIN placed w USING (tree_id)))) WHERE k = 1""", "verts", "placed")


class Forest:
    def __init__(self, trees: DataFrame):
        self.nodes = cut_lineage(parse_newick(trees, dialect=0).select(*forest.NODE_COLUMNS))

    @cached_property
    def spots(self) -> DataFrame:
        """How the queries name a node: its depth and the first leaf below it."""
        numbers = cut_lineage(forest.leaf_numbers(self.nodes))
        first = numbers.select("tree_id", F.col("number").alias("first_leaf"), F.col("name").alias("first_name"))
        last = numbers.select("tree_id", F.col("number").alias("last_leaf"), F.col("name").alias("last_name"))
        return cut_lineage(
            forest.leaves_under(self.nodes).join(first, ["tree_id", "first_leaf"]).join(last, ["tree_id", "last_leaf"])
            .join(forest.tree_paths(self.nodes), forest.KEY)
            .select(*forest.KEY, big("depth"), F.col("first_name").alias("first_leaf"), F.col("last_name").alias("last_leaf"), "n_leaves", "root_distance")
        )

    def shown(self, rows: DataFrame, *columns) -> DataFrame:
        """Rows of nodes by their names."""
        return rows.join(self.spots, forest.KEY).select("tree_id", "depth", "first_leaf", *columns)

    def leaf_names(self, column: str, alias: str) -> DataFrame:
        return self.nodes.filter("is_leaf").select("tree_id", F.col("node_id").alias(column), F.col("name").alias(alias))


BUCKET_TEXT = 1 << 20  # characters of Newick text per bucket of node rows
LONG_TEXT = 1 << 24  # trees of longer texts have their nodes spread over tasks


def on_trees(*statuses: str) -> Callable:
    """A query on forests as a function of the domain. The trees' nodes are kept together, but for those of very long texts.

    ``work`` takes the domain and one forest per status; its rows have a tree_id and come from the forests' trees one by one.
    """
    def of_domain(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(d: Domain) -> DataFrame:
            size = F.length("newick")
            texts, sizes = zip(*(
                cut_measured(d.trees_by_status(s), all=F.sum(size), longest=F.max(size)) for s in statuses or ("F",)
            ))
            buckets = 1 + sum(s["all"] or 0 for s in sizes) // BUCKET_TEXT
            long = [t.filter(size > LONG_TEXT).select("tree_id") for t, s in zip(texts, sizes) if (s["longest"] or 0) > LONG_TEXT]
            spread = cut_lineage(reduce(DataFrame.unionByName, long).distinct()) if long else None
            with kept_together(d.spark, "tree_id", buckets):
                some = texts if spread is None else [t.join(spread, "tree_id", "left_anti") for t in texts]
                out = cut_lineage(work(d, *map(Forest, some)))
            if spread is None:
                return out
            return out.unionByName(work(d, *(Forest(t.join(spread, "tree_id", "left_semi")) for t in texts)))

        return run

    return of_domain


def pruned(d: Domain, f: Forest) -> DataFrame:
    names = d.genes.filter(F.col("species").isin("AFRICA", "EUROPE")).select(F.col("gene").alias("name"))
    return forest.keep_tips(f.nodes, names)


@query("read_newick", """
SELECT tree_id, '' AS name, 0.0 AS dist, false AS is_leaf FROM leaves GROUP BY tree_id UNION ALL
SELECT tree_id, '', CAST(side_len AS DOUBLE), false FROM leaves GROUP BY tree_id, side, side_len UNION ALL
SELECT tree_id, '', CAST(sp_len AS DOUBLE), false FROM leaves GROUP BY tree_id, side, species, sp_len UNION ALL
SELECT tree_id, gene, CAST(len AS DOUBLE), true FROM leaves""", "leaves")
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    return f.nodes.select("tree_id", F.coalesce("name", F.lit("")).alias("name"), "dist", "is_leaf")


@query("write_newick", "SELECT tree_id, '(' || string_agg(side_text, ',' ORDER BY side_text) || ');' AS newick FROM side_texts GROUP BY 1",
       "side_texts")
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    return write_newick(f.nodes, dialect=5)


@query("root_distance", """
SELECT tree_id, gene AS name, 3 AS depth, CAST(side_len + sp_len + len AS DOUBLE) AS root_distance FROM leaves""", "leaves")
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    leaves = f.nodes.filter("is_leaf").select(*forest.KEY, "name")
    return leaves.join(forest.tree_paths(f.nodes), forest.KEY).select("tree_id", "name", big("depth"), "root_distance")


@query("pair_distance", """
SELECT tree_id, ga AS gene_a, gb AS gene_b,
  CAST(CASE WHEN a.side <> b.side THEN a.side_len + a.sp_len + a.len + b.side_len + b.sp_len + b.len
    WHEN a.species <> b.species THEN a.sp_len + a.len + b.sp_len + b.len WHEN a.gene <> b.gene THEN a.len + b.len ELSE 0 END AS DOUBLE) AS distance,
  CAST(CASE WHEN a.side <> b.side THEN 5 WHEN a.species <> b.species THEN 3 WHEN a.gene <> b.gene THEN 1 ELSE 0 END AS DOUBLE) AS nodes_between
FROM (SELECT tree_id, gene AS ga, coalesce(lead(gene, 3) OVER (PARTITION BY tree_id ORDER BY gene), min(gene) OVER (PARTITION BY tree_id)) AS gb
  FROM leaves) p
JOIN leaves a USING (tree_id) JOIN leaves b USING (tree_id) WHERE a.gene = ga AND b.gene = gb""", "leaves")
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    """Every leaf with the third one after it by name, the last three with the first one."""
    leaves = f.nodes.filter("is_leaf").select("tree_id", "name", "node_id")
    by_name = Window.partitionBy("tree_id").orderBy("name")
    first = F.first("node_id").over(by_name)
    wanted = cut_lineage(leaves.select(
        "tree_id", F.col("node_id").alias("node_a"), F.coalesce(F.lead("node_id", 3).over(by_name), first).alias("node_b")
    ))
    both = forest.pair_distance(f.nodes, wanted)
    return both.join(f.leaf_names("node_a", "gene_a"), ["tree_id", "node_a"]).join(f.leaf_names("node_b", "gene_b"), ["tree_id", "node_b"]).select(
        "tree_id", "gene_a", "gene_b", "distance", "nodes_between"
    )


@query("mrca", """
SELECT g.tree_id, g.species, s.depth, s.first_leaf, s.n_leaves FROM (
  SELECT tree_id, species, CASE WHEN count(DISTINCT side) > 1 THEN '' WHEN count(*) = 1 THEN any_value(gene) ELSE any_value(side || species) END AS node,
    CASE WHEN count(DISTINCT side) > 1 THEN 0 WHEN count(*) = 1 THEN 3 ELSE 2 END AS depth FROM placed GROUP BY 1, 2) g
JOIN spots s ON s.tree_id = g.tree_id AND s.depth = g.depth AND s.node = g.node""", ("placed", "spots"))
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    species = d.genes.select(F.col("gene").alias("name"), F.col("species").alias("set_id"))
    members = f.nodes.filter("is_leaf").join(species, "name").select("tree_id", "set_id", "node_id")
    top = forest.mrca(f.nodes, members).withColumnRenamed("ancestor_id", "node_id")
    return f.shown(top, F.col("set_id").alias("species"), "n_leaves")


@query("leaves_under", "SELECT tree_id, depth, first_leaf, last_leaf, n_leaves FROM spots", "spots")
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    return f.spots.select("tree_id", "depth", "first_leaf", "last_leaf", "n_leaves")


for name, value, topological in (("leaf_extremes", "dist", False), ("leaf_extremes_topological", "3 - depth", True)):

    @query(name, f"""
SELECT s.tree_id, s.depth, s.first_leaf, u.closest, u.closest_distance, u.farthest, u.farthest_distance, u.mean_distance FROM spots s JOIN (
  SELECT tree_id, depth, node, arg_min(gene, (dist, pos)) AS closest, CAST(min(dist) AS DOUBLE) AS closest_distance,
    arg_max(gene, (dist, pos)) AS farthest, CAST(max(dist) AS DOUBLE) AS farthest_distance, round(avg(dist), 6) AS mean_distance
  FROM (SELECT tree_id, depth, node, gene, pos, {value} AS dist FROM under) GROUP BY 1, 2, 3) u
ON s.tree_id = u.tree_id AND s.depth = u.depth AND s.node = u.node""", ("spots", "under"))
    @on_trees()
    def _(d: Domain, f: Forest, topological: bool = topological) -> DataFrame:
        rows = forest.leaf_extremes(f.nodes, topological)
        named = rows.join(f.leaf_names("closest_leaf", "closest"), ["tree_id", "closest_leaf"]).join(
            f.leaf_names("farthest_leaf", "farthest"), ["tree_id", "farthest_leaf"]
        )
        return f.shown(named, "closest", "closest_distance", "farthest", "farthest_distance", r6("mean_leaf_distance", "mean_distance"))


for name, source, topological in (("farthest_node", "far", False), ("farthest_node_topological", "far_hops", True)):

    @query(name, f"""
SELECT s.tree_id, s.depth, s.first_leaf, f.far_leaf, f.distance FROM spots s
JOIN {source} f ON s.tree_id = f.tree_id AND s.depth = f.depth AND s.node = f.node""", ("spots", source))
    @on_trees()
    def _(d: Domain, f: Forest, topological: bool = topological) -> DataFrame:
        rows = forest.farthest_node(f.nodes, topological).join(f.leaf_names("farthest", "far_leaf"), ["tree_id", "farthest"])
        return f.shown(rows, "far_leaf", "distance")


@query("midpoint_outgroup", """
SELECT m.tree_id, m.depth, s.first_leaf FROM (
  SELECT a.tree_id, CASE WHEN w.len > b.distance / 2 THEN 3 WHEN w.len + w.sp_len > b.distance / 2 THEN 2
      WHEN w.len + w.sp_len + w.side_len > b.distance / 2 THEN 1 END AS depth, w.gene, w.side, w.species
  FROM far a JOIN far b ON b.tree_id = a.tree_id AND b.depth = 3 AND b.node = a.far_leaf
  JOIN placed w ON w.tree_id = a.tree_id AND w.gene = a.far_leaf WHERE a.depth = 0) m
JOIN spots s ON s.tree_id = m.tree_id AND s.depth = m.depth
  AND s.node = CASE m.depth WHEN 3 THEN m.gene WHEN 2 THEN m.side || m.species ELSE CAST(m.side AS VARCHAR) END""", ("far", "placed", "spots"))
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    return f.shown(forest.midpoint_outgroup(f.nodes).withColumnRenamed("outgroup", "node_id"))


@query("ultrametric", """
SELECT s.tree_id, s.depth, s.first_leaf, round(CASE s.depth WHEN 0 THEN 0 WHEN 1 THEN d * side_len / (side_len + z1)
    WHEN 2 THEN d * (z1 / (side_len + z1)) * sp_len / (sp_len + z2) ELSE d * (z1 / (side_len + z1)) * (z2 / (sp_len + z2)) END, 3) AS dist
FROM spots s JOIN (SELECT *, avg(side_len + sp_len + len) OVER (PARTITION BY tree_id) AS d,
    avg(sp_len + len) OVER (PARTITION BY tree_id, side) AS z1, avg(len) OVER (PARTITION BY tree_id, side, species) AS z2 FROM placed) l
ON l.tree_id = s.tree_id AND l.gene = s.first_leaf
WHERE s.tree_id IN (SELECT tree_id FROM placed GROUP BY 1 HAVING count(DISTINCT side) = 2)""", ("spots", "placed"))
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    """Families with genes on one side only have no binary root."""
    sides = f.nodes.filter("parent_id = 0").groupBy("tree_id").agg(F.count(F.lit(1)).alias("n")).filter("n = 2")
    rooted = cut_lineage(f.nodes.join(sides, "tree_id", "left_semi"))
    return f.shown(forest.ultrametric(rooted), F.round("dist", 3).alias("dist"))


HEIGHTS = {
    "balanced": """CASE node_depth WHEN 0 THEN 0
      WHEN 1 THEN CASE WHEN r THEN 100.0 / side_m ELSE 0 END WHEN 2 THEN CASE WHEN s OR r THEN over_species / 2 ELSE 0 END
      ELSE CASE WHEN p AND (s OR r) THEN over_species / 2 WHEN p THEN 100.0 WHEN s OR r THEN over_species ELSE 0 END END""",
    "fixed": """CASE node_depth WHEN 0 THEN 0 WHEN 1 THEN CASE WHEN r THEN step ELSE 0 END WHEN 2 THEN CASE WHEN s OR r THEN step ELSE 0 END
      ELSE CASE WHEN above = 0 THEN 0 ELSE 100.0 - (above - 1) * step END END""",
}
for strategy, value in HEIGHTS.items():

    @query(f"ultrametric_{strategy}", f"""
SELECT q.tree_id, q.depth, s.first_leaf, round({value}, 6) AS dist FROM (
  SELECT n.tree_id, n.depth, n.node, n.depth AS node_depth, l.*  EXCLUDE (tree_id) FROM pruned n JOIN (
    SELECT tree_id, side, species, gene, p, s, r, side_m, CAST(p AS INT) + CAST(s AS INT) + CAST(r AS INT) AS above,
      CASE WHEN s AND r THEN 100.0 - 100.0 / side_m ELSE 100.0 END AS over_species,
      100.0 / CASE WHEN r THEN root_m WHEN s THEN side_m WHEN p THEN 2 ELSE 1 END AS step FROM levels) l
  ON l.tree_id = n.tree_id AND CASE n.depth WHEN 3 THEN l.gene = n.node WHEN 2 THEN l.side || l.species = n.node
    WHEN 1 THEN CAST(l.side AS VARCHAR) = n.node ELSE true END
  QUALIFY row_number() OVER (PARTITION BY n.tree_id, n.depth, n.node ORDER BY l.gene) = 1) q
JOIN spots s ON s.tree_id = q.tree_id AND s.depth = q.depth AND s.node = q.node""", ("pruned", "levels", "spots"))
    @on_trees()
    def _(d: Domain, f: Forest, strategy: str = strategy) -> DataFrame:
        """On pruned trees, whose leaves end at different depths."""
        flat = forest.ultrametric_by_height(cut_lineage(pruned(d, f)), 100.0, strategy)
        return f.shown(flat, r6("dist"))


@query("prune", """
SELECT p.tree_id, p.depth, s.first_leaf, p.parent_depth, CAST(p.dist AS DOUBLE) AS dist FROM pruned p
JOIN spots s ON s.tree_id = p.tree_id AND s.depth = p.depth AND s.node = p.node""", ("pruned", "spots"))
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    parents = f.spots.select("tree_id", F.col("node_id").alias("parent_id"), F.col("depth").alias("parent_depth"))
    return f.shown(pruned(d, f).join(parents, ["tree_id", "parent_id"], "left"), "parent_depth", "dist")


@query("collapse", """
SELECT s.tree_id, s.depth, s.first_leaf, CASE s.depth WHEN 0 THEN false WHEN 1 THEN l.side_len % 2 = 1 WHEN 2 THEN l.sp_len % 2 = 1 ELSE true END AS is_leaf
FROM spots s JOIN placed l ON l.tree_id = s.tree_id AND l.gene = s.first_leaf
WHERE s.depth <= 1 OR l.side_len % 2 = 0 AND (s.depth = 2 OR l.sp_len % 2 = 0)""", ("spots", "placed"))
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    return f.shown(forest.collapse(f.nodes, F.col("parent_id").isNotNull() & (F.col("dist") % 2 == 1)), "is_leaf")


@query("tree_splits", """
SELECT tree_id, n AS size, string_split(names, ',')[1] AS low, string_split(names, ',')[-1] AS high FROM clades""", "clades")
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    return forest.tree_splits(f.nodes).select("tree_id", "size", "low", "high")


@query("robinson_foulds", """
SELECT tree_id, l.common_names, count(*) FILTER (a.names IS NULL OR b.names IS NULL) AS rf, count(a.names) + count(b.names) AS max_rf
FROM clades a FULL JOIN clades_o b USING (tree_id, names)
JOIN (SELECT tree_id, count(*) AS common_names FROM leaves SEMI JOIN leaves_o USING (tree_id) GROUP BY 1) l USING (tree_id)
GROUP BY 1, 2 HAVING l.common_names > 1""", ("clades", "clades_o"))
@on_trees("F", "O")
def _(d: Domain, a: Forest, b: Forest) -> DataFrame:
    return forest.robinson_foulds(a.nodes, b.nodes).select("tree_id", "common_names", "rf", "max_rf")


@query("monophyly", """
SELECT tree_id, n_targets, CASE WHEN sides = 1 THEN 0 ELSE others END AS n_foreign,
  CASE WHEN sides = 1 OR others = 0 THEN 'monophyletic'
    WHEN other_sides = 1 AND other_species = 1 THEN 'paraphyletic' ELSE 'polyphyletic' END AS verdict FROM (
  SELECT tree_id, count(*) FILTER (species = 'AFRICA') AS n_targets, count(DISTINCT side) FILTER (species = 'AFRICA') AS sides,
    count(*) FILTER (species <> 'AFRICA') AS others,
    count(DISTINCT side) FILTER (species <> 'AFRICA') AS other_sides, count(DISTINCT species) FILTER (species <> 'AFRICA') AS other_species
  FROM leaves GROUP BY 1 HAVING count(*) FILTER (species = 'AFRICA') > 0)""", "leaves")
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    targets = d.genes.filter("species = 'AFRICA'").select(F.col("hog").alias("tree_id"), F.col("gene").alias("name"))
    return forest.monophyly(f.nodes, targets)


@query("monophyletic_clades", """
SELECT s.tree_id, s.depth, s.first_leaf, s.n_leaves FROM (
  SELECT tree_id, CASE WHEN count(*) = n_all THEN 0 WHEN count(*) = any_value(n_side) THEN 1 ELSE 2 END AS depth, any_value(side) AS side
  FROM (SELECT *, count(*) OVER (PARTITION BY tree_id) AS n_all, count(*) OVER (PARTITION BY tree_id, side) AS n_side FROM placed)
  WHERE species = 'AFRICA' GROUP BY tree_id, n_all HAVING count(DISTINCT side) = 1 OR count(*) = n_all) m
JOIN spots s ON s.tree_id = m.tree_id AND s.depth = m.depth
  AND s.node = CASE m.depth WHEN 0 THEN '' WHEN 1 THEN CAST(m.side AS VARCHAR) ELSE m.side || 'AFRICA' END""", ("placed", "spots"))
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    wanted = f.nodes.filter("is_leaf").join(
        d.genes.filter("species = 'AFRICA'").select(F.col("gene").alias("name")), "name", "left_semi"
    ).select("tree_id", "name")
    return f.shown(forest.monophyletic_clades(f.nodes, wanted), "n_leaves")


@query("relabel_tips", """
SELECT tree_id, depth, first_leaf, CASE depth WHEN 3 THEN coalesce(name, 'none') WHEN 0 THEN ''
    ELSE 'N' || row_number() OVER (PARTITION BY tree_id, depth IN (1, 2) ORDER BY depth, place) END AS name, CAST(own AS DOUBLE) AS dist
FROM spots LEFT JOIN (SELECT seqid, name FROM id_map) ON depth = 3 AND seqid = 'q' || substr(first_leaf, 2)""", ("spots", "id_map"))
@on_trees()
def _(d: Domain, f: Forest) -> DataFrame:
    names = d.id_map.select(F.col("name").alias("seqid"), "name")
    out = forest.relabel_tips(f.nodes, names, fix_negative=True, label="N")
    return f.shown(out, F.when(F.col("is_leaf"), F.coalesce("name", F.lit("none"))).otherwise(F.coalesce("name", F.lit(""))).alias("name"), "dist")


@query("connected_components", """
SELECT species, hog, count(*) AS n FROM hog_genes GROUP BY 1, 2 HAVING count(*) > 1""", "hog_genes")
def _(d: Domain) -> DataFrame:
    labels = clustering.components(d.edges).groupBy("cluster").agg(F.count("node").alias("n"))
    named = labels.join(d.hog_genes, F.col("cluster") == F.col("gene"))
    return named.select("species", "hog", "n")


@query("mcl_cluster")
def _(d: Domain) -> DataFrame:
    return clustering.mcl_cluster(d.edges)
