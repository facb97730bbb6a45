import random
from statistics import median

import numpy as np
import pytest

from kinfold.functions import order
from kinfold.operators import clustering, counts, forest
from kinfold.sources.newick import parse_newick


def test_median_with_a_hot_value(spark):
    rng = random.Random(3)
    data = {g: [rng.choice([0.25, -1.0, rng.gauss(0, 3)]) for _ in range(n)] for g, n in {"a": 301, "b": 300, "c": 1, "d": 2}.items()}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    got = {r.g: r.m for r in order.exact_median(df, ["g"], "v", "m").collect()}
    assert got == pytest.approx({g: median(vs) for g, vs in data.items()})


def test_bh_with_ties_and_nulls(spark):
    rng = random.Random(5)
    rows = [(s, i, rng.choice([None, 0.01, rng.random(), rng.random() ** 6])) for s in "xy" for i in range(400)]
    df = spark.createDataFrame(rows, "species string, i int, pvalue double")
    got = {(r.species, r.i): r.padj for r in counts.bh_adjust(df).collect()}
    for s in "xy":
        known = sorted(((p, i) for t, i, p in rows if t == s and p is not None), reverse=True)
        low = 1.0
        for k, (p, i) in enumerate(known):
            low = min(low, p * len(known) / (len(known) - k))
            assert got[s, i] == pytest.approx(low)
    assert all(got[s, i] is None for s, i, p in rows if p is None)


def test_two_group_test(spark):
    rng = np.random.default_rng(2)
    samples = ["c1", "c2", "c3", "t1", "t2", "t3"]
    condition = {s: "control" if s[0] == "c" else "treated" for s in samples}
    depth = np.array([1.0, 1.5, 0.7, 1.2, 0.9, 2.0])
    fold = np.where(np.arange(300) < 30, 8.0, 1.0)
    base = rng.uniform(50, 500, 300)
    mean = base[:, None] * depth * np.where(np.array([s[0] == "t" for s in samples]), fold[:, None], 1.0)
    table = rng.poisson(rng.gamma(20, mean / 20))
    long = spark.createDataFrame([(f"g{i}", s, int(table[i, j])) for i in range(300) for j, s in enumerate(samples)], "gene string, sample string, count long")
    rows = counts.count_rows(long, samples)
    factors = counts.size_factors(rows, samples)
    logs = np.log(table)
    want = np.exp(np.median(logs - logs.mean(axis=1, keepdims=True), axis=0))
    got = {r["sample"]: r.size_factor for r in factors.collect()}
    assert [got[s] for s in samples] == pytest.approx(list(want))
    tested = counts.de_test(
        counts.group_dispersion(counts.with_factors(rows, factors, samples), samples, condition), samples, condition)
    out = {r.gene: r for r in counts.bh_adjust(tested.selectExpr("'a' species", "*")).collect()}
    found = {g for g, r in out.items() if r.padj < 0.05}
    true = {f"g{i}" for i in range(30)}
    assert len(true & found) >= 28 and len(found - true) <= 30
    assert np.mean([out[g].log2FoldChange for g in true]) == pytest.approx(3.0, abs=0.25)


def test_overlaps_against_brute_force(spark):
    rng = random.Random(9)
    reads = [("s", rng.choice("ab"), f"r{i % 150}", i % 2, (p := rng.randint(1, 3000)), p + rng.randint(0, 400)) for i in range(300)]
    parts = [(rng.choice("ab"), f"g{i % 12}", (p := rng.randint(1, 3000)), p + rng.randint(0, 700)) for i in range(40)]
    a = spark.createDataFrame(reads, "sample string, chrom string, read_id string, hit_index int, start long, end long")
    f = spark.createDataFrame(parts, "chrom string, gene_id string, start long, end long")
    want = {}
    for _, chrom, rid, hit, s, e in reads:
        for g in {g for c, g, fs, fe in parts if c == chrom and s <= fe and fs <= e}:
            want.setdefault(g, set()).add((rid, hit))
    for width in (64, 4096):
        got = {r.gene_id: r["count"] for r in counts.count_features(a, f, width=width).collect()}
        assert got == {g: len(v) for g, v in want.items()}


def forest_of(spark, **trees):
    return parse_newick(spark.createDataFrame(list(trees.items()), "tree_id string, newick string"), 1)


def test_paths_and_extremes(spark):
    nodes = forest_of(spark, t="((A:1,B:2)X:1,((C:5,D:1)Y:1,E:1)Z:2)R;")
    by_name = {r.name: r.node_id for r in nodes.collect()}
    paths = {r.node_id: (r.depth, r.root_distance) for r in forest.tree_paths(nodes).collect()}
    assert paths[by_name["C"]] == (3, 8.0) and paths[by_name["R"]] == (0, 0.0)
    ext = {r.node_id: r for r in forest.leaf_extremes(nodes).collect()}
    assert ext[by_name["R"]].closest_leaf == by_name["A"] and ext[by_name["R"]].farthest_leaf == by_name["C"]
    wanted = spark.createDataFrame([("t", by_name["A"], by_name["C"]), ("t", by_name["C"], by_name["D"])], "tree_id string, node_a int, node_b int")
    assert {r.node_a: r.distance for r in forest.pair_distance(nodes, wanted).collect()} == {by_name["A"]: 10.0, by_name["C"]: 6.0}
    assert {r.nodes_between for r in forest.pair_distance(nodes, wanted).collect()} == {4.0, 1.0}
    far = {r.node_id: (r.farthest, r.distance) for r in forest.farthest_node(nodes).collect()}
    assert far[by_name["C"]] == (by_name["B"], 11.0)
    assert forest.midpoint_outgroup(nodes).first().outgroup == by_name["Y"]


def test_ultrametric(spark):
    nodes = forest_of(spark, t="((A:1,B:3)X:2,(C:4,D:4)Y:2)R;")
    flat = forest.ultrametric(nodes)
    depth = forest.tree_paths(flat).join(nodes.filter("is_leaf"), forest.KEY)
    assert [r.root_distance for r in depth.collect()] == pytest.approx([5.0] * 4)
    old = forest.tree_paths(forest.ultrametric(nodes, root_age=10.0)).join(nodes.filter("is_leaf"), forest.KEY)
    assert [r.root_distance for r in old.collect()] == pytest.approx([10.0] * 4)
    three = forest_of(spark, t="(A:1,B:3,C:2);")
    with pytest.raises(ValueError, match="rooted"):
        forest.ultrametric(three)


def test_prune_splits_and_monophyly(spark):
    nodes = forest_of(spark, t="((A:1,B:2)X:1,((C:5,D:1)Y:1,E:1)Z:2)R;", u="((A:1,C:1):1,((B:1,D:1):1,E:1):1);")
    names = spark.createDataFrame([("A",), ("C",), ("D",)], "name string")
    kept = {r.name: r.dist for r in forest.keep_tips(nodes, names).filter("tree_id = 't'").collect()}
    assert kept == {"R": 0.0, "A": 2.0, "Y": 3.0, "C": 5.0, "D": 1.0}
    t, u = nodes.filter("tree_id = 't'"), nodes.filter("tree_id = 'u'").selectExpr("'t' tree_id", "node_id", "parent_id", "name", "dist", "support", "is_leaf")
    rf = forest.robinson_foulds(t, u).first()
    assert (rf.common_names, rf.rf, rf.max_rf) == (5, 6, 8)

    def verdict(*leaves):
        targets = spark.createDataFrame([("t", n) for n in leaves], "tree_id string, name string")
        return forest.monophyly(t, targets).first().verdict

    assert verdict("C", "D") == "monophyletic"
    assert verdict("C", "E") == "paraphyletic"
    assert verdict("A", "C") == "polyphyletic"


def test_relabel(spark):
    nodes = forest_of(spark, t="((a:1,b:-2)x:1,c:4)r;")
    ids = spark.createDataFrame([(n, n.upper()) for n in "abc"], "seqid string, name string")
    rows = {r.name: r.dist for r in forest.relabel_tips(nodes, ids, fix_negative=True, label="N").collect()}
    assert rows["B"] == pytest.approx(4e-6) and rows["N1"] == 1.0 and set(rows) == {"A", "B", "C", "N1", "r"}


def test_inner_labels_count_by_level_and_ties_take_the_last_leaf(spark):
    nodes = forest_of(spark, t="((A:1,(B:1,C:1)u:1)v:1,(D:1,E:1)w:1)r;")
    ids = spark.createDataFrame([(n, n) for n in "ABCDE"], "seqid string, name string")
    before = {r.node_id: r.name for r in nodes.collect()}
    after = {before[r.node_id]: r.name for r in forest.relabel_tips(nodes, ids, label="N").collect()}
    assert (after["v"], after["w"], after["u"]) == ("N1", "N2", "N3")
    nodes = forest_of(spark, t="((A:1,B:2)X:1,((C:5,D:5)Y:1,E:1)Z:1)R;")
    names = {r.node_id: r.name for r in nodes.collect()}
    top = {r.node_id: r for r in forest.leaf_extremes(nodes).collect()}
    root = next(k for k, v in names.items() if v == "R")
    assert names[top[root].farthest_leaf] == "D" and names[top[root].closest_leaf] == "A"


def test_paths_of_a_caterpillar_stay_linear(spark):
    n = 600
    rows = [("t", i, i - 1 if i else None, None, 1.0, None, False) for i in range(n)]
    nodes = spark.createDataFrame(rows, "tree_id string, node_id int, parent_id int, name string, dist double, support double, is_leaf boolean")
    got = forest.tree_paths(nodes).collect()
    assert sorted((r.depth, r.root_distance) for r in got) == [(i, float(i)) for i in range(n)]


def test_clusters_of_two_cliques(spark):
    groups = ["abcd", "wxyz"]
    edges = [(g[i], g[j], 1.0) for g in groups for i in range(4) for j in range(i + 1, 4)] + [("d", "w", 0.05)]
    df = spark.createDataFrame(edges, "a string, b string, weight double")
    got = {r.node: r.cluster for r in clustering.mcl_cluster(df, inflation=2.0).collect()}
    assert got == {**dict.fromkeys("abcd", "a"), **dict.fromkeys("wxyz", "w")}


def test_small_and_large_components_give_the_same_clusters(spark, monkeypatch):
    """A path, a star, a ring and two cliques with a bridge: as matrices, by joins, and some each way."""
    edges = [(f"p{i}", f"p{i + 1}", 1.0 + i % 3) for i in range(9)] + [("s0", f"s{i}", 2.0 + i) for i in range(1, 6)]
    edges += [(f"r{i}", f"r{(i + 1) % 5}", 1.0 + 0.1 * i) for i in range(5)] + [("p0", "p0", 9.0), ("n0", "n1", None), ("s0", "n0", None)]
    edges += [(f"{g}{i}", f"{g}{j}", 1.0 + i) for g in "xy" for i in range(4) for j in range(i)] + [("x0", "y0", 0.1)]
    df = spark.createDataFrame(edges, "a string, b string, weight double")
    found = []
    for small, chunk in ((64, 1 << 15), (64, 4), (5, 8), (0, 8)):
        monkeypatch.setattr(clustering, "SMALL", small)
        monkeypatch.setattr(clustering, "CHUNK_EDGES", chunk)
        found.append(sorted(map(tuple, clustering.mcl_cluster(df).collect())))
    assert found[1:] == found[:1] * 3 and len(found[0]) == 29
    assert clustering.mcl_cluster(df.limit(0)).count() == 0
