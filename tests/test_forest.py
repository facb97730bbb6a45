"""Tree operators against a plain walk over random trees, and on shapes that are deep or wide."""

import random

import pytest
from pyspark.sql import functions as F

from kinfold import session
from kinfold.operators import forest

SCHEMA = "tree_id string, node_id int, parent_id int, name string, dist double, support double, is_leaf boolean"


class Tree:
    """A walked tree: parents by id in reading order."""

    def __init__(self, parents, lengths):
        self.up, self.len = parents, lengths
        self.kids = {i: [j for j, p in enumerate(parents) if p == i] for i in range(len(parents))}

    def rows(self, name):
        return [(name, i, p, f"n{i}" if not self.kids[i] else None, self.len[i], None, not self.kids[i]) for i, p in enumerate(self.up)]

    def leaves(self, i):
        out, stack = [], [i]
        while stack:
            j = stack.pop()
            out += [] if self.kids[j] else [j]
            stack += self.kids[j]
        return sorted(out)

    def path(self, i):
        out = []
        while i is not None:
            out.append(i)
            i = self.up[i]
        return out

    def down(self, i, top, topological=False):
        way = self.path(i)
        way = way[: way.index(top)]
        return float(len(way)) if topological else sum(self.len[j] for j in way)

    def ancestor(self, a, b):
        over = set(self.path(b))
        return next(i for i in self.path(a) if i in over)

    def far_below(self, i, topological):
        return max((self.down(j, i, topological), j) for j in self.leaves(i))

    def farthest(self, i, topological):
        best, where = self.far_below(i, topological)
        way, here = 0.0 if topological else self.len[i], i
        while self.up[here] is not None:
            over = self.up[here]
            for kid in self.kids[over]:
                if kid != here:
                    d, leaf = self.far_below(kid, topological)
                    d += 1.0 if topological else self.len[kid]
                    if way + d > best:
                        best, where = way + d, leaf
            here = over
            way += 1.0 if topological else self.len[here]
        return where, best


def random_tree(rng, n, deep):
    parents, lengths = [None], [0.0]
    stack = [0]
    for i in range(1, n):  # reading order: the parent is on the current path
        while len(stack) > 1 and rng.random() > deep:
            stack.pop()
        parents.append(stack[-1])
        lengths.append(float(rng.randint(1, 4)))
        stack.append(i)
    return Tree(parents, lengths)


def table(spark, **trees):
    return spark.createDataFrame([r for name, t in trees.items() for r in t.rows(name)], SCHEMA)


@pytest.fixture(scope="module")
def trees():
    rng = random.Random(11)
    return {f"t{i}": random_tree(rng, rng.randint(1, 45), deep) for i, deep in enumerate([0.1, 0.5, 0.8, 0.97, 0.6, 0.3])}


@pytest.fixture(scope="module")
def nodes(spark, trees):
    return table(spark, **trees).cache()


def by_node(df, *columns):
    return {(r.tree_id, r.node_id): tuple(r[c] for c in columns) for r in df.collect()}


def every(trees):
    return [(name, t, i) for name, t in trees.items() for i in range(len(t.up))]


@pytest.mark.parametrize("topological", [False, True])
def test_extremes_and_farthest(trees, nodes, topological):
    got = by_node(forest.leaf_extremes(nodes, topological), "closest_leaf", "closest_distance", "farthest_leaf", "farthest_distance", "mean_leaf_distance", "height")
    far = by_node(forest.farthest_node(nodes, topological), "farthest", "distance")
    for name, t, i in every(trees):
        below = [(t.down(j, i, topological), j) for j in t.leaves(i)]
        near, most = min(below), max(below)
        height = max(int(t.down(j, i, True)) for j in t.leaves(i))
        assert got[name, i][:4] == (near[1], near[0], most[1], most[0]) and got[name, i][5] == height
        assert got[name, i][4] == pytest.approx(sum(d for d, _ in below) / len(below))
        assert far[name, i] == t.farthest(i, topological), (name, i)


def test_ranges_paths_and_ancestors(spark, trees, nodes):
    under = by_node(forest.leaves_under(nodes), "first_leaf", "last_leaf", "n_leaves")
    numbers = by_node(forest.leaf_numbers(nodes), "number")
    for name, t, i in every(trees):
        below = t.leaves(i)
        assert under[name, i] == (numbers[name, below[0]][0], numbers[name, below[-1]][0], len(below))
    asked = [(name, i, j) for name, t in trees.items() for i in range(0, len(t.up), 3) for j in range(len(t.up))]
    df = spark.createDataFrame(asked, "tree_id string, node_a int, node_b int")
    found = {(r.tree_id, r.node_a, r.node_b): r.ancestor_id for r in forest.common_ancestor(nodes, df).collect()}
    far = {(r.tree_id, r.node_a, r.node_b): (r.distance, r.nodes_between) for r in forest.pair_distance(nodes, df).collect()}
    for name, i, j in asked:
        t = trees[name]
        top = t.ancestor(i, j)
        assert found[name, i, j] == top and far[name, i, j][0] == pytest.approx(t.down(i, top) + t.down(j, top))
        assert far[name, i, j][1] == max(0.0, t.down(i, top, True) + t.down(j, top, True) - 1)


def test_collapse_stops_at_the_highest(trees, nodes):
    stop = (F.col("node_id") % 4 == 1) & F.col("parent_id").isNotNull()
    got = by_node(forest.collapse(nodes, stop), "is_leaf")
    for name, t, i in every(trees):
        hidden = any(j % 4 == 1 and t.up[j] is not None for j in t.path(i)[1:])
        assert ((name, i) in got) != hidden
        if not hidden:
            assert got[name, i] == (not t.kids[i] or (i % 4 == 1 and t.up[i] is not None),)


@pytest.mark.parametrize("preserve", [False, True])
def test_prune(trees, nodes, preserve):
    keep = nodes.filter("is_leaf and node_id % 3 <> 0")
    got = by_node(forest.prune(nodes, keep, preserve), "parent_id", "dist")
    for name, t in trees.items():
        tips = {i for i in range(len(t.up)) if not t.kids[i] and i % 3}
        used = {j for i in tips for j in t.path(i)}
        stay = tips | {i for i in used if sum(k in used for k in t.kids[i]) > 1}
        assert {i for n, i in got if n == name} == stay
        for i in stay:
            over = next((j for j in t.path(i)[1:] if j in stay), None)
            length = 0.0 if over is None else t.down(i, over) if preserve else t.len[i]
            assert got[name, i] == (over, length)


def test_ultrametric_by_height(trees, nodes):
    for strategy in ("balanced", "fixed"):
        got = by_node(forest.ultrametric_by_height(nodes, 12.0, strategy), "dist")
        for name, t in trees.items():
            levels = {i: max(int(t.down(j, i, True)) for j in t.leaves(i)) + 1 for i in range(len(t.up))}
            at = {0: 0.0}
            for i in range(1, len(t.up)):
                if strategy == "balanced":
                    want = (12.0 - at[t.up[i]]) / levels[i]
                    at[i] = at[t.up[i]] + want
                else:
                    step = 12.0 / levels[0]
                    want = step if t.kids[i] else 12.0 - at[t.up[i]] * step
                    at[i] = at[t.up[i]] + 1
                assert got[name, i][0] == pytest.approx(want), (strategy, name, i)
    with pytest.raises(ValueError, match="strategy"):
        forest.ultrametric_by_height(nodes, 1.0, "other")


def test_splits_and_verdicts(spark, trees, nodes):
    got = {}
    for r in forest.tree_splits(nodes).collect():
        got.setdefault(r.tree_id, set()).add((r["size"], r.low, r.high))
    targets = [(name, f"n{i}") for name, t in trees.items() for i in t.leaves(0) if i % 2]
    df = spark.createDataFrame(targets, "tree_id string, name string")
    verdicts = {r.tree_id: r.verdict for r in forest.monophyly(nodes, df).collect()}
    for name, t in trees.items():
        clades = {frozenset(f"n{j}" for j in t.leaves(i)) for i in range(len(t.up)) if len(t.leaves(i)) > 1}
        assert len(got.get(name, ())) <= len(clades) and got.get(name, set()) == {(len(c), min(c), max(c)) for c in clades}
        mine = {i for i in t.leaves(0) if i % 2}
        if mine:
            top = max(i for i in range(len(t.up)) if mine <= set(t.leaves(i)))
            foreign = set(t.leaves(top)) - mine
            mixed = foreign and mine & set(t.leaves(max(i for i in range(len(t.up)) if foreign <= set(t.leaves(i)))))
            assert verdicts[name] == ("monophyletic" if not foreign else "polyphyletic" if mixed else "paraphyletic")


def test_pure_clades_of_repeated_names(spark):
    t = Tree([None, 0, 1, 1, 0, 4, 4, 4, 0], [0.0] + [1.0] * 8)
    rows = [(*r[:3], {2: "a", 3: "b", 5: "a", 6: "a", 7: "b", 8: "c"}.get(r[1]), *r[4:]) for r in t.rows("t")]
    nodes = spark.createDataFrame(rows, SCHEMA)
    wanted = spark.createDataFrame([("t", "a"), ("t", "b")], "tree_id string, name string")
    assert sorted(by_node(forest.monophyletic_clades(nodes, wanted))) == [("t", 1), ("t", 4)]


def test_a_caterpillar_of_many_leaves(spark, monkeypatch):
    """Spine nodes with one leaf each: no table of a round has more rows than the tree has nodes."""
    n = 5000
    rows = []
    spine = None
    for i in range(2 * n):  # reading order: spine node, its leaf, next spine node
        leaf = i % 2 == 1
        rows.append(("t", i, i - 1 if leaf else spine, f"n{i}" if leaf else None, 1.0, None, leaf))
        if not leaf:
            spine = i
    nodes = spark.createDataFrame(rows, SCHEMA)
    sizes, cut = [], session.cut_lineage

    def watched(df):
        out = cut(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(session, "cut_lineage", watched)
    monkeypatch.setattr(forest, "cut_lineage", watched)
    got = by_node(forest.leaf_extremes(nodes), "farthest_leaf", "farthest_distance", "height")
    assert got["t", 0] == (2 * n - 1, float(n), n) and got["t", 2 * n - 2] == (2 * n - 1, 1.0, 1)
    assert len(sizes) < 60 and max(sizes) <= 2 * n
    before = len(sizes)
    under = by_node(forest.leaves_under(nodes), "n_leaves")
    assert under["t", 0] == (n,) and under["t", 2 * n - 4] == (2,)
    assert len(sizes) - before < 20 and max(sizes) <= 2 * n


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert forest.leaf_extremes(none).collect() == [] and forest.leaves_under(none).collect() == []
    assert forest.farthest_node(none).collect() == [] and forest.collapse(none, F.lit(True)).collect() == []
    assert forest.midpoint_outgroup(none).collect() == [] and forest.tree_splits(none).collect() == []


def test_trees_kept_together_give_the_same_rows_without_shuffles(spark):
    rng = random.Random(11)
    rows = []
    for t in range(6):
        parents = [None] + [rng.randrange(max(0, i - 4), i) for i in range(1, 40)]
        order, kids = [], {i: [j for j, p in enumerate(parents) if p == i] for i in range(40)}
        stack = [0]
        while stack:
            i = stack.pop()
            order.append(i)
            stack += reversed(kids[i])
        place = {i: k for k, i in enumerate(order)}
        up = [None if parents[i] is None else place[parents[i]] for i in order]
        rows += Tree(up, [0.0 if p is None else float(rng.randrange(1, 9)) for p in up]).rows(f"t{t}")
    nodes = spark.createDataFrame(rows, SCHEMA)
    works = [forest.tree_paths, forest.leaves_under, forest.leaf_extremes, forest.farthest_node, forest.midpoint_outgroup]
    want = [sorted(map(tuple, work(nodes).collect())) for work in works]
    with session.kept_together(spark, "tree_id", 3):
        kept = session.cut_lineage(nodes)
        assert [sorted(map(tuple, work(kept).collect())) for work in works] == want
        joined = kept.join(forest.tree_paths(kept), forest.KEY).groupBy(*forest.KEY).count()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        none, measured = session.cut_measured(kept.filter("node_id < 0").groupBy("name").agg(F.max("tree_id").alias("tree_id")), rows=F.count("*"))
        assert measured == {"rows": 0} and none.count() == 0
    assert not session.is_kept_together()
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
