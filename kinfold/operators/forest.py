"""Work on many trees at once, as a node table.

Node rows are (tree_id, node_id, parent_id, name, dist, support, is_leaf); node ids count in
reading order, so a parent precedes its children and what is below a node is a range of ids. No operator makes
(node, ancestor) pairs; all of them keep one row per node, whatever the shape of the tree:

* ``climb`` folds values along the way up by doubling pointers, up to the root or to fences;
* ``fold_up`` folds leaf values into all nodes by contraction: finished children are raked into their parents, chains of nodes
  with one open child are composed by doubling and taken out;
* ``intervals`` gives the end of each node's range, ``common_ancestor`` lifts asked nodes by powers of two.

Rounds grow with the logarithm of the depth. Each round's table is written, which cuts its lineage. Within ``session.kept_together``
the nodes of a tree stay in one bucket and only new rows are shuffled; trees too large for that are worked on outside of it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.order import running_total
from kinfold.session import cut_lineage, cut_measured, is_kept_together

KEY = ["tree_id", "node_id"]
NODE_COLUMNS = ["tree_id", "node_id", "parent_id", "name", "dist", "support", "is_leaf"]
NEGATIVE_BRANCH_SHARE = 1e-6  # fixed value: replacement of a negative branch, as share of the tree length


def _length() -> Column:
    return F.coalesce("dist", F.lit(0.0))


def _is_root() -> Column:
    return F.col("parent_id").isNull()


def _advanced(state: DataFrame, going: str, ahead: DataFrame, on: list[str], moved: dict[str, Column]) -> DataFrame:
    """The rows marked ``going`` with what ``moved`` makes of them and of their row ``ahead``; the others as they are.

    ``ahead`` has a column goes_on without nulls. Rows kept together meet in one join, which does not move them; otherwise
    finished rows take no part in the join.
    """
    if is_kept_together():
        both = state.join(ahead, on, "left").filter(~F.col(going) | F.col("goes_on").isNotNull())
        return both.select(*[F.when(F.col(going), moved[c]).otherwise(F.col(c)).alias(c) if c in moved else c for c in state.columns])
    went = state.filter(going).join(ahead, on).select(*[moved[c].alias(c) if c in moved else c for c in state.columns])
    return state.filter(~F.col(going)).unionByName(went)


# Up: values along the way to the root.


def climb(
    nodes: DataFrame,
    own: dict[str, Column],
    above: dict[str, Column],
    fences: DataFrame | None = None,
) -> DataFrame:
    """Fold of ``own`` values from each node upwards: (tree_id, node_id, up, *own).

    ``own`` is a node's part for the step to its parent, neutral at a root. ``above`` says how a value goes on: an
    expression over its own column and ``above_<name>``, that of the node reached so far; it must be associative. The way ends behind
    the root (up is null) or at the nearest proper ancestor in ``fences`` (tree_id, node_id), whose own part is not included.
    Pointers double their reach every round; finished rows no longer take part.
    """
    state = nodes.select(*KEY, F.col("parent_id").alias("up"), *[c.alias(n) for n, c in own.items()])
    if fences is None:
        state = state.withColumn("open", F.col("up").isNotNull())
    else:
        stops = fences.select("tree_id", F.col("node_id").alias("up")).distinct().withColumn("fence", F.lit(True))
        state = state.join(stops, ["tree_id", "up"], "left").withColumn(
            "open", F.col("up").isNotNull() & F.col("fence").isNull()
        ).drop("fence")
    state, left = cut_measured(state, rows=F.count_if("open"))
    while left["rows"]:
        ahead = state.select(
            "tree_id", F.col("node_id").alias("up"), F.col("up").alias("next"), F.col("open").alias("goes_on"),
            *[F.col(n).alias(f"above_{n}") for n in own],
        )
        moved = {"up": F.col("next"), **above, "open": F.col("goes_on")}
        state, left = cut_measured(_advanced(state, "open", ahead, ["tree_id", "up"], moved), rows=F.count_if("open"))
    return state.select(*KEY, "up", *own)


def tree_paths(nodes: DataFrame) -> DataFrame:
    """Depth and root distance of every node."""
    own = {
        "depth": F.when(_is_root(), 0).otherwise(1),
        "root_distance": F.when(_is_root(), 0.0).otherwise(_length()),
    }
    return climb(nodes, own, {n: F.col(n) + F.col(f"above_{n}") for n in own}).drop("up")


def nearest_above(nodes: DataFrame, fences: DataFrame) -> DataFrame:
    """Nearest proper ancestor of each node among the fences: (tree_id, node_id, up, hops, distance); up is null without one."""
    own = {"hops": F.when(_is_root(), 0).otherwise(1), "distance": F.when(_is_root(), 0.0).otherwise(_length())}
    return climb(nodes, own, {n: F.col(n) + F.col(f"above_{n}") for n in own}, fences)


def collapse(nodes: DataFrame, stop: Column) -> DataFrame:
    """Node table in which every node that meets ``stop`` counts as a leaf, and what is below it is left out."""
    stops = nodes.filter(stop & ~F.col("is_leaf")).select(*KEY)
    below = nearest_above(nodes, stops).filter(F.col("up").isNotNull())
    kept = nodes.join(below, KEY, "left_anti")
    cut = stops.withColumn("cut", F.lit(True))
    return kept.join(cut, KEY, "left").withColumn("is_leaf", F.col("is_leaf") | F.col("cut").isNotNull()).select(*NODE_COLUMNS)


# Down: ranges of ids and values of leaves.


def intervals(nodes: DataFrame) -> DataFrame:
    """End of each node's range: (tree_id, node_id, last), so that below a node are the ids from node_id to last.

    The last node below is the last one below the last child, so pointers run down the last children.
    """
    last_child = nodes.filter(~_is_root()).groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(
        F.max("node_id").alias("child")
    )
    state, left = cut_measured(
        nodes.select(*KEY).join(last_child, KEY, "left").select(
            *KEY, F.coalesce("child", "node_id").alias("last"), F.col("child").isNotNull().alias("open")
        ),
        rows=F.count_if("open"),
    )
    while left["rows"]:
        ahead = state.select(
            "tree_id", F.col("node_id").alias("last"), F.col("last").alias("further"), F.col("open").alias("goes_on")
        )
        moved = {"last": F.col("further"), "open": F.col("goes_on")}
        state, left = cut_measured(_advanced(state, "open", ahead, ["tree_id", "last"], moved), rows=F.count_if("open"))
    return state.drop("open")


def leaf_numbers(nodes: DataFrame) -> DataFrame:
    """Leaves numbered from 1 in reading order: (tree_id, node_id, name, number)."""
    upto = running_total(nodes.select(*KEY, "name", "is_leaf"), ["tree_id"], "node_id", F.col("is_leaf").cast("long"), "number")
    return upto.filter("is_leaf").select(*KEY, "name", "number")


def leaves_under(nodes: DataFrame) -> DataFrame:
    """Leaves below every node as a range of leaf numbers: (tree_id, node_id, last, first_leaf, last_leaf, n_leaves)."""
    return marked_under(nodes, F.lit(True)).select(
        *KEY, "last", (F.col("before") + 1).alias("first_leaf"), (F.col("before") + F.col("n_marked")).alias("last_leaf"),
        F.col("n_leaves"),
    )


def marked_under(nodes: DataFrame, mark: Column) -> DataFrame:
    """Per node, its leaves and those of them that meet ``mark``: differences of running counts at the ends of its range."""
    flags = nodes.select(*KEY, F.col("is_leaf").cast("long").alias("leaf"), (F.col("is_leaf") & mark).cast("long").alias("hit"))
    upto = running_total(flags, ["tree_id"], "node_id", F.col("leaf"), "leaves_upto")
    upto = running_total(upto, ["tree_id"], "node_id", F.col("hit"), "hits_upto")
    ends = upto.select("tree_id", F.col("node_id").alias("last"), F.col("leaves_upto").alias("leaves_end"), F.col("hits_upto").alias("hits_end"))
    return upto.join(intervals(nodes), KEY).join(ends, ["tree_id", "last"]).select(
        *KEY, "last", (F.col("hits_upto") - F.col("hit")).alias("before"),
        (F.col("leaves_end") - F.col("leaves_upto") + F.col("leaf")).alias("n_leaves"),
        (F.col("hits_end") - F.col("hits_upto") + F.col("hit")).alias("n_marked"),
    )


class Fold(NamedTuple):
    """What ``fold_up`` does with the struct of a node: that of a leaf, seen from the upper end of a branch, of many, of two."""

    leaf: Column
    moved: Callable[[Column, Column, Column], Column]  # value, length, hops
    merged: Callable[[Column], Column]  # an aggregate
    both: Callable[[Column, Column], Column]


def _either(fold: Fold, a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(fold.both(a, b))


def fold_up(nodes: DataFrame, fold: Fold) -> DataFrame:
    """Folded leaf values of every node: (tree_id, node_id, value), by rake and compress.

    Each round, finished nodes hand their values to their parents. Where that removes less than a quarter of the nodes, there are chains of nodes
    with one open child each, and these are taken out: each learns, by doubling, what it adds to the value at the end of its chain, and that end is
    hung below the chain. So the number of rounds is logarithmic in the number of nodes. At the end the chains are
    filled in, last taken out first.
    """
    key = ["tree_id", "node_id"]
    children = nodes.filter(~_is_root()).groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(F.count(F.lit(1)).alias("n"))
    rows = F.count(F.lit(1))
    live, left = cut_measured(
        nodes.join(children, key, "left").select(
            *key, "parent_id", _length().alias("length"), F.lit(1).alias("hops"), F.coalesce("n", F.lit(0)).alias("open"),
            F.when(F.col("is_leaf"), fold.leaf).alias("value"),
        ),
        rows=rows,
    )
    finished, chains = [], []
    while left["rows"]:
        ready, rest = live.filter("open = 0"), live.filter("open > 0")
        finished.append(ready.select(*key, "value"))
        given = (
            ready.filter(~_is_root())
            .select("tree_id", F.col("parent_id").alias("node_id"), fold.moved(F.col("value"), F.col("length"), F.col("hops")).alias("v"))
            .groupBy(*key).agg(fold.merged(F.col("v")).alias("given"), F.count(F.lit(1)).alias("n"))
        )
        before = left["rows"]
        live, left = cut_measured(
            rest.join(given, key, "left").select(
                *key, "parent_id", "length", "hops", (F.col("open") - F.coalesce("n", F.lit(0))).alias("open"),
                _either(fold, F.col("value"), F.col("given")).alias("value"),
            ),
            rows=rows,
            single=F.count_if(F.col("open") == 1),
        )
        if left["single"] > 1 and 4 * left["rows"] > 3 * before:
            live, chain = _without_chains(live, fold)
            chains.append(chain)
            left = {"rows": live.count()}
    known = reduce(DataFrame.unionByName, finished) if finished else nodes.limit(0).select(*key, fold.leaf.alias("value"))
    for chain in reversed(chains):
        at_end = known.select("tree_id", F.col("node_id").alias("end"), F.col("value").alias("end_value"))
        filled = chain.join(at_end, ["tree_id", "end"]).select(
            *key, _either(fold, F.col("adds"), fold.moved(F.col("end_value"), F.col("way"), F.col("steps"))).alias("value")
        )
        known = cut_lineage(known.unionByName(filled))
    return known


def _without_chains(live: DataFrame, fold: Fold) -> tuple[DataFrame, DataFrame]:
    """The live nodes without those that have one open child, and the latter as (tree_id, node_id, end, adds, way, steps)."""
    key = ["tree_id", "node_id"]
    single = live.filter("open = 1")
    hung = live.select("tree_id", F.col("parent_id").alias("node_id"), F.col("node_id").alias("end"), F.col("length").alias("way"), F.col("hops").alias("steps"))
    inside = single.select("tree_id", F.col("node_id").alias("end")).withColumn("goes_on", F.lit(True))
    chain, left = cut_measured(
        single.select(*key, F.col("value").alias("adds")).join(hung, key).join(inside, ["tree_id", "end"], "left")
        .select(*key, "end", "adds", "way", "steps", F.col("goes_on").isNotNull().alias("going")),
        rows=F.count_if("going"),
    )
    while left["rows"]:
        ahead = chain.select(
            "tree_id", F.col("node_id").alias("end"), F.col("end").alias("next"), F.col("adds").alias("next_adds"),
            F.col("way").alias("next_way"), F.col("steps").alias("next_steps"), F.col("going").alias("goes_on"),
        )
        further = F.when(F.col("next_adds").isNotNull(), fold.moved(F.col("next_adds"), F.col("way"), F.col("steps")))
        moved = {
            "end": F.col("next"), "adds": _either(fold, F.col("adds"), further), "way": F.col("way") + F.col("next_way"),
            "steps": F.col("steps") + F.col("next_steps"), "going": F.col("goes_on"),
        }
        chain, left = cut_measured(_advanced(chain, "going", ahead, ["tree_id", "end"], moved), rows=F.count_if("going"))
    chain = chain.drop("going")
    tops = (
        single.select(*key, "parent_id", "length", "hops")
        .join(single.select("tree_id", F.col("node_id").alias("parent_id")), ["tree_id", "parent_id"], "left_anti").join(chain, key)
    )
    hang = tops.select(
        "tree_id", F.col("end").alias("node_id"), F.col("parent_id").alias("new_parent"), (F.col("length") + F.col("way")).alias("new_length"),
        (F.col("hops") + F.col("steps")).alias("new_hops"), F.lit(True).alias("hung"),
    )
    given = (
        tops.filter(F.col("parent_id").isNotNull() & F.col("adds").isNotNull())
        .select("tree_id", F.col("parent_id").alias("node_id"), fold.moved(F.col("adds"), F.col("length"), F.col("hops")).alias("v"))
        .groupBy(*key).agg(fold.merged(F.col("v")).alias("given"))
    )
    rest = live.filter("open <> 1").join(hang, key, "left").join(given, key, "left").select(
        *key,
        F.when(F.col("hung"), F.col("new_parent")).otherwise(F.col("parent_id")).alias("parent_id"),
        F.coalesce("new_length", "length").alias("length"), F.coalesce("new_hops", "hops").alias("hops"), "open",
        _either(fold, F.col("value"), F.col("given")).alias("value"),
    )
    return cut_lineage(rest), chain


def _named(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def extremes_fold(topological: bool = False) -> Fold:
    """Number of leaves, sum of their distances, nearest (first on ties) and farthest (last on ties), largest number of hops."""
    zero = _named(distance=F.lit(0.0), leaf=F.col("node_id"))

    def moved(v: Column, length: Column, hops: Column) -> Column:
        step = hops.cast("double") if topological else length
        return _named(
            n=v["n"], total=v["total"] + v["n"] * step, hops=v["hops"] + hops,
            near=_named(distance=v["near"]["distance"] + step, leaf=v["near"]["leaf"]),
            far=_named(distance=v["far"]["distance"] + step, leaf=v["far"]["leaf"]),
        )

    return Fold(
        _named(n=F.lit(1).cast("long"), total=F.lit(0.0), hops=F.lit(0), near=zero, far=zero),
        moved,
        lambda v: _named(n=F.sum(v["n"]), total=F.sum(v["total"]), hops=F.max(v["hops"]), near=F.min(v["near"]), far=F.max(v["far"])),
        lambda a, b: _named(
            n=a["n"] + b["n"], total=a["total"] + b["total"], hops=F.greatest(a["hops"], b["hops"]),
            near=F.least(a["near"], b["near"]), far=F.greatest(a["far"], b["far"]),
        ),
    )


def leaf_extremes(nodes: DataFrame, topological: bool = False) -> DataFrame:
    """Closest leaf (on ties the first in reading order) and farthest leaf (the last) below every node, and the mean distance.

    Topological distances count branches.
    """
    return fold_up(nodes, extremes_fold(topological)).select(
        *KEY,
        F.col("value.near.leaf").alias("closest_leaf"), F.col("value.near.distance").alias("closest_distance"),
        F.col("value.far.leaf").alias("farthest_leaf"), F.col("value.far.distance").alias("farthest_distance"),
        (F.col("value.total") / F.col("value.n")).alias("mean_leaf_distance"), F.col("value.hops").alias("height"),
    )


def mean_leaf_distance(nodes: DataFrame) -> DataFrame:
    return leaf_extremes(nodes).select(*KEY, "mean_leaf_distance")


def farthest_node(nodes: DataFrame, topological: bool = False) -> DataFrame:
    """Farthest leaf from every node in any direction: (tree_id, node_id, farthest, distance).

    From below comes the farthest leaf under the node; from above, per step up, the best sibling branch, which is the parent's best branch or,
    on the way through that one, its second best. Ties go to what is below, then to the nearest ancestor, then to its first branch.
    Topological distances count branches below the node, and the nodes in between otherwise.
    """
    below = cut_lineage(leaf_extremes(nodes, topological).select(*KEY, "farthest_leaf", "farthest_distance"))
    step = F.lit(1.0) if topological else _length()
    branches = nodes.filter(~_is_root()).join(below, KEY).select(
        "tree_id", "parent_id", "node_id",
        _named(reach=step + F.col("farthest_distance"), first=-F.col("node_id"), leaf=F.col("farthest_leaf")).alias("branch"),
    )
    best = branches.groupBy("tree_id", "parent_id").agg(F.max("branch").alias("best"))
    second = (
        branches.join(best, ["tree_id", "parent_id"]).filter(F.col("branch.first") != F.col("best.first"))
        .groupBy("tree_id", "parent_id").agg(F.max("branch").alias("second"))
    )
    sides = nodes.join(best, ["tree_id", "parent_id"], "left").join(second, ["tree_id", "parent_id"], "left")
    side = F.when(F.col("best.first") == -F.col("node_id"), F.col("second")).otherwise(F.col("best"))
    onward = F.when(_is_root(), 0.0).otherwise(step)
    here = F.lit(0.0) if topological else onward  # the first step up is not counted topologically
    low = F.lit(float("-inf"))
    own = {"reach": F.coalesce(side["reach"] + here, low), "leaf": side["leaf"], "onward": onward}
    longer = F.col("above_reach") + F.col("onward") > F.col("reach")
    above = {
        "reach": F.when(longer, F.col("above_reach") + F.col("onward")).otherwise(F.col("reach")),
        "leaf": F.when(longer, F.col("above_leaf")).otherwise(F.col("leaf")),
        "onward": F.col("onward") + F.col("above_onward"),
    }
    up = climb(sides, own, above)
    over = F.col("reach") > F.col("farthest_distance")
    return below.join(up, KEY).select(
        *KEY, F.when(over, F.col("leaf")).otherwise(F.col("farthest_leaf")).alias("farthest"),
        F.when(over, F.col("reach")).otherwise(F.col("farthest_distance")).alias("distance"),
    )


def midpoint_outgroup(nodes: DataFrame) -> DataFrame:
    """Node above which a tree splits into two halves of equal depth: (tree_id, outgroup).

    From the leaf farthest from the root, climb until more than half of the way to the leaf
    farthest from it is covered; the nodes on that way are those whose range holds the leaf.
    """
    roots = nodes.filter(_is_root()).select(*KEY)
    start = leaf_extremes(nodes).join(roots, KEY, "left_semi").select(
        "tree_id", F.col("farthest_leaf").alias("leaf"), F.col("farthest_distance").alias("leaf_depth")
    )
    across = farthest_node(nodes).withColumnRenamed("node_id", "leaf").join(start, ["tree_id", "leaf"]).select(
        "tree_id", "leaf", "leaf_depth", (F.col("distance") / 2).alias("half")
    )
    rows = nodes.join(intervals(nodes), KEY).join(tree_paths(nodes), KEY)
    on_the_way = rows.join(across, "tree_id").filter((F.col("node_id") <= F.col("leaf")) & (F.col("leaf") <= F.col("last")))
    covered = F.col("leaf_depth") - F.col("root_distance") + _length()
    return on_the_way.filter(covered > F.col("half")).groupBy("tree_id").agg(F.max("node_id").alias("outgroup"))


# Common ancestors.


def common_ancestor(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (tree_id, node_a, node_b, ...) with ``ancestor_id``, by lifting the first of both nodes.

    Level k holds the 2^k-th ancestor of every node that has one. From the highest level down, a node is lifted
    where it stays outside of the other's ancestors, which a range tells; its parent is the answer then.
    """
    ends = cut_lineage(intervals(nodes).join(nodes.select(*KEY, "parent_id"), KEY))
    level = ends.filter(~_is_root()).select(*KEY, F.col("parent_id").alias("up"))
    levels = []
    while True:
        level, left = cut_measured(level, rows=F.count(F.lit(1)))
        if not left["rows"]:
            break
        levels.append(level)
        ahead = level.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("next"))
        level = level.join(ahead, ["tree_id", "up"]).select(*KEY, F.col("next").alias("up"))
    first, second = F.least("node_a", "node_b"), F.greatest("node_a", "node_b")
    state = asked.withColumns({"_at": first, "_to": second})
    own = ends.select("tree_id", F.col("node_id").alias("_at"), F.col("last").alias("_last"), F.col("parent_id").alias("_parent"))
    for level in reversed(levels):
        jump = level.select("tree_id", F.col("node_id").alias("_at"), F.col("up").alias("_up")).join(
            ends.select("tree_id", F.col("node_id").alias("_up"), F.col("last").alias("_end")), ["tree_id", "_up"]
        )
        state = state.join(jump, ["tree_id", "_at"], "left").withColumn(
            "_at", F.when(F.col("_end") < F.col("_to"), F.col("_up")).otherwise(F.col("_at"))
        ).drop("_up", "_end")
    return state.join(own, ["tree_id", "_at"]).withColumn(
        "ancestor_id", F.when(F.col("_last") >= F.col("_to"), F.col("_at")).otherwise(F.col("_parent"))
    ).drop("_at", "_to", "_last", "_parent")


def mrca(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Most recent common ancestor per (tree, set): that of the set's first and last member. ``members`` has tree_id, set_id, node_id."""
    ends = members.groupBy("tree_id", "set_id").agg(F.min("node_id").alias("node_a"), F.max("node_id").alias("node_b"))
    return common_ancestor(nodes, ends).select("tree_id", "set_id", "ancestor_id")


def pair_distance(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Distance of the asked node pairs (tree_id, node_a, node_b), from the three root distances, and the nodes strictly between the two."""
    paths = cut_lineage(tree_paths(nodes))

    def side(name: str) -> DataFrame:
        return paths.select("tree_id", F.col("node_id").alias(name), F.col("depth").alias(f"{name}_hops"), F.col("root_distance").alias(f"{name}_way"))

    through = common_ancestor(nodes, wanted.select("tree_id", "node_a", "node_b"))
    for name in ("node_a", "node_b", "ancestor_id"):
        through = through.join(side(name), ["tree_id", name])
    hops = F.col("node_a_hops") + F.col("node_b_hops") - 2 * F.col("ancestor_id_hops")
    length = F.col("node_a_way") + F.col("node_b_way") - 2 * F.col("ancestor_id_way")
    return through.select(
        "tree_id", "node_a", "node_b", length.alias("distance"), F.greatest(hops - 1, F.lit(0)).cast("double").alias("nodes_between")
    )


# Trees of equal depth.


def ultrametric(nodes: DataFrame, root_age: float | None = None) -> DataFrame:
    """Node table with branches stretched so that all leaves end at the mean root-leaf distance.

    Going down, a branch y with mean distance z to its leaves gets (d - x) * y / (y + z), where
    x is the new depth of the parent and d the mean of the root. The height d - x left below a
    node is d times the product of z / (y + z) along its path.
    """
    not_binary = (
        nodes.filter(~_is_root())
        .join(
            nodes.filter(_is_root()).select("tree_id", F.col("node_id").alias("parent_id")),
            ["tree_id", "parent_id"], "left_semi",
        )
        .groupBy("tree_id").count().filter("count <> 2").limit(1).collect()
    )
    if not_binary:
        raise ValueError(f"tree {not_binary[0]['tree_id']} is not rooted: its root needs two children")
    z = F.when(F.col("is_leaf"), F.lit(0.0)).otherwise(F.col("mean_leaf_distance"))
    branches = cut_lineage(nodes.join(mean_leaf_distance(nodes), KEY).withColumns({"y": _length(), "z": z}))
    whole = F.nullif(F.col("y") + F.col("z"), F.lit(0.0))
    share = F.coalesce(F.col("y") / whole, F.lit(0.0))
    factor = F.when(_is_root(), F.lit(1.0)).otherwise(F.coalesce(F.col("z") / whole, F.lit(1.0)))
    top = branches.filter(_is_root()).select("tree_id", F.col("mean_leaf_distance").alias("d"))
    scale = F.lit(1.0) if root_age is None else F.lit(root_age) / F.nullif(F.col("d"), F.lit(0.0))
    new = F.when(_is_root(), F.lit(0.0)).otherwise(F.col("d") * F.col("left_above") * share * scale)
    return _left_above(branches, factor).join(top, "tree_id").withColumn("dist", new).select(*NODE_COLUMNS)


def _left_above(branches: DataFrame, factor: Column) -> DataFrame:
    """The rows with ``left_above``: the product of the factors from the root down to each node's parent."""
    left = climb(branches, {"left": factor}, {"left": F.col("left") * F.col("above_left")})
    above = left.select("tree_id", F.col("node_id").alias("parent_id"), F.col("left").alias("left_above"))
    return branches.join(above, ["tree_id", "parent_id"], "left")


def ultrametric_by_height(nodes: DataFrame, tree_length: float, strategy: str = "balanced") -> DataFrame:
    """Node table whose leaves all end at ``tree_length``, by the numbers of levels instead of the branch lengths.

    balanced: each branch takes an equal part of the length left, among the levels left below it. fixed: inner branches are all
    one step of the root's levels, leaves take the rest. A root keeps its length.
    """
    if strategy not in ("balanced", "fixed"):
        raise ValueError(f"unknown strategy {strategy}")
    rows = cut_lineage(nodes.join(leaf_extremes(nodes).select(*KEY, "height"), KEY).withColumn("levels", F.col("height") + 1))
    if strategy == "balanced":
        factor = F.when(_is_root(), F.lit(1.0)).otherwise(1 - 1 / F.col("levels"))
        placed = _left_above(rows, factor)
        new = F.lit(float(tree_length)) * F.col("left_above") / F.col("levels")
    else:
        top = rows.filter(_is_root()).select("tree_id", (F.lit(float(tree_length)) / F.col("levels")).alias("step"))
        placed = rows.join(tree_paths(nodes), KEY).join(top, "tree_id")
        new = F.when(F.col("is_leaf"), F.lit(float(tree_length)) - (F.col("depth") - 1) * F.col("step")).otherwise(F.col("step"))
    return placed.withColumn("dist", F.when(_is_root(), F.col("dist")).otherwise(new)).select(*NODE_COLUMNS)


# Parts of trees.


def prune(nodes: DataFrame, keep: DataFrame, preserve_lengths: bool = False) -> DataFrame:
    """Node table of the kept leaves (tree_id, node_id) and the nodes where they branch.

    A node with a single kept branch below it disappears; its length is added to the branch
    below it when lengths are preserved. The new parent is the nearest node above that stays.
    """
    tips = keep.select(*KEY).distinct().withColumn("tip", F.lit(True))
    flagged = nodes.join(tips, KEY, "left").withColumn("tip", F.col("tip").isNotNull())
    used = marked_under(flagged, F.col("tip")).filter("n_marked > 0").select(*KEY)
    branching = (
        nodes.join(used, KEY, "left_semi").filter(~_is_root())
        .groupBy("tree_id", "parent_id").agg(F.count(F.lit(1)).alias("kept_children"))
        .filter("kept_children > 1").select("tree_id", F.col("parent_id").alias("node_id"))
    )
    stay = cut_lineage(flagged.filter("tip").select(*KEY).unionByName(branching).distinct())
    up = nearest_above(nodes, stay).select(*KEY, F.col("up").alias("new_parent"), F.col("distance").alias("path"))
    length = F.when(F.col("new_parent").isNull(), F.lit(0.0)).otherwise(
        F.col("path") if preserve_lengths else F.col("dist")
    )
    return nodes.join(stay, KEY, "left_semi").join(up, KEY).select(
        "tree_id", "node_id", F.col("new_parent").alias("parent_id"), "name", length.alias("dist"), "support", "is_leaf"
    )


def keep_tips(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """Prune to leaves by name (one ``name`` column), keeping path lengths."""
    tips = nodes.filter("is_leaf").join(names.select("name").distinct(), "name", "left_semi")
    return prune(nodes, tips, preserve_lengths=True)


def tree_splits(nodes: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Distinct clades of two or more leaves per tree, as order-free signatures instead of name lists.

    A signature is the number of names, the first and the last one and two independent hash folds.
    With ``names`` (tree_id, name) only those leaves count; clades without any are left out.
    """
    counted = nodes.withColumn("counts", F.lit(True))
    if names is not None:
        chosen = names.select("tree_id", "name").distinct().withColumn("counts", F.lit(True))
        counted = nodes.join(chosen, ["tree_id", "name"], "left")
    wide = F.xxhash64("name", F.lit("clade")).cast("decimal(38,0)")
    here = F.col("counts").isNotNull()
    leaf = _named(
        leaves=F.lit(1).cast("long"), size=here.cast("long"), fold=F.when(here, F.xxhash64("name")).otherwise(0),
        fold_sum=F.when(here, wide).otherwise(0).cast("decimal(38,0)"), low=F.when(here, F.col("name")), high=F.when(here, F.col("name")),
    )
    fold = Fold(
        leaf,
        lambda v, length, hops: v,
        lambda v: _named(
            leaves=F.sum(v["leaves"]), size=F.sum(v["size"]), fold=F.bit_xor(v["fold"]), fold_sum=F.sum(v["fold_sum"]).cast("decimal(38,0)"),
            low=F.min(v["low"]), high=F.max(v["high"]),
        ),
        lambda a, b: _named(
            leaves=a["leaves"] + b["leaves"], size=a["size"] + b["size"], fold=a["fold"].bitwiseXOR(b["fold"]),
            fold_sum=(a["fold_sum"] + b["fold_sum"]).cast("decimal(38,0)"), low=F.least(a["low"], b["low"]), high=F.greatest(a["high"], b["high"]),
        ),
    )
    return fold_up(counted, fold).filter("value.leaves > 1 and value.size > 0").select(
        "tree_id", "value.size", "value.fold", "value.fold_sum", "value.low", "value.high"
    ).distinct()


def robinson_foulds(nodes_a: DataFrame, nodes_b: DataFrame) -> DataFrame:
    """Symmetric clade distance of trees with the same id, over their common leaf names.

    Trees with fewer than two common names are left out.
    """
    def leaf_names(nodes: DataFrame) -> DataFrame:
        return nodes.filter("is_leaf").select("tree_id", "name").distinct()

    common = leaf_names(nodes_a).join(leaf_names(nodes_b), ["tree_id", "name"])
    enough = common.groupBy("tree_id").agg(F.count(F.lit(1)).alias("common_names")).filter("common_names >= 2")
    key = ["tree_id", "size", "fold", "fold_sum", "low", "high"]
    a = tree_splits(nodes_a, common).withColumn("in_a", F.lit(1))
    b = tree_splits(nodes_b, common).withColumn("in_b", F.lit(1))
    both = a.join(b, key, "full_outer").groupBy("tree_id").agg(
        F.count_if(F.col("in_a").isNull() | F.col("in_b").isNull()).alias("rf"),
        (F.count("in_a") + F.count("in_b")).alias("max_rf"),
    )
    return enough.join(both, "tree_id")


def _targeted(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    wanted = targets.select("tree_id", "name").distinct().withColumn("target", F.lit(True))
    return nodes.join(wanted, ["tree_id", "name"], "left").withColumn("target", F.col("target").isNotNull())


def monophyly(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """Whether the target leaves (tree_id, name) of a tree form a mono-, para- or polyphyletic set.

    The smallest clade of a set is the deepest node below which all of the set is counted. Targets are
    monophyletic if their clade holds nothing else, polyphyletic if targets also lie in the clade of the others in it.
    """
    counts = cut_lineage(marked_under(_targeted(nodes, targets), F.col("target")))
    whole = counts.filter("n_marked > 0").groupBy("tree_id").agg(F.max("n_marked").alias("n_targets"))
    clade = counts.join(whole, "tree_id").filter("n_marked = n_targets").groupBy("tree_id", "n_targets").agg(
        F.max(_named(node_id=F.col("node_id"), last=F.col("last"), foreign=F.col("n_leaves") - F.col("n_marked"))).alias("top")
    ).select("tree_id", "n_targets", F.col("top.node_id").alias("top"), F.col("top.last").alias("end"), F.col("top.foreign").alias("n_foreign"))
    # The clade of the foreign leaves among the nodes of the clade.
    inside = counts.join(clade, "tree_id").filter(
        (F.col("node_id") >= F.col("top")) & (F.col("node_id") <= F.col("end"))
        & (F.col("n_foreign") > 0) & (F.col("n_leaves") - F.col("n_marked") == F.col("n_foreign"))
    )
    others = inside.groupBy("tree_id").agg(F.max(_named(node_id=F.col("node_id"), mixed=F.col("n_marked") > 0))["mixed"].alias("mixed"))
    verdict = (
        F.when(F.col("n_foreign") == 0, "monophyletic").when(F.col("mixed"), "polyphyletic").otherwise("paraphyletic")
    )
    return clade.join(others, "tree_id", "left").select("tree_id", "n_targets", "n_foreign", verdict.alias("verdict"))


def monophyletic_clades(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """Highest nodes whose leaf values are exactly the whole target set of their tree: (tree_id, node_id).

    Such a node is the highest of a pure branch, so each leaf belongs to at most one candidate, found by climbing to it.
    """
    flagged = cut_lineage(_targeted(nodes, targets))
    counts = marked_under(flagged, F.col("target"))
    pure = cut_lineage(counts.filter("n_marked = n_leaves").select(*KEY))
    parents = pure.select("tree_id", F.col("node_id").alias("parent_id")).withColumn("pure_parent", F.lit(True))
    tops = cut_lineage(
        nodes.join(pure, KEY, "left_semi").join(parents, ["tree_id", "parent_id"], "left").filter("pure_parent is null").select(*KEY)
    )
    size = targets.select("tree_id", "name").distinct().groupBy("tree_id").agg(F.count(F.lit(1)).alias("n_wanted"))
    climbed = nearest_above(flagged, tops).select(*KEY, "up")
    owned = (
        flagged.filter("is_leaf and target").join(climbed, KEY)
        .join(tops.withColumn("own", F.col("node_id")), KEY, "left")
        .select("tree_id", F.coalesce("own", "up").alias("node_id"), "name").filter(F.col("node_id").isNotNull())
    )
    found = owned.groupBy(*KEY).agg(F.count_distinct("name").alias("n_found"))
    return found.join(size, "tree_id").filter("n_found = n_wanted").select(*KEY)


def relabel_tips(nodes: DataFrame, id_map: DataFrame, fix_negative: bool = False, label: str | None = None) -> DataFrame:
    """Rename leaves by an id map (seqid, name); optionally mend branches and number inner nodes."""
    names = id_map.select(F.col("seqid").alias("name"), F.col("name").alias("new_name"))
    out = nodes.join(names, "name", "left").withColumn(
        "name", F.when(F.col("is_leaf"), F.col("new_name")).otherwise(F.col("name"))
    ).drop("new_name")
    if fix_negative:
        inner = nodes.filter(~_is_root())
        lengths = inner.groupBy("tree_id").agg((F.sum("dist") * NEGATIVE_BRANCH_SHARE).alias("least"))
        out = out.join(lengths, "tree_id", "left").withColumn(
            "dist", F.when(F.col("dist") < 0, F.col("least")).otherwise(F.col("dist"))
        ).drop("least")
    if label is not None:
        # Level by level, and in reading order within a level: the nodes of the levels above, then those before.
        inner = nodes.filter(~F.col("is_leaf") & ~_is_root()).select(*KEY).join(tree_paths(nodes).select(*KEY, "depth"), KEY)
        levels = running_total(
            inner.groupBy("tree_id", "depth").agg(F.count(F.lit(1)).alias("n")), ["tree_id"], "depth", F.col("n"), "upto"
        ).select("tree_id", "depth", (F.col("upto") - F.col("n")).alias("levels_before"))
        placed = running_total(inner, ["tree_id", "depth"], "node_id", F.lit(1), "place").join(levels, ["tree_id", "depth"])
        numbered = placed.select(*KEY, F.concat(F.lit(label), (F.col("levels_before") + F.col("place")).cast("string")).alias("label"))
        out = out.join(numbered, KEY, "left").withColumn("name", F.coalesce("label", "name")).drop("label")
    return out.select(*NODE_COLUMNS)


def balanced(trees: DataFrame) -> Column:
    """Whether a Newick text closes as many parentheses as it opens."""
    opened = F.length("newick") - F.length(F.translate("newick", "(", ""))
    closed = F.length("newick") - F.length(F.translate("newick", ")", ""))
    return opened == closed
