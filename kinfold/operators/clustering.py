"""Flow clustering of a weighted graph, and components, as iterated joins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.session import cut_lineage, cut_measured

# Inflation of the clustering step and stopping rule.
INFLATION = 1.5
TOLERANCE = 1e-4
GUARD_ROUNDS = 200
SMALL = 64  # nodes of the components whose flow is worked on as one small matrix
CHUNK_EDGES = 1 << 15  # directed edges of a chunk of such components


def _columns_sum_to_one(flow: DataFrame) -> DataFrame:
    totals = flow.groupBy("target").agg(F.sum("flow").alias("total"))
    return flow.join(totals, "target").select("source", "target", (F.col("flow") / F.col("total")).alias("flow"))


def _grown(flow: DataFrame, inflation: float, min_flow: float) -> DataFrame:
    """The flow after one round."""
    first = flow.select("source", F.col("target").alias("via"), F.col("flow").alias("flow_in"))
    then = flow.select(F.col("source").alias("via"), "target", F.col("flow").alias("flow_out"))
    grown = cut_lineage(
        first.join(then, "via").groupBy("source", "target").agg(
            F.pow(F.sum(F.col("flow_in") * F.col("flow_out")), F.lit(inflation)).alias("flow")
        )
    )
    totals = grown.groupBy("target").agg(F.sum("flow").alias("total"), F.max("flow").alias("most"))
    kept = grown.join(totals, "target").filter(
        ((F.col("flow") > 0) & (F.col("flow") >= min_flow * F.col("total"))) | (F.col("flow") == F.col("most"))
    )
    return _columns_sum_to_one(kept.select("source", "target", "flow"))


def _unrest(flow: DataFrame) -> float:
    """How far the least settled column is from a settled one."""
    return (
        flow.groupBy("target").agg((F.max("flow") - F.sum(F.col("flow") * F.col("flow"))).alias("unrest"))
        .agg(F.max("unrest")).first()[0]
    ) or 0.0


def _stacks(chunk: pd.DataFrame) -> list[tuple]:
    """(names, flow) of the components of a chunk, stacked by their number of nodes; names are sorted within a component."""
    import numpy as np

    source, names = pd.factorize(chunk["source"], sort=True)
    target = pd.Index(names).get_indexer(chunk["target"])
    cluster = pd.factorize(chunk["cluster"])[0]
    home = np.zeros(len(names), np.int64)
    home[source] = cluster
    order = np.argsort(home, kind="stable")
    sizes = np.bincount(home)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = []
    for n in np.unique(sizes):
        slot = np.cumsum(sizes == n) - 1
        rows = sizes[cluster] == n
        flow = np.zeros((slot[-1] + 1, n, n))
        flow[slot[cluster[rows]], place[source[rows]], place[target[rows]]] = chunk["flow"].to_numpy()[rows]
        flow[:, np.arange(n), np.arange(n)] = flow.max(axis=1)
        members = order[sizes[home[order]] == n].reshape(-1, n)
        out.append((np.asarray(names, dtype=object)[members], flow / flow.sum(axis=1, keepdims=True)))
    return out


def _stack_grown(flow, inflation: float, min_flow: float):
    """The same round as that of ``_grown`` on stacked matrices."""
    import numpy as np

    grown = np.power(flow @ flow, inflation)
    total, most = grown.sum(axis=1, keepdims=True), grown.max(axis=1, keepdims=True)
    grown[~(((grown > 0) & (grown >= min_flow * total)) | (grown == most))] = 0.0
    return grown / grown.sum(axis=1, keepdims=True)


def _stack_unrest(flow) -> float:
    return float((flow.max(axis=1) - (flow * flow).sum(axis=1)).max())


def _stack_clusters(names, flow):
    """Smallest name that flow leads to from each node, in either direction."""
    import numpy as np

    near = (flow > 0) | (flow > 0).transpose(0, 2, 1)
    n = flow.shape[1]
    label = np.broadcast_to(np.arange(n), names.shape)
    while True:
        new = np.minimum(label, np.where(near, label[:, None, :], n).min(axis=2))
        if (new == label).all():
            return np.take_along_axis(names, label, axis=1)
        label = new


def mcl_cluster(
    edges: DataFrame, inflation: float = INFLATION, min_flow: float = 0.0, tolerance: float = TOLERANCE
) -> DataFrame:
    """Markov clustering of (a, b, weight) edges: (node, cluster), named by the smallest member.

    Every round squares the flow matrix and raises it to the inflation, until no column moves by ``tolerance``. The result is
    always that of a settled flow: more than ``GUARD_ROUNDS`` rounds raise an error. ``min_flow`` is the published method's
    pruning and off by default; with it a column keeps at most 1 / min_flow entries, and its strongest flow always stays.
    Flows that have become exactly zero are no entries.

    No flow leaves a component of the graph. Small components are dealt to chunks and squared as stacked matrices; larger ones, and
    those with weights that are not positive and finite, are squared with one join and one sum, which combines before its shuffle, and
    their lineage is cut every round. All go through the same number of rounds, the first after which every column is settled.
    """
    both = edges.filter("a <> b").select(F.col("a").alias("source"), F.col("b").alias("target"), F.col("weight").alias("flow"))
    both = cut_lineage(both.unionByName(
        both.select(F.col("target").alias("source"), F.col("source").alias("target"), "flow")
    ).groupBy("source", "target").agg(F.max("flow").alias("flow")).filter(F.col("flow").isNotNull()))
    labels = components(both.filter(F.col("source") < F.col("target")).select(F.col("source").alias("a"), F.col("target").alias("b")))
    sizes = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    homes = labels.join(sizes, "cluster").select(F.col("node").alias("source"), "cluster", "n")
    sound = (F.col("flow") > 0) & (F.col("flow") < float("inf"))
    placed, found = cut_measured(
        both.join(homes, "source").withColumn("odd", (F.col("n") > SMALL) | ~sound), edges=F.count(F.lit(1)), odd=F.count_if("odd")
    )
    small, flow = placed, None
    if found["odd"]:
        apart = cut_lineage(placed.filter("odd").select("cluster").distinct())
        small, large = placed.join(apart, "cluster", "left_anti"), placed.join(apart, "cluster", "left_semi").select("source", "target", "flow")
        loops = large.groupBy("target").agg(F.max("flow").alias("flow")).select(F.col("target").alias("source"), "target", "flow")
        flow = _columns_sum_to_one(cut_lineage(large.unionByName(loops)))
    chunks = 1 + found["edges"] // CHUNK_EDGES
    dealt = small.select(F.pmod(F.xxhash64("cluster"), F.lit(chunks)).alias("chunk"), "cluster", "source", "target", "flow")
    guard = GUARD_ROUNDS

    def settled_after(chunk: pd.DataFrame) -> pd.DataFrame:
        flows, done = [f for _, f in _stacks(chunk)], 0
        while done <= guard:
            flows, done = [_stack_grown(f, inflation, min_flow) for f in flows], done + 1
            if max(map(_stack_unrest, flows)) < tolerance:
                break
        return pd.DataFrame({"rounds": [done]})

    def clustered(rounds: int) -> DataFrame:
        def of_chunk(chunk: pd.DataFrame) -> pd.DataFrame:
            def parts() -> Iterator[pd.DataFrame]:
                for names, f in _stacks(chunk):
                    for _ in range(rounds):
                        f = _stack_grown(f, inflation, min_flow)
                    yield pd.DataFrame({"node": names.ravel(), "cluster": _stack_clusters(names, f).ravel(), "unrest": _stack_unrest(f)})

            return pd.concat(list(parts()))

        kind = edges.schema["a"].dataType.simpleString()
        return dealt.groupBy("chunk").applyInPandas(of_chunk, f"node {kind}, cluster {kind}, unrest double")

    # No round before the last of these is one after which all is settled.
    rounds = dealt.groupBy("chunk").applyInPandas(settled_after, "rounds int").agg(F.max("rounds")).first()[0] or 1
    done = 0
    while rounds <= GUARD_ROUNDS:
        while flow is not None and done < rounds:
            flow, done = _grown(flow, inflation, min_flow), done + 1
        if flow is None or _unrest(flow) < tolerance:
            named, left = cut_measured(clustered(rounds), unrest=F.max("unrest"))
            if (left["unrest"] or 0.0) < tolerance:
                break
        rounds += 1
    else:
        raise RuntimeError(f"mcl_cluster: not settled after {GUARD_ROUNDS} rounds")
    named = named.select("node", "cluster")
    if flow is None:
        return named
    return named.unionByName(components(flow.select(F.col("source").alias("a"), F.col("target").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """Connected components: every node takes the smallest label around it until none changes.

    Labels also jump to the label of their label each round, which shortens long chains.
    """
    both = cut_lineage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("cluster"))
    while True:
        labels = cut_lineage(labels)
        known = labels.select(F.col("node").alias("b"), F.col("cluster").alias("near"))
        around = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        jump = labels.select(F.col("node").alias("cluster"), F.col("cluster").alias("further"))
        new = (
            labels.join(around, "node").join(jump, "cluster", "left")
            .select("node", F.least("cluster", "near", "further").alias("new"), "cluster")
        )
        new = cut_lineage(new)
        changed = not new.filter(F.col("new") != F.col("cluster")).isEmpty()
        labels = new.select("node", F.col("new").alias("cluster"))
        if not changed:
            return labels
