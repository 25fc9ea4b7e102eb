"""Problem 4: one group identifier for every record that pairs link, directly or not.

The graph is shrunk by steps:

1. strip vertices of degree one: each is hung under its only neighbour;
2. compress chains of degree-two vertices: pointer doubling over the arcs of a
   chain (list ranking) finds both of its ends, one edge between the ends
   replaces the chain, and its vertices are hung under an end. A chain closed to
   a ring is hung under its smallest vertex;
3. solve the core that is left: up to CORE_EDGES edges by union-find in one task;
   of a larger one, whose vertices have three neighbours or more, each vertex is
   hung under its smallest neighbour, and all begins again with what remains.

All that was hung somewhere forms one forest whose depth is at most the number
of steps; pointer doubling over that forest restores the labels.

Every vertex is described by one aggregate over its edges (degree, smallest and
largest neighbour), which combines map-side, and edges and arcs are matched on
both ends together, so a hub that has a third of all edges never lands in one
task. Only the lookups by parent can meet a hot key; they are salted. Tables of
earlier steps are deleted as soon as no later one reads them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import cut, discard, salted_lookup

#: Edges of a core that one task solves (two numbers each).
CORE_EDGES = 1_000_000


def _degrees(edges: DataFrame) -> DataFrame:
    """(node, deg, lo, hi): degree, smallest and largest neighbour."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("nbr")), F.struct(F.col("v").alias("node"), F.col("u").alias("nbr")))).alias("e"))
    return ends.select("e.node", "e.nbr").groupBy("node").agg(F.count(F.lit(1)).alias("deg"), F.min("nbr").alias("lo"), F.max("nbr").alias("hi"))


def _edge(a: str, b: str) -> list:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _strip_leaves(edges: DataFrame, deg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang every vertex of degree one under its neighbour; of a lone edge, the larger end."""
    leaves = deg.where("deg = 1").select("node", F.col("lo").alias("parent"))
    by_edge = leaves.groupBy(*_edge("node", "parent")).agg(F.max("node").alias("node"))
    hung = by_edge.select("node", F.when(F.col("node") == F.col("u"), F.col("v")).otherwise(F.col("u")).alias("parent"))
    return edges.join(by_edge.select("u", "v"), ["u", "v"], "left_anti"), hung


def _compress_chains(edges: DataFrame, deg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replace chains of degree-two vertices by edges between their ends.

    An arc (a, w) that enters a degree-two vertex w from a is followed by the
    arc that leaves w on the other side; an arc that enters any other vertex is
    the end of its list. Doubling the pointers ranks all lists in
    O(log length) rounds. ``low`` is the least vertex entered so far: on a ring,
    which has no end, a round that finishes no list and in which ``low`` equals
    that of the arc pointed to, for all arcs, has seen every whole ring.
    """
    two = deg.where("deg = 2")
    arcs = two.select(
        F.explode(
            F.array(
                F.struct(F.col("lo").alias("a"), F.col("node").alias("w"), F.col("node").alias("pa"), F.col("hi").alias("pw")),
                F.struct(F.col("hi").alias("a"), F.col("node").alias("w"), F.col("node").alias("pa"), F.col("lo").alias("pw")),
            )
        ).alias("s")
    ).select("s.*").withColumn("low", F.col("w"))
    # rows: the arc (a, w), the arc (pa, pw) it points to, the least vertex in between
    done = None
    live = cut(arcs)
    while True:
        # an arc that is gone from live but was finished earlier hands its end on
        known = live.select(F.col("a").alias("pa"), F.col("w").alias("pw"), F.col("pa").alias("na"), F.col("pw").alias("nw"), F.col("low").alias("nlow"), F.lit(False).alias("end"))
        if done is not None:
            known = known.unionByName(done.select(F.col("a").alias("pa"), F.col("w").alias("pw"), F.col("pa").alias("na"), F.col("pw").alias("nw"), F.col("low").alias("nlow"), F.lit(True).alias("end")))
        step = cut(
            live.join(known, ["pa", "pw"], "left").select(
                "a",
                "w",
                F.coalesce("na", "pa").alias("pa"),
                F.coalesce("nw", "pw").alias("pw"),
                F.least("low", "nlow").alias("low"),
                (F.col("nw").isNull() | F.col("end")).alias("end"),
                F.coalesce(F.col("low") == F.col("nlow"), F.lit(False)).alias("same"),
            )
        )
        now = step.agg(F.count(F.when(F.col("end"), 1)).alias("ended"), F.count(F.when(~F.col("end"), 1)).alias("open"), F.count(F.when(~F.col("end") & ~F.col("same"), 1)).alias("moving")).first()
        ended = step.where("end").drop("end", "same")
        done = ended if done is None else done.unionByName(ended)
        discard(live)
        live = step.where("not end").drop("end", "same")
        if now["open"] == 0 or (now["ended"] == 0 and now["moving"] == 0):
            break
    # every chain vertex is entered by two arcs: their lists end at the chain's two ends
    ends = done.groupBy("w").agg(F.min("pw").alias("x"), F.max("pw").alias("y"))
    rings = live.groupBy(F.col("w").alias("node")).agg(F.min("low").alias("parent")).where("node <> parent")
    hung = ends.select(F.col("w").alias("node"), F.col("x").alias("parent")).unionByName(rings)
    bridges = ends.where("x <> y").select(F.col("x").alias("u"), F.col("y").alias("v")).distinct()
    inner = two.select(F.explode(F.array(F.struct(*_edge("node", "lo")), F.struct(*_edge("node", "hi")))).alias("e")).select("e.u", "e.v").distinct()
    return edges.join(inner, ["u", "v"], "left_anti").unionByName(bridges).distinct(), hung


def _resolve(forest: DataFrame) -> DataFrame:
    """(node, parent) with every parent replaced by the root above it."""
    while True:
        up = forest.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = cut(salted_lookup(forest, "parent", up).select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")))
        if not step.where("moved").limit(1).count():
            return step.drop("moved")
        forest = step.drop("moved")


def union_find(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each one's group)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    above = list(range(len(nodes)))
    for a, b in zip(at[: len(u)].tolist(), at[len(u) :].tolist()):
        while above[a] != a:
            above[a] = a = above[above[a]]
        while above[b] != b:
            above[b] = b = above[above[b]]
        if a < b:
            above[b] = a
        elif b < a:
            above[a] = b
    root = np.array(above, np.int64)
    while True:
        up = root[root]
        if np.array_equal(up, root):
            return nodes, nodes[root]
        root = up


def _solve(edges: DataFrame) -> DataFrame:
    """(node, parent): a core of at most CORE_EDGES edges hung under its groups' smallest vertices."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(b["u"].to_numpy(), b["v"].to_numpy()) for b in batches]
        if parts:
            nodes, root = union_find(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield pd.DataFrame({"node": nodes, "parent": root})[nodes != root]

    kind = dict(edges.dtypes)["u"]
    return edges.select("u", "v").coalesce(1).mapInPandas(solve, f"node {kind}, parent {kind}")


def _contract(edges: DataFrame, deg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang each vertex under its smallest neighbour, if that is smaller, and merge."""
    hung = _resolve(cut(deg.where("lo < node").select("node", F.col("lo").alias("parent"))))
    lift = hung.select(F.col("node").alias("u"), F.col("parent").alias("ru"))
    left = salted_lookup(edges, "u", lift).select(F.coalesce("ru", "u").alias("x"), "v")
    lift = hung.select(F.col("node").alias("v"), F.col("parent").alias("rv"))
    both = salted_lookup(left, "v", lift).select("x", F.coalesce("rv", "v").alias("y"))
    return both.where("x <> y").select(*_edge("x", "y")).distinct(), hung


def connected_groups(pairs: DataFrame, u: str = "u", v: str = "v", node: str = "node_id", group: str = "group_id") -> DataFrame:
    """(node, group): the smallest id of the group for each id in a row with both ends filled.

    Repeated and reversed pairs count once; an id paired only with itself is a
    group of one; rows with an empty end are no link and name no id. An empty
    table gives no rows. Other columns of ``pairs`` are ignored.
    """
    filled = pairs.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    rows = cut(filled.select(*_edge("u", "v")).distinct())
    edges, forest, own = rows.where("u <> v"), None, None
    while True:
        for step in (_strip_leaves, _compress_chains, _contract):
            deg = cut(_degrees(edges))
            some = deg.agg(F.count(F.lit(1)).alias("n"), F.sum("deg").alias("ends"), F.count(F.when(F.col("deg") == 1, 1)).alias("one"), F.count(F.when(F.col("deg") == 2, 1)).alias("two")).first()
            if not some["n"]:
                break
            if step is _contract and some["ends"] <= 2 * CORE_EDGES:
                hung = cut(_solve(edges))
                edges = None
            elif step is _contract or some["one" if step is _strip_leaves else "two"]:
                left, hung = step(edges, deg)
                left, hung = cut(left), cut(hung)
                discard(own)
                edges = own = left
            else:
                discard(deg)
                continue
            forest = hung if forest is None else forest.unionByName(hung)
            discard(deg)
            if edges is None:
                break
        else:
            continue
        break
    nodes = rows.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    if forest is None:
        return nodes.select(F.col("node").alias(node), F.col("node").alias(group))
    roots = nodes.join(_resolve(cut(forest)), "node", "left").select("node", F.coalesce("parent", "node").alias("root"))
    roots = cut(roots)
    least = roots.groupBy("root").agg(F.min("node").alias("least"))
    return salted_lookup(roots, "root", least, "inner").select(F.col("node").alias(node), F.col("least").alias(group))
