"""Connected components by repeated contraction to smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dist import cut, discard, salted_lookup


def _roots(parents: DataFrame) -> DataFrame:
    """Follow (node, parent) pointers to their ends, doubling the distance each round."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        step = cut(salted_lookup(parents, "parent", above).select("node", F.coalesce("next", "parent").alias("parent"), F.col("next").isNotNull().alias("more")))
        discard(parents)
        if not step.where("more").limit(1).count():
            return step.drop("more")
        parents = step.drop("more")
        parents._written = step._written


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    In each round every node points to its smallest neighbour if that is smaller,
    pointers are followed to their roots, and the graph shrinks to its roots; the
    number of nodes with edges at least halves, so rounds are logarithmic. Rows
    with an empty end are dropped, an edge to itself makes a component of one.
    """
    filled = edges.where(F.col(u).isNotNull() & F.col(v).isNotNull())  # least() would skip a null
    rows = cut(filled.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct())
    nodes = rows.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = None
    left = rows.where("u <> v")
    while left.limit(1).count():
        both = left.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("nbr")), F.struct(F.col("v").alias("node"), F.col("u").alias("nbr")))).alias("e")).select("e.*")
        down = both.groupBy("node").agg(F.min("nbr").alias("parent")).where("parent < node")
        hung = _roots(cut(down))
        a = salted_lookup(left, "u", hung.select(F.col("node").alias("u"), F.col("parent").alias("ru"))).select(F.coalesce("ru", "u").alias("a"), "v")
        b = salted_lookup(a, "v", hung.select(F.col("node").alias("v"), F.col("parent").alias("rv"))).select("a", F.coalesce("rv", "v").alias("b"))
        left = cut(b.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
        labels = hung if labels is None else labels.unionByName(hung)
    if labels is None:
        return nodes.select("node", F.col("node").alias("component"))
    found = _roots(cut(labels))
    # roots are local minima that were never beaten, so a root is its component's smallest node
    return nodes.join(found, "node", "left").select("node", F.coalesce("parent", "node").alias("component"))
