"""Groups of records that are linked directly or through others, by randomised contraction.

Every round each vertex hooks to the vertex of its closed neighbourhood that comes first in a fresh hash order;
edges are relabelled by those representatives, deduplicated and stripped of loops. The number of vertices shrinks
by a constant factor in expectation, whatever the shape of the graph, so the rounds grow with the logarithm of its
size. Each edge is held once; only the hook sees it from both ends. At the end the round mappings are composed from
the last to the first, and each is dropped with that.

Names become numbers first. A round's hash order is a one-to-one mapping of numbers that renames all vertices, so the first
neighbour is a least number: rounds compare, aggregate and join nothing but numbers.

No vertex's edge list is gathered: the hook is a minimum (combined before the shuffle), and the relabelling joins
have one row per vertex on one side, so a vertex with a third of all edges is split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import Scratch


#: Shifts of the one-to-one mappings (left, right, left), taken in turn.
SHIFTS = ((13, 7, 17), (21, 35, 4), (17, 31, 8), (11, 29, 14), (5, 15, 27))


def renamed(x: Column, turn: int) -> Column:
    """Another number for each number, one to one, in a fresh order for every turn."""
    a, b, c = SHIFTS[turn % len(SHIFTS)]
    x = x.bitwiseXOR(F.xxhash64(F.lit(turn)))
    x = x.bitwiseXOR(F.shiftleft(x, a))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, b))
    return x.bitwiseXOR(F.shiftleft(x, c))


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """One row ``node, group_node`` per vertex that has an edge to another; ``group_node`` is its group's least node.

    Edges are undirected; repeated, reversed and self edges and those with a null end don't count, and a vertex
    that has no other edge gives no row. Names compare bytewise. An empty input gives no rows; further columns
    are ignored.
    """
    scratch = Scratch(edges.sparkSession, "components")
    ordered = [F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")]
    named = edges.select(F.col(src).cast("string").alias("na"), F.col(dst).cast("string").alias("nb")).where("na <> nb")
    names = named.select(F.col("na").alias("node")).unionAll(named.select(F.col("nb").alias("node"))).distinct()
    nodes = scratch.cut(names.withColumn("id", F.monotonically_increasing_id()))  # written, so the numbers stay
    side = lambda x: nodes.select(F.col("node").alias(f"n{x}"), F.col("id").alias(x))
    e = scratch.cut(named.join(side("a"), "na").join(side("b"), "nb").select(*ordered).distinct())
    rounds: list[DataFrame] = []
    while not e.isEmpty():
        turn = len(rounds) + 1
        own = e.select(renamed(F.col("u"), turn).alias("u"), renamed(F.col("v"), turn).alias("v"))
        hook = own.unionAll(own.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min("v").alias("first"))
        rounds.append(scratch.cut(hook.select("u", F.least("u", "first").alias("r"))))
        left = own.join(rounds[-1], "u").select(F.col("r").alias("a"), F.col("v").alias("u"))
        after = scratch.cut(left.join(rounds[-1], "u").select("a", F.col("r").alias("b")).where("a <> b").select(*ordered).distinct())
        scratch.drop(e)
        e = after
    if not rounds:
        return nodes.select("node", F.col("node").alias("group_node"))
    # From the last round to the first; a mapping goes as soon as it is part of the composed one. A root is named by the last
    # round that it had an edge in, and its number there.
    roots = rounds.pop().withColumn("t", F.lit(len(rounds) + 1))
    made: DataFrame | None = None
    while rounds:
        reps, turn = rounds.pop(), len(rounds) + 1
        later = roots.select(F.col("u").alias("k"), F.col("r").alias("root"), F.col("t").alias("round"))
        joined = reps.withColumn("k", renamed(F.col("r"), turn + 1)).join(later, "k", "left")
        composed = scratch.cut(joined.select("u", F.coalesce("root", "r").alias("r"), F.coalesce("round", F.lit(turn)).alias("t")))
        scratch.drop(reps, *([made] if made is not None else []))
        roots = made = composed
    found = scratch.cut(nodes.withColumn("u", renamed(F.col("id"), 1)).join(roots, "u").select("node", "t", "r"))
    scratch.drop(nodes)
    least = found.groupBy("t", "r").agg(F.min("node").alias("group_node"))
    return found.join(least, ["t", "r"]).select("node", "group_node")
