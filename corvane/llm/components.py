"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``(a, b)`` edges; the root is the smallest node of the component.

    Null ends are left out; an edge of a node with itself names the node. Equal edges count once.
    """
    return contracted(edges)[0]


def contracted(edges: DataFrame) -> tuple[DataFrame, int]:
    """:func:`components` and the number of rounds.

    In a round every node that has an edge points to the neighbour, or itself,
    that comes first in an order drawn anew for the round (a hash of node and
    round), and every pointer is followed one step further. Edges are drawn
    again between what their ends point to. Only nodes that others point to keep
    edges, so the expected number of nodes falls by a constant factor in every
    round whatever the shape: a sorted chain, a star or a random graph. Pointers
    lead to earlier nodes only, so they never run in circles.

    Every round is written to the shared folder and read back: its size is then
    that of its files, while a checkpoint would hand the estimates of the plan
    on and multiply them in every join. What a round replaces is deleted. Only
    an emptiness test comes to the driver. Last, the smallest node of every component becomes its root.
    """
    # Edges come out of the dearest joins; unless stored, the nodes and the edges would each run those.
    ends = stored(edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b"), "ends")
    roots = stored(
        ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct().withColumn("root", F.col("node")), "roots"
    )
    live = stored(_simple(ends), "edges")
    discard(ends)
    rounds = 0
    while not live.isEmpty():
        step = _pointers(live, rounds)
        to_first = roots.join(step, roots["root"] == step["at"], "left").select("node", F.coalesce("to", "root").alias("root"))
        left = step.select(F.col("at").alias("a"), F.col("to").alias("a2"))
        right = step.select(F.col("at").alias("b"), F.col("to").alias("b2"))
        moved = live.join(left, "a").join(right, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        old = roots, live, step
        roots, live = stored(to_first, "roots"), stored(_simple(moved), "edges")
        discard(*old)
        rounds += 1
    lowest = roots.groupBy("root").agg(F.min("node").alias("low"))
    return roots.join(lowest, "root").select("node", F.col("low").alias("root")), rounds


def _pointers(live: DataFrame, round_: int) -> DataFrame:
    """``(at, to)``: where every node of the edges points to."""
    both = live.union(live.select("b", "a"))
    place = lambda c: F.struct(F.xxhash64(c, F.lit(round_)).alias("hash"), F.col(c).alias("node"))
    first = stored(
        both.groupBy(F.col("a").alias("at")).agg(F.min(place("b")).alias("low"))
        .select("at", F.least(place("at"), F.col("low"))["node"].alias("to")), "pointers",
    )
    onward = first.select(F.col("at").alias("to"), F.col("to").alias("further"))
    step = stored(first.join(onward, "to").select("at", F.col("further").alias("to")), "pointers")
    discard(first)
    return step


def _simple(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
