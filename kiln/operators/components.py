"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.lineage import Scratch


def connected_components(edges: DataFrame, work: Scratch, name: str, group_cols=()) -> DataFrame:
    """(*group, node, component) for every node of ``edges`` (*group, a, b); component is the smallest node reached.

    Every step is a grouped minimum and an equi-join on a node. A hub with a third of all edges is reduced
    before the shuffle of the minimum; the minima are written, so both sides of the join are plain scans
    and adaptive execution may broadcast the small one or split the hub. Each round is written to the shared
    folder and the one before it removed; the loop ends only when a round changes no edge. Self-links and
    repeated edges are ignored; an empty input gives an empty result.
    """
    g = list(group_cols)
    current = work.write(
        edges.select(*g, F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi <> lo").distinct(), f"{name}-0")
    before, turn = None, 0
    while True:
        turn += 1
        near = current.select(*g, F.col("hi").alias("x"), F.col("lo").alias("y")) \
            .unionAll(current.select(*g, F.col("lo").alias("x"), F.col("hi").alias("y")))
        least = work.write(near.groupBy(*g, "x").agg(F.min("y").alias("y0"))
                           .select(*g, "x", F.least("x", "y0").alias("m")), f"{name}-least-{turn}")
        large = (near.join(least, [*g, "x"]).where("y > x")
                 .select(*g, F.col("y").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy(*g, "hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, [*g, "hi"])
                 .select(*g, F.explode(F.array(F.struct("hi", F.col("m").alias("lo")),
                                               F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select(*g, "e.hi", "e.lo").where("hi <> lo").distinct())
        current = work.write(small, f"{name}-{turn}")
        work.drop(f"{name}-{turn - 1}")
        work.drop(f"{name}-least-{turn}")
        # read from the table: an Observation would leave a manager in the session that some MLlib models can't serialise
        after = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*g, "hi", "lo") % (1 << 40))).first()
        if after == before:
            break
        before = after
    roots = current.select(*g, "lo").distinct().select(*g, F.col("lo").alias("node"), F.col("lo").alias("component"))
    return current.select(*g, F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)
