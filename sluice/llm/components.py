"""Connected components of an edge table, as joins and aggregates.

Large star and small star in turn: every node is linked to the least node it
can see, until each component is a star around its least node. Nothing is
collected; each round is written to the shared folder, which cuts the lineage.
A hub's edges are only aggregated (partially, before the shuffle) or joined. What
they are joined with is stored first: both sides of the join are then plain
shuffles, which Spark's skew handling splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its least node.

    Loops and repeated edges are allowed; nulls are left out. No edges give no rows.
    """
    known = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    known = scratch.store(known, f"{label}-0")
    state, round_ = _state(known), 0
    while state[0]:
        round_ += 1
        both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"))
        least = scratch.store(least.select("hub", F.least("hub", "m").alias("m")), f"{label}-least")
        large = both.join(least, both.a == least.hub).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.store(large.distinct(), f"{label}-large")
        to = scratch.store(large.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m")), f"{label}-to")
        small = large.join(to, large.a == to.hub).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        known = scratch.store(small.where("a <> b").distinct(), f"{label}-{round_}")
        new = _state(known)
        scratch.drop(f"{label}-{round_ - 1}", f"{label}-least", f"{label}-large", f"{label}-to")
        if new == state:
            break
        state = new
    stars = known.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
