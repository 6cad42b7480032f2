"""Connected components by alternating large-star and small-star rounds of joins.

No task holds a component: each round is a minimum for each node (partly aggregated before the
shuffle) and a join that Spark may split where a node is hot. Rounds are reliable checkpoints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import checkpoint


def components(edges: DataFrame, held: Callable[[DataFrame], DataFrame] = checkpoint) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node it reaches. held: keeps what a round makes."""
    now = held(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    while True:
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = held(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
