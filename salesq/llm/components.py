"""Connected components of a link table by repeated hash-minimum contraction.

Each round every node points at the neighbour (or itself) with the least hash,
labels follow the pointers and the links are relabelled; links inside one label
vanish. Hashing the order keeps long chains from collapsing one node a round.
Every round is a written table, nothing is collected, and all joins read plain
exchanges that adaptive execution can split at a hub."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesq.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` (long, any direction, repeats and loops allowed) ->
    ``(node, root)`` for every node with a link; an empty table gives none."""
    pairs = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = written(pairs, "links")
    labels = None
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("n"))
        step = written(near.select("a", F.least(own, F.col("m"))["n"].alias("p")), "step")
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            labels = (labels.join(step, labels.root == step.a, "left")
                      .select("node", F.coalesce("p", "root").alias("root")))
        labels = written(labels, "labels")
        to_a, to_b = (step.select(F.col("a").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        moved = pairs.join(to_a, "a").join(to_b, "b").filter("pa <> pb")
        pairs = written(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
                        "links")
    if labels is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
