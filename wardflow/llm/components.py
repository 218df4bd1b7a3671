"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.session import durable

#: Each round at least halves the height of the trees left, so this is never reached in practice.
MAX_ROUNDS = 60


def _lowest(pairs: DataFrame) -> DataFrame:
    """For rows (u, v): v with the smallest of u and its neighbours. Minima are taken before
    the shuffle; a hub's rows meet its one minimum in a join that Spark may split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root being the smallest node reachable.

    Loops and repeated edges are allowed; an empty edge table gives no rows. Each round
    is written to the shared folder, so no plan grows and a lost executor costs one round.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _lowest(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _lowest(large)
        ends = F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b"))))
        now = durable(small.select(ends.alias("e")).select("e.a", "e.b").where("a <> b").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    root = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return root.union(root.select(F.col("root").alias("node"), "root").distinct())
