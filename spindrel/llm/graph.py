"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.llm.common import durable


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link, root being the smallest node reachable.

    Each round rewires every node to the smallest node near it, so paths shorten by a factor a round. A node's links are
    never gathered: its smallest neighbour is a grouped minimum (combined before the shuffle) and the rewiring is an equi-join
    that adaptive execution may split at a hot node. Rounds are cut off by a durable checkpoint; only two numbers reach the
    driver. Null ends and links from a node to itself are dropped.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = durable(e.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct())
    seen = _digest(e)
    for _ in range(max_rounds if seen[0] else 0):
        near = e.select(F.col("lo").alias("node"), F.col("hi").alias("by")).unionByName(e.select(F.col("hi").alias("node"), F.col("lo").alias("by")))
        near = near.groupBy("node").agg(F.min("by").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = e.join(near, e["lo"] == near["node"]).select(F.col("m").alias("lo"), "hi").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select("lo", "hi", "m")
        e = durable(small.select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("x")).select("x.lo", "x.hi").where("lo <> hi").distinct())
        now = _digest(e)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


#: Parts that the nodes of a component are dealt over where they get its value back: one component may hold most nodes.
SALTS = 16


def least_of(nodes: DataFrame, roots: DataFrame, value: str) -> DataFrame:
    """(node, value) for every node: the least value of its component. nodes: node, value; roots as components gives them, so nodes without a link keep their own."""
    own = nodes.select("node", value).join(roots, "node", "left")
    alone = own.where("root is null").select("node", value)
    linked = own.where("root is not null").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    # merged, not broadcast: Spark takes the table for as small as it was before each row became SALTS
    least = linked.groupBy("root").agg(F.min(value).alias("__least")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return alone.unionByName(linked.join(least.hint("merge"), ["root", "salt"]).select("node", F.col("__least").alias(value)))


def _digest(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("h")).first()
    return (row["n"], row["h"])
