"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import hot_join, shared_dir


def _kept(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def star_forest(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """``edges`` (u, v: long) -> a row (node, root) for each node but the roots.

    root is the smallest node of the component.  Each step replaces links by links to the least
    neighbour; the number of links never grows.  Least neighbours are pre-aggregated by task and
    hubs are dealt over many tasks.  A self link, null or repeated link changes nothing.
    """
    now = _kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        state = tuple(now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        # Large star: the larger neighbours of each node link to its least neighbour (or itself).
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).where("m < u")
        large = hot_join(both.where("v > u"), least, ["u"], ["v"]).select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v")).distinct()
        # Small star: the smaller neighbours of each node, and itself, link to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = hot_join(large, low, ["u"], ["v"])
        small = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = _kept(small)
    raise RuntimeError(f"components didn't settle in {rounds} rounds")
