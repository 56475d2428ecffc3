"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; each step is an aggregation with partial minima before
the shuffle and a join, and is written to the shared folder, so an executor may
be lost at any time and plans do not grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


#: Nodes of most neighbours, at most so many, get theirs by broadcast, so that no task takes a hub's edges alone.
MAX_HUBS = 50_000
#: Fewest neighbours of a hub.
HUB = 1000


def _lowest(edges: DataFrame) -> DataFrame:
    """Each node ``u`` with the least of its neighbours and itself, and their number."""
    return edges.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("n")).select(F.col("u").alias("node"), F.least("least", "u").alias("least"), "n")


def _with_least(edges: DataFrame, low: DataFrame, n_edges: int) -> DataFrame:
    """``edges`` with the ``least`` of their node ``u``.

    ``low`` counts each edge at most twice, so no more than MAX_HUBS nodes have
    as many neighbours as a hub must.
    """
    hub = F.col("n") >= max(HUB, 2 * n_edges // MAX_HUBS + 1)
    hubs = low.where(hub).select(F.col("node").alias("hub"), F.col("least").alias("hub_least"))
    tagged = edges.join(F.broadcast(hubs), F.col("u") == F.col("hub"), "left")
    rest = tagged.where("hub IS NULL").select("u", "v").join(low.where(~hub), F.col("u") == F.col("node"))
    return tagged.where("hub IS NOT NULL").select("u", "v", F.col("hub_least").alias("least")).unionByName(rest.select("u", "v", "least"))


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    up = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return _with_least(up, _lowest(both), n_edges).select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v")


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    onward = _with_least(down, low, n_edges).where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return onward.unionAll(low.select(F.col("node").alias("u"), F.col("least").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of the edges ``u``, ``v``.

    Loops and repeated edges are harmless, null ends are ignored, and no edges
    give an empty table.
    """
    spark = edges.sparkSession
    now, path = written(edges.where("u <> v").distinct(), "edges")
    state, n = None, now.count()
    while n:
        between, between_path = written(_large_star(now, n), "edges")  # no more edges than before
        after, after_path = written(_small_star(between, n), "edges")
        found = tuple(after.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first())
        drop(spark, path)
        drop(spark, between_path)
        now, path, n = after, after_path, found[0]
        if found == state:
            break
        state = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
