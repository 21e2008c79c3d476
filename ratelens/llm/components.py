"""Smallest reachable id in a graph of links, without bringing the graph to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratelens.llm.tables import kept


def smallest_reachable(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``root``: for each id in a link the smallest id of its component.

    Links are non-null long pairs, in any order and number. Each round hands every node the
    smallest root among its neighbours and itself, then every node takes the root of its root, so
    chains shrink by halves. Rounds end when nothing changes. The minimum is combined before the
    shuffle, so a node with very many links costs one row per task; each round is a written table.
    """
    both = kept(
        links.select(F.col(left).alias("node"), F.col(right).alias("other"))
        .unionByName(links.select(F.col(right).alias("node"), F.col(left).alias("other")))
        .where("node <> other").distinct(), "links")
    now = kept(both.groupBy("node").agg(F.min("other").alias("near"))
               .select("node", F.least("node", "near").alias("root")), "roots")
    while True:
        offered = both.join(now.select(F.col("node").alias("other"), "root"), "other") \
            .groupBy("node").agg(F.min("root").alias("offer"))
        lower = kept(now.join(offered, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "offer").alias("root")), "roots")
        of_root = lower.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        jumped = kept(lower.join(of_root, "root", "left").select(
            "node", "was", F.coalesce("beyond", "root").alias("root")), "roots")
        if jumped.where("root <> was").isEmpty():
            return jumped.select("node", "root")
        now = jumped.select("node", "root")
