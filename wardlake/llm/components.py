"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlake.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it can reach, for every node of ``links`` (a, b).

    Every round each node takes the least root among its own and its neighbours', and then
    that root's root. Each round is a written table; the last one changed nothing.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("near"))
        lower = roots.join(near, roots["node"] == near["a"]).select("node", F.least("root", "near").alias("up"), F.col("root").alias("was"))
        jump = roots.select(F.col("node").alias("up"), F.col("root").alias("upper"))
        moved = written(lower.join(jump, "up").select("node", F.least("up", "upper").alias("root"), "was"), "roots")
        roots = moved.select("node", "root")
        if not moved.where("root <> was").head(1):
            return roots
