"""Connected components of a link table, with star contraction.

Each round hangs the larger neighbours of a node, then the smaller ones, on the least of them. Both
steps are a minimum per node (combined before the shuffle) and a join; no neighbour list is ever
packed. Rounds end when no link changes; their number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.store import shared_folder


def _round(links: DataFrame) -> DataFrame:
    """links(a, b) with b < a; the result has the same components and this form."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    # Larger neighbours of a node go to its least neighbour.
    hung = links.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least.withColumnRenamed("a", "u"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    # Smaller neighbours, and the node itself, go to the least of them.
    low = hung.groupBy("a").agg(F.min("b").alias("m"))
    joined = hung.join(low, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links; component is the smallest node reachable.

    Links are pairs of long ids in either order, repeats and loops allowed; null ends are ignored.
    Nodes whose only links are loops are left out, as are nodes without links; no link, no rows.
    """
    shared_folder(links.sparkSession)
    # greatest and least skip null, so a link with a null end becomes a loop and goes.
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct().checkpoint()
    state = None
    for _ in range(most_rounds):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
        links = _round(links).checkpoint()
    else:
        raise RuntimeError(f"links do not settle in {most_rounds} rounds")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
