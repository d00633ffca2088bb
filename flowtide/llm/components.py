"""Connected components of a graph in a DataFrame, by alternating large and small stars.

Each round attaches every node's larger neighbours to the smallest node it knows, then its smaller
ones; the graph ends as one star for each component, in a number of rounds that follows the
logarithm of the longest path. Minima are added up in each task before the shuffle. Every round is
written to the shared folder. No edge or node passes through the driver, only sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm import common


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) to (node, root), root being the smallest node of the component.

    Nodes without an edge to another node are left out; so are null ends.
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = common.store(ordered.filter("u != v").distinct(), "stars")
    state = _state(stars)
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.union(low.filter("low < u").select("u", F.col("low").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        stars = common.store(small.union(low.select("u", F.col("low").alias("v"))).filter("u != v").distinct(), "stars")
        before, state = state, _state(stars)
        if state == before:
            low = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return low.union(stars.select("v", "v").distinct().toDF("node", "root"))


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
