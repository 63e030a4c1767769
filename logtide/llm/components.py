"""Connected components by alternating star contractions.

Every step hangs the neighbours of a node on the smallest node around it, until nothing but
stars is left. A step is one aggregation (combined before the shuffle) and one join of the
links with it, which adaptive execution splits where one node has very many links. Each step
is written to the shared folder, so lineage does not grow and lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import written


def _hung(links: DataFrame, larger_only: bool) -> DataFrame:
    """Link neighbours of u with the smallest of u and its neighbours.

    ``links`` is directed; with ``larger_only`` only neighbours above u move (large star).
    """
    lowest = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = links.where("v > u") if larger_only else links
    return moved.join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b): root is the smallest node of its component.

    Null ends are ignored; repeated and self links are harmless. No links give no rows.
    """
    links = links.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(links.distinct(), "links")
    state = None
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = written(_hung(both, larger_only=True).distinct(), "links")
        # Small star: each node and its smaller neighbours hang on the smallest of these.
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(lowest, "u")
        small = joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        links = written(small.distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
