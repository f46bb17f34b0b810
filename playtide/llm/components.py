"""Connected components of a graph given as a table of links, without leaving Spark.

Stars are contracted until nothing changes: every node links its larger neighbours to
the smallest node it knows, then its smaller neighbours. The number of rounds grows with
the logarithm of a component's diameter. Each round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import stored


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def roots(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """For each linked node the smallest node it can reach, as ``(node, root)``; roots and loose nodes have no row."""
    links = stored(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                   .where("u <> v").distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).union(links.select("v", "u"))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = (both.where("y > x").join(low, "x")
                 .select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low))
        links, before = stored(small.distinct(), "links"), state
        state = _state(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
