"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is two groupings with joins and is written to the shared folder, so a lost executor
costs one round at most. No component, link list or label reaches the driver; it sees a count and a
checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.xxhash64("b").cast("decimal(20,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the component's least node.

    Repeated links, both directions and links of a node to itself are allowed; a link with a
    missing end is ignored. No links give no rows.
    """
    proper = links.where("a is not null and b is not null and a != b")
    stars = staged(
        proper.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while (now := _state(stars)) != before:
        before = now
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: larger neighbours move to the least of node and neighbours
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        # small star: smaller neighbours, and the node, move to the least neighbour
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        stars = staged(small.distinct(), "links")
    roots = stars.select("b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
