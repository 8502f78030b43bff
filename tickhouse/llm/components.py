"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.session import settle


def components(
    links: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = settle
) -> DataFrame:
    """(node, root) for every end of the links (a, b), root being the least node it is linked with.

    Every round hands the neighbours of a node on to the least of them, so paths shrink by more
    than half, and the number of links never grows. Minima are combined before they are shuffled
    and joins may split popular nodes; nothing of the graph is collected. Rounds are written to
    the shared folder by ``keep`` and end when a round changes nothing. Nodes without links are not
    returned.
    """
    up = F.greatest("a", "b")
    down = F.least("a", "b")
    edges = keep(
        links.where(F.col("a") != F.col("b")).select(up.alias("a"), down.alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b"), F.col("b")).distinct()
            )
        before = tuple(mark)
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where(F.col("b") > F.col("a"))
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = keep(large, "large-star")
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(root, "a")
        small = joined.select("b", "m").where(F.col("b") != F.col("m")).union(joined.select("a", "m"))
        edges = keep(small.toDF("a", "b").distinct(), "small-star")
