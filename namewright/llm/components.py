"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _to_minimum(links: DataFrame, larger_only: bool) -> DataFrame:
    """Link each node's neighbours to the smallest node around it.

    The minimum is reduced on the map side and stored, so that Spark can split the join
    that spreads it back where one node has many links.
    """
    smallest = stage(links.groupBy("a").agg(F.min("b").alias("m")), "smallest")
    joined = links.join(smallest, "a").withColumn("m", F.least("a", "m"))
    if larger_only:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionAll(smallest.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) of every linked node that isn't a root; ``root`` is the smallest reachable node.

    ``links`` has two long columns a and b, in any direction, repeated or not. Every
    round first links larger neighbours, then smaller ones, to the smallest neighbour,
    until all links point at roots; the rounds grow with the logarithm of the
    longest chain. Each round is a stored table, so a lost executor costs one round.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    stars = stage(ordered.distinct(), "links")
    check = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
    before = check(stars)
    while True:
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stage(_to_minimum(both, True), "links")
        stars = stage(_to_minimum(large, False), "links")
        now = check(stars)
        if now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
