"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.stage import discard, staged


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One star step: links each node's larger (or else its other) neighbours to its smallest.

    The smallest neighbour is found by a pre-aggregated minimum and joined back, so that a node
    with very many neighbours never has them in one task.
    """
    if larger:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
        out = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        out = down.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct("a", F.col("low").alias("b")),
        )).alias("link")).select("link.*")
    return out.where("a != b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether each node either has one link, to a smaller one, or is only linked to."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out")).unionAll(
        links.select(F.col("b").alias("node"), F.lit(0).alias("out"))
    )
    roles = ends.groupBy("node").agg(F.sum("out").alias("n"), F.min("out").alias("least"))
    return roles.where("n > 1 OR (n = 1 AND least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Smallest node of the component of each node that has a link: node, label. ``links`` has
    two long columns a and b. Alternates large and small stars until only stars are left, some
    log(n) times; each round is written, so that a lost executor costs its tasks only."""
    down = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = staged(down.distinct(), "links")
    while not _are_stars(links):
        last, links = links, staged(_star(_star(links, True), False), "stars")
        discard(last)
    ends = links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(ends)
