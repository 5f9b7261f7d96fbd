"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpack.session import written


def _large(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least", narrow=True)  # a table of its own, so that a hot node's links can be split
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least", narrow=True)
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def _size(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``): the least node of its component.

    Each round is written to the shared folder. Rounds grow with the logarithm of the nodes; they end when nothing changes.
    """
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", narrow=True)
    size = _size(now)
    last = None
    while size[0] and size != last:
        now = written(_small(_large(now).where("a <> b").distinct()).where("a <> b").distinct(), "links", narrow=True)
        last, size = size, _size(now)
    return written(now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct(), "roots", narrow=True)
