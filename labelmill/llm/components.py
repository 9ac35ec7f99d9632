"""Connected components of links between numbered nodes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.session import stored


def _least_below(links: DataFrame, name: str) -> DataFrame:
    """``(node, least)``: the least smaller neighbour of each node that has any."""
    return stored(
        links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), f"{name}-least"
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least node around it."""
    least = _least_below(links, "large-star")
    moved = links.join(least, links.b == least.node, "left").select(
        "a", F.coalesce("least", "b").alias("b")
    )
    return stored(moved.distinct(), "large-star")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    least = _least_below(links, "small-star")
    moved = links.join(least, links.a == least.node).filter("b != least")
    own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return stored(
        moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(own).distinct(),
        "small-star",
    )


def _sign(links: DataFrame) -> tuple:
    """Differs between two sets of links, but for a chance of about 2^-60."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of links ``(a, b)``; a component is its least node.

    Alternates two star contractions until the links no longer change; their
    number of rounds grows with the logarithm of the longest chain. The least
    neighbour is an aggregate, reduced in the map tasks and joined back, so no
    task gathers the neighbours of a node; both sides of the join are read from
    storage, where Spark's skew join can split a node with very many links.
    Every round is written to the shared folder, which cuts the lineage.
    """
    links = stored(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    now, before = _sign(links), None
    while now != before:
        links, before = _small_star(_large_star(links)), now
        now = _sign(links)
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.union(roots)
