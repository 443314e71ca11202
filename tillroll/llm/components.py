"""Connected components of a graph that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import forget, store


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a``, ``b``, both long); the label is the
    smallest node of the component.

    Large-star and small-star steps by turns until nothing changes: each step hangs a node's
    neighbours under the smallest of them, so edges never multiply. Sums and minima are taken
    in every task before the shuffle, a hub's edges are joined to its one minimum, and each
    round is stored, so that its work is neither repeated nor lost. Edges from a node to
    itself name a node without neighbours. Nulls are ignored; no edges give no rows.
    """
    # What gives the edges may be a long search: it runs once, here.
    given = store(
        edges.where("a IS NOT NULL AND b IS NOT NULL")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    links, stored = given.where("a <> b"), []
    sign = _sign(links)
    while sign[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = store(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), "m")
            .where("a <> m")
            .select("a", F.col("m").alias("b"))
            .distinct()
        )
        following = store(small, "small-star")
        after = _sign(following)
        forget(edges.sparkSession, large, *stored)
        links, stored, settled = following, [following], after == sign
        sign = after
        if settled:
            break
    heads = links.select(F.col("b").alias("node"), F.col("b").alias("label"))
    alone = given.select(F.explode(F.array("a", "b")).alias("node"))
    found = links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(heads)
    named = found.unionByName(alone.select("node", F.col("node").alias("label")))
    result = store(named.groupBy("node").agg(F.min("label").alias("label")), "components")
    forget(edges.sparkSession, given, *stored)
    return result


def _sign(links: DataFrame) -> tuple:
    """Changes whenever the set of links does, but for a chance of 2^-64."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), digest).first())
