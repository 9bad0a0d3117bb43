"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheaf.session import stage

ROUNDS = 60


def _starred(links: DataFrame, large: bool) -> DataFrame:
    """Move links of every node to the smallest node near it.

    ``links`` has ``a < b``. The large star looks at all neighbours of a node and moves
    those above it; the small star looks at those below it and moves them and itself.
    """
    near = links.select("a", "b")
    if large:
        near = near.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    # written, so that the join shuffles both sides anew and Spark can split the links of one node
    least = stage(near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    moved = near.join(least, "a")
    if large:
        moved = moved.filter("b > a").select("root", "b")
    else:
        moved = moved.select("root", "b").unionByName(least.select("root", F.col("a").alias("b")))
    return moved.filter("root <> b").select(F.col("root").alias("a"), "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``links`` (a, b: bigint).

    Links may repeat, point either way or join a node to itself; nulls are dropped.
    Every round is written to the shared folder, so lineage stays short; the number of
    rounds grows with the logarithm of the longest chain. A node with a third of all
    links is only ever a key of sums and of joins that Spark can split.
    """
    links = links.filter("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    links = stage(links.distinct(), "links")
    for _ in range(ROUNDS):
        if links.isEmpty():
            break
        after = stage(_starred(_starred(links, large=True), large=False), "links")
        # a star has every node below one root, and no root below another
        unsettled = after.groupBy("b").count().filter("count > 1").limit(1).count() or after.join(
            after.select(F.col("b").alias("a")), "a", "leftsemi"
        ).limit(1).count()
        links = after
        if not unsettled:
            break
    else:
        raise RuntimeError(f"no settled components after {ROUNDS} rounds")
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
