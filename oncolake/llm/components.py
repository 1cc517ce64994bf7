"""Connected components of a graph given as links, by repeated star contraction.

Every round makes each node's neighbours point to the smallest one of them, first the larger
neighbours and then the smaller ones (large star, small star). The rounds grow with the
logarithm of a component's size, not with the length of its chains. A node that most links end
at, as the middle of a star does, is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake.llm.shared import checkpointed, with_total

MAX_ROUNDS = 100


def _large_star(links: DataFrame, tasks: int | None) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = both.coalesce(tasks) if tasks else both
    larger = with_total(both, "u", "v", F.min("v"), F.min, "m", keep=F.col("v") > F.col("u"))
    return larger.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(links: DataFrame, tasks: int | None) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("v"))
    moved = with_total(links, "u", "v", F.min("v"), F.min, "m").filter(F.col("v") != F.col("m"))
    others = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    both = others.unionByName(least)
    return (both.coalesce(tasks) if tasks else both).distinct()


def components(links: DataFrame, links_a_task: int | None = None) -> DataFrame:
    """(node, root) of every node in `links`, whose two columns are the ends of a link.

    The root is the smallest node of the component. Links to oneself, repeated links and their
    direction do not matter; nodes without a link to another are not in the result, and links
    with a null end are none. Each round is kept in the shared folder.

    With `links_a_task` a round has no more tasks than there are so many links for: every task of
    every shuffle leaves files, which for few links are more than the links.
    """
    a, b = links.columns
    now = checkpointed(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    tasks = max(1, -(-now.count() // links_a_task)) if links_a_task else None
    state = None
    for _ in range(MAX_ROUNDS):
        now = checkpointed(_small_star(_large_star(now, tasks), tasks))
        found = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = tuple(found)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
