"""Connected components of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.storage import written


def _roots(best: DataFrame) -> DataFrame:
    """Follow u -> up until it ends, doubling the distance each time."""
    while True:
        up = best.select(F.col("u").alias("w"), F.col("up").alias("top"))
        best = written(
            best.join(up, best["up"] == up["w"]).select("u", "up", "top"), "components-jump"
        )
        moved = best.where("up <> top").limit(1).count()
        best = best.select("u", F.col("top").alias("up"))
        if not moved:
            return best


def components(links: DataFrame) -> DataFrame:
    """`id` and `component` of all ends of links (a, b); a component is named by its least id.

    In each round every node points to its least neighbour, or to itself if that is less, pointers
    are followed to their ends, and links between the ends remain: at most half of the nodes do.
    """
    links = written(links.where("a <> b").select("a", "b").distinct(), "components-links")
    ends = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    labels = ends.select("id", F.col("id").alias("component"))
    while links.limit(1).count():
        both = links.union(links.select("b", "a"))
        best = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("up"))
        best = _roots(written(best.select("u", F.least("u", "up").alias("up")), "components-best"))
        labels = written(
            labels.join(best, F.col("component") == F.col("u"), "left").select(
                "id", F.coalesce("up", "component").alias("component")
            ),
            "components-labels",
        )
        of_a = best.select(F.col("u").alias("a"), F.col("up").alias("x"))
        of_b = best.select(F.col("u").alias("b"), F.col("up").alias("y"))
        links = written(
            links.join(of_a, "a")
            .join(of_b, "b")
            .where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct(),
            "components-links",
        )
    return labels
