"""Connected components of a table of links, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cuts import Cuts


def components(cuts: Cuts, links: DataFrame) -> DataFrame:
    """(id, root) for every linked id that is not itself a root; root is the smallest id reachable.

    `links` has the whole-number columns a and b; order, repeats and loops do not matter. In each
    round every id with a smaller neighbour hooks to its smallest one, chains are shortened by
    doubling, and the links are carried over to the roots. A star takes one round, any graph a
    logarithmic number. All state lies in written tables; no list of neighbours is ever built.
    """
    edges = cuts.cut(_canonical(links.select("a", "b")))
    labels = None
    while not cuts.empty(edges):
        hooks = _shorten(cuts, edges.groupBy("a").agg(F.min("b").alias("root")))
        moved = hooks.select(F.col("a").alias("from"), F.col("root").alias("to"))
        if labels is None:
            labels = hooks.select(F.col("a").alias("id"), "root")
        else:
            raised = labels.join(moved, labels.root == moved["from"], "left").select(
                "id", F.coalesce("to", "root").alias("root")
            )
            labels = cuts.cut(raised.union(hooks.select("a", "root")))
        for end in ("a", "b"):
            edges = edges.join(moved, F.col(end) == F.col("from"), "left").withColumn(
                end, F.coalesce("to", end)
            )
            edges = edges.select("a", "b")
        edges = cuts.cut(_canonical(edges))
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return labels


def _canonical(links: DataFrame) -> DataFrame:
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a != b")
        .distinct()
    )


def _shorten(cuts: Cuts, hooks: DataFrame) -> DataFrame:
    """Let every id point to the end of its chain."""
    hooks = cuts.cut(hooks)
    while True:
        up = hooks.select(F.col("a").alias("via"), F.col("root").alias("next"))
        jumped = cuts.cut(
            hooks.join(up, F.col("root") == F.col("via"), "left").select(
                "a", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")
            )
        )
        done = cuts.empty(jumped.filter("on"))
        cuts.drop(hooks)
        hooks = jumped.select("a", "root")
        if done:
            return hooks
