"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.session import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that links ``a, b`` lead to.

    Rounds of contraction: a node takes the smallest of itself and its
    neighbours, then that node's choice; links are redrawn between the chosen
    labels, and those within one label vanish, so later rounds are small.
    Every round is written to the checkpoint folder; nothing is collected.
    """
    edges = materialize(links.filter("a != b").select("a", "b").distinct(), "edges")
    label = None
    while True:
        both = edges.selectExpr("a AS node", "b AS other").unionByName(edges.selectExpr("b AS node", "a AS other"))
        choice = materialize(both.groupBy("node").agg(F.min("other").alias("least"))
                             .select("node", F.least("node", "least").alias("to")), "labels")
        hop = choice.selectExpr("node AS to", "to AS label")
        step = materialize(choice.join(hop, "to").select("node", "label"), "labels")
        if label is None:
            now = step
        else:
            nxt = step.selectExpr("node AS label", "label AS further")
            now = materialize(label.join(nxt, "label", "left").select(
                "node", F.coalesce("further", "label").alias("label")), "labels")
        redrawn = (edges.join(step.selectExpr("node AS a", "label AS la"), "a")
                   .join(step.selectExpr("node AS b", "label AS lb"), "b")
                   .filter("la != lb").selectExpr("least(la, lb) AS a", "greatest(la, lb) AS b").distinct())
        left = materialize(redrawn, "edges")
        discard(edges, choice, *[x for x in (label, step) if x is not None and x is not now])
        edges, label = left, now
        if not edges.limit(1).count():
            discard(edges)
            return label
