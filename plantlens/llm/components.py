"""Connected components of a link table, by spreading smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import written


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b), and of ``known``,
    the components of other links; label is the smallest node reachable.
    Of known components, only the labels that ``links`` reach are spread.
    A round takes the smallest label among the neighbours and then the
    label's own label, so that long chains shorten by half or more. Every
    round is a written table."""
    if known is not None:
        for end in ("a", "b"):
            placed = links.join(known.toDF(end, "label"), end, "left")
            links = placed.withColumn(end, F.coalesce("label", end)).drop("label")
    edges = written(_starred(links), "links")
    both = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("near")), F.struct(F.col("b").alias("node"), F.col("a").alias("near")))
    ends = edges.select(F.explode(both).alias("e")).select("e.*").distinct()
    labels = written(
        ends.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("label")), "labels"
    )
    while True:
        seen = ends.join(labels.select(F.col("node").alias("near"), F.col("label").alias("other")), "near")
        spread = seen.groupBy("node").agg(F.min("other").alias("other"))
        hooked = labels.join(spread, "node").select("node", F.least("label", "other").alias("next"), "label")
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        after = written(
            hooked.join(jump, "next").select("node", F.least("next", "far").alias("label"), F.col("label").alias("old")),
            "labels",
        )
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            break
    if known is None:
        return labels
    moved = known.join(labels.toDF("label", "other"), "label", "left")
    new = labels.join(known.select("node"), "node", "left_anti")
    return written(moved.select("node", F.coalesce("other", "label").alias("label")).unionByName(new), "labels")


def _starred(links: DataFrame) -> DataFrame:
    """Links (a, b) of the same components, few if many nodes share several
    smaller neighbours: a node keeps the link with the smallest of these, and
    the others are linked with that one instead of with the node. A node
    without other neighbours than itself keeps that link."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = links.select(low.alias("low"), high.alias("high"))
    least = edges.groupBy("high").agg(F.min("low").alias("a"))
    pairs = edges.join(least, "high").select("a", F.explode(F.array("high", "low")).alias("b"))
    return pairs.where("a <> b").unionByName(links.where("a = b")).distinct()
