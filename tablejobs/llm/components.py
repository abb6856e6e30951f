"""Connected components of a growing set of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.store import saved


def _jump(parents: DataFrame) -> DataFrame:
    """Follow parents (node, label) to their roots: each pass halves the depth."""
    while True:
        up = parents.select(F.col("node").alias("label"), F.col("label").alias("_up"))
        moved = saved(parents.join(up, "label", "left").select(
            "node", F.coalesce("_up", "label").alias("label"),
            (F.col("_up") != F.col("label")).alias("_moved")), "component_jump")
        parents = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return parents


def join_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after joining what ``links`` (a, b) connect; the smallest
    label wins. Every pass hooks each component to its smallest neighbour, so the
    number of passes is logarithmic; nothing but emptiness is asked for by the driver."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    open_links = saved(links.join(left, "a").join(right, "b").filter("la <> lb").select(
        F.greatest("la", "lb").alias("a"), F.least("la", "lb").alias("b")).distinct(), "component_links")
    while not open_links.isEmpty():
        parents = _jump(saved(open_links.groupBy("a").agg(F.min("b").alias("label"))
                              .withColumnRenamed("a", "node"), "component_hooks"))
        up = parents.select(F.col("node").alias("label"), F.col("label").alias("_up"))
        labels = saved(labels.join(up, "label", "left").select("node", F.coalesce("_up", "label").alias("label")),
                       "component_labels")
        pa, pb = (parents.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
        open_links = saved(open_links.join(pa, "a", "left").join(pb, "b", "left").select(
            F.coalesce("la", "a").alias("x"), F.coalesce("lb", "b").alias("y")).filter("x <> y").select(
            F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "component_links")
    return labels
