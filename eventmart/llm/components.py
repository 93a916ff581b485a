"""Connected components by contraction: every round hooks each node to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import small, staged

#: So few edges are handled in one task, which saves the shuffles; larger tables are shuffled.
ONE_TASK = 500_000


def _flatten(parents: DataFrame) -> tuple[DataFrame, int]:
    """Parents replaced by roots: each pass doubles the distance a pointer jumps."""
    parents = staged(parents, "parents")
    rows = parents.count()
    while True:
        parents = _narrow(parents, rows)
        up = small(parents.select(F.col("node").alias("_n"), F.col("root").alias("_r")), rows)
        jumped = parents.join(up, F.col("root") == F.col("_n"), "left")
        jumped = staged(
            jumped.select("node", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")),
            "parents",
        )
        parents = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return parents, rows


def _narrow(df: DataFrame, rows: int) -> DataFrame:
    return df.coalesce(1) if rows <= ONE_TASK else df


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has two columns of ids.

    A component is named by its smallest node. Loops and nulls are ignored; repeated
    edges count once. Nothing is collected: a round is one aggregation with map-side
    combine and joins with the table of hooks, broadcast only while it is small.
    The last rounds, of few edges, run in one task each.
    The edges left after a round join different components, so they shrink quickly.
    """
    a, b = (F.col(f"`{c}`").cast("long") for c in edges.columns[:2])
    edges = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), (a.isNull() | b.isNull()).alias("_x"))
    edges = staged(edges.filter("not _x and hi > lo").select("hi", "lo").distinct(), "edges")
    labels = None
    while left := edges.count():
        edges = _narrow(edges, left)
        parents, rows = _flatten(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")))
        if labels is None:
            # every node is below some root; the roots are added at the end
            labels = parents
        else:
            up = small(parents.select(F.col("node").alias("_n"), F.col("root").alias("_r")), rows)
            moved = labels.join(up, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root"))
            # what is hooked now was a root before, and so isn't among the labels
            labels = staged(moved.unionByName(parents), "labels")
        up = small(parents.select(F.col("node").alias("_n"), F.col("root").alias("_r")), rows)
        for end in ("hi", "lo"):
            edges = edges.join(up, F.col(end) == F.col("_n"), "left").withColumn(end, F.coalesce("_r", end)).select("hi", "lo")
        edges = edges.filter("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo"))
        edges = staged(edges.distinct(), "edges")
    if labels is None:
        return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = labels.select(F.col("root").alias("node")).distinct()
    return labels.unionByName(roots.withColumn("root", F.col("node"))).withColumnRenamed("root", "component")
