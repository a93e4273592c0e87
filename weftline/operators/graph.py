"""Connected components of a graph by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the vertices of edges (a, b): the smallest vertex each is connected with.

    A round takes, for every vertex, the least label among itself and its
    neighbours, then the label of that label; both are minima or joins by key,
    so a vertex may have any part of the edges. Labels only fall; when their sum
    and number stay, each component has one. Every round is written.
    """
    both = edges.where("a <> b").select("a", "b")
    both = materialize(both.union(both.select("b", "a")).distinct(), "graph-edges")
    label = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "graph-labels")
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.col("component").cast("decimal(38,0)"))).first())
    was = state(label)
    while was[0]:
        near = both.join(label.toDF("b", "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = label.join(near, "id").select("id", F.least("component", "near").alias("to"))
        jump = label.select(F.col("id").alias("to"), F.col("component").alias("then"))
        label = materialize(lower.join(jump, "to", "left").select("id", F.least("to", "then").alias("component")), "graph-labels")
        now = state(label)
        if now == was:
            break
        was = now
    return label
