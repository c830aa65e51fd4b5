"""Connected components of an undirected graph by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftop.session import written


def connected_components(edges: DataFrame) -> DataFrame:
    """v, label: for every end of an edge (u, v: long) the least node that it reaches.

    A round gives each node the least label of its neighbours, then that label's own label, so long chains halve. Edges and
    labels are written between rounds; rounds end when no label moves.
    """
    both = written(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = written(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("u", "v").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("v", "u"), "u").groupBy("v").agg(F.min("label").alias("near"))
        hop = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("v").alias("to"), F.col("label").alias("beyond"))
        step = written(
            hop.join(jump, "to", "left").select("v", F.col("label").alias("old"), F.least("to", F.coalesce("beyond", "to")).alias("label")),
            "labels",
        )
        labels = step.select("v", "label")
        if step.where("old <> label").isEmpty():
            return labels
