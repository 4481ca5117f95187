"""Connected components of an edge table, distributed: labels and edges stay on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.llm.shared import drop_table, write_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b); root is the smallest node reachable. Nulls and loops are dropped.

    Each round gives a node the smallest label among its neighbours', then follows that label's own label (pointer
    jumping), so a chain of n nodes takes about log n rounds. Rounds are written to the shared folder.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    both = both.union(both.select(F.col("b"), F.col("a"))).distinct()
    both, edge_path = write_table(both, "edges")
    labels, path = write_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("heard"))
        step = labels.join(heard, "node").select("node", F.col("root").alias("old"), F.least("root", "heard").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        step = step.join(jump, "near").select("node", F.least("near", "far").alias("root"), (F.least("near", "far") < F.col("old")).alias("moved"))
        new, new_path = write_table(step, "labels")
        moved = new.where("moved").limit(1).count()
        drop_table(spark, path)
        labels, path = new.drop("moved"), new_path
        if not moved:
            drop_table(spark, edge_path)
            return labels
