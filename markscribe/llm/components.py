"""Connected components of an edge table by label propagation with pointer jumping, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markscribe.llm.common import forget, written


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every end of ``edges(a, b)``.

    Each round takes the smallest label among a node's neighbours and then its label's label. Both are
    aggregates with partial minima, so a hub is combined before the shuffle.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        other = labels.select(F.col("id").alias("b"), F.col("component").alias("c"))
        nearest = both.join(other, "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        lower = labels.join(nearest, "id").select("id", F.least("component", "c").alias("component"), F.col("component").alias("old"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("j"))
        new = written(lower.join(jump, "component", "left").select("id", F.least("component", "j").alias("component"), "old"), "labels")
        changed = new.filter("component <> old").limit(1).count()
        forget(labels)
        labels = new
        if not changed:
            forget(both)
            return labels.select("id", "component")
