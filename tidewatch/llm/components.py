"""Connected components of links between documents, as joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of any orderable type -> (id, lab): each linked id with the
    smallest id that it reaches. Ids without a link have no row.

    A round takes the smallest label among the neighbours, then the label of
    that label (so a chain halves each round), until a round changes nothing.
    Every round is a table in the shared folder: short lineage, and a lost
    executor costs one round. Minima are pre-aggregated, and the joins carry
    ids alone between plain exchanges, so a hub of many links is split."""
    both = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).where("a <> b")
    edges = written(both.unionAll(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "component-edges")
    labels = written(edges.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("lab")).select("id", F.least("id", "lab").alias("lab")), "component-labels")
    if labels.isEmpty():
        return labels
    while True:
        near = edges.join(labels.select(F.col("id").alias("dst"), "lab"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("lab").alias("near"))
        step = labels.join(near, "id").select("id", F.col("lab").alias("old"), F.least("lab", "near").alias("lab"))
        step = written(step, "component-step")
        up = step.select(F.col("id").alias("lab"), F.col("lab").alias("up"))
        labels = written(step.join(up, "lab").select("id", F.least("lab", "up").alias("lab"), "old"), "component-labels")
        if labels.where("lab <> old").isEmpty():
            return labels.select("id", "lab")
