"""Connected components by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, c) for every vertex of ``edges`` (a, b): ``c`` is the smallest vertex reachable.

    Each round takes the smallest label of the neighbours, then the label of that label, so
    chains halve. A round is stored; all joins are between plain scans, so a vertex with very
    many neighbours is split at run time. It ends when no label has moved.
    """
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("a").alias("u"))
    )
    both = stored(both, "edges")
    labels = stored(both.groupBy("v").agg(F.least("v", F.min("u")).alias("c")), "labels")
    total = _total(labels)
    while True:
        near = both.join(labels.withColumnRenamed("v", "u"), "u").select("v", "c").unionByName(labels)
        near = stored(near.groupBy("v").agg(F.min("c").alias("c")), "labels")
        before, total = total, _total(near)
        if total == before:
            return near
        up = near.select(F.col("v").alias("c"), F.col("c").alias("up"))
        labels = stored(near.join(up, "c").select("v", F.col("up").alias("c")), "labels")
        total = _total(labels)


def _total(labels: DataFrame):
    """Labels only ever fall, so their sum tells whether one has moved."""
    return labels.agg(F.sum(F.col("c").cast("decimal(38,0)"))).first()[0]
