"""Connected components of an edge list, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.shared import materialize, spent


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id that occurs in ``links``; the component is its smallest id.

    Each round takes the smallest label among an id's neighbours, then follows
    labels to their own labels, so the rounds grow with the logarithm of a chain's
    length. Minima are summed in the map tasks and joined back: an id with very many
    links is never gathered. Null ends, loops and repeated links change nothing; no
    links give no rows. Every round is written to the shared folder.
    """
    spark = links.sparkSession
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = materialize(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = materialize(
        edges.groupBy(F.col("u").alias("id")).agg(F.least(F.min("u"), F.min("v")).alias("component")), "labels"
    )
    last = labels
    while True:
        near = edges.join(labels, edges["v"] == labels["id"]).groupBy("u").agg(F.min("component").alias("near"))
        closer = labels.join(near, labels["id"] == near["u"], "left").select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("next")
        )
        closer = materialize(closer, "labels")
        heads = closer.select(F.col("id").alias("head"), F.col("next").alias("beyond"))
        moved = closer.join(heads, closer["next"] == heads["head"], "left").select(
            "id", "was", F.least("next", "beyond").alias("component")
        )
        moved = materialize(moved, "labels")
        spent(last, closer)
        last, labels = moved, moved.select("id", "component")
        if moved.where(F.col("was") != F.col("component")).isEmpty():
            spent(edges)
            return labels
