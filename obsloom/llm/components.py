"""Connected components of a link table, by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.session import checkpointed


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of long ids: (id, label), the smallest id that each linked id reaches.

    Each round every id takes the smallest label of its neighbours and then that label's own label, so
    paths halve. Smallest labels are aggregated before they are shuffled; a hub costs no more than its links.
    """
    both = checkpointed(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("id"), F.least("a", "least").alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), F.col("label").alias("of_b")), "b")
            .groupBy("a").agg(F.min("of_b").alias("near"))
        )
        lower = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("lower"))
        jump = labels.select(F.col("id").alias("lower"), F.col("label").alias("jump"))
        after = checkpointed(
            lower.join(jump, "lower").select("id", F.least("lower", "jump").alias("new"), (F.least("lower", "jump") < F.col("label")).alias("changed"))
        )
        labels = after.select("id", F.col("new").alias("label"))
        if after.filter("changed").isEmpty():
            return labels
