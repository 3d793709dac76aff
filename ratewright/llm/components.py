"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of a link ``(a, b)``; a component is named by its least id.

    Each round gives a node the least label among its neighbours and then the label
    of its label, so chains shorten geometrically. The state is a written table of
    one row per node; nothing but one changed-row count reaches the driver.
    """
    ends = links.select("a", "b").where("a <> b")
    both = materialize(ends.union(ends.select("b", "a")).toDF("src", "dst").distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("src").alias("id")).agg(F.least("src", F.min("dst")).alias("component")), "labels"
    )
    while True:
        near = (
            both.join(labels, F.col("dst") == F.col("id"))
            .groupBy(F.col("src").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        stepped = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("step")
        )
        roots = labels.select(F.col("id").alias("root"), F.col("component").alias("above"))
        following = materialize(
            stepped.join(roots, F.col("step") == F.col("root")).select(
                "id", "old", F.least("step", "above").alias("component")
            ),
            "labels",
        )
        if following.where("old <> component").limit(1).count() == 0:
            return following.select("id", "component")
        labels = following.select("id", "component")
