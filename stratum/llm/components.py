"""Connected components of links, by labels passed along links and through other labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its least node.

    Each round takes the least label among a node's neighbours, then the label of that
    label; paths shorten by more than half a round.  Every round is written to the shared
    folder, so that a lost executor costs a round at most.  Minima are taken in each map task before
    a shuffle, and joins are of stored tables, which Spark splits at a hot node.

    Defined results: a link of a node to itself makes a component of its own; repeated and reversed links count once;
    links with a NULL end are left out; without links there are no rows.
    """
    links = links.where("a is not null and b is not null")
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                  "component-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")),
                    "component-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("component").alias("near")))
        stepped = stored(labels.join(near, "node").select(
            "node", F.least("component", "near").alias("component"),
            (F.col("near") < F.col("component")).alias("changed")), "component-step")
        if stepped.where("changed").isEmpty():
            return labels
        of = stepped.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = stored(stepped.join(of, "component").select("node", F.col("further").alias("component")),
                        "component-labels")
