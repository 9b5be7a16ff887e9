"""Connected components of a link table, by joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.llm.forests import spanning_forest
from quartermark.session import written_once

ROUNDS = 100
# Links that one task connects at once.
TASK_LINKS = 500_000


def thinned(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect the same nodes: in each task the smallest node of a group with all others of it."""

    def forest(batches):
        held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
        if held:
            a, b = (np.concatenate(x) for x in zip(*held))
            _, edges = spanning_forest(np.tile(np.arange(len(a)), 2), np.concatenate([a, b]))
            yield pa.RecordBatch.from_pydict({"a": edges[:, 0], "b": edges[:, 1]})

    tasks = max(1, -(-links.count() // TASK_LINKS))
    return links.repartition(tasks).mapInArrow(forest, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``links`` (a, b).

    Links are first thinned out in tasks of bounded size, which leaves few rounds.
    Each round gives a node the smallest label among its neighbours and itself,
    then the label of that label, so distances shrink by more than half. Rounds
    are written tables, which cuts lineage. A node with very many links is one
    row on the label side of the join, and its links are split by adaptive
    execution.
    """
    both = thinned(written_once(links.filter("a <> b").select("a", "b"), "links"))
    both = written_once(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written_once(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    for _ in range(ROUNDS):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        next_label = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        stepped = written_once(
            next_label.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")),
            "labels",
        )
        labels = stepped.select("node", "label")
        if stepped.filter("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
