"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkinfer.llm.common import let_go, stored
from sparkinfer.operators.joins import attach

#: Links, some 50 bytes each, that one task may join at the end.
ONE_TASK = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a task's links: what comes out links every node to its root in the task."""
    let_go()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at:at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(part, np.int64)),
                                          pa.array(np.array([root(x) for x in part], np.int64))], names=["u", "v"])


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of a link.

    Tasks first join their own links by union-find; what is left are at most (nodes of the
    task) links to roots. Up to ``ONE_TASK`` of them, which is counted, are joined by one more
    union-find. With more, smallest labels spread over the links and are followed to their
    own labels, so that chains halve a round, until a round changes nothing. A hub, or a label that
    very many nodes share, is looked up from a broadcast (``attach``), and minima are
    pre-aggregated; so neither meets one task. Each round is stored in the shared folder.
    """
    forest = stored(links.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
                    .mapInArrow(_forest, "u long, v long"), "forest")
    if forest.limit(ONE_TASK + 1).count() <= ONE_TASK:
        whole = stored(forest.coalesce(1).mapInArrow(_forest, "u long, v long"), "forest")
        tops = whole.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
        return whole.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(tops)
    both = forest.unionByName(forest.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = stored(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("links")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("root"), "links"), "labels")
    while True:
        ends = labels.select(F.col("node").alias("v"), F.col("root").alias("m"), "links")
        near = attach(both, ends, ["v"], "links", how="inner").groupBy(F.col("u").alias("node")).agg(F.min("m").alias("m"))
        spread = stored(labels.join(near, "node").select("node", "root", F.least("root", "m").alias("low"), "links"), "labels")
        jump = (spread.groupBy("low").agg(F.count("*").alias("held"))
                .join(labels.select(F.col("node").alias("low"), F.col("root").alias("of_low")), "low"))
        step = stored(attach(spread, jump, ["low"], "held").select(
            "node", F.least("low", F.coalesce("of_low", "low")).alias("root"), F.col("root").alias("was"), "links"), "labels")
        labels = step.select("node", "root", "links")
        if step.where(F.col("root") != F.col("was")).isEmpty():
            return labels.select("node", "root")
