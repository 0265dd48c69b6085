"""Connected components of a link table, as DataFrame jobs.

Alternating star contraction: the large-star step links every larger
neighbour of a node to the smallest one of its neighbourhood, the small-star
step does so with the smaller ones. Partitions first contract their own links
to a forest, so a dense group costs a forest per partition, not its pairs.
Every round is written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flocklens.llm.common import Run

_PAIR = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its group) that span the groups of a-b."""
    nodes, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = codes[: len(a)], codes[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _forests(frames):
    parts = [f for f in frames if len(f)]
    if parts:
        f = pd.concat(parts)
        a, b = forest(f["a"].to_numpy(np.int64), f["b"].to_numpy(np.int64))
        yield pd.DataFrame({"a": a, "b": b})


def components(links: DataFrame, run: Run) -> DataFrame:
    """(id, component): the smallest id reachable from each id in ``links(a, b)``.

    Links with a null end or equal ends link nothing; ids without links are
    not returned."""
    edges = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = run.keep(edges.mapInPandas(_forests, _PAIR), "forest")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        low = run.keep(low, "low")  # two tables: Spark can then split the join of a node with many neighbours
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every link now points down; small star: the smaller neighbours of a go to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        seen = Observation()
        star = down.unionByName(low.withColumnRenamed("m", "b")).distinct()
        star = star.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
        edges = run.keep(star, "star")
        now = seen.get
        if now == state:
            break
        state = now
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
