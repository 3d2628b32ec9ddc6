"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut

#: Links that one task joins in memory at once (16 MB).
LOT = 1 << 20


def stars_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its group) of every node of the links (u, v) that is not the least one itself."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    up = np.arange(len(nodes))
    while len(a):
        least = np.minimum(up[a], up[b])
        np.minimum.at(up, up[a], least)
        np.minimum.at(up, up[b], least)
        while (up != up[up]).any():
            up = up[up]
        apart = up[a] != up[b]
        a, b = a[apart], b[apart]
    lower = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[lower], nodes[up[lower]]


def _contracted(links: DataFrame) -> DataFrame:
    """links (u, v), each lot of a task's links replaced by its stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def stars() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in stars_of(t["u"].to_numpy(), t["v"].to_numpy())], ["u", "v"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= LOT:
                yield stars()
                held, rows = [], 0
        if rows:
            yield stars()

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every node that a row (a, b) of ``links`` names; component is the least id reachable.

    Each task first replaces its links by stars, which never are more. If what is
    left is one lot, a task joins it; else large-star and small-star steps take
    turns until the links are stars around each component's least node. Each step
    is an aggregation to the least neighbour and a join back, so a node of any
    degree stays a skewed join, which Spark splits, and never a list.
    """
    stars = cut(_contracted(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v")))
    if stars.count() <= LOT:
        stars = cut(_contracted(stars.coalesce(1)))  # LOT links at most
        rounds = 0
    mark = None
    for _ in range(rounds):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        if rounds:
            raise RuntimeError("components did not settle")
    return stars.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
