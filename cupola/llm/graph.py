"""Connected components of a link table, by Spark jobs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cupola.session import materialise

#: Links (both ways) that a task of a round holds about.
TASK_ROWS = 1 << 17


def components(links: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node of ``links(a, b)``; the root is its component's smallest node.

    Alternating star contraction: every round hooks larger neighbours to the smallest known
    one, and the number of rounds grows with the logarithm of the longest chain. A round
    writes its links once; only a count and a checksum reach the driver. The count sizes the
    round's tasks: a shuffle leaves files for every task before it, however few its rows.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while True:
        tasks = math.ceil(2 * state[0] / TASK_ROWS) or 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(least.withColumnRenamed("m", "b")).coalesce(tasks).distinct().coalesce(tasks))
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64(F.lit(5), "b", "a"))).first())
