"""Sharding by Karmarkar-Karp differencing: shards of nearly equal bytes, equal texts together.

A partial partition is a tuple of shard loads. Differencing starts from one partial
partition per item (its size and zeros) and repeatedly joins the two of largest spread in
opposite order, the heaviest shard of one with the lightest of the other, until one is left.

Spark computes everything that grows with the table: sizes and text keys in one scan, then
one partial aggregate to a row per distinct text. The differencing takes a bounded number of
items however large the table is: every group of equal texts with at least ``total / items``
bytes is an item of its own (there can be at most ``items`` of these), and the smaller groups
are first added up to ``items`` bundles by the hash of their text. Groups are never split.

The slot of a row is its place in its shard: rows are numbered inside (shard, bucket) and
moved up by the counts of the buckets before, so no task holds a whole shard.

Edge cases: a null text has size 1 and goes with the empty texts; rows that repeat in full
get different slots of the same shard; an empty table gives no rows; only the id and the
text are read, so extra columns do not matter; null ids are placed like others.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cupola.session import materialise

from .common import text_key


def differencing(sizes: list[int], n_shards: int) -> list[int]:
    """Shard of each item by Karmarkar-Karp differencing; ties by item order."""
    if not sizes:
        return []
    # (-spread, order, loads ascending, members: a tree of items per load)
    heap = []
    for i, s in enumerate(sizes):
        heap.append((-s, i, (0,) * (n_shards - 1) + (s,), (None,) * (n_shards - 1) + (i,)))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, a, am = heapq.heappop(heap)
        _, _, b, bm = heapq.heappop(heap)
        both = sorted(((x + y, k) for k, (x, y) in enumerate(zip(a, reversed(b)))), key=lambda t: (t[0], t[1]))
        members = tuple((am[k], bm[n_shards - 1 - k]) for _, k in both)
        loads = tuple(x for x, _ in both)
        heapq.heappush(heap, (loads[0] - loads[-1], order, loads, members))
        order += 1
    shard = [0] * len(sizes)
    for k, tree in enumerate(reversed(heap[0][3])):  # the heaviest is shard 0
        stack = [tree]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack.extend(x)
            elif x is not None:
                shard[x] = k
    return shard


def assign(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text", items: int = 4096) -> DataFrame:
    """Rows ``(id, size, text_crc32, law, shard, slot, grown_shard)``, one per row of ``docs``.

    ``items`` bounds both the large groups and the bundles that reach the driver.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2 = text_key(text_col)
    base = materialise(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            h1.alias("h1"),
            h2.alias("h2"),
        )
    )
    groups = materialise(base.groupBy("h1", "h2", "size").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") >= F.lit(total / items)
    bundle = F.pmod("h1", F.lit(items)).cast("int")
    big = groups.where(large).select("h1", "h2", "size", "bytes").collect()  # at most `items` rows
    small = groups.where(~large).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).collect()
    big.sort(key=lambda r: (-r["bytes"], r["h1"], r["h2"]))
    small.sort(key=lambda r: (-r["bytes"], r["bundle"]))
    shard = differencing([r["bytes"] for r in big] + [r["bytes"] for r in small], n_shards)
    big_to = spark.createDataFrame(
        [(r["h1"], r["h2"], r["size"], s) for r, s in zip(big, shard)], "h1 long, h2 long, size long, own int"
    )
    small_to = spark.createDataFrame([(r["bundle"], s) for r, s in zip(small, shard[len(big) :])], "bundle int, shared int")
    placed = materialise(
        base.withColumn("bundle", bundle)
        .join(F.broadcast(big_to), ["h1", "h2", "size"], "left")  # at most `items` rows each
        .join(F.broadcast(small_to), "bundle", "left")
        .withColumn("shard", F.coalesce("own", "shared"))
        .withColumn("part", F.pmod(F.xxhash64(F.lit(3), id_col, "text_crc32", "h1"), F.lit(_parts(spark))).cast("int"))
        .select(id_col, "size", "text_crc32", "h1", "shard", "part")
    )
    before = (
        placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
        .withColumn("first", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n"))
        .select("shard", "part", "first")
    )
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy(id_col, "text_crc32", "h1"))
    return (
        placed.withColumn("nth", nth)
        .join(before, ["shard", "part"])
        .select(
            id_col,
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _parts(spark) -> int:
    """Buckets per shard: as many as the session has shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
