"""Exact top-k search by inner product: an impact-ordered index, processed score at a time.

Components are integers, ``floor(256 * x)``. A component's impact is its magnitude, quantised
to levels; a posting segment holds the vectors with one level and sign in one dimension. The
segments of a block are processed from the highest level down for a block of queries at once,
each adding query weight times quantised impact to the accumulators of its vectors.

After a level with bound ``r`` (no component has more than ``r`` left to add, whether its
segment was processed or not) every score lies within ``weight * r`` of its accumulator, where
``weight`` is the sum of the query's absolute components. A vector whose accumulator is more
than ``2 * weight * r`` below the k-th best accumulator is proven out. Processing stops when few
enough vectors are left, or at the last level; those left are scored exactly.

Spark deals blocks of vectors and blocks of queries to cells and merges the best of the cells.
Vectors equal in all components are one entry with its ``k + 1`` smallest ids: more of them can
never be in a result, so copies cost nothing.

Edge cases: vectors that are null or hold a null or non-finite component, and rows without an
id, take no part; vectors of different lengths are padded with zeros; ties go to the smaller
id; with fewer than k candidates all are returned; rows with the query's id are not its
candidates, and rows equal in id and vector count once; extra columns are not read; an empty
table gives no rows. Scores must fit into 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cupola.session import materialise

#: Vectors and queries of a cell.
VECTORS, QUERIES = 4096, 512
LEVELS = 32
#: Processing stops when no query of the cell has more than this share of the vectors left.
LEFT = 1 / 32


class Index:
    """Posting segments of a block: per dimension, vectors ordered by level and sign."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        most = int(np.abs(vectors).max(initial=0))
        self.step = max(1, -(-(most + 1) // LEVELS))
        level = np.abs(vectors) // self.step
        signed = np.where(vectors < 0, -level, level)
        self.top = int(level.max(initial=0))
        self.segments: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in range(self.top + 1)]
        for d in range(vectors.shape[1]):
            order = np.argsort(signed[:, d], kind="stable")
            cuts = np.flatnonzero(np.diff(signed[order, d])) + 1
            for ids in np.split(order, cuts):
                if len(ids) and (v := int(signed[ids[0], d])):
                    self.segments[abs(v)].append((d, v, ids))

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(query, vectors, scores)``: the k best vectors of each query, and all that tie with the last."""
        n, weight = len(self.vectors), np.abs(queries).sum(1)
        reach = float(weight.max(initial=0)) * float(np.abs(self.vectors).max(initial=0))
        kind = np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else np.int64  # sums stay exact
        acc = np.zeros((n, len(queries)), kind)
        by_dim = np.ascontiguousarray(queries.T).astype(kind)
        k = min(k, n)
        left = np.ones((n, len(queries)), bool)
        for level in range(self.top, 0, -1):
            for d, v, ids in self.segments[level]:
                acc[ids] += by_dim[d] * kind(v * self.step)
            if level > 1 and level % 4:
                continue
            worst = np.partition(acc, n - k, axis=0)[n - k]
            rest = level * self.step - 1  # what any component may still add, per unit of weight
            left = worst - acc <= 2 * weight.astype(np.float64) * rest * (1 + 1e-9)
            if left.sum(0).max(initial=0) <= max(4 * k, LEFT * n):
                break
        whole = np.float64 if reach < 2**53 else np.int64
        for q in range(len(queries)):
            ids = np.flatnonzero(left[:, q])
            score = (self.vectors[ids].astype(whole) @ queries[q].astype(whole)).astype(np.int64)
            best = score >= np.partition(score, len(score) - k)[len(score) - k]
            yield q, ids[best], score[best]


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows ``(vec_id, v, h1, h2)`` of the vectors that take part; ``h1, h2`` name the vector."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    sound = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = F.transform("x", lambda c: F.floor(256 * c).cast("long"))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
        .select(F.col(id_col).alias("vec_id"), x.alias("x"))
        .where(sound)
        .select("vec_id", v.alias("v"))
        .withColumn("h1", F.xxhash64("v"))
        .withColumn("h2", F.xxhash64(F.lit(7), "v"))
    )


def search(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: for each row where the condition ``is_query``
    on ``vec_id`` holds, its k best other rows."""
    import pyarrow as pa

    rows = materialise(quantised(vectors, id_col, vec_col).dropDuplicates(["vec_id", "h1", "h2"]))
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    entries = materialise(
        rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("h1", "h2")
        .agg(F.first("v").alias("v"), F.collect_list("vec_id").alias("ids"))
    )  # at most k + 1 ids each
    asked = materialise(rows.where(is_query).select("vec_id", "h1", "h2"))
    names = asked.select("h1", "h2").distinct()
    wanted = materialise(entries.join(names, ["h1", "h2"], "left_semi"))
    n_blocks = max(1, math.ceil(entries.count() / VECTORS))
    q_blocks = max(1, math.ceil(wanted.count() / QUERIES))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    offered = entries.select("h1", "h2", "v", "ids", F.pmod("h1", F.lit(n_blocks)).cast("int").alias("c")).select("*", span(q_blocks).alias("q"))
    asking = wanted.select("h1", "h2", "v", F.pmod("h2", F.lit(q_blocks)).cast("int").alias("q")).select("*", span(n_blocks).alias("c"))

    def matrix(col, width: int) -> np.ndarray:
        flat, at = col.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(pa.compute.list_value_length(col).to_numpy(zero_copy_only=False)))
        out = np.zeros((len(col), width), np.int64)
        for i in range(len(col)):
            out[i, : at[i + 1] - at[i]] = flat[at[i] : at[i + 1]]
        return out

    def cell(offered: pa.Table, asking: pa.Table) -> pa.Table:
        import pyarrow.compute  # noqa: F401

        schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not offered.num_rows or not asking.num_rows:
            return schema.empty_table()
        have, want = offered.column("v").combine_chunks(), asking.column("v").combine_chunks()
        width = max(int(pa.compute.max(pa.compute.list_value_length(c)).as_py() or 0) for c in (have, want))
        ids = offered.column("ids").to_pylist()
        h1, h2 = asking.column("h1").to_pylist(), asking.column("h2").to_pylist()
        out = []
        for q, found, score in Index(matrix(have, width)).search(matrix(want, width), k + 1):
            items = sorted((-s, i) for f, s in zip(found.tolist(), score.tolist()) for i in ids[f])[: k + 1]
            out += [(h1[q], h2[q], i, -s) for s, i in items]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema) if out else schema.empty_table()

    best = offered.groupBy("c", "q").cogroup(asking.groupBy("c", "q")).applyInArrow(cell, "h1 long, h2 long, vec_id long, score long")
    by_class = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("nth", F.row_number().over(by_class)).where(F.col("nth") <= k + 1).select("h1", "h2", F.col("vec_id").alias("other"), "score")
    rank = F.row_number().over(Window.partitionBy("query_id", "h1", "h2").orderBy(F.desc("score"), "other"))
    return (
        asked.select(F.col("vec_id").alias("query_id"), "h1", "h2")
        .join(best, ["h1", "h2"])
        .where(F.col("query_id") != F.col("other"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("other").alias("vec_id"), "score")
    )
