import math
import random

import numpy as np
from pyspark.sql import functions as F

from cupola.llm import topk


def brute(rows, every, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, a in ok:
        if i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in ok if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


def check(spark, rows, every=5, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(df, F.col("vec_id") % every == 0, k).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute(rows, every, k)


def test_index_is_exact(monkeypatch):
    rng = np.random.default_rng(1)
    for left in (0.0, 1 / 32, 1.0):
        monkeypatch.setattr(topk, "LEFT", left)
        for scale in (3, 100, 10**5, 10**8):
            v = rng.integers(-scale, scale, (300, 20))
            v[:40] = v[0]
            q = rng.integers(-scale, scale, (7, 20))
            for i, ids, score in topk.Index(v).search(q, 6):
                want = v @ q[i]
                last = np.sort(want)[-6]
                assert set(ids.tolist()) == set(np.flatnonzero(want >= last).tolist()) and (score == want[ids]).all()


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)]) for i in range(250)]
    hot = rows[7][1]
    rows = [(i, hot if rng.random() < 0.3 else v) for i, v in rows]  # a third are one vector
    rows += [(1000, None), (1005, [1.0, None] + [0.0] * 10), (1010, [float("nan")] * 12), (1015, [float("inf")] * 12), (None, [0.5] * 12)]
    check(spark, rows)
    monkeypatch.setattr(topk, "VECTORS", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    check(spark, rows, k=2)


def test_ties_few_rows_and_none(spark):
    check(spark, [(i, [1.0, 0.0]) for i in range(12)])
    check(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (5, [0.0, 0.0])])
    check(spark, [(0, [1.0])])
    check(spark, [])
    check(spark, [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [1.0, 1.0])][1:])
