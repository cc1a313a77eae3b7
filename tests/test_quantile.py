"""Exact quantiles equal numpy's, also when the brackets are narrowed repeatedly."""

import math
import random

import numpy as np
import pytest

from cupola.operators.quality import fill_missing_by_group
from cupola.operators.quantile import exact_quantiles, exact_quantiles_many, group_quantiles


@pytest.mark.parametrize("accuracy", [10, 200, 10_000])
def test_exact_quantiles_match_numpy(spark, accuracy):
    rnd = random.Random(9)
    vals = [float(rnd.randint(0, 300)) for _ in range(3000)] + [rnd.gauss(0, 50) for _ in range(3000)]
    rows = [(v,) for v in vals] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs, accuracy=accuracy)
    want = np.quantile(np.array(vals), probs, method="linear")
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-12)
    low = exact_quantiles(df, "x", probs, interpolation="lower", accuracy=accuracy)
    assert low == list(np.quantile(np.array(vals), probs, method="lower"))


def test_exact_quantiles_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]


def test_few_jobs_on_tied_columns(spark):
    df = spark.range(60_000).selectExpr("cast(id % 50 as double) as a", "cast(id % 9 as double) / 100 as b", "cast(1 as double) as c")
    group = "quantile-jobs"
    spark.sparkContext.setJobGroup(group, "count the jobs")
    got = exact_quantiles_many(df, {c: [0.25, 0.5, 0.75] for c in "abc"}, accuracy=1000)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext._jsc.clearJobGroup()
    assert got["c"] == [1.0, 1.0, 1.0] and got["a"][1] == 24.5
    assert jobs <= 10


def test_group_quantiles_and_fill_match_sorted_groups(spark):
    rnd = random.Random(6)
    rows = [("hot" if rnd.random() < 0.35 else f"g{rnd.randint(0, 12)}", rnd.choice([None, float("nan"), 1.0, 2.5, -3.0, rnd.random()])) for _ in range(800)]
    rows += [("empty", None), (None, 4.0), (None, None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    sound = lambda x: x is not None and x == x
    groups = {}
    for k, x in rows:
        if k is not None and sound(x):
            groups.setdefault(k, []).append(x)

    def quantile(v, p):
        v = sorted(v)
        pos = (len(v) - 1) * p
        lo, hi = v[math.floor(pos)], v[math.ceil(pos)]
        return lo + (pos - math.floor(pos)) * (hi - lo)

    got = {r.k: (r.n, r.q0, r.q1) for r in group_quantiles(df, ["k"], "x", [0.5, 0.9]).collect()}
    assert got == {k: (len(v), quantile(v, 0.5), quantile(v, 0.9)) for k, v in groups.items()}
    whole = quantile([x for _, x in rows if sound(x)], 0.5)
    out = fill_missing_by_group(df, "x", ["k"], add_indicator=True).collect()
    want = sorted((str(k), x if sound(x) else quantile(groups[k], 0.5) if k in groups else whole, int(not sound(x))) for k, x in rows)
    assert sorted((str(r.k), r.x, r.x_missing) for r in out) == want
