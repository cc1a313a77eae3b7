"""ROC / AUC on the edge cases of FIXTURES.md F7, against MLlib and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cupola.operators import metrics as M


def _scores(spark, rows):
    return spark.createDataFrame(rows, "model string, id bigint, score double, label int")


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    u = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return u / (len(pos) * len(neg))


def test_auc_edge_cases(spark):
    rows = []
    for i in range(20):
        rows.append(("equal", i, 0.5, i % 2))
        rows.append(("perfect", i, float(i), int(i >= 10)))
        rows.append(("reversed", i, float(-i), int(i >= 10)))
        rows.append(("one_class", i, float(i), 1))
    got = {r.model: r.auc for r in M.auc(_scores(spark, rows)).collect()}
    assert got == {"equal": 0.5, "perfect": 1.0, "reversed": 0.0, "one_class": None}


def test_auc_heavy_ties_matches_brute_force_and_mllib(spark):
    rnd = random.Random(7)
    rows = [("m", i, float(rnd.randint(0, 9)), rnd.randint(0, 1)) for i in range(2000)]
    df = _scores(spark, rows)
    got = M.auc(df, n_buckets=4).first().auc
    assert got == pytest.approx(_brute_auc([(s, y) for _, _, s, y in rows]), abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    mllib = ev.evaluate(df.withColumn("y", F.col("label").cast("double")))
    assert got == pytest.approx(mllib, abs=1e-9)


def test_roc_points_end_at_one_one(spark):
    rnd = random.Random(3)
    rows = [("m", i, rnd.random(), rnd.randint(0, 1)) for i in range(500)]
    pts = M.roc_points(_scores(spark, rows), n_buckets=8).orderBy(F.desc("threshold")).collect()
    assert len(pts) == len({r[2] for r in rows})
    assert pts[-1].tpr == 1.0 and pts[-1].fpr == 1.0
    assert all(a.tp <= b.tp and a.fp <= b.fp for a, b in zip(pts, pts[1:]))


def test_compare_models_ranks_by_auc(spark):
    rows = []
    for i in range(40):
        y = int(i >= 20)
        rows.append(("good", i, 0.9 if y else 0.1, y))
        rows.append(("coin", i, 0.5, y))
    out = {r.model: r for r in M.compare_models(_scores(spark, rows)).collect()}
    assert out["good"].best and out["good"].auc == 1.0 and out["good"].accuracy == 1.0
    assert not out["coin"].best and out["coin"].auc == 0.5
    assert out["good"].average_precision == 1.0


def test_auc_many_range_buckets_two_models_match_brute_force(spark):
    # more buckets than distinct scores of one model, continuous and tied scores mixed
    rnd = random.Random(11)
    rows = [("cont", i, rnd.random(), rnd.randint(0, 1)) for i in range(3000)]
    rows += [("ties", i, float(rnd.randint(0, 4)), rnd.randint(0, 1)) for i in range(3000)]
    got = {r.model: r.auc for r in M.auc(_scores(spark, rows).repartition(7), n_buckets=300).collect()}
    for m in ("cont", "ties"):
        want = _brute_auc([(s, y) for mm, _, s, y in rows if mm == m])
        assert got[m] == pytest.approx(want, abs=1e-12), m


def _brute_ap(pairs):
    # step-wise area under precision-recall, thresholds at each distinct score (ties together)
    n_pos = sum(y for _, y in pairs)
    if n_pos == 0:
        return None
    total = 0.0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(1 for t, y in pairs if t >= s and y == 1)
        fp = sum(1 for t, y in pairs if t >= s and y == 0)
        pos_here = sum(1 for t, y in pairs if t == s and y == 1)
        total += pos_here * tp / (tp + fp)
    return total / n_pos


@pytest.mark.parametrize("n_buckets", [1, 3, 50])
def test_average_precision_matches_brute_force(spark, n_buckets):
    rnd = random.Random(13)
    rows = [("m", i, float(rnd.randint(0, 30)) / 3.0, rnd.randint(0, 1)) for i in range(600)]
    got = M.average_precision(_scores(spark, rows).repartition(4), n_buckets=n_buckets).first().average_precision
    assert got == pytest.approx(_brute_ap([(s, y) for _, _, s, y in rows]), abs=1e-12)


def _delong(rows, models):
    """AUCs and their covariance by comparing every positive with every negative."""
    ids = sorted({i for _, i, _, _ in rows if sum(r[1] == i for r in rows) == len(models)})
    by = {(m, i): (s, y) for m, i, s, y in rows}
    ids = [i for i in ids if all((m, i) in by and by[m, i][0] is not None and by[m, i][1] is not None and not math.isnan(by[m, i][0]) for m in models)]
    pos, neg = [[i for i in ids if by[models[0], i][1] == y] for y in (1, 0)]
    v10, v01 = {}, {}
    for m in models:
        wins = np.array([[(by[m, i][0] > by[m, j][0]) + 0.5 * (by[m, i][0] == by[m, j][0]) for j in neg] for i in pos])
        v10[m], v01[m] = wins.mean(1), wins.mean(0)
    auc = {m: v10[m].mean() for m in models}
    cov = {(a, b): np.cov(v10[a], v10[b])[0, 1] / len(pos) + np.cov(v01[a], v01[b])[0, 1] / len(neg) for a in models for b in models}
    return len(pos), len(neg), auc, cov


def test_compare_auc_matches_every_pair_compared(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(260):
        y = int(rnd.random() < 0.4)
        rows += [("a", i, rnd.gauss(y, 1), y), ("b", i, float(rnd.randint(0, 3) + y), y), ("c", i, rnd.gauss(0, 1), y)]
    rows = [r for r in rows if r[:2] != ("c", 7)] + [("a", 900, 0.1, 1), ("b", 901, None, 1), ("a", 902, float("nan"), 0)]
    rows += [("a", 5, 0.5, 1)]  # an id that stands twice in a model is left out
    n_pos, n_neg, auc, cov = _delong(rows, ["a", "b", "c"])
    df = spark.createDataFrame(rows, "model string, id long, score double, label int")
    for n_buckets in (None, 3):
        got = M.compare_auc(df, n_buckets=n_buckets).collect()
        assert [(r.model_a, r.model_b) for r in got] == [("a", "a"), ("a", "b"), ("a", "c"), ("b", "b"), ("b", "c"), ("c", "c")]
        for r in got:
            a, b = r.model_a, r.model_b
            assert (r.n_pos, r.n_neg) == (n_pos, n_neg) and math.isclose(r.auc_a, auc[a]) and math.isclose(r.auc_b, auc[b])
            assert math.isclose(r.covariance, cov[a, b], rel_tol=1e-9, abs_tol=1e-15)
            if a == b:
                assert r.z is None and r.p_value is None
                continue
            se = math.sqrt(cov[a, a] + cov[b, b] - 2 * cov[a, b])
            assert math.isclose(r.std_error, se) and math.isclose(r.z, (auc[a] - auc[b]) / se, rel_tol=1e-9)
            assert math.isclose(r.p_value, math.erfc(abs(r.z) / math.sqrt(2)))


def test_compare_auc_without_spread_or_rows(spark):
    df = spark.createDataFrame([("a", 1, 0.5, 1), ("b", 1, 0.5, 1), ("a", 2, 0.1, 0), ("b", 2, 0.1, 0)], "model string, id long, score double, label int")
    got = M.compare_auc(df).collect()
    assert [(r.auc_a, r.covariance, r.z) for r in got] == [(1.0, None, None)] * 3
    got = M.compare_auc(df.where("label = 1")).collect()
    assert [(r.n_pos, r.n_neg, r.auc_a) for r in got] == [(1, 0, None)] * 3
    assert M.compare_auc(df.where("id > 9")).count() == 0
