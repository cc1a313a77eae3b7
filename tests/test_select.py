"""Chi-square against MLlib's ChiSquareTest; VIF and correlation against numpy."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from cupola.operators import select as S
from tests.conftest import SF01


@pytest.fixture(scope="module")
def li(spark):
    df = spark.read.parquet(f"{SF01}/lineitem.parquet")
    return df.withColumn("label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0)) \
        .withColumn("ln", F.col("l_linenumber").cast("double")) \
        .withColumn("disc", F.round(F.col("l_discount") * 100))


def test_chi_square_matches_mllib(li):
    ours = {r.feature: r for r in S.chi_square(li, ["ln", "disc", "l_quantity"], "label").collect()}
    vec = VectorAssembler(inputCols=["ln", "disc", "l_quantity"], outputCol="f").transform(li)
    ref = ChiSquareTest.test(vec, "f", "label").first()
    for i, f in enumerate(["ln", "disc", "l_quantity"]):
        assert ours[f].statistic == pytest.approx(ref.statistics[i], rel=1e-9)
        assert ours[f].dof == ref.degreesOfFreedom[i]
        assert ours[f].p_value == pytest.approx(ref.pValues[i], rel=1e-6, abs=1e-12)


def test_chi2_sf_known_values(spark):
    assert S.chi2_sf(spark, 3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert S.chi2_sf(spark, 0.0, 3) == 1.0
    assert S.chi2_sf(spark, 18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    for dof in (1e6, 1e8):
        assert S.chi2_sf(spark, dof, dof) == pytest.approx(0.5, abs=1e-3)
    assert S.chi2_sf(spark, None, 1) is None and S.chi2_sf(spark, 1.0, 0) is None


def test_vif_matches_numpy(li):
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    got = S.vif_values(li, feats)
    x = np.array(li.select(*feats).collect(), dtype=float)
    want = np.diag(np.linalg.inv(np.corrcoef(x, rowvar=False)))
    for f, w in zip(feats, want):
        assert got[f] == pytest.approx(w, rel=1e-9)


def test_vif_select_drops_collinear(spark):
    df = spark.range(500).selectExpr("cast(id as double) as a", "cast(id * 2 + 1 as double) as b",
                                     "cast((id * 7919) % 101 as double) as c")
    kept, removed = S.vif_select(df, ["a", "b", "c"], threshold=10)
    assert len(removed) == 1 and removed[0][0] in ("a", "b") and "c" in kept


def test_corr_filter_keeps_stronger_with_label(spark):
    df = spark.range(400).selectExpr("cast(id as double) as a", "cast(id as double) * 3 + (id % 2) as b",
                                     "cast(id > 200 as int) as y")
    kept, dropped = S.corr_filter(df, ["a", "b"], "y", threshold=0.9)
    assert len(kept) == 1 and len(dropped) == 1


def test_collinear_features_in_any_order(spark):
    import itertools

    df = spark.range(500).selectExpr("cast(id as double) as a", "cast(id * 2 + 1 as double) as b",
                                     "cast((id * 7919) % 101 as double) as c", "cast((id * 104729) % 97 as double) as d",
                                     "cast(3 as double) as k")
    for order in itertools.permutations(["a", "b", "c", "d"]):
        v = S.vif_values(df, order)
        assert v["a"] == v["b"] == float("inf") and v["c"] < 1.1 and v["d"] < 1.1
    kept, removed = S.vif_select(df, ["c", "k", "a", "d", "b"], threshold=10)
    assert kept == ["c", "a", "d"] and [f for f, _ in removed] == ["k", "b"]


def test_constant_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, 7.0, 5.0), (float("nan"), 1.0, 5.0), (9.0, None, 5.0)], "a double, b double, k double")
    got = {(r.feature_a, r.feature_b): r["corr"] for r in S.corr_pairs(df, ["a", "k", "b"]).collect()}
    assert got["a", "k"] is None and got["k", "b"] is None
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 7])[0, 1])
    kept, _ = S.corr_filter(df, ["a", "k", "b"], threshold=0.99)
    assert kept == ["a", "k", "b"]
    assert S.corr_pairs(df.limit(0), ["a", "b"]).first()["corr"] is None


def test_many_features_in_one_pass(spark):
    df = spark.range(20_000).selectExpr(*[f"cast(pmod(xxhash64(id, {i}), 1000) as double) as f{i}" for i in range(56)])
    feats = [f"f{i}" for i in range(56)]
    m = S.correlation_matrix(df, feats)
    x = np.array(df.collect())
    assert np.allclose(m, np.corrcoef(x, rowvar=False), atol=1e-9)


def test_vif_keeps_its_digits_for_large_means_and_near_equal_features(spark):
    """Condition numbers up to 1e10: known inflation from orthogonal parts, with means of 1e6."""
    n = 512
    a = np.array([1.0 if i & 1 else -1.0 for i in range(n)])
    b = np.array([1.0 if i & 2 else -1.0 for i in range(n)])
    c = np.array([1.0 if i & 4 else -1.0 for i in range(n)])
    for eps in (2.0**-10, 2.0**-24, 2.0**-33):
        y = a + eps * b  # correlation 1 / sqrt(1 + eps^2), inflation 1 + 1 / eps^2 for both
        rows = [(float(u), float(v), float(w) + 1e6) for u, v, w in zip(a, y, c)]
        df = spark.createDataFrame(rows, "a double, y double, c double").repartition(7)
        got = S.vif_values(df, ["a", "y", "c"])
        want = 1 + 1 / eps**2
        assert abs(got["a"] / want - 1) < 1e-4 and abs(got["y"] / want - 1) < 1e-4 and abs(got["c"] - 1) < 1e-6
    exact = spark.createDataFrame([(float(u), float(3 * u + 1)) for u in a * 5 + b], "a double, y double")
    assert set(S.vif_values(exact, ["a", "y"]).values()) == {float("inf")}


def test_correlation_in_one_job_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (None, 3.0, 5.0)], "a double, b double, c double")
    m = S.correlation_matrix(df, ["a", "b", "c"])
    assert abs(m[0, 1] + 1) < 1e-12 and np.isnan(m[0, 2]) and m[2, 2] == 1
    assert np.isnan(S.correlation_matrix(df.where("a > 9"), ["a", "b"])[0, 1])


def _chi_merge_by_hand(pairs, threshold, max_bins):
    bins = [[x, x, sum(y for v, y in pairs if v == x), sum(1 - y for v, y in pairs if v == x)] for x in sorted({v for v, _ in pairs})]
    while len(bins) > 1:
        chis = [S._chi_of_neighbours(*map(float, (a[2], a[3], b[2], b[3]))) for a, b in zip(bins, bins[1:])]
        k = min(range(len(chis)), key=lambda i: chis[i])
        if chis[k] >= threshold and len(bins) <= max_bins:
            break
        bins[k : k + 2] = [[bins[k][0], bins[k + 1][1], bins[k][2] + bins[k + 1][2], bins[k][3] + bins[k + 1][3]]]
    return [tuple(b) for b in bins]


def test_chi_merge_matches_merging_by_hand(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), int(rng.random() < (0.8 if 10 < a < 25 else 0.3))) for a, b in zip(rng.integers(0, 40, 600), rng.normal(size=600))]
    df = spark.createDataFrame([*rows, (None, 1.0, 1), (3.0, float("nan"), 0), (4.0, 1.0, None)], "a double, b double, y int").repartition(5)
    sound = [*rows, (None, 1.0, 1), (3.0, None, 0)]
    for threshold, max_bins in ((3.84, 64), (0.5, 5), (9.0, 1)):
        got = {}
        for r in S.chi_merge(df, ["a", "b"], "y", threshold, max_bins).orderBy("feature", "bin").collect():
            got.setdefault(r.feature, []).append((r.low, r.high, r.n_pos, r.n_neg))
        for j, f in enumerate("ab"):
            assert got[f] == _chi_merge_by_hand([(r[j], r[2]) for r in sound if r[j] is not None], threshold, max_bins)
    bins = S.chi_merge(df, ["a"], "y").cache()
    n = {r["a_bin"]: r["count"] for r in S.apply_bins(df.where("y is not null"), bins, ["a"]).groupBy("a_bin").count().collect()}
    assert n == {**{r.bin: r.n_pos + r.n_neg for r in bins.collect()}, None: 1}


def test_chi_merge_starts_from_ranges_where_values_are_many(spark):
    df = spark.range(5000).selectExpr("cast(id as double) as x", "cast(id >= 2000 and id < 3500 as int) as y")
    got = S.chi_merge(df, ["x"], "y", start=100).orderBy("bin").collect()
    assert len(got) == 3 and abs(got[0].high - 2000) <= 50 and abs(got[1].high - 3500) <= 50
    assert sum(r.n_pos + r.n_neg for r in got) == 5000
    assert S.chi_merge(df.where("x < 0"), ["x"], "y").count() == 0
