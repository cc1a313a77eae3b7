"""Quasi-constant filter (FIXTURES.md F3), missing values, duplicates, outliers."""

import math

import pytest

from cupola.operators import quality as Q


@pytest.fixture(scope="module")
def f3(spark):
    rows = []
    for i in range(100):
        rows.append((
            1 if i < 96 else 2,
            1 if i < 95 else 2,
            1.0 if i < 3 else float("nan"),
            None,
            0.0 if i < 50 else -0.0,
            i + 1,
        ))
    return spark.createDataFrame(rows, "c1 int, c2 int, c3 double, c4 string, c5 double, c6 int")


WANT = {"c1": (0.96, True), "c2": (0.95, False), "c3": (1.0, True), "c4": (None, False),
        "c5": (1.0, True), "c6": (0.01, False)}


@pytest.mark.parametrize("method", ["exact", "sketch"])
def test_quasi_constant_report(spark, f3, method):
    rep = {r.feature: (r.ratio, r.flagged) for r in Q.quasi_constant_report(f3, None, 0.95, method).collect()}
    for c, (ratio, flagged) in WANT.items():
        got_ratio, got_flag = rep[c]
        assert got_flag == flagged, c
        if method == "exact" or (ratio is not None and ratio > 0.5):
            assert (got_ratio is None and ratio is None) or math.isclose(got_ratio, ratio), c


def test_quasi_constant_filter_drops(f3):
    pruned, _ = Q.quasi_constant_filter(f3, threshold=0.95)
    assert pruned.columns == ["c2", "c4", "c6"]
    kept, _ = Q.quasi_constant_filter(f3, threshold=0.95, report_only=True)
    assert kept.columns == f3.columns


def test_quasi_constant_wide_table_chunks(spark):
    cols = [f"x{i}" for i in range(60)]
    df = spark.range(50).selectExpr(*[f"cast(id % {i + 1} as int) as x{i}" for i in range(60)])
    rep = {r.feature: r.ratio for r in Q.quasi_constant_report(df, cols).collect()}
    assert rep["x0"] == 1.0 and math.isclose(rep["x1"], 0.5) and len(rep) == 60


def test_missing_fill_and_indicator(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (3.0, "a"), (float("nan"), "b")], "v double, s string")
    rep = {r.feature: r.n_missing for r in Q.missing_report(df).collect()}
    assert rep == {"v": 2, "s": 1}
    out = Q.fill_missing(df, {"v": "mean", "s": "mode"}, add_indicator=True).collect()
    assert [r.v for r in out] == [1.0, 2.0, 3.0, 2.0]
    assert [r.s for r in out] == ["a", "a", "a", "b"]
    assert [r.v_missing for r in out] == [0, 1, 0, 1]


def test_dedup_keyed_picks_first_by_order(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, 1, "z"), (1, 3, "w")], "k int, t int, v string")
    out = {r.k: r.v for r in Q.dedup_keyed(df, ["k"], ["t", "v"]).collect()}
    assert out == {1: "w", 2: "z"}


def test_dedup_keyed_prunes_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id as t")
    plan = Q.dedup_keyed(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "v double")
    b = Q.outlier_bounds(df, ["v"], exact=True)
    lo, hi = b["v"]
    assert hi < 100
    assert Q.outlier_drop(df, b).count() == 8
    assert max(r.v for r in Q.outlier_clip(df, b).collect()) == hi


def test_quasi_constant_messages(f3):
    report = Q.quasi_constant_report(f3, None, 0.95)
    lines = sorted(r.message for r in Q.quasi_constant_messages(report).collect())
    assert lines == ["dropped feature c1: most frequent value holds 0.9600 of non-missing values",
                     "dropped feature c3: most frequent value holds 1.0000 of non-missing values",
                     "dropped feature c5: most frequent value holds 1.0000 of non-missing values"]


def test_outliers_leave_missing_values_alone(spark):
    rows = [(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "v double")
    b = Q.outlier_bounds(df, ["v"], exact=True)
    lo, hi = b["v"]
    clipped = [r.v for r in Q.outlier_clip(df, b).collect()]
    assert clipped.count(None) == 1 and sum(1 for v in clipped if v is not None and math.isnan(v)) == 1
    assert max(v for v in clipped if v is not None and not math.isnan(v)) == hi
    flags = [r.v_outlier for r in Q.outlier_flag(df, b).collect()]
    assert sum(flags) == 1  # only 100
    assert Q.outlier_drop(df, b).count() == 10


def test_sketch_falls_back_to_exact_counts_on_hash_collisions(spark, f3, monkeypatch):
    """With every value hashing alike, each column with two or more distinct values
    collides and is counted by grouping: the report equals the exact one."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(Q.F, "xxhash64", lambda *cols: F.lit(7).cast("long"))
    sketch = {r.feature: (r.top_count, r.non_missing, r.flagged)
              for r in Q.quasi_constant_report(f3, None, 0.95, method="sketch").collect()}
    monkeypatch.undo()
    exact = {r.feature: (r.top_count, r.non_missing, r.flagged)
             for r in Q.quasi_constant_report(f3, None, 0.95, method="exact").collect()}
    assert sketch == exact


@pytest.mark.parametrize("threshold", [0.02, 0.15, 0.4, 0.8])
def test_summary_flags_like_the_exact_counts_at_any_threshold(spark, threshold):
    """Skewed, flat and unique columns in many partitions, with more values than counters."""
    df = spark.range(20_000).repartition(13).selectExpr(
        "id as u", "cast(pow(20000, rand(1)) as int) as skewed", "cast(if(rand(2) < 0.42, -1, id) as long) as one_heavy",
        "cast(rand(3) * 5 as int) as five", "if(rand(4) < 0.17, 'x', cast(id as string)) as s", "if(rand(5) < 0.5, double('nan'), if(rand(6) < 0.5, 0.0D, -0.0D)) as z",
        "array(cast(rand(7) * 3 as int)) as a", "cast(null as string) as none")
    df = df.cache()
    cols = df.columns
    exact = {r.feature: r for r in Q.quasi_constant_report(df, cols, threshold).collect()}
    for r in Q.quasi_constant_report(df, cols, threshold, method="sketch").collect():
        e = exact[r.feature]
        assert (r.flagged, r.non_missing) == (e.flagged, e.non_missing), r.feature
        if e.flagged:
            assert r.top_count == e.top_count
    df.unpersist()


def test_summary_refuses_thresholds_that_need_too_many_counters(f3):
    with pytest.raises(ValueError):
        Q.quasi_constant_report(f3, None, 0.0001, method="sketch")
