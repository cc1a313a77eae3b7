"""Edge tables for the coupon parsers (FIXTURES.md F1, F2)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from cupola.operators.normalise import normalise_coupons

F1 = [
    ("200:20", 0.9, 200.0),
    ("0.9", 0.9, 0.0),
    ("1", 1.0, 1.0),
    ("10.5:1", 0.9047619047619048, 10.5),
    ("5:10", -1.0, 5.0),
    ("-5:1", 1.2, -5.0),
    (" 30 : 5 ", 0.8333333333333334, 30.0),
    ("1e-05", 1e-05, 1e-05),
    ("200:", None, 200.0),
    ("0:5", None, 0.0),
    ("a.b", None, 0.0),
    ("a:b:c", None, None),
    ("null", None, None),
    ("fixed", None, None),
    ("", None, None),
    (None, None, None),
    ("nan", None, None),
    ("inf", None, None),
    ("1_0", None, None),
    ("20f", None, None),
    ("20d", None, None),
]

F2 = [
    ("2016-01-15", 20160115),
    ("20160115", 20160115),
    (" 20160115 ", 20160115),
    ("2016-1-5", 201615),
    ("-1234", -123),
    ("1-2", None),
    ("x-", None),
    ("2016-01-15 10:00", None),
    ("2016/01/15", None),
    ("20160115.0", None),
    ("nan", None),
    (None, None),
]


def test_discount_and_min_spend(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(F1)], "i int, rate_raw string")
    got = {r.i: (r.discount_rate, r.min_spend) for r in normalise_coupons(df, date_col=None).collect()}
    for i, (raw, rate, spend) in enumerate(F1):
        assert got[i] == (rate, spend), raw


def test_date_int(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(F2)], "i int, date_raw string")
    got = {r.i: r.date_int for r in normalise_coupons(df, rate_col=None).collect()}
    for i, (raw, want) in enumerate(F2):
        assert got[i] == want, raw


def test_bad_value_counts_are_observed(spark):
    # Own session: once a session has used an Observation, Spark 4.1 cannot serialise
    # closures that capture that session (MLlib transforms do), see normalise_coupons.
    spark = spark.newSession()
    df = spark.createDataFrame([(r,) for r, _, _ in F1], "rate_raw string")
    obs = Observation("bad")
    normalise_coupons(df, date_col=None, observation=obs).count()
    m = obs.get
    # unparsable but present: 200:, 0:5, a.b, a:b:c, fixed, inf, 1_0, 20f, 20d
    assert m["bad_discount_rate"] == 9
    # a:b:c, fixed, inf, 1_0, 20f, 20d
    assert m["bad_min_spend"] == 6


@pytest.mark.parametrize("raw", ["200:", "0:5", "a:b:c", "fixed", "20f"])
def test_fail_mode_raises(spark, raw):
    df = spark.createDataFrame([(raw,)], "rate_raw string")
    with pytest.raises(PySparkException):
        normalise_coupons(df, date_col=None, on_error="fail").collect()


@pytest.mark.parametrize("raw", ["", "null", "nan", None])
def test_fail_mode_keeps_missing_as_null(spark, raw):
    df = spark.createDataFrame([(raw,)], "rate_raw string")
    r = normalise_coupons(df, date_col=None, on_error="fail").first()
    assert r.discount_rate is None and r.min_spend is None


def test_plan_is_one_projection(spark):
    df = spark.createDataFrame([("200:20", "2016-01-15")], "rate_raw string, date_raw string")
    plan = normalise_coupons(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_last_colon_split_matches_python(spark):
    """Head and tail around the last colon, as Python's rfind gives them, on random text
    with colons, newlines and characters outside ASCII."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
    from pyspark.sql import functions as F

    from cupola.functions.parse import _head, _tail

    texts = []

    @settings(max_examples=300, database=None, suppress_health_check=list(HealthCheck))
    @given(st.text(alphabet=st.sampled_from(list("ab1.: \né中")), max_size=12))
    def collect(t):
        texts.append(t)

    collect()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: (r.h, r.t) for r in df.select("i", _head(F.col("s")).alias("h"), _tail(F.col("s")).alias("t")).collect()}
    for i, t in enumerate(texts):
        k = t.rfind(":")
        want = (t[:k], t[k + 1:]) if k >= 0 else ("", t)
        assert got[i] == want, repr(t)
