"""Time split, redemption label, running totals and the no-look-ahead property."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cupola.operators import timeline as TL
from cupola.operators.prefix import running_totals
from tests.conftest import SF01


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF01}/events.parquet")


def test_time_split_half_open(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 14, 23, 59),), (dt.datetime(2024, 1, 15),),
                                (dt.datetime(2024, 1, 23),), (None,)], "ts timestamp_ntz")
    got = [r.split for r in TL.time_split(df, "ts", ["2024-01-15", "2024-01-23"]).collect()]
    assert got == ["train", "valid", "test", None]


def _brute_label(clicks: pd.DataFrame, purchases: pd.DataFrame, horizon: pd.Timedelta) -> dict:
    by_user = purchases.groupby("user_id")["ts"].apply(list).to_dict()
    out = {}
    for r in clicks.itertuples():
        ps = by_user.get(r.user_id, [])
        out[r.event_id] = int(any(r.ts <= p <= r.ts + horizon for p in ps))
    return out


@pytest.mark.parametrize("seconds", [3600, 86400, 3 * 86400])
def test_redemption_label_matches_brute_force(events, seconds):
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    purchases = events.where("event_type = 'purchase'").select("user_id", "ts")
    got = {r.event_id: r.label for r in TL.redemption_label(clicks, purchases, ["user_id"], "ts", seconds).collect()}
    want = _brute_label(clicks.toPandas(), purchases.toPandas(), pd.Timedelta(seconds=seconds))
    assert got == want


def test_redemption_label_boundaries(spark):
    t0 = dt.datetime(2024, 1, 1, 12)
    clicks = spark.createDataFrame([(1, 7, t0), (2, 7, t0 + dt.timedelta(hours=5)), (3, 8, t0)],
                                   "event_id long, user_id long, ts timestamp_ntz")
    purchases = spark.createDataFrame([(7, t0 + dt.timedelta(hours=1)), (8, t0 - dt.timedelta(seconds=1))],
                                      "user_id long, ts timestamp_ntz")
    got = {r.event_id: r.label for r in TL.redemption_label(clicks, purchases, ["user_id"], "ts", 3600).collect()}
    # exactly at issue + horizon counts; a purchase before the issue does not
    assert got == {1: 1, 2: 0, 3: 0}


def test_running_totals_equal_plain_window_with_hot_key(spark):
    rnd = random.Random(5)
    rows = [(i, 0 if rnd.random() < 0.4 else rnd.randint(1, 20), rnd.randint(0, 50), rnd.randint(1, 9))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k int, t int, v int")
    got = running_totals(df, ["k"], [F.col("t"), F.col("id")], F.floor(F.col("t") / 7),
                         {"s": F.col("v")}, inclusive=False)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert got.select("id", "s").exceptAll(want.select("id", "s")).count() == 0
    assert got.count() == 3000


def test_entity_features_ignore_rows_after_history_end(spark, events):
    end = "2024-01-20"
    base = TL.entity_features(events, ["user_id"], "ts", end, category_col="event_type",
                              categories=["click", "purchase"], amount_cols=["value"])
    future = events.where(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")) \
        .withColumn("value", F.col("value") * 1000).withColumn("event_id", F.col("event_id") + 10**9)
    noisy = TL.entity_features(events.unionByName(future), ["user_id"], "ts", end, category_col="event_type",
                               categories=["click", "purchase"], amount_cols=["value"])
    assert base.exceptAll(noisy).count() == 0 and noisy.exceptAll(base).count() == 0


def test_prior_features_strictly_before(spark, events):
    out = TL.prior_features(events, ["user_id"], "ts", "event_id", {"n": F.lit(1)})
    first = out.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    assert first.where("r = 1 and prior_n <> 0").count() == 0
    assert first.where("prior_n <> r - 1").count() == 0


def test_redemption_label_hot_user(spark):
    """One user holds a third of all rows: still exact, and split over time buckets."""
    rnd = random.Random(21)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(6000):
        user = 0 if i % 3 == 0 else rnd.randint(1, 200)
        kind = "click" if rnd.random() < 0.5 else "purchase"
        rows.append((i, user, kind, t0 + dt.timedelta(seconds=rnd.randint(0, 20 * 86400))))
    ev = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz")
    clicks = ev.where("event_type = 'click'").select("event_id", "user_id", "ts")
    purchases = ev.where("event_type = 'purchase'").select("user_id", "ts")
    got = {r.event_id: r.label for r in TL.redemption_label(clicks, purchases, ["user_id"], "ts", 7200).collect()}
    want = _brute_label(clicks.toPandas(), purchases.toPandas(), pd.Timedelta(seconds=7200))
    assert got == want


def test_prior_features_hot_user_day_is_sliced_and_exact(spark):
    """A third of all rows is one user on one day (with repeated timestamps): the day
    is cut into time slices, and the running counts equal a plain window's."""
    from cupola.operators.prefix import with_hot_split

    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 3)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append((i, 0, "purchase" if i % 2 else "click", t0 + dt.timedelta(seconds=rnd.randint(0, 3000))))
        else:
            rows.append((i, rnd.randint(1, 50), "click", t0 + dt.timedelta(days=rnd.randint(-3, 3),
                                                                             seconds=rnd.randint(0, 86399))))
    ev = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz")
    counts = {"n": F.lit(1), "buys": (F.col("event_type") == "purchase").cast("int")}
    got = TL.prior_features(ev, ["user_id"], "ts", "event_id", counts, max_bucket_rows=50)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = ev.select("event_id", F.coalesce(F.count(F.lit(1)).over(w), F.lit(0)).alias("prior_n"),
                     F.coalesce(F.sum((F.col("event_type") == "purchase").cast("int")).over(w), F.lit(0))
                     .alias("prior_buys"))
    got = got.select("event_id", "prior_n", "prior_buys")
    assert got.count() == 3000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    day = F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                   F.col("ts")) / F.lit(86_400_000_000))
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    sliced = with_hot_split(ev, ["user_id"], day, us, 50, col="b")
    per_slice = sliced.where("user_id = 0").groupBy("b").count()
    assert per_slice.count() >= 10


def test_hot_split_shuffle_join_path_gives_same_buckets(spark):
    """Over the broadcast bound the hot groups are joined by a shuffle: same buckets."""
    from cupola.operators.prefix import with_hot_split

    rows = [(i, i % 2, i * 1000) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k long, p long")
    day = F.lit(0)
    a = with_hot_split(df, ["k"], day, F.col("p"), 20, broadcast_rows=100).select("id", "_bucket")
    b = with_hot_split(df, ["k"], day, F.col("p"), 20, broadcast_rows=0).select("id", "_bucket")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    sizes = [r["count"] for r in a.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2 * 20


def test_coupon_features_one_scan_equals_per_kind(spark):
    """Several kinds from one grouping-sets scan give what one aggregate per kind gives,
    NULL keys included."""
    rnd = random.Random(17)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.choice([None, 1, 2, 3]), rnd.randint(1, 4), rnd.randint(0, 1), rnd.choice([None, 10.0, 25.5]),
             t0 + dt.timedelta(hours=rnd.randint(0, 24 * 20))) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, user_id long, merchant_id long, label int, min_spend double, "
                                     "ts timestamp_ntz")
    kinds = {"user": ["user_id"], "merchant": ["merchant_id"], "pair": ["user_id", "merchant_id"]}
    distinct = {"merchant": ["user_id"]}
    together = TL.coupon_features(df, kinds, "ts", "2024-01-15", distinct_cols=distinct)
    for kind, keys in kinds.items():
        alone = TL.entity_features(df, keys, "ts", "2024-01-15", amount_cols=["min_spend"],
                                   distinct_cols=distinct.get(kind, ()), flag_cols=["label"], prefix=f"{kind}_")
        got = together[kind]
        assert sorted(got.columns) == sorted(alone.columns), kind
        assert got.exceptAll(alone.select(*got.columns)).count() == 0, kind
        assert alone.select(*got.columns).exceptAll(got).count() == 0, kind


def test_feature_family_reads_the_coupons_once(spark):
    import __spark_entry__ as E
    from tests.conftest import SF001

    plan = E.queries()["coupon_feature_family"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and "Expand" in plan


def test_one_user_one_timestamp_is_cut_by_id_and_exact(spark):
    from cupola.operators.prefix import with_tie_split

    df = spark.range(2000).selectExpr("id as event_id", "1L as user_id", "if(id % 2 = 0, timestamp_ntz'2024-01-05 00:00:00', timestamp_ntz'2024-01-06 00:00:00') as ts", "id % 3 as v")
    got = TL.prior_features(df, ["user_id"], "ts", "event_id", {"v": F.col("v")}, max_bucket_rows=100)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("prior_v", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert got.select("event_id", "prior_v").exceptAll(want.select("event_id", "prior_v")).count() == 0
    cut = with_tie_split(df.withColumn("b", F.dayofmonth("ts")), ["user_id"], "b", F.unix_micros(F.col("ts").cast("timestamp")), "event_id", 100)
    assert cut.groupBy("b", "_tie").count().agg(F.max("count")).first()[0] <= 110


def test_sliding_features_match_brute_force(spark):
    rnd = random.Random(21)
    rows = [("hot" if rnd.random() < 0.35 else f"k{rnd.randint(0, 9)}", rnd.randint(0, 120), rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 5, -2, 7]))
            for _ in range(900)]
    rows += [(None, 3, 1, 1), ("k0", None, 1, 1)]
    day0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, None if d is None else day0 + dt.timedelta(days=d, hours=rnd.randint(0, 23)), c, a) for k, d, c, a in rows],
                               "k string, ts timestamp_ntz, c int, a int")
    for bucket_days in (32, 5):
        got = TL.sliding_features(df, ["k"], "ts", (3, 30), {"amount": F.col("a")}, ["c"], bucket_days=bucket_days).collect()
        keys = {(k, d) for k, d, _, _ in rows if k is not None and d is not None}
        assert len(got) == len(keys)
        for r in got:
            d = (dt.datetime.combine(r["day"], dt.time()) - day0).days
            assert (r["k"], d) in keys
            for w in (3, 30):
                inside = [(c, a) for k, x, c, a in rows if k == r["k"] and x is not None and d - w <= x < d]
                assert r[f"n_{w}d"] == len(inside) and r[f"amount_{w}d"] == sum(a or 0 for _, a in inside)
                assert r[f"n_distinct_c_{w}d"] == len({c for c, _ in inside} - {None})
    plan = TL.sliding_features(df, ["k"], "ts", (7,), {}, ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_rolling_folds_repeat_rows_per_fold_without_overlap(spark, events):
    origins = ["2024-01-10", "2024-01-14", "2024-01-18"]
    got = TL.rolling_folds(events, "ts", origins, 6, 3, gap_days=1).toPandas()
    for i, o in enumerate(pd.Timestamp(x) for x in origins):
        f = got[got.fold == i]
        past, ahead = f[f.part == "history"], f[f.part == "target"]
        assert past.ts.min() >= o - pd.Timedelta(days=7) and past.ts.max() < o - pd.Timedelta(days=1)
        assert ahead.ts.min() >= o and ahead.ts.max() < o + pd.Timedelta(days=3) and set(f.origin) == {o}
        want = events.where(f"ts >= timestamp_ntz '{o - pd.Timedelta(days=7)}' and ts < timestamp_ntz '{o - pd.Timedelta(days=1)}'").count()
        assert len(past) == want
    plan = TL.rolling_folds(events, "ts", origins, 6, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    with pytest.raises(ValueError):
        TL.rolling_folds(events, "ts", origins, 0, 3)


def test_sliding_features_write_no_more_rows_than_they_read(spark, monkeypatch):
    """days that lie far apart, where every day used to become seven changes."""
    written, plain = [], TL.materialise

    def counted(df):
        out = plain(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(TL, "materialise", counted)
    df = spark.range(400).select((F.col("id") % 7).alias("k"), F.col("id").alias("c"),
                                 F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 3).cast("int")).alias("ts"))
    got = TL.sliding_features(df, ["k"], "ts", (7, 30), {"one": F.lit(1)}, ["c"]).collect()
    assert len(got) == 400 and sum(written) <= 400
    # every seventh row is of one key, 21 days after the last
    assert {(r.n_7d, r.n_30d, r.one_30d, r.n_distinct_c_30d) for r in got} == {(0, 0, 0, 0), (0, 1, 1, 1)}


def test_coupon_features_compute_what_is_asked(spark):
    """F8: the features that a caller names are those of the whole family, and only they are written."""
    df = spark.createDataFrame([(i % 5, i % 3, f"2024-01-{1 + i % 20:02d}", i % 2, float(i % 7)) for i in range(200)],
                               "u long, m long, day string, label int, min_spend double").withColumn("day", F.to_timestamp_ntz("day"))
    kinds = {"u": ["u"], "um": ["u", "m"]}
    whole = TL.coupon_features(df, kinds, "day", "2024-01-15")
    some = TL.coupon_features(df, kinds, "day", "2024-01-15", features=("n_events", "label_rate"))
    for kind, keys in kinds.items():
        names = [*keys, f"{kind}_n_events", f"{kind}_label_rate"]
        assert some[kind].columns == names
        assert sorted(map(tuple, some[kind].collect())) == sorted(map(tuple, whole[kind].select(*names).collect()))
