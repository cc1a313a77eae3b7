"""First-in first-out matching against a play-by-play of each key."""

import datetime as dt
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from cupola.operators import matching as MT

T0 = dt.datetime(2024, 1, 1)
ISSUES = "id long, user string, ts timestamp_ntz, label string"
REDEEMS = "id long, user string, ts timestamp_ntz"


def _at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def _brute(issues, redeems, horizon):
    used = {}
    for user in {u for _, u, _ in issues if u is not None}:
        events = [(t, 0, i) for i, u, t in issues if u == user and t is not None]
        events += [(t, 1, i) for i, u, t in redeems if u == user and t is not None]
        queue = deque()
        for t, kind, i in sorted(events):
            if kind == 0:
                queue.append((t, i))
                continue
            while queue and queue[0][0] + horizon < t:
                queue.popleft()
            if queue:
                used[queue.popleft()[1]] = i
    return {i: used.get(i) for i, _, _ in issues}


def _check(spark, issues, redeems, horizon):
    a = spark.createDataFrame([(i, u, _at(t), "kept") for i, u, t in issues], ISSUES)
    b = spark.createDataFrame([(i, u, _at(t)) for i, u, t in redeems], REDEEMS)
    got = MT.redemption_match(a, b, ["user"], "ts", horizon, "id", label_col="hit").collect()
    assert len(got) == len(issues) and {r["label"] for r in got} <= {"kept"}
    want = _brute(issues, redeems, horizon)
    assert {r["id"]: r["redeem_id"] for r in got} == want
    when = {i: _at(t) for i, _, t in redeems}
    for r in got:
        assert r["hit"] == (r["redeem_id"] is not None) and r["redeem_ts"] == when.get(r["redeem_id"])


@pytest.mark.parametrize("horizon,partitions", [(50, 8), (400, 23), (5, 3)])
def test_against_play_by_play_with_a_key_of_a_third_of_the_rows(spark, horizon, partitions):
    rnd = random.Random(horizon)
    user = lambda: "hot" if rnd.random() < 0.35 else f"u{rnd.randint(0, 30)}"
    issues = [(i, user(), rnd.randint(0, 2000)) for i in range(900)]
    redeems = [(10_000 + i, user(), rnd.randint(0, 2400)) for i in range(700)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        _check(spark, issues, redeems, horizon)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)


def test_ends_ties_and_missing(spark):
    issues = [(1, "a", 0), (2, "a", 0), (3, "a", 10), (4, None, 0), (5, "b", None), (6, "c", 0), (7, "d", 5)]
    redeems = [(11, "a", 10), (12, "a", 10), (13, "a", 20), (14, "a", 20), (15, None, 1), (16, "c", 11), (17, "d", 4), (18, "e", 1), (19, "b", 1)]
    _check(spark, issues, redeems, 10)
    _check(spark, issues, [], 10)
    a = spark.createDataFrame([], ISSUES)
    assert MT.redemption_match(a, spark.createDataFrame([(1, "a", T0)], REDEEMS), ["user"], "ts", 10, "id").count() == 0
    with pytest.raises(ValueError):
        MT.redemption_match(a, a, ["user"], "ts", 0, "id")


def test_clamps_compose():
    rnd = random.Random(3)
    for _ in range(200):
        run = [(rnd.choice([MT.ISSUE, MT.REDEEM, MT.EXPIRY]), 0) for _ in range(rnd.randint(0, 12))]
        issued, expired = rnd.randint(0, 6), rnd.randint(0, 3)
        a, b, c = MT._clamp(iter(run), issued, expired)
        for x in range(expired, issued + 1):
            y, i, e = x, issued, expired
            for kind, _ in run:
                i, e = i + (kind == MT.ISSUE), e + (kind == MT.EXPIRY)
                y = max(y, e) if kind == MT.EXPIRY else min(y + 1, i) if kind == MT.REDEEM else y
            assert min(c, max(b, x + a)) == y


def test_no_window_over_a_whole_key(spark):
    """A key with every row is played in as many ranges as there are shuffle partitions."""
    n = 4000
    issues = spark.range(n).select("id", F.lit("one").alias("user"), F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit(T0).cast("timestamp_ntz")).alias("ts"))
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = MT.redemption_match(issues, issues.where("id % 2 = 0"), ["user"], "ts", 3600, "id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert sum(r["label"] for r in out) == n // 2
    assert {r["id"]: r["redeem_id"] for r in out if r["label"]} == {i: 2 * i for i in range(n // 2)}
