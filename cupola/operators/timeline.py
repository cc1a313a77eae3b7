"""Time-aware operators: split by time, redemption label, behaviour features.

Features only ever look at rows strictly before their history end, so a model
trained on them never sees the period it is asked to predict.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupola.operators.prefix import running_totals, with_hot_split, with_tie_split
from cupola.session import materialise


def _lit_ts(v) -> Column:
    """Wall-clock timestamp literal (TIMESTAMP_NTZ), independent of any time zone."""
    if isinstance(v, str):
        v = dt.datetime.fromisoformat(v)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        v = dt.datetime(v.year, v.month, v.day)
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def _micros(ts: Column) -> Column:
    # microseconds since 1970-01-01 on the wall clock
    return F.timestamp_diff("MICROSECOND", _lit_ts("1970-01-01"), ts)


def _seconds(horizon) -> int:
    if isinstance(horizon, dt.timedelta):
        return int(horizon.total_seconds())
    return int(horizon)


# ---------------------------------------------------------------------------------------
# B2: split by time
# ---------------------------------------------------------------------------------------

def time_split(df: DataFrame, ts_col: str, cuts: Sequence, names: Sequence[str] = ("train", "valid", "test"),
               col: str = "split") -> DataFrame:
    """Label each row with the half-open period ``[cut_i, cut_i+1)`` it falls in.

    ``len(names) == len(cuts) + 1``. To read one period only, use ``split_filter``: its
    comparisons reach the scan, a filter on the ``split`` column does not.
    """
    if len(names) != len(cuts) + 1:
        raise ValueError("need one name per period: len(cuts) + 1")
    ts = F.col(ts_col)
    expr = F.when(ts.isNull(), F.lit(None))
    for cut, name in zip(cuts, names):
        expr = expr.when(ts < _lit_ts(cut), F.lit(name))
    return df.withColumn(col, expr.otherwise(F.lit(names[-1])))


def split_filter(df: DataFrame, ts_col: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= ts < end`` (either bound optional), as a pushed-down filter."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts_col) >= _lit_ts(start))
    if end is not None:
        cond = cond & (F.col(ts_col) < _lit_ts(end))
    return df.where(cond)


def rolling_folds(df: DataFrame, ts_col: str, origins: Sequence, history_days: int, horizon_days: int, gap_days: int = 0) -> DataFrame:
    """Rolling-origin evaluation: ``df`` with ``fold`` (its number, from 0), ``origin`` and ``part``, a
    row once for each fold that it belongs to.

    At an origin o, ``history`` is ``[o - gap - history_days, o - gap)`` and ``target`` is ``[o, o + horizon_days)``.
    One scan serves all folds: the fold is a column to group by. A row is repeated
    at most once per origin whose window holds it, and rows of no fold are not kept.
    """
    if history_days <= 0 or horizon_days <= 0 or gap_days < 0:
        raise ValueError("history and horizon must be positive, the gap not negative")
    ts, day = F.col(ts_col), lambda o, n: _lit_ts(o) + F.expr(f"interval {n} days")
    folds = []
    for i, o in enumerate(origins):
        past = (ts >= day(o, -gap_days - history_days)) & (ts < day(o, -gap_days))
        ahead = (ts >= _lit_ts(o)) & (ts < day(o, horizon_days))
        folds.append(F.when(past | ahead, F.struct(F.lit(i).alias("fold"), _lit_ts(o).alias("origin"), F.when(past, F.lit("history")).otherwise(F.lit("target")).alias("part"))))
    return df.select("*", F.inline(F.filter(F.array(*folds), lambda f: f.isNotNull())))


# ---------------------------------------------------------------------------------------
# Redemption label
# ---------------------------------------------------------------------------------------

def redemption_label(
    issues: DataFrame,
    redeems: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    horizon,
    label_col: str = "label",
    redeem_ts_col: str | None = None,
) -> DataFrame:
    """``label = 1`` when some redeem row with the same keys has ``ts`` in
    ``[issue_ts, issue_ts + horizon]`` (horizon in seconds or a ``timedelta``).

    No range join and no window per key: time is cut into buckets one horizon
    wide, so a qualifying redeem lies in the issue's bucket (at or after the
    issue) or in the next one (no later than issue + horizon). Redeems are
    reduced to one row per (keys, bucket) holding the latest redeem of the
    bucket and the earliest of the next, by a partial aggregate; the issues join
    that on (keys, bucket). A key with a third of all rows is split over its
    buckets, and the join side it meets has one row per bucket.
    """
    h_us = _seconds(horizon) * 1_000_000
    if h_us <= 0:
        raise ValueError("horizon must be positive")
    rts = F.col(redeem_ts_col or ts_col)
    r = redeems.select(*keys, _micros(rts).alias("_t")).where(F.col("_t").isNotNull())
    r = r.withColumn("_b", F.floor(F.col("_t") / F.lit(h_us)))
    # each redeem is 'latest of its own bucket' and 'earliest of the previous bucket's next'
    spread = r.select(*keys, F.inline(F.array(
        F.struct(F.col("_b").alias("_bucket"), F.col("_t").alias("_cur"), F.lit(None).cast("long").alias("_nxt")),
        F.struct((F.col("_b") - 1).alias("_bucket"), F.lit(None).cast("long").alias("_cur"), F.col("_t").alias("_nxt")),
    )))
    marks = spread.groupBy(*keys, "_bucket").agg(F.max("_cur").alias("_last_cur"), F.min("_nxt").alias("_first_nxt"))
    t = _micros(F.col(ts_col))
    i = issues.withColumn("_t", t).withColumn("_bucket", F.floor(F.col("_t") / F.lit(h_us)))
    hit = (F.col("_last_cur") >= F.col("_t")) | (F.col("_first_nxt") <= F.col("_t") + F.lit(h_us))
    return (
        i.join(marks, [*keys, "_bucket"], "left")
        .withColumn(label_col, F.coalesce(hit, F.lit(False)).cast("int"))
        .drop("_t", "_bucket", "_last_cur", "_first_nxt")
    )


# ---------------------------------------------------------------------------------------
# Behaviour features
# ---------------------------------------------------------------------------------------

def _entity_aggs(ts_col: str, category_col: str | None, categories: Sequence[str], amount_cols: Sequence[str],
                 amount_scale: int, distinct_cols: Sequence[str], flag_cols: Sequence[str]) -> list[Column]:
    n = F.count(F.lit(1))
    aggs = [n.alias("n_events")]
    for c in categories:
        aggs.append(F.count_if(F.col(category_col) == F.lit(c)).alias(f"n_{c}"))
    for f in flag_cols:
        aggs.append(F.sum(F.col(f).cast("bigint")).alias(f"n_{f}"))
    aggs.append(F.count_distinct(F.to_date(F.col(ts_col))).alias("n_active_days"))
    for a in amount_cols:
        units = F.round(F.col(a) * F.lit(amount_scale)).cast("bigint")
        aggs += [F.sum(units).alias(f"{a}_units"), F.count(F.col(a)).alias(f"_{a}_n"),
                 F.min(a).alias(f"{a}_min"), F.max(a).alias(f"{a}_max")]
    for d in distinct_cols:
        aggs.append(F.count_distinct(F.col(d)).alias(f"n_distinct_{d}"))
    aggs.append(F.max(ts_col).alias("last_ts"))
    return aggs


def _entity_derive(out: DataFrame, history_end, categories: Sequence[str], flag_cols: Sequence[str],
                   amount_cols: Sequence[str], amount_scale: int) -> DataFrame:
    derived = {}
    for c in [*categories, *flag_cols]:
        derived[f"{c}_rate"] = F.col(f"n_{c}") / F.col("n_events")
    for a in amount_cols:
        derived[f"{a}_avg"] = F.try_divide(F.col(f"{a}_units"), F.col(f"_{a}_n")) / F.lit(amount_scale)
    derived["days_since_last"] = F.datediff(F.to_date(_lit_ts(history_end)), F.to_date(F.col("last_ts")))
    return out.withColumns(derived).drop(*[f"_{a}_n" for a in amount_cols])


def entity_features(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    history_end,
    history_start=None,
    category_col: str | None = None,
    categories: Sequence[str] = (),
    amount_cols: Sequence[str] = (),
    amount_scale: int = 100,
    distinct_cols: Sequence[str] = (),
    flag_cols: Sequence[str] = (),
    prefix: str = "",
) -> DataFrame:
    """One row per entity (``keys``) from its rows in ``[history_start, history_end)``.

    Features: ``n_events``; per category ``n_<c>`` and ``<c>_rate``; per 0/1 flag
    column ``n_<f>`` and ``<f>_rate``;
    ``n_active_days``; per amount column ``<a>_units`` (exact sum, in units of
    1/amount_scale), ``<a>_avg``, ``<a>_min``, ``<a>_max``; per distinct column
    ``n_distinct_<d>``; ``last_ts`` and ``days_since_last`` (to the history end).
    One hash aggregate with partial aggregation; distinct counts use Spark's
    two-step distinct aggregation.
    """
    hist = split_filter(df, ts_col, history_start, history_end)
    aggs = _entity_aggs(ts_col, category_col, categories, amount_cols, amount_scale, distinct_cols, flag_cols)
    out = _entity_derive(hist.groupBy(*keys).agg(*aggs), history_end, categories, flag_cols, amount_cols,
                         amount_scale)
    if prefix:
        out = out.select(*keys, *[F.col(c).alias(prefix + c) for c in out.columns if c not in keys])
    return out


def prior_features(
    df: DataFrame,
    key: Sequence[str],
    ts_col: str,
    id_col: str,
    counts: dict[str, Column],
    bucket: Column | None = None,
    max_bucket_rows: int | None = 1_000_000,
) -> DataFrame:
    """Per row, running totals over the same entity's earlier rows (strictly before,
    in ``(ts, id)`` order): ``prior_<name>`` for each name -> 0/1 or numeric column.

    Uses the two-level prefix sum with day buckets by default, so no task holds
    all rows of one entity; an (entity, day) with more than ``max_bucket_rows`` rows
    is cut further into slices of time, and one whose rows share a timestamp by ranges of an
    integer id (``with_hot_split``, ``with_tie_split``; ``None`` turns both off).
    """
    vals = {f"prior_{k}": v for k, v in counts.items()}
    if bucket is not None:
        return running_totals(df, key, [F.col(ts_col), F.col(id_col)], bucket, vals, inclusive=False)
    us = _micros(F.col(ts_col))
    day = F.floor(us / F.lit(86_400_000_000))
    if max_bucket_rows is None:
        return running_totals(df, key, [F.col(ts_col), F.col(id_col)], day, vals, inclusive=False)
    split = with_hot_split(df, key, day, us, max_bucket_rows, col="_day_slice")
    bucket = F.col("_day_slice")
    if isinstance(df.schema[id_col].dataType, T.IntegralType):
        split = with_tie_split(split, key, "_day_slice", us, id_col, max_bucket_rows)
        bucket = F.struct("_day_slice", "_tie")
    return running_totals(split, key, [F.col(ts_col), F.col(id_col)], bucket, vals,
                          inclusive=False).drop("_day_slice", "_tie")


def join_features(target: DataFrame, features: DataFrame, keys: Sequence[str], fill: dict | None = None) -> DataFrame:
    """Left-join entity features onto target rows; entities without history get ``fill``.

    No broadcast hint: the feature table grows with the number of entities, so the
    choice is left to adaptive execution, which broadcasts it only when its
    measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    out = target.join(features, list(keys), "left")
    return out.fillna(fill) if fill else out


def coupon_feature_table(coupons: DataFrame, key_sets: dict[str, Sequence[str]], ts_col: str, history_end,
                         history_start=None, label_col: str = "label", amount_cols: Sequence[str] = ("min_spend",),
                         distinct_cols: Sequence[str] = (), amount_scale: int = 100) -> DataFrame:
    """The feature family of every entity kind from one scan: one row per (kind, entity).

    ``key_sets`` maps a kind to its key columns (for example ``{"user": [...],
    "merchant": [...], "user_merchant": [...]}``). One grouping-sets aggregate over
    the history window computes the features of ``entity_features`` (coupon counts,
    redemptions and their rate, amount statistics, distinct counts, activity days,
    recency) for all kinds at once, so the coupon table is read once, not once per
    kind. Columns: ``kind``, every key column (NULL where the kind does not use it),
    then the features. A NULL key value of a kind stays a group of its own.
    """
    kinds = list(key_sets)
    sets = [tuple(key_sets[k]) for k in kinds]
    if len(set(sets)) != len(sets):
        raise ValueError("two kinds have the same key columns")
    all_keys = list(dict.fromkeys(c for keys in sets for c in keys))
    hist = split_filter(coupons, ts_col, history_start, history_end)
    aggs = _entity_aggs(ts_col, None, (), amount_cols, amount_scale, distinct_cols, (label_col,))
    table = hist.groupingSets([[F.col(c) for c in keys] for keys in sets], *all_keys) \
        .agg(*aggs, F.grouping_id().alias("_gid"))
    n = len(all_keys)
    # grouping_id has the bit of a column set when the column is rolled up (not a key of the set)
    kind = F.lit(None).cast("string")
    for name, keys in zip(kinds, sets):
        gid = sum(1 << (n - 1 - i) for i, c in enumerate(all_keys) if c not in keys)
        kind = F.when(F.col("_gid") == F.lit(gid), F.lit(name)).otherwise(kind)
    table = table.withColumn("kind", kind).drop("_gid")
    table = _entity_derive(table, history_end, (), (label_col,), amount_cols, amount_scale)
    return table.select("kind", *all_keys, *[c for c in table.columns if c not in ("kind", *all_keys)])


def coupon_features(coupons: DataFrame, key_sets: dict[str, Sequence[str]], ts_col: str, history_end,
                    history_start=None, label_col: str = "label", amount_cols: Sequence[str] = ("min_spend",),
                    distinct_cols: dict[str, Sequence[str]] | None = None, features: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The feature family per entity kind, with columns prefixed by the kind.

    One kind is one aggregate. Several kinds share one scan: the long table of
    ``coupon_feature_table`` is written once (``materialise``; it holds one row
    per entity, not per coupon) and split by kind. ``features`` names the columns that the
    caller reads (every one by default); others are neither computed nor shuffled nor written.
    """
    from cupola.session import materialise

    distinct_cols = distinct_cols or {}
    if len(key_sets) == 1:
        (kind, keys), = key_sets.items()
        one = {kind: entity_features(coupons, keys, ts_col, history_end, history_start, amount_cols=amount_cols,
                                      distinct_cols=distinct_cols.get(kind, ()), flag_cols=(label_col,),
                                      prefix=f"{kind}_")}
        return one if features is None else {kind: one[kind].select(*keys, *[f"{kind}_{c}" for c in features])}
    every_distinct = list(dict.fromkeys(d for ds in distinct_cols.values() for d in ds))
    table = coupon_feature_table(coupons, key_sets, ts_col, history_end, history_start, label_col, amount_cols, every_distinct)
    if features is not None:
        named = list(dict.fromkeys(c for ks in key_sets.values() for c in ks))
        table = table.select("kind", *named, *features)
    table = materialise(table)
    all_keys = [c for c in table.columns[1:] if any(c in ks for ks in key_sets.values())]
    out = {}
    for kind, keys in key_sets.items():
        unused = [f"n_distinct_{d}" for d in every_distinct if d not in distinct_cols.get(kind, ())]
        feats = [c for c in table.columns if c not in ("kind", *all_keys, *unused)]
        out[kind] = table.where(F.col("kind") == F.lit(kind)).select(
            *keys, *[F.col(c).alias(f"{kind}_{c}") for c in feats])
    return out


def sliding_features(df: DataFrame, keys: Sequence[str], ts_col: str, windows: Sequence[int] = (7, 30),
                     sums: dict[str, Column] | None = None, distinct: Sequence[str] = (), bucket_days: int = 32) -> DataFrame:
    """One row per (keys, day with rows): what the ``windows`` days before that day hold.

    Columns ``day`` and, for each window w, ``n_<w>d`` (rows), ``<name>_<w>d`` for each entry of
    ``sums`` (a whole-number column) and ``n_distinct_<c>_<w>d`` for each column of ``distinct``.
    The day itself is not in its windows.

    Days are cut into buckets of ``bucket_days`` (four of the longest windows, where that is more),
    and a day is also copied to the next bucket where a window reaches over the cut. So a window's
    total is a range of one (key, bucket), which holds a row per day at most. A window's distinct
    values are those of its days, less the repeats: an occurrence and the next one of the value
    take one away on the days whose window holds both, a running total of the bucket. No second
    aggregation per distinct column (Expand) and no sketch. Rows are written once, reduced to days
    before they meet, and no task holds a key's rows. Rows with a missing time or key are left
    out; a missing amount adds 0, a missing value is no distinct value.
    """
    keys, sums = list(keys), dict(sums or {})
    day = F.datediff(F.col(ts_col).cast("date"), F.lit("1970-01-01").cast("date"))
    known = F.col("_day").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    base = df.select(*keys, day.alias("_day"), *[F.col(c).alias(f"_d{i}") for i, c in enumerate(distinct)],
                     *[F.coalesce(v.cast("bigint"), F.lit(0)).alias(f"_s{i}") for i, v in enumerate(sums.values())]).where(known)
    base = materialise(base)
    span, reach = max(bucket_days, 4 * max(windows)), max(windows)
    own = ["_n", *[f"_s{i}" for i in range(len(sums))]]
    met = [f"_d{i}" for i in range(len(distinct))]
    repeats = [f"_r{i}_{w}" for i in range(len(distinct)) for w in windows]

    def bucket(at: Column) -> Column:
        return F.floor(at / F.lit(span)).cast("int")

    def entry(in_bucket: Column, at: Column, value: dict[str, Column], asked: int = 0) -> Column:
        return F.struct(in_bucket.alias("_bucket"), at.cast("int").alias("_at"), F.lit(asked).alias("_asked"), *[
            value.get(c, F.lit(0)).cast("bigint").alias(c) for c in [*own, *met, *repeats]])

    parts = []
    for i in range(max(1, len(distinct))):
        d, day = f"_d{i}", F.col("_day")
        if i == 0:  # the rows and sums go with the first distinct column
            days = base.groupBy(*keys, "_day", *met[:1]).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in own[1:]])
            value = {c: F.col(c) for c in own}
        else:
            days, value = base.where(F.col(d).isNotNull()).select(*keys, "_day", d).distinct(), {}
        steps = []
        if distinct:
            following = F.lead("_day").over(Window.partitionBy(*keys, d).orderBy("_day"))  # at most a row per day
            days = days.withColumn("_next", F.when(F.col(d).isNotNull(), following))
            value[d] = F.col(d).isNotNull().cast("int")
            for w in windows:
                start, end, r = F.col("_next") + 1, day + w, f"_r{i}_{w}"
                both = start <= end
                steps += [F.when(both, entry(bucket(start), start, {r: F.lit(1)})),
                          F.when(both & (bucket(end) > bucket(start)), entry(bucket(end), bucket(end) * span, {r: F.lit(1)})),
                          F.when(both, entry(bucket(end), end + 1, {r: F.lit(-1)}))]
        steps += [entry(bucket(day), day, value, 1), F.when(bucket(day + reach) > bucket(day), entry(bucket(day + reach), day, value))]
        parts.append(days.select(*keys, F.inline(F.filter(F.array(*steps), lambda x: x.isNotNull()))))
    entries = parts[0]
    for p in parts[1:]:
        entries = entries.unionByName(p)
    per_day = entries.groupBy(*keys, "_bucket", "_at").agg(F.max("_asked").alias("_asked"), *[F.sum(c).alias(c) for c in [*own, *met, *repeats]])
    order = Window.partitionBy(*keys, "_bucket").orderBy("_at")
    upto = order.rangeBetween(Window.unboundedPreceding, 0)
    total = {}
    for w in windows:
        before = order.rangeBetween(-w, -1)
        total |= {f"_t{c}_{w}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in [*own, *met]}
        for i in range(len(distinct)):
            total[f"_t_d{i}_{w}"] = total[f"_t_d{i}_{w}"] - F.sum(f"_r{i}_{w}").over(upto)
    called = {"_n": "n", **{f"_s{i}": name for i, name in enumerate(sums)}, **{f"_d{i}": f"n_distinct_{c}" for i, c in enumerate(distinct)}}
    return per_day.withColumns(total).where(F.col("_asked") == 1).select(
        *keys, F.date_add(F.lit("1970-01-01").cast("date"), F.col("_at")).alias("day"),
        *[F.col(f"_t{m}_{w}").alias(f"{called[m]}_{w}d") for w in windows for m in [*own, *met]])
