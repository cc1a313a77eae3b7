"""DuckDB text of each registered query (the correctness oracle).

Written as plain SQL over the pre-registered tables; helpers below only expand
the number guards so that each statement reads like the Spark expression it
checks.
"""

from __future__ import annotations

from cupola.functions.parse import DECIMAL_PATTERN, INTEGER_PATTERN
from cupola.sources.tables import COUPON_VIEW_SQL

# The oracle splits at the last colon with a regular expression (the Spark side
# uses substrings), so the two formulations check each other.
LAST_COLON_PATTERN = r"(?s)^(.*):([^:]*)$"


def num(e: str) -> str:
    return f"(case when regexp_matches({e}, '{DECIMAL_PATTERN}') then try_cast({e} as double) end)"


def inum(e: str) -> str:
    return f"(case when regexp_matches({e}, '{INTEGER_PATTERN}') then try_cast({e} as integer) end)"


def clean(e: str) -> str:
    return f"(case when lower(trim({e})) not in ('', 'null', 'nan') then {e} end)"


def normalised_sql(extra: tuple[str, ...] = ()) -> str:
    """The normalised coupon view; ``extra`` lineitem columns are carried through."""
    view = COUPON_VIEW_SQL.replace("\nfrom lineitem", "".join(f", {c}" for c in extra) + "\nfrom lineitem")
    more = "".join(f", {c}" for c in extra)
    return f"""
with v as ({view}),
c as (select *, {clean('rate_raw')} as r, {clean('date_raw')} as d from v),
p as (select *,
        regexp_extract(r, '{LAST_COLON_PATTERN}', 1) as head,
        regexp_extract(r, '{LAST_COLON_PATTERN}', 2) as tail,
        replace(d, substring(d, 5, 1), '') as dstrip
      from c)
select l_orderkey, l_linenumber, l_partkey, rate_raw, date_raw, label,
  case when instr(r, ':') > 0 then ({num('head')} - {num('tail')}) / nullif({num('head')}, 0)
       else {num('r')} end as discount_rate,
  case when instr(r, ':') > 0 then {num('head')}
       when instr(r, '.') > 0 then cast(0 as double)
       else {num('r')} end as min_spend,
  case when instr(d, '-') > 0 then {inum('dstrip')} else {inum('d')} end as date_int{more}
from p
"""


NORMALISED_SQL = normalised_sql()

SQL: dict[str, str] = {}

SQL["coupon_normalise"] = NORMALISED_SQL

SQL["discount_bands"] = f"""
select cast(floor(discount_rate * 10) as bigint) as band,
       count(*) as n_coupons,
       cast(sum(label) as bigint) as n_redeemed,
       cast(sum(label) as bigint) / count(*) as redeem_rate
from ({NORMALISED_SQL}) group by 1
"""


# --- data quality ---------------------------------------------------------------------

QUASI_VIEW = f"""select *, cast(l_quantity <= 48 as integer) as qty_le_48 from (
{normalised_sql(("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_shipdate"))})"""


def _quasi_part(col: str) -> str:
    return f"""select '{col}' as feature, max(n) as top_count, cast(sum(n) as bigint) as non_missing
      from (select {col}, count(*) as n from q where {col} is not null group by {col})"""


QUASI_FEATURES = ["rate_raw", "discount_rate", "min_spend", "date_int", "label",
                  "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_shipdate",
                  "qty_le_48"]

SQL["quasi_constant"] = f"""
with q as ({QUASI_VIEW}),
t as ({" union all ".join(_quasi_part(c) for c in QUASI_FEATURES)})
select feature, top_count, coalesce(non_missing, 0) as non_missing,
       case when non_missing > 0 then top_count / non_missing end as ratio,
       coalesce(top_count / non_missing > 0.95, false) as flagged
from t
"""

SQL["quasi_constant_sketch"] = f"""
with q as ({QUASI_VIEW}),
t as ({" union all ".join(_quasi_part(c) for c in QUASI_FEATURES)})
select feature, coalesce(non_missing, 0) as non_missing,
       coalesce(top_count / non_missing > 0.95, false) as flagged
from t
"""

SQL["frequent_value_features"] = f"""
with q as ({QUASI_VIEW}),
t as ({" union all ".join(_quasi_part(c) for c in QUASI_FEATURES)})
select feature, top_count, non_missing from t where top_count / non_missing > 0.1
"""

EVENTS_GAPS = """
select event_id, ts, user_id,
       case when event_type <> 'error' then event_type end as event_type,
       case when event_type <> 'error' then value end as value, props
from events
"""

EVENTS_REPEATS = "select * from events union all select * from events where event_type = 'click'"


def _missing_part(col: str) -> str:
    return f"""select '{col}' as feature, count(*) as n_rows, cast(count_if({col} is null) as bigint) as n_missing,
      count_if({col} is null) / count(*) as missing_ratio from g"""


SQL["missing_report"] = f"""
with g as ({EVENTS_GAPS})
{" union all ".join(_missing_part(c) for c in ["event_id", "ts", "user_id", "event_type", "value", "props"])}
"""

SQL["missing_fill"] = f"""
with g as ({EVENTS_GAPS})
select event_id, coalesce(event_type, 'unknown') as event_type,
       coalesce(value, (select quantile_cont(value, 0.5) from g)) as value,
       cast(event_type is null as integer) as event_type_missing,
       cast(value is null as integer) as value_missing
from g
"""

SQL["dedup_exact"] = f"select distinct * from ({EVENTS_REPEATS})"

SQL["dedup_keyed"] = f"""
select user_id, event_type, event_id, ts, value from (
  select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn
  from ({EVENTS_REPEATS})) where rn = 1
"""

SQL["duplicate_report"] = f"""
select event_id, count(*) as n_rows from ({EVENTS_REPEATS}) group by event_id having count(*) > 1
"""


def _bounds(col: str) -> str:
    return f"""quantile_cont({col}, 0.25) - 1.5 * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) as lo_{col},
      quantile_cont({col}, 0.75) + 1.5 * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) as hi_{col}"""


OUTLIER_COLS = ["l_quantity", "l_discount", "l_tax"]

SQL["outlier_iqr"] = f"""
with b as (select {", ".join(_bounds(c) for c in OUTLIER_COLS)} from lineitem)
select l_orderkey, l_linenumber,
  {", ".join(f"least(greatest({c}, lo_{c}), hi_{c}) as {c}" for c in OUTLIER_COLS)},
  {", ".join(f"cast(coalesce({c} < lo_{c} or {c} > hi_{c}, false) as integer) as {c}_outlier" for c in OUTLIER_COLS)}
from lineitem, b
"""

SQL["outlier_events"] = f"""
with g as ({EVENTS_GAPS}),
b as (select {_bounds("value")} from g)
select event_id,
  case when value is null then null else least(greatest(value, lo_value), hi_value) end as value,
  cast(coalesce(value < lo_value or value > hi_value, false) as integer) as value_outlier
from g, b
"""

SIGMA_COLS = ["l_extendedprice", "l_quantity"]

SQL["outlier_sigma"] = f"""
with b as (select {", ".join(f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in SIGMA_COLS)} from lineitem)
select l_orderkey, l_linenumber, {", ".join(SIGMA_COLS)}
from lineitem, b
where not ({" or ".join(f"coalesce({c} < m_{c} - 1.5 * s_{c} or {c} > m_{c} + 1.5 * s_{c}, false)"
                        for c in SIGMA_COLS)})
"""

SQL["missing_drop"] = f"""
with g as ({EVENTS_GAPS})
select event_id, user_id, event_type, value from g
where event_type is not null and value is not null and not isnan(value)
"""


# --- time split, label, behaviour features ---------------------------------------------

SQL["time_split"] = """
select event_id, ts,
  case when ts is null then null
       when ts < timestamp '2024-01-15 00:00:00' then 'train'
       when ts < timestamp '2024-01-23 00:00:00' then 'valid'
       else 'test' end as split
from events
"""

SQL["redemption_label"] = """
select c.event_id, c.user_id, c.ts,
  case when exists (select 1 from events p
                    where p.event_type = 'purchase' and p.user_id = c.user_id
                      and p.ts >= c.ts and p.ts <= c.ts + interval 1 day) then 1 else 0 end as label
from events c where c.event_type = 'click'
"""

_TYPES = ("view", "signup", "purchase", "error", "click")

SQL["entity_features"] = f"""
with a as (
  select user_id, count(*) as n_events,
    {", ".join(f"cast(count_if(event_type = '{t}') as bigint) as n_{t}" for t in _TYPES)},
    count(distinct cast(ts as date)) as n_active_days,
    cast(sum(cast(round(value * 100) as bigint)) as bigint) as value_units,
    count(value) as value_n, min(value) as value_min, max(value) as value_max,
    count(distinct event_type) as n_distinct_event_type,
    max(ts) as last_ts
  from events where ts < timestamp '2024-01-20 00:00:00' group by user_id)
select user_id, n_events, {", ".join(f"n_{t}" for t in _TYPES)}, n_active_days, value_units,
  value_min, value_max, n_distinct_event_type, last_ts,
  {", ".join(f"n_{t} / n_events as {t}_rate" for t in _TYPES)},
  value_units / value_n / 100 as value_avg,
  cast(date_diff('day', cast(last_ts as date), date '2024-01-20') as integer) as days_since_last
from a
"""

SQL["prior_features"] = """
select event_id, user_id, ts,
  cast(coalesce(count(*) over w, 0) as bigint) as prior_events,
  cast(coalesce(sum(case when event_type = 'purchase' then 1 else 0 end) over w, 0) as bigint) as prior_purchases,
  cast(coalesce(sum(cast(round(value * 100) as bigint)) over w, 0) as bigint) as prior_value_units
from events
window w as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding)
"""


# --- ROC / AUC ----------------------------------------------------------------------------

LINEITEM_SCORES = """
select 'discount' as model, l_orderkey as id, l_discount as score, case when l_returnflag = 'R' then 1 else 0 end as label from lineitem
union all
select 'tax', l_orderkey, l_tax, case when l_returnflag = 'R' then 1 else 0 end from lineitem
union all
select 'quantity', l_orderkey, l_quantity, case when l_returnflag = 'R' then 1 else 0 end from lineitem
union all
select 'price', l_orderkey, l_extendedprice, case when l_returnflag = 'R' then 1 else 0 end from lineitem
"""

SCORE_COUNTS = f"""
select model, score, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg
from ({LINEITEM_SCORES}) where score is not null and label is not null group by model, score
"""

SQL["auc"] = f"""
with c as ({SCORE_COUNTS}),
r as (select *, coalesce(sum(neg) over (partition by model order by score
                  rows between unbounded preceding and 1 preceding), 0) as neg_below from c)
select model, cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg,
  case when sum(pos) * sum(neg) > 0 then
    sum(cast(pos as double) * (2.0 * cast(neg_below as double) + cast(neg as double)))
      / (2.0 * cast(sum(pos) as double) * cast(sum(neg) as double)) end as auc
from r group by model
"""

SQL["roc_points"] = f"""
with c as ({SCORE_COUNTS}),
r as (select model, score,
        cast(sum(pos) over w as bigint) as tp, cast(sum(neg) over w as bigint) as fp,
        sum(pos) over (partition by model) as n_pos, sum(neg) over (partition by model) as n_neg
      from c window w as (partition by model order by score desc rows between unbounded preceding and current row))
select model, score as threshold, tp, fp,
  case when n_pos > 0 then tp / n_pos end as tpr, case when n_neg > 0 then fp / n_neg end as fpr
from r
"""


# --- feature screening ----------------------------------------------------------------------

_CHI = ["l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax"]

SQL["chi_square"] = f"""
with base as (select cast(case when l_returnflag = 'R' then 1 else 0 end as varchar) as y, {", ".join(_CHI)} from lineitem),
long as ({" union all ".join(f"select '{c}' as feature, cast({c} as varchar) as x, y from base" for c in _CHI)}),
cells as (select feature, x, y, count(*) as o from long where x is not null and y is not null group by feature, x, y),
r as (select feature, x, sum(o) as r from cells group by feature, x),
c as (select feature, y, sum(o) as c from cells group by feature, y),
pf as (select feature, cast(sum(r) as bigint) as n, count(*) as n_values from r group by feature),
pl as (select feature, count(*) as n_labels from c group by feature),
t as (select cells.feature, sum(cast(o as double) * cast(o as double) / (cast(r as double) * cast(c as double))) as s
      from cells join r on cells.feature = r.feature and cells.x = r.x
                 join c on cells.feature = c.feature and cells.y = c.y
      group by cells.feature)
select pf.feature, n, n_values, n_labels, (n_values - 1) * (n_labels - 1) as dof,
       round(cast(n as double) * (s - 1.0), 6) as statistic
from pf join pl on pf.feature = pl.feature join t on pf.feature = t.feature
"""

_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "label"]
_LABELLED = "select *, case when l_returnflag = 'R' then 1 else 0 end as label from lineitem"

SQL["corr_pairs"] = f"""
with b as ({_LABELLED})
{" union all ".join(f"select '{a}' as feature_a, '{b}' as feature_b, round(corr(cast({a} as double), cast({b} as double)), 9) as corr from b"
                    for i, a in enumerate(_CORR) for b in _CORR[i + 1:])}
"""

SQL["vif_pair"] = f"""
with b as ({_LABELLED}), r as (select corr(l_quantity, l_extendedprice) as r from b)
select 'l_quantity' as feature, round(1.0 / (1.0 - r * r), 6) as vif from r
union all
select 'l_extendedprice' as feature, round(1.0 / (1.0 - r * r), 6) as vif from r
"""


def _vif3(name: str, a: str, b: str, c: str) -> str:
    # R^2 of the feature on the other two from pairwise correlations, then 1 / (1 - R^2)
    r2 = f"({a} * {a} + {b} * {b} - 2.0 * {a} * {b} * {c}) / (1.0 - {c} * {c})"
    return f"select '{name}' as feature, round(1.0 / (1.0 - {r2}), 6) as vif from r"


SQL["vif_three"] = f"""
with b as (select *, l_discount + l_tax as disc_plus_tax from lineitem),
r as (select corr(cast(l_quantity as double), cast(l_discount as double)) as r12,
             corr(cast(l_quantity as double), cast(disc_plus_tax as double)) as r13,
             corr(cast(l_discount as double), cast(disc_plus_tax as double)) as r23 from b)
{_vif3('l_quantity', 'r12', 'r13', 'r23')}
union all
{_vif3('l_discount', 'r12', 'r23', 'r13')}
union all
{_vif3('disc_plus_tax', 'r13', 'r23', 'r12')}
"""

# --- models ---------------------------------------------------------------------------------

_D2 = ("list_reduce(list_transform(list_zip(q.embedding, t.embedding), "
       "lambda z: (cast(z[1] as double) - cast(z[2] as double)) * (cast(z[1] as double) - cast(z[2] as double))), "
       "lambda acc, v: acc + v)")

SQL["knn_exact"] = f"""
with p as (select q.vec_id as qid, q.label as qlabel, t.vec_id as tid, t.label as tlabel, {_D2} as d2
           from embeddings q join embeddings t on q.vec_id <> t.vec_id),
r as (select *, row_number() over (partition by qid order by d2, tid) as rn from p),
v as (select qid, qlabel, tlabel, count(*) as n from r where rn <= 5 group by qid, qlabel, tlabel),
w as (select *, row_number() over (partition by qid order by n desc, tlabel) as rn from v)
select qid as vec_id, qlabel as label, tlabel as pred_label from w where rn = 1
"""

SQL["adaboost_stump"] = """
with b as (select case when l_returnflag = 'R' then 1 else 0 end as y, l_quantity as f1,
                  round(l_discount * 100) as f2 from lineitem),
long as (select 'l_quantity' as feature, f1 as x, y from b union all select 'discount_pct', f2, y from b),
tot as (select feature, sum(cast(y as double)) as P, sum(cast(1 - y as double)) as N from long group by feature),
g as (select feature, x, sum(cast(y as double)) as gp, sum(cast(1 - y as double)) as gn
      from long where x is not null group by feature, x),
c as (select feature, x,
        sum(gp) over (partition by feature order by x rows between unbounded preceding and current row) as pos_le,
        sum(gn) over (partition by feature order by x rows between unbounded preceding and current row) as neg_le
      from g),
e as (select c.feature, x as threshold, 1 as polarity, (neg_le + (P - pos_le)) / (P + N) as error
      from c join tot on c.feature = tot.feature
      union all
      select c.feature, x, -1, (pos_le + (N - neg_le)) / (P + N) from c join tot on c.feature = tot.feature)
select feature, threshold, polarity, error from e order by error, feature, threshold, polarity desc limit 1
"""


# --- coupon feature family ------------------------------------------------------------------


def _coupon_family(keys: list[str], prefix: str, source: str, distinct: list[str], end: str = "1997-01-01") -> str:
    k = ", ".join(keys)
    dist = "".join(f", count(distinct {d}) as n_distinct_{d}" for d in distinct)
    dist_out = "".join(f", n_distinct_{d} as {prefix}n_distinct_{d}" for d in distinct)
    return f"""
with s as ({source}),
a as (
  select {k}, count(*) as n_events, cast(sum(label) as bigint) as n_label,
    count(distinct cast(l_shipdate as date)) as n_active_days,
    cast(sum(cast(round(min_spend * 100) as bigint)) as bigint) as min_spend_units,
    count(min_spend) as ms_n, min(min_spend) as min_spend_min, max(min_spend) as min_spend_max{dist},
    max(l_shipdate) as last_ts
  from s where l_shipdate < timestamp '{end} 00:00:00' group by {k})
select {k}, n_events as {prefix}n_events, n_label as {prefix}n_label, n_active_days as {prefix}n_active_days,
  min_spend_units as {prefix}min_spend_units, min_spend_min as {prefix}min_spend_min,
  min_spend_max as {prefix}min_spend_max{dist_out}, last_ts as {prefix}last_ts,
  n_label / n_events as {prefix}label_rate,
  case when ms_n > 0 then min_spend_units / ms_n end / 100 as {prefix}min_spend_avg,
  cast(date_diff('day', cast(last_ts as date), date '{end}') as integer) as {prefix}days_since_last
from a
"""


SQL["merchant_features"] = _coupon_family(["l_suppkey"], "merchant_", normalised_sql(("l_suppkey", "l_shipdate")),
                                          ["l_partkey"])

SQL["user_merchant_features"] = _coupon_family(
    ["o_custkey", "l_suppkey"], "um_",
    f"select n.*, o.o_custkey from ({normalised_sql(('l_suppkey', 'l_shipdate'))}) n "
    "join orders o on n.l_orderkey = o.o_orderkey", [])


FAMILY_KINDS = {"customer": ["o_custkey"], "merchant": ["l_suppkey"], "part": ["l_partkey"],
                "customer_merchant": ["o_custkey", "l_suppkey"]}
_FAMILY_KEYS = ["o_custkey", "l_suppkey", "l_partkey"]
_FAMILY_FEATURES = ["n_events", "n_label", "n_active_days", "min_spend_units", "min_spend_min", "min_spend_max",
                    "n_distinct_l_partkey", "last_ts", "label_rate", "min_spend_avg", "days_since_last"]
_PARTIES = (f"select n.*, o.o_custkey from ({normalised_sql(('l_suppkey', 'l_shipdate'))}) n "
            "join orders o on n.l_orderkey = o.o_orderkey")


def _family_part(kind: str, keys: list[str]) -> str:
    cols = [c if c in keys else f"cast(null as bigint) as {c}" for c in _FAMILY_KEYS]
    return (f"select '{kind}' as kind, {', '.join(cols)}, {', '.join(_FAMILY_FEATURES)} "
            f"from ({_coupon_family(keys, '', _PARTIES, ['l_partkey'])})")


SQL["coupon_feature_family"] = " union all ".join(_family_part(k, v) for k, v in FAMILY_KINDS.items())


# --- coupon training matrix -------------------------------------------------------------------

_MATRIX = ["n_events", "label_rate", "min_spend_avg", "days_since_last"]


def _matrix_part(split: str, history_end: str, start: str, end: str) -> str:
    joins, cols = "", []
    for kind, keys in FAMILY_KINDS.items():
        on = " and ".join(f"p.{k} is not distinct from {kind}.{k}" for k in keys)
        joins += f" left join ({_coupon_family(keys, kind + '_', _PARTIES, [], history_end)}) {kind} on {on}"
        cols += [f"coalesce({kind}_n_events, 0) as {kind}_n_events"] + [f"{kind}_{c}" for c in _MATRIX[1:]]
    return (f"select '{split}' as split, l_orderkey, l_linenumber, p.label, discount_rate, min_spend, date_int, {', '.join(cols)} "
            f"from ({_PARTIES}) p{joins} where l_shipdate >= timestamp '{start} 00:00:00' and l_shipdate < timestamp '{end} 00:00:00'")


SQL["coupon_training_matrix"] = (
    _matrix_part("train", "1996-01-01", "1996-02-01", "1997-01-01") + " union all "
    + _matrix_part("test", "1997-01-01", "1997-02-01", "1998-01-01"))

# --- missing, constant and collinear inputs ---------------------------------------------------

_GAPPED_SCORES = """
select 'discount' as model, case when l_linenumber % 5 = 0 then null when l_linenumber % 7 = 0 then cast('nan' as double) else l_discount end as score,
  case when l_returnflag = 'R' then 1 else 0 end as label from lineitem
"""
_GAPPED_COUNTS = f"""
select model, score, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg
from ({_GAPPED_SCORES}) where score is not null and not isnan(score) group by model, score
"""
SQL["auc_missing"] = SQL["auc"].replace(SCORE_COUNTS, _GAPPED_COUNTS)
SQL["roc_points_missing"] = SQL["roc_points"].replace(SCORE_COUNTS, _GAPPED_COUNTS)

SQL["corr_constant"] = """
select 'l_quantity' as feature_a, 'three' as feature_b, cast(null as double) as corr
union all select 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 9) from lineitem
union all select 'three', 'l_discount', null
"""

SQL["vif_collinear"] = """
with r as (select corr(l_quantity, l_discount) as r from lineitem)
select 'l_discount' as feature, round(1.0 / (1.0 - r * r), 6) as vif from r
union all select 'three', null
union all select 'l_quantity', cast('infinity' as double)
union all select 'twice_quantity', cast('infinity' as double)
"""

# --- bad values and the CSV reader ------------------------------------------------------------

MESSY_VIEW = """
select *, case when l_partkey % 11 = 0 then concat(rate_raw, 'f') when l_partkey % 13 = 0 then '0:5' when l_partkey % 17 = 0 then 'nan' else rate_raw end as rate,
  case when l_partkey % 7 = 0 then replace(date_raw, '-', '/') else date_raw end as day
from ({view})
"""


def _bad(name: str, raw: str, parsed: str) -> str:
    return (f"select '{name}' as column_name, count(*) as n, count(*) - count({raw}) as n_missing, "
            f"count(case when {raw} is not null and {parsed} is null then 1 end) as n_bad from p")


_MESSY = normalised_sql().replace(COUPON_VIEW_SQL, (
    "select l_orderkey, l_linenumber, l_partkey, rate as rate_raw, day as date_raw, label from ("
    + MESSY_VIEW.format(view=COUPON_VIEW_SQL) + ")"))
SQL["bad_value_report"] = f"""
with p as (select *, {clean('rate_raw')} as r, {clean('date_raw')} as d from ({_MESSY}))
{_bad('discount_rate', 'r', 'discount_rate')} union all {_bad('min_spend', 'r', 'min_spend')} union all {_bad('date_int', 'd', 'date_int')}
"""

SQL["coupon_csv"] = f"""
select l_orderkey as user_id, cast(l_partkey as varchar) as coupon_id, discount_rate, min_spend, date_int
from ({NORMALISED_SQL})
"""

# --- score sink and model comparison on fixed scores ------------------------------------------

_FIXED_SCORES = """
select 'discount' as model, l_orderkey * 10 + l_linenumber as id, l_discount * 10 as score, case when l_returnflag = 'R' then 1 else 0 end as label from lineitem
union all
select 'quantity', l_orderkey * 10 + l_linenumber, l_quantity / 64, case when l_returnflag = 'R' then 1 else 0 end from lineitem
"""
SQL["score_sink_fixed"] = _FIXED_SCORES
SQL["model_compare_fixed"] = f"""
with f as ({_FIXED_SCORES}),
c as (select model, score, sum(label) as pos, sum(1 - label) as neg from f group by model, score),
r as (select *, coalesce(sum(neg) over (partition by model order by score rows between unbounded preceding and 1 preceding), 0) as neg_below from c),
a as (select model, sum(pos * (2.0 * neg_below + neg)) / (2.0 * sum(pos) * sum(neg)) as auc from r group by model),
b as (select model, count(*) as n, avg(case when (score >= 0.5) = (label = 1) then 1.0 else 0.0 end) as accuracy from f group by model)
select model, n, round(accuracy, 9) as accuracy, round(auc, 9) as auc,
  cast(dense_rank() over (order by auc desc) as integer) as auc_rank
from a join b using (model)
"""

SQL["lr_gradient"] = """
select unnest(['n_chars', 'n_words', 'n_distinct_words', 'n_lines', 'intercept']) as feature, cast(0 as double) as gradient
"""

SQL["knn_score_counts"] = """
with t as (select doc_id, quality as label, coalesce(text, '') as text from labels join documents using (doc_id)),
v as (select doc_id, label, case when trim(text, ' ') = '' then 0 else len(string_split_regex(trim(text, ' '), '\\s+')) end as w,
             len(string_split(text, chr(10))) as l from t),
p as (select a.doc_id as q, b.doc_id as t, b.label, (a.w - b.w) * (a.w - b.w) + (a.l - b.l) * (a.l - b.l) as d
      from v a join v b on a.doc_id <> b.doc_id),
r as (select *, row_number() over (partition by q order by d, t) as k from p)
select q as doc_id, round(avg(cast(label as double)), 9) as score from r where k <= 15 group by q
"""

SQL["redemption_match"] = """
with recursive i as (
  select event_id, user_id, ts, row_number() over (partition by user_id order by ts, event_id) as n
  from events where event_type = 'click' and user_id is not null and ts is not null),
r as (
  select p.event_id, p.user_id, p.ts, row_number() over (partition by p.user_id order by p.ts, p.event_id) as j,
         (select count(*) from i where i.user_id = p.user_id and i.ts <= p.ts) as hi,
         (select count(*) from i where i.user_id = p.user_id and i.ts < p.ts - interval 1 day) as gone
  from events p where p.event_type = 'purchase' and p.user_id is not null and p.ts is not null),
s as (
  select user_id, cast(0 as bigint) as j, cast(0 as bigint) as x, cast(null as bigint) as n, cast(null as bigint) as redeem_id, cast(null as timestamp) as redeem_ts
  from r group by user_id
  union all
  select s.user_id, s.j + 1, greatest(s.x, r.gone) + case when greatest(s.x, r.gone) < r.hi then 1 else 0 end,
         case when greatest(s.x, r.gone) < r.hi then greatest(s.x, r.gone) + 1 end, r.event_id, r.ts
  from s join r on r.user_id = s.user_id and r.j = s.j + 1)
select c.event_id, c.user_id, c.ts, s.redeem_id, s.redeem_ts, case when s.n is null then 0 else 1 end as label
from events c left join i on i.event_id = c.event_id left join s on s.user_id = i.user_id and s.n = i.n
where c.event_type = 'click'
"""

_EVENT_SCORES = " union all ".join(
    f"select '{m}' as model, event_id as id, cast({s} as double) as score, cast(event_type = 'purchase' as integer) as label from events"
    for m, s in (("value", "value"), ("hour", "hour(ts)"), ("user", "user_id")))
SQL["auc_compare"] = f"""
with f as ({_EVENT_SCORES}),
u as (
  select model, id, label,
         case when label = 1 then 2 * (rank() over (partition by model order by score) - 1 - coalesce(sum(label) over below, 0)) + sum(1 - label) over same
              else 2 * (sum(label) over (partition by model) - sum(label) over upto) + sum(label) over same end as u
  from f
  window below as (partition by model order by score range between unbounded preceding and current row exclude group),
         upto as (partition by model order by score range between unbounded preceding and current row),
         same as (partition by model, score)),
n as (select sum(label) as n_pos, sum(1 - label) as n_neg from f where model = 'hour'),
c as (
  select a.model as model_a, b.model as model_b, a.label, count(*) as m,
         sum(cast(a.u as hugeint)) as sa, sum(cast(b.u as hugeint)) as sb, sum(cast(a.u as hugeint) * cast(b.u as hugeint)) as sab
  from u a join u b on a.id = b.id and a.model <= b.model group by a.model, b.model, a.label),
v as (
  select model_a, model_b, sum(case when label = 1 then cast(sa as double) / (2.0 * n_pos * n_neg) end) as auc_a,
         sum(case when label = 1 then cast(sb as double) / (2.0 * n_pos * n_neg) end) as auc_b,
         sum(cast(m * sab - sa * sb as double) / (cast(m as double) * (m - 1) * m * 4.0 * (case when label = 1 then n_neg * n_neg else n_pos * n_pos end))) as cov
  from c, n group by model_a, model_b)
select v.model_a, v.model_b, cast(n_pos as bigint) as n_pos, cast(n_neg as bigint) as n_neg, round(v.auc_a, 9) as auc_a, round(v.auc_b, 9) as auc_b,
       round(v.cov, 14) as covariance,
       case when v.model_a <> v.model_b then round((v.auc_a - v.auc_b) / sqrt(x.cov + y.cov - 2 * v.cov), 6) end as z
from v join v x on x.model_a = v.model_a and x.model_b = v.model_a join v y on y.model_a = v.model_b and y.model_b = v.model_b, n
"""


def _sliding(w: int) -> str:
    frame = f"over (partition by o_custkey order by day range between interval {w} days preceding and interval 1 day preceding)"
    return f"""count(*) {frame} as n_{w}d, cast(coalesce(sum(label) {frame}, 0) as bigint) as n_label_{w}d,
  cast(coalesce(sum(cast(round(min_spend * 100) as bigint)) {frame}, 0) as bigint) as min_spend_units_{w}d,
  count(distinct l_suppkey) {frame} as n_distinct_l_suppkey_{w}d"""


SQL["coupon_sliding_features"] = f"""
with c as (select *, cast(l_shipdate as date) as day from ({_PARTIES}))
select l_orderkey, l_linenumber, o_custkey, day, {_sliding(7)}, {_sliding(30)} from c
"""


SQL["rf_tree_gap"] = "select doc_id, cast(0 as double) as gap from labels join documents using (doc_id)"

# AdaBoost in whole numbers: every round is replayed from the cells' weights
_BINS = ("chars_bin", "lines_bin", "words_bin")


def _boosting_round(r: int) -> str:
    each = " union all ".join(f"select '{b}' as feature, {b} as threshold, y, w from c{r}" for b in _BINS)
    value = " ".join(f"when '{b}' then {b}" for b in _BINS)
    right = f"(((case b.feature {value} end) <= b.threshold) = (b.polarity = 1)) = (y = 1)"
    return f"""
g{r} as (select feature, threshold, sum(case when y = 1 then w else 0 end) as p, sum(case when y = 1 then 0 else w end) as n from ({each}) group by 1, 2),
s{r} as (select feature, threshold, sum(n) over upto + sum(p) over (partition by feature) - sum(p) over upto as plus, sum(p + n) over (partition by feature) as total
         from g{r} window upto as (partition by feature order by threshold)),
b{r} as materialized (
  select * from (select feature, threshold, 1 as polarity, plus as wrong, total from s{r} union all select feature, threshold, -1, total - plus, total from s{r})
  where 2 * wrong < total order by wrong, feature, threshold, polarity desc limit 1),
c{r + 1} as (
  select {", ".join(_BINS)}, y, cast(w * total // (case when {right} then 2 * (total - wrong) else 2 * wrong end) as hugeint) as w
  from c{r}, b{r} as b where wrong > 0)"""


SQL["adaboost_rounds"] = f"""
with t as (select quality as y, n_chars, coalesce(text, '') as text from labels join documents using (doc_id)),
v as (select y, least(n_chars // 200, 40) as chars_bin, least(len(string_split(text, chr(10))), 30) as lines_bin,
        least((case when trim(text, ' ') = '' then 0 else len(string_split_regex(trim(text, ' '), '\\s+')) end) // 25, 40) as words_bin from t),
c0 as (select {", ".join(_BINS)}, y, cast(count(*) * 1048576 as hugeint) as w from v where y is not null and chars_bin is not null group by all),
{",".join(_boosting_round(r) for r in range(8))}
{" union all ".join(f"select {r + 1} as round, feature, cast(threshold as bigint) as threshold, polarity, cast(wrong as bigint) as wrong_weight, cast(total as bigint) as total_weight from b{r}" for r in range(8))}
"""

SQL["missing_fill_by_group"] = f"""
with g as (select *, cast(ts as date) as day from ({EVENTS_GAPS})),
m as (select user_id, day, quantile_cont(value, 0.5) as med from g where value is not null group by user_id, day)
select event_id, g.user_id, g.day, coalesce(value, med, (select quantile_cont(value, 0.5) from g)) as value
from g left join m on g.user_id = m.user_id and g.day = m.day
"""

SQL["coupon_quarantine"] = f"""
with v as ({COUPON_VIEW_SQL}),
f as (select l_orderkey, l_orderkey % 89 = 0 or l_orderkey % 97 = 0 as bad,
        case when l_orderkey % 89 = 0 then concat_ws(',', l_orderkey, l_partkey)
             else concat_ws(',', 'x' || l_orderkey, l_partkey, l_partkey, rate_raw, '1', date_raw, 'null') end as line from v)
select 'kept' as part, count(*) as n_rows, cast(coalesce(sum(l_orderkey), 0) as bigint) as checksum from f where not bad
union all
select 'quarantine', count(*), cast(coalesce(sum(length(line)), 0) as bigint) from f where bad
"""

_CHI_OF = """(case when (s[i].p + s[i].n) * (s[i + 1].p + s[i + 1].n) * (s[i].p + s[i + 1].p) * (s[i].n + s[i + 1].n) > 0 then
  (s[i].p + s[i].n + s[i + 1].p + s[i + 1].n) * (s[i].p * s[i + 1].n - s[i].n * s[i + 1].p) * (s[i].p * s[i + 1].n - s[i].n * s[i + 1].p)
  / ((s[i].p + s[i].n) * (s[i + 1].p + s[i + 1].n) * (s[i].p + s[i + 1].p) * (s[i].n + s[i + 1].n)) else 0.0 end)"""

SQL["chi_merge"] = f"""
with recursive v as (
  select 'l_quantity' as feature, l_quantity as x, l_returnflag from lineitem
  union all select 'discount_pct', round(l_discount * 100), l_returnflag from lineitem),
c as (select feature, x, cast(count_if(l_returnflag = 'R') as double) as p, cast(count_if(l_returnflag <> 'R') as double) as n from v where x is not null group by feature, x),
s0 as (select feature, list(struct_pack(low := x, high := x, p := p, n := n) order by x) as s from c group by feature),
m as (
  select feature, s, list_transform(range(1, len(s)), lambda i: {_CHI_OF}) as chi from s0
  union all
  select feature, s, list_transform(range(1, len(s)), lambda i: {_CHI_OF}) as chi from (
    select feature, list_concat(list_concat(s[:k - 1], [struct_pack(low := s[k].low, high := s[k + 1].high, p := s[k].p + s[k + 1].p, n := s[k].n + s[k + 1].n)]), s[k + 2:]) as s
    from (select feature, s, chi, list_position(chi, list_min(chi)) as k from m
          where len(chi) > 0 and (list_min(chi) < 3.841458820694124 or len(s) > 64)))),
l as (select feature, s from m where len(chi) = 0 or not (list_min(chi) < 3.841458820694124 or len(s) > 64)),
u as (select feature, unnest(range(1, len(s) + 1)) as i, s from l)
select feature, cast(i as integer) as bin, s[i].low as low, s[i].high as high, cast(s[i].p as bigint) as n_pos, cast(s[i].n as bigint) as n_neg from u
"""

SQL["rolling_origin_table"] = """
with o as (select * from (values (0, timestamp '2024-01-12'), (1, timestamp '2024-01-16'), (2, timestamp '2024-01-20'), (3, timestamp '2024-01-24')) t(fold, origin)),
p as (
  select fold, origin, user_id, count(*) as n_events, cast(count_if(event_type = 'click') as bigint) as n_clicks, cast(count_if(event_type = 'purchase') as bigint) as n_purchases,
         cast(coalesce(sum(cast(round(value * 100) as bigint)), 0) as bigint) as value_units, max(ts) as last_ts
  from events join o on ts >= origin - interval 10 day and ts < origin group by fold, origin, user_id)
select fold, user_id, n_events, n_clicks, n_purchases, value_units, cast(date_diff('day', cast(last_ts as date), cast(origin as date)) as integer) as days_since_last,
  cast(exists (select 1 from events e where e.user_id = p.user_id and e.event_type = 'purchase' and e.ts >= p.origin and e.ts < p.origin + interval 3 day) as integer) as label
from p
"""
