"""normalise_coupons: raw coupon text -> typed columns, as one projection.

Discount rate, minimum spend and date all come out of a single ``Project`` over
the scan: no shuffle, no Python worker, and the shared sub-expressions (the
slice before the last colon is used by both the rate and the minimum spend) are
evaluated once by codegen subexpression elimination.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cupola.functions.parse import MISSING_TOKENS, clean_text, date_day, date_int, discount_rate, min_spend

OUTPUTS = ("discount_rate", "min_spend", "date_int", "date_day")


def _fail_if_bad(raw: Column, parsed: Column, name: str) -> Column:
    message = F.concat(F.lit(f"cupola: cannot parse {name} from '"), raw, F.lit("'"))
    return F.when(raw.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def normalise_coupons(
    df: DataFrame,
    rate_col: str | None = "rate_raw",
    date_col: str | None = "date_raw",
    on_error: str = "null",
    missing_tokens=MISSING_TOKENS,
    observation: Observation | None = None,
    with_day: bool = True,
) -> DataFrame:
    """Add ``discount_rate``, ``min_spend`` (DOUBLE) from ``rate_col`` and
    ``date_int`` (INT, yyyymmdd) and ``date_day`` (DATE) from ``date_col``.

    Missing tokens (default: empty, ``null``, ``nan``; trimmed, any case) become
    NULL first. Then ``on_error="null"`` gives NULL for text that does not parse
    and ``on_error="fail"`` stops the job at the first such value. When an
    ``Observation`` is passed, the counts of unparsable (not missing) values are
    collected in the same pass as ``bad_<column>`` metrics.

    Note (Spark 4.1): once a session has used an ``Observation``, jobs whose closures
    capture that session (MLlib ``transform`` does) fail with "Task not serializable:
    ObservationManager". Observe in a ``spark.newSession()`` when the same session
    also scores MLlib models.
    """
    if on_error not in ("null", "fail"):
        raise ValueError("on_error must be 'null' or 'fail'")
    cols: dict[str, Column] = {}
    raws: dict[str, Column] = {}
    if rate_col is not None:
        r = clean_text(rate_col, missing_tokens)
        cols["discount_rate"] = discount_rate(r)
        cols["min_spend"] = min_spend(r)
        raws["discount_rate"] = raws["min_spend"] = r
    if date_col is not None:
        d = clean_text(date_col, missing_tokens)
        cols["date_int"] = date_int(d)
        raws["date_int"] = d
        if with_day:
            cols["date_day"] = date_day(d)
    if on_error == "fail":
        cols = {k: (_fail_if_bad(raws[k], v, k) if k in raws else v) for k, v in cols.items()}
    out = df.withColumns(cols)
    if observation is not None:
        metrics = [F.count_if(raws[k].isNotNull() & F.col(k).isNull()).alias(f"bad_{k}") for k in raws]
        out = out.observe(observation, *metrics)
    return out


def discount_band_report(coupons: DataFrame, bands_per_unit: int = 10) -> DataFrame:
    """Coupons and redemption share per discount band ``floor(rate * bands_per_unit)``.

    ``coupons`` needs ``discount_rate`` and a 0/1 ``label``. One hash aggregate
    with map-side partial aggregation; the number of groups is the number of
    bands, so the shuffle carries a few rows per map task.
    """
    band = F.floor(F.col("discount_rate") * F.lit(bands_per_unit)).alias("band")
    return (
        coupons.groupBy(band)
        .agg(
            F.count(F.lit(1)).alias("n_coupons"),
            F.sum(F.col("label").cast("bigint")).alias("n_redeemed"),
        )
        .withColumn("redeem_rate", F.col("n_redeemed") / F.col("n_coupons"))
    )


def bad_value_report(df: DataFrame, rate_col: str = "rate_raw", date_col: str = "date_raw",
                     missing_tokens=MISSING_TOKENS) -> DataFrame:
    """``column_name, n, n_missing, n_bad`` per parsed column, from one aggregate: missing
    tokens, and text that is there but does not parse."""
    r, d = clean_text(rate_col, missing_tokens), clean_text(date_col, missing_tokens)
    pairs = {"discount_rate": (r, discount_rate(r)), "min_spend": (r, min_spend(r)), "date_int": (d, date_int(d))}
    rows = df.select(*[x.alias(f"{k}_{i}") for k, pair in pairs.items() for i, x in enumerate(pair)])
    counts = rows.agg(F.count(F.lit(1)).alias("n"), *[
        a for k in pairs for a in (F.count_if(F.col(f"{k}_0").isNull()).alias(f"{k}_missing"),
                                   F.count_if(F.col(f"{k}_0").isNotNull() & F.col(f"{k}_1").isNull()).alias(f"{k}_bad"))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("column_name"), F.col("n"), F.col(f"{k}_missing").alias("n_missing"), F.col(f"{k}_bad").alias("n_bad"))
        for k in pairs])))
