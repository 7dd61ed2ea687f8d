"""Daily series features.

One series = one (market_name, commodity_name), ordered by price_date. All
series windows share a single ``Window`` spec, so the whole feature block runs
after one hash Exchange on the series keys; the FX lookup is a broadcast
equi-join (it keeps that partitioning), and densify is a generator (it keeps
it too).

Scale notes. A series holds at most one row per calendar day (the input is
the daily fact, one row per (date, market, commodity)), so a window partition
is bounded by the calendar span, however skewed the raw feeds are: the raw
skew is absorbed by the partial aggregation of the daily fact. Offsets are
row offsets after densification, as in the reference ("7d" = 7 rows).

Money is handled as integer cents; rolling mean/std come from exact integer
sums, so results are deterministic and independent of summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestline.functions import cents, is_lean_season, is_rainy_season
from harvestline.session import written

SERIES = ["market_name", "commodity_name"]
DATE = "price_date"

# The reference's offsets and windows (rows).
TARGET_HORIZONS = [7, 30]
LAGS = [1, 3, 7, 14, 21, 30, 60, 90]
ROLL_WINDOWS = [7, 14, 30, 60]
MOMENTUM = [7, 14, 30]
FX_CHANGES = [7, 30]
REQUIRED = ["lag_30d", "roll_mean_30d"]
# The reference's modelling targets, written with the clean
# names the harmonisation maps them to (three of its raw spellings no longer
# exist after mapping). Pass as ``feature_table(commodities=...)`` to
# reproduce its feature run; the default (None) featurises every commodity.
TARGET_COMMODITIES = [
    "Millet",
    "Rice (imported)",
    "Rice (local)",
    "Sorghum",
    "Yam tuber",
    "Maize flour",
    "Groundnuts",
    "Onions",
    "Eggs (crate of 30)",
    "Palm oil",
]


def series_window(keys: Sequence[str] = SERIES, date: str = DATE):
    return Window.partitionBy(*keys).orderBy(date)


# Calendar days (16 bytes a row) up to which the as-of table is broadcast.
MAX_BROADCAST_DAYS = 1_000_000


def _whole(keys, date):
    return series_window(keys, date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def min_history(df: DataFrame, keys: Sequence[str] = SERIES, n: int = 50, date: str = DATE):
    """Keep series with at least ``n`` rows."""
    cnt = F.count(F.lit(1)).over(_whole(keys, date))
    return df.withColumn("_n", cnt).where(F.col("_n") >= n).drop("_n")


def densify_daily(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    date: str = DATE,
    values: Sequence[str] = ("price_c",),
    limit: int = 7,
    min_obs: int | None = None,
) -> DataFrame:
    """Daily grid with forward fill of at most ``limit`` days.

    Each observation is carried over the following days up to the day before
    the next observation, at most ``limit`` days; days further into a gap are
    not generated at all (the reference generates them and drops them), and
    the last observation is not extended. ``min_obs`` applies W4 in the same
    window pass.
    """
    w = series_window(keys, date)
    d = F.col(date)
    nxt = F.lead(d).over(w)
    end = F.greatest(d, F.least(F.coalesce(F.date_sub(nxt, 1), d), F.date_add(d, limit)))
    cols = [*keys, d, *values, end.alias("_end")]
    if min_obs:
        cols.append(F.count(F.lit(1)).over(_whole(keys, date)).alias("_n"))
    staged = df.select(*cols)
    if min_obs:
        staged = staged.where(F.col("_n") >= min_obs)
    return staged.select(
        *keys, F.explode(F.sequence(d, F.col("_end"))).alias(date), *values
    )


def fx_daily(
    rates: DataFrame,
    date: str = "rate_date",
    value: str = "central_rate",
    out: str = "fx_usd_ngn",
) -> DataFrame:
    """As-of table: one row per calendar day from the first to the last rate's
    month, holding the latest rate dated on or before that day (W11).

    Work is dealt by month: a month's days are filled from its own rates, the
    days before its first rate from the last rate of an earlier month, which a
    small table with a row per month carries forward. ``rates`` are those of
    one currency; several rates of a day count once (the greatest).
    """
    d = F.col(date)
    key = ["currency"] if "currency" in rates.columns else []
    by_day = (
        rates.where(d.isNotNull())
        .groupBy(*key, d.alias("day"))
        .agg(F.max(F.col(value).cast("double")).alias("rate"))
    )
    months = by_day.groupBy(*key, F.trunc("day", "month").alias("month")).agg(
        F.max_by("rate", "day").alias("last"), F.sort_array(F.collect_list(F.struct("day", "rate"))).alias("rates")
    )
    carry = Window.partitionBy(*key).orderBy("month")
    filled = months.select(
        "month",
        "rates",
        F.lag("last").over(carry).alias("carried"),
        F.coalesce(F.lead("month").over(carry), F.add_months("month", 1)).alias("until"),
    )
    # from the month's first day to the day before the next month that has rates
    edges = F.concat(F.array(F.struct(F.col("month").alias("day"), F.col("carried").alias("rate"))), F.col("rates"))
    span = filled.select("until", F.posexplode(edges).alias("i", "e"), edges.alias("edges"))
    end = F.date_sub(F.coalesce(F.get("edges.day", F.col("i") + 1), F.col("until")), 1)
    return (
        span.select(F.col("e.day").alias("day"), F.col("e.rate").alias(out), end.alias("end"))
        .where(f"day <= end and {out} is not null")
        .select(F.explode(F.sequence("day", "end")).alias("_fx_day"), out)
    )


def asof_rate(
    df: DataFrame,
    rates: DataFrame,
    on: str = DATE,
    date: str = "rate_date",
    value: str = "central_rate",
    out: str = "fx_usd_ngn",
    currency: str = "USD",
) -> DataFrame:
    """Backward as-of join: each row gets the latest rate dated <= its date;
    rows before the first rate get NULL (J6).

    Written as a daily as-of table + equi-join (no range join, no nested
    loop). The table has one row per calendar day by construction, so it is
    broadcast only if the calendar between the first and the last rate is
    within ``MAX_BROADCAST_DAYS``. Days after it take the last rate. Where
    ``rates`` name their currency, those of ``currency`` count.
    """
    if "currency" in rates.columns:
        rates = rates.where(F.col("currency") == currency)
    # a row per day, written: read for its ends and again for the calendar, whose months are carried by currency
    key = ["currency"] if "currency" in rates.columns else []
    by_day = rates.where(F.col(date).isNotNull()).groupBy(*key, date)
    rates = written(by_day.agg(F.max(F.col(value).cast("double")).alias(value)), "rates")
    first, last = rates.agg(
        F.min(date), F.max(F.struct(F.col(date).alias("d"), F.col(value).cast("double").alias("r")))
    ).first()
    if first is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    daily = fx_daily(rates, date, value, out)
    if (last["d"] - first).days <= MAX_BROADCAST_DAYS:
        daily = F.broadcast(daily)
    j = df.join(daily, F.col(on) == F.col("_fx_day"), "left")
    carried = F.when(F.col(on) > F.lit(last["d"]), F.lit(last["r"])).otherwise(F.col(out))
    return j.withColumn(out, carried).drop("_fx_day")


def _running(w, price_c: str = "price_c") -> list[Column]:
    """Row number and running sums over the series (one O(n) pass). Squares
    are summed as DECIMAL so a long, expensive series cannot overflow."""
    c = F.col(price_c)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    c2 = c.cast("decimal(20,0)") * c.cast("decimal(20,0)")
    return [
        F.row_number().over(w).alias("_rn"),
        F.sum(c).over(upto).alias("_cs"),
        F.sum(c2).over(upto).alias("_cs2"),
    ]


def _roll(c: Column, w, n: int) -> list[Column]:
    """Rolling mean/std/min/max over the last ``n`` rows, NULL until ``n`` rows
    exist (W8). Sums are differences of running sums (exact integers, O(1)
    per row); min/max use the sliding frame. The price column has no NULLs
    after densify, so "n rows exist" is row_number >= n."""
    fr = w.rowsBetween(-(n - 1), 0)
    full = F.col("_rn") >= n
    s = F.col("_cs") - F.coalesce(F.lag("_cs", n).over(w), F.lit(0))
    s2 = F.col("_cs2") - F.coalesce(F.lag("_cs2", n).over(w), F.lit(0))
    var_num = (s2 * n - s.cast("decimal(38,0)") * s).cast("double")
    return [
        F.when(full, s / n / 100).alias(f"roll_mean_{n}d"),
        F.when(full, F.sqrt(var_num / (n * (n - 1))) / 100).alias(f"roll_std_{n}d"),
        F.when(full, F.min(c).over(fr) / 100).alias(f"roll_min_{n}d"),
        F.when(full, F.max(c).over(fr) / 100).alias(f"roll_max_{n}d"),
    ]


def feature_columns(
    w, price_c: str = "price_c", date: str = DATE, fx: str | None = "fx_usd_ngn"
) -> list[Column]:
    """Targets, lags, rolling stats, momentum, calendar and FX changes.
    Expects the ``_running`` columns next to ``price_c``."""
    c = F.col(price_c)
    d = F.col(date)
    cols = [(c / 100).alias("price_ngn")]
    cols += [(F.lead(c, h).over(w) / 100).alias(f"target_{h}d") for h in TARGET_HORIZONS]
    cols += [(F.lag(c, k).over(w) / 100).alias(f"lag_{k}d") for k in LAGS]
    for n in ROLL_WINDOWS:
        cols += _roll(c, w, n)
    cols += [
        (F.try_divide(c, F.lag(c, k).over(w)) - 1).alias(f"mom_pct_change_{k}d") for k in MOMENTUM
    ]
    month = F.month(d)
    cols += [
        month.alias("cal_month"),
        F.quarter(d).alias("cal_quarter"),
        F.weekday(d).alias("cal_day_of_week"),
        F.dayofyear(d).alias("cal_day_of_year"),
        F.weekofyear(d).alias("cal_week_of_year"),
        is_rainy_season(month).alias("cal_is_rainy_season"),
        is_lean_season(month).alias("cal_is_lean_season"),
    ]
    if fx:
        f = F.col(fx)
        cols.append(f.alias(fx))
        cols += [
            (F.try_divide(f, F.lag(f, k).over(w)) - 1).alias(f"fx_pct_change_{k}d")
            for k in FX_CHANGES
        ]
    return cols


def feature_table(
    daily: DataFrame,
    rates: DataFrame | None = None,
    commodities: Sequence[str] | None = None,
    min_obs: int = 50,
    limit: int = 7,
    keys: Sequence[str] = SERIES,
    date: str = DATE,
    price: str = "price_ngn",
) -> DataFrame:
    """The model feature table from the daily fact (fe, W4-W13, P19, J6).

    ``rates``: staged FX rows (one per date, USD) or None to skip FX features.
    ``commodities``: optional list filter (P12), pushed below the windows.
    """
    base = daily
    if commodities is not None:
        base = base.where(F.col("commodity_name").isin(list(commodities)))
    base = base.select(*keys, date, cents(price).alias("price_c"))
    dense = densify_daily(base, keys, date, ["price_c"], limit=limit, min_obs=min_obs)
    if rates is not None:
        dense = asof_rate(dense, rates, on=date)
        fx = "fx_usd_ngn"
    else:
        fx = None
    w = series_window(keys, date)
    n_after = F.count(F.lit(1)).over(_whole(keys, date)).alias("_n")
    extra = [fx] if fx else []
    running = dense.select(*keys, date, "price_c", *extra, *_running(w, "price_c"))
    feats = running.select(*keys, date, *feature_columns(w, "price_c", date, fx), n_after)
    out = feats.where(F.col("_n") >= min_obs).drop("_n")
    return out.dropna(subset=REQUIRED)


# Step-by-step forms of the feature block (one helper per feature family).
# They share ``series_window``, so chained calls collapse into the same
# Window operators; ``feature_table`` is the one-call equivalent.


def _cents_col(df: DataFrame, price: str) -> tuple[DataFrame, str]:
    return df.withColumn("_pc", cents(price)), "_pc"


def add_targets(df, price="price_ngn", keys=SERIES, date=DATE, horizons=TARGET_HORIZONS) -> DataFrame:
    """Price ``h`` rows ahead."""
    d, c = _cents_col(df, price)
    w = series_window(keys, date)
    return d.withColumns({f"target_{h}d": F.lead(c, h).over(w) / 100 for h in horizons}).drop(c)


def add_lags(df, price="price_ngn", keys=SERIES, date=DATE, lags=LAGS) -> DataFrame:
    """Price ``k`` rows back."""
    d, c = _cents_col(df, price)
    w = series_window(keys, date)
    return d.withColumns({f"lag_{k}d": F.lag(c, k).over(w) / 100 for k in lags}).drop(c)


def add_rolling(df, price="price_ngn", keys=SERIES, date=DATE, windows=ROLL_WINDOWS) -> DataFrame:
    """Rolling mean/std/min/max over the last n rows, NULL until full.
    Assumes no NULL prices (true after densify)."""
    d, c = _cents_col(df, price)
    w = series_window(keys, date)
    run = d.select("*", *_running(w, c))
    cols = [col for n in windows for col in _roll(F.col(c), w, n)]
    return run.select("*", *cols).drop(c, "_rn", "_cs", "_cs2")


def add_momentum(df, price="price_ngn", keys=SERIES, date=DATE, spans=MOMENTUM) -> DataFrame:
    """Percent change over ``k`` rows."""
    d, c = _cents_col(df, price)
    w = series_window(keys, date)
    cols = {f"mom_pct_change_{k}d": F.try_divide(F.col(c), F.lag(c, k).over(w)) - 1 for k in spans}
    return d.withColumns(cols).drop(c)


def add_calendar(df, date=DATE) -> DataFrame:
    """Month, quarter, weekday (Mon=0), day of year, ISO week, season flags."""
    d = F.col(date)
    m = F.month(d)
    return df.withColumns(
        {
            "cal_month": m,
            "cal_quarter": F.quarter(d),
            "cal_day_of_week": F.weekday(d),
            "cal_day_of_year": F.dayofyear(d),
            "cal_week_of_year": F.weekofyear(d),
            "cal_is_rainy_season": is_rainy_season(m),
            "cal_is_lean_season": is_lean_season(m),
        }
    )


def fx_features(df, fx="fx_usd_ngn", keys=SERIES, date=DATE, spans=FX_CHANGES) -> DataFrame:
    """FX percent change over ``k`` rows within the series."""
    w = series_window(keys, date)
    f = F.col(fx)
    return df.withColumns({f"fx_pct_change_{k}d": F.try_divide(f, F.lag(f, k).over(w)) - 1 for k in spans})


def feature_summary(features: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Per series: rows, first/last date, mean price."""
    c = F.round(F.col("price_ngn") * 100).cast("bigint")  # exact cents back
    return features.groupBy(*keys).agg(
        F.count("price_ngn").alias("obs_count"),
        F.min(DATE).alias("date_min"),
        F.max(DATE).alias("date_max"),
        (F.sum(c) / F.count(c) / 100).alias("price_mean"),
    )
