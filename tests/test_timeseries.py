import datetime as dt
from decimal import Decimal as D

import pandas as pd
from pyspark.sql import functions as F
import pytest

from harvestline.operators import timeseries as ts
from tests.conftest import rows

D0 = dt.date(2024, 1, 1)


def series(spark, days_prices, market="Kano", commodity="Rice"):
    data = [(market, commodity, D0 + dt.timedelta(days=d), D(p)) for d, p in days_prices]
    return spark.createDataFrame(data, "market_name string, commodity_name string, price_date date, price_ngn decimal(12,2)")


def test_densify_fills_at_most_seven_days_and_not_past_last(spark):
    s = series(spark, [(0, "1.00"), (7, "2.00"), (15, "3.00"), (24, "4.00")])
    base = s.select("market_name", "commodity_name", "price_date", (s.price_ngn * 100).cast("bigint").alias("price_c"))
    dense = ts.densify_daily(base)
    got = rows(dense, "price_date", "price_c")
    days = [(d - D0).days for d, _ in got]
    assert days == list(range(0, 23)) + [24]  # gap of 9: day 23 not generated; last not extended
    assert dict(((d - D0).days, c) for d, c in got)[14] == 200  # gap of 8 fully filled
    assert dict(((d - D0).days, c) for d, c in got)[22] == 300


def test_min_history_49_vs_50(spark):
    a = series(spark, [(i, "1.00") for i in range(49)], market="A")
    b = series(spark, [(i, "1.00") for i in range(50)], market="B")
    out = ts.min_history(a.unionByName(b), n=50)
    assert {r.market_name for r in out.select("market_name").distinct().collect()} == {"B"}


def test_rolling_features_match_pandas(spark):
    prices = [f"{100 + (i * 37) % 23}.{(i * 7) % 100:02d}" for i in range(120)]
    s = series(spark, list(enumerate(prices)))
    fe = ts.feature_table(s, rates=None, min_obs=50)
    pdf = fe.orderBy("price_date").toPandas()
    p = pd.Series([float(x) for x in prices])
    ref = pd.DataFrame(
        {
            "roll_mean_7d": p.rolling(7).mean(),
            "roll_std_14d": p.rolling(14).std(),
            "roll_min_30d": p.rolling(30).min(),
            "roll_max_60d": p.rolling(60).max(),
            "lag_30d": p.shift(30),
            "target_7d": p.shift(-7),
            "mom_pct_change_7d": p.pct_change(7),
        }
    ).dropna(subset=["lag_30d"])
    assert len(pdf) == len(ref) == 90
    for c in ref.columns:
        a, b = pdf[c].to_numpy(dtype=float), ref[c].to_numpy(dtype=float)
        assert pd.Series(a).isna().equals(pd.Series(b).isna()), c
        m = ~pd.isna(b)
        assert abs(a[m] - b[m]).max() < 1e-9, c


def test_constant_series_has_zero_std_and_calendar(spark):
    s = series(spark, [(i, "5.00") for i in range(60)])
    fe = ts.feature_table(s, rates=None, min_obs=50).orderBy("price_date")
    r = fe.first()
    assert r.roll_std_7d == 0.0 and r.roll_mean_30d == 5.0 and r.mom_pct_change_30d == 0.0
    # 2024-01-31 is a Wednesday: Mon=0 -> 2; ISO week 5
    assert (r.price_date, r.cal_day_of_week, r.cal_week_of_year, r.cal_is_rainy_season) == (
        dt.date(2024, 1, 31), 2, 5, 0
    )


def test_asof_rate_backward_with_leading_null(spark):
    rates = spark.createDataFrame(
        [(D0 + dt.timedelta(days=2), D("900.0")), (D0 + dt.timedelta(days=5), D("950.0"))],
        "rate_date date, central_rate decimal(12,4)",
    )
    obs = spark.createDataFrame([(D0 + dt.timedelta(days=d),) for d in (1, 2, 3, 5, 10)], "price_date date")
    got = rows(ts.asof_rate(obs, rates), "price_date", "fx_usd_ngn")
    assert [v for _, v in got] == [None, 900.0, 900.0, 950.0, 950.0]


def test_asof_rate_carries_months_by_currency(spark):
    days = {0: "900.0", 3: "905.0", 70: "950.0", 200: "990.0"}
    rates = spark.createDataFrame(
        [(D0 + dt.timedelta(days=d), D(r), "USD") for d, r in days.items()]
        + [(D0 + dt.timedelta(days=d), D("1.0"), c) for d in (1, 60, 300) for c in ("EUR", None)]
        + [(D0 + dt.timedelta(days=70), D("940.0"), "USD"), (None, D("2.0"), "USD")],
        "rate_date date, central_rate decimal(12,4), currency string",
    )
    obs = spark.createDataFrame([(D0 + dt.timedelta(days=d),) for d in range(-1, 310)], "price_date date")
    df = ts.asof_rate(obs, rates)
    got = [v for _, v in rows(df, "price_date", "fx_usd_ngn")]
    assert got == [max(((d, float(r)) for d, r in days.items() if d <= at), default=(0, None))[1] for at in range(-1, 310)]
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


def test_feature_summary(spark):
    s = series(spark, [(i, "2.00" if i % 2 else "4.00") for i in range(80)])
    fe = ts.feature_table(s, rates=None, min_obs=50)
    (r,) = ts.feature_summary(fe).collect()
    assert r.obs_count == 50 and r.price_mean == pytest.approx(3.0)


def test_commodity_filter_is_pushed_below_the_windows(spark):
    a = series(spark, [(i, "1.00") for i in range(60)], commodity="Rice")
    b = series(spark, [(i, "2.00") for i in range(60)], commodity="Beans")
    fe = ts.feature_table(a.unionByName(b), rates=None, commodities=["Beans"])
    assert {r.commodity_name for r in fe.select("commodity_name").distinct().collect()} == {"Beans"}
    plan = fe._jdf.queryExecution().optimizedPlan().toString()
    # the filter sits under the window operators, not on top of them
    assert plan.rfind("Filter") > plan.find("Window")


def test_step_helpers_equal_feature_table(spark):
    prices = [f"{100 + (i * 37) % 23}.{(i * 7) % 100:02d}" for i in range(120)]
    s = series(spark, list(enumerate(prices)))
    table = ts.feature_table(s, rates=None, min_obs=50)
    step = ts.add_calendar(ts.add_momentum(ts.add_rolling(ts.add_lags(ts.add_targets(s)))))
    step = step.withColumn("price_ngn", F.col("price_ngn").cast("double")).dropna(subset=ts.REQUIRED)
    cols = [c for c in table.columns]
    a = sorted(tuple(r) for r in table.select(*cols).collect())
    b = sorted(tuple(r) for r in step.select(*cols).collect())
    assert a == b
