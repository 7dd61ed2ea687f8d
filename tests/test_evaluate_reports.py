import datetime as dt

import pytest

from harvestline.operators import evaluate, reports
from tests.conftest import rows


def test_split_cutoff_month_end_clamp(spark):
    for last, cut in ((dt.date(2024, 5, 31), dt.date(2024, 2, 29)), (dt.date(2023, 5, 31), dt.date(2023, 2, 28))):
        df = spark.createDataFrame([(last,), (cut,), (cut - dt.timedelta(days=1),)], "price_date date")
        got = rows(evaluate.temporal_split(df, 3), "price_date", "split")
        assert got == [(cut - dt.timedelta(days=1), "train"), (cut, "test"), (last, "test")]


def test_metrics_mask_zero_truth_from_mape_only(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 1.0), ("a", 2.0, 1.0), ("a", None, 5.0), ("b", 0.0, 3.0)], "k string, y double, yhat double"
    )
    got = {r.k: r for r in evaluate.error_metrics(df, "y", "yhat", ["k"]).collect()}
    assert got["a"].mae == 1.0 and got["a"].rmse == 1.0 and got["a"].mape == 50.0 and got["a"].n_scored == 2
    assert got["b"].mape is None  # all-zero truths
    z = df.groupBy("k").agg(*evaluate.metric_aggs("y", "yhat", zero_mape=0.0))
    assert {r.k: r.mape for r in z.collect()}["b"] == 0.0


def test_best_model_ties_and_nulls(spark):
    res = spark.createDataFrame(
        [("c", "Naive (last value)", 0, 2.0, 1.0), ("c", "Moving Average (30d)", 1, 2.0, 0.5), ("c", "Seasonal Naive (30d)", 2, None, None)],
        "commodity string, model string, model_rank int, mae double, mape double",
    )
    (r,) = evaluate.best_model(res).collect()
    assert r.model == "Naive (last value)"


def _features(spark, data):
    return spark.createDataFrame(
        data,
        "market_name string, commodity_name string, price_date date, price_ngn double, mom_pct_change_30d double, roll_std_30d double",
    )


def test_projection_null_momentum_and_floor(spark):
    d = dt.date(2024, 1, 1)
    fe = _features(
        spark,
        [
            ("A", "Rice", d, 100.0, 0.3, 80.0),
            ("B", "Rice", d, 100.0, None, 1.0),  # null momentum -> no rows
            ("C", "Rice", d, 100.0, 0.0, None),  # null std -> 10 % of price
        ],
    )
    p = reports.project(fe, days=30)
    assert {r.market_name for r in p.select("market_name").distinct().collect()} == {"A", "C"}
    a1 = p.where("market_name = 'A' AND step = 1").first()
    assert a1.projected_price == pytest.approx(101.0) and a1.lower == 0.0
    assert a1.forecast_date == dt.date(2024, 1, 2)
    c = p.where("market_name = 'C' AND step = 30").first()
    assert c.upper == pytest.approx(100 + 1.96 * 10)
    pt = reports.projection_point(fe).where("market_name = 'A'").first()
    assert pt.projected_30d == pytest.approx(130.0)


def test_trend_labels_and_threshold(spark):
    d0 = dt.date(2024, 1, 1)
    data = []
    for m, last in (("UP", 110.0), ("FLAT", 101.0), ("DOWN", 90.0)):
        for i in range(31):
            data.append((m, "Rice", d0 + dt.timedelta(days=i), last if i == 30 else 100.0, 0.0, 1.0))
    data += [("SHORT", "Rice", d0 + dt.timedelta(days=i), 100.0, 0.0, 1.0) for i in range(30)]
    got = {r.market_name: r.trend for r in reports.trend(_features(spark, data)).collect()}
    assert got == {"UP": "Rising", "FLAT": "Stable", "DOWN": "Falling"}


def test_latest_prices_limit_validation(spark):
    fe = _features(spark, [("A", "Rice", dt.date(2024, 1, 1), 1.0, 0.0, 0.0)])
    with pytest.raises(ValueError):
        reports.latest_prices(fe, n=501)
    assert reports.latest_prices(fe, n=1).first().price_date == "2024-01-01"


def test_modal_unit_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("Rice", "KG"), ("Rice", "BAG"), ("Rice", "KG"), ("Rice", "BAG")], "commodity_name string, unit_name string")
    assert reports.modal_unit(df).first().unit == "BAG"
