import datetime as dt

from pyspark.sql import functions as F

from harvestline.operators import models
from harvestline.operators import timeseries as ts

FAST = models.Params(n_estimators=3, max_depth=2, learning_rate=0.3, seed=42)
D0 = dt.date(2023, 1, 1)


def _features(spark, n_days=420, markets=("A", "B")):
    data = []
    for m in markets:
        for i in range(n_days):
            price = 100 + (i % 17) * 3 + (5 if m == "B" else 0)
            data.append((m, "Rice", D0 + dt.timedelta(days=i), price))
    daily = spark.createDataFrame(data, "market_name string, commodity_name string, price_date date, price_ngn int")
    daily = daily.withColumn("price_ngn", F.col("price_ngn").cast("decimal(12,2)"))
    return ts.feature_table(daily, rates=None, min_obs=50)


def test_per_commodity_training_and_forecast(spark):
    fe = _features(spark).checkpoint()
    res, forest = models.train_per_commodity(fe, horizons=(7,), params=FAST)
    (r,) = res.collect()
    assert r.commodity == "Rice" and r.train_size >= 100 and r.test_size >= 20
    assert r.model_mape is not None and r.naive_mape is not None
    assert [r.model for r in forest.bases.collect()] == ["7d:Rice"]

    # newest row of market A lacks features: the latest complete row is used,
    # the band uses the newest row's std, which is NULL -> 10 % of prediction
    last = fe.agg(F.max("price_date")).first()[0]
    broken = fe.withColumn(
        "lag_90d", F.when((F.col("market_name") == "A") & (F.col("price_date") == last), None).otherwise(F.col("lag_90d"))
    ).withColumn(
        "roll_std_30d", F.when((F.col("market_name") == "A") & (F.col("price_date") == last), None).otherwise(F.col("roll_std_30d"))
    )
    req = spark.createDataFrame(
        [("Rice", "A", 7), ("Rice", "B", 7), ("Rice", "B", 8), ("Rice", "Z", 7), ("Beans", "A", 30),
         ("Rice", "B", 6), ("Rice", "B", 31), ("Rice", "A", None)],
        "commodity string, market string, forecast_horizon_days int",
    )
    out = {(r.market, r.forecast_horizon_days, r.commodity): r for r in models.forecast(req, broken, models.by_forest(forest)).collect()}
    assert len(out) == 7  # a request without a horizon asks for 7 days
    assert out[("B", 6, "Rice")].status == out[("B", 31, "Rice")].status == "invalid_horizon"
    a = out[("A", 7, "Rice")]
    assert a.status == "ok" and a.forecast_date == last - dt.timedelta(days=1) + dt.timedelta(days=7)
    assert abs((a.upper_bound_ngn - a.predicted_price_ngn) - 1.96 * 0.1 * a.predicted_price_ngn) < 0.02
    b = out[("B", 7, "Rice")]
    assert b.lower_bound_ngn >= 0 and b.lower_bound_ngn <= b.predicted_price_ngn <= b.upper_bound_ngn
    assert out[("B", 8, "Rice")].status == "no_model_for_horizon"
    assert out[("Z", 7, "Rice")].status == "no_data"
    assert out[("A", 30, "Beans")].status == "no_data"


def test_global_model_importance_and_best(spark):
    fe = _features(spark).checkpoint()
    model, overall, per, scored = models.train_global(fe, params=FAST)
    assert overall.first().n_scored > 0 and per.count() == 1
    imp = models.importances(model, top=10)
    vals = [r.importance for r in imp.collect()]
    assert len(vals) == 10 and vals == sorted(vals, reverse=True)
    res = spark.createDataFrame(
        [("Rice", 7, 1.0, 5.0), ("Beans", 7, 2.0, -1.0), ("Rice", 30, 3.0, -2.0)],
        "commodity string, horizon int, model_mape double, mape_improvement_pct double",
    )
    best = {r.horizon: r.commodity for r in models.select_best(res).collect()}
    assert best == {7: "Rice"}


def test_v1_protocol_gates_and_split(spark):
    fe = _features(spark, n_days=300, markets=("A",)).checkpoint()
    res, forest = models.train_per_commodity_v1(fe, params=FAST)
    (r,) = res.collect()
    # 3-month test window of one daily series: roughly 90 test rows, rest train
    assert r.horizon == 7 and 80 <= r.test_size <= 95 and r.train_size >= 50
    assert r.train_size + r.test_size == fe.dropna(subset=["target_7d", *models.GLOBAL_FEATURES]).count()
    short = _features(spark, n_days=150, markets=("A",))  # < 100 usable rows -> no model
    res2, forest2 = models.train_per_commodity_v1(short, params=FAST)
    assert res2.count() == 0 and forest2.nodes.count() == 0
