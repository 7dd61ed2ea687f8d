"""Boosted-tree forecasting.

The reference fits XGBoost model after model in one process. Here all models of
a protocol (every commodity and horizon) are fitted together by
``boosting.fit``, and all of them score in one pass. The parameters keep their
XGBoost meanings, the regularisation terms included; trees differ in row and
column draws and in their quantile bins, so that model numbers differ; the evaluation
protocol and metric formulas are the reference's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestline.operators import boosting, evaluate
from harvestline.operators.boosting import Forest, Params, importances
from harvestline.operators.reports import latest_row
from harvestline.session import discard, sized, written

__all__ = ["Forest", "Params", "importances"]

SERIES = ["market_name", "commodity_name"]
DATE = "price_date"

# Feature lists of the global (v1) and per-commodity (v2) models.
GLOBAL_FEATURES = [
    "lag_1d", "lag_3d", "lag_7d", "lag_14d", "lag_21d", "lag_30d", "lag_60d", "lag_90d",
    "roll_mean_7d", "roll_mean_14d", "roll_mean_30d", "roll_mean_60d",
    "roll_std_7d", "roll_std_14d", "roll_std_30d", "roll_std_60d",
    "roll_min_7d", "roll_min_30d", "roll_max_7d", "roll_max_30d",
    "mom_pct_change_7d", "mom_pct_change_14d", "mom_pct_change_30d",
    "cal_month", "cal_quarter", "cal_day_of_year", "cal_week_of_year",
    "cal_is_rainy_season", "cal_is_lean_season",
]
V2_FEATURES = [
    "lag_1d", "lag_3d", "lag_7d", "lag_14d", "lag_30d", "lag_60d", "lag_90d",
    "roll_mean_7d", "roll_mean_14d", "roll_mean_30d",
    "roll_std_7d", "roll_std_14d", "roll_std_30d",
    "roll_min_7d", "roll_min_30d", "roll_max_7d", "roll_max_30d",
    "mom_pct_change_7d", "mom_pct_change_14d", "mom_pct_change_30d",
    "cal_month", "cal_quarter", "cal_day_of_year", "cal_is_rainy_season", "cal_is_lean_season",
]

# The reference's boosting parameters.
GLOBAL_PARAMS = Params(
    n_estimators=500, max_depth=6, learning_rate=0.05, subsample=0.8, colsample_bytree=0.8,
    min_child_weight=5, reg_alpha=0.1, reg_lambda=1.0, seed=42,
)
PER_COMMODITY_V1_PARAMS = Params(
    n_estimators=300, max_depth=5, learning_rate=0.05, subsample=0.8, colsample_bytree=0.8, seed=42
)
V2_PARAMS = Params(
    n_estimators=200, max_depth=4, learning_rate=0.03, subsample=0.7, colsample_bytree=0.7,
    min_child_weight=10, reg_alpha=1.0, reg_lambda=5.0, gamma=0.1, seed=42,
)
HORIZONS = (7, 30)
# The horizon that a request may ask for, and the one it gets if it names none.
HORIZON_RANGE = (7, 30)
DEFAULT_HORIZON = 7
Z = 1.96



def model_key(commodity: Column | str = "commodity_name", horizon: Column | str = "horizon") -> Column:
    """The name of the model of a commodity and horizon; null if either is."""
    commodity, horizon = (F.col(c) if isinstance(c, str) else c for c in (commodity, horizon))
    return F.concat(horizon.cast("string"), F.lit("d:"), commodity)


def _prepared(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return df.dropna(subset=[target, *features])


def train_global(
    features_df: DataFrame,
    target: str = "target_7d",
    features: Sequence[str] = GLOBAL_FEATURES,
    params: Params = GLOBAL_PARAMS,
    test_months: int = 3,
    min_commodity_rows: int = 10,
):
    """One model over all series (M6): temporal split, fit on train, score
    test overall and per commodity with at least ``min_commodity_rows`` test
    rows (A19). Returns (forest, overall metrics, per-commodity metrics,
    scored test rows)."""
    data = written(_prepared(features_df.select("commodity_name", DATE, target, *features), features, target), "features")
    split = written(evaluate.temporal_split(data, test_months).withColumn("model", F.lit("global")), "split")
    forest = boosting.fit(split.where("split = 'train'"), features, target, params)
    scored = written(boosting.score(split.where("split = 'test'"), forest, F.col("model")), "scored")
    overall = scored.agg(*evaluate.metric_aggs(target, "prediction"))
    return forest, overall, errors_by_commodity(scored, target, "prediction", min_commodity_rows), scored


def errors_by_commodity(scored: DataFrame, target: str, prediction: str, min_rows: int = 10) -> DataFrame:
    """Test errors per commodity with at least ``min_rows`` scored rows."""
    per = scored.groupBy(F.col("commodity_name").alias("commodity")).agg(
        F.count(F.lit(1)).alias("n_obs"), *evaluate.metric_aggs(target, prediction)
    )
    return per.where(F.col("n_obs") >= min_rows).select("commodity", "mae", "mape", "n_obs")


def eligible_commodities(
    features_df: DataFrame,
    target: str,
    features: Sequence[str],
    test_months: int,
    min_rows: int,
    min_train: int,
    min_test: int,
) -> DataFrame:
    """Per commodity: usable rows, train and test sizes under a per-commodity
    cutoff, and whether the size gates pass — one aggregate job."""
    data = _prepared(features_df, features, target)
    split = evaluate.temporal_split(data, test_months, by=["commodity_name"])
    g = split.groupBy("commodity_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("split") == "train").alias("train_size"),
        F.count_if(F.col("split") == "test").alias("test_size"),
    )
    ok = (F.col("rows") >= min_rows) & (F.col("train_size") >= min_train) & (F.col("test_size") >= min_test)
    return g.withColumn("eligible", ok)


RESULT = [
    "commodity", "horizon", "model_mae", "model_rmse", "model_mape", "naive_mae", "naive_mape",
    "mape_improvement_pct", "train_size", "test_size",
]


def train_per_commodity(
    features_df: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    features: Sequence[str] = V2_FEATURES,
    params: Params = V2_PARAMS,
    test_months: int = 2,
    min_rows: int = 200,
    min_train: int = 100,
    min_test: int = 20,
) -> tuple[DataFrame, Forest]:
    """One model per commodity and horizon, all fitted together, compared with
    the naive (lag_1d) forecast on the same test rows (M7b, J7). Returns
    (results, forest); the models are named by ``model_key``. Commodities that miss
    the gates get no model. v1's gates are ``min_rows=100, min_train=50,
    min_test=10, test_months=3`` with ``PER_COMMODITY_V1_PARAMS``."""
    # read for the cutoffs and the rows of each horizon, so written if it is a plan
    features_df = written(
        features_df.select("commodity_name", DATE, *[f"target_{h}d" for h in horizons], *features), "features"
    )
    parts = []
    for h in horizons:
        data = _prepared(features_df.select("commodity_name", DATE, f"target_{h}d", *features), features, f"target_{h}d")
        split = evaluate.temporal_split(data, test_months, by=["commodity_name"])
        parts.append(split.select("commodity_name", F.lit(h).alias("horizon"), "split", F.col(f"target_{h}d").alias("y"), *features))
    rows = written(reduce(DataFrame.unionByName, parts).withColumn("model", model_key()), "labelled")
    sizes = rows.groupBy("model", "commodity_name", "horizon").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("split") == "train").alias("train_size"),
        F.count_if(F.col("split") == "test").alias("test_size"),
    )
    gates = (F.col("rows") >= min_rows) & (F.col("train_size") >= min_train) & (F.col("test_size") >= min_test)
    chosen = sized(sizes.where(gates))
    gated = rows.join(chosen.select("model"), "model", "left_semi")
    forest = boosting.fit(gated.where("split = 'train'"), features, "y", params)
    scored = boosting.score(gated.where("split = 'test'"), forest, F.col("model"))
    m = evaluate.metric_aggs("y", "prediction", zero_mape=0.0)  # v2 scores all-zero truths as 0 %
    n = evaluate.metric_aggs("y", "lag_1d", zero_mape=0.0)
    g = scored.groupBy("model").agg(
        m[0].alias("model_mae"), m[1].alias("model_rmse"), m[2].alias("model_mape"),
        n[0].alias("naive_mae"), n[2].alias("naive_mape"),
    )
    imp = evaluate.improvement(F.col("model_mape"), F.col("naive_mape"))
    res = g.join(chosen, "model").withColumnRenamed("commodity_name", "commodity")
    res = res.withColumn("mape_improvement_pct", F.round(imp, evaluate.DIGITS))
    out = written(res.select(*RESULT), "results")
    discard(features_df, rows)
    return out, forest


def train_per_commodity_v1(features_df: DataFrame, params: Params = PER_COMMODITY_V1_PARAMS):
    """v1 protocol (M7a): 7-day target, the global feature list, 3-month
    split, gates >= 100 rows / train >= 50 / test >= 10, v1 parameters."""
    return train_per_commodity(
        features_df,
        horizons=(7,),
        features=GLOBAL_FEATURES,
        params=params,
        test_months=3,
        min_rows=100,
        min_train=50,
        min_test=10,
    )


def select_best(results: DataFrame) -> DataFrame:
    """Per horizon, the commodity model with the largest MAPE improvement,
    kept only when the improvement is positive (M11)."""
    pick = F.max_by(F.struct("commodity", "model_mape", "mape_improvement_pct"), F.col("mape_improvement_pct"))
    best = results.groupBy("horizon").agg(pick.alias("b")).select("horizon", "b.*")
    return best.where(F.col("mape_improvement_pct") > 0)


# Adds ``prediction`` to rows with commodity_name, horizon and the features; null without a model.
Predictor = Callable[[DataFrame], DataFrame]


def by_forest(forest: Forest) -> Predictor:
    return lambda df: boosting.score(df, forest, model_key())


def by_column(column: str, where: Column) -> Predictor:
    """A column in the models' place, such as the naive forecast."""
    return lambda df: df.withColumn("prediction", F.when(where, F.col(column).cast("double")))


def forecast(
    requests: DataFrame,
    features_df: DataFrame,
    predictor: Predictor,
    features: Sequence[str] = V2_FEATURES,
    horizons: Sequence[int] = HORIZONS,
    z: float = Z,
) -> DataFrame:
    """Batch forecast, one output row per request.

    requests: (commodity, market, forecast_horizon_days); a null horizon is 7,
    one outside 7..30 is invalid. The newest row of
    the series with every feature present is scored by the model of
    (commodity, horizon), all models in one pass; the band is ±z·roll_std_30d of the newest row of the
    series (even if that row lacks features), or ±10 % of the prediction when
    it is NULL; the lower bound is floored at 0 and all values rounded to 2
    decimals. ``status`` says why a request got no prediction.
    """
    req = requests.select(
        F.col("commodity").alias("commodity_name"),
        F.col("market").alias("market_name"),
        F.coalesce(F.col("forecast_horizon_days").cast("int"), F.lit(DEFAULT_HORIZON)).alias("horizon"),
    )
    complete = latest_row(features_df.select(*SERIES, DATE, *features), required=list(features))
    newest_std = latest_row(features_df.select(*SERIES, DATE, "roll_std_30d")).select(
        *SERIES, F.col("roll_std_30d").alias("_std")
    )
    present = features_df.select(*SERIES).distinct().withColumn("_seen", F.lit(True))
    # Distinct request keys are scored once; duplicates share the answer.
    base = (
        req.distinct()
        .join(present, SERIES, "left")
        .join(complete, SERIES, "left")
        .join(newest_std, SERIES, "left")
    )
    known = F.col("horizon").isin(list(horizons))
    answered = predictor(base).withColumn("_pred", F.when(known, F.col("prediction")))
    out = req.join(answered, ["commodity_name", "market_name", "horizon"], "left")
    std = F.coalesce(F.col("_std"), F.col("_pred") * 0.1)
    status = (
        F.when(~F.col("horizon").between(*HORIZON_RANGE), F.lit("invalid_horizon"))
        .when(~known, F.lit("no_model_for_horizon"))
        .when(F.col("_seen").isNull(), F.lit("no_data"))
        .when(F.col(DATE).isNull(), F.lit("insufficient_features"))
        .when(F.col("_pred").isNull(), F.lit("no_model"))
        .otherwise(F.lit("ok"))
    )
    version = F.concat(F.col("horizon").cast("string"), F.lit("d"))
    return out.select(
        F.col("commodity_name").alias("commodity"),
        F.col("market_name").alias("market"),
        F.date_add(F.col(DATE), F.col("horizon")).alias("forecast_date"),
        F.col("horizon").alias("forecast_horizon_days"),
        F.round(F.col("_pred"), 2).alias("predicted_price_ngn"),
        F.round(F.greatest(F.lit(0.0), F.col("_pred") - std * z), 2).alias("lower_bound_ngn"),
        F.round(F.col("_pred") + std * z, 2).alias("upper_bound_ngn"),
        F.when(F.col("_pred").isNotNull(), version).alias("model_version"),
        F.lit("NGN/kg").alias("unit"),
        status.alias("status"),
    )
