"""Forecast evaluation as table operations.

The reference loops over commodities in Python and scores each with numpy;
here the predictions are unpivoted into (commodity, model, y, yhat) rows and
scored with one ``groupBy``. Metrics are reported to 6 decimals (they are
sums of doubles, and the last bits of a floating sum depend on the order
Spark combines partial aggregates).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestline.functions import winner_label
from harvestline.session import sized

DATE = "price_date"
DIGITS = 6

# The three baselines (name, prediction column), in the
# reference's order, all scored against the 7-row-ahead target.
BASELINES = [
    ("Naive (last value)", "lag_1d"),
    ("Moving Average (30d)", "roll_mean_30d"),
    ("Seasonal Naive (30d)", "lag_30d"),
]


def split_cutoff(df: DataFrame, months: int, by: Sequence[str] | None = None, date: str = DATE):
    """Cutoff = max(date) - ``months`` months, globally or per group (M1)."""
    if by:
        return df.groupBy(*by).agg(F.add_months(F.max(date), -months).alias("_cutoff"))
    return F.add_months(df.select(F.max(date)).scalar(), -months)


def temporal_split(df: DataFrame, months: int = 3, by: Sequence[str] | None = None, date: str = DATE):
    """Tag rows 'train' (date < cutoff) or 'test' (date >= cutoff) (M1)."""
    if by:
        j = df.join(sized(split_cutoff(df, months, by, date), "cutoffs"), list(by))
    else:
        j = df.withColumn("_cutoff", split_cutoff(df, months, None, date))
    tag = F.when(F.col(date) >= F.col("_cutoff"), F.lit("test")).otherwise(F.lit("train"))
    return j.withColumn("split", tag).drop("_cutoff")


def metric_aggs(y: str | Column, yhat: str | Column, zero_mape: float | None = None) -> list[Column]:
    """MAE, RMSE, MAPE (rows with y = 0 masked from MAPE only) over rows where
    both are present (A14). All-zero truths give NULL MAPE, or ``zero_mape``."""
    y = F.col(y) if isinstance(y, str) else y
    yhat = F.col(yhat) if isinstance(yhat, str) else yhat
    ok = y.isNotNull() & yhat.isNotNull()
    e = F.when(ok, y - yhat)
    ape = F.when(ok & (y != 0), F.abs(e / y))
    mape = F.avg(ape) * 100
    if zero_mape is not None:
        mape = F.when(F.count(ape) == 0, F.lit(zero_mape)).otherwise(mape)
    return [
        F.round(F.avg(F.abs(e)), DIGITS).alias("mae"),
        F.round(F.sqrt(F.avg(e * e)), DIGITS).alias("rmse"),
        F.round(mape, DIGITS).alias("mape"),
        F.count(e).alias("n_scored"),
    ]


def error_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*metric_aggs(y, yhat))


def _unpivot_models(df: DataFrame, target: str, models: Sequence[tuple[str, str]], keys):
    arr = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.lit(i).alias("model_rank"), F.col(col).cast("double").alias("yhat"))
            for i, (name, col) in enumerate(models)
        ]
    )
    return df.select(*keys, F.col(target).alias("y"), F.inline(arr))


def baseline_table(
    features: DataFrame,
    test_months: int = 3,
    min_test: int = 10,
    target: str = "target_7d",
    models: Sequence[tuple[str, str]] = BASELINES,
) -> DataFrame:
    """Per commodity with at least ``min_test`` test rows (counted before any
    null drop): MAE/RMSE/MAPE of each baseline on the test period (M2-M5)."""
    test = temporal_split(features, test_months).where(F.col("split") == "test")
    long = _unpivot_models(test, target, models, ["commodity_name"])
    g = long.groupBy(F.col("commodity_name").alias("commodity"), "model", "model_rank").agg(
        F.count(F.lit(1)).alias("test_rows"), *metric_aggs("y", "yhat")
    )
    return g.where(F.col("test_rows") >= min_test)


def summarise_models(results: DataFrame) -> DataFrame:
    """Mean MAE/RMSE/MAPE per model, rounded to 2 decimals."""
    return results.groupBy("model").agg(
        F.round(F.avg("mae"), 2).alias("avg_mae"),
        F.round(F.avg("rmse"), 2).alias("avg_rmse"),
        F.round(F.avg("mape"), 2).alias("avg_mape"),
    )


def best_model(results: DataFrame, key: str = "commodity") -> DataFrame:
    """Lowest-MAE model per commodity; NULL MAE never wins; ties go to the
    earlier model in the listed order (A16)."""
    ranked = results.where(F.col("mae").isNotNull())
    pick = F.min_by(F.struct("model", "mae", "mape"), F.struct("mae", "model_rank"))
    return ranked.groupBy(key).agg(pick.alias("b")).select(key, "b.model", "b.mae", "b.mape")


def improvement(model_mape: Column, naive_mape: Column) -> Column:
    """% MAPE improvement over naive; 0 when the naive MAPE is not positive."""
    return F.when(naive_mape > 0, (naive_mape - model_mape) / naive_mape * 100).otherwise(F.lit(0.0))


def compare(results: DataFrame, naive: DataFrame, key: str = "commodity") -> DataFrame:
    """Join model results to the naive baseline by key; improvement and
    winner label (J7, P17, O5)."""
    n = naive.select(key, F.col("mape").alias("naive_mape"), F.col("mae").alias("naive_mae"))
    j = results.join(n, key)
    imp = improvement(F.col("mape"), F.col("naive_mape"))
    return j.select(
        "*", F.round(imp, DIGITS).alias("mape_improvement_pct"), winner_label(imp).alias("winner")
    ).orderBy(F.col("mape_improvement_pct").desc(), key)


def wins(compared: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How often the model beats naive, and the mean MAPEs."""
    return compared.groupBy(*by).agg(
        F.count_if(F.col("mape_improvement_pct") > 0).alias("wins"),
        F.count(F.lit(1)).alias("models"),
        F.round(F.avg("mape"), DIGITS).alias("avg_model_mape"),
        F.round(F.avg("naive_mape"), DIGITS).alias("avg_naive_mape"),
    )
