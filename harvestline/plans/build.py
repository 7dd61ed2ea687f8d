"""The reference's batch flow as one Spark job sequence, written the way it
should run on a cluster: validate the raw feeds and stop on failure, write
the unified table once and build every mart from the written copy (the
reference recomputes its staging and unified views for each consumer), write
the features partitioned by commodity, then run the mart tests and write the
baseline results.

Every intermediate lives under ``out_dir`` on shared storage, so a lost
executor only recomputes the partitions of the stage it was running and a
failed step can be resumed from the last written table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from harvestline import sinks
from harvestline.operators import evaluate, marts, quality, timeseries
from harvestline.plans import marts as pm


def _write_read(spark: SparkSession, df: DataFrame, path: str, partition_by=None) -> DataFrame:
    sinks.overwrite(df, path=path, partition_by=partition_by)
    return spark.read.parquet(path)


def build_all(
    spark: SparkSession,
    feeds: pm.RawFeeds,
    out_dir: str,
    as_of: dt.date,
    run_ts: dt.datetime,
    commodities: list[str] | None = None,
    enforce: bool = True,
) -> dict[str, str]:
    """Validate -> unified -> facts and dims -> features -> mart tests.
    Returns the written table paths. With ``enforce`` a failed raw check
    stops the run before any mart is written (Q12)."""
    raw = {
        "wfp_prices": feeds.wfp,
        "worldbank_prices": feeds.worldbank,
        "nbs_prices": feeds.nbs,
        "cbn_rates": feeds.fx,
        "weather": feeds.weather,
    }
    checks = _write_read(spark, quality.run_suites(raw, quality.SQL_CHECKS, as_of), f"{out_dir}/quality_results")
    suites = _write_read(spark, quality.run_suites(raw, quality.SUITE_CHECKS, as_of), f"{out_dir}/suite_results")
    log = quality.validation_log_row(checks, suites, run_ts)
    sinks.overwrite(log, path=f"{out_dir}/data_quality_log/run={run_ts:%Y%m%dT%H%M%S}")
    if enforce:
        quality.gate(checks.unionByName(suites))

    paths = {}
    unified = _write_read(spark, pm.unified(feeds), f"{out_dir}/unified")
    daily = _write_read(spark, marts.daily_fact(unified), f"{out_dir}/fct_daily_prices")
    outputs = {
        "fct_weekly_prices": marts.weekly_fact(daily),
        "fct_monthly_prices": marts.monthly_fact(daily),
        "dim_markets": marts.dim_markets(unified, feeds.market_seed),
        "dim_commodities": marts.dim_commodities(unified, feeds.commodity_seed),
    }
    tables = {"fct_daily_prices": daily}
    for name, df in outputs.items():
        tables[name] = _write_read(spark, df, f"{out_dir}/{name}")
    paths.update({n: f"{out_dir}/{n}" for n in ["unified", *tables]})

    tests = quality.run_suites(tables, quality.MART_CHECKS)
    tests = _write_read(spark, tests, f"{out_dir}/mart_tests")
    quality.gate(tests)

    features = timeseries.feature_table(daily, pm.fx_usd(feeds), commodities)
    sinks.write_features(features, f"{out_dir}/features")
    feats = spark.read.parquet(f"{out_dir}/features")
    sinks.overwrite(timeseries.feature_summary(feats), path=f"{out_dir}/feature_summary")
    baselines = _write_read(spark, evaluate.baseline_table(feats), f"{out_dir}/baselines")
    sinks.overwrite(evaluate.summarise_models(baselines), path=f"{out_dir}/baseline_summary")
    sinks.overwrite(evaluate.best_model(baselines), path=f"{out_dir}/best_baselines")
    results = ["features", "feature_summary", "baselines", "baseline_summary", "best_baselines"]
    paths.update({n: f"{out_dir}/{n}" for n in results})
    return paths
