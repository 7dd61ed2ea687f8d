"""Registered queries: one Spark DataFrame builder per operator ID, each with
an independent DuckDB statement (``plans.oracle``) where SQL can express it.

Every query reads the driver's tables at ``sf_dir`` in full (no subsets,
caps or samples) and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestline import sinks
from harvestline.operators import evaluate, marts, quality, reports, staging, timeseries, unify
from harvestline.plans import marts as pm
from harvestline.operators import models, registry, reshape
from harvestline.session import checkpoint_dir, written
from harvestline.plans.oracle import checks_sql, dbl, half_up_cents, in_list, lit, skey, with_ctes
from harvestline.sources import report_text, semistructured, testdata

RUN_TS = dt.datetime(2002, 1, 1)  # the load time of the queries' written tables
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return deco


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns to double for cross-engine comparison (exact: a
    2-decimal value converts to the nearest double in both engines)."""
    cols = [
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def feeds(spark: SparkSession, sf_dir: str) -> pm.RawFeeds:
    return pm.testdata_feeds(spark, sf_dir)


def shared(spark: SparkSession, sf_dir: str) -> pm.Marts:
    return pm.Marts(feeds(spark, sf_dir))


# --- marts -----------------------------------------------------------------


@register(
    "daily_fact",
    f"""
SELECT {skey("price_date", "market_name", "commodity_name")} AS price_id,
       price_date, market_name, commodity_name, category, unit_name,
       CAST(price_c AS DOUBLE) / 100 AS price_ngn,
       CAST(min_c AS DOUBLE) / 100 AS price_min_ngn,
       CAST(max_c AS DOUBLE) / 100 AS price_max_ngn,
       source_count
FROM daily_c""",
)
def q_daily_fact(spark, sf_dir):
    return plain(pm.daily(feeds(spark, sf_dir)))


# --- time series -----------------------------------------------------------


@register("feature_table", "SELECT * FROM features")
def q_feature_table(spark, sf_dir):
    return pm.features(feeds(spark, sf_dir))


@register(
    "feature_summary",
    """
SELECT market_name, commodity_name, count(price_ngn) AS obs_count,
       min(price_date) AS date_min, max(price_date) AS date_max,
       sum(CAST(round(price_ngn * 100) AS BIGINT)) / count(*) / 100 AS price_mean
FROM features GROUP BY market_name, commodity_name""",
)
def q_feature_summary(spark, sf_dir):
    return timeseries.feature_summary(pm.features(feeds(spark, sf_dir)))


# --- marts (continued) -------------------------------------------------------

_PERIOD = """
SELECT {key} AS {id_col}, {start}, market_name, commodity_name,
       CAST({avg} AS DOUBLE) / 100 AS avg_price_ngn,
       CAST(min(price_c) AS DOUBLE) / 100 AS min_price_ngn,
       CAST(max(price_c) AS DOUBLE) / 100 AS max_price_ngn,{extra}
       count(*) AS observation_count
FROM (SELECT CAST(date_trunc('{unit}', price_date) AS DATE) AS {start}, market_name, commodity_name, price_c
      FROM daily_c)
GROUP BY {start}, market_name, commodity_name"""


@register(
    "weekly_fact",
    _PERIOD.format(
        key=skey("week_start", "market_name", "commodity_name"),
        id_col="weekly_price_id",
        start="week_start",
        unit="week",
        avg=half_up_cents("sum(price_c)", "count(*)"),
        extra="",
    ),
)
def q_weekly_fact(spark, sf_dir):
    return plain(pm.weekly(feeds(spark, sf_dir)))


@register(
    "monthly_fact",
    _PERIOD.format(
        key=skey("month_start", "market_name", "commodity_name"),
        id_col="monthly_price_id",
        start="month_start",
        unit="month",
        avg=half_up_cents("sum(price_c)", "count(*)"),
        extra="\n       CAST(max(price_c) - min(price_c) AS DOUBLE) / 100 AS price_range_ngn,",
    ),
)
def q_monthly_fact(spark, sf_dir):
    return plain(pm.monthly(feeds(spark, sf_dir)))


DIM_MARKETS_SQL = """
SELECT om.market_name, sm.state, sm.geopolitical_zone, sm.latitude, sm.longitude,
       sm.market_name IS NOT NULL AS has_coordinates
FROM (SELECT DISTINCT market_name FROM unified) om
LEFT JOIN market_seed sm ON om.market_name = sm.market_name"""


@register("dim_markets", DIM_MARKETS_SQL)
def q_dim_markets(spark, sf_dir):
    return pm.markets_dim(feeds(spark, sf_dir))


@register(
    "dim_commodities",
    """
SELECT oc.commodity_name, sc.category, sc.standard_unit,
       coalesce(sc.is_staple, FALSE) AS is_staple, sc.commodity_name IS NOT NULL AS in_seed_list
FROM (SELECT DISTINCT commodity_name FROM unified) oc
LEFT JOIN commodity_seed sc ON lower(oc.commodity_name) = lower(sc.commodity_name)""",
)
def q_dim_commodities(spark, sf_dir):
    return pm.commodities_dim(feeds(spark, sf_dir))


@register(
    "unified_prices",
    f"""
SELECT price_date, market_name, commodity_name, unit_name, category,
       {dbl("price_ngn")} AS price_ngn, source
FROM unified""",
)
def q_unified_prices(spark, sf_dir):
    return plain(pm.unified(feeds(spark, sf_dir)))


@register(
    "iqr_bounds",
    """
SELECT commodity_name, q1c / 100 AS q1, q3c / 100 AS q3,
       (q1c - (q3c - q1c) * 3.0) / 100 AS lower_bound,
       (q3c + (q3c - q1c) * 3.0) / 100 AS upper_bound
FROM bounds""",
)
def q_iqr_bounds(spark, sf_dir):
    f = feeds(spark, sf_dir)
    h = unify.drop_noise(
        unify.harmonise(unify.union_sources(pm.staged(f)), f.mapping),
        excluded_markets=f.excluded_markets,
    )
    b = unify.iqr_bounds(h, "commodity_name", "price_ngn", 3.0)
    return b.select(
        "commodity_name",
        "q1",
        "q3",
        (F.col("lo_c") / 100).alias("lower_bound"),
        (F.col("hi_c") / 100).alias("upper_bound"),
    )


# --- staging ---------------------------------------------------------------


@register(
    "stg_wfp",
    f"""
SELECT market_name, commodity_name, currency_name, unit_name, {dbl("price_ngn")} AS price_ngn,
       price_date, source FROM stg_wfp""",
)
def q_stg_wfp(spark, sf_dir):
    return plain(staging.stage_wfp(testdata.raw_wfp(testdata.observations(spark, sf_dir))))


@register(
    "stg_worldbank",
    f"""
SELECT market_name, commodity_name, unit_name, {dbl("price_ngn")} AS price_ngn, price_date, source
FROM stg_worldbank""",
)
def q_stg_worldbank(spark, sf_dir):
    return plain(staging.stage_worldbank(testdata.raw_worldbank(testdata.observations(spark, sf_dir))))


@register(
    "stg_nbs",
    f"""
SELECT market_name, commodity_name, unit_name, {dbl("price_ngn")} AS price_ngn, price_date, source
FROM stg_nbs""",
)
def q_stg_nbs(spark, sf_dir):
    return plain(staging.stage_nbs(testdata.raw_nbs(testdata.observations(spark, sf_dir))))


@register(
    "stg_fx",
    f"""
SELECT rate_date, currency, {dbl("buying_rate", 4)} AS buying_rate, {dbl("central_rate", 4)} AS central_rate,
       {dbl("selling_rate", 4)} AS selling_rate, source
FROM stg_fx""",
)
def q_stg_fx(spark, sf_dir):
    return plain(staging.stage_fx(testdata.raw_fx(spark, sf_dir)))


@register(
    "stg_weather",
    f"""
SELECT market_name, weather_date, {dbl("temperature_max", 1)} AS temperature_max,
       {dbl("temperature_min", 1)} AS temperature_min,
       CAST(precipitation_mm AS DOUBLE) AS precipitation_mm, CAST(humidity_pct AS DOUBLE) AS humidity_pct, source
FROM raw_weather WHERE weather_date IS NOT NULL AND market_name IS NOT NULL""",
)
def q_stg_weather(spark, sf_dir):
    return plain(staging.stage_weather(testdata.raw_weather(spark, sf_dir)))


# --- reports ---------------------------------------------------------------

LAST_BY_COMMODITY = "(SELECT commodity_name, max(price_date) AS last_date FROM daily_c GROUP BY commodity_name)"


@register(
    "latest_prices",
    """
SELECT strftime(price_date, '%Y-%m-%d') AS price_date, market_name, commodity_name, price_ngn
FROM features ORDER BY features.price_date DESC, market_name, commodity_name LIMIT 50""",
)
def q_latest_prices(spark, sf_dir):
    return reports.latest_prices(pm.features(feeds(spark, sf_dir)), n=50)


@register("commodity_list", "SELECT DISTINCT commodity_name FROM features WHERE commodity_name IS NOT NULL")
def q_commodity_list(spark, sf_dir):
    return reports.distinct_list(pm.features(feeds(spark, sf_dir)), "commodity_name")


@register("market_list", "SELECT DISTINCT market_name FROM features WHERE market_name IS NOT NULL")
def q_market_list(spark, sf_dir):
    return reports.distinct_list(pm.features(feeds(spark, sf_dir)), "market_name")


@register(
    "market_snapshot",
    f"""
SELECT d.commodity_name, d.price_date, d.market_name, m.state, m.geopolitical_zone,
       CASE WHEN m.state IS NOT NULL THEN d.market_name || ' (' || m.state || ')' ELSE d.market_name END AS display,
       CAST(d.price_c AS DOUBLE) / 100 AS price_ngn
FROM daily_c d
JOIN {LAST_BY_COMMODITY} l ON d.commodity_name = l.commodity_name AND d.price_date = l.last_date
LEFT JOIN ({DIM_MARKETS_SQL}) m ON d.market_name = m.market_name""",
)
def q_market_snapshot(spark, sf_dir):
    m = shared(spark, sf_dir)
    return plain(reports.snapshot(m.daily, m.markets))


@register(
    "labelled_history",
    f"""
SELECT d.commodity_name, d.market_name, d.price_date, CAST(d.price_c AS DOUBLE) / 100 AS price_ngn,
       CASE WHEN m.state IS NOT NULL THEN d.market_name || ' (' || m.state || ')' ELSE d.market_name END AS label
FROM daily_c d LEFT JOIN ({DIM_MARKETS_SQL}) m ON d.market_name = m.market_name""",
)
def q_labelled_history(spark, sf_dir):
    m = shared(spark, sf_dir)
    return plain(reports.labelled_history(m.daily, m.markets))


@register(
    "snapshot_kpis",
    f"""
SELECT d.commodity_name, d.price_date, count(*) AS markets,
       sum(d.price_c) / count(*) / 100 AS avg_price,
       CAST(min(d.price_c) AS DOUBLE) / 100 AS min_price, CAST(max(d.price_c) AS DOUBLE) / 100 AS max_price
FROM daily_c d
JOIN {LAST_BY_COMMODITY} l ON d.commodity_name = l.commodity_name AND d.price_date = l.last_date
GROUP BY d.commodity_name, d.price_date""",
)
def q_snapshot_kpis(spark, sf_dir):
    return plain(reports.snapshot_kpis(reports.latest_per_commodity(shared(spark, sf_dir).daily)))


@register(
    "state_averages",
    f"""
SELECT d.commodity_name, m.state, m.geopolitical_zone,
       sum(d.price_c) / count(*) / 100 AS avg_price, count(*) AS observations
FROM daily_c d
JOIN {LAST_BY_COMMODITY} l ON d.commodity_name = l.commodity_name
LEFT JOIN ({DIM_MARKETS_SQL}) m ON d.market_name = m.market_name
WHERE d.price_date >= l.last_date - INTERVAL 3 MONTH AND m.state IS NOT NULL AND m.geopolitical_zone IS NOT NULL
GROUP BY d.commodity_name, m.state, m.geopolitical_zone""",
)
def q_state_averages(spark, sf_dir):
    m = shared(spark, sf_dir)
    return reports.state_averages(m.daily, m.markets, months=3)


@register(
    "modal_unit",
    """
SELECT commodity_name, unit FROM (
  SELECT commodity_name, unit_name AS unit,
         row_number() OVER (PARTITION BY commodity_name ORDER BY count(*) DESC, unit_name) AS rn
  FROM daily_c WHERE unit_name IS NOT NULL GROUP BY commodity_name, unit_name)
WHERE rn = 1""",
)
def q_modal_unit(spark, sf_dir):
    return reports.modal_unit(pm.daily(feeds(spark, sf_dir)))


TOP_MARKET_SQL = """
SELECT commodity_name, market_name, n AS rows FROM (
  SELECT commodity_name, market_name, count(*) AS n,
         row_number() OVER (PARTITION BY commodity_name ORDER BY count(*) DESC, market_name) AS rn
  FROM features GROUP BY commodity_name, market_name)
WHERE rn = 1"""


@register("top_market", TOP_MARKET_SQL)
def q_top_market(spark, sf_dir):
    return reports.top_market(pm.features(feeds(spark, sf_dir)))


@register(
    "forecast_history",
    f"""
SELECT commodity_name, market_name, price_date, price_ngn, roll_mean_30d FROM (
  SELECT f.commodity_name, f.market_name, f.price_date, f.price_ngn, f.roll_mean_30d,
         row_number() OVER (PARTITION BY f.market_name, f.commodity_name ORDER BY f.price_date DESC) AS rn
  FROM features f JOIN ({TOP_MARKET_SQL}) t
    ON f.commodity_name = t.commodity_name AND f.market_name = t.market_name)
WHERE rn <= 180""",
)
def q_forecast_history(spark, sf_dir):
    fe = shared(spark, sf_dir).features
    top = reports.top_market(fe).select("commodity_name", "market_name")
    picked = fe.join(top, ["commodity_name", "market_name"])
    rec = reports.recent_rows(picked, n=180)
    return rec.select("commodity_name", "market_name", "price_date", "price_ngn", "roll_mean_30d")


@register(
    "price_trend",
    """
SELECT market_name, commodity_name, latest_date, cur / 100 AS current_price, prev / 100 AS price_n_rows_ago,
       (cur - prev) / prev * 100 AS change_pct,
       CASE WHEN (cur - prev) / prev * 100 > 2.0 THEN 'Rising'
            WHEN (cur - prev) / prev * 100 < -2.0 THEN 'Falling' ELSE 'Stable' END AS trend
FROM (
  SELECT market_name, commodity_name,
         max(CASE WHEN rn = 1 THEN price_date END) AS latest_date,
         max(CASE WHEN rn = 1 THEN c END) AS cur, max(CASE WHEN rn = 30 THEN c END) AS prev
  FROM (SELECT market_name, commodity_name, price_date, CAST(round(price_ngn * 100) AS BIGINT) AS c,
               row_number() OVER (PARTITION BY market_name, commodity_name ORDER BY price_date DESC) AS rn,
               count(*) OVER (PARTITION BY market_name, commodity_name) AS size
        FROM features)
  WHERE rn IN (1, 30) AND size > 30
  GROUP BY market_name, commodity_name)""",
)
def q_price_trend(spark, sf_dir):
    return reports.trend(pm.features(feeds(spark, sf_dir)), n=30)


LAST_FEATURE_ROW = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY market_name, commodity_name ORDER BY price_date DESC) AS rn
               FROM features) WHERE rn = 1"""


@register(
    "price_projection",
    f"""
SELECT market_name, commodity_name, CAST(price_date + CAST(i AS INTEGER) AS DATE) AS forecast_date,
       CAST(i AS INTEGER) AS step,
       price_ngn * (mom_pct_change_30d / 30 * i + 1) AS projected_price,
       greatest(CAST(0.0 AS DOUBLE), price_ngn * (mom_pct_change_30d / 30 * i + 1)
                - coalesce(roll_std_30d, price_ngn * CAST(0.1 AS DOUBLE)) * CAST(1.96 AS DOUBLE)) AS lower,
       price_ngn * (mom_pct_change_30d / 30 * i + 1)
                + coalesce(roll_std_30d, price_ngn * CAST(0.1 AS DOUBLE)) * CAST(1.96 AS DOUBLE) AS upper
FROM (SELECT *, unnest(range(1, 31)) AS i FROM ({LAST_FEATURE_ROW}) l WHERE mom_pct_change_30d IS NOT NULL) s""",
)
def q_price_projection(spark, sf_dir):
    return reports.project(pm.features(feeds(spark, sf_dir)), days=30)


@register(
    "projection_point",
    f"""
SELECT market_name, commodity_name, price_date AS latest_date,
       price_ngn * (mom_pct_change_30d + 1) AS projected_30d
FROM ({LAST_FEATURE_ROW}) l WHERE mom_pct_change_30d IS NOT NULL""",
)
def q_projection_point(spark, sf_dir):
    return reports.projection_point(pm.features(feeds(spark, sf_dir)))


@register(
    "source_counts",
    """
SELECT 'WFP' AS source, count(*) AS rows FROM raw_wfp
UNION ALL SELECT 'World Bank', count(*) FROM raw_worldbank
UNION ALL SELECT 'NBS', count(*) FROM raw_nbs
UNION ALL SELECT 'CBN (FX)', count(*) FROM raw_fx
UNION ALL SELECT 'Weather', count(*) FROM raw_weather
UNION ALL SELECT 'Total', CAST((SELECT count(*) FROM raw_wfp) + (SELECT count(*) FROM raw_worldbank)
  + (SELECT count(*) FROM raw_nbs) + (SELECT count(*) FROM raw_fx) + (SELECT count(*) FROM raw_weather) AS BIGINT)""",
)
def q_source_counts(spark, sf_dir):
    f = feeds(spark, sf_dir)
    return reports.source_counts(
        {"WFP": f.wfp, "World Bank": f.worldbank, "NBS": f.nbs, "CBN (FX)": f.fx, "Weather": f.weather},
        total="Total",
    )


@register(
    "freshness",
    """
SELECT 'WFP' AS source, CAST(max(price_date) AS VARCHAR) AS latest FROM raw_wfp
UNION ALL SELECT 'World Bank', CAST(max(price_date) AS VARCHAR) FROM raw_worldbank
UNION ALL SELECT 'NBS', CAST(max(report_month) AS VARCHAR) FROM raw_nbs""",
)
def q_freshness(spark, sf_dir):
    f = feeds(spark, sf_dir)
    return reports.freshness(
        {"WFP": (f.wfp, "price_date"), "World Bank": (f.worldbank, "price_date"), "NBS": (f.nbs, "report_month")}
    )


@register(
    "distinct_counts",
    """
SELECT count(DISTINCT market_name) AS n_market_name, count(DISTINCT commodity_name) AS n_commodity_name,
       count(DISTINCT source) AS n_source
FROM unified""",
)
def q_distinct_counts(spark, sf_dir):
    return reports.distinct_counts(pm.unified(feeds(spark, sf_dir)), ["market_name", "commodity_name", "source"])


@register(
    "latest_features",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY market_name, commodity_name ORDER BY price_date DESC) AS rn
  FROM features WHERE lag_1d IS NOT NULL AND lag_90d IS NOT NULL AND roll_std_30d IS NOT NULL
    AND mom_pct_change_30d IS NOT NULL)
WHERE rn = 1""",
)
def q_latest_features(spark, sf_dir):
    fe = pm.features(feeds(spark, sf_dir))
    req = ["lag_1d", "lag_90d", "roll_std_30d", "mom_pct_change_30d"]
    return reports.latest_row(fe, required=req).select(*fe.columns)


# --- evaluation ------------------------------------------------------------

_TEST = "(SELECT * FROM features WHERE price_date >= (SELECT max(price_date) FROM features) - INTERVAL 3 MONTH)"


def _baseline_sql() -> str:
    arms = "\nUNION ALL\n".join(
        f"SELECT commodity_name, target_7d AS y, {lit(name)} AS model, {i} AS model_rank, "
        f"CAST({col} AS DOUBLE) AS yhat FROM {_TEST} t"
        for i, (name, col) in enumerate(evaluate.BASELINES)
    )
    ok = "y IS NOT NULL AND yhat IS NOT NULL"
    return f"""
SELECT commodity_name AS commodity, model, model_rank, count(*) AS test_rows,
       round(avg(CASE WHEN {ok} THEN abs(y - yhat) END), 6) AS mae,
       round(sqrt(avg(CASE WHEN {ok} THEN (y - yhat) * (y - yhat) END)), 6) AS rmse,
       round(avg(CASE WHEN {ok} AND y <> 0 THEN abs((y - yhat) / y) END) * 100, 6) AS mape,
       count(CASE WHEN {ok} THEN y - yhat END) AS n_scored
FROM ({arms}) long
GROUP BY commodity_name, model, model_rank
HAVING count(*) >= 10"""


BASELINE_SQL = _baseline_sql()


def baselines(spark, sf_dir):
    return evaluate.baseline_table(shared(spark, sf_dir).features, test_months=3, min_test=10)


@register(
    "temporal_split",
    """
SELECT CASE WHEN price_date >= (SELECT max(price_date) FROM features) - INTERVAL 3 MONTH
            THEN 'test' ELSE 'train' END AS split,
       count(*) AS rows, min(price_date) AS first_date, max(price_date) AS last_date
FROM features GROUP BY 1""",
)
def q_temporal_split(spark, sf_dir):
    s = evaluate.temporal_split(shared(spark, sf_dir).features, months=3)
    return s.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min("price_date").alias("first_date"), F.max("price_date").alias("last_date")
    )


@register(
    "temporal_split_by_commodity",
    """
SELECT f.commodity_name, CASE WHEN f.price_date >= c.cut THEN 'test' ELSE 'train' END AS split, count(*) AS rows
FROM features f JOIN (SELECT commodity_name, max(price_date) - INTERVAL 2 MONTH AS cut FROM features GROUP BY 1) c
  ON f.commodity_name = c.commodity_name
GROUP BY 1, 2""",
)
def q_temporal_split_by_commodity(spark, sf_dir):
    s = evaluate.temporal_split(shared(spark, sf_dir).features, months=2, by=["commodity_name"])
    return s.groupBy("commodity_name", "split").agg(F.count(F.lit(1)).alias("rows"))


@register("baseline_table", BASELINE_SQL)
def q_baseline_table(spark, sf_dir):
    return baselines(spark, sf_dir)


@register(
    "baseline_summary",
    f"""
SELECT model, round(avg(mae), 2) AS avg_mae, round(avg(rmse), 2) AS avg_rmse, round(avg(mape), 2) AS avg_mape
FROM ({BASELINE_SQL}) b GROUP BY model""",
)
def q_baseline_summary(spark, sf_dir):
    return evaluate.summarise_models(baselines(spark, sf_dir))


@register(
    "best_baseline",
    f"""
SELECT commodity, model, mae, mape FROM (
  SELECT *, row_number() OVER (PARTITION BY commodity ORDER BY mae, model_rank) AS rn
  FROM ({BASELINE_SQL}) b WHERE mae IS NOT NULL)
WHERE rn = 1""",
)
def q_best_baseline(spark, sf_dir):
    return evaluate.best_model(baselines(spark, sf_dir))


_COMPARE_SQL = f"""
SELECT b.commodity, b.model, b.mape, n.mape AS naive_mape, n.mae AS naive_mae,
       round(CASE WHEN n.mape > 0 THEN (n.mape - b.mape) / n.mape * 100 ELSE 0.0 END, 6) AS mape_improvement_pct,
       CASE WHEN (CASE WHEN n.mape > 0 THEN (n.mape - b.mape) / n.mape * 100 ELSE 0.0 END) > 0
            THEN 'ML Model' ELSE 'Simple baseline' END AS winner
FROM ({BASELINE_SQL}) b JOIN ({BASELINE_SQL}) n ON b.commodity = n.commodity
WHERE b.model_rank > 0 AND n.model_rank = 0"""


def _compared(spark, sf_dir):
    b = written(baselines(spark, sf_dir), "baselines")
    naive = b.where(F.col("model_rank") == 0)
    others = b.where(F.col("model_rank") > 0).select("commodity", "model", "mape")
    return evaluate.compare(others, naive)


@register("baseline_vs_naive", _COMPARE_SQL)
def q_baseline_vs_naive(spark, sf_dir):
    return _compared(spark, sf_dir)


@register(
    "baseline_wins",
    f"""
SELECT model, count(*) FILTER (WHERE mape_improvement_pct > 0) AS wins, count(*) AS models,
       round(avg(mape), 6) AS avg_model_mape, round(avg(naive_mape), 6) AS avg_naive_mape
FROM ({_COMPARE_SQL}) c GROUP BY model""",
)
def q_baseline_wins(spark, sf_dir):
    return evaluate.wins(_compared(spark, sf_dir), by=["model"])


# --- quality ---------------------------------------------------------------

_RAW_VIEWS = {
    "wfp_prices": "raw_wfp",
    "worldbank_prices": "raw_worldbank",
    "nbs_prices": "raw_nbs",
    "cbn_rates": "raw_fx",
    "weather": "raw_weather",
}


def _raw_tables(spark, sf_dir):
    f = feeds(spark, sf_dir)
    return {
        "wfp_prices": f.wfp,
        "worldbank_prices": f.worldbank,
        "nbs_prices": f.nbs,
        "cbn_rates": f.fx,
        "weather": f.weather,
    }


def _suite_sql(suites, views) -> str:
    return "\nUNION ALL\n".join(
        checks_sql(views[t], t, suites[t], testdata.AS_OF) for t in views if t in suites
    )


@register("quality_sql_checks", _suite_sql(quality.SQL_CHECKS, _RAW_VIEWS))
def q_quality_sql_checks(spark, sf_dir):
    return quality.run_suites(_raw_tables(spark, sf_dir), quality.SQL_CHECKS, testdata.AS_OF)


@register("quality_suites", _suite_sql(quality.SUITE_CHECKS, _RAW_VIEWS))
def q_quality_suites(spark, sf_dir):
    return quality.run_suites(_raw_tables(spark, sf_dir), quality.SUITE_CHECKS, testdata.AS_OF)


@register("quality_json_suites", _suite_sql(quality.JSON_SUITE_CHECKS, _RAW_VIEWS))
def q_quality_json_suites(spark, sf_dir):
    """The stored JSON suites' value checks (Q1-Q3, Q6) over the raw feeds."""
    return quality.run_suites(_raw_tables(spark, sf_dir), quality.JSON_SUITE_CHECKS)


def _validation_sql() -> str:
    sql = _suite_sql(quality.SQL_CHECKS, _RAW_VIEWS)
    gx = _suite_sql(quality.SUITE_CHECKS, _RAW_VIEWS)
    ts = testdata.AS_OF.isoformat()
    return f"""
SELECT 'post_ingestion_validation' AS suite_name, TIMESTAMP '{ts} 00:00:00' AS run_date,
       sql_failed + gx_failed = 0 AS success,
       to_json(struct_pack(sql_passed := sql_passed, sql_failed := sql_failed, gx_passed := gx_passed,
                           gx_failed := gx_failed, total_passed := sql_passed + gx_passed,
                           total_failed := sql_failed + gx_failed))::VARCHAR AS statistics,
       format('SQL: {{}} passed, {{}} failed | GX: {{}} passed, {{}} failed', sql_passed, sql_failed, gx_passed, gx_failed)
         AS results_summary
FROM (
  SELECT count(*) FILTER (WHERE kind = 'sql' AND passed) AS sql_passed,
         count(*) FILTER (WHERE kind = 'sql' AND NOT passed) AS sql_failed,
         count(*) FILTER (WHERE kind = 'gx' AND passed) AS gx_passed,
         count(*) FILTER (WHERE kind = 'gx' AND NOT passed) AS gx_failed
  FROM (SELECT 'sql' AS kind, passed FROM ({sql}) s
        UNION ALL
        SELECT 'gx' AS kind, bool_and(passed) AS passed FROM ({gx}) g GROUP BY table_name) u) c"""


@register("validation_log", _validation_sql())
def q_validation_log(spark, sf_dir):
    """The post-ingestion validation log row over the raw feeds (K4, Q11)."""
    raw = _raw_tables(spark, sf_dir)
    sql = quality.run_suites(raw, quality.SQL_CHECKS, testdata.AS_OF)
    gx = quality.run_suites(raw, quality.SUITE_CHECKS, testdata.AS_OF)
    run_ts = dt.datetime.combine(testdata.AS_OF, dt.time())
    return quality.validation_log_row(sql, gx, run_ts)


_MART_VIEWS = {
    "fct_daily_prices": f"""(SELECT {skey("price_date", "market_name", "commodity_name")} AS price_id,
        price_date, market_name, commodity_name, price_c AS price_ngn FROM daily_c)""",
    "fct_weekly_prices": f"""(SELECT DISTINCT {skey("CAST(date_trunc('week', price_date) AS DATE)", "market_name", "commodity_name")}
        AS weekly_price_id FROM daily_c)""",
    "fct_monthly_prices": f"""(SELECT DISTINCT {skey("CAST(date_trunc('month', price_date) AS DATE)", "market_name", "commodity_name")}
        AS monthly_price_id FROM daily_c)""",
    "dim_markets": "(SELECT DISTINCT market_name FROM unified)",
    "dim_commodities": "(SELECT DISTINCT commodity_name FROM unified)",
}


@register("mart_tests", _suite_sql(quality.MART_CHECKS, _MART_VIEWS))
def q_mart_tests(spark, sf_dir):
    m = shared(spark, sf_dir)
    tables = {
        "fct_daily_prices": m.daily,
        "fct_weekly_prices": marts.weekly_fact(m.daily),
        "fct_monthly_prices": marts.monthly_fact(m.daily),
        "dim_markets": m.markets,
        "dim_commodities": m.commodities,
    }
    return quality.run_suites(tables, quality.MART_CHECKS)


@register(
    "price_stats",
    """
SELECT 'wfp_prices' AS table_name, CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
       sum(CAST(price * 100 AS BIGINT)) / count(price) / 100 AS avg_price FROM raw_wfp WHERE price IS NOT NULL
UNION ALL
SELECT 'worldbank_prices', CAST(min(price) AS DOUBLE), CAST(max(price) AS DOUBLE),
       sum(CAST(price * 100 AS BIGINT)) / count(price) / 100 FROM raw_worldbank WHERE price IS NOT NULL
UNION ALL
SELECT 'nbs_prices', CAST(min(price) AS DOUBLE), CAST(max(price) AS DOUBLE),
       sum(CAST(price * 100 AS BIGINT)) / count(price) / 100 FROM raw_nbs WHERE price IS NOT NULL""",
)
def q_price_stats(spark, sf_dir):
    f = feeds(spark, sf_dir)
    parts = [
        plain(quality.price_stats(df)).select(F.lit(name).alias("table_name"), "*")
        for name, df in (("wfp_prices", f.wfp), ("worldbank_prices", f.worldbank), ("nbs_prices", f.nbs))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- semi-structured and text sources --------------------------------------

# Report months already known to the extractor.
KNOWN_REPORT_MONTHS = ["2024-11", "2024-12", "2025-02", "2025-04"]
PRICE_RE = report_text.PRICE_PATTERN


@register(
    "api_items",
    """
SELECT event_id, CAST(event_id % 3 + 1 AS INTEGER) AS total_pages, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE props IS NOT NULL
UNION ALL SELECT event_id, CAST(event_id % 3 + 1 AS INTEGER), event_id FROM events WHERE props IS NOT NULL""",
)
def q_api_items(spark, sf_dir):
    ev = testdata.table(spark, sf_dir, "events")
    docs = ev.select("event_id", F.concat(
            F.lit('{"items": ['), "props", F.lit(', {"k": '), F.col("event_id").cast("string"),
            F.lit('}], "totalPages": '), (F.col("event_id") % 3 + 1).cast("string"), F.lit("}"),
        ).alias("doc"))
    item = T.StructType([T.StructField("k", T.LongType(), True)])
    return semistructured.explode_items(docs, "doc", item, keep=["event_id"])


_RATE = "CAST(json_extract(props, '$.k') AS DOUBLE)"


def _rates_sql(date: str, rate: str) -> str:
    return f"""SELECT event_id, {date} AS rate_date, 'USD' AS currency, {rate} * CAST(0.99 AS DOUBLE) AS buying_rate,
       {rate} AS central_rate, {rate} * CAST(1.01 AS DOUBLE) AS selling_rate
FROM events WHERE {rate} <> 0"""


@register(
    "rate_map",
    _rates_sql("CAST(ts AS DATE)", _RATE)
    + "\nUNION ALL\n"
    + _rates_sql("CAST(ts AS DATE) + 1", "CAST(event_id % 5 AS DOUBLE)"),
)
def q_rate_map(spark, sf_dir):
    """Two dates a document; the second's rate is 0 in every fifth one, which is no quote."""
    day = F.col("ts").cast("date")
    doc = F.concat(
        F.lit('{"rates": {"'), day.cast("string"), F.lit('": {"NGN": '), F.get_json_object("props", "$.k"),
        F.lit('}, "'), F.date_add(day, 1).cast("string"), F.lit('": {"NGN": '), (F.col("event_id") % 5).cast("string"),
        F.lit(', "EUR": 2}}}'),
    )
    ev = testdata.table(spark, sf_dir, "events")
    return semistructured.explode_rate_map(ev.select("event_id", doc.alias("doc")), "doc", keep=["event_id"])


# Report pages and catalogue pages are laid out from the given tables: a page
# per part, zonal, national or neither by its key, with its name and prices.
_CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


def _money_sql(cents: str) -> str:
    return f"CAST(({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0')"


_ZONAL_LINE = " || ' ' || ".join(["p_name || ' grade ' || p_brand", *[_money_sql(f"{_CENTS} + {7 * i}") for i in range(7)]])
_NATIONAL_LINE = " || ' ' || ".join(
    ["p_name || ' of size'", _money_sql(f"{_CENTS} - 850"), "'1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.50'", "'12.40 3.75'"]
)
_PAGES = f"""(SELECT p_partkey AS doc_id, CASE p_partkey % 3
  WHEN 0 THEN 'APPENDIX' || chr(10) || 'Item Label NORTH CENTRAL NORTH EAST NORTH WEST SOUTH EAST' || chr(10) ||
       {_ZONAL_LINE} || chr(10) || 'short 1.00' || chr(10) || upper({_ZONAL_LINE})
  WHEN 1 THEN 'Selected items Beans Garri, Item Label, MoM and Year - on - Year change in per cent' || chr(10) ||
       {_NATIONAL_LINE} || chr(10) || 'Average of 12.00 13.00 14.00 in all' || chr(10) || '123 ' || {_NATIONAL_LINE}
  ELSE 'Notes on the method, without a table: ' || {_ZONAL_LINE} END AS text FROM part)"""


def _money(cents):
    return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def _docs(spark, sf_dir):
    """The report pages (doc_id, text)."""
    c = F.round(F.col("p_retailprice") * 100).cast("bigint")
    zonal = F.concat_ws(
        " ", F.concat("p_name", F.lit(" grade "), "p_brand"), *[_money(c + 7 * i) for i in range(7)]
    )
    national = F.concat_ws(
        " ",
        F.concat("p_name", F.lit(" of size")),
        _money(c - 850),
        F.concat(F.lit("1,"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit(".50")),
        F.lit("12.40 3.75"),
    )
    kind = F.col("p_partkey") % 3
    text = (
        F.when(
            kind == 0,
            F.concat_ws(
                "\n",
                F.lit("APPENDIX"),
                F.lit("Item Label NORTH CENTRAL NORTH EAST NORTH WEST SOUTH EAST"),
                zonal,
                F.lit("short 1.00"),
                F.upper(zonal),
            ),
        )
        .when(
            kind == 1,
            F.concat_ws(
                "\n",
                F.lit("Selected items Beans Garri, Item Label, MoM and Year - on - Year change in per cent"),
                national,
                F.lit("Average of 12.00 13.00 14.00 in all"),
                F.concat(F.lit("123 "), national),
            ),
        )
        .otherwise(F.concat(F.lit("Notes on the method, without a table: "), zonal))
    )
    pages = testdata.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), text.alias("text"))
    return written(pages, "report_pages")  # the layout is long: parsers read it as text


_ZONE_HITS = " + ".join(
    f"CAST(contains(upper(text), {lit(z)}) AS INTEGER)" for z in report_text.ZONE_HEADER_PATTERNS
)
_CLASSES = f"""
SELECT doc_id, text, zone_headers, is_zonal,
       NOT is_zonal AND (contains(text, 'MoM') OR contains(replace(text, ' ', ''), 'Month-on-Month'))
       AND (contains(text, 'YoY') OR contains(replace(text, ' ', ''), 'Year-on-Year'))
       AND ({" OR ".join(f"contains(text, {lit(i)})" for i in report_text.NATIONAL_ITEMS)}) AS is_national
FROM (SELECT doc_id, text, {_ZONE_HITS} AS zone_headers,
             ({_ZONE_HITS}) >= 3 AND (contains(text, 'Item Label') OR contains(text, 'APPENDIX')) AS is_zonal
      FROM {_PAGES} pages WHERE length(text) >= {report_text.MIN_PAGE_CHARS})"""


@register("page_classes", f"SELECT doc_id, zone_headers, is_zonal, is_national FROM ({_CLASSES}) c")
def q_page_classes(spark, sf_dir):
    return report_text.classify_pages(_docs(spark, sf_dir)).select(
        "doc_id", "zone_headers", "is_zonal", "is_national"
    )


def _lines_sql(src: str, cond: str) -> str:
    return f"""
(SELECT doc_id, line_no, line, prices,
        CASE WHEN len(prices) > 0 THEN
             regexp_replace(substring(line, 1, instr(line, prices[1]) - 1), '^\\s+|\\s+$', '', 'g') END AS commodity_name
 FROM (SELECT doc_id, line_no, line, regexp_extract_all(line, '{PRICE_RE}') AS prices
       FROM (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no,
                    unnest(string_split(text, chr(10))) AS line FROM {src}) l
       WHERE {cond}) p)"""


_ZONAL_COND = (
    f"NOT contains(line, 'Item Label') AND NOT contains(upper(line), 'NORTH') "
    f"AND length(line) >= {report_text.MIN_LINE_CHARS} AND NOT contains(line, 'APPENDIX')"
)
_NATIONAL_COND = (
    f"NOT contains(line, 'Item Label') AND NOT contains(line, 'Average of') "
    f"AND length(line) >= {report_text.MIN_LINE_CHARS}"
)
_VALID = "length(commodity_name) > 0 AND NOT regexp_matches(commodity_name, '^[0-9]+$')"
_ZONE_LIST = "[" + ", ".join(lit(z) for z in report_text.ZONES) + "]"


def _zonal_sql(src: str) -> str:
    return f"""
SELECT doc_id, line_no, commodity_name, {_ZONE_LIST}[i] AS zone,
       CAST(replace(prices[i], ',', '') AS DOUBLE) AS price
FROM (SELECT *, unnest(range(1, 7)) AS i FROM {_lines_sql(src, _ZONAL_COND)} n
      WHERE len(prices) >= 6 AND {_VALID}) z"""


def _national_sql(src: str) -> str:
    return f"""
SELECT doc_id, line_no, commodity_name, 'National' AS zone, price FROM (
  SELECT doc_id, line_no, commodity_name,
         list_filter(list_transform(prices[1:4], lambda x: CAST(replace(x, ',', '') AS DOUBLE)),
                     lambda v: v >= 50 AND v <= 50000)[-1] AS price
  FROM {_lines_sql(src, _NATIONAL_COND)} n
  WHERE len(prices) >= 2 AND {_VALID}) q
WHERE price IS NOT NULL AND price <> 0"""


@register("zonal_lines", _zonal_sql(f"{_PAGES} pages"))
def q_zonal_lines(spark, sf_dir):
    return report_text.parse_zonal_lines(_docs(spark, sf_dir))


@register("national_lines", _national_sql(f"{_PAGES} pages"))
def q_national_lines(spark, sf_dir):
    return report_text.parse_national_lines(_docs(spark, sf_dir))


@register(
    "report_prices",
    _zonal_sql(f"(SELECT * FROM ({_CLASSES}) c WHERE is_zonal)")
    + "\nUNION ALL\n"
    + _national_sql(f"(SELECT * FROM ({_CLASSES}) c WHERE is_national)"),
)
def q_report_prices(spark, sf_dir):
    return report_text.extract_prices(_docs(spark, sf_dir))


_MONTHS_SQL = "[" + ", ".join(lit(m) for m in report_text.MONTHS) + "]"
# Each page of the catalogue links its own report (of a month that its number
# gives, every ninth without one) and the next page's.
_CATALOGUE = f"""(SELECT page_id, html || '<a href="/catalog/162/download/' || page_id || '/prices_' ||
  CASE WHEN page_id % 9 = 0 THEN 'annual' ELSE {_MONTHS_SQL}[page_id % 12 + 1] || (20 + page_id % 6) END ||
  '.pdf">report</a> <a href=/catalog/162/download/' || (page_id + 1) || '>next</a>' AS html FROM pages)"""
_LINK_RE = report_text.CATALOGUE_LINK.replace("'", "''")
_LINKS_SQL = f"""
SELECT page_id, CAST(generate_subscripts(ids, 1) - 1 AS INTEGER) AS link_no, unnest(ids) AS resource_id, unnest(rests) AS link_rest
FROM (SELECT page_id, regexp_extract_all(html, '{_LINK_RE}', 1) AS ids,
             regexp_extract_all(html, '{_LINK_RE}', 2) AS rests FROM {_CATALOGUE} c) p"""


def _links(spark, sf_dir):
    n = F.col("page_id")
    month = F.get(F.array(*[F.lit(m) for m in report_text.MONTHS]), (n % 12).cast("int"))
    name = F.when(n % 9 == 0, "annual").otherwise(F.concat(month, (n % 6 + 20).cast("string")))
    html = F.concat(
        "html", F.lit('<a href="/catalog/162/download/'), n.cast("string"), F.lit("/prices_"), name,
        F.lit('.pdf">report</a> <a href=/catalog/162/download/'), (n + 1).cast("string"), F.lit(">next</a>"),
    )
    pages = testdata.table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return report_text.extract_links(pages, "html")


@register("report_links", _LINKS_SQL)
def q_report_links(spark, sf_dir):
    return _links(spark, sf_dir)


_MONTH_RE = "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)([0-9]{2})"
_MONTH_LIST = "[" + ", ".join(lit(m) for m in report_text.MONTHS) + "]"


@register(
    "report_months",
    f"""
SELECT month_key, arg_min(resource_id, page_id * 100000 + link_no) AS resource_id FROM (
  SELECT CASE WHEN length(regexp_extract(link_rest, '{_MONTH_RE}', 1)) > 0 THEN
           '20' || regexp_extract(link_rest, '{_MONTH_RE}', 2) || '-' ||
           lpad(CAST(list_position({_MONTH_LIST}, regexp_extract(link_rest, '{_MONTH_RE}', 1)) AS VARCHAR), 2, '0')
         END AS month_key, resource_id, page_id, link_no
  FROM ({_LINKS_SQL}) l) m
WHERE month_key IS NOT NULL AND month_key NOT IN {in_list(KNOWN_REPORT_MONTHS)}
GROUP BY month_key""",
)
def q_report_months(spark, sf_dir):
    known = spark.createDataFrame([(m,) for m in KNOWN_REPORT_MONTHS], "month_key string")
    return report_text.discover_reports(_links(spark, sf_dir), known)


# --- reshape ---------------------------------------------------------------

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
TYPE_NAMES = {t: t.title() + " part" for t in PART_TYPES}


@register(
    "wide_to_long",
    "\nUNION ALL\n".join(
        f"SELECT p_brand, {lit(TYPE_NAMES[t])} AS commodity_name, price FROM "
        f"(SELECT p_brand, max(CASE WHEN p_type = {lit(t)} THEN p_retailprice END) AS price FROM part GROUP BY p_brand) w "
        f"WHERE price IS NOT NULL"
        for t in PART_TYPES
    ),
)
def q_wide_to_long(spark, sf_dir):
    part = testdata.table(spark, sf_dir, "part")
    wide = part.groupBy("p_brand").pivot("p_type", PART_TYPES).agg(F.max("p_retailprice"))
    return reshape.wide_to_long(wide, ["p_brand"], TYPE_NAMES, value_col="price")


@register(
    "wide_to_long_paired",
    "\nUNION ALL\n".join(
        f"SELECT p_brand, {lit(TYPE_NAMES[t])} AS commodity_name, price, confidence FROM "
        f"(SELECT p_brand, max(CASE WHEN p_type = {lit(t)} THEN p_retailprice END) AS price, "
        f"CAST(count(CASE WHEN p_type = {lit(t)} THEN 1 END) AS DOUBLE) AS confidence FROM part GROUP BY p_brand) w "
        f"WHERE price IS NOT NULL"
        for t in PART_TYPES
    ),
)
def q_wide_to_long_paired(spark, sf_dir):
    part = testdata.table(spark, sf_dir, "part")
    aggs = []
    for t in PART_TYPES:
        hit = F.col("p_type") == t
        aggs += [F.max(F.when(hit, F.col("p_retailprice"))).alias(t), F.count(F.when(hit, 1)).alias("c_" + t)]
    wide = part.groupBy("p_brand").agg(*aggs)
    return reshape.wide_to_long_paired(wide, ["p_brand"], TYPE_NAMES, value_col="price")


# --- models (iterative: rows-only checks, no SQL oracle; tests/test_boosting.py checks the trees) ---


def _materialized_features(spark, sf_dir):
    """Feature table written once into the shared checkpoint folder, which the training reads."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex}"
    fe = pm.features(feeds(spark, sf_dir))
    sinks.write_features(fe, path)
    return spark.read.schema(fe.schema).parquet(path)


def _saved_models(spark, sf_dir):
    """Features, and the registry of the models of both horizons trained on them (v2 protocol)."""
    fe = _materialized_features(spark, sf_dir)
    results, forest = models.train_per_commodity(fe)
    path = f"{checkpoint_dir(spark).rstrip('/')}/registry-{uuid.uuid4().hex}"
    registry.save(forest, results, path, RUN_TS)
    return fe, path, results


@register("model_forecast")
def q_model_forecast(spark, sf_dir):
    """Per-commodity models for both horizons (v2 protocol), trained together and saved; then
    loaded again for a batch forecast of every series and horizon (M7b, M8, M11, W14, W15)."""
    fe, path, _ = _saved_models(spark, sf_dir)
    series = fe.select(F.col("commodity_name").alias("commodity"), F.col("market_name").alias("market")).distinct()
    horizons = F.array(*[F.lit(h) for h in models.HORIZONS])
    requests = series.select("*", F.explode(horizons).alias("forecast_horizon_days"))
    return models.forecast(requests, fe, models.by_forest(registry.load(spark, path)))


@register("model_scores")
def q_model_scores(spark, sf_dir):
    """The v2 result table of both horizons, with the best model of each."""
    _, path, results = _saved_models(spark, sf_dir)
    best = registry.entries(spark, path).select("commodity", "horizon", "is_best")
    status = F.when(F.col("mape_improvement_pct") > 0, "BETTER").otherwise("WORSE")
    return results.withColumn("status", status).join(best, ["commodity", "horizon"])


@register("model_scores_v1")
def q_model_scores_v1(spark, sf_dir):
    """The v1 result table: a model per commodity under v1's gates and parameters."""
    fe = _materialized_features(spark, sf_dir)
    return models.train_per_commodity_v1(fe)[0].drop("horizon")


@register("model_importance")
def q_model_importance(spark, sf_dir):
    """Global model (v1 protocol): its ten most important features, and its test errors overall
    and per commodity, in one table (M6, M10, O4, A14, A19)."""
    fe = _materialized_features(spark, sf_dir)
    forest, overall, per, _ = models.train_global(fe)
    none = F.lit(None)
    top = models.importances(forest).select(
        F.lit("importance").alias("kind"), F.col("feature").alias("name"), "importance",
        none.cast("double").alias("mae"), none.cast("double").alias("mape"), none.cast("bigint").alias("n_obs"),
    )
    rows = [
        df.select(F.lit(kind).alias("kind"), name, none.cast("double").alias("importance"), "mae", "mape", n.alias("n_obs"))
        for kind, df, name, n in (
            ("overall", overall, F.lit("global").alias("name"), F.col("n_scored")),
            ("commodity", per, F.col("commodity").alias("name"), F.col("n_obs")),
        )
    ]
    return top.union(rows[0]).union(rows[1])
