"""More registered queries: landed forms to raw schemas, stored tables, and the
operators that the mart and report queries do not reach.

Landed documents and files are laid out from the given tables, row by row, so
that their number grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harvestline import schemas, sinks
from harvestline.operators import evaluate, models, quality, reports, reshape, staging, timeseries
from harvestline.plans.catalog import (
    _COMPARE_SQL,
    _TEST,
    DIM_MARKETS_SQL,
    RUN_TS,
    _compared,
    feeds,
    plain,
    register,
    shared,
)
from harvestline.plans import marts as pm
from harvestline.plans.oracle import in_list, lit
from harvestline.session import checkpoint_dir
from harvestline.sources import readers, semistructured, testdata


def _fresh(spark, name: str) -> str:
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- rates and weather documents -------------------------------------------

AS_OF = dt.date(2024, 6, 30)


@register(
    "rate_snapshot",
    f"""
SELECT event_id, DATE '{AS_OF}' AS rate_date, 'USD' AS currency, r * CAST(0.99 AS DOUBLE) AS buying_rate,
       r AS central_rate, r * CAST(1.01 AS DOUBLE) AS selling_rate
FROM (SELECT event_id, CAST(event_id % 7 AS DOUBLE) AS r FROM events WHERE event_id % 11 <> 0) WHERE r <> 0""",
)
def q_rate_snapshot(spark, sf_dir):
    """A document per event; some without the quote, some with a quote of 0."""
    rates = F.when(F.col("event_id") % 11 != 0, F.concat(F.lit('"NGN": '), (F.col("event_id") % 7).cast("string"))).otherwise(
        F.lit('"EUR": 1')
    )
    docs = testdata.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit('{"rates": {'), rates, F.lit("}}")).alias("doc")
    )
    return semistructured.rate_snapshot(docs, "doc", AS_OF, keep=["event_id"])


# The location list of the weather feed (fixed values of the proxy: event types as markets).
LOCATIONS = [("click", 9.0579, 7.4951), ("view", 6.5244, 3.3792), ("error", 12.0022, 8.592), ("purchase", 4.8156, 7.0498)]
_LOCATIONS_SQL = ", ".join(f"({lit(m)}, {a!r}, {b!r})" for m, a, b in LOCATIONS)


@register(
    "weather_rows",
    f"""
SELECT market_name, CAST(l.latitude AS DOUBLE) AS latitude, CAST(l.longitude AS DOUBLE) AS longitude, weather_date,
       temperature_max, temperature_min, CAST(NULL AS DOUBLE) AS precipitation_mm, humidity_pct, 'OpenMeteo' AS source
FROM (
  SELECT event_type AS market_name, CAST(ts AS DATE) AS weather_date, CAST(event_id % 40 AS DOUBLE) AS temperature_max,
         CAST(event_id % 9 AS DOUBLE) AS temperature_min, CAST(event_id % 101 AS DOUBLE) AS humidity_pct FROM events
  UNION ALL
  SELECT event_type, CAST(ts AS DATE) + 1, CAST(event_id % 30 AS DOUBLE), NULL, NULL FROM events) d
LEFT JOIN (SELECT * FROM (VALUES {_LOCATIONS_SQL}) AS t(market, latitude, longitude)) l ON d.market_name = l.market""",
)
def q_weather_rows(spark, sf_dir):
    """Weather documents (two days each, arrays of unequal length, one array absent)
    joined with the location list, in the raw layout (S9, S14)."""
    ev = testdata.table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    n = F.col("event_id")
    doc = F.concat(
        F.lit('{"daily": {"time": ["'), day.cast("string"), F.lit('", "'), F.date_add(day, 1).cast("string"),
        F.lit('"], "temperature_2m_max": ['), (n % 40).cast("string"), F.lit(", "), (n % 30).cast("string"),
        F.lit('], "temperature_2m_min": ['), (n % 9).cast("string"),
        F.lit('], "relative_humidity_2m_mean": ['), (n % 101).cast("string"), F.lit(", null]}}"),
    )
    docs = ev.select(F.col("event_type").alias("market_name"), doc.alias("doc"))
    rows = semistructured.explode_parallel_arrays(docs, "doc", keep=["market_name"])
    located = semistructured.stamp_locations(rows, readers.literal_locations(spark, LOCATIONS))
    raw = sinks.stamp(located, {"source": "OpenMeteo"}, RUN_TS).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW_WEATHER.fields]
    )
    kinds = ["latitude", "longitude", "temperature_max", "temperature_min", "precipitation_mm", "humidity_pct"]
    dated = raw.where("weather_date is not null and market_name is not null")
    return dated.select("market_name", "weather_date", *[F.col(k).cast("double").alias(k) for k in kinds], "source")


# --- price files -------------------------------------------------------------

_LANDED_SQL = """(SELECT
  CASE WHEN l_linenumber = 6 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date,
  CASE WHEN l_linenumber = 5 AND l_orderkey % 3 = 0 THEN NULL ELSE 'M' || (l_suppkey % 7) END AS market,
  'C' || (l_partkey % 5) AS commodity, 'NGN' AS currency, 'KG' AS unit, 'S' || (l_suppkey % 3) AS admin1,
  CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS VARCHAR) END AS price
  FROM lineitem)"""
_START, _END = dt.date(1998, 3, 1), dt.date(2001, 2, 28)


def _landed(spark, sf_dir):
    li = testdata.table(spark, sf_dir, "lineitem")
    no = F.col("l_linenumber")
    whole = F.floor(F.round(F.col("l_extendedprice") * 100).cast("bigint") / 100).cast("bigint")
    return li.select(
        F.when(no == 6, "soon").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("date"),
        F.when((no == 5) & (F.col("l_orderkey") % 3 == 0), None)
        .otherwise(F.concat(F.lit("M"), (F.col("l_suppkey") % 7).cast("string")))
        .alias("market"),
        F.concat(F.lit("C"), (F.col("l_partkey") % 5).cast("string")).alias("commodity"),
        F.lit("NGN").alias("currency"),
        F.lit("KG").alias("unit"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 3).cast("string")).alias("admin1"),
        F.when(no == 7, "n/a").otherwise(whole.cast("string")).alias("price"),
    )


@register(
    "price_file_rows",
    f"""
SELECT TRY_CAST(date AS DATE) AS price_date, market AS market_name, commodity AS commodity_name, currency AS currency_name,
       unit AS unit_name, CAST(TRY_CAST(price AS DECIMAL(12,2)) AS DOUBLE) AS price, admin1 AS state
FROM {_LANDED_SQL} f
WHERE TRY_CAST(price AS DECIMAL(12,2)) IS NOT NULL AND market IS NOT NULL
  AND TRY_CAST(date AS DATE) BETWEEN DATE '{_START}' AND DATE '{_END}'""",
)
def q_price_file_rows(spark, sf_dir):
    """Landed text rows -> typed observations: rename, optional columns, tolerant
    parses, null keys dropped, both ends of the date range (P1-P5)."""
    std = reshape.standardize(_landed(spark, sf_dir), readers.HDX_RENAME, readers.HDX_KEEP, readers.HDX_OPTIONAL)
    typed = reshape.parse_dates(reshape.parse_numbers(std, ["price"]), ["price_date"])
    typed = reshape.drop_null_keys(typed, ["price", "price_date", "market_name", "commodity_name"])
    return plain(reshape.date_between(typed, "price_date", _START, _END))


@register(
    "price_csv_load",
    f"""
SELECT market_name, commodity_name, count(*) AS rows, CAST(sum(CAST(price * 100 AS BIGINT)) AS BIGINT) AS cents
FROM (SELECT market AS market_name, commodity AS commodity_name, TRY_CAST(price AS DECIMAL(12,2)) AS price
      FROM {_LANDED_SQL} f
      WHERE TRY_CAST(price AS DECIMAL(12,2)) IS NOT NULL AND market IS NOT NULL AND TRY_CAST(date AS DATE) >= DATE '{_START}') g
GROUP BY 1, 2""",
)
def q_price_csv_load(spark, sf_dir):
    """The same rows by way of a CSV copy with header, the file reader, and two
    appends to a raw table (S1, S2, K1, K2)."""
    csv, raw = _fresh(spark, "csv"), _fresh(spark, "raw")
    landed = _landed(spark, sf_dir)
    for name in [f.name for f in schemas.HDX_CSV.fields if f.name not in landed.columns]:
        landed = landed.withColumn(name, F.lit("x"))
    sinks.backup_csv(landed.select(*[f.name for f in schemas.HDX_CSV.fields]), csv)
    rows = readers.hdx_observations(spark, csv, start=_START)
    constants = {"country_name": "Nigeria", "source": "WFP"}
    for part in (F.col("commodity_name") < "C2", F.col("commodity_name") >= "C2"):
        sinks.append_raw(rows.where(part), constants, RUN_TS, path=raw, schema=schemas.RAW_WFP)
    table = readers.read_table(spark, raw, schemas.RAW_WFP)
    return table.groupBy("market_name", "commodity_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum((F.col("price") * 100).cast("bigint")).alias("cents")
    )


@register(
    "price_api_rows",
    """
SELECT CAST(l_shipdate AS DATE) AS price_date, 'M' || (l_suppkey % 7) AS market_name, 'C' || (l_partkey % 5) AS commodity_name,
       'NGN' AS currency_name, 'KG' AS unit_name, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS price, 'WFP' AS source
FROM lineitem WHERE l_linenumber <> 3""",
)
def q_price_api_rows(spark, sf_dir):
    """Paged documents of price items -> raw price rows with their source."""
    no = F.col("l_linenumber")
    item = F.to_json(
        F.struct(
            F.concat(F.lit("M"), (F.col("l_suppkey") % 7).cast("string")).alias("marketName"),
            F.concat(F.lit("C"), (F.col("l_partkey") % 5).cast("string")).alias("commodityName"),
            F.lit("NGN").alias("currencyName"),
            F.lit("KG").alias("unitName"),
            F.when(no != 3, F.col("l_quantity").cast("bigint").cast("string")).otherwise("-").alias("commodityPrice"),
            F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00:00")).alias("commodityPriceDate"),
        )
    )
    docs = testdata.table(spark, sf_dir, "lineitem").select(F.concat(F.lit('{"items": ['), item, F.lit("]}")).alias("doc"))
    return plain(readers.api_observations(semistructured.explode_items(docs, "doc"), "WFP"))


# --- features and series -------------------------------------------------------

PICKED = ["Economy grade", "Large sack"]
PICKED_MARKETS = ["NATION_1", "NATION_2", "NATION_13"]


@register("feature_table_picked", f"SELECT * FROM features WHERE commodity_name IN {in_list(PICKED)}")
def q_feature_table_picked(spark, sf_dir):
    """The feature run over a list of commodities."""
    return pm.features(feeds(spark, sf_dir), PICKED)


@register(
    "history_picked",
    f"""
SELECT d.commodity_name, d.market_name, d.price_date, CAST(d.price_c AS DOUBLE) / 100 AS price_ngn,
       CASE WHEN m.state IS NOT NULL THEN d.market_name || ' (' || m.state || ')' ELSE d.market_name END AS label
FROM daily_c d LEFT JOIN ({DIM_MARKETS_SQL}) m ON d.market_name = m.market_name
WHERE d.commodity_name = {lit(PICKED[0])} AND d.market_name IN {in_list(PICKED_MARKETS)}""",
)
def q_history_picked(spark, sf_dir):
    """One commodity's history in some markets."""
    m = shared(spark, sf_dir)
    return plain(reports.labelled_history(m.daily, m.markets, PICKED[0], PICKED_MARKETS))


_CALENDAR = ["cal_month", "cal_quarter", "cal_day_of_week", "cal_day_of_year"]


@register(
    "feature_documents",
    f"""
SELECT market_name, commodity_name, price_date,
       CAST(to_json({{{", ".join(f"{c}: {c}" for c in _CALENDAR)}}}) AS VARCHAR) AS features
FROM features""",
)
def q_feature_documents(spark, sf_dir):
    """A JSON document of feature values per row (K8)."""
    fe = pm.features(feeds(spark, sf_dir))
    return sinks.to_feature_document(fe, ["market_name", "commodity_name", "price_date"], _CALENDAR)


@register(
    "stored_features",
    f"""
SELECT commodity_name, market_name, count(*) AS rows, max(price_ngn) AS top
FROM features WHERE commodity_name = {lit(PICKED[1])} AND price_date >= DATE '1999-01-01' GROUP BY 1, 2""",
)
def q_stored_features(spark, sf_dir):
    """Features written by commodity, one commodity's folder read back."""
    path = _fresh(spark, "features")
    fe = pm.features(feeds(spark, sf_dir))
    sinks.write_features(fe, path)
    back = readers.select_where(
        readers.read_table(spark, path, fe.schema),
        ["commodity_name", "market_name", "price_date", "price_ngn"],
        (F.col("commodity_name") == PICKED[1]) & (F.col("price_date") >= F.lit(dt.date(1999, 1, 1))),
    )
    return back.groupBy("commodity_name", "market_name").agg(
        F.count(F.lit(1)).alias("rows"), F.max("price_ngn").alias("top")
    )


@register(
    "stored_dimension",
    f"SELECT market_name, state, geopolitical_zone, has_coordinates, 'view' AS kind FROM ({DIM_MARKETS_SQL}) v "
    f"UNION ALL SELECT market_name, state, geopolitical_zone, has_coordinates, 'table' FROM ({DIM_MARKETS_SQL}) t",
)
def q_stored_dimension(spark, sf_dir):
    """The market dimension as a view and as a table that replaces an older one (K3, K9)."""
    dim = shared(spark, sf_dir).markets
    path = _fresh(spark, "dim")
    sinks.overwrite(dim.limit(1), path=path)
    view = sinks.materialize(dim, "dim_markets_view", False, spark)
    table = sinks.materialize(dim, "dim_markets", True, spark, path)
    columns = ["market_name", "state", "geopolitical_zone", "has_coordinates"]
    return view.select(*columns, F.lit("view").alias("kind")).unionByName(
        table.select(*columns, F.lit("table").alias("kind"))
    )


# --- model protocol with the naive column as the model ---------------------------


def _naive_forecast(spark, sf_dir):
    fe = shared(spark, sf_dir).features
    naive = models.by_column("lag_1d", F.col("commodity_name") != PICKED[1])
    series = fe.select(F.col("commodity_name").alias("commodity"), F.col("market_name").alias("market")).distinct()
    unknown = series.select("commodity", F.concat(F.lit("No "), "market").alias("market"))
    horizons = F.array(*[F.lit(h) for h in (*models.HORIZONS, 14)])
    requests = series.union(unknown).select("*", F.explode(horizons).alias("forecast_horizon_days"))
    return models.forecast(requests, fe, naive)


_NEEDED = " AND ".join(f"{c} IS NOT NULL" for c in models.V2_FEATURES)
_FORECAST_SQL = f"""
SELECT r.commodity, r.market,
       CASE WHEN c.price_date IS NOT NULL THEN c.price_date + r.h END AS forecast_date, r.h AS forecast_horizon_days,
       round(p, 2) AS predicted_price_ngn,
       round(greatest(CAST(0.0 AS DOUBLE), p - std * CAST(1.96 AS DOUBLE)), 2) AS lower_bound_ngn,
       round(p + std * CAST(1.96 AS DOUBLE), 2) AS upper_bound_ngn,
       CASE WHEN p IS NOT NULL THEN r.h || 'd' END AS model_version, 'NGN/kg' AS unit,
       CASE WHEN r.h NOT IN (7, 30) THEN 'no_model_for_horizon' WHEN NOT r.known THEN 'no_data'
            WHEN c.price_date IS NULL THEN 'insufficient_features' WHEN p IS NULL THEN 'no_model' ELSE 'ok' END AS status
FROM (SELECT commodity, market, known, unnest([7, 30, 14])::INTEGER AS h FROM (
        SELECT DISTINCT commodity_name AS commodity, market_name AS market, TRUE AS known FROM features
        UNION ALL SELECT DISTINCT commodity_name, 'No ' || market_name, FALSE FROM features) s) r
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY market_name, commodity_name ORDER BY price_date DESC) AS rn
           FROM features WHERE {_NEEDED}) WHERE rn = 1) c
  ON r.commodity = c.commodity_name AND r.market = c.market_name
LEFT JOIN (SELECT market_name, commodity_name, roll_std_30d FROM (
           SELECT *, row_number() OVER (PARTITION BY market_name, commodity_name ORDER BY price_date DESC) AS rn FROM features)
           WHERE rn = 1) n ON r.commodity = n.commodity_name AND r.market = n.market_name,
LATERAL (SELECT CASE WHEN r.h IN (7, 30) AND r.commodity <> {lit(PICKED[1])} THEN c.lag_1d END AS p) x,
LATERAL (SELECT coalesce(n.roll_std_30d, p * CAST(0.1 AS DOUBLE)) AS std) y"""


@register("naive_forecast", _FORECAST_SQL)
def q_naive_forecast(spark, sf_dir):
    """The batch forecast with the naive column in the models' place: joins,
    band, floor and status of every request (M8, W14, W15)."""
    return _naive_forecast(spark, sf_dir)


@register(
    "naive_predictions",
    f"""
SELECT market AS market_name, commodity AS commodity_name, forecast_date AS prediction_date, forecast_horizon_days,
       predicted_price_ngn AS predicted_price, lower_bound_ngn AS lower_bound, upper_bound_ngn AS upper_bound,
       model_version, TIMESTAMP '{RUN_TS}' AS created_at
FROM ({_FORECAST_SQL}) f WHERE status = 'ok'""",
)
def q_naive_predictions(spark, sf_dir):
    """Its predictions in the stored layout, written and read back (K6, K7)."""
    path = _fresh(spark, "predictions")
    sinks.overwrite(sinks.predictions_table(_naive_forecast(spark, sf_dir), RUN_TS), path=path)
    return plain(readers.read_table(spark, path))


@register(
    "naive_test_errors",
    f"""
SELECT commodity_name AS commodity, round(avg(abs(target_7d - lag_1d)), 6) AS mae,
       round(avg(CASE WHEN target_7d <> 0 THEN abs((target_7d - lag_1d) / target_7d) END) * 100, 6) AS mape, count(*) AS n_obs
FROM {_TEST} t WHERE target_7d IS NOT NULL AND lag_1d IS NOT NULL GROUP BY 1 HAVING count(*) >= 10""",
)
def q_naive_test_errors(spark, sf_dir):
    """Test errors per commodity, as the global model reports them."""
    split = evaluate.temporal_split(shared(spark, sf_dir).features, 3)
    test = split.where("split = 'test' and target_7d is not null and lag_1d is not null")
    return models.errors_by_commodity(test, "target_7d", "lag_1d", 10)


_HORIZON = "CASE WHEN model LIKE 'Moving%' THEN 7 ELSE 30 END"


@register(
    "best_by_horizon",
    f"""
SELECT horizon, commodity, model_mape, mape_improvement_pct FROM (
  SELECT {_HORIZON} AS horizon, commodity, mape AS model_mape, mape_improvement_pct,
         row_number() OVER (PARTITION BY {_HORIZON} ORDER BY mape_improvement_pct DESC) AS rn
  FROM ({_COMPARE_SQL}) c) WHERE rn = 1 AND mape_improvement_pct > 0""",
)
def q_best_by_horizon(spark, sf_dir):
    """Per horizon the model that improves most on the naive one, if any does."""
    horizon = F.when(F.col("model").startswith("Moving"), 7).otherwise(30)
    rows = _compared(spark, sf_dir).select(
        horizon.alias("horizon"), "commodity", F.col("mape").alias("model_mape"), "mape_improvement_pct"
    )
    return models.select_best(rows)


@register(
    "eligible_commodities",
    """
SELECT commodity_name, count(*) AS rows, count(*) FILTER (WHERE price_date < cut) AS train_size,
       count(*) FILTER (WHERE price_date >= cut) AS test_size,
       count(*) >= 200 AND count(*) FILTER (WHERE price_date < cut) >= 100
         AND count(*) FILTER (WHERE price_date >= cut) >= 20 AS eligible
FROM (SELECT *, max(price_date) OVER (PARTITION BY commodity_name) - INTERVAL 2 MONTH AS cut
      FROM features WHERE target_7d IS NOT NULL AND """
    + _NEEDED
    + """) p
GROUP BY commodity_name""",
)
def q_eligible_commodities(spark, sf_dir):
    """The size gates of the per-commodity models."""
    return models.eligible_commodities(
        shared(spark, sf_dir).features, "target_7d", models.V2_FEATURES, test_months=2, min_rows=200, min_train=100, min_test=20
    )


# --- checks ------------------------------------------------------------------------

_EXPECTED = ["l_orderkey", "l_shipdate", "l_nowhere"]
_NUMERIC = ["l_quantity", "l_shipdate"]
_EMPTY_CHECKS = [
    quality.Check("rows", "row_count", lo=1),
    quality.Check("has_key", "not_null", "l_orderkey"),
]


@register(
    "schema_and_empty_checks",
    "\nUNION ALL\n".join(
        [f"SELECT 'lineitem' AS table_name, 'column_exists_{c}' AS check_name, "
         f"count(*) FILTER (WHERE column_name = '{c}') > 0 AS passed FROM (DESCRIBE lineitem)" for c in _EXPECTED]
        + [f"SELECT 'lineitem', 'numeric_{c}', count(*) FILTER (WHERE column_name = '{c}' AND column_type IN "
           f"('DOUBLE', 'BIGINT', 'INTEGER')) > 0 FROM (DESCRIBE lineitem)" for c in _NUMERIC]
        + ["SELECT 'no_rows', 'rows', count(*) >= 1 FROM lineitem WHERE l_quantity < 0",
           "SELECT 'all_rows', 'rows', count(*) >= 1 FROM lineitem",
           "SELECT 'all_rows', 'has_key', count(*) FILTER (WHERE l_orderkey IS NULL) = 0 FROM lineitem"]
    ),
)
def q_schema_and_empty_checks(spark, sf_dir):
    """Column and type checks, and the checks of a table without rows (Q4, Q5, Q13)."""
    li = testdata.table(spark, sf_dir, "lineitem")
    found = quality.check_schema(spark, li, "lineitem", _EXPECTED, _NUMERIC)
    for name, df in (("no_rows", li.where("l_quantity < 0")), ("all_rows", li)):
        found = found.unionByName(quality.run_checks(df, name, _EMPTY_CHECKS).select("table_name", "check_name", "passed"))
    return found


@register(
    "series_steps",
    """
SELECT market_name, commodity_name, price_date, CAST(price_c AS DOUBLE) / 100 AS price_ngn,
       lead(price_c, 7) OVER w / 100 AS target_7d, lead(price_c, 30) OVER w / 100 AS target_30d
FROM (SELECT *, count(*) OVER (PARTITION BY market_name, commodity_name) AS n FROM daily_c) d WHERE n >= 50
WINDOW w AS (PARTITION BY market_name, commodity_name ORDER BY price_date)""",
)
def q_series_steps(spark, sf_dir):
    """The feature steps one by one: minimum history and targets on the observed rows."""
    daily = pm.daily(feeds(spark, sf_dir)).select("market_name", "commodity_name", "price_date", "price_ngn")
    return plain(timeseries.add_targets(timeseries.min_history(daily, n=50)))
