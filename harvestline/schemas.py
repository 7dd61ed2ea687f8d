"""Explicit schemas of the raw, seed and request tables."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(12, 2)
RATE = T.DecimalType(12, 4)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_WFP = _s(
    ("country_name", T.StringType()),
    ("market_name", T.StringType()),
    ("commodity_name", T.StringType()),
    ("currency_name", T.StringType()),
    ("unit_name", T.StringType()),
    ("price", PRICE),
    ("price_date", T.DateType()),
    ("source", T.StringType()),
    ("ingested_at", T.TimestampType()),
)

RAW_NBS = _s(
    ("commodity_name", T.StringType()),
    ("unit", T.StringType()),
    ("price", PRICE),
    ("report_month", T.DateType()),
    ("state", T.StringType()),
    ("source", T.StringType()),
    ("ingested_at", T.TimestampType()),
)

RAW_WORLDBANK = _s(
    ("country_code", T.StringType()),
    ("market_name", T.StringType()),
    ("commodity_name", T.StringType()),
    ("unit", T.StringType()),
    ("price", PRICE),
    ("price_date", T.DateType()),
    ("source", T.StringType()),
    ("ingested_at", T.TimestampType()),
)

RAW_FX = _s(
    ("rate_date", T.DateType()),
    ("currency", T.StringType()),
    ("buying_rate", RATE),
    ("central_rate", RATE),
    ("selling_rate", RATE),
    ("source", T.StringType()),
    ("ingested_at", T.TimestampType()),
)

RAW_WEATHER = _s(
    ("market_name", T.StringType()),
    ("latitude", T.DecimalType(8, 4)),
    ("longitude", T.DecimalType(8, 4)),
    ("weather_date", T.DateType()),
    ("temperature_max", T.DecimalType(5, 1)),
    ("temperature_min", T.DecimalType(5, 1)),
    ("precipitation_mm", T.DecimalType(6, 1)),
    ("humidity_pct", T.DecimalType(5, 1)),
    ("source", T.StringType()),
    ("ingested_at", T.TimestampType()),
)

QUALITY_LOG = _s(
    ("suite_name", T.StringType()),
    ("run_date", T.TimestampType()),
    ("success", T.BooleanType()),
    ("statistics", T.StringType()),
    ("results_summary", T.StringType()),
)

PREDICTIONS = _s(
    ("market_name", T.StringType()),
    ("commodity_name", T.StringType()),
    ("prediction_date", T.DateType()),
    ("forecast_horizon_days", T.IntegerType()),
    ("predicted_price", PRICE),
    ("lower_bound", PRICE),
    ("upper_bound", PRICE),
    ("model_version", T.StringType()),
    ("created_at", T.TimestampType()),
)

SEED_MARKETS = _s(
    ("market_id", T.IntegerType()),
    ("market_name", T.StringType()),
    ("state", T.StringType()),
    ("geopolitical_zone", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
)

SEED_COMMODITIES = _s(
    ("commodity_id", T.IntegerType()),
    ("commodity_name", T.StringType()),
    ("category", T.StringType()),
    ("standard_unit", T.StringType()),
    ("is_staple", T.BooleanType()),
)

SEED_MAPPING = _s(
    ("raw_name", T.StringType()),
    ("clean_name", T.StringType()),
    ("category", T.StringType()),
    ("unit", T.StringType()),
)

FORECAST_REQUEST = _s(
    ("commodity", T.StringType()),
    ("market", T.StringType()),
    ("forecast_horizon_days", T.IntegerType()),
)

# Price-API item (S6) and the HDX CSV layout.
PRICE_API_ITEM = _s(
    ("marketName", T.StringType()),
    ("commodityName", T.StringType()),
    ("currencyName", T.StringType()),
    ("unitName", T.StringType()),
    ("commodityPrice", T.StringType()),
    ("commodityPriceDate", T.StringType()),
)

HDX_CSV = _s(
    ("date", T.StringType()),
    ("admin1", T.StringType()),
    ("admin2", T.StringType()),
    ("market", T.StringType()),
    ("latitude", T.StringType()),
    ("longitude", T.StringType()),
    ("category", T.StringType()),
    ("commodity", T.StringType()),
    ("unit", T.StringType()),
    ("priceflag", T.StringType()),
    ("pricetype", T.StringType()),
    ("currency", T.StringType()),
    ("price", T.StringType()),
    ("usdprice", T.StringType()),
)
