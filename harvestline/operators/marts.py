"""Star schema: daily / weekly / monthly facts and the two dimensions
(A1-A3, A5, A6, J3, J4, P14, P20).

Prices stay DECIMAL(12,2); ``round(avg(decimal), 2)`` in Spark is exact
half-up, matching the reference's ``round(x::numeric, 2)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.functions import surrogate_key

SERIES = ["market_name", "commodity_name"]


def _r2(c) -> F.Column:
    return F.round(c, 2).cast("decimal(12,2)")


def daily_fact(unified: DataFrame, with_sources: bool = False) -> DataFrame:
    """Daily price fact: one row per (date, market, commodity) (A1).

    ``source_count`` counts rows, not distinct sources (reference quirk 13).
    ``with_sources`` adds the documented ``sources`` array (sorted distinct
    feed tags; bounded by the number of feeds).
    """
    aggs = [
        F.max("category").alias("category"),
        F.max("unit_name").alias("unit_name"),
        F.avg("price_ngn").alias("_avg"),
        F.min("price_ngn").alias("_min"),
        F.max("price_ngn").alias("_max"),
        F.count(F.lit(1)).alias("source_count"),
    ]
    if with_sources:
        aggs.append(F.array_sort(F.collect_set("source")).alias("sources"))
    agg = unified.groupBy("price_date", *SERIES).agg(*aggs)
    extra = ["sources"] if with_sources else []
    return agg.select(
        surrogate_key("price_date", *SERIES).alias("price_id"),
        "price_date",
        *SERIES,
        "category",
        "unit_name",
        _r2(F.col("_avg")).alias("price_ngn"),
        _r2(F.col("_min")).alias("price_min_ngn"),
        _r2(F.col("_max")).alias("price_max_ngn"),
        "source_count",
        *extra,
    )


def _period_fact(daily: DataFrame, unit: str, start_col: str, id_col: str, with_range: bool):
    start = F.date_trunc(unit, F.col("price_date")).cast("date")
    aggs = [
        F.avg("price_ngn").alias("_avg"),
        F.min("price_ngn").alias("_min"),
        F.max("price_ngn").alias("_max"),
        F.count(F.lit(1)).alias("observation_count"),
    ]
    agg = daily.groupBy(start.alias(start_col), *SERIES).agg(*aggs)
    cols = [
        surrogate_key(start_col, *SERIES).alias(id_col),
        start_col,
        *SERIES,
        _r2(F.col("_avg")).alias("avg_price_ngn"),
        _r2(F.col("_min")).alias("min_price_ngn"),
        _r2(F.col("_max")).alias("max_price_ngn"),
    ]
    if with_range:
        cols.append(_r2(F.col("_max") - F.col("_min")).alias("price_range_ngn"))
    cols.append("observation_count")
    return agg.select(*cols)


def weekly_fact(daily: DataFrame) -> DataFrame:
    """Weekly price fact: Monday-start weeks over the rounded daily prices (A2)."""
    return _period_fact(daily, "week", "week_start", "weekly_price_id", with_range=False)


def monthly_fact(daily: DataFrame) -> DataFrame:
    """Monthly price fact: calendar months, plus the max-min range (A3)."""
    return _period_fact(daily, "month", "month_start", "monthly_price_id", with_range=True)


def dim_markets(unified: DataFrame, seed: DataFrame) -> DataFrame:
    """Observed markets left-joined to the market seed."""
    observed = unified.select("market_name").distinct()
    s = seed.select(
        F.col("market_name").alias("_seed_market"),
        "state",
        "geopolitical_zone",
        "latitude",
        "longitude",
    )
    j = observed.join(s, observed["market_name"] == s["_seed_market"], "left")
    return j.select(
        "market_name",
        "state",
        "geopolitical_zone",
        "latitude",
        "longitude",
        F.col("_seed_market").isNotNull().alias("has_coordinates"),
    )


def dim_commodities(unified: DataFrame, seed: DataFrame) -> DataFrame:
    """Observed commodities left-joined to the seed on lower-cased names."""
    observed = unified.select("commodity_name").distinct()
    s = seed.select(
        F.col("commodity_name").alias("_seed_name"),
        F.lower("commodity_name").alias("_seed_key"),
        "category",
        "standard_unit",
        "is_staple",
    )
    j = observed.join(s, F.lower(observed["commodity_name"]) == s["_seed_key"], "left")
    return j.select(
        "commodity_name",
        "category",
        "standard_unit",
        F.coalesce("is_staple", F.lit(False)).alias("is_staple"),
        F.col("_seed_name").isNotNull().alias("in_seed_list"),
    )
