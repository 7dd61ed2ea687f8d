"""Staging: filters, renames and keep-latest dedupe per source.

``latest_per_key`` is written as an aggregate (``max`` of a struct led by the
ordering columns) instead of ``row_number() = 1``: an aggregate combines
partially on the map side, so a key that holds a third of all rows (a reload
storm) is reduced inside every input task before the shuffle, while a
row_number window would pull every copy of that key into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("ingested_at",),
) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order``, descending.

    Ties on ``order`` are broken by every remaining column (descending, by
    name), so the pick is deterministic: two rows that tie on all columns are
    identical and either may be kept.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    tiebreak = sorted(c for c in rest if c not in order)
    # The ranking struct holds every non-key column, so its maximum *is* the
    # kept row: one struct per key in the aggregation buffer, not two.
    rank = F.struct(*[F.col(c) for c in list(order) + tiebreak])
    picked = df.groupBy(*keys).agg(F.max(rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row." + c).alias(c) for c in rest]).select(*df.columns)


def stage_wfp(raw: DataFrame) -> DataFrame:
    """Staged WFP feed: price > 0, keys not null, latest per (market, commodity, date)."""
    cleaned = raw.where(
        (F.col("price") > 0)
        & F.col("price_date").isNotNull()
        & F.col("market_name").isNotNull()
        & F.col("commodity_name").isNotNull()
    ).select(
        "market_name",
        "commodity_name",
        "currency_name",
        "unit_name",
        F.col("price").alias("price_ngn"),
        "price_date",
        "source",
        "ingested_at",
    )
    return latest_per_key(cleaned, ["market_name", "commodity_name", "price_date"]).drop(
        "ingested_at"
    )


def stage_worldbank(raw: DataFrame) -> DataFrame:
    """Staged World Bank feed: same filters, ``unit`` renamed ``unit_name``."""
    cleaned = raw.where(
        (F.col("price") > 0)
        & F.col("price_date").isNotNull()
        & F.col("market_name").isNotNull()
        & F.col("commodity_name").isNotNull()
    ).select(
        "market_name",
        "commodity_name",
        F.col("unit").alias("unit_name"),
        F.col("price").alias("price_ngn"),
        "price_date",
        "source",
        "ingested_at",
    )
    return latest_per_key(cleaned, ["market_name", "commodity_name", "price_date"]).drop(
        "ingested_at"
    )


def stage_nbs(raw: DataFrame) -> DataFrame:
    """Staged NBS feed: state -> market_name, report_month -> price_date."""
    cleaned = raw.where((F.col("price") > 0) & F.col("commodity_name").isNotNull()).select(
        F.col("state").alias("market_name"),
        "commodity_name",
        F.col("unit").alias("unit_name"),
        F.col("price").alias("price_ngn"),
        F.col("report_month").alias("price_date"),
        "source",
        "ingested_at",
    )
    return latest_per_key(cleaned, ["commodity_name", "market_name", "price_date"]).drop(
        "ingested_at"
    )


def stage_fx(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    """Staged FX feed: central_rate > 0 and a date.

    With ``dedupe`` (default) an append-only reload keeps the latest row per
    (currency, rate_date); the as-of join needs one rate per date.
    """
    cleaned = raw.where((F.col("central_rate") > 0) & F.col("rate_date").isNotNull())
    if dedupe:
        cleaned = latest_per_key(cleaned, ["currency", "rate_date"])
    return cleaned.select(
        "rate_date", "currency", "buying_rate", "central_rate", "selling_rate", "source"
    )


def stage_weather(raw: DataFrame) -> DataFrame:
    """Staged weather feed: date and market present, measurement columns kept (P10)."""
    return raw.where(F.col("weather_date").isNotNull() & F.col("market_name").isNotNull()).select(
        "market_name",
        "weather_date",
        "temperature_max",
        "temperature_min",
        "precipitation_mm",
        "humidity_pct",
        "source",
    )
