"""The SQL-model layer as one lazily composed plan: raw -> staged -> unified
-> facts and dimensions.

The reference recomputes staging and unified once per consumer (they are
views). A query with one consumer composes the functions below; one with
several takes them from ``Marts``, which writes each table once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.operators import marts, staging, timeseries, unify
from harvestline.session import written
from harvestline.sources import testdata


@dataclass
class RawFeeds:
    wfp: DataFrame
    worldbank: DataFrame
    nbs: DataFrame
    fx: DataFrame
    weather: DataFrame
    mapping: DataFrame
    market_seed: DataFrame
    commodity_seed: DataFrame
    excluded_markets: list[str]


def testdata_feeds(spark: SparkSession, sf_dir: str) -> RawFeeds:
    observed = testdata.observations(spark, sf_dir)
    return RawFeeds(
        wfp=testdata.raw_wfp(observed),
        worldbank=testdata.raw_worldbank(observed),
        nbs=testdata.raw_nbs(observed),
        fx=testdata.raw_fx(spark, sf_dir),
        weather=testdata.raw_weather(spark, sf_dir),
        mapping=testdata.mapping_seed(spark),
        market_seed=testdata.market_seed(spark, sf_dir),
        commodity_seed=testdata.commodity_seed(spark),
        excluded_markets=unify.EXCLUDED_MARKETS + testdata.PROXY_EXCLUDED_MARKETS,
    )


def staged(feeds: RawFeeds) -> dict[str, DataFrame]:
    return {
        "WFP": staging.stage_wfp(feeds.wfp),
        "WorldBank": staging.stage_worldbank(feeds.worldbank),
        "NBS": staging.stage_nbs(feeds.nbs),
    }


def unified(feeds: RawFeeds) -> DataFrame:
    return unify.unified_prices(
        staged(feeds), feeds.mapping, excluded_markets=feeds.excluded_markets
    )


def daily(feeds: RawFeeds) -> DataFrame:
    return marts.daily_fact(unified(feeds))


def weekly(feeds: RawFeeds) -> DataFrame:
    return marts.weekly_fact(daily(feeds))


def monthly(feeds: RawFeeds) -> DataFrame:
    return marts.monthly_fact(daily(feeds))


def markets_dim(feeds: RawFeeds) -> DataFrame:
    return marts.dim_markets(unified(feeds), feeds.market_seed)


def commodities_dim(feeds: RawFeeds) -> DataFrame:
    return marts.dim_commodities(unified(feeds), feeds.commodity_seed)


def fx_usd(feeds: RawFeeds) -> DataFrame:
    """Staged USD rates, one row per date."""
    return staging.stage_fx(feeds.fx).where(F.col("currency") == "USD")


def features(feeds: RawFeeds, commodities: list[str] | None = None) -> DataFrame:
    return timeseries.feature_table(daily(feeds), fx_usd(feeds), commodities)


class Marts:
    """Tables that several consumers share, each written once and read from there."""

    def __init__(self, feeds: RawFeeds):
        self.feeds = feeds

    @cached_property
    def unified(self) -> DataFrame:
        return written(unified(self.feeds), "unified")

    @cached_property
    def daily(self) -> DataFrame:
        return written(marts.daily_fact(self.unified), "daily")

    @cached_property
    def markets(self) -> DataFrame:
        return marts.dim_markets(self.unified, self.feeds.market_seed)

    @cached_property
    def commodities(self) -> DataFrame:
        return marts.dim_commodities(self.unified, self.feeds.commodity_seed)

    @cached_property
    def features(self) -> DataFrame:
        return written(features(self.feeds), "features")
