"""Raw price feeds derived from the driver's TPC-H-ish tables.

The reference reads five landed feeds. The test tables have none of them, so
each feed is a deterministic projection of the given tables (work grows with
lineitem / orders):

* observations = lineitem ⋈ supplier ⋈ nation ⋈ part; market = nation name,
  commodity = part type, date = ship date, price = extended price / quantity
  in exact cents (half-up), reload stamp = ship date + line number days;
* l_returnflag splits them into three feeds: A -> WFP, N -> World Bank,
  R -> NBS (NBS reports are monthly: the date is the month start);
* FX feed = all orders: central rates per order date, many orders per date
  (exercises the FX dedupe), buying/selling at -1 %/+1 %; low-priority orders
  are quoted in EUR, the others in USD;
* market seed = nation ⋈ region (regions other than EUROPE, so some observed
  markets have no seed row, as J4 needs them); two nations play labels that P11
  leaves out; mapping and commodity seeds are small literals.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline import schemas
from harvestline.sources import readers

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the proxy seeds (small by construction).
MAPPING_ROWS = [
    ("ECONOMY", "Economy grade", "Cereals", "KG"),
    ("LARGE", "Large sack", "Tubers", "BAG"),
    ("PROMO", "Promo pack", "Oils", "L"),
    ("PROMO", "Promo bundle", "Oils", "L"),
    ("small", "Small pack", "Legumes", "KG"),
    ("STANDARD", "Standard grade", "Cereals", "KG"),
]
COMMODITY_SEED_ROWS = [
    (1, "economy grade", "Cereals", "KG", True),
    (2, "LARGE SACK", "Tubers", "BAG", False),
    (3, "Promo Bundle", "Oils", "L", None),
    (4, "Rice (local)", "Cereals", "KG", True),
    (5, "Medium", "Other", "KG", False),
]
# Two nations play the report-style aggregate rows ('National', a zone).
PROXY_EXCLUDED_MARKETS = ["NATION_7", "NATION_13"]
# Reporting date of the proxy feeds (freshness checks need an explicit date).
AS_OF = dt.date(2002, 1, 1)
SEED_EXCLUDED_REGION = "EUROPE"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed observation rows with the flag that splits them into feeds.

    The three price feeds take one DataFrame of it, so their plans share its
    scans and exchanges."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = (
        li.join(sup, li["l_suppkey"] == sup["s_suppkey"])
        .join(nat, F.col("s_nationkey") == nat["n_nationkey"])
        .join(part, li["l_partkey"] == part["p_partkey"])
    )
    q = F.col("l_quantity").cast("bigint")
    ext_c = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    price_c = F.floor((ext_c * 2 + q) / (q * 2)).cast("bigint")
    return j.select(
        F.col("n_name").alias("market_name"),
        F.col("p_type").alias("commodity_name"),
        F.when(F.col("l_linestatus") == "F", F.lit("KG")).otherwise(F.lit("50KG")).alias("unit_name"),
        (price_c.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast(schemas.PRICE).alias("price"),
        F.col("l_shipdate").cast("date").alias("price_date"),
        (F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber"))).alias("ingested_at"),
        "l_returnflag",
    )


def raw_wfp(observed: DataFrame) -> DataFrame:
    o = observed.where(F.col("l_returnflag") == "A")
    return o.select(
        F.lit("Nigeria").alias("country_name"),
        "market_name",
        "commodity_name",
        F.lit("NGN").alias("currency_name"),
        "unit_name",
        "price",
        "price_date",
        F.lit("WFP").alias("source"),
        "ingested_at",
    )


def raw_worldbank(observed: DataFrame) -> DataFrame:
    o = observed.where(F.col("l_returnflag") == "N")
    return o.select(
        F.lit("NGA").alias("country_code"),
        "market_name",
        "commodity_name",
        F.col("unit_name").alias("unit"),
        "price",
        "price_date",
        F.lit("WorldBank").alias("source"),
        "ingested_at",
    )


def raw_nbs(observed: DataFrame) -> DataFrame:
    o = observed.where(F.col("l_returnflag") == "R")
    return o.select(
        "commodity_name",
        F.col("unit_name").alias("unit"),
        "price",
        F.trunc("price_date", "month").alias("report_month"),
        F.col("market_name").alias("state"),
        F.lit("NBS").alias("source"),
        "ingested_at",
    )


def raw_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    central = (
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("decimal(14,0)")
        * F.lit(Decimal("0.01"))
    ).cast(schemas.RATE)
    return o.select(
        F.col("o_orderdate").cast("date").alias("rate_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", "EUR").otherwise("USD").alias("currency"),
        central.alias("central_rate"),
        F.col("o_orderdate").alias("ingested_at"),
    ).select(
        "rate_date",
        "currency",
        (F.col("central_rate") * F.lit(Decimal("0.99"))).cast(schemas.RATE).alias("buying_rate"),
        "central_rate",
        (F.col("central_rate") * F.lit(Decimal("1.01"))).cast(schemas.RATE).alias("selling_rate"),
        F.lit("CBN").alias("source"),
        "ingested_at",
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-like readings from the event log: one reading per event, the
    event type playing the station (market)."""
    e = table(spark, sf_dir, "events")
    # value has 2 decimals: tenths half-up as integer math, then exact decimals
    tenths = F.floor((F.round(F.col("value") * 100).cast("bigint") + 5) / 10).cast("bigint")
    tenth = F.lit(Decimal("0.1"))
    return e.select(
        F.col("event_type").alias("market_name"),
        F.lit(None).cast("decimal(8,4)").alias("latitude"),
        F.lit(None).cast("decimal(8,4)").alias("longitude"),
        F.col("ts").cast("date").alias("weather_date"),
        (tenths.cast("decimal(10,0)") * tenth).cast("decimal(5,1)").alias("temperature_max"),
        (F.floor(tenths / 2).cast("decimal(10,0)") * tenth).cast("decimal(5,1)").alias("temperature_min"),
        F.lit(None).cast("decimal(6,1)").alias("precipitation_mm"),
        F.lit(None).cast("decimal(5,1)").alias("humidity_pct"),
        F.lit("OpenMeteo").alias("source"),
        F.col("ts").alias("ingested_at"),
    )


def mapping_seed(spark: SparkSession) -> DataFrame:
    return readers.local_table(spark, MAPPING_ROWS, schemas.SEED_MAPPING)


def commodity_seed(spark: SparkSession) -> DataFrame:
    return readers.local_table(spark, COMMODITY_SEED_ROWS, schemas.SEED_COMMODITIES)


def market_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"]).where(F.col("r_name") != SEED_EXCLUDED_REGION)
    return j.select(
        F.col("n_nationkey").alias("market_id"),
        F.col("n_name").alias("market_name"),
        F.concat(F.lit("State "), F.col("n_regionkey").cast("string")).alias("state"),
        F.col("r_name").alias("geopolitical_zone"),
        (F.col("n_nationkey") * 1.5).cast("double").alias("latitude"),
        (F.col("n_regionkey") * 2.25).cast("double").alias("longitude"),
    )
