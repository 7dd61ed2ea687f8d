"""Typed readers for landed files and seeds.

Schemas are always explicit (no inference pass over the data); parquet reads
get column pruning and predicate pushdown from Catalyst.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from harvestline import schemas
from harvestline.operators.reshape import date_between, drop_null_keys, standardize
from harvestline.functions import try_date, try_number


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """Typed read of a raw table."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with quoted fields (doubled quotes inside)."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_seed(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """Seed CSV; rows without a key (blank lines) are dropped."""
    return read_csv(spark, path, schema).where(F.col(key).isNotNull())


def select_where(
    df: DataFrame, columns: Sequence[str], where=None, order: Sequence[str] | None = None
) -> DataFrame:
    """Projection + predicate (+ optional order) read (S5); the projection
    and predicate reach the parquet scan."""
    out = df.select(*columns)
    if where is not None:
        out = out.where(where)
    return out.orderBy(*order) if order else out


# HDX price CSV -> raw price columns.
HDX_RENAME = {
    "date": "price_date",
    "market": "market_name",
    "commodity": "commodity_name",
    "currency": "currency_name",
    "unit": "unit_name",
    "admin1": "state",
    "admin2": "lga",
}
HDX_KEEP = ["price_date", "market_name", "commodity_name", "currency_name", "unit_name", "price"]
HDX_OPTIONAL = ["state", "lga", "latitude", "longitude", "category", "pricetype"]


def hdx_observations(
    spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """HDX price CSV -> typed observations: rename what exists, tolerant
    price parse, drop rows without keys, optional inclusive date range
    (S2, P1-P5)."""
    raw = read_csv(spark, path, schemas.HDX_CSV)
    std = standardize(raw, HDX_RENAME, HDX_KEEP, HDX_OPTIONAL)
    typed = std.withColumns(
        {"price": try_number(F.col("price")), "price_date": try_date("price_date")}
    )
    typed = drop_null_keys(typed, ["price", "price_date", "market_name", "commodity_name"])
    return date_between(typed, "price_date", start, end)


def api_observations(items: DataFrame, source: str | None = None) -> DataFrame:
    """Price-API items (from ``semistructured.explode_items``) -> typed
    observations, the columns that exist, stamped with ``source`` if given
    (P1, P2, P4)."""
    # Price-API item fields -> raw price columns.
    rename = {
        "marketName": "market_name",
        "commodityName": "commodity_name",
        "currencyName": "currency_name",
        "unitName": "unit_name",
        "commodityPrice": "price",
        "commodityPriceDate": "price_date",
    }
    needed = ["price", "price_date", "market_name", "commodity_name"]
    std = standardize(items, rename, needed, HDX_KEEP)
    typed = std.withColumns(
        {"price": try_number(F.col("price")), "price_date": try_date(F.col("price_date"))}
    )
    if source:
        typed = typed.withColumn("source", F.lit(source))
    return drop_null_keys(typed, needed)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Literal rows as a local relation: the planner knows their size."""
    columns = list(zip(*rows))
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)


def literal_locations(spark: SparkSession, rows: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Fixed (market, latitude, longitude) list as a DataFrame."""
    schema = T.StructType().add("market_name", "string").add("latitude", "double").add("longitude", "double")
    return local_table(spark, rows, schema)
