"""JSON feeds as DataFrames.

The reference pulls these documents over HTTP and walks them in Python. Here a
landed document is a string column (one document per row, e.g. read with
``spark.read.text(path, wholetext=True)`` or from a JSON-lines file), parsed
with ``from_json`` against an explicit schema and flattened with generators —
all JVM-side, one pass, partitioned like the input files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestline import schemas
from harvestline.functions import try_date


def explode_items(
    df: DataFrame,
    json_col: str,
    item_schema: T.StructType = schemas.PRICE_API_ITEM,
    keep: Sequence[str] = (),
    items_field: str = "items",
) -> DataFrame:
    """Paged API document ``{items: [...], totalPages: n}`` -> one row per
    item, item fields as columns (S6). ``keep`` carries document-level columns."""
    doc = T.StructType(
        [
            T.StructField(items_field, T.ArrayType(item_schema), True),
            T.StructField("totalPages", T.IntegerType(), True),
        ]
    )
    parsed = df.select(*keep, F.from_json(F.col(json_col), doc).alias("_doc"))
    rows = parsed.select(*keep, F.col("_doc.totalPages").alias("total_pages"), F.explode(f"_doc.{items_field}").alias("_it"))
    return rows.select(*keep, "total_pages", "_it.*")


def explode_rate_map(
    df: DataFrame,
    json_col: str,
    base: str = "NGN",
    currency: str = "USD",
    spread: float = 0.01,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``{rates: {"YYYY-MM-DD": {CCY: x}}}`` -> one row per date with the
    ``base`` quote as central rate and buying/selling at ∓``spread`` (S7, S15)."""
    doc = T.StructType(
        [T.StructField("rates", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())), True)]
    )
    parsed = df.select(*keep, F.from_json(F.col(json_col), doc).alias("_doc"))
    rows = parsed.select(*keep, F.explode("_doc.rates").alias("_date", "_quotes"))
    rate = F.col("_quotes").getItem(base)
    # a rate of 0 is no quote
    return rows.where(rate.isNotNull() & (rate != 0)).select(
        *keep,
        try_date("_date").alias("rate_date"),
        F.lit(currency).alias("currency"),
        (rate * (1 - spread)).alias("buying_rate"),
        rate.alias("central_rate"),
        (rate * (1 + spread)).alias("selling_rate"),
    )


def rate_snapshot(
    df: DataFrame,
    json_col: str,
    as_of: dt.date,
    base: str = "NGN",
    currency: str = "USD",
    spread: float = 0.01,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Single-rate document ``{rates: {CCY: x}}`` -> one row dated ``as_of``
    (an explicit parameter, never the wall clock) (S8, S15)."""
    doc = T.StructType([T.StructField("rates", T.MapType(T.StringType(), T.DoubleType()), True)])
    rate = F.from_json(F.col(json_col), doc).getField("rates").getItem(base)
    return df.select(*keep, rate.alias("_r")).where("_r is not null and _r <> 0").select(
        *keep,
        F.lit(as_of).alias("rate_date"),
        F.lit(currency).alias("currency"),
        (F.col("_r") * (1 - spread)).alias("buying_rate"),
        F.col("_r").alias("central_rate"),
        (F.col("_r") * (1 + spread)).alias("selling_rate"),
    )


# Daily weather arrays of the forecast document and the
# staging column each becomes.
WEATHER_FIELDS = {
    "time": "weather_date",
    "temperature_2m_max": "temperature_max",
    "temperature_2m_min": "temperature_min",
    "precipitation_sum": "precipitation_mm",
    "relative_humidity_2m_mean": "humidity_pct",
}


def explode_parallel_arrays(
    df: DataFrame,
    json_col: str,
    fields: dict[str, str] = WEATHER_FIELDS,
    root: str = "daily",
    keep: Sequence[str] = (),
    date_field: str = "time",
) -> DataFrame:
    """``{daily: {time: [...], a: [...], b: [...]}}`` -> one row per index,
    arrays zipped position-wise (S9). Missing arrays give NULL columns."""
    inner = T.StructType(
        [
            T.StructField(k, T.ArrayType(T.StringType() if k == date_field else T.DoubleType()), True)
            for k in fields
        ]
    )
    doc = T.StructType([T.StructField(root, inner, True)])
    parsed = df.select(*keep, F.from_json(F.col(json_col), doc).alias("_doc"))
    def arr(k):  # an absent array zips as NULLs instead of voiding the row
        t = "array<string>" if k == date_field else "array<double>"
        return F.coalesce(F.col(f"_doc.{root}.{k}"), F.array().cast(t)).alias(k)

    zipped = F.arrays_zip(*[arr(k) for k in fields])
    rows = parsed.select(*keep, F.inline(zipped))
    return rows.select(
        *keep,
        *[
            (try_date(k) if k == date_field else F.col(k)).alias(v)
            for k, v in fields.items()
        ],
    )


def stamp_locations(df: DataFrame, locations: DataFrame, key: str = "market_name") -> DataFrame:
    """Attach (latitude, longitude) from a fixed location list."""
    return df.join(locations.select(key, "latitude", "longitude"), key, "left")
