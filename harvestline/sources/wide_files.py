"""Wide price extracts: files with a column per commodity, not all with the same columns.

The header of every file is read first, some thousand bytes each. Files are then
grouped by header; each group is one typed scan of the columns that are wanted, made
long, and the groups are one union. A column that a group lacks is NULL there, never the
neighbouring column's values, and no file is read to infer a schema.
"""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestline.functions import try_date, try_number
from harvestline.operators.reshape import date_between, wide_to_long_paired

# Price columns of the wide extract and their display names.
COMMODITIES = {
    "rice": "Rice",
    "rice_various": "Rice (various)",
    "maize": "Maize",
    "maize_flour": "Maize flour",
    "beans": "Beans",
    "cowpeas": "Cowpeas",
    "sorghum": "Sorghum",
    "millet": "Millet",
    "yam": "Yam",
    "cassava": "Cassava",
    "cassava_flour": "Cassava flour",
    "gari_fao": "Garri",
    "plantains": "Plantains",
    "oil": "Cooking oil",
    "groundnuts": "Groundnuts",
    "meat_beef": "Beef",
    "meat_chicken": "Chicken",
    "fish_catfish": "Catfish",
    "eggs": "Eggs",
    "tomatoes": "Tomatoes",
    "onions": "Onions",
    "sugar": "Sugar",
    "salt": "Salt",
    "wheat_flour": "Wheat flour",
    "milk": "Milk",
}
# The other columns that are kept, their names and types, and the constants.
IDS = {
    "DATES": ("price_date", "date"),
    "mkt_name": ("market_name", "string"),
    "currency": ("currency_name", "string"),
    "adm1_name": ("state", "string"),
    "lat": ("lat", "double"),
    "lon": ("lon", "double"),
}
UNIT = "KG"
EXTRACT_SOURCE = "WorldBank_RTP"
RAW_CONSTANTS = {"country_code": "NGA", "source": "WorldBank"}
CONFIDENCE = "c_"
COLUMNS = (
    "price_date date, market_name string, commodity_name string, price double, currency_name string, "
    "unit_name string, state string, lat double, lon double, confidence_score double, source string"
)
READERS = 32  # headers read at a time


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` by their header; hidden files (``_``, ``.``) are left out.

    What the driver holds is a path per file and a header per kind of file.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    listed, files = fs.listFiles(root, True), []
    while listed.hasNext():
        file = listed.next().getPath()
        if file.getName()[0] not in "_.":
            files.append(file)

    def header(file) -> tuple[str, ...]:
        stream = fs.open(file)
        try:
            codec = codecs.getCodec(file)
            source = codec.createInputStream(stream) if codec else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
        finally:
            stream.close()
        names = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
        return tuple(n.strip() for n in names)

    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(READERS) as pool:
        for names, file in zip(pool.map(header, files), files):
            if names:  # an empty file has no rows either
                found.setdefault(names, []).append(file.toString())
    return found


def _kind(spark: SparkSession, names: tuple[str, ...], files: list[str], commodities: Mapping[str, str]) -> DataFrame:
    """The long rows of the files with one header."""
    # a name that comes twice counts where it comes first
    unique = [n if n not in names[:i] else f"{n}#{i}" for i, n in enumerate(names)]
    schema = T.StructType([T.StructField(n or f"#{i}", T.StringType()) for i, n in enumerate(unique)])
    rows = spark.read.schema(schema).option("header", "true").option("quote", '"').option("escape", '"').csv(files)
    parse = {"date": try_date, "string": F.col, "double": lambda c: try_number(c, "double")}
    ids = [
        (parse[kind](name) if name in unique else F.lit(None)).cast(kind).alias(new) for name, (new, kind) in IDS.items()
    ]
    prices = [c for c in commodities if c in unique]
    values = [try_number(c, "double").alias(c) for c in prices]
    values += [try_number(CONFIDENCE + c, "double").alias(CONFIDENCE + c) for c in prices if CONFIDENCE + c in unique]
    return wide_to_long_paired(
        rows.select(*ids, *values), [new for new, _ in IDS.values()], commodities, CONFIDENCE, conf_col="confidence_score"
    )


def read_wide(
    spark: SparkSession,
    path: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    commodities: Mapping[str, str] = COMMODITIES,
) -> DataFrame:
    """Long price rows (``COLUMNS``) of all wide files below ``path``, between two dates if given.

    A row per market, date and commodity with a price; text that is no number is
    no price. Files without any wanted commodity give nothing.
    """
    kinds = [(n, f) for n, f in sorted(headers(spark, path).items()) if any(c in n for c in commodities)]
    if not kinds:
        return spark.createDataFrame([], COLUMNS)
    long = reduce(DataFrame.unionByName, [_kind(spark, n, f, commodities) for n, f in kinds])
    long = long.withColumns({"unit_name": F.lit(UNIT), "source": F.lit(EXTRACT_SOURCE)})
    return date_between(long.select(*[c.split()[0] for c in COLUMNS.split(", ")]), "price_date", start, end)


def raw_columns(long: DataFrame) -> DataFrame:
    """The long rows in the raw layout, but for its constants (``RAW_CONSTANTS``) and load time."""
    return long.select("market_name", "commodity_name", F.col("unit_name").alias("unit"), "price", "price_date")
