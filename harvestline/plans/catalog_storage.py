"""Registered queries of landed files, stored layouts, checked loads and ordered results.

Files are laid out from the given tables, row by row, so that their number or size
grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline import schemas, sinks
from harvestline.operators import quality, reports, staging, timeseries
from harvestline.plans import marts as pm
from harvestline.plans.catalog import _CLASSES, _RAW_VIEWS, DIM_MARKETS_SQL, RUN_TS, _docs, feeds, plain, register, shared
from harvestline.plans.catalog import _national_sql, _zonal_sql
from harvestline.plans.catalog_feeds import _fresh
from harvestline.plans.oracle import checks_sql
from harvestline.sinks import versioned
from harvestline.sources import readers, report_text, testdata, wide_files

LATER = RUN_TS + dt.timedelta(days=1)

# --- wide extracts ---------------------------------------------------------------


def _wide_folders(spark, sf_dir) -> tuple[str, str]:
    """Two wide extracts of different columns in different order, a row per order."""
    no, price = F.col("o_orderkey"), F.floor("o_totalprice").cast("bigint")
    day = F.col("o_orderdate").cast("date").cast("string")
    market = F.concat(F.lit("M"), no.cast("string"))
    orders = testdata.table(spark, sf_dir, "orders")
    first = orders.select(
        F.lit("NGA").alias("ISO3"),
        day.alias("DATES"),
        market.alias("mkt_name"),
        F.concat(F.lit("State, "), (no % 9).cast("string")).alias("adm1_name"),
        F.lit("NGN").alias("currency"),
        price.cast("string").alias("rice"),
        F.concat(F.lit("0."), F.lpad((no % 100).cast("string"), 2, "0")).alias("c_rice"),
        F.when(no % 7 == 0, "n/a").when(no % 5 != 0, (no % 500 + 1).cast("string")).alias("maize"),
    )
    second = orders.where(no % 3 == 0).select(
        market.alias("mkt_name"),
        (no % 90).cast("string").alias("beans"),
        F.lit("9.5").alias("lat"),
        F.lit("x").alias("note"),
        day.alias("DATES"),
        (price + 1).cast("string").alias("rice"),
    )
    root = _fresh(spark, "wide")
    for name, df in (("first", first), ("second", second)):
        sinks.backup_csv(df, f"{root}/{name}")
    return f"{root}/first", f"{root}/second"


_ORDER = "'M' || o_orderkey AS market_name, CAST(o_orderdate AS DATE) AS price_date, o_orderkey AS k"
_FIRST_SQL = f"""
SELECT market_name, price_date, k, 1 AS load, 'Rice' AS commodity_name, CAST(floor(o_totalprice) AS DOUBLE) AS price,
       CAST('0.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS confidence_score FROM (SELECT *, {_ORDER} FROM orders)
UNION ALL
SELECT market_name, price_date, k, 1, 'Maize', CAST(k % 500 + 1 AS DOUBLE), NULL FROM (SELECT *, {_ORDER} FROM orders) WHERE k % 7 <> 0 AND k % 5 <> 0"""
_SECOND_SQL = f"""
SELECT market_name, price_date, k, 2, 'Beans', CAST(k % 90 AS DOUBLE), NULL FROM (SELECT *, {_ORDER} FROM orders) WHERE k % 3 = 0
UNION ALL
SELECT market_name, price_date, k, 2, 'Rice', CAST(floor(o_totalprice) AS DOUBLE) + 1, NULL FROM (SELECT *, {_ORDER} FROM orders) WHERE k % 3 = 0"""
_SINCE = dt.date(1996, 1, 1)


@register(
    "wide_extract_rows",
    f"""
SELECT price_date, market_name, commodity_name, price, CASE WHEN load = 1 THEN 'NGN' END AS currency_name, 'KG' AS unit_name,
       CASE WHEN load = 1 THEN 'State, ' || (k % 9) END AS state, CASE WHEN load = 2 THEN CAST(9.5 AS DOUBLE) END AS lat,
       CAST(NULL AS DOUBLE) AS lon, confidence_score, 'WorldBank_RTP' AS source
FROM ({_FIRST_SQL} UNION ALL {_SECOND_SQL}) w WHERE price_date >= DATE '{_SINCE}'""",
)
def q_wide_extract_rows(spark, sf_dir):
    """Two kinds of wide files under one folder -> long rows with confidence."""
    first, _ = _wide_folders(spark, sf_dir)
    return wide_files.read_wide(spark, first.rsplit("/", 1)[0], start=_SINCE)


@register(
    "wide_extract_load",
    f"""
SELECT market_name, commodity_name, 'KG' AS unit_name, price AS price_ngn, price_date, 'WorldBank' AS source
FROM (SELECT *, row_number() OVER (PARTITION BY market_name, commodity_name, price_date ORDER BY load DESC) AS rn
      FROM ({_FIRST_SQL} UNION ALL {_SECOND_SQL}) w WHERE price > 0) r WHERE rn = 1""",
)
def q_wide_extract_load(spark, sf_dir):
    """Each extract appended to the raw table, then staged: the later load wins."""
    raw = _fresh(spark, "raw-wide")
    for folder, when in zip(_wide_folders(spark, sf_dir), (RUN_TS, LATER)):
        long = wide_files.raw_columns(wide_files.read_wide(spark, folder))
        sinks.append_raw(long, wide_files.RAW_CONSTANTS, when, path=raw, schema=schemas.RAW_WORLDBANK)
    return plain(staging.stage_worldbank(readers.read_table(spark, raw, schemas.RAW_WORLDBANK)))


# --- report files ------------------------------------------------------------------

_MONTH_SQL = "CAST((2019 + doc_id % 4) || '-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || '-01' AS DATE)"


@register(
    "report_file_load",
    f"""
SELECT zone AS market_name, commodity_name, 'KG' AS unit_name, max(price) AS price_ngn, {_MONTH_SQL} AS price_date, 'NBS' AS source
FROM ({_zonal_sql(f"(SELECT * FROM ({_CLASSES}) c WHERE is_zonal)")} UNION ALL {_national_sql(f"(SELECT * FROM ({_CLASSES}) c WHERE is_national)")}) p
WHERE price > 0 GROUP BY zone, commodity_name, {_MONTH_SQL}""",
)
def q_report_file_load(spark, sf_dir):
    """Report pages written as files by month, read as whole texts, parsed, appended to the raw
    table and staged (S10-S12, K1, P4, P8, W3)."""
    files, raw = _fresh(spark, "report-files"), _fresh(spark, "raw-reports")
    no = F.col("doc_id")
    month = F.concat_ws("-", (no % 4 + 2019).cast("string"), F.lpad((no % 12 + 1).cast("string"), 2, "0"))
    pages = _docs(spark, sf_dir).select(F.col("text").alias("value"), month.alias("report"))
    pages.write.option("lineSep", "\f").partitionBy("report").text(files)
    rows = report_text.report_rows(report_text.read_report_files(spark, files))
    sinks.append_raw(rows, {"source": report_text.REPORT_SOURCE}, RUN_TS, path=raw, schema=schemas.RAW_NBS)
    return plain(staging.stage_nbs(readers.read_table(spark, raw, schemas.RAW_NBS)))


# --- seeds ---------------------------------------------------------------------------


@register(
    "seed_csv",
    """
SELECT p_name || ', "' || p_brand || '"' AS raw_name, p_name AS harmonized_name, p_brand AS unit, p_type AS category
FROM part WHERE p_partkey % 11 <> 0""",
)
def q_seed_csv(spark, sf_dir):
    """A name mapping through its seed file: quoted commas, quotes, and rows without a key."""
    path = _fresh(spark, "seed")
    name = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))
    rows = testdata.table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 11 != 0, name).alias("raw_name"),
        F.col("p_name").alias("harmonized_name"),
        F.col("p_brand").alias("unit"),
        F.col("p_type").alias("category"),
    )
    rows.write.option("header", "true").option("escape", '"').csv(path)
    schema = "raw_name string, harmonized_name string, unit string, category string"
    return readers.read_seed(spark, path, spark.createDataFrame([], schema).schema, "raw_name")


# --- stored layouts --------------------------------------------------------------------


def bucketed_features(spark, sf_dir) -> DataFrame:
    name = _fresh(spark, "daily_by_series")
    daily = shared(spark, sf_dir).daily
    stored = sinks.write_bucketed(
        daily, name.rsplit("/", 1)[1].replace("-", "_"), name, timeseries.SERIES, ["price_date"], buckets=16
    )
    return timeseries.feature_table(stored, pm.fx_usd(feeds(spark, sf_dir)))


@register("bucketed_features", "SELECT * FROM features")
def q_bucketed_features(spark, sf_dir):
    """Features from the daily fact stored in buckets by series: no exchange before the windows."""
    return bucketed_features(spark, sf_dir)


FEATURES = [
    *[f"lag_{k}d" for k in timeseries.LAGS],
    *[f"roll_{s}_{n}d" for n in timeseries.ROLL_WINDOWS for s in ("mean", "std", "min", "max")],
    *[f"mom_pct_change_{k}d" for k in timeseries.MOMENTUM],
    "cal_month", "cal_quarter", "cal_day_of_week", "cal_day_of_year", "cal_week_of_year",
    "cal_is_rainy_season", "cal_is_lean_season", "fx_usd_ngn",
    *[f"fx_pct_change_{k}d" for k in timeseries.FX_CHANGES],
]
_KEYS = ["market_name", "commodity_name", "price_date"]


@register(
    "feature_variants",
    f"SELECT {', '.join(_KEYS)}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATURES)} FROM features",
)
def q_feature_variants(spark, sf_dir):
    """All 37 features of a row in one VARIANT document, stored, and read back by path (K8)."""
    path = _fresh(spark, "variants")
    fe = pm.features(feeds(spark, sf_dir))
    sinks.overwrite(sinks.to_feature_variant(fe, _KEYS, FEATURES), path=path)
    return sinks.from_feature_variant(readers.read_table(spark, path), _KEYS, {c: "double" for c in FEATURES})


@register(
    "replaced_dimension",
    f"""
SELECT market_name, state, 'before' AS seen FROM ({DIM_MARKETS_SQL}) a WHERE state IS NULL
UNION ALL SELECT market_name, state, 'failed' FROM ({DIM_MARKETS_SQL}) b WHERE state IS NULL
UNION ALL SELECT market_name, state, 'after' FROM ({DIM_MARKETS_SQL}) c""",
)
def q_replaced_dimension(spark, sf_dir):
    """A table before, during a failed, and after a whole replacement (K3, K9)."""
    path = _fresh(spark, "dim-versions")
    dim = shared(spark, sf_dir).markets.select("market_name", "state")
    versioned.replace(dim.where("state is null"), path)
    before = versioned.read(spark, path)
    # a replacement that ends before its pointer is written
    dim.write.parquet(f"{path}/{versioned.VERSIONS}/unfinished/data")
    failed = versioned.read(spark, path)
    versioned.replace(dim, path)
    after = versioned.read(spark, path)
    out = [df.withColumn("seen", F.lit(s)) for df, s in ((before, "before"), (failed, "failed"), (after, "after"))]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- checked loads -----------------------------------------------------------------------


def _loaded(spark, sf_dir) -> dict[str, DataFrame]:
    """Report per raw table, from the pass that loads it."""
    raw = feeds(spark, sf_dir)
    sources = {"wfp_prices": (raw.wfp, schemas.RAW_WFP), "worldbank_prices": (raw.worldbank, schemas.RAW_WORLDBANK)}
    out = {}
    for name, (df, schema) in sources.items():
        constants = {"source": "WFP" if name == "wfp_prices" else "WorldBank"}
        out[name] = sinks.append_checked(
            df.drop("ingested_at"), constants, RUN_TS, _fresh(spark, name), name, quality.SQL_CHECKS[name], testdata.AS_OF, schema
        )
    return out


_LOAD_SQL = "\nUNION ALL\n".join(
    checks_sql(_RAW_VIEWS[t], t, quality.SQL_CHECKS[t], testdata.AS_OF) for t in ("wfp_prices", "worldbank_prices")
)


@register(
    "checked_load",
    f"""
SELECT table_name, check_order, check_name, passed, observed FROM ({_LOAD_SQL}) c
UNION ALL
SELECT table_name, -1, 'gate', bool_and(passed), CAST(count(*) FILTER (NOT passed) AS DOUBLE) FROM ({_LOAD_SQL}) g GROUP BY table_name""",
)
def q_checked_load(spark, sf_dir):
    """Raw loads checked in the pass that writes them, and what the gate says of each (K1, Q7, Q11, Q12)."""
    rows = None
    for name, report in _loaded(spark, sf_dir).items():
        try:
            quality.gate(report)
            stopped = False
        except quality.QualityGateError:
            stopped = True
        failed = report.agg(
            F.lit(name).alias("table_name"), F.lit(-1).alias("check_order"), F.lit("gate").alias("check_name"),
            F.lit(not stopped).alias("passed"), F.count_if(~F.col("passed")).cast("double").alias("observed"),
        )
        part = report.unionByName(failed)
        rows = part if rows is None else rows.unionByName(part)
    return rows


# --- ordered results ------------------------------------------------------------------------


@register(
    "ordered_lists",
    """
SELECT kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY name) AS INTEGER) AS rank, name FROM (
  SELECT DISTINCT 'commodity' AS kind, commodity_name AS name FROM daily_c
  UNION ALL SELECT DISTINCT 'market', market_name FROM daily_c) d""",
)
def q_ordered_lists(spark, sf_dir):
    """The sorted commodity and market lists with each name's place (O2, O3)."""
    daily = shared(spark, sf_dir).daily
    lists = [
        reports.with_rank(reports.distinct_list(daily, c).withColumnRenamed(c, "name"), ["name"]).withColumn("kind", F.lit(k))
        for k, c in (("commodity", "commodity_name"), ("market", "market_name"))
    ]
    return lists[0].unionByName(lists[1]).select("kind", "rank", "name")
