"""Independent ANSI/DuckDB SQL for every registered query.

These statements are the correctness oracle: written as plain SQL over the
driver's pre-registered views, with the same proxy definitions as
``harvestline.sources.testdata``. Money is carried as integer cents so both
engines produce bit-identical doubles (half-up rounding as integer math).
"""

from __future__ import annotations

from harvestline.operators.unify import EXCLUDED_MARKETS, JUNK_NAMES
from harvestline.sources.testdata import (
    COMMODITY_SEED_ROWS,
    MAPPING_ROWS,
    PROXY_EXCLUDED_MARKETS,
    SEED_EXCLUDED_REGION,
)

NULL_KEY = "'_dbt_utils_surrogate_key_null_'"


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def values(rows, names) -> str:
    body = ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES\n  {body}) AS t({', '.join(names)}))"


def skey(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), {NULL_KEY})" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def half_up_cents(total: str, n: str) -> str:
    return f"((2 * ({total}) + ({n})) // (2 * ({n})))"


# --- proxy feeds -----------------------------------------------------------
CTES: list[tuple[str, str]] = [
    (
        "obs",
        """
SELECT n.n_name AS market_name, p.p_type AS commodity_name,
       CASE WHEN l.l_linestatus = 'F' THEN 'KG' ELSE '50KG' END AS unit_name,
       CAST(CAST((2 * CAST(round(l.l_extendedprice * 100) AS BIGINT) + CAST(l.l_quantity AS BIGINT))
                 // (2 * CAST(l.l_quantity AS BIGINT)) AS DECIMAL(14,0)) * 0.01 AS DECIMAL(12,2)) AS price,
       CAST(l.l_shipdate AS DATE) AS price_date,
       l.l_shipdate + to_days(CAST(l.l_linenumber AS INTEGER)) AS ingested_at,
       l.l_returnflag
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey""",
    ),
    (
        "raw_wfp",
        """
SELECT 'Nigeria' AS country_name, market_name, commodity_name, 'NGN' AS currency_name, unit_name,
       price, price_date, 'WFP' AS source, ingested_at
FROM obs WHERE l_returnflag = 'A'""",
    ),
    (
        "raw_worldbank",
        """
SELECT 'NGA' AS country_code, market_name, commodity_name, unit_name AS unit, price, price_date,
       'WorldBank' AS source, ingested_at
FROM obs WHERE l_returnflag = 'N'""",
    ),
    (
        "raw_nbs",
        """
SELECT commodity_name, unit_name AS unit, price, CAST(date_trunc('month', price_date) AS DATE) AS report_month,
       market_name AS state, 'NBS' AS source, ingested_at
FROM obs WHERE l_returnflag = 'R'""",
    ),
    (
        "raw_fx",
        """
SELECT rate_date, currency,
       CAST(central_rate * 0.99 AS DECIMAL(12,4)) AS buying_rate, central_rate,
       CAST(central_rate * 1.01 AS DECIMAL(12,4)) AS selling_rate, 'CBN' AS source, ingested_at
FROM (SELECT CAST(o_orderdate AS DATE) AS rate_date,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'EUR' ELSE 'USD' END AS currency,
             CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(14,0)) * 0.01 AS DECIMAL(12,4)) AS central_rate,
             o_orderdate AS ingested_at
      FROM orders)""",
    ),
    (
        "stg_wfp",
        """
SELECT market_name, commodity_name, currency_name, unit_name, price_ngn, price_date, source FROM (
  SELECT market_name, commodity_name, currency_name, unit_name, price AS price_ngn, price_date, source,
         row_number() OVER (PARTITION BY market_name, commodity_name, price_date
                            ORDER BY ingested_at DESC, currency_name DESC, price DESC, source DESC, unit_name DESC) AS rn
  FROM raw_wfp
  WHERE price > 0 AND price_date IS NOT NULL AND market_name IS NOT NULL AND commodity_name IS NOT NULL)
WHERE rn = 1""",
    ),
    (
        "stg_worldbank",
        """
SELECT market_name, commodity_name, unit_name, price_ngn, price_date, source FROM (
  SELECT market_name, commodity_name, unit AS unit_name, price AS price_ngn, price_date, source,
         row_number() OVER (PARTITION BY market_name, commodity_name, price_date
                            ORDER BY ingested_at DESC, price DESC, source DESC, unit DESC) AS rn
  FROM raw_worldbank
  WHERE price > 0 AND price_date IS NOT NULL AND market_name IS NOT NULL AND commodity_name IS NOT NULL)
WHERE rn = 1""",
    ),
    (
        "stg_nbs",
        """
SELECT market_name, commodity_name, unit_name, price_ngn, price_date, source FROM (
  SELECT state AS market_name, commodity_name, unit AS unit_name, price AS price_ngn,
         report_month AS price_date, source,
         row_number() OVER (PARTITION BY commodity_name, state, report_month
                            ORDER BY ingested_at DESC, price DESC, source DESC, unit DESC) AS rn
  FROM raw_nbs
  WHERE price > 0 AND commodity_name IS NOT NULL)
WHERE rn = 1""",
    ),
    (
        "stg_fx",
        """
SELECT rate_date, currency, buying_rate, central_rate, selling_rate, source FROM (
  SELECT *, row_number() OVER (PARTITION BY currency, rate_date
            ORDER BY ingested_at DESC, buying_rate DESC, central_rate DESC, selling_rate DESC, source DESC) AS rn
  FROM raw_fx WHERE central_rate > 0 AND rate_date IS NOT NULL)
WHERE rn = 1""",
    ),
    ("mapping_raw", values(MAPPING_ROWS, ["raw_name", "clean_name", "category", "unit"])),
    (
        "mapping",
        """
SELECT raw_name, clean_name, category, unit FROM (
  SELECT *, row_number() OVER (PARTITION BY raw_name ORDER BY clean_name, category, unit) AS rn
  FROM mapping_raw WHERE raw_name IS NOT NULL)
WHERE rn = 1""",
    ),
    (
        "raw_unified",
        """
SELECT price_date, market_name, commodity_name, unit_name, price_ngn, 'WFP' AS source FROM stg_wfp
UNION ALL
SELECT price_date, market_name, commodity_name, unit_name, price_ngn, 'WorldBank' AS source FROM stg_worldbank
UNION ALL
SELECT price_date, market_name, commodity_name, unit_name, price_ngn, 'NBS' AS source FROM stg_nbs""",
    ),
    (
        "harmonized",
        f"""
SELECT u.price_date, u.market_name,
       coalesce(m.clean_name, u.commodity_name) AS commodity_name,
       coalesce(m.unit, u.unit_name) AS unit_name,
       coalesce(m.category, 'Other') AS category,
       u.price_ngn, u.source
FROM raw_unified u LEFT JOIN mapping m ON u.commodity_name = m.raw_name
WHERE u.price_ngn > 0
  AND length(coalesce(m.clean_name, u.commodity_name)) > 3
  AND lower(coalesce(m.clean_name, u.commodity_name)) NOT IN {in_list(JUNK_NAMES)}
  AND u.market_name NOT IN {in_list(EXCLUDED_MARKETS + PROXY_EXCLUDED_MARKETS)}""",
    ),
    (
        "bounds",
        """
SELECT commodity_name,
       quantile_cont(CAST(CAST(price_ngn * 100 AS BIGINT) AS DOUBLE), 0.25) AS q1c,
       quantile_cont(CAST(CAST(price_ngn * 100 AS BIGINT) AS DOUBLE), 0.75) AS q3c
FROM harmonized GROUP BY commodity_name""",
    ),
    (
        "unified",
        """
SELECT h.price_date, h.market_name, h.commodity_name, h.unit_name, h.category, h.price_ngn, h.source
FROM harmonized h JOIN bounds b ON h.commodity_name = b.commodity_name
WHERE CAST(CAST(h.price_ngn * 100 AS BIGINT) AS DOUBLE)
      BETWEEN b.q1c - 3.0 * (b.q3c - b.q1c) AND b.q3c + 3.0 * (b.q3c - b.q1c)""",
    ),
    (
        "daily_c",
        f"""
SELECT price_date, market_name, commodity_name,
       max(category) AS category, max(unit_name) AS unit_name,
       {half_up_cents("sum(CAST(price_ngn * 100 AS BIGINT))", "count(*)")} AS price_c,
       CAST(min(price_ngn) * 100 AS BIGINT) AS min_c,
       CAST(max(price_ngn) * 100 AS BIGINT) AS max_c,
       count(*) AS source_count
FROM unified GROUP BY price_date, market_name, commodity_name""",
    ),
    (
        "raw_weather",
        """
SELECT event_type AS market_name, CAST(NULL AS DECIMAL(8,4)) AS latitude, CAST(NULL AS DECIMAL(8,4)) AS longitude,
       CAST(ts AS DATE) AS weather_date,
       CAST(CAST((CAST(round(value * 100) AS BIGINT) + 5) // 10 AS DECIMAL(10,0)) * 0.1 AS DECIMAL(5,1)) AS temperature_max,
       CAST(CAST(((CAST(round(value * 100) AS BIGINT) + 5) // 10) // 2 AS DECIMAL(10,0)) * 0.1 AS DECIMAL(5,1)) AS temperature_min,
       CAST(NULL AS DECIMAL(6,1)) AS precipitation_mm, CAST(NULL AS DECIMAL(5,1)) AS humidity_pct,
       'OpenMeteo' AS source, ts AS ingested_at
FROM events""",
    ),
    (
        "market_seed",
        f"""
SELECT n.n_nationkey AS market_id, n.n_name AS market_name,
       'State ' || CAST(n.n_regionkey AS VARCHAR) AS state, r.r_name AS geopolitical_zone,
       CAST(n.n_nationkey * 1.5 AS DOUBLE) AS latitude, CAST(n.n_regionkey * 2.25 AS DOUBLE) AS longitude
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name <> {lit(SEED_EXCLUDED_REGION)}""",
    ),
    (
        "commodity_seed",
        values(
            COMMODITY_SEED_ROWS,
            ["commodity_id", "commodity_name", "category", "standard_unit", "is_staple"],
        ),
    ),
]


def dbl(col: str, scale: int = 2) -> str:
    """Exact decimal -> double, as integer units / 10^scale."""
    f = 10**scale
    return f"CAST(CAST({col} * {f} AS BIGINT) AS DOUBLE) / {f}"


def with_ctes(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with every proxy CTE (DuckDB skips unreferenced ones)."""
    parts = CTES + FEATURE_CTES + list(extra or [])
    ctes = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in parts)
    return f"WITH {ctes}\n{body.strip()}"


# --- time series -----------------------------------------------------------
def feature_sql(min_obs: int = 50, limit: int = 7, fx: bool = True) -> list[tuple[str, str]]:
    """CTEs building the feature table ``features`` from ``daily_c``."""
    from harvestline.operators.timeseries import (
        FX_CHANGES,
        LAGS,
        MOMENTUM,
        ROLL_WINDOWS,
        TARGET_HORIZONS,
    )

    cols = ["CAST(price_c AS DOUBLE) / 100 AS price_ngn"]
    cols += [f"lead(price_c, {h}) OVER w / 100 AS target_{h}d" for h in TARGET_HORIZONS]
    cols += [f"lag(price_c, {k}) OVER w / 100 AS lag_{k}d" for k in LAGS]
    for n in ROLL_WINDOWS:
        fr = f"w{n}"
        full = f"count(price_c) OVER {fr} = {n}"
        s, s2 = f"sum(price_c) OVER {fr}", f"sum(price_c * price_c) OVER {fr}"
        cols += [
            f"CASE WHEN {full} THEN {s} / {n} / 100 END AS roll_mean_{n}d",
            f"CASE WHEN {full} THEN sqrt(({s2} * {n} - {s} * {s}) / {n * (n - 1)}) / 100 END AS roll_std_{n}d",
            f"CASE WHEN {full} THEN min(price_c) OVER {fr} / 100 END AS roll_min_{n}d",
            f"CASE WHEN {full} THEN max(price_c) OVER {fr} / 100 END AS roll_max_{n}d",
        ]
    cols += [f"price_c / lag(price_c, {k}) OVER w - 1 AS mom_pct_change_{k}d" for k in MOMENTUM]
    cols += [
        "CAST(month(price_date) AS INTEGER) AS cal_month",
        "CAST(quarter(price_date) AS INTEGER) AS cal_quarter",
        "CAST(isodow(price_date) - 1 AS INTEGER) AS cal_day_of_week",
        "CAST(dayofyear(price_date) AS INTEGER) AS cal_day_of_year",
        "CAST(weekofyear(price_date) AS INTEGER) AS cal_week_of_year",
        "CAST(CASE WHEN month(price_date) BETWEEN 4 AND 10 THEN 1 ELSE 0 END AS INTEGER) AS cal_is_rainy_season",
        "CAST(CASE WHEN month(price_date) BETWEEN 6 AND 8 THEN 1 ELSE 0 END AS INTEGER) AS cal_is_lean_season",
    ]
    if fx:
        cols.append("fx_usd_ngn")
        cols += [f"fx_usd_ngn / lag(fx_usd_ngn, {k}) OVER w - 1 AS fx_pct_change_{k}d" for k in FX_CHANGES]
    windows = ["w AS (PARTITION BY market_name, commodity_name ORDER BY price_date)"]
    windows += [f"w{n} AS (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in ROLL_WINDOWS]
    src = "withfx" if fx else "dense"
    ctes = [
        (
            "ds1",
            """
SELECT market_name, commodity_name, price_date, price_c,
       lead(price_date) OVER (PARTITION BY market_name, commodity_name ORDER BY price_date) AS nxt,
       count(*) OVER (PARTITION BY market_name, commodity_name) AS n0
FROM daily_c""",
        ),
        (
            "dense",
            f"""
SELECT market_name, commodity_name,
       CAST(unnest(generate_series(CAST(price_date AS TIMESTAMP),
            CAST(greatest(price_date, least(coalesce(nxt - 1, price_date), price_date + {limit})) AS TIMESTAMP),
            INTERVAL 1 DAY)) AS DATE) AS price_date,
       price_c
FROM ds1 WHERE n0 >= {min_obs}""",
        ),
        (
            "fx_ends",
            """
SELECT rate_date, CAST(central_rate AS DOUBLE) AS fx,
       coalesce(lead(rate_date) OVER (ORDER BY rate_date) - 1,
                greatest(rate_date, (SELECT max(price_date) FROM dense))) AS e
FROM stg_fx WHERE currency = 'USD'""",
        ),
        (
            "fx_day",
            """
SELECT CAST(unnest(generate_series(CAST(rate_date AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d, fx
FROM fx_ends""",
        ),
        (
            "withfx",
            "SELECT x.*, f.fx AS fx_usd_ngn FROM dense x LEFT JOIN fx_day f ON x.price_date = f.d",
        ),
        (
            "feat",
            f"""
SELECT market_name, commodity_name, price_date,
       {(',' + chr(10) + '       ').join(cols)},
       count(*) OVER (PARTITION BY market_name, commodity_name) AS n1
FROM {src}
WINDOW {', '.join(windows)}""",
        ),
        (
            "features",
            f"SELECT * EXCLUDE (n1) FROM feat WHERE n1 >= {min_obs} "
            "AND lag_30d IS NOT NULL AND roll_mean_30d IS NOT NULL",
        ),
    ]
    return ctes


FEATURE_CTES = feature_sql()


# --- quality ---------------------------------------------------------------
def _check_sql(c, as_of) -> tuple[str, str]:
    col = c.column
    if c.kind == "row_count":
        ok = f"count(*) >= {c.lo!r}" + (f" AND count(*) <= {c.hi!r}" if c.hi is not None else "")
        return "CAST(count(*) AS DOUBLE)", ok
    if c.kind == "not_null":
        nulls = f"count(*) FILTER (WHERE {col} IS NULL)"
        return f"CAST({nulls} AS DOUBLE)", f"{nulls} = 0"
    if c.kind == "between":
        share = (
            f"CASE WHEN count({col}) > 0 THEN count(*) FILTER (WHERE {col} BETWEEN {c.lo!r} AND {c.hi!r})"
            f" / count({col}) END"
        )
        return share, f"coalesce({share} >= {c.mostly!r}, TRUE)"
    if c.kind == "price_range":
        lo_op, hi_op = (">=", "<=") if c.inclusive else (">", "<")
        ok = f"coalesce(min({col}) {lo_op} {c.lo!r} AND max({col}) {hi_op} {c.hi!r}, FALSE)"
        return f"CAST(max({col}) AS DOUBLE)", ok
    if c.kind == "freshness":
        days = f"coalesce(DATE '{as_of.isoformat()}' - max({col}), 999)"
        return f"CAST({days} AS DOUBLE)", f"{days} <= {c.hi!r}"
    if c.kind == "in_set":
        bad = f"count(*) FILTER (WHERE {col} NOT IN {in_list(c.values)})"
        return f"CAST({bad} AS DOUBLE)", f"{bad} = 0"
    if c.kind == "unique":
        dup = f"count({col}) - count(DISTINCT {col})"
        return f"CAST({dup} AS DOUBLE)", f"{dup} = 0"
    raise ValueError(c.kind)


def checks_sql(view: str, table: str, checks, as_of=None) -> str:
    parts = []
    for i, c in enumerate(checks):
        obs, ok = _check_sql(c, as_of)
        keep = "TRUE" if c.kind == "row_count" else "count(*) > 0"
        parts.append(
            f"SELECT {lit(table)} AS table_name, {i} AS check_order, {lit(c.name)} AS check_name, "
            f"{ok} AS passed, {obs} AS observed FROM {view} HAVING {keep}"
        )
    return "\nUNION ALL\n".join(parts)
