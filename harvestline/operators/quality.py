"""Data-quality checks.

Every check on a table becomes one or more aggregate expressions, and all of
a table's checks are evaluated by a single ``agg`` (one scan, partial
aggregation per task); the one-row result is then stacked into report rows
(table_name, check_name, passed, observed). Schema checks (Q4, Q5) read the
DataFrame's schema only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestline.functions import ts_literal


@dataclass(frozen=True)
class Check:
    """One check. ``kind`` is one of:

    row_count   count within [lo, hi] (hi optional)                    Q1
    not_null    no NULL in ``column``                                  Q2
    between     share of non-null values within [lo, hi] >= mostly     Q3
    price_range min > lo (or >= when inclusive) and max < hi (<=)      Q7
    freshness   days from max(column) to as_of <= hi; empty -> 999     Q8
    in_set      every non-null value in ``values``                     Q6
    unique      no duplicate of ``column``                             Q9
    """

    name: str
    kind: str
    column: str | None = None
    lo: float | None = None
    hi: float | None = None
    mostly: float = 1.0
    inclusive: bool = False
    values: tuple = field(default_factory=tuple)


def _observed_and_pass(c: Check, n: Column, as_of: dt.date | None) -> tuple[Column, Column]:
    col = F.col(c.column) if c.column else None
    if c.kind == "row_count":
        ok = n >= F.lit(c.lo)
        if c.hi is not None:
            ok = ok & (n <= F.lit(c.hi))
        return n.cast("double"), ok
    if c.kind == "not_null":
        nulls = F.count_if(col.isNull())
        return nulls.cast("double"), nulls == 0
    if c.kind == "between":
        inside = F.count_if(col.between(F.lit(c.lo), F.lit(c.hi)))
        present = F.count(col)
        share = F.when(present > 0, inside / present)
        return share, F.coalesce(share >= F.lit(c.mostly), F.lit(True))
    if c.kind == "price_range":
        mn, mx = F.min(col).cast("double"), F.max(col).cast("double")
        lo_ok = mn >= F.lit(c.lo) if c.inclusive else mn > F.lit(c.lo)
        hi_ok = mx <= F.lit(c.hi) if c.inclusive else mx < F.lit(c.hi)
        return mx, F.coalesce(lo_ok & hi_ok, F.lit(False))
    if c.kind == "freshness":
        if as_of is None:
            raise ValueError("freshness needs an explicit as_of date")
        days = F.coalesce(F.datediff(F.lit(as_of), F.max(col)), F.lit(999))
        return days.cast("double"), days <= F.lit(c.hi)
    if c.kind == "in_set":
        bad = F.count_if(~col.isin(list(c.values)))
        return bad.cast("double"), bad == 0
    if c.kind == "unique":
        dup = F.count(col) - F.count_distinct(col)
        return dup.cast("double"), dup == 0
    raise ValueError(f"unknown check kind {c.kind!r}")


def run_checks(
    df: DataFrame, table: str, checks: Sequence[Check], as_of: dt.date | None = None
) -> DataFrame:
    """Evaluate ``checks`` on ``df`` in one aggregate (Q1-Q3, Q6-Q10, Q13).

    When the table is empty only the row-count checks are reported (Q13).
    """
    return _report(df.agg(*_metrics(checks, as_of)), table, checks)


def _metrics(checks: Sequence[Check], as_of: dt.date | None) -> list[Column]:
    """The aggregates that decide ``checks``: the row count, then value and outcome of each."""
    n = F.count(F.lit(1))
    aggs = [n.alias("_n")]
    for i, c in enumerate(checks):
        obs, ok = _observed_and_pass(c, n, as_of)
        aggs += [obs.alias(f"_o{i}"), ok.alias(f"_p{i}")]
    return aggs


def observed(df: DataFrame, checks: Sequence[Check], as_of: dt.date | None = None) -> tuple[DataFrame, Observation]:
    """``df`` that computes its checks' metrics while another action reads it (Q11, K1).

    The checks cost no scan of their own; they see the rows that pass, once. Uniqueness
    (Q9) needs a shuffle and is left to ``run_checks``.
    """
    if any(c.kind == "unique" for c in checks):
        raise ValueError("uniqueness cannot be observed in passing")
    seen = Observation()
    return df.observe(seen, *_metrics(checks, as_of)), seen


def observed_report(spark: SparkSession, seen: Observation, table: str, checks: Sequence[Check]) -> DataFrame:
    """The report of ``run_checks`` from the metrics of an action that has ended."""
    got = seen.get
    kinds = ["_n bigint"] + [f"_o{i} double, _p{i} boolean" for i in range(len(checks))]
    names = ["_n"] + [f"_{k}{i}" for i in range(len(checks)) for k in "op"]
    return _report(spark.createDataFrame([tuple(got[n] for n in names)], ", ".join(kinds)), table, checks)


def _report(one: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Report rows from the row of metrics."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("check_order"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.kind).alias("kind"),
                F.col(f"_p{i}").alias("passed"),
                F.col(f"_o{i}").alias("observed"),
            )
            for i, c in enumerate(checks)
        ]
    )
    out = one.select("_n", F.inline(rows))
    out = out.where((F.col("_n") > 0) | (F.col("kind") == "row_count"))
    return out.select(F.lit(table).alias("table_name"), "check_order", "check_name", "passed", "observed")


def check_schema(
    spark: SparkSession, df: DataFrame, table: str, columns: Sequence[str], numeric: Sequence[str] = ()
) -> DataFrame:
    """Column-exists (Q4) and column-is-numeric (Q5) checks from the schema."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = [(table, f"column_exists_{c}", c in types) for c in columns]
    rows += [
        (table, f"numeric_{c}", isinstance(types.get(c), T.NumericType)) for c in numeric
    ]
    schema = "table_name string, check_name string, passed boolean"
    return spark.createDataFrame(rows, schema)


def report_summary(results: DataFrame) -> DataFrame:
    """Passed / failed totals of a check report (Q11)."""
    return results.agg(
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> None:
    """Raise when any check failed, so downstream work does not start (Q12).
    Reads one aggregate row, never the report itself."""
    failed = results.agg(F.count_if(~F.col("passed")).alias("f")).first()["f"]
    if failed:
        raise QualityGateError(f"{failed} data-quality check(s) failed")


def to_log_row(results: DataFrame, suite: str, run_ts: dt.datetime) -> DataFrame:
    """Quality-log row: suite, run time, success, JSON statistics (K4)."""
    stats = F.to_json(
        F.struct(
            F.count(F.lit(1)).alias("evaluated_expectations"),
            F.count_if(F.col("passed")).alias("successful_expectations"),
            F.count_if(~F.col("passed")).alias("unsuccessful_expectations"),
        )
    )
    return results.agg(
        F.lit(suite).alias("suite_name"),
        ts_literal(run_ts, ntz=True).alias("run_date"),
        (F.count_if(~F.col("passed")) == 0).alias("success"),
        stats.alias("statistics"),
        F.concat_ws(", ", F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("check_name"))))).alias(
            "results_summary"
        ),
    )


def validation_log_row(
    sql_results: DataFrame, suite_results: DataFrame, run_ts: dt.datetime, suite: str = "post_ingestion_validation"
) -> DataFrame:
    """The post-ingestion validation log row (K4, Q11): SQL checks count one
    by one, an expectation suite counts as passed only if all its checks
    passed; success means nothing failed. One aggregate job."""
    sql = sql_results.select(F.lit("sql").alias("kind"), "passed")
    gx = suite_results.groupBy("table_name").agg(F.bool_and("passed").alias("passed"))
    u = sql.unionByName(gx.select(F.lit("gx").alias("kind"), "passed"))

    def n(kind: str, ok: bool):
        return F.count_if((F.col("kind") == kind) & (F.col("passed") == ok))

    c = u.agg(
        n("sql", True).alias("sql_passed"),
        n("sql", False).alias("sql_failed"),
        n("gx", True).alias("gx_passed"),
        n("gx", False).alias("gx_failed"),
    )
    total_p = F.col("sql_passed") + F.col("gx_passed")
    total_f = F.col("sql_failed") + F.col("gx_failed")
    stats = F.to_json(
        F.struct("sql_passed", "sql_failed", "gx_passed", "gx_failed", total_p.alias("total_passed"), total_f.alias("total_failed"))
    )
    summary = F.format_string(
        "SQL: %d passed, %d failed | GX: %d passed, %d failed", "sql_passed", "sql_failed", "gx_passed", "gx_failed"
    )
    return c.select(
        F.lit(suite).alias("suite_name"),
        ts_literal(run_ts, ntz=True).alias("run_date"),
        (total_f == 0).alias("success"),
        stats.alias("statistics"),
        summary.alias("results_summary"),
    )


# Thresholds of the reference's SQL checks (per raw table).
SQL_CHECKS: dict[str, list[Check]] = {
    "wfp_prices": [
        Check("row_count", "row_count", lo=1000),
        Check("not_null_market_name", "not_null", "market_name"),
        Check("not_null_commodity_name", "not_null", "commodity_name"),
        Check("not_null_price", "not_null", "price"),
        Check("not_null_price_date", "not_null", "price_date"),
        Check("price_range", "price_range", "price", lo=0, hi=200000),
        Check("freshness", "freshness", "price_date", hi=90),
    ],
    "worldbank_prices": [
        Check("row_count", "row_count", lo=1000),
        Check("not_null_market_name", "not_null", "market_name"),
        Check("not_null_commodity_name", "not_null", "commodity_name"),
        Check("not_null_price", "not_null", "price"),
        Check("not_null_price_date", "not_null", "price_date"),
        Check("price_range", "price_range", "price", lo=0, hi=50000),
    ],
    "nbs_prices": [
        Check("row_count", "row_count", lo=10),
        Check("price_range", "price_range", "price", lo=50, hi=50000, inclusive=True),
    ],
    "cbn_rates": [Check("row_count", "row_count", lo=1)],
    "weather": [Check("row_count", "row_count", lo=0)],
}

# Thresholds of the reference's expectation suites (code copy).
SUITE_CHECKS: dict[str, list[Check]] = {
    "wfp_prices": [
        Check("row_count", "row_count", lo=1000, hi=500000),
        *[Check(f"not_null_{c}", "not_null", c) for c in ("market_name", "commodity_name", "price", "price_date")],
        Check("price_between", "between", "price", lo=0.01, hi=200000),
    ],
    "worldbank_prices": [
        Check("row_count", "row_count", lo=1000, hi=200000),
        *[Check(f"not_null_{c}", "not_null", c) for c in ("market_name", "commodity_name", "price", "price_date")],
        Check("price_between", "between", "price", lo=1, hi=50000),
    ],
    "nbs_prices": [
        Check("row_count", "row_count", lo=10, hi=50000),
        Check("not_null_commodity_name", "not_null", "commodity_name"),
        Check("not_null_price", "not_null", "price"),
        Check("price_between", "between", "price", lo=50, hi=50000),
    ],
    "cbn_rates": [
        Check("row_count", "row_count", lo=1, hi=100000),
        Check("not_null_rate_date", "not_null", "rate_date"),
        Check("not_null_central_rate", "not_null", "central_rate"),
        Check("central_rate_between", "between", "central_rate", lo=100, hi=5000),
    ],
    "weather": [
        Check("row_count", "row_count", lo=0, hi=500000),
        Check("not_null_market_name", "not_null", "market_name"),
        Check("not_null_weather_date", "not_null", "weather_date"),
        Check("temperature_max_between", "between", "temperature_max", lo=15, hi=50, mostly=0.95),
        Check("precipitation_between", "between", "precipitation_mm", lo=0, hi=500, mostly=0.95),
    ],
}

# The stored JSON expectation suites. No reference code loads
# them and their thresholds differ from the code suites above (which are
# authoritative); they are offered for their extra kinds: distinct values in
# a set (Q6), more columns in range, and the schema checks below (Q4, Q5).
JSON_SUITE_CHECKS: dict[str, list[Check]] = {
    "wfp_prices": [
        Check("row_count", "row_count", lo=1000, hi=200000),
        *[Check(f"not_null_{c}", "not_null", c) for c in ("market_name", "commodity_name", "price", "price_date")],
        Check("price_between", "between", "price", lo=0.01, hi=100000),
    ],
    "worldbank_prices": [
        Check("row_count", "row_count", lo=1000, hi=100000),
        *[Check(f"not_null_{c}", "not_null", c) for c in ("market_name", "commodity_name", "price")],
        Check("price_between", "between", "price", lo=1, hi=50000),
        Check("source_in_set", "in_set", "source", values=("WorldBank",)),
    ],
    "nbs_prices": [
        Check("row_count", "row_count", lo=10, hi=10000),
        Check("not_null_commodity_name", "not_null", "commodity_name"),
        Check("not_null_price", "not_null", "price"),
        Check("price_between", "between", "price", lo=50, hi=50000),
    ],
    "cbn_rates": [
        Check("row_count", "row_count", lo=1, hi=100000),
        Check("not_null_rate_date", "not_null", "rate_date"),
        Check("not_null_central_rate", "not_null", "central_rate"),
        Check("central_rate_between", "between", "central_rate", lo=100, hi=5000),
        Check("buying_rate_between", "between", "buying_rate", lo=100, hi=5000),
        Check("selling_rate_between", "between", "selling_rate", lo=100, hi=5000),
    ],
    "weather": [
        Check("row_count", "row_count", lo=100, hi=500000),
        Check("not_null_market_name", "not_null", "market_name"),
        Check("not_null_weather_date", "not_null", "weather_date"),
        Check("temperature_max_between", "between", "temperature_max", lo=15, hi=50),
        Check("temperature_min_between", "between", "temperature_min", lo=5, hi=40),
        Check("precipitation_between", "between", "precipitation_mm", lo=0, hi=500),
        Check("humidity_between", "between", "humidity_pct", lo=0, hi=100),
    ],
}
# The JSON suites' column-exists and numeric-type checks, as
# (columns that must exist, columns that must be numeric).
JSON_SCHEMA_CHECKS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "wfp_prices": (("market_name", "commodity_name", "price", "price_date"), ("price",)),
    "worldbank_prices": (("market_name", "commodity_name", "price", "price_date"), ()),
    "nbs_prices": (("commodity_name", "price"), ()),
}

# dbt-style mart tests: unique + not null on keys (Q9, Q10).
MART_CHECKS: dict[str, list[Check]] = {
    "fct_daily_prices": [
        Check("unique_price_id", "unique", "price_id"),
        Check("not_null_price_id", "not_null", "price_id"),
        Check("not_null_price_date", "not_null", "price_date"),
        Check("not_null_market_name", "not_null", "market_name"),
        Check("not_null_commodity_name", "not_null", "commodity_name"),
        Check("not_null_price_ngn", "not_null", "price_ngn"),
    ],
    "fct_weekly_prices": [
        Check("unique_weekly_price_id", "unique", "weekly_price_id"),
        Check("not_null_weekly_price_id", "not_null", "weekly_price_id"),
    ],
    "fct_monthly_prices": [
        Check("unique_monthly_price_id", "unique", "monthly_price_id"),
        Check("not_null_monthly_price_id", "not_null", "monthly_price_id"),
    ],
    "dim_markets": [
        Check("unique_market_name", "unique", "market_name"),
        Check("not_null_market_name", "not_null", "market_name"),
    ],
    "dim_commodities": [
        Check("unique_commodity_name", "unique", "commodity_name"),
        Check("not_null_commodity_name", "not_null", "commodity_name"),
    ],
}


def run_suites(
    tables: dict[str, DataFrame], suites: dict[str, list[Check]], as_of: dt.date | None = None
) -> DataFrame:
    """All tables' reports as one DataFrame (one aggregate job per table)."""
    parts = [run_checks(df, name, suites[name], as_of) for name, df in tables.items() if name in suites]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def price_stats(df: DataFrame, col: str = "price") -> DataFrame:
    """min / max / avg over non-null values."""
    c = F.col(col)
    cents = F.round(c * 100).cast("bigint")
    return df.where(c.isNotNull()).agg(
        F.min(c).alias("min_price"),
        F.max(c).alias("max_price"),
        (F.sum(cents) / F.count(cents) / 100).alias("avg_price"),
    )
