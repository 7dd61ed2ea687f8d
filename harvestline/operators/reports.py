"""Reporting queries of the API and dashboard, set-oriented (A7, A8, A10-A13,
A17, W9, W14-W17, O1-O3, O6, M9, P15, P16, P18, J5, U3).

The reference answers these for one selected commodity/market at a time; here
each is a DataFrame over all commodities (or filtered by optional keys), so a
caller can pick one or serve many.

Per-commodity "latest date" lookups are an aggregate joined back on the key
rather than a window over the commodity: a commodity holding a third of all
rows would otherwise land in a single window task. The aggregate is tiny (one
row per commodity) and AQE broadcasts it after measuring it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestline.functions import cents, label_with_state, trend_label
from harvestline.session import sized

SERIES = ["market_name", "commodity_name"]
DATE = "price_date"


def mean_price(col: str = "price_ngn") -> F.Column:
    """Mean of a 2-decimal price from exact integer cents (order independent)."""
    c = cents(col)
    return F.sum(c) / F.count(c) / 100


def filter_keys(df: DataFrame, commodity: str | None = None, market: str | None = None):
    """Optional equality filters on commodity and market."""
    if commodity is not None:
        df = df.where(F.col("commodity_name") == commodity)
    if market is not None:
        df = df.where(F.col("market_name") == market)
    return df


def latest_prices(
    df: DataFrame, n: int = 50, commodity: str | None = None, market: str | None = None
) -> DataFrame:
    """Latest observed prices, newest first, at most ``n`` (1..500) rows (O1).

    Ties on the date are ordered by market then commodity so the top-n is
    deterministic. The limit is the feature: Spark plans it as a per-task
    top-n followed by a final merge (TakeOrderedAndProject), never a full sort.
    """
    if not 1 <= n <= 500:
        raise ValueError("limit must be within 1..500")
    out = filter_keys(df, commodity, market).select(DATE, *SERIES, "price_ngn")
    out = out.orderBy(F.col(DATE).desc(), "market_name", "commodity_name").limit(n)
    return out.select(
        F.date_format(DATE, "yyyy-MM-dd").alias(DATE), "market_name", "commodity_name", "price_ngn"
    )


def distinct_list(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of one column (O2, O3)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def with_rank(df: DataFrame, order: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with each row's place (from 1) in ``order``, so that an ordered result stays
    ordered when it is stored. Without ``by`` the rows are numbered by one task: for
    lists and rankings of commodities, markets and models."""
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.partitionBy(F.lit(0)).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w))


def last_dates(daily: DataFrame) -> DataFrame:
    """(commodity_name, _last): each commodity's most recent date, a measured side
    table, so that price rows are not dealt out by commodity for it."""
    return sized(daily.groupBy("commodity_name").agg(F.max(DATE).alias("_last")), "last-dates")


def latest_per_commodity(daily: DataFrame) -> DataFrame:
    """Rows on each commodity's most recent date."""
    j = daily.join(last_dates(daily), "commodity_name")
    return j.where(F.col(DATE) == F.col("_last")).drop("_last")


def snapshot(daily: DataFrame, markets: DataFrame, commodity: str | None = None) -> DataFrame:
    """Latest prices per market with state, zone and display label, cheapest
    first (W9, J5, P15, O6)."""
    snap = latest_per_commodity(filter_keys(daily, commodity))
    dim = markets.select("market_name", "state", "geopolitical_zone")
    j = snap.join(dim, "market_name", "left")
    return j.select(
        "commodity_name",
        DATE,
        "market_name",
        "state",
        "geopolitical_zone",
        label_with_state("market_name", "state").alias("display"),
        "price_ngn",
    ).orderBy("commodity_name", "price_ngn", "market_name")


def labelled_history(
    daily: DataFrame, markets: DataFrame, commodity: str | None = None, market_list: list[str] | None = None
) -> DataFrame:
    """Price history with a 'market (state)' label per row, optionally for one
    commodity and a set of markets (the trends page: P15, P18, J5)."""
    d = filter_keys(daily, commodity)
    if market_list is not None:
        d = d.where(F.col("market_name").isin(list(market_list)))
    j = d.join(markets.select("market_name", "state"), "market_name", "left")
    return j.select(
        "commodity_name",
        "market_name",
        DATE,
        "price_ngn",
        label_with_state("market_name", "state").alias("label"),
    )


def snapshot_kpis(snap: DataFrame) -> DataFrame:
    """Markets, mean, min and max of the latest prices per commodity."""
    return snap.groupBy("commodity_name", DATE).agg(
        F.count(F.lit(1)).alias("markets"),
        mean_price("price_ngn").alias("avg_price"),
        F.min("price_ngn").alias("min_price"),
        F.max("price_ngn").alias("max_price"),
    )


def state_averages(daily: DataFrame, markets: DataFrame, months: int = 3) -> DataFrame:
    """Mean price and row count per (commodity, state, zone) over the last
    ``months`` months of each commodity; rows without a state or zone are
    dropped, as a pandas groupby drops NULL keys (A7)."""
    recent = daily.join(last_dates(daily), "commodity_name").where(
        F.col(DATE) >= F.add_months(F.col("_last"), -months)
    )
    dim = markets.select("market_name", "state", "geopolitical_zone")
    j = recent.join(dim, "market_name", "left").where(
        F.col("state").isNotNull() & F.col("geopolitical_zone").isNotNull()
    )
    return (
        j.groupBy("commodity_name", "state", "geopolitical_zone")
        .agg(mean_price("price_ngn").alias("avg_price"), F.count(F.lit(1)).alias("observations"))
        .orderBy("commodity_name", "avg_price", "state")
    )


def modal_unit(daily: DataFrame) -> DataFrame:
    """Most frequent unit per commodity, ties to the smallest value."""
    return daily.groupBy("commodity_name").agg(F.mode("unit_name", True).alias("unit"))


def top_market(df: DataFrame) -> DataFrame:
    """Market with most rows per commodity; ties go to the smaller name."""
    counts = df.groupBy("commodity_name", "market_name").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct((F.lit(0) - F.col("n")).alias("neg_n"), F.col("market_name"))
    return counts.groupBy("commodity_name").agg(
        F.min_by("market_name", rank).alias("market_name"), F.max("n").alias("rows")
    )


def recent_rows(df: DataFrame, n: int = 180, keys: Sequence[str] = SERIES) -> DataFrame:
    """The last ``n`` rows of every series (W16). A series has at most one row
    per day, so each window partition is calendar-bounded."""
    w = Window.partitionBy(*keys).orderBy(F.col(DATE).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def trend(features: DataFrame, n: int = 30, band: float = 2.0) -> DataFrame:
    """Per series with more than ``n`` rows: latest price vs the price ``n``
    rows from the end (inclusive), change in %, and a trend class (W17, P16)."""
    w = Window.partitionBy(*SERIES).orderBy(F.col(DATE).desc())
    c = cents("price_ngn")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = features.select(
        *SERIES,
        DATE,
        c.alias("_c"),
        F.row_number().over(w).alias("_rn"),
        F.count(F.lit(1)).over(whole).alias("_size"),
    )
    picked = ranked.where(F.col("_rn").isin(1, n) & (F.col("_size") > n))
    g = picked.groupBy(*SERIES).agg(
        F.max(F.when(F.col("_rn") == 1, F.col(DATE))).alias("latest_date"),
        F.max(F.when(F.col("_rn") == 1, F.col("_c"))).alias("_cur"),
        F.max(F.when(F.col("_rn") == n, F.col("_c"))).alias("_prev"),
    )
    change = (F.col("_cur") - F.col("_prev")) / F.col("_prev") * 100
    return g.select(
        *SERIES,
        "latest_date",
        (F.col("_cur") / 100).alias("current_price"),
        (F.col("_prev") / 100).alias("price_n_rows_ago"),
        change.alias("change_pct"),
        trend_label(change, band).alias("trend"),
    )


def latest_row(df: DataFrame, keys: Sequence[str] = SERIES, required: Sequence[str] = ()) -> DataFrame:
    """Newest row per key, optionally among rows where ``required`` are all
    non-null (W14, W15). An aggregate (max_by on the date), so partial
    aggregation bounds the per-key state."""
    src = df.dropna(subset=list(required)) if required else df
    rest = [c for c in src.columns if c not in keys]
    picked = src.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(DATE)).alias("_r"))
    return picked.select(*keys, *[F.col("_r." + c).alias(c) for c in rest])


def project(features: DataFrame, days: int = 30, z: float = 1.96) -> DataFrame:
    """Momentum projection from each series' newest row (M9): price·(1 +
    mom30/30·i) for i = 1..days with a ±z·std band (std falls back to 10 % of
    the price, lower bound floored at 0). A NULL momentum yields no rows."""
    last = latest_row(features.select(*SERIES, DATE, "price_ngn", "mom_pct_change_30d", "roll_std_30d"))
    last = last.where(F.col("mom_pct_change_30d").isNotNull())
    i = F.col("step")
    p = F.col("price_ngn") * (F.col("mom_pct_change_30d") / 30 * i + 1)
    std = F.coalesce(F.col("roll_std_30d"), F.col("price_ngn") * 0.1)
    steps = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("step"))
    return steps.select(
        *SERIES,
        F.date_add(F.col(DATE), i).alias("forecast_date"),
        i.alias("step"),
        p.alias("projected_price"),
        F.greatest(F.lit(0.0), p - std * z).alias("lower"),
        (p + std * z).alias("upper"),
    )


def projection_point(features: DataFrame) -> DataFrame:
    """Single 30-day projection price·(1 + mom30) per series (M9)."""
    last = latest_row(features.select(*SERIES, DATE, "price_ngn", "mom_pct_change_30d"))
    return last.where(F.col("mom_pct_change_30d").isNotNull()).select(
        *SERIES,
        F.col(DATE).alias("latest_date"),
        (F.col("price_ngn") * (F.col("mom_pct_change_30d") + 1)).alias("projected_30d"),
    )


def source_counts(named: Mapping[str, DataFrame], total: str | None = None) -> DataFrame:
    """Rows per source (UNION ALL of counts) (A11, U3). With ``total`` a
    grand-total row with that label is added (summed from the per-source
    counts, so the sources are scanned once)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows") for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if total is not None:
        out = out.unionByName(out.agg(F.sum("rows").cast("bigint").alias("rows")).select(F.lit(total).alias("source"), "rows"))
    return out


def freshness(named: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest date per source as 'YYYY-MM-DD' text."""
    parts = [
        df.agg(F.max(col).cast("string").alias("latest")).select(F.lit(name).alias("source"), "latest")
        for name, (df, col) in named.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct counts of several columns in one pass (A10)."""
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])
