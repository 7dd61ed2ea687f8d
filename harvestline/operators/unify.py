"""Unified price table: union, name harmonisation, noise filters, IQR fence
(U1, U2, J1, P11, A4, J2).

The harmonised rows are written once: the quartiles read two of their columns,
the fence reads them again. The per-commodity bounds are written too, so that
the join with them is planned with a known size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestline.functions import cents
from harvestline.session import written

# Lower-cased commodity names treated as parsing junk.
JUNK_NAMES = [
    "bottle",
    "loose",
    "one)",
    "penny 2kg",
    "sold loose",
    "medium size",
    "medium size fresh",
    "specify",
]

# Market labels that are aggregates or zones, not markets.
EXCLUDED_MARKETS = [
    "National",
    "Market Average",
    "North Central",
    "North East",
    "North West",
    "South East",
    "South South",
    "South West",
]

UNIFIED_COLUMNS = [
    "price_date",
    "market_name",
    "commodity_name",
    "unit_name",
    "category",
    "price_ngn",
    "source",
]


def union_sources(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of staged sources, each stamped with its source tag."""
    cols = ["price_date", "market_name", "commodity_name", "unit_name", "price_ngn"]
    parts = [df.select(*cols, F.lit(tag).alias("source")) for tag, df in tagged.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dedupe_mapping(mapping: DataFrame) -> DataFrame:
    """One mapping row per raw name (the seed repeats three raw names, which
    would fan out the left join). The smallest (clean_name, category, unit)
    wins, so the choice is deterministic."""
    best = F.min(F.struct("clean_name", "category", "unit")).alias("m")
    return mapping.where(F.col("raw_name").isNotNull()).groupBy("raw_name").agg(best).select(
        "raw_name", "m.clean_name", "m.category", "m.unit"
    )


def harmonise(df: DataFrame, mapping: DataFrame, default_category: str = "Other") -> DataFrame:
    """Left join on the exact raw name; mapped name/unit win, category falls
    back to ``default_category`` (J1)."""
    m = dedupe_mapping(mapping).select(
        F.col("raw_name"),
        F.col("clean_name").alias("_clean"),
        F.col("category").alias("_cat"),
        F.col("unit").alias("_unit"),
    )
    joined = df.join(m, df["commodity_name"] == m["raw_name"], "left")
    return joined.select(
        "price_date",
        "market_name",
        F.coalesce("_clean", "commodity_name").alias("commodity_name"),
        F.coalesce("_unit", "unit_name").alias("unit_name"),
        F.coalesce("_cat", F.lit(default_category)).alias("category"),
        "price_ngn",
        "source",
    )


def drop_noise(
    df: DataFrame,
    junk: Sequence[str] = JUNK_NAMES,
    excluded_markets: Sequence[str] = EXCLUDED_MARKETS,
    min_len: int = 4,
) -> DataFrame:
    """price > 0, name at least ``min_len`` long and not junk, market not an
    aggregate label (P11). A NULL market fails ``NOT IN`` and is dropped, as
    in SQL three-valued logic."""
    name = F.col("commodity_name")
    return df.where(
        (F.col("price_ngn") > 0)
        & (F.length(name) >= min_len)
        & ~F.lower(name).isin(list(junk))
        & ~F.col("market_name").isin(list(excluded_markets))
    )


# Prices are counted in ranges of 2**RANGE_BITS cents to find a quartile's range.
RANGE_BITS = 12
BROADCAST_BYTES = 32 << 20


def iqr_bounds(df: DataFrame, key: str, value: str, k: float = 3.0) -> DataFrame:
    """Per-key interpolated quartiles and the ``k``·IQR fence (A4), exactly.

    No task holds a key's prices: rows are counted per (key, cents) with
    map-side combine, the counts are summed up per price range, running sums
    over a key's ranges say which range holds each of the four ranks that the
    quartiles lie between, and only the prices of those ranges (at most
    2**RANGE_BITS each) are ordered. Interpolation at quarter positions is
    exact in double arithmetic on integer cents.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(key, cents(value).cast("bigint").alias("c")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ranges = counts.groupBy(key, F.shiftright("c", RANGE_BITS).alias("range")).agg(F.sum("n").alias("n"))
    every = Window.partitionBy(key)
    upto = every.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.select(
        key, "range", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(every).alias("total")
    )
    # 0-based positions (total - 1) / 4 and 3 (total - 1) / 4, in quarters
    q1, q3 = F.col("total") - 1, (F.col("total") - 1) * 3
    ranks = {"a1": F.floor(q1 / 4), "b1": F.ceil(q1 / 4), "a3": F.floor(q3 / 4), "b3": F.ceil(q3 / 4)}
    wanted = F.explode(
        F.array(*[F.struct(F.lit(s).alias("stat"), r.cast("bigint").alias("rank")) for s, r in ranks.items()])
    )
    found = (
        ranges.select("*", wanted.alias("w"))
        .where((F.col("w.rank") >= F.col("upto") - F.col("n")) & (F.col("w.rank") < F.col("upto")))
        .select(
            key,
            "range",
            "w.stat",
            (F.col("w.rank") - F.col("upto") + F.col("n")).alias("rank"),
            (q1 % 4 / 4).alias("f1"),
            (q3 % 4 / 4).alias("f3"),
        )
    )
    inside = counts.withColumn("range", F.shiftright("c", RANGE_BITS)).join(found, [key, "range"])
    within = Window.partitionBy(key, "stat").orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.sum("n").over(within)).where(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    )

    def at(stat: str):
        return F.max(F.when(F.col("stat") == stat, F.col("c"))).cast("double")

    def between(low: str, high: str, share: str):
        return at(low) + (at(high) - at(low)) * F.max(share)

    q = inside.groupBy(key).agg(between("a1", "b1", "f1").alias("q1_c"), between("a3", "b3", "f3").alias("q3_c"))
    iqr = F.col("q3_c") - F.col("q1_c")
    return q.select(
        key,
        (F.col("q1_c") / 100).alias("q1"),
        (F.col("q3_c") / 100).alias("q3"),
        (F.col("q1_c") - iqr * k).alias("lo_c"),
        (F.col("q3_c") + iqr * k).alias("hi_c"),
    )


def iqr_fence(df: DataFrame, key: str, value: str, k: float = 3.0) -> DataFrame:
    """Keep rows whose value lies inside [q1 - k·IQR, q3 + k·IQR] of their key
    (inclusive on both ends) (J2).

    ``df`` should be a written table: it is read for the bounds and again for
    the fence. The bounds (a row per key) are written first, so their size is
    known before the join is planned: small ones are broadcast and the price
    rows are not shuffled."""
    b = written(iqr_bounds(df, key, value, k).select(key, "lo_c", "hi_c"), "bounds")
    size = b.agg(F.sum(F.octet_length(key) + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        b = F.broadcast(b)
    c = cents(value)
    return df.join(b, key, "inner").where(c.between(F.col("lo_c"), F.col("hi_c"))).select(*df.columns)


def unified_prices(
    staged: Mapping[str, DataFrame],
    mapping: DataFrame,
    junk: Sequence[str] = JUNK_NAMES,
    excluded_markets: Sequence[str] = EXCLUDED_MARKETS,
    k: float = 3.0,
) -> DataFrame:
    """The unified price table: union -> harmonise -> noise filters -> IQR fence."""
    h = drop_noise(harmonise(union_sources(staged), mapping), junk, excluded_markets)
    return iqr_fence(written(h, "harmonised"), "commodity_name", "price_ngn", k).select(*UNIFIED_COLUMNS)
