"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the sentinel the surrogate-key macro substitutes for NULL parts.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the '-'-joined text of the parts, NULL parts replaced (P20)."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def try_number(c: str | Column, dtype: str = "decimal(12,2)") -> Column:
    """Tolerant numeric parse: bad text becomes NULL instead of failing."""
    return _col(c).try_cast(dtype)


def try_date(c: str | Column, fmt: str | None = None) -> Column:
    """Tolerant date parse of landed text: malformed -> NULL (ANSI-safe).
    Without ``fmt``, ISO dates, 'YYYY-MM' and ISO timestamps are accepted."""
    if fmt:
        return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")
    return _col(c).try_cast("date")


def ts_literal(ts, ntz: bool = False) -> Column:
    """A timestamp literal parsed by Spark from ISO text, so a naive Python
    datetime is never shifted by the driver process's local time zone."""
    text = ts.isoformat(sep=" ") if hasattr(ts, "isoformat") else str(ts)
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def cents(c: str | Column) -> Column:
    """Integer cents of a 2-decimal amount: exact for DECIMAL(p,2), and for a
    double holding cents/100 the rounding recovers the integer."""
    return F.round(_col(c) * 100).cast("bigint")


def is_rainy_season(month: Column) -> Column:
    # Rainy season April..October.
    return month.between(4, 10).cast("int")


def is_lean_season(month: Column) -> Column:
    # Lean season June..August.
    return month.between(6, 8).cast("int")


def label_with_state(market: str | Column, state: str | Column) -> Column:
    """'market (state)', or the market alone when the state is unknown."""
    m, s = _col(market), _col(state)
    return F.when(s.isNotNull(), F.concat(m, F.lit(" ("), s, F.lit(")"))).otherwise(m)


def trend_label(change_pct: str | Column, band: float = 2.0) -> Column:
    """Rising above +band %, Falling below -band %, otherwise Stable."""
    c = _col(change_pct)
    return (
        F.when(c > band, F.lit("Rising"))
        .when(c < -band, F.lit("Falling"))
        .otherwise(F.lit("Stable"))
    )


def winner_label(improvement: str | Column) -> Column:
    """Model-vs-baseline winner from the sign of the improvement."""
    c = _col(improvement)
    return F.when(c > 0, F.lit("ML Model")).otherwise(F.lit("Simple baseline"))
