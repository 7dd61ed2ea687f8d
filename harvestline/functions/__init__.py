"""Column-expression helpers. All are built-in Spark expressions (JVM side,
whole-stage codegen); nothing here is a Python UDF."""

from harvestline.functions.exprs import (
    SURROGATE_NULL,
    cents,
    is_lean_season,
    is_rainy_season,
    label_with_state,
    surrogate_key,
    trend_label,
    try_date,
    ts_literal,
    try_number,
    winner_label,
)

__all__ = [
    "SURROGATE_NULL",
    "cents",
    "is_lean_season",
    "is_rainy_season",
    "label_with_state",
    "surrogate_key",
    "trend_label",
    "try_date",
    "ts_literal",
    "try_number",
    "winner_label",
]
