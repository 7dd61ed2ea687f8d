"""Column standardisation and wide <-> long reshaping."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.functions import try_date, try_number


def standardize(
    df: DataFrame,
    rename: Mapping[str, str],
    keep: Sequence[str],
    optional: Sequence[str] = (),
) -> DataFrame:
    """Rename only the columns that exist, then keep ``keep`` plus whichever
    ``optional`` columns are present (P1)."""
    present = {k: v for k, v in rename.items() if k in df.columns}
    out = df.withColumnsRenamed(present) if present else df
    cols = list(keep) + [c for c in optional if c in out.columns and c not in keep]
    return out.select(*cols)


def parse_numbers(df: DataFrame, cols: Sequence[str], dtype: str = "decimal(12,2)") -> DataFrame:
    """Tolerant numeric parse of text columns: unparseable -> NULL."""
    return df.withColumns({c: try_number(F.col(c), dtype) for c in cols})


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows NULL in any of ``keys``."""
    return df.dropna(subset=list(keys))


def parse_dates(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Timestamp or text -> DATE; ``fmt`` e.g. 'yyyy-MM' gives the 1st.
    Malformed text becomes NULL (tolerant, ANSI-safe)."""
    return df.withColumns({c: try_date(c, fmt) for c in cols})


def date_between(df: DataFrame, col: str, start: dt.date | None = None, end: dt.date | None = None):
    """Inclusive optional date-range filter (P5); pushed down to the scan."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end))
    return df


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Mapping[str, str],
    name_col: str = "commodity_name",
    value_col: str = "price",
) -> DataFrame:
    """One row per (ids, wide column) for the listed columns that exist, the
    column renamed to its display name; NULL values dropped (R1)."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError("none of the wide columns is present")
    long = df.unpivot(list(ids), present, "_col", value_col)
    names = F.create_map(*[x for c in present for x in (F.lit(c), F.lit(columns[c]))])
    return long.where(F.col(value_col).isNotNull()).select(
        *ids, names[F.col("_col")].alias(name_col), value_col
    )


def wide_to_long_paired(
    df: DataFrame,
    ids: Sequence[str],
    columns: Mapping[str, str],
    conf_prefix: str = "c_",
    name_col: str = "commodity_name",
    value_col: str = "price",
    conf_col: str = "confidence",
) -> DataFrame:
    """Like ``wide_to_long`` but each value ``x`` travels with its companion
    column ``c_x`` (NULL when that column is absent) (R2)."""
    present = [c for c in columns if c in df.columns]
    pairs = F.array(
        *[
            F.struct(
                F.lit(columns[c]).alias(name_col),
                F.col(c).cast("double").alias(value_col),
                (F.col(conf_prefix + c) if conf_prefix + c in df.columns else F.lit(None))
                .cast("double")
                .alias(conf_col),
            )
            for c in present
        ]
    )
    long = df.select(*ids, F.inline(pairs))
    return long.where(F.col(value_col).isNotNull())
