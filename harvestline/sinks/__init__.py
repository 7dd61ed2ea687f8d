"""Writers (K1-K9). Every writer is a DataFrame write; nothing is collected.

Targets are either a path (parquet/csv files in shared storage) or, with
``table=``, a catalog table. Appends carry a run stamp so reloads can be
deduplicated downstream (staging keeps the newest ``ingested_at``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline import schemas
from harvestline.functions import ts_literal
from harvestline.operators import quality


def _writer(df: DataFrame, mode: str, fmt: str, partition_by: Sequence[str] | None, **options):
    w = df.write.mode(mode).format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def _save(w, path: str | None, table: str | None) -> None:
    if table:
        w.saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("give a path or a table")


def stamp(df: DataFrame, constants: Mapping[str, object], run_ts: dt.datetime) -> DataFrame:
    """Add constant columns and the load time stamp (K1)."""
    cols = {k: F.lit(v) for k, v in constants.items()}
    cols["ingested_at"] = ts_literal(run_ts)
    return df.withColumns(cols)


def append_raw(
    df: DataFrame,
    constants: Mapping[str, object],
    run_ts: dt.datetime,
    path: str | None = None,
    table: str | None = None,
    schema=None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Append observations to a raw table with constants and ``ingested_at``
    (K1). With ``schema`` the rows are projected and cast to the raw DDL."""
    out = stamp(df, constants, run_ts)
    if schema is not None:
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    _save(_writer(out, "append", fmt, partition_by), path, table)
    return out


def append_checked(
    df: DataFrame,
    constants: Mapping[str, object],
    run_ts: dt.datetime,
    path: str,
    table: str,
    checks: Sequence[quality.Check],
    as_of: dt.date | None = None,
    schema=None,
) -> DataFrame:
    """``append_raw`` that checks the rows in the pass that writes them (K1, Q11).

    Returns the report of ``checks`` on this load's rows; give it to ``quality.gate``
    to stop what follows a failed load (Q12).
    """
    out = stamp(df, constants, run_ts)
    if schema is not None:
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    out, seen = quality.observed(out, checks, as_of)
    _save(_writer(out, "append", "parquet", None), path, None)
    return quality.observed_report(df.sparkSession, seen, table, checks)


def overwrite(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Replace a table or folder with ``df`` (K3, K6, K9 'table')."""
    _save(_writer(df, "overwrite", fmt, partition_by), path, table)


def backup_csv(df: DataFrame, path: str) -> None:
    """CSV copy of an extract, with header (K2). Written by all tasks in
    parallel (one file per partition)."""
    _writer(df, "overwrite", "csv", None, header="true").save(path)


def write_features(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("commodity_name",), buckets: int = 8
) -> None:
    """Feature table as parquet partitioned by commodity, so per-commodity
    training and serving prune to their own folder (K5). Rows are dealt by
    commodity and a hash of the market first: a folder gets a file per bucket,
    not per task, and a frequent commodity is still written by several tasks."""
    bucket = F.pmod(F.xxhash64("market_name"), F.lit(buckets))
    overwrite(df.repartition(*partition_by, bucket), path=path, partition_by=partition_by)


def write_bucketed(
    df: DataFrame, table: str, path: str, by: Sequence[str], order: Sequence[str] = (), buckets: int = 8
) -> DataFrame:
    """A table dealt into buckets by ``by`` and sorted within them: windows, joins and
    aggregates on these keys read it without an exchange (K5). Take as many buckets as a
    shuffle of the table would have partitions; a bucket is written by one task."""
    w = df.repartition(buckets, *by).write.mode("overwrite").format("parquet").option("path", path)
    w.bucketBy(buckets, *by).sortBy(*by, *order).saveAsTable(table)
    return df.sparkSession.table(table)


def to_feature_variant(df: DataFrame, keys: Sequence[str], feature_cols: Sequence[str]) -> DataFrame:
    """The feature values of each row as one VARIANT document (K8): typed inside, its
    fields read by path without a schema."""
    doc = F.to_variant_object(F.struct(*[F.col(c) for c in feature_cols]))
    return df.select(*keys, doc.alias("features"))


def from_feature_variant(df: DataFrame, keys: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """Fields (name -> type) of VARIANT documents by path; one that a document lacks is NULL."""
    return df.select(*keys, *[F.try_variant_get("features", f"$.{c}", t).alias(c) for c, t in fields.items()])


def to_feature_document(df: DataFrame, keys: Sequence[str], feature_cols: Sequence[str]) -> DataFrame:
    """One JSON document of the feature values per row (K8)."""
    doc = F.to_json(F.struct(*[F.col(c) for c in feature_cols]))
    return df.select(*keys, doc.alias("features"))


def log_quality(
    results: DataFrame, suite: str, run_ts: dt.datetime, path: str | None = None, table: str | None = None
) -> DataFrame:
    """Append one quality-log row per run (K4)."""
    row = quality.to_log_row(results, suite, run_ts)
    _save(_writer(row, "append", "parquet", None), path, table)
    return row


def predictions_table(forecasts: DataFrame, created_at: dt.datetime) -> DataFrame:
    """Forecast rows in the declared predictions layout (K7)."""
    ok = forecasts.where(F.col("status") == "ok")
    out = ok.select(
        F.col("market").alias("market_name"),
        F.col("commodity").alias("commodity_name"),
        F.col("forecast_date").alias("prediction_date"),
        F.col("forecast_horizon_days").cast("int"),
        F.col("predicted_price_ngn").cast(schemas.PRICE).alias("predicted_price"),
        F.col("lower_bound_ngn").cast(schemas.PRICE).alias("lower_bound"),
        F.col("upper_bound_ngn").cast(schemas.PRICE).alias("upper_bound"),
        "model_version",
        ts_literal(created_at).alias("created_at"),
    )
    return out


def materialize(df: DataFrame, name: str, as_table: bool, spark: SparkSession, path: str | None = None):
    """'view' models stay lazy temp views; 'table' models are written (K9)."""
    if as_table:
        overwrite(df, path=path, table=None if path else name)
        return spark.read.parquet(path) if path else spark.table(name)
    df.createOrReplaceTempView(name)
    return spark.table(name)
