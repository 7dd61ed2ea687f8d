"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every session gets. They are correctness settings (time zone, ANSI)
# or scale settings (AQE re-plans shuffles and skewed joins at run time).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Floor for AQE's partition coalescing. Stages over small inputs can be
    # compute-heavy (the ~40 series window functions): keep them spread over
    # the cores instead of merging them into 1 MB partitions. With large
    # shuffles (a cluster at scale) partitions are far above this floor and
    # nothing changes; skew splitting uses the advisory size, untouched here.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Aggregates and windows must hash on all their keys: reusing a
    # partitioning on a subset (e.g. commodity only, after the IQR join)
    # would put a whole hot commodity into one task.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "harvestline",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the base settings applied.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[N]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "12g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if spark.conf.isModifiable(k):  # static ones hold from the start
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only under a ``local[...]`` master
    (tests) is a fresh scratch folder created when the setting is missing; on
    a cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
    local = tempfile.mkdtemp(prefix="harvestline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read
    it back: every consumer reads the written table, and a lost executor costs
    a file read, never the work before it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


# Rows of a side table (a row per commodity, market, model ...) that may be broadcast.
SIDE_ROWS = 200_000


def sized(side: DataFrame, name: str = "side") -> DataFrame:
    """A small table, written and measured: broadcast below the bound, so that the
    rows it is joined to stay where they are."""
    table = written(side, name)
    return F.broadcast(table) if table.count() <= SIDE_ROWS else table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "written_at", None):
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def ship(spark: SparkSession) -> None:
    """Hand the package to the workers, once per application, where it is neither
    installed on the executors nor passed with ``--py-files``."""
    sc = spark.sparkContext
    if getattr(sc, "_harvestline_shipped", False):
        return
    package = Path(__file__).resolve().parent
    with tempfile.NamedTemporaryFile(prefix="harvestline-", suffix=".zip", delete=False) as f:
        with zipfile.ZipFile(f, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
    sc.addPyFile(f.name)
    sc._harvestline_shipped = True
