"""Helpers shared by the operators: table reads, shared scratch space, schemas."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BATCH_ROWS = 1000
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs the rereading of a file, never the
    work before it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def hinted(df: DataFrame, width: Column, bound: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if its rows' widths sum up to ``bound`` bytes at most."""
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= bound else df


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "written_at", None):
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z alone; every other character stays."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI (``file:``, ``hdfs:``, ``s3:`` ... or a plain path)."""
    if "://" not in uri:
        if uri.startswith("file:"):
            uri = uri[5:]
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_once(fs: pafs.FileSystem, path: str, chunks) -> int:
    """Write a file under a private name, then move it into place.

    A retried or speculative task writes the same bytes again and replaces the
    file as a whole, so readers never see a torn one. Returns the bytes written.
    """
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    n = 0
    with fs.open_output_stream(part, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            n += len(chunk)
    fs.move(part, path)
    return n


def ship(spark: SparkSession) -> None:
    """Make a session ready for the operators.

    A worker imports the operators' modules; where the package is neither
    installed on the executors nor passed with ``--py-files``, Spark hands out
    this archive of it, once per application. Rows are whole texts, so that
    batches between the JVM and Python hold fewer of them than usual.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_harvestline_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    with tempfile.NamedTemporaryFile(prefix="harvestline-", suffix=".zip", delete=False) as f:
        with zipfile.ZipFile(f, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
    sc.addPyFile(f.name)
    sc._harvestline_shipped = True


_state: tuple[tuple, object] | None = None


def worker_state(key: tuple, make: Callable[[], object]) -> object:
    """What a Python worker keeps between the tasks of one operator.

    A worker keeps one such object: another operator's replaces it, so that
    memory holds what the current stage needs.
    """
    global _state
    if _state is None or _state[0] != key:
        _state = None  # let go of the old one before the new one is made
        _state = (key, make())
    return _state[1]


def drop_worker_state() -> None:
    """For operators that keep nothing between tasks."""
    global _state
    _state = None
