"""Tables that are replaced as a whole, safely (K3, K9).

A version is a folder of its own below the table's path. A pointer, a small file with
a running number, names the version that readers take; it is written last and never
overwritten. A replacement that fails before leaves no pointer, and a reader that has
started keeps its files, as they stay until ``vacuum`` drops old versions. Of two
writers with the same number, the second fails instead of hiding the first.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

POINTERS, VERSIONS = "_pointers", "_versions"


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of every committed version, oldest first."""
    fs, place = _fs(spark, f"{path}/{POINTERS}")
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted((int(n.split("-", 1)[0]), n.split("-", 1)[1]) for n in names if n[0].isdigit())


def commit(spark: SparkSession, path: str, version: str) -> None:
    """Point readers to ``version``. The number is claimed by a file that must not exist yet."""
    number = (pointers(spark, path) or [(0, "")])[-1][0] + 1
    fs, claim = _fs(spark, f"{path}/{POINTERS}/.claim-{number:08d}")
    fs.create(claim, False).close()  # raises if another writer has this number
    fs.create(_fs(spark, f"{path}/{POINTERS}/{number:08d}-{version}")[1], False).close()


def replace(tables: Mapping[str, DataFrame] | DataFrame, path: str) -> str:
    """Write the tables (or the one) as a new version, then make it the current one."""
    if isinstance(tables, DataFrame):
        tables = {"data": tables}
    version = uuid.uuid4().hex
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        df.write.parquet(f"{path}/{VERSIONS}/{version}/{name}")
    if spark is None:
        raise ValueError("a version needs a table")
    commit(spark, path, version)
    return version


def current(spark: SparkSession, path: str) -> str:
    """The version that readers take."""
    found = pointers(spark, path)
    if not found:
        raise FileNotFoundError(f"no version of {path}")
    return found[-1][1]


def read(spark: SparkSession, path: str, name: str = "data", version: str | None = None) -> DataFrame:
    return spark.read.parquet(f"{path}/{VERSIONS}/{version or current(spark, path)}/{name}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drop what is neither current nor one of the ``keep`` newest versions; returns what is dropped.

    Folders without a pointer (of failed replacements) go too, so run it while no replacement is under way.
    """
    kept = {v for _, v in pointers(spark, path)[-max(keep, 1) :]}
    fs, place = _fs(spark, f"{path}/{VERSIONS}")
    gone = []
    for status in fs.listStatus(place) if fs.exists(place) else []:
        if (name := status.getPath().getName()) not in kept:
            fs.delete(status.getPath(), True)
            gone.append(name)
    for number, version in pointers(spark, path):
        if version in gone:
            fs.delete(_fs(spark, f"{path}/{POINTERS}/{number:08d}-{version}")[1], False)
    return gone
