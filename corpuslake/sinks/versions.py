"""Small tables that a stream keeps: one folder per micro-batch holds the whole table, older folders go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import storage


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions there are, oldest first."""
    files, root = storage(spark, path)
    if not files.exists(root):
        return []
    names = [f.getPath().getName() for f in files.listStatus(root)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def complete(spark: SparkSession, path: str, version: int) -> bool:
    return storage(spark, f"{path}/version={version}/_SUCCESS")[0].exists(storage(spark, f"{path}/version={version}/_SUCCESS")[1])


def version_before(spark: SparkSession, path: str, version: int, schema: str | StructType) -> DataFrame:
    """The table as the last complete version before this one left it; empty if there is none."""
    earlier = [v for v in versions(spark, path) if v < version and complete(spark, path, v)]
    if not earlier:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={earlier[-1]}")


def latest(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table as it is now."""
    return version_before(spark, path.rstrip("/"), 1 << 62, schema)


def advance(spark: SparkSession, path: str, version: int, schema: str | StructType, step: Callable[[DataFrame], DataFrame]) -> None:
    """Write version ``version``, made by ``step`` from the one before it, and drop those before that.

    A micro-batch that is replayed makes the same version from the same predecessor again; that is why two are kept.
    """
    path = path.rstrip("/")
    step(version_before(spark, path, version, schema)).write.mode("overwrite").parquet(f"{path}/version={version}")
    drop_before(spark, path, version - 1)


def drop_before(spark: SparkSession, path: str, version: int) -> None:
    for old in [v for v in versions(spark, path) if v < version]:
        files, place = storage(spark, f"{path}/version={old}")
        files.delete(place, True)
