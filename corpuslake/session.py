"""Session helpers: where intermediate tables go."""

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, on storage that every executor can reach.

    The parent is ``spark.checkpoint.dir``; where that is not set, a folder of the warehouse.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{parent.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def storage(spark: SparkSession, path: str):
    """The file system that Spark reaches ``path`` through, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
