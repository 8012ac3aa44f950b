"""Connected components of a table of links, by shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: later steps survive the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; the root is the smallest node of the component.

    Stars are rewired by turns: a node's larger neighbours are tied to its smallest neighbour, then a node's
    smaller neighbours are tied to the smallest of them, until nothing changes. Rounds grow with the
    logarithm of a component's size. Each round is a pre-aggregated minimum and a join against it, which adaptive
    execution splits where one node has most of the links; the driver sees a count and a checksum.
    Links between a node and itself and repeated links do no harm.
    """
    # node > parent throughout
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("parent")).filter("node <> parent").distinct()
    edges = staged(edges, "edges")
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("parent").alias("node"), F.col("node").alias("parent")))
        least = both.groupBy("node").agg(F.min("parent").alias("m")).select("node", F.least("m", "node").alias("m"))
        large = both.filter("parent > node").join(least, "node").select(F.col("parent").alias("node"), F.col("m").alias("parent"))
        large = large.filter("node <> parent").distinct()
        least = large.groupBy("node").agg(F.min("parent").alias("m"))
        small = large.join(least, "node")
        tied = small.filter("parent <> m").select(F.col("parent").alias("node"), F.col("m").alias("parent"))
        edges = staged(
            tied.unionByName(least.select("node", F.col("m").alias("parent"))).filter("node <> parent").distinct(), "edges"
        )
        sums = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "parent").cast("decimal(20,0)"))).first()
        if tuple(sums) == last:
            return edges.select("node", F.col("parent").alias("root"))
        last = tuple(sums)
