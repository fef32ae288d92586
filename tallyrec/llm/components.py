"""Connected components of an edge table by alternating large-star and small-star rounds.

Vertices never leave the cluster; the driver sees two figures per round. A component of any
diameter needs about log(size) rounds, and every round writes at most as many edges as it reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.session import shared_folder


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every vertex with an edge; the root is the smallest vertex.

    Null ends and loops are ignored, repeated edges and either direction are fine. Without edges
    the result is empty. The rounds alternate between two folders, so at most two edge tables
    are left behind.
    """
    spark = edges.sparkSession
    folder = f"{shared_folder(spark)}/components-{uuid.uuid4().hex}"

    def write(df: DataFrame, slot: int) -> tuple[DataFrame, tuple]:
        path = f"{folder}/{slot}"
        df.write.mode("overwrite").parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
        state = table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        return table, tuple(state)

    start = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    table, state = write(start.distinct(), 0)
    slot = 0
    while state[0]:
        slot = 1 - slot
        table, after = write(_small_star(_large_star(table)), slot)
        if after == state:
            break
        state = after
    roots = table.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return table.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a vertex is tied to the smallest vertex around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are all tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    others = edges.join(least, "u").where(F.col("v") != F.col("least"))
    return (
        others.select(F.col("v").alias("u"), F.col("least").alias("v"))
        .unionByName(least.select("u", F.col("least").alias("v")))
        .distinct()
    )
