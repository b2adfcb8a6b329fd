"""Connected components of an edge table by alternating large and small stars.

Every round is two joins and an aggregate over the edge table, written to the shared folder; nothing but a row count
and a checksum reaches the driver. The joins put both sides through an exchange of their own, so that AQE can split a
hub's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.store import drop, shared_dir


def _least_neighbour(sym: DataFrame) -> DataFrame:
    # Grouping by a struct keeps the aggregate's partitioning apart from the join's key: the join gets its own exchange.
    return sym.groupBy(F.struct("u").alias("k")).agg(F.min("v").alias("m")).select(F.col("k.u").alias("u"), F.least("m", F.col("k.u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    sym = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = sym.join(_least_neighbour(sym), "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``edges(u long, v long)`` -> ``(node long, component long)`` for every node that is not its component's least.

    Self loops and rows with a null end are ignored; repeated edges count once. An empty table gives an empty table.
    """
    spark = edges.sparkSession
    path = shared_dir(spark)
    edges.select("u", "v").where("u <> v").distinct().write.parquet(path)
    before = None
    for _ in range(max_rounds):
        now = spark.read.schema("u long, v long").parquet(path)
        n, check = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, check) == before or n == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = (n, check)
        middle, after = shared_dir(spark), shared_dir(spark)
        _large_star(now).write.parquet(middle)
        _small_star(spark.read.schema("u long, v long").parquet(middle)).write.parquet(after)
        drop(spark, middle)
        drop(spark, path)
        path = after
    raise RuntimeError("the components did not settle")
