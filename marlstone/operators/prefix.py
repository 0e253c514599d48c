"""Running sums in a global order without a window over everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.stages import stage

#: Parts of the order; each is one window, and their sums are the only thing that a single task sees.
PARTS = 1024


def running_sum(rows: DataFrame, order: list[str], weight: Column, name: str = "running", parts: int | None = None) -> DataFrame:
    """``rows`` with the sum of ``weight`` over all rows up to and with this one, in ``order`` (unique, so the sums are defined).

    Rows are ranged over parts by the order; parts are summed, their sums are added up (at most PARTS rows), and each
    part is then summed within. Decimal and integer weights give exact sums. Staged.
    """
    spark = rows.sparkSession
    n = parts or min(PARTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.withColumn("_w", weight).repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    placed = stage(placed)
    sums = placed.groupBy("_part").agg(F.sum("_w").alias("_s"))
    before = sums.select("_part", (F.sum("_s").over(Window.orderBy("_part")) - F.col("_s")).alias("_before"))
    within = F.sum("_w").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + within).drop("_part", "_before", "_w")


def numbered(rows: DataFrame, order: list[str], name: str = "number", parts: int | None = None) -> DataFrame:
    """``rows`` with their number from 1 in ``order``."""
    return running_sum(rows, order, F.lit(1).cast("long"), name, parts)
