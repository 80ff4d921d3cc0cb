"""Ranks of rows in the order of a number in [0, 1), without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the number whose sizes are summed up first.
RANGES = 4096


def ranked(rows: DataFrame, number: Column, *ties: str, weight: str | None = None) -> DataFrame:
    """rows with _rank (from 1) by the number, then the ties, _sum, the weight up to and with each row, and _all and _total over all rows.

    Ranks within each of RANGES ranges go on from the counts of the ranges
    before, a table of no more than RANGES rows.
    """
    w = F.col(weight) if weight else F.lit(1)
    placed = rows.withColumn("_h", number).withColumn("_b", F.floor(F.col("_h") * RANGES))
    sizes = placed.groupBy("_b").agg(F.count("*").alias("_n"), F.sum(w).alias("_w"))
    every, up_to = Window.partitionBy(F.lit(1)), Window.partitionBy(F.lit(1)).orderBy("_b")
    before = sizes.select("_b", (F.sum("_n").over(up_to) - F.col("_n")).alias("_n"), (F.sum("_w").over(up_to) - F.col("_w")).alias("_w"), F.sum("_n").over(every).alias("_all"), F.sum("_w").over(every).alias("_total"))
    own = Window.partitionBy("_b").orderBy("_h", *ties)
    joined = placed.join(F.broadcast(before), "_b")
    return joined.withColumn("_rank", F.row_number().over(own) + F.col("_n")).withColumn("_sum", F.sum(w).over(own.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_w")).drop("_h", "_b", "_n", "_w")
