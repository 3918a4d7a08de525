"""Surrogate keys 1..n in a sorted order (WIN-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.operators.materialize import stage


def assign_ids(
    df: DataFrame,
    name: str,
    order: list[Column],
    *,
    one_task_rows: int = 100_000,
    ranges: int | None = None,
) -> DataFrame:
    """Put ``name`` = 1..n first, numbered in ``order``, which must be a total order.

    A table of up to ``one_task_rows`` rows is numbered by one window. A larger one is split into ranges that
    are numbered on their own and shifted by the sizes of the ranges before them.
    """
    if df.limit(one_task_rows + 1).count() <= one_task_rows:
        numbered = df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
        return numbered.select(name, *df.columns)

    spark = df.sparkSession
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(
        df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    # At most `parts` shifts exist, so this broadcast cannot grow with the data.
    numbered = ranged.join(F.broadcast(shifts), "_range").withColumn(
        name, (inside + F.col("_shift")).cast("int")
    )
    return numbered.select(name, *df.columns)
