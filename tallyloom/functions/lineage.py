"""Cutting a plan's lineage where it would be planned, and run, several times."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the session's shared folder and read from there.

    Where spark.checkpoint.dir is unset, a local master gets a folder of its own;
    on a cluster, whose executors couldn't read one, that is an error.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def ranged(df: DataFrame, order: list[Column], out: str = "_range") -> DataFrame:
    """df, written, dealt to ranges of an order with their numbers in that order.

    Spark samples the bounds, so ranges are about equally large whatever the
    values' spread; rows that are equal in the order share one.
    """
    return checkpointed(df.repartitionByRange(*order).withColumn(out, F.spark_partition_id()))


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """df with the rows' numbers from 1 in an order, counted by ranges; the order should have no ties."""
    rows = ranged(df, order)
    # one row for each range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_nth", inside).join(F.broadcast(base), "_range").withColumn(out, F.col("_base") + F.col("_nth")).drop("_range", "_nth", "_base")
