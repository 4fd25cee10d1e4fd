"""Statistics as native expressions: gamma, hypergeometric tail, ranks, false-discovery rate."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.lineage import checkpointed, ranged

#: Lanczos' approximation of the gamma function for g = 7.
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def ln_gamma(x: Column) -> Column:
    """For x of 0.5 or more."""
    z = x - 1
    total = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + i)
    t = z + 7.5
    return F.lit(0.9189385332046727) + (z + 0.5) * F.log(t) - t + F.log(total)


def ln_choose(n: Column, k: Column) -> Column:
    return ln_gamma(n + 1.0) - ln_gamma(k + 1.0) - ln_gamma(n - k + 1.0)


def hypergeom_tail(k: Column, drawn: Column, marked: Column, total: Column, empty: float = 0.0) -> Column:
    """P(X >= k) for X marked ones among drawn of total; empty if no value is possible.

    The first term comes from ln_gamma, the rest by the ratio of neighbours.
    """
    k, drawn, marked, total = (x.cast("double") for x in (k, drawn, marked, total))
    low = F.greatest(k, drawn + marked - total, F.lit(0.0))
    high = F.least(drawn, marked)
    first = F.exp(ln_choose(marked, low) + ln_choose(total - marked, drawn - low) - ln_choose(total, drawn))
    steps = F.sequence(F.lit(0), F.greatest(F.lit(0), (high - low).cast("int") - 1))

    def step(acc: Column, i: Column) -> Column:
        x = low + i
        ratio = ((marked - x) * (drawn - x)) / ((x + 1) * (total - marked - drawn + x + 1))
        term = acc["term"] * ratio
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    start = F.struct(first.alias("term"), first.alias("sum"))
    tail = F.when(high > low, F.aggregate(steps, start, step)["sum"]).otherwise(first)
    return F.when(low > high, F.lit(empty)).otherwise(F.least(F.lit(1.0), tail))


def cumulated(df: DataFrame, value: str) -> DataFrame:
    """value, n (rows of it), below (rows of a lesser one), total, _range: by ranges of the distinct values, so that no task sorts all of them."""
    each = ranged(df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n")), [F.asc(value)])
    sums = each.groupBy("_range").agg(F.sum("n").alias("_sum"))
    # one row for each range
    order = Window.orderBy("_range")
    sums = sums.select("_range", (F.sum("_sum").over(order) - F.col("_sum")).alias("_base"), F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    inside = Window.partitionBy("_range").orderBy(value)
    return each.join(F.broadcast(sums), "_range").select(value, "n", (F.col("_base") + F.sum("n").over(inside) - F.col("n")).alias("below"), "total", "_range")


def bh_fdr(df: DataFrame, p: str, partition: list[str], out: str = "fdr") -> DataFrame:
    """df with Benjamini-Hochberg's q of p inside each partition, null for a null p; equal values have one q."""
    if partition:
        up = Window.partitionBy(*partition).orderBy(p)
        back = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        df = df.withColumn("_rank", F.row_number().over(up)).withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy(*partition)))
        return df.withColumn(out, F.least(F.lit(1.0), F.min(F.col(p) * F.col("_m") / F.col("_rank")).over(back))).drop("_rank", "_m")
    df = checkpointed(df)
    each = cumulated(df, p).withColumn("_q", F.col(p) * F.col("total") / (F.col("below") + F.col("n")))
    later = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    least = each.groupBy("_range").agg(F.min("_q").alias("_least")).select("_range", F.min("_least").over(later).alias("_later"))
    back = Window.partitionBy("_range").orderBy(p).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    each = each.join(F.broadcast(least), "_range").select(p, F.least(F.lit(1.0), F.min("_q").over(back), F.coalesce("_later", F.lit(1.0))).alias(out))
    return df.join(each, p, "left").select(*df.columns, out)


def tied_ranks(df: DataFrame, score: str, partition: list[str], out: str = "rank") -> DataFrame:
    """df with the average rank of equal scores, in ascending order; null for a null score."""
    if partition:
        order = Window.partitionBy(*partition).orderBy(score)
        ties = Window.partitionBy(*partition, score)
        return df.withColumn(out, F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / 2.0)
    df = checkpointed(df)
    each = cumulated(df, score).select(score, (F.col("below") + (F.col("n") + 1) / 2.0).alias(out))
    return df.join(each, score, "left").select(*df.columns, out)


def two_sided_normal_p(z: Column) -> Column:
    """erfc(|z| / sqrt 2) as a vectorised function; Spark has none of its own."""
    @F.pandas_udf("double")
    def erfc(x: pd.Series) -> pd.Series:
        return x.map(lambda v: math.erfc(abs(v) / math.sqrt(2)) if v == v and v is not None else None)

    return erfc(z)
