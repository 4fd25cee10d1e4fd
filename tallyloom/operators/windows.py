"""Window and top-k operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in an order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def cap_per_group(df: DataFrame, keys: list[str], order: list[Column | str], limit: Column | int) -> DataFrame:
    """The first rows of each key, as many as limit says; a report's bound, with rank from 1."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= limit)


def merge_intervals(df: DataFrame, keys: list[str], touch: int = 1) -> DataFrame:
    """keys, start, end, n of merged closed intervals; those up to touch apart are one."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # each interval once, so that the order has no ties
    rows = df.groupBy(*keys, "start", "end").agg(F.count("*").alias("_rows"))
    rows = rows.withColumn("_new", F.when(F.col("start") > F.max("end").over(before) + touch, 1).when(F.max("end").over(before).isNull(), 1).otherwise(0))
    rows = rows.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("_rows").alias("n")).drop("_island")


def exon_junctions(exons: DataFrame, *, by_strand: bool = False) -> DataFrame:
    """transcript, chrom, junction_no, start, end (intron bases), offset (transcript bases before it) from exons (transcript, chrom, start, end).

    In genomic order; by_strand those of strand - run from the last exon to the first.
    """
    order = Window.partitionBy("transcript", "chrom").orderBy("start", "end")
    if by_strand:
        back = F.when(F.col("strand") == "-", -1).otherwise(1)
        order = Window.partitionBy("transcript", "chrom").orderBy(F.col("start") * back, F.col("end") * back)
        rows = exons.withColumns({"_start": F.lead("start").over(order), "_end": F.lead("end").over(order), "junction_no": F.row_number().over(order), "offset": F.sum(F.col("end") - F.col("start") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))})
        minus = F.col("strand") == "-"
        first, last = F.when(minus, F.col("_end")).otherwise(F.col("end")) + 1, F.when(minus, F.col("start")).otherwise(F.col("_start")) - 1
        return rows.filter(F.col("_start").isNotNull()).select("transcript", "chrom", "junction_no", first.alias("start"), last.alias("end"), "offset")
    rows = exons.withColumns({"_next": F.lead("start").over(order), "junction_no": F.row_number().over(order), "offset": F.sum(F.col("end") - F.col("start") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    return rows.filter(F.col("_next").isNotNull()).select("transcript", "chrom", "junction_no", (F.col("end") + 1).alias("start"), (F.col("_next") - 1).alias("end"), "offset")


def junction_phase(junctions: DataFrame, hits: DataFrame, min_anchor: int = 2) -> DataFrame:
    """For each junction inside a translated peptide: phase, residues left and right of it, whether it is spanned.

    junctions: transcript, junction_no, offset (bases before it); hits:
    transcript, orf_start (first base, 1-based), peptide, start (residue, 1-based).
    """
    rows = hits.join(junctions, "transcript").withColumn("_coding", F.col("offset") - F.col("orf_start") + 1)
    left = F.floor(F.col("_coding") / 3) - (F.col("start") - 1)
    rows = rows.withColumns({"phase": F.pmod("_coding", F.lit(3)), "left": left, "right": F.char_length("peptide") - left - F.when(F.pmod("_coding", F.lit(3)) > 0, 1).otherwise(0)})
    return rows.filter((F.col("left") >= 0) & (F.col("right") >= 0)).withColumn("spanning", F.least("left", "right") >= min_anchor).drop("_coding")


def top_terms(df: DataFrame, keys: list[str], k: int, most_fdr: float = 0.1) -> DataFrame:
    """The k best terms of each analysis by (fdr, size, id), those of size over 0 and a low fdr."""
    return cap_per_group(df.filter((F.col("fdr") <= most_fdr) & (F.col("size") > 0)), keys, ["fdr", F.desc("size"), "term"], k)


def nonredundant_terms(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Terms with an effect, one for each name without case and punctuation, the k best by (fdr, term)."""
    effect = ((F.col("odds") >= 1.5) & (F.col("size") >= 5)) | ((F.abs("mean") >= 0.25) & (F.abs("z") >= 2))
    rows = df.filter(effect).withColumn("_name", F.regexp_replace(F.lower("name"), "[^a-z0-9]+", " "))
    return cap_per_group(best_by(rows, [*keys, "_name"], ["fdr", "term"]), keys, ["fdr", "term"], k).drop("_name")


def occurrence_choice(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key from occurrences (start, validated): the one validated, AMBIGUOUS for several, else the first."""
    n = df.groupBy(*keys).agg(F.count_if("validated").alias("n_valid"), F.min(F.when(F.col("validated"), F.col("start"))).alias("_v"), F.min("start").alias("_f"))
    return n.select(*keys, "n_valid", F.when(F.col("n_valid") > 1, "AMBIGUOUS").when(F.col("n_valid") == 1, "VALIDATED").otherwise("FIRST").alias("choice"), F.when(F.col("n_valid") == 1, F.col("_v")).when(F.col("n_valid") == 0, F.col("_f")).alias("start"))


def consolidate(df: DataFrame, key: str, class_order: list[str]) -> DataFrame:
    """One row per key: classes and sources united, the other columns from the row of the first class in class_order."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in class_order]), F.col("class")), F.lit(0))
    rank = F.when(rank == 0, len(class_order) + 1).otherwise(rank)
    chosen = best_by(df.withColumn("_r", rank), [key], ["_r", "source"]).drop("_r", "class", "source")
    sets = df.groupBy(key).agg(F.array_sort(F.collect_set("class")).alias("classes"), F.array_sort(F.collect_set("source")).alias("sources"))
    return chosen.join(sets, key)


def chromosome_order(chrom: str = "chrom") -> list[Column]:
    """Numbers first, by value, then names."""
    return [F.asc_nulls_last(F.col(chrom).try_cast("int")), F.asc(chrom)]
