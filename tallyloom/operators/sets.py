"""Set comparison of allele tables: baseline against follow-up, caller against caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contrast(left: DataFrame, right: DataFrame, key: list[str], names: tuple[str, str, str] = ("shared", "A_only", "B_only"), attributes: list[str] | None = None) -> DataFrame:
    """key, attributes and contrast: in both, only left or only right; one aggregation, no join.

    Attributes are those of the key's least row, of the left side where it has one.
    """
    attributes = attributes or []
    rows = left.select(*key, *attributes, F.lit(0).alias("_side")).unionByName(right.select(*key, *attributes, F.lit(1).alias("_side")))
    first = [F.min(F.struct("_side", *attributes)).alias("_first")] if attributes else []
    n = rows.groupBy(*key).agg(F.min("_side").alias("_a"), F.max("_side").alias("_b"), *first)
    side = F.when(F.col("_a") != F.col("_b"), names[0]).when(F.col("_a") == 0, names[1]).otherwise(names[2])
    return n.select(*key, *[F.col(f"_first.{c}").alias(c) for c in attributes], side.alias("contrast"))


def baseline_partition(rows: DataFrame, subject: str, allele: list[str], baseline: str) -> DataFrame:
    """subject, allele and partition (shared, baseline_only, nonbaseline_only): one aggregation, no join.

    Subjects without a baseline row have nonbaseline_only alleles alone.
    """
    side = rows.groupBy(subject, *allele).agg(F.bool_or(baseline).alias("_b"), F.bool_or(~F.col(baseline)).alias("_f"))
    return side.select(subject, *allele, F.when(F.col("_b") & F.col("_f"), "shared").when(F.col("_b"), "baseline_only").otherwise("nonbaseline_only").alias("partition"))


def common_exclusive(rows: DataFrame, group: str, member: str, item: str) -> DataFrame:
    """group, item, members (how many hold it), kind: common to all members of its group, exclusive to one, or partial; exclusive_to names that one."""
    total = rows.groupBy(group).agg(F.countDistinct(member).alias("_all"))
    each = rows.groupBy(group, item).agg(F.countDistinct(member).alias("members"), F.min(member).alias("_one"))
    out = each.join(total, group)
    return out.select(group, item, "members", F.when((F.col("members") == F.col("_all")) & (F.col("_all") > 1), "common").when(F.col("members") == 1, "exclusive").otherwise("partial").alias("kind"), F.when(F.col("members") == 1, F.col("_one")).alias("exclusive_to"))


def caller_sets(left: DataFrame, right: DataFrame, key: list[str], genotype: str) -> DataFrame:
    """key, both genotypes, side and concordance (yes, no, not_comparable) of two callers' alleles; of repeated keys the greatest genotype."""
    rows = left.select(*key, F.col(genotype).alias("_gt"), F.lit(True).alias("_left")).unionByName(right.select(*key, F.col(genotype).alias("_gt"), F.lit(False).alias("_left")))
    both = rows.groupBy(*key).agg(F.max(F.when(F.col("_left"), F.col("_gt"))).alias("left_gt"), F.max(F.when(~F.col("_left"), F.col("_gt"))).alias("right_gt"), F.bool_or("_left").alias("_a"), F.bool_or(~F.col("_left")).alias("_b"))
    side = F.when(F.col("_a") & F.col("_b"), "shared").when(F.col("_a"), "left_only").otherwise("right_only")
    same = F.when(F.col("left_gt").isNull() | F.col("right_gt").isNull(), "not_comparable").when(F.col("left_gt") == F.col("right_gt"), "yes").otherwise("no")
    return both.select(*key, "left_gt", "right_gt", side.alias("side"), same.alias("concordance"))


def caller_metrics(sets: DataFrame) -> DataFrame:
    """One row: counts by side, Jaccard and overlap percent, genotype concordance percent."""
    n = sets.agg(*[F.count_if(F.col("side") == s).alias(s) for s in ("shared", "left_only", "right_only")], F.count_if(F.col("concordance") == "yes").alias("same"), F.count_if(F.col("concordance").isin("yes", "no")).alias("comparable"))
    shared, left, right = F.col("shared"), F.col("left_only"), F.col("right_only")
    return n.select("shared", "left_only", "right_only", F.try_divide(shared * 100.0, shared + left + right).alias("jaccard_percent"), F.try_divide(shared * 100.0, shared + F.least(left, right)).alias("overlap_percent"), F.try_divide(F.col("same") * 100.0, F.col("comparable")).alias("concordance_percent"))


def sample_pairs(samples: DataFrame, subject: str, sample: str) -> DataFrame:
    """All unordered pairs of samples inside a subject; a design table of a few samples each."""
    s = samples.select(subject, sample).distinct()
    return s.withColumnRenamed(sample, "a").join(s.withColumnRenamed(sample, "b"), subject).filter("a < b")


def baseline_pairs(samples: DataFrame, subject: str, sample: str, baseline: str) -> DataFrame:
    """subject, base, followup for subjects with exactly one baseline."""
    one = samples.filter(baseline).groupBy(subject).agg(F.count("*").alias("_n"), F.min(sample).alias("base")).filter("_n = 1").drop("_n")
    return samples.filter(~F.col(baseline)).select(subject, F.col(sample).alias("followup")).join(one, subject).select(subject, "base", "followup")


def union_strict(*tables: DataFrame) -> DataFrame:
    """Of tables with the same columns in the same order; anything else is an error."""
    first = tables[0]
    for other in tables[1:]:
        if other.columns != first.columns:
            raise ValueError(f"headers differ: {first.columns} and {other.columns}")
        first = first.unionByName(other)
    return first


def union_loose(*tables: DataFrame) -> DataFrame:
    """By name; missing columns are null."""
    first = tables[0]
    for other in tables[1:]:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def key_sets_equal(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """One row: keys on one side alone and whether there are none."""
    c = contrast(left, right, key).agg(F.count_if(F.col("contrast") == "A_only").alias("left_only"), F.count_if(F.col("contrast") == "B_only").alias("right_only"))
    return c.withColumn("equal", (F.col("left_only") == 0) & (F.col("right_only") == 0))


def distinct_sequences(proteins: DataFrame, min_length: int = 1) -> DataFrame:
    """One row per sequence, with its first header by (source_no, row_no), at least min_length long."""
    from .windows import best_by

    return best_by(proteins.filter(F.char_length("sequence") >= min_length), ["sequence"], ["source_no", "row_no"])


def odds_contrast(left: DataFrame, right: DataFrame, term: str = "term") -> DataFrame:
    """Terms tested on both sides: log2 of the odds' ratio, and which is larger."""
    a, b = left.select(term, F.col("odds").alias("left_odds")), right.select(term, F.col("odds").alias("right_odds"))
    ratio = F.log2(F.try_divide(F.col("left_odds"), F.col("right_odds")))
    return a.join(b, term).withColumns({"log2_ratio": ratio, "larger": F.when(ratio > 0, "left").when(ratio < 0, "right").otherwise("equal")})
