"""Expressions on alleles, genotypes and coordinates.  All are native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Single-base changes within purines or within pyrimidines.
TRANSITIONS = ("AG", "GA", "CT", "TC")
#: Alternative alleles that name no sequence.
SYMBOLIC = (".", "*", "<NON_REF>")


def norm_chrom(chrom: Column) -> Column:
    """Without a leading ``chr``; M becomes MT."""
    plain = F.regexp_replace(chrom, "(?i)^chr", "")
    return F.when(F.upper(plain).isin("M", "MT"), "MT").otherwise(plain)


def allele_type(ref: Column, alt: Column) -> Column:
    """SNV, MNV, INSERTION (alt begins with ref), DELETION (ref begins with alt) or COMPLEX; null without both."""
    a, b = F.char_length(ref), F.char_length(alt)
    return (
        F.when((a == 0) | (b == 0), None)
        .when((a == 1) & (b == 1), "SNV")
        .when(a == b, "MNV")
        .when((b > a) & alt.startswith(ref), "INSERTION")
        .when((a > b) & ref.startswith(alt), "DELETION")
        .when(ref.isNotNull() & alt.isNotNull(), "COMPLEX")
    )


def is_transition(ref: Column, alt: Column) -> Column:
    return F.concat(F.upper(ref), F.upper(alt)).isin(*TRANSITIONS)


def zygosity(gt: Column) -> Column:
    """heterozygous, homozygous_alt, missing or other."""
    return F.when(gt.isNull() | (gt == "") | F.contains(gt, F.lit(".")), "missing").when(gt.isin("0/1", "1/0", "0|1", "1|0"), "heterozygous").when(gt.isin("1/1", "1|1"), "homozygous_alt").otherwise("other")


def alt_dosage(gt: Column, index: Column) -> Column:
    """How often an allele's index stands in a genotype; null if a part is missing."""
    parts = F.split(F.regexp_replace(gt, r"\|", "/"), "/")
    return F.when(gt.isNotNull() & ~F.contains(gt, F.lit(".")), F.size(F.filter(parts, lambda x: x == index.cast("string"))))


def common_suffix(a: Column, b: Column) -> Column:
    """Length of the longest common suffix."""
    return common_prefix(F.reverse(a), F.reverse(b))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    most = F.least(F.char_length(a), F.char_length(b))
    return F.aggregate(F.sequence(F.lit(0), most), F.lit(0), lambda best, n: F.when(F.left(a, n) == F.left(b, n), n).otherwise(best))


def annotated_forms(ref: Column, alt: Column) -> Column:
    """Array of the ways in which an annotation may name an allele: as it is, without the base it shares with ref, ``-`` if nothing is left."""
    rest = F.substring(alt, 2, 1 << 30)
    return F.when(F.left(ref, F.lit(1)) == F.left(alt, F.lit(1)), F.array(alt, F.when(rest == "", "-").otherwise(rest))).otherwise(F.array(alt))


def trim_allele(df: DataFrame, pos: str = "pos", ref: str = "ref", alt: str = "alt") -> DataFrame:
    """df with pos, ref and alt trimmed: the common suffix first, then the prefix, at least one base kept in each."""
    r, a = F.col(ref), F.col(alt)
    shortest = F.least(F.char_length(r), F.char_length(a)) - 1
    df = df.withColumn("_cut", F.greatest(F.lit(0), F.least(common_suffix(r, a), shortest)))
    df = df.withColumns({ref: F.left(r, F.char_length(r) - F.col("_cut")), alt: F.left(a, F.char_length(a) - F.col("_cut"))})
    shortest = F.least(F.char_length(F.col(ref)), F.char_length(F.col(alt))) - 1
    df = df.withColumn("_cut", F.greatest(F.lit(0), F.least(common_prefix(F.col(ref), F.col(alt)), shortest)))
    return df.withColumns({pos: F.col(pos) + F.col("_cut"), ref: F.expr(f"substring({ref}, _cut + 1)"), alt: F.expr(f"substring({alt}, _cut + 1)")}).drop("_cut")


def split_multiallelic(df: DataFrame, alt: str = "alt") -> DataFrame:
    """One row for each alternative allele, with its allele_index from 1; symbolic ones are left out."""
    out = df.select("*", F.posexplode(F.split(F.col(alt), ",")).alias("_at", "_alt"))
    return out.withColumns({alt: F.col("_alt"), "allele_index": F.col("_at") + 1}).drop("_at", "_alt").filter(~F.col(alt).isin(*SYMBOLIC))


def coordinate_label(chrom: Column, position: Column) -> Column:
    """``chr1:12,345``"""
    return F.concat(F.lit("chr"), F.regexp_replace(chrom, "^chr", ""), F.lit(":"), F.format_number(position, 0))
