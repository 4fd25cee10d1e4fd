"""The operators on the driver's tables, each with the same query in SQL for DuckDB.

Generic columns stand in for the roles that the operators name: an order's
customer is a subject, its priority a sample, a part a gene, its brand a set.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import alleles, cigar, sequences, units
from tallyloom.operators import aggregates, enrichment, evidence, joins, quality, rules, sets, windows
from tallyloom.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sets -------------------------------------------------------------------


@query("""
SELECT o_custkey, year(o_orderdate)::INTEGER AS order_year, o_orderstatus,
  CASE WHEN bool_or(o_orderpriority = '1-URGENT') AND bool_or(o_orderpriority <> '1-URGENT') THEN 'shared'
       WHEN bool_or(o_orderpriority = '1-URGENT') THEN 'baseline_only' ELSE 'nonbaseline_only' END AS partition
FROM orders GROUP BY ALL
""")
def baseline_partition(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("order_year"), "o_orderstatus", (F.col("o_orderpriority") == "1-URGENT").alias("baseline"))
    return sets.baseline_partition(o, "o_custkey", ["order_year", "o_orderstatus"], "baseline")


_CONTRAST = """
WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'),
c AS (SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey,
  CASE WHEN a.l_partkey IS NOT NULL AND b.l_partkey IS NOT NULL THEN 'shared' WHEN a.l_partkey IS NOT NULL THEN 'A_only' ELSE 'B_only' END AS contrast
  FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey)
"""


@query(_CONTRAST + "SELECT * FROM c")
def pair_contrast(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return sets.contrast(li.filter("l_returnflag = 'A'"), li.filter("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


@query(_CONTRAST + "SELECT contrast, count(*) AS alleles, count(DISTINCT l_partkey) AS genes FROM c GROUP BY contrast")
def pairwise_summary(spark, sf_dir):
    return pair_contrast(spark, sf_dir).groupBy("contrast").agg(F.count("*").alias("alleles"), F.countDistinct("l_partkey").alias("genes"))


_CALLERS = """
WITH a AS (SELECT l_partkey, l_suppkey, max(l_linenumber % 3) AS left_gt FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL),
b AS (SELECT l_partkey, l_suppkey, max(l_linenumber % 3) AS right_gt FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL),
c AS (SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, left_gt, right_gt,
  CASE WHEN a.l_partkey IS NOT NULL AND b.l_partkey IS NOT NULL THEN 'shared' WHEN a.l_partkey IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side,
  CASE WHEN left_gt IS NULL OR right_gt IS NULL THEN 'not_comparable' WHEN left_gt = right_gt THEN 'yes' ELSE 'no' END AS concordance
  FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey)
"""


@query(_CALLERS + "SELECT * FROM c")
def caller_sets(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus", (F.col("l_linenumber") % 3).alias("gt"))
    return sets.caller_sets(li.filter("l_linestatus = 'O'"), li.filter("l_linestatus = 'F'"), ["l_partkey", "l_suppkey"], "gt")


@query(
    _CALLERS
    + """SELECT count_if(side = 'shared')::BIGINT AS shared, count_if(side = 'left_only')::BIGINT AS left_only, count_if(side = 'right_only')::BIGINT AS right_only,
  round(count_if(side = 'shared') * 100.0::DOUBLE / count(*), 6) AS jaccard_percent,
  round(count_if(side = 'shared') * 100.0::DOUBLE / (count_if(side = 'shared') + least(count_if(side = 'left_only'), count_if(side = 'right_only'))), 6) AS overlap_percent,
  round(count_if(concordance = 'yes') * 100.0::DOUBLE / count_if(concordance IN ('yes', 'no')), 6) AS concordance_percent FROM c"""
)
def caller_metrics(spark, sf_dir):
    return rounded(sets.caller_metrics(caller_sets(spark, sf_dir)), "jaccard_percent", "overlap_percent", "concordance_percent")


@query("""
WITH r AS (SELECT DISTINCT year(o_orderdate)::INTEGER AS order_year, o_orderpriority AS m, o_custkey FROM orders),
t AS (SELECT order_year, count(DISTINCT m) AS n FROM r GROUP BY 1)
SELECT r.order_year, o_custkey, count(DISTINCT m) AS members,
  CASE WHEN count(DISTINCT m) = any_value(t.n) AND any_value(t.n) > 1 THEN 'common' WHEN count(DISTINCT m) = 1 THEN 'exclusive' ELSE 'partial' END AS kind,
  CASE WHEN count(DISTINCT m) = 1 THEN min(m) END AS exclusive_to
FROM r JOIN t USING (order_year) GROUP BY ALL
""")
def common_exclusive(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("order_year"), "o_orderpriority", "o_custkey")
    return sets.common_exclusive(o, "order_year", "o_orderpriority", "o_custkey")


def _design(spark, sf_dir):
    """Customers of a nation as a subject's samples, those of one segment with the least key as baseline."""
    c = table(spark, sf_dir, "customer")
    first = c.filter("c_mktsegment = 'BUILDING' AND c_nationkey % 4 <> 0").groupBy("c_nationkey").agg(F.min("c_custkey").alias("first"))
    return c.join(first, "c_nationkey", "left").select(F.col("c_nationkey").alias("subject"), F.col("c_custkey").alias("sample"), F.coalesce(F.col("c_custkey") == F.col("first"), F.lit(False)).alias("baseline"))


_DESIGN = """
WITH f AS (SELECT c_nationkey, min(c_custkey) AS first FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey % 4 <> 0 GROUP BY 1),
d AS (SELECT c.c_nationkey AS subject, c_custkey AS sample, coalesce(c_custkey = first, false) AS baseline FROM customer c LEFT JOIN f ON f.c_nationkey = c.c_nationkey)
"""


@query(_DESIGN + "SELECT subject, count(*) AS n_samples, count_if(baseline)::BIGINT AS n_baseline, CASE WHEN count_if(baseline) = 0 THEN 'SKIPPED_NO_BASELINE' WHEN count(*) = 1 THEN 'NO_NONBASELINE' ELSE 'ENABLED' END AS design FROM d GROUP BY subject")
def design_status(spark, sf_dir):
    return rules.design_status(_design(spark, sf_dir))


@query(_DESIGN + "SELECT f.subject, b.sample AS base, f.sample AS followup FROM d f JOIN d b ON f.subject = b.subject AND b.baseline WHERE NOT f.baseline")
def baseline_pairs(spark, sf_dir):
    return sets.baseline_pairs(_design(spark, sf_dir), "subject", "sample", "baseline")


@query("WITH s AS (SELECT DISTINCT l_returnflag AS subject, l_shipdate IS NOT NULL AS x, l_linestatus || (l_linenumber % 4) AS sample FROM lineitem) SELECT a.subject, a.sample AS a, b.sample AS b FROM s a JOIN s b ON a.subject = b.subject AND a.sample < b.sample")
def sample_pairs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("subject"), F.concat("l_linestatus", (F.col("l_linenumber") % 4).cast("string")).alias("sample"))
    return sets.sample_pairs(li, "subject", "sample")


@query("WITH a AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R') SELECT count_if(b.l_partkey IS NULL)::BIGINT AS left_only, count_if(a.l_partkey IS NULL)::BIGINT AS right_only, count_if(a.l_partkey IS NULL OR b.l_partkey IS NULL) = 0 AS equal FROM a FULL JOIN b ON a.l_partkey = b.l_partkey")
def key_set_equality(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag")
    return sets.key_sets_equal(li.filter("l_returnflag = 'A'"), li.filter("l_returnflag = 'R'"), ["l_partkey"])


# --- rules ------------------------------------------------------------------


def _ruled(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_tax")
    alt = F.floor(F.col("l_quantity") * F.col("l_discount") * 3)
    found = rules.variant_rules(
        filter_=F.when(F.col("l_returnflag") == "N", "PASS").otherwise("LOW"),
        alt_count=F.col("l_linenumber") % 3,
        ref=F.col("l_linestatus"),
        genome_ref=F.when(F.col("l_tax") > 0.07, None).when(F.col("l_tax") > 0.05, "X").otherwise(F.col("l_linestatus")),
        depth=F.col("l_quantity"),
        alt_reads=alt,
        altering=F.col("l_partkey") % 5 > 0,
    )
    return rules.with_rules(li, found)


_RULED = """
WITH x AS (SELECT *, floor(l_quantity * l_discount * 3) AS alt, CASE WHEN l_tax > 0.07 THEN NULL WHEN l_tax > 0.05 THEN 'X' ELSE l_linestatus END AS genome FROM lineitem),
r AS (SELECT *, list_filter([
  CASE WHEN l_returnflag <> 'N' THEN 'VCF_FILTER_NOT_PASS' END, CASE WHEN l_linenumber % 3 > 1 THEN 'MULTIALLELIC_REQUIRES_NORMALIZATION' END,
  CASE WHEN genome <> l_linestatus THEN 'REFERENCE_ALLELE_MISMATCH' END, CASE WHEN genome IS NULL THEN 'REFERENCE_LOOKUP_FAILED' END,
  CASE WHEN l_quantity < 10 THEN 'RNA_DEPTH_BELOW_MINIMUM' END, CASE WHEN alt < 3 THEN 'RNA_ALT_READS_BELOW_MINIMUM' END,
  CASE WHEN alt / l_quantity < 0.05 THEN 'RNA_ALT_FRACTION_BELOW_MINIMUM' END, CASE WHEN l_partkey % 5 = 0 THEN 'NO_SUPPORTED_PROTEIN_ALTERING_CONSEQUENCE' END
], lambda c: c IS NOT NULL) AS codes FROM x)
"""


@query(_RULED + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN len(codes) = 0 THEN 'RNA_VALIDATED' ELSE 'REJECTED' END AS status, codes[1] AS primary_failure, array_to_string(codes, ';') AS codes FROM r")
def rule_codes(spark, sf_dir):
    return _ruled(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "status", "primary_failure", F.array_join("failure_codes", ";").alias("codes"))


@query(_RULED + ", e AS (SELECT l_returnflag, unnest(codes) AS code FROM r) SELECT l_returnflag, code, count(*) AS count FROM e GROUP BY ALL")
def failure_code_counts(spark, sf_dir):
    return aggregates.code_counts(_ruled(spark, sf_dir), ["l_returnflag"])


@query(_RULED + "SELECT l_linestatus, count(*) AS reported, count_if(len(codes) = 0)::BIGINT AS validated, count_if(len(codes) > 0)::BIGINT AS rejected FROM r GROUP BY ALL")
def class_status_counts(spark, sf_dir):
    return aggregates.status_counts(_ruled(spark, sf_dir), ["l_linestatus"], F.col("status") == "RNA_VALIDATED")


@query("SELECT 'l_returnflag' AS dimension, l_returnflag AS value, count(*) AS count FROM lineitem GROUP BY ALL UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY ALL UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR, count(*) FROM lineitem GROUP BY ALL")
def multi_dimension_counts(spark, sf_dir):
    return aggregates.multi_dimension_counts(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(_RULED + ", d AS (SELECT l_suppkey, codes[1] AS reason, count(*) AS n FROM r WHERE len(codes) > 0 GROUP BY ALL) SELECT l_suppkey, string_agg(reason || '=' || n, ';' ORDER BY n DESC, reason) AS detail FROM d GROUP BY l_suppkey")
def exclusion_detail(spark, sf_dir):
    return aggregates.exclusion_detail(_ruled(spark, sf_dir).filter("primary_failure IS NOT NULL"), "l_suppkey", "primary_failure")


@query("""
WITH f AS (SELECT l_returnflag, l_linestatus, array_to_string(list_filter([
  CASE WHEN l_quantity / 10 < 2 THEN 'QD2' END, CASE WHEN l_extendedprice / 1000 > 60 THEN 'FS60' END, CASE WHEN l_discount * 50 > 3 THEN 'SOR3' END,
  CASE WHEN l_tax * 1000 < 40 THEN 'MQ40' END, CASE WHEN -l_linenumber * 2.0 < -12.5 THEN 'MQRankSum-12.5' END], lambda c: c IS NOT NULL), ';') AS codes FROM lineitem)
SELECT l_returnflag, l_linestatus, CASE WHEN codes = '' THEN 'PASS' ELSE codes END AS filter, count(*) AS n FROM f GROUP BY ALL
""")
def hard_filter(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", (F.col("l_quantity") / 10).alias("QD"), (F.col("l_extendedprice") / 1000).alias("FS"), (F.col("l_discount") * 50).alias("SOR"), (F.col("l_tax") * 1000).alias("MQ"), (-F.col("l_linenumber") * 2.0).alias("MQRankSum"), F.lit(None).cast("double").alias("ReadPosRankSum"))
    return rules.hard_filter(li, rules.SNP_FILTERS).groupBy("l_returnflag", "l_linestatus", "filter").agg(F.count("*").alias("n"))


@query("""
WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'x' END AS b1, o_orderkey % 3 AS s1, o_orderkey % 2 AS s2, o_orderkey % 5 AS d, o_orderpriority, o_orderstatus FROM orders)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN b1 = '' THEN 'MISSING_BREAKPOINT' END, CASE WHEN s1 + s2 < 1 THEN 'SPLIT_READS_BELOW_MINIMUM' END, CASE WHEN s1 + s2 + d < 2 THEN 'TOTAL_SUPPORT_BELOW_MINIMUM' END,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'LOW_CONFIDENCE' END, CASE WHEN o_orderstatus <> 'O' THEN 'NOT_IN_FRAME' END], lambda c: c IS NOT NULL), ';') AS codes FROM f
""")
def fusion_rule_codes(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    f = o.select("o_orderkey", F.when(k % 7 == 0, "").otherwise("x").alias("breakpoint1"), F.lit("y").alias("breakpoint2"), (k % 3).alias("split_reads1"), (k % 2).alias("split_reads2"), (k % 5).alias("discordant_mates"), F.regexp_extract("o_orderpriority", "[A-Z ]+$", 0).alias("confidence"), F.when(F.col("o_orderstatus") == "O", "in-frame").otherwise("out-of-frame").alias("reading_frame"))
    return rules.with_rules(f, rules.fusion_rules()).select("o_orderkey", F.array_join("failure_codes", ";").alias("codes"))


_BASES = "ACGTTGCAAGCT"


def _codons() -> tuple[Column, Column, Column, Column]:
    k = F.col("p_partkey")
    text = F.lit(_BASES * 3)
    ref, alt = F.substr(text, (k % 30 + 1).cast("int"), F.lit(3)), F.substr(text, (k % 29 + 2).cast("int"), F.lit(3))
    letters = F.lit("FLSYCWPHQRIMTNKVADEG*")
    return ref, alt, F.substr(letters, (k % 21 + 1).cast("int"), F.lit(1)), F.substr(letters, (F.col("p_size") % 21 + 1).cast("int"), F.lit(1))


_CODE = "(strpos('TCAG', substr({0}, 1, 1)) - 1) * 16 + (strpos('TCAG', substr({0}, 2, 1)) - 1) * 4 + strpos('TCAG', substr({0}, 3, 1))"


def _aa(codon: str) -> str:
    return f"substr('{sequences.STANDARD_CODE}', {_CODE.format(codon)}, 1)"


@query(f"""
WITH c AS (SELECT p_partkey, substr('{_BASES * 3}', p_partkey % 30 + 1, 3) AS r, substr('{_BASES * 3}', p_partkey % 29 + 2, 3) AS a,
  substr('FLSYCWPHQRIMTNKVADEG*', p_partkey % 21 + 1, 1) AS ra, substr('FLSYCWPHQRIMTNKVADEG*', p_size % 21 + 1, 1) AS aa, p_size, p_brand FROM part),
t AS (SELECT *, {_aa("r")} AS rt, {_aa("a")} AS altt FROM c)
SELECT p_partkey, rt AS ref_translated, altt AS alt_translated, reverse(translate(r, 'ACGT', 'TGCA')) AS ref_reverse,
  CASE WHEN p_size % 7 = 0 THEN 'COMPLEX_CONSEQUENCE_NOT_SINGLE_CODON_COMPARABLE'
       WHEN p_size % 7 = 1 AND rt = altt AND ra = rt AND aa = altt THEN 'SYNONYMOUS_CODON_TRANSLATION_CONFIRMED'
       WHEN rt = ra AND altt = aa THEN 'CODON_TRANSLATION_MATCH' ELSE 'CODON_TRANSLATION_MISMATCH' END AS status,
  p_size % 7 <> 0 AND rt = ra AND altt = aa AS eligible
FROM t
""")
def codon_status(spark, sf_dir):
    ref, alt, ref_aa, alt_aa = _codons()
    term = F.when(F.col("p_size") % 7 == 0, "frameshift_variant&x").when(F.col("p_size") % 7 == 1, "synonymous_variant").otherwise("missense_variant")
    out = rules.codon_status(F.concat(ref, F.lit("/"), alt), F.concat(ref_aa, F.lit("/"), alt_aa), term)
    return table(spark, sf_dir, "part").select("p_partkey", sequences.translate_codon(ref).alias("ref_translated"), sequences.translate_codon(alt).alias("alt_translated"), sequences.reverse_complement(ref).alias("ref_reverse"), out.alias("o")).select("p_partkey", "ref_translated", "alt_translated", "ref_reverse", "o.status", "o.eligible")


@query(f"""
WITH c AS (SELECT p_partkey, substr('{_BASES * 3}', p_partkey % 30 + 1, 3) AS r, substr('{_BASES * 3}', p_partkey % 29 + 2, 3) AS a,
  substr('FLSYCWPHQRIMTNKVADEG*', p_partkey % 21 + 1, 1) AS ra, substr('FLSYCWPHQRIMTNKVADEG*', p_size % 21 + 1, 1) AS aa, p_size FROM part),
t AS (SELECT *, {_aa("r")} AS rt, {_aa("a")} AS altt FROM c),
m AS (SELECT *, CASE r WHEN 'AGA' THEN '*' WHEN 'AGG' THEN '*' WHEN 'ATA' THEN 'M' WHEN 'TGA' THEN 'W' ELSE rt END AS rm, CASE a WHEN 'AGA' THEN '*' WHEN 'AGG' THEN '*' WHEN 'ATA' THEN 'M' WHEN 'TGA' THEN 'W' ELSE altt END AS am,
  (substr(r, 1, 1) <> substr(a, 1, 1))::INT + (substr(r, 2, 1) <> substr(a, 2, 1))::INT + (substr(r, 3, 1) <> substr(a, 3, 1))::INT AS d,
  CASE WHEN substr(r, 1, 1) <> substr(a, 1, 1) THEN substr(r, 1, 1) || substr(a, 1, 1) WHEN substr(r, 2, 1) <> substr(a, 2, 1) THEN substr(r, 2, 1) || substr(a, 2, 1) ELSE substr(r, 3, 1) || substr(a, 3, 1) END AS ch FROM t)
SELECT p_partkey, CASE WHEN p_size % 5 = 0 AND rm = ra AND am = aa THEN 'MITOCHONDRIAL_CODE_RESOLVES_MISMATCH' WHEN rt = ra AND altt = aa THEN 'NO_REPRODUCIBLE_MISMATCH'
  WHEN rt <> ra AND altt = aa THEN 'REFERENCE_AMINO_ACID_MISMATCH_ONLY' WHEN rt = ra AND altt <> aa THEN 'ALTERNATE_AMINO_ACID_MISMATCH_ONLY' WHEN p_size % 7 = 0 THEN 'FRAMESHIFT_NOT_SINGLE_CODON_COMPARABLE'
  WHEN d = 1 AND ch NOT IN ('AG', 'TC') THEN 'CODON_CHANGE_INCONSISTENT_WITH_VCF_ALLELES' ELSE 'UNEXPLAINED_TRANSLATION_MISMATCH' END AS category
FROM m
""")
def codon_mismatches(spark, sf_dir):
    ref, alt, ref_aa, alt_aa = _codons()
    chrom = F.when(F.col("p_size") % 5 == 0, "chrM").otherwise("chr1")
    term = F.when(F.col("p_size") % 7 == 0, "frameshift_variant").otherwise("missense_variant")
    return table(spark, sf_dir, "part").select("p_partkey", rules.mismatch_diagnosis(chrom, F.lit("A"), F.lit("G"), ref, alt, ref_aa, alt_aa, term).alias("category"))


@query("""
WITH p AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS f FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN len(f) = 3 THEN 'all-three' WHEN len(f) = 1 THEN f[1] || '-only' ELSE f[1] || '+' || f[2] END AS pattern FROM p
""")
def observed_pattern(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("f"))
    return p.select("l_orderkey", rules.observed_pattern(F.col("f"), ["A", "N", "R"]).alias("pattern"))


# --- alleles, reads ---------------------------------------------------------


def _variants(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    text = F.lit("ACGTTGCAACGG")
    ref = F.substr(text, (k % 4 + 1).cast("int"), (s % 3 + 1).cast("int"))
    alt = F.substr(text, (s % 5 + 1).cast("int"), (k % 3 + 1).cast("int"))
    gts = F.array(*[F.lit(x) for x in ("0/1", "1|1", "./.", "1/2", "")])
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("sample"), F.col("p_type").alias("chrom"), (k + 100).alias("pos"), ref.alias("ref"), alt.alias("alt"), F.get(gts, (k % 5).cast("int")).alias("gt"), (k % 2 + 1).alias("n_alts"))


_VARIANTS = """
WITH v AS (SELECT p_partkey, p_brand AS sample, p_type AS chrom, p_partkey + 100 AS pos, substr('ACGTTGCAACGG', p_partkey % 4 + 1, p_size % 3 + 1) AS ref,
  substr('ACGTTGCAACGG', p_size % 5 + 1, p_partkey % 3 + 1) AS alt, ['0/1', '1|1', './.', '1/2', ''][p_partkey % 5 + 1] AS gt, p_partkey % 2 + 1 AS n_alts FROM part),
k AS (SELECT *, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNV' WHEN length(ref) = length(alt) THEN 'MNV' WHEN length(alt) > length(ref) AND starts_with(alt, ref) THEN 'INSERTION'
  WHEN length(ref) > length(alt) AND starts_with(ref, alt) THEN 'DELETION' ELSE 'COMPLEX' END AS kind, length(ref) = 1 AND length(alt) = 1 AS snv, ref || alt IN ('AG', 'GA', 'CT', 'TC') AS ti,
  CASE WHEN gt = '' OR contains(gt, '.') THEN 'missing' WHEN gt IN ('0/1', '1/0', '0|1', '1|0') THEN 'heterozygous' WHEN gt IN ('1/1', '1|1') THEN 'homozygous_alt' ELSE 'other' END AS zyg FROM v)
"""


@query(
    _VARIANTS
    + """, w AS (SELECT sample, count_if(kind = 'SNV') AS SNV, count_if(kind = 'MNV') AS MNV, count_if(kind = 'INSERTION') AS INSERTION, count_if(kind = 'DELETION') AS DELETION, count_if(kind = 'COMPLEX') AS COMPLEX,
  count_if(snv AND ti) AS transition, count_if(snv AND NOT ti) AS transversion, count_if(zyg = 'heterozygous') AS heterozygous, count_if(zyg = 'homozygous_alt') AS homozygous_alt, count_if(zyg = 'missing') AS missing, count_if(zyg = 'other') AS other, count_if(n_alts > 1) AS multiallelic_sites FROM k GROUP BY sample)
SELECT sample, metric, count::BIGINT AS count FROM (UNPIVOT w ON COLUMNS(* EXCLUDE sample) INTO NAME metric VALUE count)"""
)
def variant_landscape(spark, sf_dir):
    return aggregates.variant_landscape(_variants(spark, sf_dir), ["sample"])


@query(
    _VARIANTS
    + """SELECT sample, count(*) AS alleles, count_if(snv)::BIGINT AS snvs, count_if(length(ref) <> length(alt))::BIGINT AS indels, count_if(snv AND ti)::BIGINT AS transitions, count_if(snv AND NOT ti)::BIGINT AS transversions,
  count(DISTINCT chrom) AS contigs, round(CASE WHEN count_if(snv AND NOT ti) > 0 THEN count_if(snv AND ti)::DOUBLE / count_if(snv AND NOT ti) END, 6) AS ti_tv FROM k GROUP BY sample"""
)
def stage_summary(spark, sf_dir):
    return rounded(aggregates.stage_summary(_variants(spark, sf_dir), ["sample"]), "ti_tv")


@query(
    _VARIANTS
    + """, s AS (SELECT *, coalesce(list_max(list_filter(range(0, least(length(ref), length(alt))), lambda n: right(ref, n) = right(alt, n))), 0) AS cut FROM k),
t AS (SELECT p_partkey, kind, pos, left(ref, length(ref) - cut) AS ref, left(alt, length(alt) - cut) AS alt FROM s),
u AS (SELECT *, coalesce(list_max(list_filter(range(0, least(length(ref), length(alt))), lambda n: left(ref, n) = left(alt, n))), 0) AS cut FROM t)
SELECT p_partkey, kind, pos + cut AS pos, substr(ref, cut + 1) AS ref, substr(alt, cut + 1) AS alt FROM u"""
)
def trimmed_alleles(spark, sf_dir):
    v = _variants(spark, sf_dir).withColumn("kind", alleles.allele_type(F.col("ref"), F.col("alt")))
    return alleles.trim_allele(v).select("p_partkey", "kind", "pos", "ref", "alt")


def _reads(spark, sf_dir, pos: Column | None = None, flag: Column | None = None):
    """A read of each line item: 20 to 60 bases around an intron of 20, at a place of its part."""
    li = table(spark, sf_dir, "lineitem")
    first, second = F.col("l_linenumber") + 10, F.col("l_quantity").cast("int")
    seq = F.substr(F.repeat(F.lit("ACGTTGCAAC"), 8), (F.col("l_suppkey") % 4 + 1).cast("int"), first + second)
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("chrom"),
        (F.col("l_partkey") % 500 + 100 if pos is None else pos).alias("pos"),
        F.concat(first.cast("string"), F.lit("M20N"), second.cast("string"), F.lit("M")).alias("cigar"),
        seq.alias("seq"),
        F.repeat(F.lit("I"), first + second).alias("qual"),
        (F.when(F.col("l_discount") > 0.08, 1024).otherwise(0) if flag is None else flag).alias("flag"),
        F.floor(F.col("l_tax") * 1000).cast("int").alias("mapq"),
    )


_READS = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag AS chrom, l_partkey % 500 + 100 AS pos, l_linenumber + 10 AS a, l_quantity::INT AS b, substr(repeat('ACGTTGCAAC', 8), (l_suppkey % 4 + 1)::INT, l_linenumber + 10 + l_quantity::INT) AS seq,
  CASE WHEN l_discount > 0.08 THEN 1024 ELSE 0 END AS flag, floor(l_tax * 1000)::INT AS mapq FROM lineitem)
"""


@query(_READS + "SELECT chrom, pos + a AS start, pos + a + 19 AS end, count(*) AS n FROM r WHERE flag = 0 GROUP BY ALL")
def junction_counts(spark, sf_dir):
    return aggregates.junction_counts(_reads(spark, sf_dir), ["chrom"])


@query(
    _READS
    + """, o AS (SELECT *, CASE WHEN 12 <= a THEN substr(seq, 12, 1) WHEN 12 >= a + 21 AND 12 <= a + 20 + b THEN substr(seq, 12 - 20, 1) END AS base FROM r)
SELECT CASE WHEN flag <> 0 THEN 'EXCLUDED' WHEN mapq < 20 THEN 'EXCLUDED' WHEN base IS NULL THEN 'EXCLUDED' WHEN base = 'G' THEN 'EXACT_ALT' WHEN base = 'C' THEN 'CLEAN_REFERENCE' ELSE 'EXCLUDED' END AS class,
  CASE WHEN flag <> 0 THEN 'DUPLICATE_FLAG' WHEN mapq < 20 THEN 'LOW_MAPQ' WHEN base IS NULL THEN 'DOES_NOT_SPAN_COMPLETE_ALLELE' WHEN base = 'G' THEN 'EXACT_SUBSTITUTION' WHEN base = 'C' THEN 'EXACT_REFERENCE_HAPLOTYPE' ELSE 'OTHER_ALLELE' END AS reason,
  chrom, count(*) AS n FROM o GROUP BY ALL"""
)
def read_classes(spark, sf_dir):
    fields = {c: F.col(c) for c in ("flag", "mapq", "cigar", "seq", "qual")}
    r = cigar.with_read_class(_reads(spark, sf_dir), "c", start=F.col("pos"), pos=F.col("pos") + 11, ref=F.lit("C"), alt=F.lit("G"), **fields)
    return r.groupBy("chrom", "c.class", "c.reason").agg(F.count("*").alias("n"))


_FLAGS = {"1": "l_linenumber % 2 = 1", "2": "l_linenumber % 2 = 1 AND l_partkey % 3 > 0", "4": "l_suppkey % 17 = 0", "64": "l_linenumber % 4 = 1", "128": "l_linenumber % 4 = 3", "256": "l_partkey % 11 = 0", "1024": "l_orderkey % 9 = 0", "2048": "l_suppkey % 13 = 0"}
_COUNTED = {"secondary": "256", "supplementary": "2048", "duplicates": "1024", "paired": "1", "proper": "2", "read1": "64", "read2": "128"}


@query("SELECT l_returnflag AS chrom, count(*) AS total, " + f"count_if(NOT ({_FLAGS['4']}))::BIGINT AS mapped, " + ", ".join(f"count_if({_FLAGS[m]})::BIGINT AS {name}" for name, m in _COUNTED.items()) + " FROM lineitem GROUP BY 1")
def flagstat(spark, sf_dir):
    flag = sum((F.when(F.expr(when), int(mask)).otherwise(0) for mask, when in _FLAGS.items()), F.lit(0))
    return aggregates.flagstat(_reads(spark, sf_dir, flag=flag), ["chrom"])


_BLOCKS = """
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS fragment, l_returnflag AS chrom, l_partkey * 100 + l_suppkey % 100 AS pos, l_linenumber + 10 AS a, l_quantity::INT AS b FROM lineitem WHERE NOT l_discount > 0.08),
b AS (SELECT fragment, chrom, pos AS start, pos + a - 1 AS end FROM r UNION ALL SELECT fragment, chrom, pos + a + 20, pos + a + 19 + b FROM r),
e AS (SELECT p_partkey AS gene, ['A', 'N', 'R'][p_partkey // 2 % 3 + 1] AS chrom, p_partkey * 100 + 90 AS start, p_partkey * 100 + 90 + p_size AS end FROM part)
"""


def _gene_inputs(spark, sf_dir):
    """Every part is a gene, next to its neighbour; a read is near its part's."""
    r = _reads(spark, sf_dir, F.col("l_partkey") * 100 + F.col("l_suppkey") % 100).filter(cigar.primary(F.col("flag")))
    b = r.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fragment"), "chrom", F.explode(cigar.aligned(cigar.blocks(F.col("cigar"), F.col("pos")))).alias("b"))
    b = b.select("fragment", "chrom", F.col("b.ref").alias("start"), (F.col("b.ref") + F.col("b.len") - 1).alias("end"))
    k = F.col("p_partkey")
    e = table(spark, sf_dir, "part").select(k.alias("gene"), F.get(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.floor(k / 2) % 3).cast("int")).alias("chrom"), (k * 100 + 90).alias("start"), (k * 100 + 90 + F.col("p_size")).alias("end"))
    return b, e


@query(_BLOCKS + ", h AS (SELECT DISTINCT b.fragment, e.gene FROM b JOIN e ON b.chrom = e.chrom AND b.start <= e.end AND e.start <= b.end), o AS (SELECT fragment, min(gene) AS gene FROM h GROUP BY 1 HAVING count(*) = 1) SELECT gene, count(*) AS n FROM o GROUP BY gene")
def gene_read_counts(spark, sf_dir):
    return aggregates.gene_read_counts(*_gene_inputs(spark, sf_dir), width=128)


_FINDINGS = """
WITH f AS (SELECT user_id AS event_id, count_if(event_type IN ('click', 'purchase') AND value > 40)::BIGINT AS alt, count_if(event_type = 'view' AND value > 60)::BIGINT AS ref, count_if(event_type IN ('error', 'signup'))::BIGINT AS excluded FROM events GROUP BY 1),
s AS (SELECT *, alt + ref AS callable, CASE WHEN alt > 0 AND ref > 0 THEN 'MIXED_ALT_AND_REFERENCE' WHEN alt > 0 THEN 'ALT_SUPPORTED' WHEN ref > 0 THEN 'NO_EXACT_ALT_SUPPORT' ELSE 'NO_CALLABLE_READS' END AS status FROM f)
"""


def _findings(spark, sf_dir):
    t, v = F.col("event_type"), F.col("value")
    kind = F.when(t.isin("click", "purchase") & (v > 40), "EXACT_ALT").when((t == "view") & (v > 60), "CLEAN_REFERENCE").when(t.isin("error", "signup"), "EXCLUDED")
    return aggregates.finding_counts(table(spark, sf_dir, "events").select(F.col("user_id").alias("event_id"), kind.alias("class")), ["event_id"])


@query(_FINDINGS + "SELECT *, round(CASE WHEN callable > 0 THEN alt::DOUBLE / callable END, 6) AS alt_fraction, round(CASE WHEN callable + excluded > 0 THEN callable::DOUBLE / (callable + excluded) END, 6) AS callable_fraction FROM s")
def finding_counts(spark, sf_dir):
    return rounded(_findings(spark, sf_dir), "alt_fraction", "callable_fraction")


@query(
    _FINDINGS
    + """, x AS (SELECT event_id, list_filter([CASE WHEN event_id % 9 = 0 THEN 'CALLABLE_NOT_ALT_PLUS_REF' END, CASE WHEN event_id % 11 = 0 THEN 'EXAMINED_NOT_CALLABLE_PLUS_EXCLUDED' END,
  CASE WHEN event_id % 13 = 0 AND status <> 'ALT_SUPPORTED' THEN 'STATUS_DOES_NOT_MATCH_COUNTS' END, CASE WHEN (callable > 0 OR event_id % 9 = 0) AND (event_id % 17 = 0 OR callable = 0) THEN 'NO_FRACTION_DESPITE_CALLABLE' END], lambda c: c IS NOT NULL) AS v FROM s)
SELECT event_id, unnest(v) AS violation FROM x"""
)
def finding_invariants(spark, sf_dir):
    f, e = _findings(spark, sf_dir), F.col("event_id")
    f = f.withColumns({"callable": F.col("callable") + F.when(e % 9 == 0, 1).otherwise(0), "examined": F.col("callable") + F.col("excluded") + F.when(e % 9 == 0, 1).otherwise(0) + F.when(e % 11 == 0, 1).otherwise(0)})
    f = f.withColumns({"alt_fraction": F.when(e % 17 == 0, None).otherwise(F.col("alt_fraction")), "status": F.when(e % 13 == 0, "ALT_SUPPORTED").otherwise(F.col("status"))})
    return quality.finding_invariants(f)


# --- joins ------------------------------------------------------------------


def _seconds(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_timestamp(F.date_trunc("second", "ts")).alias("t"))


@query("""
WITH e AS (SELECT event_id, user_id, event_type, epoch(date_trunc('second', ts))::BIGINT AS t FROM events)
SELECT w.event_id AS window_id, e.event_id AS event_id FROM e w JOIN e ON w.user_id = e.user_id AND e.t BETWEEN w.t - 3600 AND w.t + 3600 WHERE w.event_type = 'purchase' AND e.event_type = 'error'
""")
def range_join(spark, sf_dir):
    e = _seconds(spark, sf_dir)
    w = e.filter("event_type = 'purchase'").select("user_id", "event_id", F.col("t").alias("start"), F.col("t").alias("end"))
    p = e.filter("event_type = 'error'").select("user_id", "event_id", F.col("t").alias("start"), F.col("t").alias("end"))
    return joins.range_join(w, p, ["user_id"], 3600, pad=3600).select(F.col("l.event_id").alias("window_id"), F.col("r.event_id").alias("event_id"))


def _patterns(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("pattern_id"), F.col("text").alias("pattern")), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), "text")


_HITS = """
WITH h AS (SELECT item_id AS pattern_id, doc_id AS text_id, d.lang, d.source, unnest(list_filter(range(1, length(d.text) - length(b.text) + 2), lambda i: substr(d.text, i, length(b.text)) = b.text)) AS position
  FROM documents d JOIN benchmark b ON length(b.text) > 0 AND contains(d.text, b.text))
"""


@query(_HITS + "SELECT pattern_id, text_id, position FROM h")
def pattern_join_all(spark, sf_dir):
    return joins.pattern_join(*_patterns(spark, sf_dir), seed=12)


@query(_HITS + "SELECT pattern_id, text_id, min(position) AS position FROM h GROUP BY ALL")
def pattern_join_first(spark, sf_dir):
    return joins.pattern_join(*_patterns(spark, sf_dir), seed=12, first=True)


@query(
    _HITS
    + """, s AS (SELECT pattern_id AS peptide, count_if(lang = 'en')::BIGINT AS en, count_if(lang = 'fr')::BIGINT AS fr, count_if(lang = 'de')::BIGINT AS de, count_if(lang = 'es')::BIGINT AS es, array_to_string(list_sort(list(DISTINCT source)), ';') AS samples, min(position) AS first_position FROM h GROUP BY 1)
SELECT *, en = 0 AS absent_from_canonical, array_to_string(list_filter([CASE WHEN fr > 0 THEN 'fr' END, CASE WHEN de > 0 THEN 'de' END, CASE WHEN es > 0 THEN 'es' END], lambda x: x IS NOT NULL), ';') AS novel_classes FROM s"""
)
def peptide_summary(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), F.col("lang").alias("class"), F.col("source").alias("sample"))
    hits = joins.pattern_join(*_patterns(spark, sf_dir), seed=12).join(d, "text_id").withColumnRenamed("pattern_id", "peptide")
    out = evidence.peptide_summary(hits, ["en", "fr", "de", "es"], "en")
    return out.withColumn("samples", F.array_join("samples", ";"))


@query("""
WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer),
x AS (SELECT child AS node, child AS ancestor FROM e UNION SELECT parent, parent FROM e UNION SELECT x.node, e.parent FROM x JOIN e ON e.child = x.ancestor)
SELECT node, ancestor FROM x
""")
def ontology_closure(spark, sf_dir):
    n, r, c = (table(spark, sf_dir, t) for t in ("nation", "region", "customer"))

    def edge(df, child, a, parent, b):
        return df.select(F.concat(F.lit(a), F.col(child).cast("string")).alias("child"), (F.concat(F.lit(b), F.col(parent).cast("string")) if parent else F.lit(b)).alias("parent"))

    return joins.closure(edge(n, "n_nationkey", "n", "n_regionkey", "r").union(edge(r, "r_regionkey", "r", None, "world")).union(edge(c, "c_custkey", "c", "c_nationkey", "n")))


@query("""
WITH a AS (SELECT o_orderkey, o_custkey, year(o_orderdate)::INTEGER AS y FROM orders WHERE o_orderpriority = '1-URGENT'),
b AS (SELECT o_orderkey AS k, o_custkey, year(o_orderdate)::INTEGER AS y, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'),
m AS (SELECT a.o_orderkey, 0 AS attempt, b.k, b.o_totalprice FROM a JOIN b ON a.o_custkey = b.o_custkey AND a.y = b.y UNION ALL SELECT a.o_orderkey, 1, b.k, b.o_totalprice FROM a JOIN b ON a.o_custkey = b.o_custkey),
x AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY attempt, o_totalprice DESC, k) AS n FROM m)
SELECT a.o_orderkey, x.attempt, x.k AS matched FROM a LEFT JOIN x ON x.o_orderkey = a.o_orderkey AND x.n = 1
""")
def prioritised_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice", "o_orderpriority")
    a = o.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey", "y")
    b = o.filter("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("k"), "o_custkey", "y", "o_totalprice")
    out = joins.prioritised_join(a, b, [[("o_custkey", "o_custkey"), ("y", "y")], [("o_custkey", "o_custkey")]], ["o_orderkey"], [F.desc("match.o_totalprice"), F.asc("match.k")])
    return out.select("o_orderkey", "attempt", F.col("match.k").alias("matched"))


# --- windows ----------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linestatus, l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1")
def best_annotation(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus")
    return windows.best_by(li, ["l_orderkey"], ["l_linestatus", F.desc("l_quantity"), "l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders) WHERE rank <= 3")
def cap_per_group(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.cap_per_group(o, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank")


#: Each interval stands once, with its number of rows, so that no order leaves ties to chance.
_INTERVALS = "WITH i AS (SELECT l_suppkey, date_diff('day', DATE '1995-01-01', l_shipdate::DATE) AS s, date_diff('day', DATE '1995-01-01', l_shipdate::DATE) + l_linenumber * 2 AS e, count(*) AS n FROM lineitem GROUP BY ALL)"


@query(
    _INTERVALS
    + """, m AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM i),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM m)
SELECT l_suppkey, min(s)::INTEGER AS start, max(e)::INTEGER AS end, sum(n)::BIGINT AS n FROM g GROUP BY l_suppkey, isl"""
)
def merge_intervals(spark, sf_dir):
    d = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date"))
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", d.alias("start"), (d + F.col("l_linenumber") * 2).alias("end"))
    return windows.merge_intervals(li, ["l_suppkey"], 1)


@query(
    _INTERVALS
    + """, m AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM i),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM m),
x AS (SELECT l_suppkey, min(s) AS a, max(e) AS b FROM g GROUP BY l_suppkey, isl)
SELECT l_suppkey AS gene, min(a)::INTEGER AS start, max(b)::INTEGER AS end, sum(b - a + 1)::BIGINT AS merged_length FROM x GROUP BY 1"""
)
def gene_model(spark, sf_dir):
    d = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("gene"), d.alias("start"), (d + F.col("l_linenumber") * 2).alias("end"))
    return aggregates.gene_model(li)


_JUNCTIONS = """
WITH x AS (SELECT DISTINCT l_orderkey AS transcript, l_returnflag AS chrom, l_partkey * 10 AS s, l_partkey * 10 + l_linenumber AS e FROM lineitem),
j AS (SELECT transcript, chrom, row_number() OVER w AS junction_no, e + 1 AS start, lead(s) OVER w - 1 AS "end", sum(e - s + 1) OVER (PARTITION BY transcript, chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS "offset" FROM x WINDOW w AS (PARTITION BY transcript, chrom ORDER BY s, e)),
k AS (SELECT transcript, chrom, junction_no::INTEGER AS junction_no, start, "end", "offset"::BIGINT AS "offset" FROM j WHERE "end" IS NOT NULL)
"""


def _junctions(spark, sf_dir):
    s = F.col("l_partkey") * 10
    x = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("transcript"), F.col("l_returnflag").alias("chrom"), s.alias("start"), (s + F.col("l_linenumber")).alias("end")).distinct()
    return windows.exon_junctions(x)


@query(_JUNCTIONS + "SELECT * FROM k")
def exon_junctions(spark, sf_dir):
    return _junctions(spark, sf_dir)


@query(
    _JUNCTIONS
    + """, c AS (SELECT chrom, start, "end", count(*) AS n FROM k GROUP BY ALL), y AS (SELECT k.transcript, coalesce(c.n, 0) AS n FROM k LEFT JOIN c ON c.chrom = k.chrom AND c.start = k.start AND c."end" = k."end")
SELECT transcript, count(*) AS n_junctions, min(n)::BIGINT AS min_support, CASE WHEN min(n) < 2 THEN 'REJECTED' ELSE 'RNA_VALIDATED' END AS status FROM y GROUP BY 1"""
)
def junction_support(spark, sf_dir):
    j = _junctions(spark, sf_dir)
    counts = j.groupBy("chrom", "start", "end").agg(F.count("*").alias("n"))
    return rules.with_rules(aggregates.junction_support(j, counts), rules.splice_rules(2)).select("transcript", "n_junctions", "min_support", "status")


@query("""
WITH a AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS r, count(*) OVER (PARTITION BY p_brand) AS n, p_retailprice FROM part)
SELECT p_brand, p_retailprice AS upper_median FROM a WHERE r = n // 2 + 1
""")
def upper_median(spark, sf_dir):
    return aggregates.upper_median("p_retailprice", ["p_brand"], table(spark, sf_dir, "part"))


# --- enrichment -------------------------------------------------------------

_GENES = """
WITH rev AS (SELECT l_partkey AS gene, sum(l_quantity) AS q FROM lineitem GROUP BY 1), sets AS (SELECT p_partkey AS gene, p_brand AS term FROM part WHERE p_partkey IN (SELECT gene FROM rev)),
fg AS (SELECT gene FROM rev WHERE q > 900), st AS (SELECT term, count(*) AS size FROM sets GROUP BY 1), c AS (SELECT (SELECT count(*) FROM rev) AS total, (SELECT count(*) FROM fg) AS drawn),
h AS (SELECT term, count(*) AS overlap FROM sets JOIN fg USING (gene) GROUP BY 1), t AS (SELECT st.term, size, coalesce(overlap, 0) AS overlap, drawn, total FROM st LEFT JOIN h USING (term), c),
p AS (SELECT *, least(1.0, list_sum(list_transform(range(overlap, least(drawn, size) + 1), lambda x: exp(lgamma(size + 1) - lgamma(x + 1) - lgamma(size - x + 1) + lgamma(total - size + 1) - lgamma(drawn - x + 1) - lgamma(total - size - drawn + x + 1) - lgamma(total + 1) + lgamma(drawn + 1) + lgamma(total - drawn + 1))))) AS p,
  (overlap + 0.5::DOUBLE) * (total - drawn - size + overlap + 0.5) / ((drawn - overlap + 0.5) * (size - overlap + 0.5)) AS odds FROM t {where}),
r AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS m FROM p),
q AS (SELECT *, least(1.0, min(p * m / k) OVER (ORDER BY p, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fdr FROM r)
SELECT term, size, overlap, drawn, total, round(odds, 6) AS odds, round(p, 6) AS p, round(fdr, 6) AS fdr FROM q
"""


def _ora(spark, sf_dir, **options):
    rev = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("q"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("term"))
    out = enrichment.over_representation(rev.filter("q > 900"), rev, parts, **options)
    return rounded(out, "odds", "p", "fdr").select("term", "size", "overlap", "drawn", "total", "odds", "p", "fdr")


@query(_GENES.replace("{where}", ""))
def ora(spark, sf_dir):
    return _ora(spark, sf_dir)


@query(_GENES.replace("{where}", "WHERE overlap > 0 AND size BETWEEN 5 AND 500"))
def ora_landscape(spark, sf_dir):
    return _ora(spark, sf_dir, drop_zero=True, smallest=5, largest=500, empty_p=1.0)


_FOLD = """
WITH m AS (SELECT l_returnflag AS sample, l_partkey AS gene, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
fold AS (SELECT coalesce(a.gene, r.gene) AS gene, log2((coalesce(r.v, 0) + 0.5) / (coalesce(a.v, 0) + 0.5)) AS fc FROM (SELECT * FROM m WHERE sample = 'A') a FULL JOIN (SELECT * FROM m WHERE sample = 'R') r ON a.gene = r.gene)
"""


def _fold(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("v"))
    pairs = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.lit("A").alias("base"), F.col("l_returnflag").alias("followup")).distinct()
    return aggregates.gene_fold_change(m, pairs, "v")


@query(_FOLD + "SELECT 'A' AS base, 'R' AS followup, gene, round(fc, 6) AS log2_fc FROM fold")
def gene_fold_change(spark, sf_dir):
    return rounded(_fold(spark, sf_dir), "log2_fc")


@query(_FOLD + "SELECT p_brand AS gene_set, count(*) AS genes, round(median(fc), 6) AS median, round(avg(fc), 6) AS mean, round(avg((fc > 0)::INT), 6) AS up_fraction, round(avg((fc < 0)::INT), 6) AS down_fraction FROM fold JOIN part ON p_partkey = gene GROUP BY 1")
def pathway_scores(spark, sf_dir):
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("gene_set"))
    return rounded(aggregates.pathway_scores(_fold(spark, sf_dir), s), "median", "mean", "up_fraction", "down_fraction").select("gene_set", "genes", "median", "mean", "up_fraction", "down_fraction")


@query(
    _FOLD
    + """, s AS (SELECT p_brand, p_type, count(*) AS n, median(fc) AS md, avg((fc > 0)::INT) AS up, avg((fc < 0)::INT) AS down FROM fold JOIN part ON p_partkey = gene GROUP BY 1, 2),
c AS (SELECT p_type, p_brand, CASE WHEN n < 5 THEN 'INSUFFICIENT_DATA' WHEN md >= 0.25 AND up >= 0.6 THEN 'SUPPORT' WHEN md <= -0.25 AND up <= 0.4 THEN 'CONTRADICT' ELSE 'MIXED' END AS st FROM s),
v AS (SELECT p_type, count_if(st <> 'INSUFFICIENT_DATA') AS n, count_if(st = 'SUPPORT') AS y, count_if(st = 'CONTRADICT') AS no FROM c GROUP BY 1),
w AS (SELECT p_type, CASE WHEN n = 0 THEN 'INSUFFICIENT_DATA' WHEN y >= greatest(1, ceil(n / 2)) AND no = 0 THEN 'SUPPORTED' WHEN no >= greatest(1, ceil(n / 2)) AND y = 0 THEN 'CONTRADICTED' ELSE 'MIXED' END AS v FROM v)
SELECT p_type AS hypothesis, v AS verdict FROM w"""
)
def hypothesis_verdicts(spark, sf_dir):
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.concat_ws("|", "p_type", "p_brand").alias("gene_set"))
    p = aggregates.pathway_scores(_fold(spark, sf_dir), s)
    p = p.select(F.split_part("gene_set", F.lit("|"), F.lit(1)).alias("hypothesis"), "followup", rules.pathway_verdict(F.col("genes"), F.col("median"), F.col("up_fraction"), F.col("down_fraction"), F.lit("up")).alias("status"))
    return rules.hypothesis_verdicts(p, 1)


@query(
    _FOLD
    + """, r AS (SELECT gene, fc, rank() OVER (ORDER BY fc) + (count(*) OVER (PARTITION BY fc) - 1) / 2 AS rk, count(*) OVER () AS m FROM (SELECT gene, round(fc, 4) AS fc FROM fold)),
s AS (SELECT p_type AS term, count(*) AS size, sum(rk) AS rs, any_value(m) AS m, avg(fc) AS mean FROM r JOIN part ON p_partkey = gene GROUP BY 1)
SELECT term, size, round(rs - size * (size + 1) / 2, 6) AS u, round((rs - size * (size + 1) / 2 - size * (m - size) / 2) / sqrt(size * (m - size) * (m + 1) / 12.0), 6) AS z, round(mean, 6) AS mean FROM s WHERE size < m"""
)
def ranked_set_test(spark, sf_dir):
    scores = _fold(spark, sf_dir).select("gene", F.round("log2_fc", 4).alias("score"))
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.col("p_type").alias("term"))
    return rounded(enrichment.ranked_set_test(scores, s, with_p=False), "u", "z", "mean").select("term", "size", "u", "z", "mean")


#: erfc by its series below 3 and by its continued fraction from there.
_ERFC = """CASE WHEN x < 3 THEN 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 70), lambda n: (CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END) * exp((2 * n + 1) * ln(greatest(x, 1e-300)) - lgamma(n + 1)) / (2 * n + 1)))
  ELSE exp(-x * x) / sqrt(pi()) / list_reduce(list_prepend(x, list_transform(range(60, 0, -1), lambda n: n / 2.0::DOUBLE)), lambda a, n: x + n / a) END"""


@query(
    _FOLD
    + f""", r AS (SELECT gene, fc, rank() OVER (ORDER BY fc) + (count(*) OVER (PARTITION BY fc) - 1) / 2 AS rk, count(*) OVER () AS m FROM (SELECT gene, round(fc, 4) AS fc FROM fold)),
l AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY abs(fc) DESC, gene) AS nth FROM r JOIN part ON p_partkey = gene),
s AS (SELECT p_type AS term, count(*) AS size, sum(rk) AS rs, any_value(m) AS m, string_agg(gene::VARCHAR, ';' ORDER BY nth) FILTER (nth <= 50) AS "leading" FROM l GROUP BY 1),
z AS (SELECT *, (rs - size * (size + 1) / 2 - size * (m - size) / 2) / sqrt(size * (m - size) * (m + 1) / 12.0) AS z FROM s WHERE size < m),
x AS (SELECT *, abs(z) / sqrt(2) AS x FROM z), p AS (SELECT *, {_ERFC} AS p FROM x), k AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS n FROM p)
SELECT term, size, round(z, 6) AS z, round(p, 6) AS p, round(least(1.0, min(p * n / k) OVER (ORDER BY p, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS fdr, "leading" FROM k"""
)
def ranked_set_test_p(spark, sf_dir):
    scores = _fold(spark, sf_dir).select("gene", F.round("log2_fc", 4).alias("score"))
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.col("p_type").alias("term"))
    return rounded(enrichment.ranked_set_test(scores, s).select("term", "size", "z", "p", "fdr", "leading"), "z", "p", "fdr")


@query("""
WITH c AS (SELECT l_returnflag AS sample, l_partkey AS gene, sum(l_quantity) AS count FROM lineitem GROUP BY ALL), t AS (SELECT sample, sum(count) AS tot FROM c GROUP BY 1),
m AS (SELECT c.*, count / (p_size * 100 / 1000.0::DOUBLE) AS rpk FROM c JOIN part ON p_partkey = gene), a AS (SELECT sample, sum(rpk) AS al FROM m GROUP BY 1)
SELECT m.sample, gene, count, round(count * 1e6 / tot, 6) AS cpm, round(rpk * 1e6 / al, 6) AS tpm FROM m JOIN t ON t.sample = m.sample JOIN a ON a.sample = m.sample
""")
def expression_matrix(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("count"))
    m = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), (F.col("p_size") * 100).alias("merged_length"))
    return rounded(aggregates.expression_matrix(c, m), "cpm", "tpm")


@query("WITH c AS (SELECT l_returnflag AS sample, l_partkey AS gene, sum(l_quantity) AS count FROM lineitem GROUP BY ALL) SELECT sample, sum(count) AS assigned, count_if(count > 0)::BIGINT AS genes FROM c GROUP BY 1")
def expression_summary(spark, sf_dir):
    return aggregates.expression_summary(table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("count")))


@query("""
WITH x AS (SELECT p_partkey, p_name AS name, p_brand AS analysis, p_retailprice / 600 AS odds, p_size AS size, p_size / 100 AS fdr FROM part WHERE (p_retailprice / 600 >= 1.5 AND p_size >= 5) OR (abs(p_size / 50 - 0.5) >= 0.25 AND abs(p_partkey % 7 - 3) >= 2)),
d AS (SELECT *, row_number() OVER (PARTITION BY analysis, name ORDER BY fdr, p_partkey) AS n FROM x), r AS (SELECT *, row_number() OVER (PARTITION BY analysis ORDER BY fdr, p_partkey)::INTEGER AS rank FROM d WHERE n = 1)
SELECT analysis, p_partkey AS term, rank FROM r WHERE rank <= 5
""")
def nonredundant_terms(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("term"), F.col("p_name").alias("name"), F.col("p_brand").alias("analysis"), (F.col("p_retailprice") / 600).alias("odds"), F.col("p_size").alias("size"), (F.col("p_size") / 100).alias("fdr"), (F.col("p_size") / 50 - 0.5).alias("mean"), (F.col("p_partkey") % 7 - 3).alias("z"))
    return windows.nonredundant_terms(p, ["analysis"], 5).select("analysis", "term", "rank")


@query("WITH x AS (SELECT p_brand AS analysis, p_partkey AS term, row_number() OVER (PARTITION BY p_brand ORDER BY p_size / 100, p_retailprice DESC, p_partkey)::INTEGER AS rank FROM part WHERE p_size / 100 <= 0.1 AND p_retailprice > 0) SELECT * FROM x WHERE rank <= 4")
def top_terms(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("term"), F.col("p_brand").alias("analysis"), F.col("p_retailprice").alias("size"), (F.col("p_size") / 100).alias("fdr"))
    return windows.top_terms(p, ["analysis"], 4).select("analysis", "term", "rank")


# --- evidence ---------------------------------------------------------------


@query("""
WITH e AS (SELECT user_id, 'f' || (event_id % 6) AS raw_file, 's' || (event_id % 5) AS sample, value AS pep, value * 2 AS score, event_type IN ('purchase', 'click') AS direct, event_id FROM events),
i AS (SELECT user_id, unnest([event_id % 7, event_id % 3]) AS id FROM e WHERE direct), p AS (SELECT user_id, count(DISTINCT id) AS psm_count FROM i GROUP BY 1),
g AS (SELECT user_id, list_sort(list(DISTINCT raw_file)) AS f, list_sort(list(DISTINCT sample) FILTER (direct)) AS ds, list_sort(list(DISTINCT sample) FILTER (NOT direct)) AS ts, min(pep) AS best_pep, max(score) AS best_score, count_if(direct)::BIGINT AS direct_rows, count_if(NOT direct)::BIGINT AS transferred_rows FROM e GROUP BY 1)
SELECT g.user_id, array_to_string(f, ';') AS raw_files, coalesce(array_to_string(ds, ';'), '') AS direct_samples, coalesce(array_to_string(list_filter(ts, lambda s: NOT list_contains(coalesce(ds, []), s)), ';'), '') AS only_transferred, best_pep, best_score, direct_rows, transferred_rows, coalesce(psm_count, 0) AS psm_count FROM g LEFT JOIN p ON p.user_id = g.user_id
""")
def evidence_summary(spark, sf_dir):
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select("user_id", F.concat(F.lit("f"), (k % 6).cast("string")).alias("raw_file"), F.concat(F.lit("s"), (k % 5).cast("string")).alias("sample"), F.col("value").alias("pep"), (F.col("value") * 2).alias("score"), F.when(F.col("event_type").isin("purchase", "click"), F.array(k % 7, k % 3)).otherwise(F.array().cast("array<bigint>")).alias("msms_ids"))
    out = evidence.evidence_summary(e, "user_id")
    return out.select("user_id", *[F.array_join(c, ";").alias(c) for c in ("raw_files", "direct_samples", "only_transferred")], "best_pep", "best_score", "direct_rows", "transferred_rows", "psm_count")


@query("""
WITH c AS (SELECT l_orderkey, count(*) AS codon_rows, count_if(l_returnflag = 'N')::BIGINT AS validated_rows, count_if(l_returnflag = 'R')::BIGINT AS failed_rows FROM lineitem GROUP BY 1),
x AS (SELECT o_orderkey, coalesce(codon_rows, 0) AS codon_rows, coalesce(validated_rows, 0) AS validated_rows, coalesce(failed_rows, 0) AS failed_rows FROM orders LEFT JOIN c ON l_orderkey = o_orderkey),
r AS (SELECT *, array_to_string(list_filter([CASE WHEN codon_rows = 0 THEN 'NO_CODON_ROW' END, CASE WHEN failed_rows > 0 THEN 'CODON_ROW_FAILED' END, CASE WHEN codon_rows > 0 AND validated_rows = 0 THEN 'NO_VALIDATED_CODON_ROW' END], lambda c: c IS NOT NULL), ';') AS exclusion_reasons FROM x)
SELECT *, exclusion_reasons = '' AS strict FROM r
""")
def integrated_evidence(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    s = F.when(F.col("l_returnflag") == "N", "VARIANT_CODON_VALIDATED").when(F.col("l_returnflag") == "R", "VALIDATION_FAILED").otherwise("VARIANT_EVIDENCE_PARTIAL")
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), s.alias("overall_status"))
    return evidence.integrated_evidence(o, c, ["o_orderkey"])


@query("WITH g AS (SELECT l_partkey, list_sort(list(DISTINCT l_returnflag || l_linestatus)) AS s, list_sort(list(DISTINCT 'g' || (l_suppkey % 10))) AS gs FROM lineitem GROUP BY 1) SELECT l_partkey, len(s)::INTEGER AS n_samples, array_to_string(s, ';') AS samples, array_to_string(gs, ';') AS genes FROM g WHERE len(s) > 1")
def recurrence(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", F.concat("l_returnflag", "l_linestatus").alias("sample"), F.concat(F.lit("g"), (F.col("l_suppkey") % 10).cast("string")).alias("gene"))
    return aggregates.recurrence(li, ["l_partkey"])


@query("""
WITH r AS (SELECT l_returnflag || l_linestatus AS sample, l_returnflag = 'N' AS baseline, l_partkey AS allele, l_suppkey AS gene, l_linenumber AS peptide FROM lineitem), t AS (SELECT count(DISTINCT sample) AS s FROM r), e AS (SELECT allele, count(DISTINCT sample) AS n, bool_or(baseline) AS b, bool_or(NOT baseline) AS f FROM r GROUP BY 1)
SELECT (SELECT count(*) FROM r) AS rows, (SELECT count(DISTINCT allele) FROM r) AS alleles, (SELECT count(DISTINCT gene) FROM r) AS genes, (SELECT count(DISTINCT peptide) FROM r) AS peptides, count_if(n = s)::BIGINT AS in_all, count_if(b AND NOT f)::BIGINT AS baseline_only, count_if(f AND NOT b)::BIGINT AS followup_only FROM e, t
""")
def strict_identity(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("sample"), (F.col("l_returnflag") == "N").alias("baseline"), F.col("l_partkey").alias("allele"), F.col("l_suppkey").alias("gene"), F.col("l_linenumber").alias("peptide"))
    return evidence.strict_identity(li, "baseline")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R' AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey) THEN 'known' ELSE 'novel' END AS reference_status FROM lineitem a WHERE l_returnflag = 'A'")
def known_junctions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return evidence.known_junctions(li.filter("l_returnflag = 'A'").drop("l_returnflag"), li.filter("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


@query("WITH x AS (SELECT l_suppkey, 'g' || (l_partkey % 7) AS gene, l_returnflag AS s, l_linenumber AS k FROM lineitem), a AS (SELECT DISTINCT gene, l_suppkey, k FROM x WHERE s = 'A'), b AS (SELECT DISTINCT gene, l_suppkey, k FROM x WHERE s = 'R'), j AS (SELECT coalesce(a.gene, b.gene) AS gene, a.k AS ka, b.k AS kb FROM a FULL JOIN b ON a.gene = b.gene AND a.l_suppkey = b.l_suppkey AND a.k = b.k) SELECT gene, count_if(ka IS NOT NULL AND kb IS NOT NULL)::BIGINT AS shared, count_if(ka IS NULL)::BIGINT AS followup_only, count_if(kb IS NULL)::BIGINT AS baseline_only, round(log2((count(kb) + 0.5) / (count(ka) + 0.5)), 6) AS log2_ratio FROM j GROUP BY 1")
def splice_progression(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("g"), (F.col("l_partkey") % 7).cast("string")).alias("gene"), "l_suppkey", "l_linenumber", "l_returnflag")
    return rounded(aggregates.splice_progression(x.filter("l_returnflag = 'A'"), x.filter("l_returnflag = 'R'"), ["l_suppkey", "l_linenumber"]), "log2_ratio")


@query("""
WITH v AS (SELECT p_partkey, 'chr' || (p_size % 22 + 1) AS chrom, p_partkey * 997 + 1 AS pos, substr('ACGTTGCAACGG', p_partkey % 4 + 1, p_size % 3 + 1) AS ref, substr('ACGTTGCAACGG', p_partkey % 4 + 1, p_partkey % 3 + 1) AS alt FROM part)
SELECT p_partkey, CASE WHEN ref = alt AND length(ref) = 1 THEN 'SUBSTITUTE ' || ref || ' WITH ' || alt || ' AT ' || chrom || ':' || format('{:,}', pos) WHEN length(ref) = length(alt) THEN 'REPLACE ' || ref || ' WITH ' || alt || ' AT ' || chrom || ':' || format('{:,}', pos) || '-' || format('{:,}', pos + length(ref) - 1)
  WHEN length(alt) > length(ref) THEN 'INSERT ' || substr(alt, length(ref) + 1) || ' AFTER ' || chrom || ':' || format('{:,}', pos + length(ref) - 1) || ' ' || ref ELSE 'DELETE ' || substr(ref, length(alt) + 1) || ' AFTER ' || chrom || ':' || format('{:,}', pos + length(alt) - 1) || ' ' || alt END AS description, pos - 1 AS start0, pos - 1 + length(ref) AS end0 FROM v
""")
def event_descriptions(spark, sf_dir):
    k = F.col("p_partkey")
    text = F.lit("ACGTTGCAACGG")
    v = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("chr"), (F.col("p_size") % 22 + 1).cast("string")).alias("chrom"), (k * 997 + 1).alias("pos"), F.substr(text, (k % 4 + 1).cast("int"), (F.col("p_size") % 3 + 1).cast("int")).alias("ref"), F.substr(text, (k % 4 + 1).cast("int"), (k % 3 + 1).cast("int")).alias("alt"))
    v = v.withColumn("kind", alleles.allele_type(F.col("ref"), F.col("alt")))
    none = F.lit(None)
    d = evidence.event_description(F.col("kind"), F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"), none.cast("string"), none.cast("bigint"))
    return v.select("p_partkey", d.alias("description"), evidence.event_geometry(F.col("kind"), F.col("chrom"), F.col("pos"), F.col("ref")).alias("g")).select("p_partkey", "description", "g.start0", "g.end0")


@query("WITH f AS (SELECT p_partkey FROM part WHERE contains(p_type, 'O') AND contains(lower(p_name || ' ' || p_type), 'ring')) SELECT p_partkey, (SELECT count(*) FROM f) AS total FROM f ORDER BY p_partkey LIMIT 20 OFFSET 2")
def finding_search(spark, sf_dir):
    total, page = evidence.finding_search(table(spark, sf_dir, "part"), word="RING", contains={"p_type": "O"}, texts=["p_name", "p_type"], order=["p_partkey"], offset=2, limit=20)
    return page.select("p_partkey").join(F.broadcast(total))


# --- logs and quality -------------------------------------------------------


def _tasks(spark, sf_dir):
    k = F.col("event_id")
    name = F.concat(F.lit("wf:"), F.upper("event_type"), F.lit(" (s"), (k % 9).cast("string"), F.lit(")"))
    status = F.when(k % 37 == 0, "FAILED").when(k % 5 == 0, "CACHED").otherwise("COMPLETED")
    rows = table(spark, sf_dir, "events").select(F.col("ts"), k.alias("task_id"), name.alias("name"), status.alias("status"), F.when(k % 37 == 0, "137").otherwise("0").alias("exit"), F.concat((F.col("user_id") * 40).cast("string"), F.lit("%")).alias("cpu"), F.concat((k % 64).cast("string"), F.lit(" GB")).alias("peak_rss"), F.concat((k % 14).cast("string"), F.lit("h "), (k % 60).cast("string"), F.lit("m "), (k % 7).cast("string"), F.lit("s")).alias("realtime"))
    return aggregates.parsed_trace(rows).join(rows.select("task_id", "ts"), "task_id")


_TASKS = """
WITH t AS (SELECT upper(event_type) AS process, event_id AS task_id, ts, CASE WHEN event_id % 37 = 0 THEN 'FAILED' WHEN event_id % 5 = 0 THEN 'CACHED' ELSE 'COMPLETED' END AS status, CASE WHEN event_id % 37 = 0 THEN 137 ELSE 0 END AS exit,
  user_id * 40 / 100 AS cores, (event_id % 64) * 1e9 AS rss, (event_id % 14) * 3600.0::DOUBLE + (event_id % 60) * 60 + event_id % 7 AS seconds FROM events)
"""


@query(
    _TASKS
    + """SELECT process, count(*) AS tasks, round(list_sort(list(cores))[(count(*) // 2 + 1)::INT], 6) AS median_cores, max(rss) AS max_rss, max(seconds) AS max_seconds, count_if(status = 'FAILED')::BIGINT AS failures,
  array_to_string(list_filter([CASE WHEN list_sort(list(cores))[(count(*) // 2 + 1)::INT] > 32 THEN 'cores' END, CASE WHEN max(rss) > 48e9 THEN 'memory' END, CASE WHEN max(seconds) > 43200 THEN 'runtime' END], lambda c: c IS NOT NULL), ';') AS warnings FROM t GROUP BY process"""
)
def trace_summary(spark, sf_dir):
    return rounded(aggregates.trace_summary(_tasks(spark, sf_dir)), "median_cores")


@query(_TASKS + "SELECT process, task_id, status, exit FROM t WHERE status = 'FAILED'")
def failure_ledger(spark, sf_dir):
    return aggregates.failure_ledger(_tasks(spark, sf_dir)).select("process", "task_id", "status", "exit")


@query(_TASKS + ", r AS (SELECT DISTINCT process FROM t UNION ALL SELECT 'MISSING_STEP'), n AS (SELECT process, count(*) AS tasks, count_if(status = 'FAILED') AS bad FROM t GROUP BY 1) SELECT r.process, coalesce(tasks, 0) AS tasks, coalesce(bad, 0)::BIGINT AS bad, CASE WHEN tasks > 0 AND bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM r LEFT JOIN n ON n.process = r.process")
def process_contract(spark, sf_dir):
    t = _tasks(spark, sf_dir)
    required = t.select("process").distinct().union(table(spark, sf_dir, "region").select(F.lit("MISSING_STEP").alias("process")).distinct())
    return aggregates.process_contract(t, required)


@query(_TASKS + "SELECT date_trunc('hour', ts) AS window_start, process, count(*) AS tasks, max(seconds) AS max_seconds, round(avg(seconds), 6) AS mean_seconds, count_if(status = 'FAILED')::BIGINT AS failures, max(seconds) > 43200 AS slow FROM t GROUP BY ALL")
def task_rollup(spark, sf_dir):
    return rounded(jobs.rollup(_tasks(spark, sf_dir)), "mean_seconds")


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"])


@query("SELECT l_returnflag AS file, count(*) AS n, count_if(l_partkey - 50 < 0 OR l_suppkey <= l_partkey - 50)::BIGINT AS bad FROM lineitem GROUP BY 1")
def bed_problems(spark, sf_dir):
    return quality.bed_problems(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("file"), (F.col("l_partkey") - 50).alias("start"), F.col("l_suppkey").alias("end")))


@query("WITH h AS (SELECT p_partkey, p_brand || '|' || CASE p_size % 4 WHEN 0 THEN 'FUSION|' WHEN 1 THEN 'SPLICE|' WHEN 2 THEN 'VAR_1:2:A:T|' ELSE '' END || p_name AS h FROM part) SELECT p_partkey, CASE WHEN contains(h, '|FUSION|') THEN 'FUSION' WHEN contains(h, '|SPLICE|') THEN 'SPLICE' WHEN contains(h, '|VAR_') THEN 'VARIANT' ELSE 'CANONICAL' END AS class, upper(split_part(h, '|', 1)) AS sample, split_part(h, ' ', 1) AS accession FROM h")
def header_parse(spark, sf_dir):
    kind = F.when(F.col("p_size") % 4 == 0, "FUSION|").when(F.col("p_size") % 4 == 1, "SPLICE|").when(F.col("p_size") % 4 == 2, "VAR_1:2:A:T|").otherwise("")
    h = F.concat("p_brand", F.lit("|"), kind, "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", sequences.header_class(h).alias("class"), sequences.header_sample(h).alias("sample"), sequences.header_accession(h).alias("accession"))


@query("SELECT p_partkey, rank() OVER (ORDER BY p_size, p_partkey)::INTEGER AS nth FROM part")
def natural_sort(spark, sf_dir):
    """The key orders text as the numbers in it do; rows are numbered inside ranges of the key, and the ranges by their counts."""
    p = table(spark, sf_dir, "part").select("p_partkey", units.natural_key(F.concat(F.lit("s"), F.col("p_size").cast("string"), F.lit("_"), F.col("p_partkey").cast("string"))).alias("k"))
    from pyspark.sql import Window

    head = F.left("k", F.lit(21))
    p = p.withColumn("h", head)
    n = p.groupBy("h").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return p.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("k"))).join(n, "h").select("p_partkey", (F.col("r") + F.col("base")).cast("int").alias("nth"))


@query("SELECT 0 AS stage_no, 'reported' AS stage, count(*) AS count FROM lineitem UNION ALL SELECT 1, 'deep', count(*) FROM lineitem WHERE l_quantity >= 10 UNION ALL SELECT 2, 'deep_and_passed', count(*) FROM lineitem WHERE l_quantity >= 10 AND l_returnflag = 'N'")
def evidence_funnel(spark, sf_dir):
    deep = F.col("l_quantity") >= 10
    return aggregates.funnel(table(spark, sf_dir, "lineitem"), {"reported": F.lit(True), "deep": deep, "deep_and_passed": deep & (F.col("l_returnflag") == "N")})


@query("WITH x AS (SELECT l_partkey AS gene, ['MODIFIER', 'LOW', 'MODERATE', 'HIGH'][l_linenumber % 4 + 1] AS impact, l_linenumber % 4 + 1 AS r FROM lineitem) SELECT gene, arg_max(impact, r) AS best_impact, count(*) AS alleles, (max(r) * 10)::BIGINT AS score FROM x GROUP BY 1")
def progression_genes(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("gene"), F.get(F.array(*[F.lit(i) for i in ("MODIFIER", "LOW", "MODERATE", "HIGH")]), (F.col("l_linenumber") % 4).cast("int")).alias("impact"))
    return aggregates.progression_genes(x).withColumn("score", F.col("score").cast("bigint"))
