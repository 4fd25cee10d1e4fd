"""Whole jobs over reads, variants and a genome, each with SQL.

A line item is a read near its part's place; a part is a variant of one base, a
piece of the genome and an annotation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.plans import composites
from tallyloom.plans.queries import _BASES, ORACLE, _aa, _codons, _reads, query, rounded, table

_GENOME = "ACGTTGCAAC"

_PLACED = f"""
WITH r AS (SELECT l_returnflag AS sample, l_orderkey || '.' || l_linenumber AS qname, l_partkey * 100 + l_suppkey % 100 AS read_start, l_linenumber + 10 AS a, l_quantity::INT AS b, substr(repeat('{_GENOME}', 8), (l_suppkey % 4 + 1)::INT, l_linenumber + 10 + l_quantity::INT) AS seq,
  (CASE WHEN l_discount > 0.08 THEN 1024 ELSE 0 END + CASE WHEN l_suppkey % 2 = 0 THEN 16 ELSE 0 END + CASE l_linenumber % 3 WHEN 1 THEN 64 WHEN 2 THEN 128 ELSE 0 END)::INT AS flag, floor(l_tax * 1000)::INT AS mapq FROM lineitem),
v AS (SELECT p_partkey, p_size, ['A', 'N', 'R'][p_partkey % 3 + 1] AS sample, '1' AS chrom, p_partkey * 100 + 60 AS pos, substr('ACGT', p_size % 4 + 1, 1) AS ref, substr('CGTA', p_size % 4 + 1, 1) AS alt FROM part),
o AS (SELECT v.*, r.* EXCLUDE (sample), CASE WHEN pos - read_start + 1 BETWEEN 1 AND a THEN pos - read_start + 1 WHEN pos - read_start + 1 BETWEEN a + 21 AND a + 20 + b THEN pos - read_start - 19 END AS place
  FROM v JOIN r ON v.sample = r.sample AND read_start - {{pad}} <= pos AND pos <= read_start + a + 19 + b + {{pad}}),
k AS (SELECT *, CASE WHEN flag >= 1024 OR mapq < 20 OR place IS NULL THEN 'EXCLUDED' WHEN substr(seq, place, 1) = alt THEN 'EXACT_ALT' WHEN substr(seq, place, 1) = ref THEN 'CLEAN_REFERENCE' ELSE 'EXCLUDED' END AS class FROM o),
n AS (SELECT sample, chrom, pos, ref, alt, count_if(class = 'EXACT_ALT')::BIGINT AS alt_reads, count_if(class = 'CLEAN_REFERENCE')::BIGINT AS ref_reads, count_if(class = 'EXCLUDED')::BIGINT AS excluded_reads FROM k GROUP BY ALL)
"""


def _placed_reads(spark, sf_dir):
    mate = F.when(F.col("l_linenumber") % 3 == 1, 64).when(F.col("l_linenumber") % 3 == 2, 128).otherwise(0)
    flag = F.when(F.col("l_discount") > 0.08, 1024).otherwise(0) + F.when(F.col("l_suppkey") % 2 == 0, 16).otherwise(0) + mate
    rows = _reads(spark, sf_dir, F.col("l_partkey") * 100 + F.col("l_suppkey") % 100, flag)
    return rows.withColumns({"sample": F.col("chrom"), "rname": F.lit("chr1"), "qname": F.concat_ws(".", "l_orderkey", "l_linenumber")}).drop("chrom", "l_orderkey", "l_linenumber")


def _at(text, k):
    return F.substr(F.lit(text), (k + 1).cast("int"), F.lit(1))


def _placed_variants(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(_at("ANR", k % 3).alias("sample"), F.lit("chr1").alias("chrom"), (k * 100 + 60).alias("pos"), _at("ACGT", s % 4).alias("ref"), _at("CGTA", s % 4).alias("alt"))


@query(_PLACED.format(pad=0) + "SELECT sample, chrom, pos, ref, alt, qname, CASE WHEN flag & 64 <> 0 THEN 'R1' WHEN flag & 128 <> 0 THEN 'R2' ELSE 'UNPAIRED' END AS mate, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, place AS read_position, read_start + a + 19 + b AS alignment_end FROM k WHERE class = 'EXACT_ALT'")
def variant_read_provenance(spark, sf_dir):
    return composites.variant_read_provenance(_placed_reads(spark, sf_dir), _placed_variants(spark, sf_dir))


@query(_PLACED.format(pad=2) + "SELECT *, CASE WHEN alt_reads > 0 AND ref_reads > 0 THEN 'MIXED_ALT_AND_REFERENCE' WHEN alt_reads > 0 THEN 'ALT_SUPPORTED' WHEN ref_reads > 0 THEN 'NO_EXACT_ALT_SUPPORT' ELSE 'NO_CALLABLE_READS' END AS status, round(CASE WHEN alt_reads + ref_reads > 0 THEN alt_reads::DOUBLE / (alt_reads + ref_reads) END, 6) AS alt_fraction FROM n")
def finding_review_counts(spark, sf_dir):
    return rounded(composites.finding_review(_placed_reads(spark, sf_dir), _placed_variants(spark, sf_dir))[0], "alt_fraction")


@query(
    _PLACED.format(pad=2)
    + """, s AS (SELECT *, a || 'M20N' || b || 'M' AS cigar, row_number() OVER (PARTITION BY sample, chrom, pos, ref, alt, class ORDER BY qname, flag, read_start) AS rank FROM k)
SELECT sample, chrom, pos, ref, alt, qname, class, rank, sha256(concat_ws(chr(31), qname, chrom, read_start, flag, cigar, class)) AS alignment_key FROM s WHERE rank <= CASE class WHEN 'CLEAN_REFERENCE' THEN 2 ELSE 3 END"""
)
def finding_review_reads(spark, sf_dir):
    limits = {"EXACT_ALT": 3, "CLEAN_REFERENCE": 2, "EXCLUDED": 3}
    shown = composites.finding_review(_placed_reads(spark, sf_dir), _placed_variants(spark, sf_dir), limits)[1]
    return shown.select(*composites.ALLELE, "qname", "class", "rank", "alignment_key")


@query(
    _PLACED.format(pad=0)
    + f""", c AS (SELECT *, substr('{_BASES * 3}', p_partkey % 30 + 1, 3) AS rc, substr('{_BASES * 3}', p_partkey % 29 + 2, 3) AS ac, substr('FLSYCWPHQRIMTNKVADEG*', p_partkey % 21 + 1, 1) AS ra, substr('FLSYCWPHQRIMTNKVADEG*', p_size % 21 + 1, 1) AS aa,
  substr('{_GENOME}', (p_size + 9) % 10 + 1, 1) AS g FROM v),
t AS (SELECT *, {_aa("rc")} AS rt, {_aa("ac")} AS altt FROM c),
x AS (SELECT t.*, coalesce(alt_reads, 0) AS alts, coalesce(ref_reads, 0) AS refs, coalesce(excluded_reads, 0) AS excluded,
  CASE WHEN g = t.ref THEN 'GENOME_REF_VALIDATED' ELSE 'GENOME_REF_MISMATCH' END AS genome_status,
  CASE WHEN coalesce(alt_reads, 0) < 2 THEN 'ALT_READS_BELOW_MINIMUM' WHEN alt_reads / (alt_reads + ref_reads) < 0.4 THEN 'ALT_FRACTION_BELOW_MINIMUM' ELSE 'ALT_READS_VALIDATED' END AS read_status,
  CASE WHEN p_size % 7 = 0 THEN 'COMPLEX_CONSEQUENCE_NOT_SINGLE_CODON_COMPARABLE' WHEN p_size % 7 = 1 AND rt = altt AND ra = rt AND aa = altt THEN 'SYNONYMOUS_CODON_TRANSLATION_CONFIRMED' WHEN rt = ra AND altt = aa THEN 'CODON_TRANSLATION_MATCH' ELSE 'CODON_TRANSLATION_MISMATCH' END AS codon_status,
  p_size % 7 <> 0 AND rt = ra AND altt = aa AS eligible FROM t LEFT JOIN n USING (sample, chrom, pos, ref, alt)),
f AS (SELECT *, list_filter([CASE WHEN genome_status <> 'GENOME_REF_VALIDATED' THEN genome_status END, CASE WHEN read_status <> 'ALT_READS_VALIDATED' THEN read_status END, CASE WHEN codon_status = 'CODON_TRANSLATION_MISMATCH' THEN codon_status END], lambda c: c IS NOT NULL) AS codes FROM x)
SELECT sample, chrom, pos, ref, alt, 'T' || i AS transcript, alts AS alt_reads, refs AS ref_reads, excluded AS excluded_reads, genome_status, read_status, codon_status, array_to_string(codes, ';') AS codes, codes[1] AS primary_failure,
  CASE WHEN len(codes) > 0 THEN 'VALIDATION_FAILED' WHEN eligible THEN 'VARIANT_CODON_VALIDATED' ELSE 'VARIANT_EVIDENCE_PARTIAL' END AS overall_status FROM f, unnest(range(0, p_partkey % 2 + 1)) AS u(i)"""
)
def variant_codon_validation(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    part = table(spark, sf_dir, "part")
    ref, alt, ref_aa, alt_aa = _codons()
    term = F.when(s % 7 == 0, "frameshift_variant&x").when(s % 7 == 1, "synonymous_variant").otherwise("missense_variant")
    notes = part.select(_at("ANR", k % 3).alias("sample"), F.lit("chr1").alias("chrom"), (k * 100 + 60).alias("pos"), _at("ACGT", s % 4).alias("ref"), _at("CGTA", s % 4).alias("alt"), F.concat(ref, F.lit("/"), alt).alias("codons"), F.concat(ref_aa, F.lit("/"), alt_aa).alias("amino_acids"), term.alias("consequence"), F.explode(F.sequence(F.lit(0).cast("bigint"), k % 2)).alias("i"))
    genome = part.select(F.lit("chr1").alias("contig"), k.alias("chunk_no"), F.substr(F.lit(_GENOME * 11), (s % 10 + 1).cast("int"), F.lit(100)).alias("seq"))
    rows = composites.variant_codon_validation(_placed_variants(spark, sf_dir), _placed_reads(spark, sf_dir), notes.withColumn("transcript", F.concat(F.lit("T"), "i")).drop("i"), genome, min_alt=2, min_fraction=0.4, chunk=100)
    return rows.select(*composites.ALLELE, "transcript", "alt_reads", "ref_reads", "excluded_reads", "genome_status", "read_status", "codon_status", F.array_join("failure_codes", ";").alias("codes"), "primary_failure", "overall_status")


_AROUND = _PLACED.format(pad=150).replace("JOIN r ON v.sample = r.sample AND", "JOIN r ON").replace("r.* EXCLUDE (sample)", "r.* RENAME (sample AS bam)")


@query(
    _AROUND
    + """, g AS (SELECT sample, chrom, pos, ref, alt, bam, count_if(class = 'CLEAN_REFERENCE')::BIGINT AS ref_reads, count_if(class = 'EXACT_ALT')::BIGINT AS alt_reads, count_if(class = 'EXCLUDED')::BIGINT AS other_reads, count_if(class = 'EXACT_ALT' AND flag & 16 = 0)::BIGINT AS alt_forward, count_if(class = 'EXACT_ALT' AND flag & 16 <> 0)::BIGINT AS alt_reverse,
  count_if(class = 'EXACT_ALT' AND flag & 64 <> 0)::BIGINT AS alt_r1, count_if(class = 'EXACT_ALT' AND flag & 192 = 128)::BIGINT AS alt_r2, round(avg(mapq), 6) AS mean_mapq, avg(CASE WHEN flag < 1024 AND mapq >= 20 AND place IS NOT NULL THEN 40 END) AS mean_base_quality FROM k GROUP BY ALL)
SELECT g.*, round(alt_reads::DOUBLE / nullif(alt_reads + ref_reads, 0), 6) AS alt_fraction, (SELECT count(*) FROM part WHERE p_partkey * 100 + p_size <= pos AND p_partkey * 100 + p_size + 99 >= pos)::BIGINT AS features FROM g"""
)
def proteogenomic_read_validation(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    features = table(spark, sf_dir, "part").select(F.lit("chr1").alias("chrom"), (k * 100 + s).alias("start"), (k * 100 + s + 99).alias("end"), k.alias("gene"))
    n = composites.proteogenomic_read_counts(_placed_reads(spark, sf_dir), _placed_variants(spark, sf_dir), features)
    return rounded(n, "mean_mapq", "alt_fraction")


@query(f"SELECT p_partkey, category, category IN ('UNEXPLAINED_TRANSLATION_MISMATCH', 'CODON_CHANGE_INCONSISTENT_WITH_VCF_ALLELES') AS needs_manual_review FROM ({ORACLE['codon_mismatches']})")
def codon_mismatch_report(spark, sf_dir):
    ref, alt, ref_aa, alt_aa = _codons()
    fields = {"chrom": F.when(F.col("p_size") % 5 == 0, "chrM").otherwise("chr1"), "ref": F.lit("A"), "alt": F.lit("G"), "codons": F.concat(ref, F.lit("/"), alt), "amino_acids": F.concat(ref_aa, F.lit("/"), alt_aa), "consequence": F.when(F.col("p_size") % 7 == 0, "frameshift_variant").otherwise("missense_variant")}
    return composites.codon_mismatch_report(table(spark, sf_dir, "part").withColumns(fields)).select("p_partkey", "category", "needs_manual_review")


@query("""
WITH r AS (SELECT l_returnflag AS sample, l_linestatus AS chrom, substr('ACGTA', l_linenumber % 4 + 1, l_suppkey % 2 + 1) AS ref, ['G', 'A,T', 'AC,*', 'T'][l_partkey % 4 + 1] AS alts, CASE WHEN l_tax > 0.05 THEN 'LOW' ELSE 'PASS' END AS filter FROM lineitem),
x AS (SELECT sample, chrom, ref, contains(alts, ',') AS several, unnest(string_split(alts, ',')) AS alt FROM r),
y AS (SELECT *, length(ref) = 1 AND length(alt) = 1 AS snv, ref || alt IN ('AG', 'GA', 'CT', 'TC') AS ti FROM x WHERE alt <> '*'),
f AS (SELECT sample, string_agg(filter || ':' || n, ';' ORDER BY filter) AS filters FROM (SELECT sample, filter, count(*) AS n FROM r GROUP BY ALL) GROUP BY 1)
SELECT sample, count(*) AS alleles, count_if(snv)::BIGINT AS snvs, count_if(length(ref) <> length(alt))::BIGINT AS indels, count_if(snv AND ti)::BIGINT AS transitions, count_if(snv AND NOT ti)::BIGINT AS transversions, count(DISTINCT chrom) AS contigs,
  round(count_if(snv AND ti)::DOUBLE / nullif(count_if(snv AND NOT ti), 0), 6) AS ti_tv, count_if(several)::BIGINT AS multiallelic, any_value(filters) AS filters FROM y JOIN f USING (sample) GROUP BY 1
""")
def stage_qc(spark, sf_dir):
    alts = F.get(F.array(*[F.lit(x) for x in ("G", "A,T", "AC,*", "T")]), (F.col("l_partkey") % 4).cast("int"))
    ref = F.substr(F.lit("ACGTA"), (F.col("l_linenumber") % 4 + 1).cast("int"), (F.col("l_suppkey") % 2 + 1).cast("int"))
    records = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("sample"), F.col("l_linestatus").alias("chrom"), ref.alias("ref"), alts.alias("alt"), F.when(F.col("l_tax") > 0.05, "LOW").otherwise("PASS").alias("filter"))
    return rounded(composites.stage_qc(records, ["sample"]), "ti_tv")
