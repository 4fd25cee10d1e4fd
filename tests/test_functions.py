"""Expressions: hand-written reads, units, alleles, statistics."""

import math
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import alleles, cigar, sequences, stats, units


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


READS = [
    # cigar, seq, pos, ref, alt, class, reason
    ("10M", "ACGTACGTAC", 101, "C", "T", "CLEAN_REFERENCE", "EXACT_REFERENCE_HAPLOTYPE"),
    ("10M", "ATGTACGTAC", 101, "CG", "TG", "EXACT_ALT", "EXACT_SUBSTITUTION"),
    ("2M2I8M", "ACGGGTACGTAC", 101, "C", "CGG", "EXACT_ALT", "EXACT_INSERTION"),
    ("2M2D8M", "ACGTACGTAC", 101, "CGT", "C", "EXACT_ALT", "EXACT_DELETION"),
    ("10M", "ACGTACGTAC", 101, "C", "G", "CLEAN_REFERENCE", "EXACT_REFERENCE_HAPLOTYPE"),
    ("10M", "AAGTACGTAC", 101, "C", "G", "EXCLUDED", "OTHER_ALLELE"),
    ("5M5N5M", "ACGTACGTAC", 104, "AC", "TC", "EXCLUDED", "DOES_NOT_SPAN_COMPLETE_ALLELE"),
    ("2M1I8M", "ACGGTACGTAC", 101, "C", "CGG", "EXCLUDED", "OTHER_INSERTION_AT_BREAKPOINT"),
    ("10M", "ACGTACGTAC", 101, "C", "CGG", "CLEAN_REFERENCE", "REFERENCE_CONTIGUOUS_ACROSS_INSERTION_BREAKPOINT"),
    ("2M", "AC", 101, "C", "CGG", "EXCLUDED", "DOES_NOT_SPAN_BOTH_SIDES_OF_INSERTION"),
    ("2M1D8M", "ACGTACGTAC", 101, "CGT", "C", "EXCLUDED", "OTHER_DELETION_AT_BREAKPOINT"),
    ("10M", "ACGTACGTAC", 101, "CGT", "C", "CLEAN_REFERENCE", "EXACT_REFERENCE_HAPLOTYPE"),
    ("10M", "ACGTACGTAC", 101, "CG", "T", "EXCLUDED", "UNSUPPORTED_COMPLEX_REPLACEMENT"),
    ("10Q", "ACGTACGTAC", 101, "C", "T", "EXCLUDED", "UNSUPPORTED_CIGAR"),
    ("*", "ACGTACGTAC", 101, "C", "T", "EXCLUDED", "MISSING_CIGAR_OR_SEQUENCE"),
    ("10M", "ACGTACGTAC", 101, "C", "C", "EXCLUDED", "INVALID_ALLELES"),
    (None, None, 101, "C", "T", "EXCLUDED", "MISSING_CIGAR_OR_SEQUENCE"),
    ("5M1D5M", "ACGTACGTAC", 103, "TAC", "GAC", "EXCLUDED", "DOES_NOT_SPAN_COMPLETE_ALLELE"),
]


def test_read_classes(spark):
    rows = [(i, 0, 60, c, s, "I" * len(s or ""), 100, p, r, a) for i, (c, s, p, r, a, _, _) in enumerate(READS)]
    rows += [(100 + i, f, q, "10M", "ACGTACGTAC", qual, 100, 101, "C", "T") for i, (f, q, qual) in enumerate([(4, 60, "I" * 10), (256, 60, "I" * 10), (2048, 60, "I" * 10), (1024, 60, "I" * 10), (512, 60, "I" * 10), (0, 19, "I" * 10), (0, 60, "!" * 10), (0, 60, "*")])]
    df = spark.createDataFrame(rows, "i int, flag int, mapq int, cigar string, seq string, qual string, start long, pos long, ref string, alt string")
    got = {r.i: (r.c["class"], r.c["reason"]) for r in df.select("i", cigar.read_class(*[F.col(c) for c in df.columns[1:]]).alias("c")).collect()}
    for i, (*_, kind, reason) in enumerate(READS):
        assert got[i] == (kind, reason), READS[i]
    few = [("10M", "ACGTACGTAC", "ABCDEFGHIJ", 101, "CG", "TT"), ("3M2I5M", "ACGTTACGTA", "ABCDEFGHIJ", 102, "G", "GTT"), ("3M2I5M", "ACGTTACGTA", "ABCDEFGHIJ", 102, "G", "GA"), ("10M", "ACGTACGTAC", "ABCDEFGHIJ", 102, "G", "GA"), ("10M", "ACGTACGTAC", "ABCD!FGHIJ", 103, "T", "TA"), ("3M2D7M", "ACGTACGTAC", "ABCDEFGHIJ", 102, "GAA", "G"), ("10M", "ACGTACGTAC", "ABCDEFGHIJ", 102, "GTA", "G"), ("10M", "ACGTACGTAC", "ABCDEFGHIJ", 102, "GTC", "G"), ("3M20N7M", "ACGTACGTAC", "ABCDEFGHIJ", 110, "G", "T")]
    seen = spark.createDataFrame([(i, 0, 60, c, s, q, 100, p, r, a) for i, (c, s, q, p, r, a) in enumerate(few)], df.schema)
    shown = {r.i: (r.c["class"], r.c["observed"], r.c["quality"]) for r in seen.select("i", cigar.read_class(*[F.col(c) for c in df.columns[1:]]).alias("c")).collect()}
    assert [shown[i] for i in range(len(few))] == [("CLEAN_REFERENCE", "CG", "33;34"), ("EXACT_ALT", "TT", "35;36"), ("EXCLUDED", "TT", ""), ("CLEAN_REFERENCE", "G", "34;35"), ("EXCLUDED", "A", "0"), ("EXACT_ALT", "103-104", "34"), ("CLEAN_REFERENCE", "GTA", "34;35;36"), ("EXCLUDED", "GTA", "34;35;36"), ("EXCLUDED", "", "")]
    assert [got[100 + i][1] for i in range(8)] == ["UNMAPPED", "SECONDARY", "SUPPLEMENTARY", "DUPLICATE_FLAG", "QC_FAIL", "LOW_MAPQ", "LOW_ALLELE_BASE_QUALITY", "LOW_ALLELE_BASE_QUALITY"]


def test_evidence_status(spark):
    rows = [(0, 0), (2, 0), (2, 3), (0, 3)]
    df = spark.createDataFrame(rows, "a int, r int").select("a", "r", cigar.evidence_status(F.col("a"), F.col("r")).alias("s"), cigar.alt_fraction(F.col("a"), F.col("r")).alias("f"))
    got = {(r.a, r.r): (r.s, r.f) for r in df.collect()}
    assert got[0, 0] == ("NO_CALLABLE_READS", None) and got[2, 0] == ("ALT_SUPPORTED", 1.0)
    assert got[2, 3] == ("MIXED_ALT_AND_REFERENCE", 0.4) and got[0, 3][0] == "NO_EXACT_ALT_SUPPORT"


def test_gaps_do_not_observe(spark):
    b = cigar.blocks(F.lit("10M1000N10M"), F.lit(101))
    r = one(spark, gap=cigar.observes(b, F.lit(500), F.lit(501)), inside=cigar.observes(b, F.lit(105), F.lit(106)), end=cigar.alignment_end(b, F.lit(101)), j=cigar.junctions(b))
    assert (r.gap, r.inside, r.end) == (False, True, 1120)
    assert [(x.start, x.end) for x in r.j] == [(111, 1110)]
    p = one(spark, p=cigar.provenance(F.lit(16 + 64), b, F.lit(101), F.lit(1113))).p
    assert (p.mate, p.strand, p.read_position) == ("R1", "-", 13)


@pytest.mark.parametrize("row,want", [((10, "ATTT", "ATT"), (10, "AT", "A")), ((10, "CAT", "CGT"), (11, "A", "G")), ((5, "A", "T"), (5, "A", "T")), ((5, "AA", "A"), (5, "AA", "A")), ((7, "GCA", "GCATCA"), (7, "G", "GCAT"))])
def test_trimming(spark, row, want):
    df = spark.createDataFrame([row], "pos long, ref string, alt string")
    assert tuple(alleles.trim_allele(df).first()) == want


def test_alleles(spark):
    r = one(spark, a=alleles.norm_chrom(F.lit("chrM")), b=alleles.norm_chrom(F.lit("CHR7")), c=alleles.zygosity(F.lit("1/2")), d=alleles.alt_dosage(F.lit("1|1"), F.lit(1)), e=alleles.coordinate_label(F.lit("chr1"), F.lit(12345)), f=alleles.allele_type(F.lit("A"), F.lit("AG")))
    assert tuple(r) == ("MT", "7", "other", 2, "chr1:12,345", "INSERTION")
    df = spark.createDataFrame([("A,T,*,<NON_REF>",)], "alt string")
    assert [(r.alt, r.allele_index) for r in alleles.split_multiallelic(df).collect()] == [("A", 1), ("T", 2)]


def test_sequences(spark):
    code = sequences.genetic_code()
    assert (code["ATG"], code["TAA"], code["TGG"], len(code)) == ("M", "*", "W", 64)
    r = one(spark, a=sequences.translate_codon(F.lit("aga"), True), b=sequences.translate_codon(F.lit("AG")), c=sequences.reverse_complement(F.lit("AACG")), d=sequences.normalize_sequence(F.lit("pe-pIL7"), True), e=sequences.norm_amino_acids(F.lit("MK*L**")), f=sequences.header_accession(F.lit("sp|P1|X y")), g=sequences.header_class(F.lit("CON__P1")), h=sequences.mutation_orientation(F.lit("A"), F.lit("G"), F.lit("TAT"), F.lit("TGT")), i=sequences.gene_pair(F.lit("A(12),B--C")))
    assert tuple(r) == ("*", "", "CGTT", "PEPJJ", "MK*L", "P1", "CONTAMINANT", "PLUS_STRAND_ALLELE_CONSISTENT", ["A,B", "C"])


def test_units(spark):
    r = one(spark, a=units.parse_bytes(F.lit("1.5 GB")), b=units.parse_seconds(F.lit("1h 2m 3s 4ms")), c=units.parse_percent(F.lit("350%")), d=units.process_name(F.lit("wf:CALLER (TK12:0000-scattered)")), e=units.process_name(F.lit("CALLER (TK12:0000-scattered)")), f=units.raw_file_name(F.lit("C:\\x\\run1.raw")), g=units.human_size(F.lit(1536)), h=units.sorted_join(F.array(F.lit(" b"), F.lit("a"), F.lit(""), F.lit("b"))))
    assert (r.a, round(r.b, 3), r.c) == (1.5e9, 3723.004, 350.0)
    assert tuple(r)[3:] == ("CALLER", "CALLER", "run1", "1.5 KiB", "a;b")
    names = ["s10", "s9", "S2", "s2b", "s1"]
    df = spark.createDataFrame([(n,) for n in names], "n string").orderBy(units.natural_key(F.col("n")))
    assert [x.n for x in df.collect()] == ["s1", "S2", "s2b", "s9", "s10"]


def tail(k, drawn, marked, total):
    return sum(math.comb(marked, x) * math.comb(total - marked, drawn - x) for x in range(max(k, 0), min(drawn, marked) + 1) if drawn - x <= total - marked) / math.comb(total, drawn)


def test_hypergeometric_tail(spark):
    rows = [(k, d, m, n) for n in (5, 9, 30) for d in range(0, n + 1, 2) for m in range(0, n + 1, 3) for k in range(0, min(d, m) + 1)]
    df = spark.createDataFrame(rows, "k int, d int, m int, n int")
    for r in df.select("*", stats.hypergeom_tail(*[F.col(c) for c in "kdmn"]).alias("p")).collect():
        assert abs(r.p - tail(r.k, r.d, r.m, r.n)) < 1e-9, r


def test_bh(spark):
    p = [0.01, 0.02, 0.02, 0.5, 0.9, 0.04]
    rows = [(g, i, x) for g in "ab" for i, x in enumerate(p)]
    got = {(r.g, r.i): r.fdr for r in stats.bh_fdr(spark.createDataFrame(rows, "g string, i int, p double"), "p", ["g"]).collect()}
    for g in "ab":
        for i, x in enumerate(p):
            want = min(1, min(y * len(p) / sum(z <= y for z in p) for y in p if y >= x))
            assert abs(got[g, i] - want) < 1e-12 and got[g, i] >= x


def test_tied_ranks(spark):
    x = [3.0, 1.0, 3.0, 2.0, 3.0]
    got = {r.i: r["rank"] for r in stats.tied_ranks(spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, s double"), "s", []).collect()}
    assert got == {1: 1.0, 3: 2.0, 0: 4.0, 2: 4.0, 4: 4.0}
    assert len(list(combinations(range(5), 2))) == 10


def test_normal_p(spark):
    df = spark.createDataFrame([(0.0,), (1.96,), (-1.96,), (None,)], "z double")
    got = [r.p for r in df.select(stats.two_sided_normal_p(F.col("z")).alias("p")).collect()]
    assert got[0] == 1.0 and abs(got[1] - 0.05) < 1e-3 and got[1] == got[2] and (got[3] is None or got[3] != got[3])
