"""Composite jobs on a few rows with known results."""

import random

import pytest

from tallyloom.operators import joins, reports, windows
from tallyloom.plans import composites
from tallyloom.plans import composites as c

READ = "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, qual string"
VARIANT = "sample string, chrom string, pos long, ref string, alt string"


def reads(spark):
    good = "I" * 10
    rows = [("S", f"a{i}", 0, "chr1", 100, 60, "10M", "ATGTACGTAC", good) for i in range(3)]
    rows += [("S", "r", 16, "chr1", 100, 60, "10M", "ACGTACGTAC", good), ("S", "a0", 0, "chr1", 100, 60, "10M", "ATGTACGTAC", good), ("S", "x", 1024, "chr1", 100, 60, "10M", "ATGTACGTAC", good), ("T", "o", 0, "chr1", 100, 60, "10M", "ATGTACGTAC", good)]
    return spark.createDataFrame(rows, READ)


def test_read_and_codon_validation(spark):
    variants = spark.createDataFrame([("S", "1", 101, "C", "T"), ("S", "1", 500, "A", "G")], VARIANT)
    genome = spark.createDataFrame([("1", 0, "A" * 100 + "C" + "A" * 600)], "contig string, chunk_no long, seq string")
    notes = spark.createDataFrame([("S", "1", 101, "C", "T", "aCg/aTg", "T/M", "missense_variant", "T1"), ("S", "1", 500, "A", "G", "aaA/aaG", "K/K", "synonymous_variant", "T2")], VARIANT + ", codons string, amino_acids string, consequence string, transcript string")
    got = {r.pos: r for r in c.variant_codon_validation(variants, reads(spark), notes, genome).collect()}
    assert (got[101].alt_reads, got[101].ref_reads, got[101].excluded_reads, got[101].overall_status) == (3, 1, 1, "VARIANT_CODON_VALIDATED")
    assert (got[500].failure_codes, got[500].primary_failure) == (["ALT_READS_BELOW_MINIMUM"], "ALT_READS_BELOW_MINIMUM")
    where = c.variant_read_provenance(reads(spark), variants).collect()
    assert [(r.qname, r.strand, r.read_position) for r in where] == [("a0", "+", 2), ("a1", "+", 2), ("a2", "+", 2)]
    counts, shown = c.finding_review(reads(spark), variants, {"EXACT_ALT": 2})
    assert shown.count() == 2 and counts.filter("pos = 101").first().status == "MIXED_ALT_AND_REFERENCE"


def test_rule_jobs(spark):
    calls = spark.createDataFrame([("S", "1", 3, "C", "T", "PASS", {"CSQ": "T|missense_variant"}, {"DP": "20", "AD": "12,8"}), ("S", "1", 4, "A", "T,G", "q", {}, None)], "sample string, chrom string, pos long, ref string, alt string, filter string, info map<string,string>, format map<string,string>")
    genome = spark.createDataFrame([("1", 0, "AACG")], "contig string, chunk_no long, seq string")
    got = {r.pos: r for r in c.rna_variant_validation(calls, genome, ["Allele", "Consequence"]).collect()}
    assert got[3].status == "RNA_VALIDATED" and got[3].observed == "DP=20;ALT=8;FILTER=PASS"
    assert got[4].failure_codes[:3] == ["VCF_FILTER_NOT_PASS", "MULTIALLELIC_REQUIRES_NORMALIZATION", "REFERENCE_ALLELE_MISMATCH"]
    fusions = spark.createDataFrame([("1:5", "2:9", 2, 1, 0, "high", "in-frame", "a, b,a"), ("", "2:9", 0, 0, None, "LOW", None, None)], "breakpoint1 string, breakpoint2 string, split_reads1 int, split_reads2 int, discordant_mates int, confidence string, reading_frame string, read_identifiers string")
    rows = c.rna_fusion_validation(fusions).collect()
    assert rows[0].status == "RNA_VALIDATED" and rows[0].unique_supporting_read_names == 2 and len(rows[1].failure_codes) == 5
    exons = spark.createDataFrame([("T1", "1", 1, 9), ("T1", "1", 20, 30), ("T2", "1", 5, 6)], "transcript string, chrom string, start long, end long")
    spanning = spark.createDataFrame([("S", f"q{i}", 0, "1", 5, 60, "5M10N5M", "A" * 10, "I" * 10) for i in range(3)], READ)
    status = {r.transcript: (r.status, r.min_support) for r in c.rna_splice_validation(exons, spanning).collect()}
    assert status == {"T1": ("RNA_VALIDATED", 3), "T2": ("REJECTED", 0)}


def test_comparison_and_progression(spark):
    call = "chrom string, pos long, ref string, alt string, gt string"
    left = spark.createDataFrame([("chr1", 10, "ATT", "ATC,A", "1/2"), ("2", 5, "A", "G", "0/1")], call)
    right = spark.createDataFrame([("1", 12, "T", "C", "0/1"), ("2", 5, "A", "G", "1/1")], call)
    found, metrics = c.caller_comparison(left, right)
    assert {(r.chrom, r.pos, r.ref, r.alt): (r.side, r.concordance) for r in found.collect()} == {("1", 12, "T", "C"): ("shared", "yes"), ("2", 5, "A", "G"): ("shared", "no"), ("1", 10, "ATT", "A"): ("left_only", "not_comparable")}
    m = metrics.first()
    assert (m.shared, m.left_only, m.right_only, m.concordance_percent) == (2, 1, 0, 50.0)
    variants = spark.createDataFrame([("B", "1", 1, "A", "T", "g1", "LOW"), ("F", "1", 1, "A", "T", "g1", "LOW"), ("F", "1", 2, "A", "T", "g2", "HIGH"), ("G", "1", 2, "A", "T", "g2", "HIGH")], VARIANT + ", gene string, impact string")
    samples = spark.createDataFrame([("P", "B", True), ("P", "F", False), ("P", "G", False)], "subject string, sample string, baseline boolean")
    terms = spark.createDataFrame([("g1", "t"), ("g2", "u")], "gene string, term string")
    out = c.progression_analysis(variants, samples, terms)
    assert {(r.pos, r.partition) for r in out["partition"].collect()} == {(1, "shared"), (2, "nonbaseline_only")}
    assert [(r.gene, r.best_impact, r.score) for r in out["genes"].collect()] == [("g2", "HIGH", 40)]
    assert {(r.a, r.b, r.pos): r.contrast for r in out["contrasts"].collect()} == {("B", "F", 1): "shared", ("B", "F", 2): "B_only", ("B", "G", 1): "A_only", ("B", "G", 2): "B_only", ("F", "G", 1): "A_only", ("F", "G", 2): "shared"}
    assert out["enrichment"].count() == 4


def test_expression_and_ontology(spark):
    counts = spark.createDataFrame([(s, g, float(n)) for s, g, n in [("B", "g1", 10), ("B", "g2", 30), ("F", "g1", 40), ("F", "g2", 0), ("F", "g3", 5)]], "sample string, gene string, count double")
    exons = spark.createDataFrame([("g1", 1, 1000), ("g1", 500, 1500), ("g2", 1, 100), ("g3", 1, 10)], "gene string, start long, end long")
    samples = spark.createDataFrame([("P", "B", True), ("P", "F", False), ("Q", "X", False)], "subject string, sample string, baseline boolean")
    sets = spark.createDataFrame([("g1", "t"), ("g2", "u"), ("g3", "u")], "gene string, term string")
    out = c.expression_go(counts, exons, samples, sets)
    by = {(r["sample"], r.gene): r for r in out["matrix"].collect()}
    assert by["B", "g1"].cpm == 250000.0 and abs(sum(r.tpm for k, r in by.items() if k[0] == "B") - 1e6) < 1e-6
    assert {(r.base, r.followup, r.term, r.size) for r in out["ranked"].collect()} == {("B", "F", "t", 1), ("B", "F", "u", 2)}
    assert [r.subject for r in out["skipped"].collect()] == ["Q"]
    terms = spark.createDataFrame([("GO:1", "root", "p"), ("GO:2", "leaf", "p")], "id string, name string, namespace string")
    up = c.go_annotation_closure(spark.createDataFrame([("g1", "GO:2")], "gene string, term string"), spark.createDataFrame([("GO:2", "GO:1")], "child string, parent string"), terms)
    assert {(r.gene, r.term) for r in up.collect()} == {("g1", "GO:1"), ("g1", "GO:2")}


def test_peptides_and_catalogue(spark):
    peptides = spark.createDataFrame([("MKTAYIAK", 0.001, 80.0, 3), ("QQQQLLLL", None, 80.0, 3), ("SHAREDPEP", 0.001, 80.0, 3)], "sequence string, pep double, score double, msms int")
    proteins = spark.createDataFrame([("S1|VAR_1:5:A:T", "XXMKTAYIAKXX"), ("sp|P1|N", "AASHAREDPEPAA"), ("S1|FUSION|x", "QQQQLLLLSHAREDPEP")], "header string, sequence string")
    got = {r.sequence: r for r in c.peptide_mapping(peptides, proteins).collect()}
    assert got["MKTAYIAK"].high_confidence and got["MKTAYIAK"].novel_classes == "VARIANT" and got["MKTAYIAK"].first_position == 3
    assert not got["QQQQLLLL"].high_confidence and not got["SHAREDPEP"].high_confidence
    v = spark.createDataFrame([("S", "1", 10, "AT", "A")], VARIANT)
    f = spark.createDataFrame([("g1", "g2", "3:200", "4:300")], "gene1 string, gene2 string, breakpoint1 string, breakpoint2 string")
    j = spark.createDataFrame([("T1", "2", 100, 150)], "transcript string, chrom string, start long, end long")
    rows = {r["class"]: r for r in c.event_catalogue(v, f, j).collect()}
    assert (rows["rna_variant"].start0, rows["rna_variant"].end0) == (9, 11)
    assert (rows["fusion"].start0, rows["fusion"].chrom2, rows["fusion"].start2_0) == (199, "4", 299)
    assert (rows["splice_junction"].start0, rows["splice_junction"].end0) == (99, 150)


def test_stage_qc(spark):
    rows = [("s", "1", "A", "G,*", "PASS"), ("s", "1", "AC", "A", "LOW"), ("s", "2", "C", "A,T", "PASS"), ("t", "1", "A", "AT", ".")]
    got = {r.sample: r for r in composites.stage_qc(spark.createDataFrame(rows, "sample string, chrom string, ref string, alt string, filter string"), ["sample"]).collect()}
    s = got["s"]
    assert (s.alleles, s.snvs, s.indels, s.transitions, s.transversions, s.multiallelic, s.filters) == (4, 3, 1, 2, 1, 3, "LOW:1;PASS:2")
    assert got["t"].multiallelic == 0 and got["t"].ti_tv is None


def test_reads_of_all_samples_around_an_event(spark):
    reads = [("S1", "q1", 0, "chr1", 100, 60, "10M", "AAAAACAAAA", "I" * 10), ("S2", "q2", 16 + 64, "chr1", 100, 60, "10M", "AAAAAGAAAA", "I" * 10), ("S2", "q3", 0, "chr1", 200, 60, "10M", "A" * 10, "I" * 10), ("S2", "q4", 0, "chr2", 100, 60, "10M", "A" * 10, "I" * 10)]
    df = spark.createDataFrame(reads, "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, qual string")
    variants = spark.createDataFrame([("S1", "1", 105, "C", "G")], "sample string, chrom string, pos long, ref string, alt string")
    features = spark.createDataFrame([("chr1", 1, 105, "g"), ("1", 106, 200, "h")], "chrom string, start long, end long, gene string")
    n, rows = composites.proteogenomic_read_validation(df, variants, features)
    got = {r.bam: r for r in n.collect()}
    assert (got["S1"].ref_reads, got["S1"].alt_reads, got["S1"].other_reads, got["S1"].features) == (1, 0, 0, 1)
    assert (got["S2"].ref_reads, got["S2"].alt_reads, got["S2"].other_reads, got["S2"].alt_reverse, got["S2"].alt_r1, got["S2"].alt_fraction) == (0, 1, 1, 1, 1, 1.0)
    assert rows.count() == 3 and {r.qname: (r.observed, r.base_quality) for r in rows.collect()} == {"q1": ("C", 40), "q2": ("G", 40), "q3": ("", None)}
    assert {r.mean_base_quality for r in n.collect()} == {40.0}


@pytest.mark.parametrize("bin_width", [16, 1 << 16])
def test_reads_around_an_event_are_counted_without_pairs(spark, monkeypatch, bin_width):
    """The summary equals that of all pairs: repeated and long reads, events of several positions over a bin's end, missing qualities."""
    rng = random.Random(11)
    reads = []
    for k in range(150):
        shape = rng.choice(["10M", "5M3D5M", "4M40N6M", "10M", "6M2I4M", "*"])
        n = {"6M2I4M": 12, "*": 0}.get(shape, 10)
        reads.append((rng.choice("ST"), f"q{k % 140}", rng.choice([0, 16, 64, 128 + 16, 1024]), rng.choice(["chr1", "2"]), rng.randrange(1, 120), rng.choice([0, 19, 20, 60, None]), shape, "".join(rng.choice("AC") for _ in range(n)) or None, "".join(rng.choice("I+") for _ in range(n)) or "*"))
    reads += [("U", "u", 0, "1", 50, 60, "10M", "A" * 10, "I" * 10)] + reads[:40]
    df = spark.createDataFrame(reads, "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, qual string")
    alleles_ = [("A", "C"), ("C", "A"), ("AAC", "A"), ("A", "AC"), ("A" * 40, "A"), ("AC", "CA")]
    events = [(rng.choice("ST"), rng.choice(["1", "chr2"]), rng.randrange(1, 150), *rng.choice(alleles_)) for _ in range(60)]
    variants = spark.createDataFrame([*events, *events[:9], ("S", "3", 5, "A", "C")], "sample string, chrom string, pos long, ref string, alt string")
    features = spark.createDataFrame([("1", 1, 60, "g")], "chrom string, start long, end long, gene string")
    _, rows = composites.proteogenomic_read_validation(df, variants, features, pad=7)
    keys = [*composites.ALLELE, "bam"]
    want = reports.event_read_summary(rows, keys)
    pads = []
    wanted = joins.range_join
    monkeypatch.setattr(joins, "range_join", lambda *a, **o: (pads.append(o.get("pad", 0)), wanted(*a, **o))[1])
    monkeypatch.setattr(reports, "COUNT_BIN", bin_width)
    got = composites.proteogenomic_read_counts(df, variants, features, pad=7)
    assert set(map(tuple, got.select(*want.columns).collect())) == set(map(tuple, want.collect())) and got.count() == want.count() > 100
    assert pads == [0, 0]


def test_splice_junctions_by_strand(spark):
    exons = [("ENST1", "1", "+", 101, 130), ("ENST1", "1", "+", 201, 260), ("ENST2", "1", "-", 101, 130), ("ENST2", "1", "-", 201, 260)]
    df = spark.createDataFrame(exons, "transcript string, chrom string, strand string, start long, end long")
    got = {r.transcript: (r.start, r.end, r.offset) for r in windows.exon_junctions(df, by_strand=True).collect()}
    assert got == {"ENST1": (131, 200, 30), "ENST2": (131, 200, 60)}
    proteins = [("S|SPLICE|ENST1:1-90(+)", "MKTAYIAKQRQISFVKSHFSRQLEERLGLI"), ("S|SPLICE|ENST9:1-90(+)", "MMMM"), ("nothing", "MKT"), ("S|SPLICE|ENST1", "MKT")]
    out = composites.splice_junction_validation(spark.createDataFrame(proteins, "header string, sequence string"), df, spark.createDataFrame([("KQRQISF",), ("MKTA",), ("QISF",)], "peptide string"))
    spans = {r.peptide: (r.left, r.right, r.spanning) for r in out["spans"].collect()}
    # the junction lies behind residue 10
    assert spans == {"KQRQISF": (3, 4, True), "QISF": (0, 4, False)}
    assert {r.peptide: r.choice for r in out["choice"].collect()} == {"KQRQISF": "VALIDATED", "QISF": "FIRST"}
    assert {r.header: r.reason for r in out["unresolved"].collect()} == {"S|SPLICE|ENST9:1-90(+)": "TRANSCRIPT_NOT_IN_MODEL", "nothing": "NO_TRANSCRIPT_IN_HEADER", "S|SPLICE|ENST1": "NO_READING_FRAME"}


def test_evidence_and_hypotheses(spark):
    events = spark.createDataFrame([("A", "1", 5, "C", "T", "ENST1.2", "g", "missense_variant"), ("B", "1", 5, "C", "T", "ENST1.3", "g", "missense_variant"), ("A", "2", 9, "C", "T", "ENST2", "h", "x")], "sample string, chrom string, pos long, ref string, alt string, transcript string, gene string, consequence string")
    notes = [("A", "1", 5, "C", "T", "ENST1", "p", "h1", "PEPTK", "VALIDATED_SUBSTITUTION", 2, "no"), ("A", "1", 5, "C", "G", "ENST1.9", "p", "h2", "other", "PEPTIDE_NOT_FOUND", 2, "no")]
    annotations = spark.createDataFrame(notes, "sample string, chrom string, pos long, ref string, alt string, transcript string, hgvsp string, header string, sequence string, status string, msms int, in_reference string")
    mapping = spark.createDataFrame([("PEPTK", True)], "sequence string, canonical_absent boolean")
    spectra = spark.createDataFrame([("PEPTK", "A", True, True), ("PEPTK", "B", False, True), ("JUNC", "B", True, True)], "sequence string, sample string, direct boolean, clean boolean")
    junctions = spark.createDataFrame([("junc", "j1", "novel", 4, 2, 3, "B", True), ("junc", "j1", "novel", 4, 2, 3, "A", True), ("junc", "j2", "novel", 4, 2, 3, "A", False)], "sequence string, junction string, reference_status string, support int, left int, right int, sample string, spanning boolean")
    out = composites.proteogenomic_evidence(events, annotations, mapping, spectra, junctions, min_length=5)
    got = {(r.sample, r.pos): r for r in out["variants"].collect()}
    a = got["A", 5]
    assert (a.all_peptides, a.altered, a.search_consistent, a.both_absent, a.category, a.classes.sample_specific, a.only_transferred) == (["OTHER", "PEPTK"], ["PEPTK"], ["PEPTK"], ["PEPTK"], "ALTERED_RESIDUE", True, ["B"])
    assert got["B", 5].category == got["A", 9].category == "RNA_ONLY"
    strict = composites.proteogenomic_evidence(events, annotations, mapping, spectra, junctions, min_length=9, match_alt=True)["variants"].filter("sample = 'A' AND pos = 5").first()
    assert strict.all_peptides == ["PEPTK"] and strict.search_consistent == []
    j = out["junctions"].collect()
    assert len(j) == 1 and j[0].source_samples == ["A", "B"] and j[0].classes.rna_and_direct == ["B"]
    integrated, failures = spark.createDataFrame([(True,)], "strict boolean"), spark.createDataFrame([(1,)], "task_id int")
    h = {r.hypothesis: r.conclusion for r in composites.ms_hypotheses(out["variants"], out["junctions"], integrated, failures).collect()}
    assert h == {"ALTERED_PEPTIDES": "NOT_EVALUABLE", "NOVEL_PEPTIDES": "SUPPORTED", "SAMPLE_MATCHED_SPECTRA": "SUPPORTED", "STRICT_EVENTS": "SUPPORTED", "NOVEL_JUNCTIONS": "SUPPORTED", "SAMPLE_MATCHED_JUNCTIONS": "SUPPORTED"}


def test_reads_travel_once_to_be_counted_once(spark):
    """Pairs lie by their bins after the join: double reads leave there, without a second exchange of rows."""
    rows = [("S", f"q{k % 300}", 0, "chr1", 100 * (k % 300), 60, "50M", "A" * 50, "I" * 50) for k in range(600)]
    reads = spark.createDataFrame(rows, "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, qual string")
    variants = spark.createDataFrame([("S", "1", 100 * k + 10, "A", "T") for k in range(300)], "sample string, chrom string, pos long, ref string, alt string")
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = composites.classified_reads(reads, variants)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 300 and {r["class"] for r in found.collect()} == {"CLEAN_REFERENCE"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
    assert plan.count("Exchange hashpartitioning") == 2
