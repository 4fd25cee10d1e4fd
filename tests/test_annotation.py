import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tallyloom.functions.sequences import allele_token, protein_position
from tallyloom.operators import annotation, rules


def test_changed_spans_and_statuses_of_several_blocks(spark):
    """Against a decision by hand over random pairs with up to four changes."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        ref = "".join(rng.choice("ACDEFGHIKL") for _ in range(rng.randrange(1, 40)))
        alt = list(ref)
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(alt) + 1)
            alt[at : at + rng.randrange(3)] = [rng.choice("ACDEFGHIKL") for _ in range(rng.randrange(3))]
        alt = "".join(alt) or "A"
        a = rng.randrange(len(alt))
        rows.append((i, alt[a : a + rng.randrange(1, 9)], a, alt, ref, rng.choice(["inframe_insertion", "frameshift_variant&x", "stop_lost", "x"])))
    df = annotation.changed_spans(spark.createDataFrame(rows, "i int, peptide string, start int, alt_seq string, ref_seq string, term string"))
    status = rules.peptide_event(*[F.col(c) for c in ("peptide", "start", "alt_seq", "ref_seq")], protein_position(F.lit("3")), F.lit("A/C"), F.col("term"), F.col("changes"))
    got = {r.i: r for r in df.select("i", "changes", status.alias("status")).collect()}
    said = {"inframe_insertion": "VALIDATED_INFRAME_INSERTION", "frameshift_variant&x": "VALIDATED_FRAMESHIFT_NOVEL_SEQUENCE", "stop_lost": "VALIDATED_STOP_LOSS_EXTENSION", "x": "UNSUPPORTED_EVENT_TYPE"}
    several = 0
    for i, peptide, start, alt, ref, term in rows:
        changes = [(j1, j2) for tag, _, _, j1, j2 in SequenceMatcher(None, ref, alt, False).get_opcodes() if tag != "equal"]
        assert [tuple(x) for x in got[i].changes or []] == changes
        end = start + len(peptide)
        touched = any((start < j2 and end > j1) if j1 < j2 else start < j1 < end for j1, j2 in changes)
        want = "PEPTIDE_DOES_NOT_COVER_EVENT" if not touched else "PEPTIDE_PRESENT_IN_REFERENCE" if peptide in ref else said[term]
        assert got[i].status == want
        several += len(changes) > 1 and not touched and changes[0][0] < start and end < changes[-1][1]
    assert several > 5  # unchanged peptides between two changes


def test_allele_token(spark):
    rows = [("S1|var_._chr1.100.A.AT_ENST01.3_2 more",), ("s|VAR__X.5.G.C_ENST7_0",), ("sp|P1|X",), ("S|var_broken",), (None,)]
    got = [r.v for r in spark.createDataFrame(rows, "h string").select(allele_token(F.col("h")).alias("v")).collect()]
    assert tuple(got[0]) == ("S1|var_._chr1.100.A.AT_ENST01.3_2", "S1", "1", 100, "A", "AT", "ENST01.3", "ENST01", "2")
    assert got[1].chrom == "X" and got[1].transcript_base == "ENST7" and got[1].product == "0"
    assert [r.sample for r in got[2:]] == [None] * 3 and got[3].token == "S|var_broken"


NOTE = "sample string, chrom string, pos long, ref string, alts string, allele string, feature string, protein_position string, hgvsp string, amino_acids string, consequence string, protein_id string"


def test_annotations_by_four_keys(spark):
    notes = [
        ("S1", "1", 10, "A", "T", "T", "E1.1", "", "", "", "own", ""),
        ("S1", "1", 10, "A", "T", "T", "E1", "3", "", "", "base", ""),
        ("S2", "1", 10, "A", "T", "T", "E1.1", "3", "p", "", "other", ""),
        ("S2", "1", 20, "A", "AT,ATT", "T", "E2.1", "4", "", "", "inserted", ""),
        ("S2", "1", 20, "A", "AT,ATT", "TT", "E2.1", "4", "", "", "inserted more", ""),
        ("S2", "1", 30, "AC", "A", "-", "E3.1", "4", "", "", "deleted", ""),
        ("S2", "1", 30, "AC", "G", "G", "E3.1", "4", "x", "y", "another", ""),
        ("S2", "1", 40, "A", "C", "C", "E4", None, None, None, "last", None),
    ]
    asked = [(1, "S1", "1", 10, "A", "T", "E1.1"), (2, "S3", "1", 20, "A", "ATT", "E2.1"), (3, "S3", "1", 30, "AC", "A", "E3.1"), (4, "S3", "1", 40, "A", "T", "E4.2"), (5, "S1", "1", 50, "A", "T", "E1"), (6, "S1", "1", 10, "A", "G", "E1.7")]
    out = annotation.annotated(spark.createDataFrame(asked, "k int, sample string, chrom string, pos long, ref string, alt string, transcript string"), spark.createDataFrame(notes, NOTE), "k")
    got = {r.k: (r.annotation and r.annotation.consequence, r.attempt, r.exact) for r in out.collect()}
    # a protein change of another sample is better than the sample's own annotation without one
    assert got == {1: ("other", 2, True), 2: ("inserted more", 2, True), 3: ("deleted", 2, True), 4: ("last", 3, False), 5: (None, None, None), 6: ("base", 1, False)}


def test_variant_peptides(spark):
    proteins = [("S1|var_._chr1.100.A.T_ENST1.2_0 x", "MKTAYLLK", "a.fa"), ("S1|var_._1.200.A.T_ENST2.1_0", "MKTAYKTAYV", "a.fa"), ("S2|var_._1.300.A.T_ENST3.1_0", "MKTAYL", "b.fa"), ("S2|var_._1.400.A.T_ENST4.1_0", "MMKTIL", "b.fa")]
    references = [("ENSP1.1 pep transcript:ENST1.2 x", "MKSAYLLK"), ("ENSP2.1 x", "MKSAYKSAYV"), ("ENSP4 transcript:ENST4", "MMKSLL")]
    notes = [
        ("S1", "1", 100, "A", "T", "T", "ENST1.2", "3/8", "p.S3T", "S/T", "missense_variant", ""),
        ("S9", "1", 200, "A", "T", "T", "ENST2", "3-8", "p", "SAYKS/TAYKT", "inframe_insertion", "ENSP2.7"),
        ("S2", "1", 400, "A", "T", "T", "ENST4.1", "4", "p", "S/T", "missense_variant", ""),
    ]
    names = [h.split()[0] for h, _, _ in proteins]
    candidates = [("kta", f" {names[0]} more; {names[1]};sp|P1|X;{names[0]} again"), ("QQ", names[0]), ("KTA", names[2]), ("KTA", "S9|var_gone"), ("LLK", names[0]), ("MKTLL", names[3]), (None, names[0]), ("X", None)]
    frames = spark.createDataFrame(candidates, "peptide string, headers string"), spark.createDataFrame(proteins, "header string, sequence string, file string"), spark.createDataFrame(notes, NOTE), spark.createDataFrame(references, "header string, sequence string")
    rows, unresolved = annotation.variant_peptides(*frames)
    got = {(r.peptide, r.pos): (r.status, r.occurrences, r.start, r.end, r.in_reference, r.spans_position) for r in rows.collect()}
    assert got == {
        ("KTA", 100): ("VALIDATED_SUBSTITUTION", 1, 2, 4, "no", "yes"),
        ("KTA", 200): ("AMBIGUOUS_MULTIPLE_OCCURRENCES", 2, 2, 4, "no", "yes"),
        ("QQ", 100): ("PEPTIDE_NOT_FOUND", 0, None, None, "no", "unknown"),
        ("LLK", 100): ("PEPTIDE_DOES_NOT_COVER_EVENT", 1, 6, 8, "yes", "no"),
        ("MKTLL", 400): ("PEPTIDE_NOT_FOUND", 0, None, None, "no", "unknown"),
    }
    assert {tuple(r) for r in unresolved.collect()} == {("KTA", names[2], "no matching annotation"), ("KTA", "S9|var_gone", "variant header not found")}
    rows, _ = annotation.variant_peptides(*frames, il_equivalent=True)
    one = rows.filter("peptide = 'MKTLL'").first()
    assert (one.status, one.match_mode, one.start, one.in_reference) == ("VALIDATED_SUBSTITUTION", "I/L-equivalent", 2, "no")
    assert [r.peptide for r in annotation.prioritised(rows).collect()] == ["KTA", "MKTLL"]


def test_variants_are_read_once(spark):
    from tallyloom.plans import registry

    for name, joins in (("variant_peptides", 4), ("unresolved_peptides", 1)):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan and plan.count("Join") <= joins  # 39 and 9 joins before
