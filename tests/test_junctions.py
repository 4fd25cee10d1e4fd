"""Peptides over junctions against small cases by hand."""

import random

import pytest

from tallyloom.operators import joins, junctions

CALLS = "sample string, gene1 string, gene2 string, " + ", ".join(f"{c} string" for c in junctions.CALL_ATTRIBUTES)


def found(spark, peptides, proteins, calls=(), **options):
    df = junctions.junction_peptides(
        spark.createDataFrame(list(peptides), "sequence string, pep double, score double, msms int, class_code string"),
        spark.createDataFrame(list(proteins), "role string, file string, header string, sequence string"),
        spark.createDataFrame(list(calls), CALLS),
        **options,
    )
    return {(r.sequence, r["class"]): r for r in df.collect()}


def test_junction_peptides(spark):
    proteins = [
        ("CANONICAL", "c", "P1 one", "XXAAAACCXX"),
        ("CANONICAL", "c", "P2 two", "YYDDDDEEYY"),
        ("CANONICAL", "c", "P3", "SHAREDPEP"),
        ("FUSION", "f", "s|FUSION|1.A(12)-B(3).2 d", "QAAAADDDDQAAAADDDD"),
        ("FUSION", "f", "t|FUSION|A", "SHAREDPEP"),
        ("FUSION", "f", "t|SPLICE|A", "AAAADDDD"),
        ("SPLICE", "g", "s|SPLICE|STRG.1.1.p1", "KKTTTTWWWW"),
        ("SPLICE", "g", "s|SPLICE|STRG.2.1.p1", None),
    ]
    calls = [("S", "A(5)", "B", "1:5", "2:6", "high", "", "in-frame", "3", "", "2"), ("S", "A", "B", "1:4", "", "low", "", "", "3", "1", ""), ("T", "A", "B", "9:9", "9:9", "high", "", "", "9", "9", "9")]
    peptides = [("aaaadddd", 0.0, 50.0, 2, "x"), ("SHAREDPEP", 0.0, 50.0, 2, "x"), ("TTTTWWWW", None, 50.0, 2, "x"), ("TTTTWWWW", 0.5, 50.0, 2, "y"), ("NOWHERE", 0.0, 50.0, 2, "x"), ("", 0.0, 1.0, 1, "x"), (None, 0.0, 1.0, 1, "x")]
    got = found(spark, peptides, proteins, calls)
    assert sorted(got) == [("AAAADDDD", "FUSION"), ("SHAREDPEP", "FUSION"), ("TTTTWWWW", "SPLICE")]
    a = got["AAAADDDD", "FUSION"]
    assert (a.novel_matches, a.positions, a.split, a.left_segment, a.right_segment, a.left_support, a.right_support) == (2, "s|FUSION|1.A(12)-B(3).2:2-9;s|FUSION|1.A(12)-B(3).2:11-18", 4, "AAAA", "DDDD", "P1 one", "P2 two")
    assert (a.gene1, a.gene2, a.breakpoint1, a.breakpoint2, a.confidence, a.support) == ("A", "B", "1:4;1:5", "2:6", "high;low", "split1=3;split2=1;discordant=2")
    assert a.candidate and a.inference == "split-anchor-supported" and a.class_code == "x"
    shared = got["SHAREDPEP", "FUSION"]
    assert (shared.inference, shared.canonical_matches, shared.candidate, shared.gene1, shared.gene2) == ("canonical-shared", 1, False, "A", "")
    few = found(spark, peptides[:1], proteins, calls, most_headers=1)["AAAADDDD", "FUSION"]
    assert (few.novel_matches, few.headers) == (2, "s|FUSION|1.A(12)-B(3).2 d")


def test_junction_peptides_repeat_and_empty(spark):
    rows = [("TTTTWWWW", None, 50.0, 2, "x"), ("TTTTWWWW", 0.5, 50.0, 2, "y")]
    proteins = [("SPLICE", "g", "s|SPLICE|STRG.1.1.p1", "KKTTTTWWWW")]
    schema = "sequence string, pep double, score double, msms int, k string"
    texts = "role string, file string, header string, sequence string"
    df = junctions.junction_peptides(spark.createDataFrame(rows, schema), spark.createDataFrame(proteins, texts), spark.createDataFrame([], CALLS))
    assert sorted((r.k, r.candidate, r.inference) for r in df.collect()) == [("x", True, "noncanonical-no-split-anchor"), ("y", False, "noncanonical-no-split-anchor")]
    assert junctions.junction_peptides(spark.createDataFrame([], schema), spark.createDataFrame([], texts), spark.createDataFrame([], CALLS)).collect() == []


def test_split_anchor_needs_two_proteins(spark):
    """One protein with both halves is none; repeated texts and ids make no difference."""
    peptides = spark.createDataFrame([("AAAACCCC",), ("GGGGTTTT",)], "peptide string")
    proteins = spark.createDataFrame([(1, "AAAAxCCCC"), (1, "AAAAxCCCC"), (2, "GGGGxTTTT"), (3, "GGGGxTTTT"), (4, "GGGG")], "protein_id int, sequence string")
    assert [tuple(r) for r in joins.split_anchor(peptides, proteins).collect()] == [("GGGGTTTT", 4, 2, 3)]


def test_splits_seek_only_what_several_proteins_hold(spark, monkeypatch):
    """Every part of every peptide was sought; an id that was null took one of a part's two places."""
    sought = []
    wanted = joins._by_seeds

    def seen(patterns, *rest):
        sought.extend(r.pattern for r in patterns.collect())
        return wanted(patterns, *rest)

    monkeypatch.setattr(joins, "_by_seeds", seen)
    code = lambda k: f"{k:04d}".translate(str.maketrans("0123456789", "CDEFGHKMNP"))
    rows = [f"AAAA{code(k)}{code(k)}WWWW" for k in range(40)]
    own = [(f"L{k}", x[:8]) for k, x in enumerate(rows)] + [(f"R{k}", x[8:]) for k, x in enumerate(rows)]
    peptides = spark.createDataFrame([(x,) for x in rows] + [("GGGGTTTT",)], "peptide string")
    proteins = spark.createDataFrame([*own, (None, "GGGG"), ("1", "GGGGxTTTT"), ("2", "GGGG")], "protein_id string, sequence string")
    got = {r.peptide: (r.split, r.left_protein, r.right_protein) for r in joins.split_anchor(peptides, proteins).collect()}
    assert got == {x: (8, f"L{k}", f"R{k}") for k, x in enumerate(rows)} | {"GGGGTTTT": (4, "2", "1")}
    assert sought == ["GGGG"]


@pytest.mark.parametrize("keys", [joins.START_KEYS, 0])
def test_splits_of_random_peptides(spark, monkeypatch, keys):
    monkeypatch.setattr(joins, "START_KEYS", keys)
    rng = random.Random(3)
    word = lambda least, most: "".join(rng.choice("ACD") for _ in range(rng.randint(least, most)))
    texts = [(rng.randrange(20), word(0, 14)) for _ in range(40)]
    rows = {word(4, 15) for _ in range(300)}
    out = joins.split_anchor(spark.createDataFrame([(x,) for x in rows], "peptide string"), spark.createDataFrame(texts, "protein_id int, sequence string"))
    want = set()
    for x in rows:
        sides = [(k, *({i for i, t in texts if part in t} for part in (x[:k], x[k:]))) for k in range(4, len(x) - 3)]
        found = [(-min(k, len(x) - k), k, i, j) for k, a, b in sides for i in a for j in b if i != j]
        want |= {(x, *min(found)[1:])} if found else set()
    assert set(map(tuple, out.collect())) == want and len(want) > 50


def test_peptides_that_begin_alike_are_sought_whole(spark, monkeypatch):
    """Beyond the automaton seeds of 7 letters met every text with such a beginning: rows grew with the square of the table."""
    monkeypatch.setattr(joins, "AUTOMATON_LETTERS", 0)
    seeds = []
    wanted = joins._by_seeds
    monkeypatch.setattr(joins, "_by_seeds", lambda patterns, texts, seed, sizes: (seeds.append((seed, sizes)), wanted(patterns, texts, seed, sizes))[1])
    rows = [(f"ALMONDAA{a}{b}CCCC", 0.0, 50.0, 2, "x") for a in "CDEFG" for b in "CDEFG"] + [("ALMONDAA" + "ACDEFGHK" * 5, 0.0, 50.0, 2, "x")]
    got = found(spark, rows, [("SPLICE", "g", f"s|SPLICE|STRG.{k}.1.p1", "K" + r[0]) for k, r in enumerate(rows)])
    assert {x[0] for x in got} == {r[0] for r in rows} and {r.positions for r in got.values()} == {f"s|SPLICE|STRG.{k}.1.p1:2-{1 + len(r[0])}" for k, r in enumerate(rows)}
    assert seeds[0] == (32, [14, 32])


PROTEINS, EXONS, LISTED = "file string, header string, sequence string", "sample string, transcript string, chrom string, strand string, start long, end long, gene_id string", "transcript string, chrom string, strand string, start long, end long"


def splice(spark, candidates, proteins, exons, listed=()):
    return junctions.splice_peptides(spark.createDataFrame(candidates, "sequence string, headers string, pep double, msms int"), spark.createDataFrame(proteins, PROTEINS), spark.createDataFrame(exons, EXONS), spark.createDataFrame(list(listed), LISTED), attributes=["gene_id"])


def test_splice_peptides(spark):
    # residues 1 to 10, a junction behind 12 bases of the frame (residue 4) and behind 20 (inside residue 7)
    exons = [("S", "STRG.1.1", "chr1", "+", 101, 112, "g"), ("S", "STRG.1.1", "chr1", "+", 201, 208, ""), ("S", "STRG.1.1", "chr1", "+", 301, 400, "g"), ("S", "STRG.1.1", "chr1", "+", 301, 400, "g")]
    # the same frame on the other strand, found by its second name
    exons += [("S", "STRG.2.1", "2", "-", 389, 400, "h"), ("S", "STRG.2.1", "2", "-", 101, 200, "h")]
    proteins = [("S.fa", "S|SPLICE|STRG.1.1.p1 x STRG.1.1:1-33(+)", "MAKDEFGHKN*"), ("S.fa", "s|SPLICE|odd.p2.p1 STRG.2.1:33-1(-)", "MAKDEFGHKN"), ("S.fa", "S|SPLICE|STRG.9.1.p1 STRG.9.1:1-33(+)", "MAKDEFGHKN"), ("S.fa", "S|SPLICE|bad", "MAKDEFGHKN"), ("S.fa", "S|SPLICE|STRG.2.1.p9 STRG.2.1:40-70(+)", "MAKDEFGHKN")]
    headers = "S|SPLICE|STRG.1.1.p1 x;S|SPLICE|odd.p2.p1;S|SPLICE|STRG.9.1.p1;S|SPLICE|bad;S|SPLICE|STRG.2.1.p9"
    out = splice(spark, [("akdefghk", headers, 0.1, 2), ("AK", headers[:24], None, None), ("ZZ", headers[:22], 0.0, 1), ("K", headers[:22], 0.0, 1), ("AK", None, 0.0, 1)], proteins, exons, [("E1", "1", "+", 90, 112), ("E1", "1", "+", 201, 220)])
    rows = {(r.sequence, r.protein_id, r.junction_no): r for r in out["detailed"].collect()}
    assert sorted(rows) == [("AK", "STRG.1.1.p1", 1), ("AK", "STRG.1.1.p1", 2), ("AKDEFGHK", "STRG.1.1.p1", 1), ("AKDEFGHK", "STRG.1.1.p1", 2), ("AKDEFGHK", "odd.p2.p1", 1)]
    a, b, c = rows["AKDEFGHK", "STRG.1.1.p1", 1], rows["AKDEFGHK", "STRG.1.1.p1", 2], rows["AKDEFGHK", "odd.p2.p1", 1]
    assert (a.junction, a.reference_status, a.anchor_left, a.anchor_right, a.boundary_type, a.support, a.orf_length_status, a.gene_id) == ("chr1:112-201(+)", "known", 3, 5, "between-codons", "supported", "consistent", "g")
    assert (b.junction, b.reference_status, b.anchor_left, b.anchor_right, b.boundary_type, b.aa_left, b.aa_right) == ("chr1:208-301(+)", "novel", 5, 2, "within-codon-phase-2", 7, 7)
    assert (c.junction, c.model, c.left_exon.start, c.orf_start) == ("2:200-389(-)", "STRG.2.1", 389, 1)
    assert {rows["AK", "STRG.1.1.p1", n].support for n in (1, 2)} == {"not-spanning"}
    assert [(r.sequence, r.junction) for r in out["prioritized"].collect()] == [("AKDEFGHK", "2:200-389(-)"), ("AKDEFGHK", "chr1:208-301(+)")]
    lost = sorted((r.sequence, r.header, r.reason) for r in out["unresolved"].collect())
    assert lost == sorted(
        [
            ("AK", "", "candidate row contains no splice FASTA header"),
            ("AKDEFGHK", "S|SPLICE|STRG.9.1.p1", "sample-specific transcript not found in supplied GTF"),
            ("AKDEFGHK", "S|SPLICE|bad", "header not found in supplied splice FASTAs"),
            ("AKDEFGHK", "S|SPLICE|STRG.2.1.p9", "ORF contains no internal exon boundary"),
            ("ZZ", "S|SPLICE|STRG.1.1.p1", "peptide not found in splice protein"),
            ("K", "S|SPLICE|STRG.1.1.p1", "peptide has multiple occurrences in splice protein"),
        ]
    )


def test_splice_peptides_errors_and_empty(spark):
    one = [("MAK", "S|SPLICE|STRG.1.1.p1", 0.0, 1)]
    protein = "S|SPLICE|STRG.1.1.p1 STRG.1.1:1-9(+)"
    with pytest.raises(Exception, match="protein of sample S in file T.fa"):
        splice(spark, one, [("T.fa", protein, "MAK")], [])["unresolved"].collect()
    with pytest.raises(Exception, match="conflicting transcript model"):
        splice(spark, one, [("S.fa", protein, "MAK")], [("S", "STRG.1.1", c, "+", 1, 9, "") for c in "12"])["detailed"].collect()
    out = splice(spark, [], [], [])
    assert all(df.collect() == [] for df in out.values())


def test_variant_sets_without_genes(spark):
    """A single follow-up has all three analyses alike; samples without genes and subjects without follow-ups have none; an empty analysis stays."""
    from tallyloom.operators import enrichment

    genes = spark.createDataFrame([("a", "g1"), ("a", "g1"), ("a", "gx"), ("b", "g1"), ("c", "g2"), ("z", "g3")], "sample string, gene string")
    samples = spark.createDataFrame([("S", "a", False), ("T", "b", False), ("T", "c", False), ("T", "none", False), ("U", "z", True)], "subject string, sample string, baseline boolean")
    universe = spark.createDataFrame([("g1",), ("g2",), ("g3",), ("alone",)], "gene string")
    sets = spark.createDataFrame([("g1", "t"), ("g2", "t"), ("g3", "w"), ("gx", "w")], "gene string, term string")
    rows, summary = enrichment.variant_set_tests(genes, samples, universe, sets, smallest=1)
    got = {(r.subject, r.analysis): (r.members, r.foreground, r.background, r.terms) for r in summary.collect()}
    assert got == {("S", "common_all_progression"): ("a", 1, 3, 2), ("S", "a_all"): ("a", 1, 3, 2), ("S", "a_exclusive"): ("a", 1, 3, 2), ("T", "common_all_progression"): ("b,c", 0, 3, 2), ("T", "b_all"): ("b", 1, 3, 2), ("T", "b_exclusive"): ("b", 1, 3, 2), ("T", "c_all"): ("c", 1, 3, 2), ("T", "c_exclusive"): ("c", 1, 3, 2)}
    p = {(r.analysis, r.term): round(r.p, 6) for r in rows.filter("subject = 'T'").collect()}
    assert p["common_all_progression", "t"] == p["common_all_progression", "w"] == 1 and p["b_all", "t"] == 0.666667


def test_splice_queries_read_proteins_and_flags_once(spark):
    from tallyloom.plans import registry

    for name in ("splice_peptides", "splice_peptides_unresolved"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan and plan.count("Window") <= 4  # 30 times and 10 windows before
