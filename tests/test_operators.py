"""Joins, rules, windows, evidence and quality on small tables against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.sequences import protein_position
from tallyloom.operators import aggregates, annotation, enrichment, evidence, joins, quality, reports, rules, sets, windows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width,pad", [(1, 0), (7, 0), (50, 3)])
def test_range_join(spark, width, pad):
    rng = random.Random(width)
    a = [(rng.choice("xy"), i, s := rng.randrange(100), s + rng.randrange(20)) for i in range(60)]
    b = [(rng.choice("xy"), i, s := rng.randrange(100), s + rng.randrange(20)) for i in range(60)] + [("x", 99, None, 3)]
    left, right = (spark.createDataFrame(r, "k string, i int, start long, end long") for r in (a, b))
    out = joins.range_join(left, right, ["k"], width, pad=pad)
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)
    got = sorted((r.l.i, r.r.i) for r in out.collect())
    assert got == sorted((i, j) for k, i, s, e in a for m, j, t, u in b if t is not None and k == m and s - pad <= u and t <= e + pad)
    inside = joins.range_join(left, right, ["k"], width, how="within")
    assert sorted((r.l.i, r.r.i) for r in inside.collect()) == sorted((i, j) for k, i, s, e in a for m, j, t, u in b if t is not None and k == m and s <= t and u <= e)


def test_pattern_join(spark):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 900)))) for i in range(8)] + [(50, None), (51, "")]
    patterns = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(3, 14)))) for i in range(12)] + [(90, None), (91, "")]
    p, t = spark.createDataFrame(patterns, "pattern_id int, pattern string"), spark.createDataFrame(texts, "text_id int, text string")
    want = [(i, j, k + 1) for i, x in patterns if x for j, y in texts if y for k in range(len(y)) if y.startswith(x, k)]
    out = joins.pattern_join(p, t, seed=5)
    assert "NestedLoop" not in plan(out)
    assert sorted(map(tuple, out.collect())) == sorted(want)
    first = {}
    for i, j, k in sorted(want):
        first.setdefault((i, j), k)
    assert {(r.pattern_id, r.text_id): r.position for r in joins.pattern_join(p, t, seed=5, first=True).collect()} == first


def test_prioritised_join(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (4, "c", "q")], "id int, g string, s string")
    right = spark.createDataFrame([("a", "x", 9), ("a", "w", 5), ("b", "v", 7), ("b", "u", 6)], "g string, s string, score int")
    out = joins.prioritised_join(left, right, [[("g", "g"), ("s", "s")], [("g", "g")]], ["id"], [F.desc("match.score")])
    assert {r.id: (r.attempt, r.match and r.match.score) for r in out.collect()} == {1: (0, 9), 2: (1, 9), 3: (1, 7), 4: (None, None)}


def test_closure_with_a_cycle(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "f")]
    got = {(r.node, r.ancestor) for r in joins.closure(spark.createDataFrame(edges, "child string, parent string")).collect()}
    assert got == {(x, y) for x in "abc" for y in "abc"} | {("d", x) for x in "abcd"} | {("e", "e"), ("e", "f"), ("f", "f")}


def test_split_anchor(spark):
    peptides = spark.createDataFrame([("AAAACCCC",), ("GGGGTTTT",), ("SHORT",)], "peptide string")
    proteins = spark.createDataFrame([(1, "xxAAAAxx"), (2, "yyCCCCyy"), (3, "GGGGTTTT")], "protein_id int, sequence string")
    assert [tuple(r) for r in joins.split_anchor(peptides, proteins).collect()] == [("AAAACCCC", 4, 1, 2)]


def test_name_match(spark):
    samples = spark.createDataFrame([("TK1",), ("TK12",)], "sample string")
    names = spark.createDataFrame([("run_TK12_a",), ("tk1-b",), ("none",)], "name string")
    assert {r.name: r.sample for r in joins.name_match(names, samples).collect()} == {"run_TK12_a": "TK12", "tk1-b": "TK1", "none": None}
    with pytest.raises(Exception, match="several samples"):
        joins.name_match(spark.createDataFrame([("TK1_TK12",)], "name string"), samples).collect()


def test_genome_slice(spark):
    genome = spark.createDataFrame([("1", 0, "ACGTA"), ("1", 1, "CCGGT"), ("chrX", 0, "ttttt")], "contig string, chunk_no long, seq string")
    df = spark.createDataFrame([("chr1", 4, 4), ("1", 1, 2), ("X", 2, 3), ("9", 1, 1)], "chrom string, pos long, length int")
    got = {(r.chrom, r.pos): r.genome_ref for r in joins.genome_slice(df, genome, 5).collect()}
    assert got == {("chr1", 4): "TACC", ("1", 1): "AC", ("X", 2): "TTT", ("9", 1): None}


def test_merge_intervals_is_idempotent(spark):
    rng = random.Random(5)
    rows = [(rng.choice("xy"), s := rng.randrange(200), s + rng.randrange(8)) for _ in range(80)]
    once = windows.merge_intervals(spark.createDataFrame(rows, "k string, start long, end long"), ["k"], 1)
    got = sorted((r.k, r.start, r.end) for r in once.collect())
    covered = {(k, x) for k, s, e in rows for x in range(s, e + 1)}
    assert {(k, x) for k, s, e in got for x in range(s, e + 1)} == covered
    assert all(a[0] != b[0] or b[1] > a[2] + 1 for a, b in zip(got, got[1:], strict=False))
    again = windows.merge_intervals(once.drop("n"), ["k"], 1)
    assert sorted((r.k, r.start, r.end) for r in again.collect()) == got


def test_peptide_event(spark):
    rows = [
        ("KTA", 1, "MKTAY", "MKSAY", "3", "S/T", "missense_variant", "VALIDATED_SUBSTITUTION"),
        ("KTA", 1, "MKTAY", "MKSAY", "3", "G/T", "missense_variant", "REFERENCE_RESIDUE_MISMATCH"),
        ("MK", 0, "MKTAY", "MKSAY", "3", "S/T", "missense_variant", "PEPTIDE_DOES_NOT_COVER_EVENT"),
        ("KTA", -1, "MKTAY", "MKSAY", "3", "S/T", "missense_variant", "PEPTIDE_NOT_FOUND"),
        ("KTA", 1, "MKTAY", "", "3", "S/T", "missense_variant", "REFERENCE_PROTEIN_UNAVAILABLE"),
        ("KGGT", 1, "MKGGTAY", "MKTAY", "2-3", "K/KGG", "inframe_insertion", "VALIDATED_INFRAME_INSERTION"),
        ("MKAY", 0, "MKAY", "MKTAY", "3", "T/-", "inframe_deletion", "VALIDATED_INFRAME_DELETION"),
        ("QQQ", 3, "MKTQQQ", "MKTAYV", "4", "A/X", "frameshift_variant", "VALIDATED_FRAMESHIFT_NOVEL_SEQUENCE"),
        ("QQ", 3, "MKTQQQ", "MKTQQ", "4", "A/X", "x", "PEPTIDE_DOES_NOT_COVER_EVENT"),
    ]
    df = spark.createDataFrame([(i, *r[:7]) for i, r in enumerate(rows)], "i int, peptide string, start int, alt_seq string, ref_seq string, pos string, aa string, term string")
    df = annotation.changed_spans(df)
    got = {r.i: r.s for r in df.select("i", rules.peptide_event(F.col("peptide"), F.col("start"), F.col("alt_seq"), F.col("ref_seq"), protein_position(F.col("pos")), F.col("aa"), F.col("term"), F.col("changes")).alias("s")).collect()}
    assert got == {i: r[7] for i, r in enumerate(rows)}


def test_design(spark):
    df = spark.createDataFrame([("G1", "A", True), ("G1", "B", False), ("G2", "C", False), ("G3", "D", True)], "subject string, sample string, baseline boolean")
    assert {r.subject: r.design for r in rules.design_status(df).collect()} == {"G1": "ENABLED", "G2": "SKIPPED_NO_BASELINE", "G3": "NO_NONBASELINE"}
    with pytest.raises(Exception, match="multiple baselines"):
        rules.design_status(df.withColumn("baseline", F.lit(True))).collect()


def test_findings_fixture(spark):
    rows = [
        ("SNV1", "SNV", "1", 10, "A", "T", None, None, "SUBSTITUTE A WITH T AT chr1:10"),
        ("INS1", "INSERTION", "1", 20, "A", "AG", None, None, "INSERT G AFTER chr1:20 A"),
        ("DEL1", "DELETION", "1", 30, "ATG", "A", None, None, "DELETE TG AFTER chr1:30 A"),
        ("SPL1", "SPLICE_JUNCTION", "2", 100, "", "", "2", 150, "SPLICE chr2:100 TO chr2:150"),
        ("FUS1", "FUSION", "3", 200, "", "", "4", 300, "FUSE chr3:200 TO chr4:300"),
    ]
    df = spark.createDataFrame([r[:8] for r in rows], "id string, kind string, chrom string, pos long, ref string, alt string, chrom2 string, pos2 long")
    c = [F.col(x) for x in ("kind", "chrom", "pos", "ref", "alt", "chrom2", "pos2")]
    got = {r.id: r for r in df.select("id", evidence.event_description(*c).alias("d"), evidence.event_geometry(*c[:4]).alias("g"), evidence.visual_status(F.col("kind"), F.lit("ALT_SUPPORTED"), F.lit(1)).alias("v")).collect()}
    assert {k: r.d for k, r in got.items()} == {r[0]: r[8] for r in rows}
    assert tuple(got["SNV1"].g) == ("1", 9, 10) and tuple(got["DEL1"].g) == ("1", 29, 32)
    assert got["SPL1"].v == got["FUS1"].v == "CONTEXT_ALIGNMENTS_AVAILABLE" and got["SNV1"].v == "ALT_SUPPORTED"


def test_baseline_partition_adds_up(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(9), rng.randrange(5), rng.random() < 0.5) for _ in range(120)]
    got = sets.baseline_partition(spark.createDataFrame(rows, "s int, a int, b boolean"), "s", ["a"], "b").collect()
    assert {(r.s, r.a): r.partition for r in got} == {
        (s, a): "shared" if len({b for t, c, b in rows if (t, c) == (s, a)}) == 2 else "baseline_only" if (s, a, True) in rows else "nonbaseline_only" for s, a, _ in rows
    }


def test_ora_by_key_matches_each_alone(spark):
    fore = spark.createDataFrame([("k1", 1), ("k1", 2), ("k1", 99), ("k2", 5)], "k string, gene int")
    universe = spark.createDataFrame([(i,) for i in range(1, 21)], "gene int")
    terms = spark.createDataFrame([(i, "t1") for i in range(1, 5)] + [(i, "t2") for i in range(4, 12)], "gene int, term string")
    both = {(r.k, r.term): (r.overlap, round(r.p, 9)) for r in enrichment.over_representation(fore, universe, terms, keys=["k"]).collect()}
    for k in ("k1", "k2"):
        alone = enrichment.over_representation(fore.filter(F.col("k") == k), universe, terms).collect()
        assert {(k, r.term): (r.overlap, round(r.p, 9)) for r in alone} == {x: y for x, y in both.items() if x[0] == k}
    assert both["k1", "t1"][0] == 2


def test_quality(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t2\n3\n")
    (tmp_path / "b.tsv").write_text("x\n1\n")
    got = {r.file.rsplit("/", 1)[-1]: (r.rows, r.bad_rows) for r in quality.rectangular(spark, str(tmp_path)).collect()}
    assert got == {"a.tsv": (2, 1), "b.tsv": (1, 0)}
    files = quality.inventory(spark, str(tmp_path))
    manifest = files.select("path", "sha256").union(spark.createDataFrame([("gone", "00")], "path string, sha256 string"))
    assert sorted(r.status for r in quality.verify_manifest(files, manifest).collect()) == ["MISSING", "OK", "OK"]
    assert {r.label: r.status for r in quality.artifact_contract(files, [("tables", r"\.tsv$", 2), ("maps", r"\.bam$", 1)]).collect()} == {"tables": "PASS", "maps": "FAIL"}
    with pytest.raises(ValueError):
        quality.require_columns(files, ["path", "nothing"])
    sheet = spark.createDataFrame([("A", "S1", "G", "true"), ("A", "S1", "G", "TRUE"), ("C", "", "H", "maybe")], "sample string, srr string, subject string, baseline string")
    assert {r.problem for r in quality.samplesheet_problems(sheet).collect()} == {"DUPLICATE_SAMPLE", "DUPLICATE_RUN", "BASELINE_NOT_TRUE_OR_FALSE", "MULTIPLE_BASELINES"}


def test_contract_and_ledger(spark):
    tasks = spark.createDataFrame([("A", 1, "COMPLETED", 0), ("A", 2, "FAILED", 1), ("B", 3, "CACHED", 0), ("B", 3, "CACHED", 0)], "process string, task_id int, status string, exit int")
    need = spark.createDataFrame([("A",), ("B",), ("C",)], "process string")
    assert {r.process: r.status for r in aggregates.process_contract(tasks, need).collect()} == {"A": "FAIL", "B": "PASS", "C": "FAIL"}
    assert [r.task_id for r in aggregates.failure_ledger(tasks).collect()] == [2]
    assert {(r.problem, r.value) for r in quality.trace_check(tasks).collect()} == {("BAD_STATUS", "FAILED"), ("DUPLICATE_TASK", "3")}


def test_range_join_of_a_hot_bin_and_long_intervals(spark, monkeypatch):
    """Nine tenths of the rows in one bin, and intervals of all lengths."""
    monkeypatch.setattr(joins, "BIN_ROWS", 50)
    rng = random.Random(4)
    a = [("x", i, s := 500 + rng.randrange(8), s + rng.randrange(3)) for i in range(900)] + [(rng.choice("xy"), 1000 + i, s := rng.randrange(2000), s + rng.choice([0, 5, 300, 1500])) for i in range(100)]
    b = [("x", i, s := 500 + rng.randrange(8), s) for i in range(30)] + [(rng.choice("xy"), 100 + i, s := rng.randrange(2000), s + rng.choice([0, 40, 1999])) for i in range(40)]
    left, right = (spark.createDataFrame(r, "k string, i int, start long, end long") for r in (a, b))
    out = joins.range_join(left, right, ["k"], 8, pad=1)
    got = sorted((r.l.i, r.r.i) for r in out.collect())
    assert got == sorted((i, j) for k, i, s, e in a for m, j, t, u in b if k == m and s - 1 <= u and t <= e + 1)
    # no key of the join holds more of a side's rows than twice a part
    hot = spark.createDataFrame([("x", 0, 62, 10, 1), ("x", 0, 63, 10, 1)], "_k string, _level int, _bin long, _parts_l int, _parts_r int")
    rows = left.select(F.struct("*").alias("l"), F.col("k").alias("_k"), F.lit(0).alias("_level"), F.floor(F.col("start") / 8).alias("_bin"))
    dealt = joins.split(rows, hot, ["_k", "_level", "_bin"], "l", "r").groupBy("_k", "_bin", "_part_l").count()
    assert dealt.agg(F.max("count")).first()[0] < 100


def test_ranges_of_values_over_300_powers_of_ten(spark):
    """No range holds over twice its share of p-values, and ranks and rates are those of a sort."""
    from tallyloom.functions import stats

    rng = random.Random(2)
    p = [10.0 ** -rng.uniform(0, 300) for _ in range(4000)] + [0.5] * 50 + [0.0, 1.0, None]
    df = spark.createDataFrame(list(enumerate(p)), "i int, p double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in stats.cumulated(df, "p").groupBy("_range").count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    held = sorted(x for x in p if x is not None)
    got = {r.i: (r.fdr, r["rank"]) for r in stats.tied_ranks(stats.bh_fdr(df, "p", []), "p", []).collect()}
    last = {x: k for k, x in enumerate(held, 1)}
    least, q = 1.0, {}
    for x in sorted(last, reverse=True):
        least = min(least, x * len(held) / last[x])
        q[x] = least
    first = {x: k for k, x in reversed(list(enumerate(held, 1)))}
    for i, x in enumerate(p):
        if x is None:
            assert got[i] == (None, None)
        else:
            assert got[i][0] == pytest.approx(q[x], rel=1e-12, abs=1e-300) and got[i][1] == (first[x] + last[x]) / 2


@pytest.mark.parametrize("bits", [1 << 27, 1 << 15])
def test_pattern_join_beyond_the_automaton(spark, monkeypatch, bits):
    monkeypatch.setattr(joins, "SEED_BITS", bits)
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdeé猫 ") for _ in range(n))
    texts = [(i, word(rng.randrange(0, 700))) for i in range(30)] + [(50, None), (51, ""), (52, "a" * 300), (53, "ab")]
    patterns = [(i, texts[i % 30][1][3 : 3 + rng.randrange(1, 30)]) for i in range(60)] + [(90, None), (91, ""), (92, "aaaaaaaaa"), (93, "ab"), (94, "é"), (95, texts[0][1][3:20] + "!")]
    p, t = spark.createDataFrame(patterns, "pattern_id int, pattern string"), spark.createDataFrame(texts, "text_id int, text string")
    want = sorted((i, j, k + 1) for i, x in patterns if x for j, y in texts if y for k in range(len(y)) if y.startswith(x, k))
    assert sorted(map(tuple, joins.pattern_join(p, t, automaton_letters=0).collect())) == want
    none = joins.pattern_join(p.filter("pattern_id < 0"), t, automaton_letters=-1)
    assert none.collect() == []


def test_seed_bitmap_lets_few_places_through(spark):
    """Of 200,000 places in the texts about those of true seeds go on, not one a letter."""
    rng = random.Random(1)
    texts = [(i, "".join(rng.choice("abcdefghijklmnop") for _ in range(2000))) for i in range(100)]
    patterns = [(i, texts[i][1][50:80]) for i in range(50)]
    out = joins.pattern_join(spark.createDataFrame(patterns, "pattern_id int, pattern string"), spark.createDataFrame(texts, "text_id int, text string"), automaton_letters=0)
    assert out.count() == 50
    places = out._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in places
    seeds = {x[:7] for _, x in patterns}
    known = {int(joins._hashes(x, 7)[0]) % (1 << 15) for x in seeds}
    through = sum(int(h) % (1 << 15) in known for _, text in texts for h in joins._hashes(text, 7))
    assert through < 600


def test_event_regions_and_their_rules(spark):
    findings = [
        ("SNV1", "rna_variant", "E0", "1", 10, "A", "T"),
        ("INS1", "rna_variant", "", "1", 20, "A", "AG"),
        ("DEL1", "rna_variant", None, "1", 30, "ATG", "A"),
        ("SPL1", "splice_junction;x", "J1;J1;J2;gone", "2", 100, "", ""),
        ("FUS1", "x;fusion", "F1", "3", 200, "", ""),
        ("FUS2", "fusion", "F2", "3", 200, "", ""),
        ("CTX1", "other", "J1", "3", 200, None, None),
        ("CTX2", None, None, None, None, None, None),
    ]
    events = [("J1", "2", 99, 150, "", None, None), ("J2", "2", 200, 250, None, None, None), ("F1", "3", 199, 200, "4", 299, 300), ("F2", "3", None, 200, "4", 299, 300)]
    f = spark.createDataFrame(findings, "event_id string, classes string, source_events string, chrom string, pos long, ref string, alt string")
    e = spark.createDataFrame(events, "event string, chrom string, start0 long, end0 long, chrom2 string, start2_0 long, end2 long")
    rows = evidence.event_regions(f, e)
    got = {r.event_id: (r.event_type, [tuple(x) for x in r.regions]) for r in rows.collect()}
    assert got == {
        "SNV1": ("SNV", [("1", 9, 10, "TARGET_ALLELE")]),
        "INS1": ("INSERTION", [("1", 19, 20, "TARGET_ALLELE")]),
        "DEL1": ("DELETION", [("1", 29, 32, "TARGET_ALLELE")]),
        "SPL1": ("SPLICE_JUNCTION", [("2", 99, 150, "JUNCTION"), ("2", 200, 250, "JUNCTION")]),
        "FUS1": ("FUSION", [("3", 199, 200, "BREAKPOINT_1"), ("4", 299, 300, "BREAKPOINT_2")]),
        "FUS2": ("FUSION", [("4", 299, 300, "BREAKPOINT_2")]),
        "CTX1": ("CONTEXT_EVENT", [("2", 99, 150, "BREAKPOINT_1")]),
        "CTX2": ("CONTEXT_EVENT", []),
    }
    stated = F.when(F.col("event_id") == "INS1", "SNV").otherwise(F.col("event_type"))
    rows = rows.withColumns({"stated_type": stated, "context": F.when(F.col("event_id") == "SPL1", 1), "visual_status": F.lit("NO_CONTEXT_ALIGNMENTS")})
    rows = rows.withColumn("regions", F.when(F.col("event_id") == "DEL1", F.transform("regions", lambda r: r.withField("end0", r["start0"]))).otherwise(F.col("regions")))
    breaches = {(r.event_id, r.violation) for r in quality.region_invariants(rows).collect()}
    assert breaches == {("INS1", "EVENT_TYPE"), ("DEL1", "INVALID_REGION"), ("SPL1", "VISUAL_STATUS"), ("FUS2", "FUSION_BREAKPOINTS"), ("CTX2", "NO_REGIONS")}


#: Findings and events, as event_regions takes them.
FINDING, EVENT = "event_id string, classes string, source_events string, chrom string, pos long, ref string, alt string", "event string, chrom string, start0 long, end0 long, chrom2 string, start2_0 long, end2 long"


def test_findings_share_lists_of_events(spark):
    """Each list meets the events once; what it gives is right for every kind, and doesn't depend on event_id."""
    findings = [("A", "fusion", "E2;E1;E2;gone"), ("B", "splice_junction", "E2;E1;E2;gone"), ("B", "other", "E2;E1;E2;gone"), (None, "other", "E1"), ("C", "rna_variant", "E1"), ("D", "fusion", None)]
    f = spark.createDataFrame([(*r, "1", 5, *(("A", "T") if r[1] == "rna_variant" else ("", ""))) for r in findings], FINDING)
    e = spark.createDataFrame([("E1", "2", 10, 20, "3", 30, 40), ("E2", "4", 50, 60, None, None, None)], EVENT)
    rows = evidence.event_regions(f, e)
    one, two, four = ("2", 10, 20), ("3", 30, 40, "BREAKPOINT_2"), ("4", 50, 60)
    found = ("E2", "E1", "E2")
    assert sorted(((r.event_id, r.event_type, tuple(tuple(x) for x in r.regions), tuple(r.found_events)) for r in rows.collect()), key=str) == sorted(
        [
            ("A", "FUSION", ((*four, "BREAKPOINT_1"), (*one, "BREAKPOINT_1"), two), found),
            ("B", "SPLICE_JUNCTION", ((*four, "JUNCTION"), (*one, "JUNCTION"), two), found),
            ("B", "CONTEXT_EVENT", ((*four, "BREAKPOINT_1"), (*one, "BREAKPOINT_1"), two), found),
            (None, "CONTEXT_EVENT", ((*one, "BREAKPOINT_1"), two), ("E1",)),
            ("C", "SNV", (("1", 4, 5, "TARGET_ALLELE"),), ("E1",)),
            ("D", "FUSION", (), ()),
        ],
        key=str,
    )
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    exploded = next(k for k, x in enumerate(plan) if "Generate posexplode" in x)
    assert "Aggregate [" in next(x for x in plan[exploded + 1 :] if "Project" not in x and "Filter" not in x)


def test_many_findings_of_one_list_are_split(spark):
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        k = F.col("id")
        f = spark.range(0, 40000, 1, 8).select(k.cast("string").alias("event_id"), F.lit("fusion").alias("classes"), F.when(k % 100 > 0, "E1;E2").otherwise(F.concat(F.lit("E"), k)).alias("source_events"), F.lit("1").alias("chrom"), k.alias("pos"), F.lit("").alias("ref"), F.lit("").alias("alt"))
        e = spark.createDataFrame([("E1", "2", 10, 20, "3", 30, 40), ("E2", "4", 50, 60, None, None, None), ("E100", "4", 50, 60, None, None, None)], EVENT)
        rows = evidence.event_regions(f, e)
        sizes = sorted(len(r.regions) for r in rows.collect())
        assert sizes == [0] * 399 + [1] + [3] * 39600
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def nodes(plan):
    """A physical plan's nodes, of one that doesn't adapt."""
    yield plan
    for k in range(plan.children().size()):
        yield from nodes(plan.children().apply(k))


def test_names_of_very_many_lists_arent_shuffled(spark):
    """Such names, known or not, leave the shuffle by name, and what a list gives stays the same."""
    still = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in still}
    try:
        for k, v in still.items():
            spark.conf.set(k, v)
        k = F.col("id")
        names = F.concat(F.lit("hot;E"), k, F.lit(";gone;hot"))
        f = spark.range(0, 3000, 1, 8).select(k.cast("string").alias("event_id"), F.lit("splice_junction").alias("classes"), names.alias("source_events"), F.lit("1").alias("chrom"), k.alias("pos"), F.lit("").alias("ref"), F.lit("").alias("alt"))
        e = spark.createDataFrame([("hot", "2", 10, 20, "3", 30, 40), ("E7", "4", 50, 60, None, None, None), ("E8", "4", None, 60, "5", 70, 80)], EVENT)
        hot, seven, eight = [("2", 10, 20, "JUNCTION"), ("3", 30, 40, "BREAKPOINT_2")], [("4", 50, 60, "JUNCTION")], [("5", 70, 80, "BREAKPOINT_2")]
        # hot is held 6,000 times, gone 3,000 times; one that is held just common times stays
        for common, shuffled in ((2000, 3000), (3000, 6000), (6000, 12000)):
            rows = evidence.event_regions(f, e, common)
            got = {r.event_id: ([tuple(x) for x in r.regions], r.found_events) for r in rows.collect()}
            assert len(got) == 3000
            assert got.pop("7") == (hot + seven, ["hot", "E7", "hot"])
            assert got.pop("8") == (hot + eight, ["hot", "E8", "hot"])
            assert all(x == (hot, ["hot", "hot"]) for x in got.values())
            by_name = [x for x in nodes(rows._jdf.queryExecution().executedPlan()) if x.nodeName() == "Exchange" and "hashpartitioning(event" in x.simpleString(100) and "_nth" in x.output().toString()]
            assert [x.metrics().apply("shuffleRecordsWritten").value() for x in by_name] == [shuffled]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_region_rules_hold_a_finding_against_its_own_list(spark):
    """Neither other findings of its event_id nor a missing one change a finding's breaches."""
    f = spark.createDataFrame([(i, c, s, "1", 5, "", "") for i, c, s in [("A", "fusion", "\u00c91;E2"), ("A", "splice_junction", "E2"), (None, "other", "E2"), ("B", "other", "gone")]], FINDING)
    e = spark.createDataFrame([("\u00c91", "2", 10, 20, "3", 30, 40), ("E2", "4", 50, 60, None, None, None)], EVENT)
    rows = evidence.event_regions(f, e).withColumns({"stated_type": F.col("event_type"), "context": F.lit(0), "visual_status": F.lit("NO_CONTEXT_ALIGNMENTS")})
    assert [tuple(r) for r in quality.region_invariants(rows).collect()] == [("B", "NO_REGIONS")]
    # the sort of a list's events has a shuffle of its own, whatever is broadcast
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(_list") == 1


def pileup(text, reference):
    """The counts, sign by sign."""
    found, k, reference = {}, 0, reference.upper()
    add = lambda x: found.__setitem__(x, found.get(x, 0) + 1)
    while k < len(text):
        c, k = text[k], k + 1
        if c == "^":
            k += 1
        elif c in ".,":
            add(reference)
        elif c.upper() in "ACGTN":
            add(c.upper())
        elif c in "+-":
            digits = ""
            while k < len(text) and text[k] in "0123456789":
                digits, k = digits + text[k], k + 1
            if digits:
                add(reference + c + text[k : k + int(digits)].upper())
                k += int(digits)
    return found


def test_pileup_counts(spark):
    from tallyloom.functions.cigar import pileup_counts

    rng = random.Random(7)
    texts = ["", None, ".,.+2ACg-1t*$^]A", "+3AC", "-", "+", "+0A", "^+2.", "..-12acgtacgtacgtA", "^", "+-1A", "+2^]A", "1234", "+1^A"]
    texts += ["".join(rng.choice(".,ACgtN^$*+-12") for _ in range(rng.randrange(40))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", pileup_counts(F.col("t"), F.lit("g")).alias("n")).collect()
    for r in rows:
        assert r.n == pileup(texts[r.i] or "", "g"), texts[r.i]


def test_split_parts_meet_texts_whole(spark, monkeypatch):
    """Peptides that share their first and last letters: parts go on where they stand, not wherever their first letters do."""
    kept = []
    wanted = joins._by_seeds

    def seen(patterns, texts, seed, sizes):
        kept.append((seed, sizes))
        return wanted(patterns, texts, seed, sizes)

    monkeypatch.setattr(joins, "_by_seeds", seen)
    rows = [("AAAA" + f"{k:04d}".translate(str.maketrans("0123456789", "CDEFGHKMNP")) + "WWWW") for k in range(50)]
    peptides = spark.createDataFrame([(x,) for x in rows], "peptide string")
    proteins = spark.createDataFrame([(f"L{k}", "M" + x[:8]) for k, x in enumerate(rows)] + [(f"R{k}", x[8:] + "K" + x[6:] * (k % 2)) for k, x in enumerate(rows)], "protein_id string, sequence string")
    got = {r.peptide: (r.split, r.left_protein, r.right_protein) for r in joins.split_anchor(peptides, proteins).collect()}
    texts = [(r.protein_id, r.sequence) for r in proteins.collect()]
    for x in rows:
        found = []
        for k in range(4, len(x) - 3):
            a, b = (sorted(i for i, t in texts if part in t)[:2] for part in (x[:k], x[k:]))
            found += [(-min(k, len(x) - k), k, i, j) for i in a for j in b if i != j]
        assert got.get(x) == (min(found)[1:] if found else None)
    assert kept and all(seed >= max(sizes) and len(sizes) == 5 for seed, sizes in kept)


def test_allele_read_counts_are_hashed(spark):
    rows = [(1, "q", 0, 5, "10M", "EXCLUDED"), (1, "q", 0, 5, "10M", "EXACT_ALT"), (1, "q", 0, 5, "10M", "CLEAN_REFERENCE"), (1, "q", 0, 6, "10M", "CLEAN_REFERENCE"), (2, "q", 0, 5, "10M", "EXCLUDED")]
    reads = spark.createDataFrame(rows, "event int, qname string, flag int, read_start int, cigar string, class string")
    n = reports.allele_read_counts(reads, ["event"])
    assert {r.event: (r.alt_reads, r.ref_reads, r.depth) for r in n.collect()} == {1: (1, 1, 2), 2: (0, 0, 0)}
    assert "SortAggregate" not in n._jdf.queryExecution().executedPlan().toString()
