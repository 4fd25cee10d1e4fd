"""More operators and the composite jobs on the driver's tables, each with SQL.

Line items stand for variants, reads and peptide matches, orders for events,
parts for genes and transcripts, documents for sequences.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import alleles, cigar, sequences, units
from tallyloom.operators import aggregates, evidence, joins, quality, reports, rules, sets, windows
from tallyloom.plans import composites
from tallyloom.plans.queries import _CALLERS, _FOLD, _TASKS, _VARIANTS, _reads, _tasks, _variants, query, rounded, table


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _c(name):
    return F.col(name)


def _joined(df, *columns):
    return df.withColumns({c: F.array_join(c, ";") for c in columns})


# --- rules --------------------------------------------------------------------


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_discount / 5 END AS pep, l_extendedprice / 500 AS score, l_linenumber AS msms, repeat('A', (l_quantity::INT) % 12 + 3) AS s, l_returnflag <> 'R' AS absent FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(pep <= 0.01, false) AND score >= 40 AND msms >= 2 AND length(s) >= 8 AND absent AS kept, coalesce(pep <= 0.01, true) AND score >= 40 AND msms >= 2 AND length(s) >= 8 AND absent AS kept_zero FROM x
""")
def high_confidence_peptides(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(_c("l_partkey") % 4 != 0, _c("l_discount") / 5).alias("pep"), (_c("l_extendedprice") / 500).alias("score"), F.repeat(F.lit("A"), (_c("l_quantity").cast("int") % 12 + 3)).alias("s"), (_c("l_returnflag") != "R").alias("absent"))
    fields = [_c(c) for c in ("pep", "score", "l_linenumber", "s", "absent")]
    return x.select("l_orderkey", "l_linenumber", rules.high_confidence_peptide(*fields).alias("kept"), rules.high_confidence_peptide(*fields, missing_pep_as_zero=True).alias("kept_zero"))


@query("""
WITH g AS (SELECT l_partkey, list_sort(list(DISTINCT 's' || (l_suppkey % 5)) FILTER (l_returnflag = 'N')) AS rna, list_sort(list(DISTINCT 's' || (l_suppkey % 5)) FILTER (l_returnflag = 'A')) AS direct, list_sort(list(DISTINCT 's' || (l_suppkey % 5)) FILTER (l_returnflag = 'R')) AS tr FROM lineitem GROUP BY 1),
h AS (SELECT l_partkey, coalesce(rna, []) AS rna, coalesce(direct, []) AS direct, coalesce(tr, []) AS tr FROM g)
SELECT l_partkey, array_to_string(list_filter(rna, lambda s: list_contains(direct, s)), ';') AS rna_and_direct, array_to_string(list_filter(direct, lambda s: NOT list_contains(rna, s)), ';') AS direct_only, array_to_string(list_filter(tr, lambda s: NOT list_contains(direct, s)), ';') AS transferred_only,
  array_to_string(list_filter(rna, lambda s: NOT list_contains(direct, s) AND NOT list_contains(tr, s)), ';') AS rna_only, len(list_filter(rna, lambda s: list_contains(direct, s))) > 0 AND len(list_filter(direct, lambda s: NOT list_contains(rna, s))) = 0 AS sample_specific FROM h
""")
def evidence_classes(spark, sf_dir):
    sample = _text("s", _c("l_suppkey") % 5)
    g = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(*[F.array_sort(F.collect_set(F.when(_c("l_returnflag") == f, sample))).alias(n) for f, n in (("N", "rna"), ("A", "direct"), ("R", "tr"))])
    out = g.select("l_partkey", rules.evidence_classes(_c("rna"), _c("direct"), _c("tr")).alias("e")).select("l_partkey", "e.*")
    return _joined(out, "rna_and_direct", "direct_only", "transferred_only", "rna_only")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 20 AND l_discount <= 0.05 AND l_extendedprice >= 1000")
def user_filters(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return rules.user_filters(li, {"l_quantity": (">=", 20), "l_discount": ("<=", 0.05), "l_extendedprice": (">=", 1000)}).select("l_orderkey", "l_linenumber")


@query("WITH k AS (SELECT unnest([{'h': 'metal', 'ks': ['steel', 'brass', 'tin']}, {'h': 'finish', 'ks': ['polished', 'plated']}]) AS k), x AS (SELECT p_partkey, k.h AS hypothesis, list_filter(k.ks, lambda w: contains(lower(p_type), w)) AS keywords, p_size / 100 <= 0.1 AS significant FROM part, k) SELECT p_partkey, hypothesis, array_to_string(keywords, ';') AS keywords, significant FROM x WHERE len(keywords) > 0")
def keyword_match(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", (_c("p_size") / 100).alias("fdr"))
    out = rules.keyword_match(p, {"metal": ["steel", "brass", "tin"], "finish": ["Polished", "plated"]}, "p_type")
    return _joined(out.withColumn("keywords", F.transform("keywords", F.lower)), "keywords").select("p_partkey", "hypothesis", "keywords", "significant")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 0 THEN 'COMPLEX_ALLELE_NOT_COUNTED' WHEN l_suppkey % 7 < 3 THEN 'ALT_READS_BELOW_MINIMUM' WHEN l_discount < 0.05 THEN 'ALT_FRACTION_BELOW_MINIMUM' ELSE 'ALT_READS_VALIDATED' END AS status FROM lineitem")
def read_status(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rules.read_status(_c("l_linenumber") % 4 != 0, _c("l_suppkey") % 7, _c("l_discount").cast("double")).alias("status"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN 'GENOME_REF_MISMATCH' ELSE 'GENOME_REF_VALIDATED' END AS g, CASE WHEN l_suppkey % 3 = 0 THEN 'ALT_READS_BELOW_MINIMUM' ELSE 'ALT_READS_VALIDATED' END AS r, CASE WHEN l_linenumber % 6 = 0 THEN 'CODON_TRANSLATION_MISMATCH' ELSE 'CODON_TRANSLATION_MATCH' END AS c, l_linenumber % 2 = 1 AS e FROM lineitem),
y AS (SELECT *, list_filter([CASE WHEN g <> 'GENOME_REF_VALIDATED' THEN g END, CASE WHEN r <> 'ALT_READS_VALIDATED' THEN r END, CASE WHEN c = 'CODON_TRANSLATION_MISMATCH' THEN c END], lambda v: v IS NOT NULL) AS codes FROM x)
SELECT l_orderkey, l_linenumber, array_to_string(codes, ';') AS codes, codes[1] AS primary_failure, CASE WHEN len(codes) > 0 THEN 'VALIDATION_FAILED' WHEN e THEN 'VARIANT_CODON_VALIDATED' ELSE 'VARIANT_EVIDENCE_PARTIAL' END AS overall_status FROM y
""")
def variant_evidence_status(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(_c("l_partkey") % 5 == 0, "GENOME_REF_MISMATCH").otherwise("GENOME_REF_VALIDATED").alias("genome_status"),
        F.when(_c("l_suppkey") % 3 == 0, "ALT_READS_BELOW_MINIMUM").otherwise("ALT_READS_VALIDATED").alias("read_status"),
        F.when(_c("l_linenumber") % 6 == 0, "CODON_TRANSLATION_MISMATCH").otherwise("CODON_TRANSLATION_MATCH").alias("codon_status"),
        (_c("l_linenumber") % 2 == 1).alias("codon_eligible"),
    )
    return rules.variant_evidence(x).select("l_orderkey", "l_linenumber", F.array_join("failure_codes", ";").alias("codes"), "primary_failure", "overall_status")


@query("WITH x AS (SELECT o_orderkey, o_custkey % 3 = 0 AS structural, o_orderkey % 4 AS context FROM orders) SELECT o_orderkey, CASE WHEN structural AND context > 0 THEN 'CONTEXT_ALIGNMENTS_AVAILABLE' WHEN structural THEN 'NO_CONTEXT_ALIGNMENTS' ELSE 'ALT_SUPPORTED' END AS status FROM x")
def visual_status(spark, sf_dir):
    kind = F.when(_c("o_custkey") % 3 == 0, "FUSION").otherwise("SNV")
    return table(spark, sf_dir, "orders").select("o_orderkey", evidence.visual_status(kind, F.lit("ALT_SUPPORTED"), _c("o_orderkey") % 4).alias("status"))


@query("SELECT l_partkey, max(CASE WHEN l_quantity >= 2 AND l_extendedprice >= 2000 THEN 1 ELSE 0 END) = 1 AS expressed FROM lineitem GROUP BY 1")
def gene_expressed(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.bool_or(rules.gene_expressed(_c("l_quantity"), _c("l_extendedprice"), 2, 2000)).alias("expressed"))


_TERMS = "['missense_variant', 'stop_gained&splice_region_variant', 'synonymous_variant', 'intron_variant', 'frameshift_variant', 'protein_altering_variant', 'x']"
_TERM_LIST = ("missense_variant", "stop_gained&splice_region_variant", "synonymous_variant", "intron_variant", "frameshift_variant", "protein_altering_variant", "x")


def _term(number):
    return F.get(F.array(*[F.lit(x) for x in _TERM_LIST]), (number % 7).cast("int"))


@query(f"SELECT p_partkey, {_TERMS}[p_partkey % 7 + 1] IN ('missense_variant', 'stop_gained&splice_region_variant', 'frameshift_variant', 'protein_altering_variant') AS altering, {_TERMS}[p_partkey % 7 + 1] IN ('missense_variant', 'stop_gained&splice_region_variant', 'frameshift_variant') AS rna_altering FROM part")
def protein_altering(spark, sf_dir):
    t = _term(_c("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", rules.protein_altering(t).alias("altering"), rules.protein_altering(t, rules.RNA_ALTERING).alias("rna_altering"))


@query(f"""
WITH x AS (SELECT l_partkey AS allele, l_suppkey % 3 AS gene, l_orderkey, l_linenumber, ['MODIFIER', 'LOW', 'MODERATE', 'HIGH', 'odd'][l_orderkey % 5 + 1] AS impact, {_TERMS}[l_linenumber % 7 + 1] AS consequence, l_returnflag = 'A' AS canonical, l_linestatus = 'O' AS coding FROM lineitem),
r AS (SELECT *, CASE impact WHEN 'LOW' THEN 1 WHEN 'MODERATE' THEN 2 WHEN 'HIGH' THEN 3 ELSE 0 END AS ir, CASE consequence WHEN 'missense_variant' THEN 70 WHEN 'stop_gained&splice_region_variant' THEN 90 WHEN 'synonymous_variant' THEN 30 WHEN 'frameshift_variant' THEN 90 WHEN 'protein_altering_variant' THEN 65 ELSE 0 END AS cr FROM x),
b AS (SELECT *, row_number() OVER (PARTITION BY allele, gene ORDER BY ir DESC, cr DESC, canonical DESC, coding DESC, l_orderkey, l_linenumber) AS n FROM r)
SELECT allele, gene, l_orderkey, l_linenumber, impact, consequence FROM b WHERE n = 1
""")
def best_consequence(spark, sf_dir):
    impact = F.get(F.array(*[F.lit(x) for x in ("MODIFIER", "LOW", "MODERATE", "HIGH", "odd")]), (_c("l_orderkey") % 5).cast("int"))
    x = table(spark, sf_dir, "lineitem").select(
        _c("l_partkey").alias("allele"), (_c("l_suppkey") % 3).alias("gene"), "l_orderkey", "l_linenumber", impact.alias("impact"), _term(_c("l_linenumber")).alias("consequence"), F.when(_c("l_returnflag") == "A", "YES").alias("canonical"), F.when(_c("l_linestatus") == "O", "protein_coding").otherwise("lncRNA").alias("biotype")
    )
    return windows.best_by(x, ["allele", "gene"], [*reports.annotation_order(), "l_orderkey", "l_linenumber"]).select("allele", "gene", "l_orderkey", "l_linenumber", "impact", "consequence")


# --- functions ------------------------------------------------------------------


@query(r"""
SELECT p_partkey, upper(regexp_replace(p_name || '12', '[^A-Za-z]', '', 'g')) AS letters, translate(upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')), 'IL', 'JJ') AS merged, regexp_replace(upper(regexp_replace(p_type || '**', '[^A-Za-z*]', '', 'g')), '\*+$', '') AS amino,
  split_part('ENST' || p_partkey || '.' || p_size, '.', 1) AS plain, CASE WHEN p_partkey % 3 = 0 THEN 'MT' ELSE (p_size % 22)::VARCHAR END AS chrom,
  regexp_replace('run_' || p_partkey || '.raw', '\.[^.]*$', '') AS raw_name, least(50.0, -log10(greatest(p_size / 1e4, 1e-50)))::DECIMAL(12, 6)::DOUBLE AS neg_log, p_size % 2 = 0 AS truth, left(sha256(upper(p_name)), 24) AS digest
FROM part
""")
def text_functions(spark, sf_dir):
    k, size, name = _c("p_partkey"), _c("p_size"), _c("p_name")
    chrom = F.when(k % 3 == 0, "chrM").otherwise(_text("chr", size % 22))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        sequences.normalize_sequence(F.concat(name, F.lit("12"))).alias("letters"),
        sequences.normalize_sequence(name, True).alias("merged"),
        sequences.norm_amino_acids(F.concat("p_type", F.lit("**"))).alias("amino"),
        sequences.strip_version(_text("ENST", k, ".", size)).alias("plain"),
        alleles.norm_chrom(chrom).alias("chrom"),
        units.raw_file_name(_text("D:\\data\\run_", k, ".raw")).alias("raw_name"),
        F.round(units.neg_log10(size / 1e4), 6).alias("neg_log"),
        units.strict_bool(F.when(size % 2 == 0, "Yes").otherwise("off")).alias("truth"),
        sequences.sequence_hash(name).alias("digest"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_size * 41 < 1024 THEN printf('%.1f B', (p_size * 41)::DOUBLE) ELSE printf('%.1f KiB', p_size * 41 / 1024.0) END AS size, array_to_string(list_sort(list_distinct(list_filter([p_brand, p_type, '', p_brand], lambda x: x <> ''))), ';') AS joined,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size::VARCHAR END AS known, 'A=' || p_size || ';B=' || CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS observed, p_size % 30 + 1 AS first, CASE WHEN p_size % 2 = 0 THEN p_size % 30 + 3 ELSE p_size % 30 + 1 END AS last FROM part
""")
def value_functions(spark, sf_dir):
    size, k = _c("p_size"), _c("p_partkey")
    first = size % 30 + 1
    position = F.when(size % 2 == 0, _text(first, "-", first + 2, "/300")).otherwise(_text(first, "/300"))
    a, b = sequences.protein_position(position)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        units.human_size(size * 41).alias("size"),
        units.sorted_join(F.array("p_brand", _text(" ", _c("p_type"), " "), F.lit(""), "p_brand")).alias("joined"),
        units.missing_to_null(F.when(k % 3 == 0, " n/a ").otherwise(size.cast("string"))).alias("known"),
        units.observed(A=size, B=F.when(k % 2 == 0, _c("p_brand"))).alias("observed"),
        a.alias("first"),
        b.alias("last"),
    )


@query("""
WITH x AS (SELECT p_partkey, ['0/1', '1|1', './1', '1/2', '2/2'][p_partkey % 5 + 1] AS gt, unnest([1, 2]) AS i FROM part WHERE p_size > 0)
SELECT p_partkey, i AS allele_index, CASE WHEN contains(gt, '.') THEN NULL ELSE len(list_filter(string_split_regex(gt, '[/|]'), lambda g: g = i::VARCHAR))::INTEGER END AS dosage, CASE i WHEN 1 THEN 'A' ELSE 'TG' END AS alt FROM x
""")
def split_alleles(spark, sf_dir):
    gts = F.array(*[F.lit(x) for x in ("0/1", "1|1", "./1", "1/2", "2/2")])
    v = table(spark, sf_dir, "part").select("p_partkey", F.get(gts, (_c("p_partkey") % 5).cast("int")).alias("gt"), F.lit("A,TG,*").alias("alt"))
    return alleles.split_multiallelic(v).select("p_partkey", "allele_index", alleles.alt_dosage(_c("gt"), _c("allele_index")).alias("dosage"), "alt")


@query("WITH x AS (SELECT p_partkey, upper(p_brand) AS s, 'chr' || (p_size % 22) AS c FROM part) SELECT p_partkey, s AS sample, c AS chrom, p_partkey * 7 AS pos, 'A' AS ref, 'TG' AS alt, CASE WHEN p_partkey % 2 = 0 THEN 'ENST' || p_partkey ELSE '' END AS transcript FROM x JOIN part USING (p_partkey)")
def variant_headers(spark, sf_dir):
    k = _c("p_partkey")
    h = F.concat(_c("p_brand"), F.lit("|VARIANT|p1 VAR_chr"), (_c("p_size") % 22).cast("string"), _text(":", k * 7, ":A:TG"), F.when(k % 2 == 0, _text(":ENST", k)).otherwise(""))
    out = table(spark, sf_dir, "part").select("p_partkey", sequences.variant_header(h).alias("h")).select("p_partkey", "h.*")
    return out.select("p_partkey", "sample", "chrom", _c("pos").cast("long").alias("pos"), "ref", "alt", F.coalesce("transcript", F.lit("")).alias("transcript"))


# --- sets -----------------------------------------------------------------------


@query("WITH a AS (SELECT l_partkey, l_suppkey, min(l_tax) AS tax FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), b AS (SELECT l_partkey, l_suppkey, min(l_tax) AS tax FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, coalesce(a.tax, b.tax) AS l_tax, CASE WHEN a.tax IS NOT NULL AND b.tax IS NOT NULL THEN 'shared' WHEN a.tax IS NOT NULL THEN 'A_only' ELSE 'B_only' END AS contrast FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey")
def contrast_attributes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_tax", "l_returnflag")
    return sets.contrast(li.filter("l_returnflag = 'A'"), li.filter("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"], attributes=["l_tax"])


@query("WITH a AS (SELECT p_type AS term, avg(p_retailprice) AS o FROM part WHERE p_size < 25 GROUP BY 1), b AS (SELECT p_type AS term, avg(p_retailprice) AS o FROM part WHERE p_size >= 25 GROUP BY 1) SELECT term, round(a.o, 6) AS left_odds, round(b.o, 6) AS right_odds, round(log2(a.o / b.o), 6) AS log2_ratio, CASE WHEN log2(a.o / b.o) > 0 THEN 'left' WHEN log2(a.o / b.o) < 0 THEN 'right' ELSE 'equal' END AS larger FROM a JOIN b USING (term)")
def odds_contrast(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    a, b = (p.filter(f"p_size {c} 25").groupBy(_c("p_type").alias("term")).agg(F.avg("p_retailprice").alias("odds")) for c in ("<", ">="))
    return rounded(sets.odds_contrast(a, b), "left_odds", "right_odds", "log2_ratio")


@query("SELECT l_orderkey, l_linenumber, l_tax, NULL::DOUBLE AS l_discount FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT l_orderkey, l_linenumber, NULL, l_discount FROM lineitem WHERE l_returnflag = 'R'")
def union_loose(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return sets.union_loose(li.filter("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", "l_tax"), li.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_discount"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def union_strict(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return sets.union_strict(li.filter("l_returnflag = 'A'"), li.filter("l_returnflag = 'R'")).select("l_orderkey", "l_linenumber")


@query("SELECT text AS sequence, doc_id AS row_no FROM (SELECT text, doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents WHERE length(text) >= 20) WHERE n = 1")
def distinct_sequences(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(_c("text").alias("sequence"), F.lit(0).alias("source_no"), _c("doc_id").alias("row_no"))
    return sets.distinct_sequences(d, 20).select("sequence", "row_no")


# --- windows --------------------------------------------------------------------


@query("""
WITH x AS (SELECT l_partkey, l_suppkey, min(l_linenumber) AS f, count_if(l_returnflag = 'A') AS n, min(l_linenumber) FILTER (l_returnflag = 'A') AS v FROM lineitem GROUP BY ALL)
SELECT l_partkey, l_suppkey, n::BIGINT AS n_valid, CASE WHEN n > 1 THEN 'AMBIGUOUS' WHEN n = 1 THEN 'VALIDATED' ELSE 'FIRST' END AS choice, CASE WHEN n = 1 THEN v WHEN n = 0 THEN f END AS start FROM x
""")
def occurrence_choice(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", _c("l_linenumber").alias("start"), (_c("l_returnflag") == "A").alias("validated"))
    return windows.occurrence_choice(li, ["l_partkey", "l_suppkey"])


@query("""
WITH x AS (SELECT l_partkey AS event, l_returnflag AS class, 's' || l_suppkey AS source, l_quantity AS q, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS r FROM lineitem),
b AS (SELECT event, min(q) AS q FROM (SELECT *, rank() OVER (PARTITION BY event ORDER BY r, source) AS n FROM x) WHERE n = 1 GROUP BY 1)
SELECT x.event, any_value(b.q) AS quantity, array_to_string(list_sort(list(DISTINCT class)), ';') AS classes, array_to_string(list_sort(list(DISTINCT source)), ';') AS sources FROM x JOIN b ON b.event = x.event GROUP BY 1
""")
def consolidate(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").groupBy(_c("l_partkey").alias("event"), _c("l_returnflag").alias("class"), _text("s", _c("l_suppkey")).alias("source")).agg(F.min("l_quantity").alias("quantity"))
    return _joined(windows.consolidate(x, "event", ["R", "A"]), "classes", "sources").select("event", "quantity", "classes", "sources")


@query("""
WITH j AS (SELECT l_orderkey AS t, l_linenumber AS junction_no, l_linenumber * 9 + l_partkey % 3 AS o FROM lineitem), h AS (SELECT o_orderkey AS t, o_custkey % 5 + 1 AS orf, repeat('M', (o_custkey % 9 + 4)::INT) AS peptide, o_orderkey % 6 + 1 AS start FROM orders),
x AS (SELECT h.t, junction_no, peptide, start, o - orf + 1 AS c FROM h JOIN j USING (t)), y AS (SELECT *, ((c % 3) + 3) % 3 AS phase, floor(c / 3)::BIGINT - (start - 1) AS l FROM x),
z AS (SELECT *, length(peptide) - l - (CASE WHEN phase > 0 THEN 1 ELSE 0 END) AS r FROM y)
SELECT t AS transcript, junction_no, start, phase, l AS "left", r AS "right", least(l, r) >= 2 AS spanning FROM z WHERE l >= 0 AND r >= 0
""")
def junction_phase(spark, sf_dir):
    j = table(spark, sf_dir, "lineitem").select(_c("l_orderkey").alias("transcript"), _c("l_linenumber").alias("junction_no"), (_c("l_linenumber") * 9 + _c("l_partkey") % 3).alias("offset"))
    h = table(spark, sf_dir, "orders").select(_c("o_orderkey").alias("transcript"), (_c("o_custkey") % 5 + 1).alias("orf_start"), F.repeat(F.lit("M"), (_c("o_custkey") % 9 + 4).cast("int")).alias("peptide"), (_c("o_orderkey") % 6 + 1).alias("start"))
    return windows.junction_phase(j, h).select("transcript", "junction_no", "start", "phase", "left", "right", "spanning")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def last_rows(spark, sf_dir):
    return composites.last_rows(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT p_size, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_size LIMIT 15")
def most_common(spark, sf_dir):
    return reports.most_common(table(spark, sf_dir, "part"), "p_size", 15)


@query("SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 1000")
def first_n(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return reports.first_n(li, ["l_shipdate", "l_orderkey", "l_linenumber"], 1000).select("l_orderkey", "l_linenumber")


@query("""
WITH f AS (SELECT o_orderkey AS event, ['LOW', 'HIGH', 'MODERATE', '?'][o_orderkey % 4 + 1] AS impact, o_custkey % 3 = 0 AS structural, o_orderkey % 5 AS context, o_custkey % 7 AS alt, CASE WHEN o_custkey % 2 = 0 THEN (o_custkey % 10) / 10 END AS fr, o_orderkey % 9 AS callable FROM orders)
SELECT event, row_number() OVER (ORDER BY CASE impact WHEN 'LOW' THEN 1 WHEN 'MODERATE' THEN 2 WHEN 'HIGH' THEN 3 ELSE 0 END DESC, CASE WHEN structural THEN context ELSE alt END DESC, coalesce(fr, -1) DESC, callable DESC, event)::INTEGER AS rank FROM f
""")
def rank_findings(spark, sf_dir):
    k, c = _c("o_orderkey"), _c("o_custkey")
    impact = F.get(F.array(*[F.lit(x) for x in ("LOW", "HIGH", "MODERATE", "?")]), (k % 4).cast("int"))
    f = table(spark, sf_dir, "orders").select(k.alias("event"), impact.alias("impact"), (c % 3 == 0).alias("structural"), (k % 5).alias("context"), (c % 7).alias("alt"), F.when(c % 2 == 0, (c % 10) / 10.0).alias("alt_fraction"), (k % 9).alias("callable"))
    return reports.rank_findings(f).select("event", "rank")


# --- inventories ----------------------------------------------------------------


@query(f"""
WITH r AS (SELECT l_returnflag AS sample, CASE WHEN l_tax > 0.05 THEN 'LOW' ELSE 'PASS' END AS filter, {_TERMS}[l_partkey % 7 + 1] AS c1, {_TERMS}[l_suppkey % 7 + 1] AS c2, ['HIGH', '', 'LOW'][l_linenumber % 3 + 1] AS i FROM lineitem),
a AS (SELECT sample, i, c1 AS c FROM r UNION ALL SELECT sample, i, c2 FROM r)
SELECT sample, 'filter' AS category, filter AS metric, count(*) AS count FROM r GROUP BY ALL UNION ALL SELECT sample, 'impact', CASE WHEN i = '' THEN 'unannotated' ELSE i END, count(*) FROM a GROUP BY ALL
UNION ALL SELECT sample, 'consequence', t, count(*) FROM (SELECT sample, unnest(string_split(c, '&')) AS t FROM a) GROUP BY ALL
""")
def landscape_terms(spark, sf_dir):
    impact = F.get(F.array(F.lit("HIGH"), F.lit(""), F.lit("LOW")), (_c("l_linenumber") % 3).cast("int")).alias("impact")
    notes = F.array(*[F.struct(impact, _term(_c(c)).alias("consequence")) for c in ("l_partkey", "l_suppkey")])
    r = table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("sample"), F.when(_c("l_tax") > 0.05, "LOW").otherwise("PASS").alias("filter"), notes.alias("annotations"))
    return reports.landscape_terms(r, ["sample"])


@query("WITH n AS (SELECT l_returnflag AS sample, l_linestatus || (l_linenumber % 3) AS f, count(*) AS n FROM lineitem GROUP BY ALL) SELECT sample, string_agg(f || ':' || n, ';' ORDER BY f) AS filters FROM n GROUP BY 1")
def filter_counts(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("sample"), _text(_c("l_linestatus"), _c("l_linenumber") % 3).alias("filter"))
    return reports.filter_counts(r, ["sample"])


@query("""
WITH r AS (SELECT l_returnflag AS file, substr('ACGT', 1, l_linenumber % 3 + 1) AS ref, [['A'], ['A', 'TT'], ['*', 'G'], ['.']][l_partkey % 4 + 1] AS alts FROM lineitem), x AS (SELECT file, ref, list_filter(alts, lambda a: a NOT IN ('*', '.', '<NON_REF>')) AS alts FROM r)
SELECT file, count(*) AS records, sum(len(alts))::BIGINT AS alleles, sum(CASE WHEN length(ref) = 1 THEN len(list_filter(alts, lambda a: length(a) = 1)) ELSE 0 END)::BIGINT AS snps, sum(len(alts))::BIGINT - sum(CASE WHEN length(ref) = 1 THEN len(list_filter(alts, lambda a: length(a) = 1)) ELSE 0 END)::BIGINT AS indels FROM x GROUP BY 1
""")
def stage_inventory(spark, sf_dir):
    alts = F.get(F.array(*[F.array(*[F.lit(x) for x in a]) for a in (["A"], ["A", "TT"], ["*", "G"], ["."])]), (_c("l_partkey") % 4).cast("int"))
    r = table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("file"), F.substr(F.lit("ACGT"), F.lit(1), (_c("l_linenumber") % 3 + 1).cast("int")).alias("ref"), alts.alias("alts"))
    return reports.stage_inventory(r, ["file"])


@query("SELECT c_custkey AS sample, count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'F') AS \"F\" FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def comparative_matrix(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(_c("o_custkey").alias("sample"), _c("o_orderstatus").alias("stage")).agg(F.count("*").alias("n"))
    return reports.comparative_matrix(n, table(spark, sf_dir, "customer").select(_c("c_custkey").alias("sample")), ["O", "F"])


@query("SELECT 'orders' AS tool, o_orderstatus AS class, o_custkey::VARCHAR AS sample, o_orderpriority AS file, count(*) AS records FROM orders GROUP BY ALL UNION ALL SELECT 'lineitem', l_linestatus, l_suppkey::VARCHAR, l_returnflag, count(*) FROM lineitem GROUP BY ALL")
def software_inventory(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(_c("o_orderstatus").alias("class"), _c("o_custkey").cast("string").alias("sample"), _c("o_orderpriority").alias("file"))
    li = table(spark, sf_dir, "lineitem").select(_c("l_linestatus").alias("class"), _c("l_suppkey").cast("string").alias("sample"), _c("l_returnflag").alias("file"))
    return reports.software_inventory({"orders": o, "lineitem": li})


@query("""
WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), x AS (SELECT c_custkey AS shard, coalesce(n, 0) AS n_records, list_filter([CASE WHEN n IS NULL THEN 'EMPTY' END, CASE WHEN c_nationkey % 4 = 0 THEN 'INDEX_MISSING' END, CASE WHEN c_custkey % 6 = 0 THEN 'SAMPLE_MISMATCH' END], lambda v: v IS NOT NULL) AS f FROM customer LEFT JOIN n ON o_custkey = c_custkey)
SELECT shard, n_records, CASE WHEN len(f) = 0 THEN 'PASS' ELSE array_to_string(f, ';') END AS status FROM x
""")
def shard_check(spark, sf_dir):
    shards = table(spark, sf_dir, "customer").select(_c("c_custkey").alias("shard"), (_c("c_nationkey") % 4 != 0).alias("indexed"), F.when(_c("c_custkey") % 6 == 0, F.array(F.lit("S1"), F.lit("S2"))).otherwise(F.array(F.lit("S1"))).alias("names"))
    return reports.shard_check(table(spark, sf_dir, "orders").select(_c("o_custkey").alias("shard")), shards, "S1")


_PAIRED = """
WITH p AS (SELECT l_returnflag AS subject, 's' || (l_suppkey % 3) AS a, 't' || (l_suppkey % 2) AS b, ['shared', 'A_only', 'B_only'][l_partkey % 3 + 1] AS contrast, 'chr' || (l_partkey % 30) AS chrom, CASE WHEN l_linenumber = 7 THEN ' ' ELSE 'g' || (l_partkey % 101) END AS gene FROM lineitem)
"""


def _paired(spark, sf_dir):
    kind = F.get(F.array(F.lit("shared"), F.lit("A_only"), F.lit("B_only")), (_c("l_partkey") % 3).cast("int"))
    return table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("subject"), _text("s", _c("l_suppkey") % 3).alias("a"), _text("t", _c("l_suppkey") % 2).alias("b"), kind.alias("contrast"), _text("chr", _c("l_partkey") % 30).alias("chrom"), F.when(_c("l_linenumber") == 7, " ").otherwise(_text("g", _c("l_partkey") % 101)).alias("gene"))


@query(_PAIRED + "SELECT subject, a, b, contrast, count(*) AS n FROM p GROUP BY ALL")
def pair_counts(spark, sf_dir):
    return reports.pair_counts(_paired(spark, sf_dir))


@query(_PAIRED + "SELECT subject, a, b, CASE WHEN substr(chrom, 4)::INT BETWEEN 1 AND 22 THEN substr(chrom, 4) ELSE 'Other' END AS chromosome, count(*) AS n FROM p WHERE contrast = 'shared' GROUP BY ALL")
def chromosome_distribution(spark, sf_dir):
    return reports.chromosome_distribution(_paired(spark, sf_dir))


@query(_PAIRED + "SELECT gene, count(*) AS n FROM p WHERE contrast = 'shared' AND trim(gene) <> '' GROUP BY 1 ORDER BY n DESC, gene LIMIT 30")
def shared_gene_counts(spark, sf_dir):
    return reports.shared_gene_counts(_paired(spark, sf_dir))


@query(_PAIRED + "SELECT sample, count(*) AS comparisons FROM (SELECT a AS sample FROM p UNION ALL SELECT b FROM p) GROUP BY 1")
def comparison_counts(spark, sf_dir):
    return reports.comparison_counts(_paired(spark, sf_dir))


@query("SELECT l_returnflag, count(*) AS sequences, sum(length(l_linestatus || l_linenumber))::BIGINT AS residues FROM lineitem GROUP BY 1")
def fasta_stats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", _text(_c("l_linestatus"), _c("l_linenumber")).alias("sequence"))
    return aggregates.fasta_stats(li, ["l_returnflag"])


# --- reads ----------------------------------------------------------------------


@query("""
WITH r AS (SELECT l_partkey AS event, l_returnflag AS c, (CASE WHEN l_suppkey % 2 = 0 THEN 16 ELSE 0 END) AS s, l_linenumber % 3 AS m, floor(l_tax * 1000)::INT AS q, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity END AS b FROM lineitem)
SELECT event, count_if(c = 'N')::BIGINT AS ref_reads, count_if(c = 'A')::BIGINT AS alt_reads, count_if(c = 'R')::BIGINT AS other_reads, count_if(c = 'A' AND s = 0)::BIGINT AS alt_forward, count_if(c = 'A' AND s = 16)::BIGINT AS alt_reverse, count_if(c = 'A' AND m = 1)::BIGINT AS alt_r1, count_if(c = 'A' AND m = 2)::BIGINT AS alt_r2,
  round(avg(q), 6) AS mean_mapq, round(avg(b), 6) AS mean_base_quality, round(CASE WHEN count_if(c <> 'R') > 0 THEN count_if(c = 'A')::DOUBLE / count_if(c <> 'R') END, 6) AS alt_fraction FROM r GROUP BY 1
""")
def event_read_summary(spark, sf_dir):
    kind = F.when(_c("l_returnflag") == "A", "EXACT_ALT").when(_c("l_returnflag") == "N", "CLEAN_REFERENCE").otherwise("EXCLUDED")
    mate = F.when(_c("l_linenumber") % 3 == 1, 64).when(_c("l_linenumber") % 3 == 2, 128).otherwise(0)
    r = table(spark, sf_dir, "lineitem").select(_c("l_partkey").alias("event"), kind.alias("class"), (F.when(_c("l_suppkey") % 2 == 0, 16).otherwise(0) + mate).alias("flag"), F.floor(_c("l_tax") * 1000).alias("mapq"), F.when(_c("l_linenumber") % 4 != 0, _c("l_quantity")).alias("base_quality"))
    return rounded(reports.event_read_summary(r, ["event"]), "mean_mapq", "mean_base_quality", "alt_fraction")


@query("""
WITH r AS (SELECT DISTINCT l_partkey AS event, 'q' || (l_orderkey % 50) AS q, l_linenumber % 2 AS flag, l_suppkey % 3 AS read_start, first(l_returnflag) OVER (PARTITION BY l_partkey, l_orderkey % 50, l_linenumber % 2, l_suppkey % 3 ORDER BY l_returnflag) AS c FROM lineitem)
SELECT event, count_if(c = 'A')::BIGINT AS alt_reads, count_if(c = 'N')::BIGINT AS ref_reads, count_if(c IN ('A', 'N'))::BIGINT AS depth, round(CASE WHEN count_if(c IN ('A', 'N')) > 0 THEN count_if(c = 'A')::DOUBLE / count_if(c IN ('A', 'N')) END, 6) AS alt_fraction, 'REF:' || count_if(c = 'N') || ';ALT:' || count_if(c = 'A') AS alleles FROM r GROUP BY 1
""")
def allele_read_counts(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").select(_c("l_partkey").alias("event"), _text("q", _c("l_orderkey") % 50).alias("qname"), (_c("l_linenumber") % 2).alias("flag"), (_c("l_suppkey") % 3).alias("read_start"), _c("l_returnflag").alias("r"))
    kind = F.when(_c("r") == "A", "EXACT_ALT").when(_c("r") == "N", "CLEAN_REFERENCE").otherwise("EXCLUDED")
    # every read stands twice; of classes of one read the operator takes the first
    twice = r.withColumns({"class": kind, "cigar": F.lit("10M"), "copy": F.explode(F.array(F.lit(1), F.lit(2)))})
    return rounded(reports.allele_read_counts(twice, ["event"]), "alt_fraction")


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey % 500 + 100 AS pos, l_linenumber + 10 AS a, l_quantity::INT AS b, l_linenumber % 3 AS m, l_suppkey % 2 AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE m WHEN 1 THEN 'R1' WHEN 2 THEN 'R2' ELSE 'UNPAIRED' END AS mate, CASE WHEN s = 0 THEN '-' ELSE '+' END AS strand, (CASE WHEN 16 <= a THEN 16 WHEN 16 > a + 20 AND 16 <= a + 20 + b THEN 16 - 20 END)::BIGINT AS read_position, pos + a + 20 + b - 1 AS alignment_end FROM r
""")
def read_provenance(spark, sf_dir):
    mate = F.when(_c("l_linenumber") % 3 == 1, 64).when(_c("l_linenumber") % 3 == 2, 128).otherwise(0)
    r = _reads(spark, sf_dir, flag=mate + F.when(_c("l_suppkey") % 2 == 0, 16).otherwise(0)).withColumn("b", cigar.blocks(_c("cigar"), _c("pos")))
    return r.select("l_orderkey", "l_linenumber", cigar.provenance(_c("flag"), _c("b"), _c("pos"), _c("pos") + 15).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10)")
def wanted_features(spark, sf_dir):
    genes = table(spark, sf_dir, "part").filter("p_size <= 10").select(_c("p_partkey").alias("gene"))
    return reports.wanted_features(table(spark, sf_dir, "lineitem").select(_c("l_partkey").alias("gene"), "l_orderkey", "l_linenumber"), genes).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1 AND l_returnflag = 'R')")
def class_code_lines(spark, sf_dir):
    code = F.when(_c("l_returnflag") == "R", "j").otherwise("=")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _c("l_orderkey").alias("transcript"), F.when(_c("l_linenumber") == 1, "transcript").otherwise("exon").alias("feature"), F.create_map(F.lit("class_code"), code).alias("attributes"))
    return reports.class_code_lines(li).select("l_orderkey", "l_linenumber")


@query("""
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS read, l_returnflag AS bam, l_suppkey % 9 AS chrom, l_partkey * 100 AS s, l_partkey * 100 + l_linenumber AS e FROM lineitem), v AS (SELECT p_partkey AS event, p_partkey % 9 AS chrom, p_partkey * 100 + p_size * 5 AS p FROM part)
SELECT event, bam, count(*) AS n FROM v JOIN r ON r.chrom = v.chrom AND r.s <= v.p + 150 AND r.e >= v.p - 150 GROUP BY ALL
""")
def cross_sample_windows(spark, sf_dir):
    """Every sample's reads around every event: the sample is no part of the key."""
    s = _c("l_partkey") * 100
    r = table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("bam"), (_c("l_suppkey") % 9).alias("chrom"), s.alias("start"), (s + _c("l_linenumber")).alias("end"))
    p = _c("p_partkey") * 100 + _c("p_size") * 5
    v = table(spark, sf_dir, "part").select(_c("p_partkey").alias("event"), (_c("p_partkey") % 9).alias("chrom"), p.alias("start"), p.alias("end"))
    return joins.range_join(v, r, ["chrom"], 512, pad=150).groupBy(_c("l.event").alias("event"), _c("r.bam").alias("bam")).agg(F.count("*").alias("n"))


# --- evidence -------------------------------------------------------------------


def _event_rows(spark, sf_dir):
    k = _c("l_partkey")
    return table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("sample"), (k % 7).cast("string").alias("chrom"), k.alias("pos"), F.lit("A").alias("ref"), F.when(k % 2 == 0, "T").otherwise("G").alias("alt"), _text("ENST", _c("l_suppkey") % 4, ".", _c("l_linenumber")).alias("transcript"), _text("g", k % 5).alias("gene"), _term(_c("l_linenumber")).alias("consequence")).distinct()


def _notes(spark, sf_dir):
    k, size = _c("p_partkey"), _c("p_size")
    one = table(spark, sf_dir, "part").select(k.alias("k"), size.alias("size"), F.explode(F.array(F.lit("A"), F.lit("N"))).alias("sample"))
    k, size = _c("k"), _c("size")
    return one.select("sample", (k % 7).cast("string").alias("chrom"), k.alias("pos"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), _text("ENST", size % 4, ".9").alias("transcript"), F.lit("p").alias("hgvsp"), _text("h", size).alias("header"), _text("pep", k % 50).alias("sequence"), F.when(size % 3 == 0, "PEPTIDE_NOT_FOUND").otherwise("VALIDATED_SUBSTITUTION").alias("status"), (size % 4).alias("msms"), F.when(size % 5 == 0, "yes").otherwise("no").alias("in_reference"))


def _spectra(spark, sf_dir):
    k = _c("event_id")
    return table(spark, sf_dir, "events").select(F.upper(_text("pep", k % 60)).alias("sequence"), F.when(k % 3 == 0, "A").when(k % 3 == 1, "N").otherwise("R").alias("sample"), (_c("value") > 50).alias("direct"), (_c("user_id") % 2 == 0).alias("clean"))


_EVIDENCE = f"""
WITH e AS (SELECT DISTINCT l_returnflag AS sample, (l_partkey % 7)::VARCHAR AS chrom, l_partkey AS pos, 'A' AS ref, CASE WHEN l_partkey % 2 = 0 THEN 'T' ELSE 'G' END AS alt, 'ENST' || (l_suppkey % 4) || '.' || l_linenumber AS transcript, 'ENST' || (l_suppkey % 4) AS t, 'g' || (l_partkey % 5) AS gene, {_TERMS}[l_linenumber % 7 + 1] AS consequence FROM lineitem),
a AS (SELECT s.sample, (p_partkey % 7)::VARCHAR AS chrom, p_partkey AS pos, 'ENST' || (p_size % 4) AS t, upper('pep' || (p_partkey % 50)) AS sequence, p_size % 3 > 0 AS altered, p_size % 4 AS msms, p_size % 5 > 0 AS absent FROM part, (VALUES ('A'), ('N')) AS s(sample)),
sp AS (SELECT upper('pep' || (event_id % 60)) AS sequence, ['A', 'N', 'R'][event_id % 3 + 1] AS sample, value > 50 AS direct, user_id % 2 = 0 AS clean FROM events),
cl AS (SELECT sequence, bool_or(direct AND clean) AS ok FROM sp GROUP BY 1),
j AS (SELECT e.*, a.sequence, a.altered, a.msms, a.absent, coalesce(cl.ok, false) AS ok, a.sequence IS NOT NULL AND right(a.sequence, 1) IN ('1', '3', '5', '7') AS can FROM e LEFT JOIN a ON a.sample = e.sample AND a.chrom = e.chrom AND a.pos = e.pos AND a.t = e.t LEFT JOIN cl ON cl.sequence = a.sequence),
g AS (SELECT sample, chrom, pos, ref, alt, list_sort(list(DISTINCT gene)) AS genes, list_sort(list(DISTINCT transcript)) AS transcripts, list_sort(list(DISTINCT consequence)) AS consequences, coalesce(list_sort(list(DISTINCT sequence) FILTER (sequence IS NOT NULL)), []) AS all_peptides, coalesce(list_sort(list(DISTINCT sequence) FILTER (altered)), []) AS altered,
  coalesce(list_sort(list(DISTINCT sequence) FILTER (altered AND length(sequence) >= 5 AND msms >= 1 AND ok)), []) AS search_consistent, coalesce(list_sort(list(DISTINCT sequence) FILTER (altered AND can)), []) AS canonical_absent, coalesce(list_sort(list(DISTINCT sequence) FILTER (altered AND absent)), []) AS reference_absent,
  coalesce(list_sort(list(DISTINCT sequence) FILTER (altered AND can AND absent)), []) AS both_absent, coalesce(list_sort(list(DISTINCT sequence) FILTER (altered AND msms >= 2)), []) AS user_filtered FROM j GROUP BY ALL),
d AS (SELECT sequence, list_sort(list(DISTINCT sample) FILTER (direct)) AS ds, list_sort(list(DISTINCT sample) FILTER (NOT direct)) AS ts FROM sp GROUP BY 1),
u AS (SELECT sample, chrom, pos, ref, alt, unnest(altered) AS sequence FROM g),
v AS (SELECT u.sample, u.chrom, u.pos, u.ref, u.alt, list_sort(list_distinct(flatten(list(coalesce(ds, []))))) AS ds, list_sort(list_distinct(flatten(list(coalesce(ts, []))))) AS ts FROM u JOIN d USING (sequence) GROUP BY ALL)
SELECT g.sample, g.chrom, g.pos, g.ref, g.alt, array_to_string(genes, ';') AS genes, array_to_string(transcripts, ';') AS transcripts, array_to_string(consequences, ';') AS consequences, array_to_string(all_peptides, ';') AS all_peptides, array_to_string(altered, ';') AS altered, array_to_string(search_consistent, ';') AS search_consistent,
  array_to_string(canonical_absent, ';') AS canonical_absent, array_to_string(reference_absent, ';') AS reference_absent, array_to_string(both_absent, ';') AS both_absent, array_to_string(user_filtered, ';') AS user_filtered, array_to_string(coalesce(ds, []), ';') AS direct_samples, array_to_string(coalesce(ts, []), ';') AS transferred_samples,
  CASE WHEN len(altered) > 0 THEN 'ALTERED_RESIDUE' WHEN len(all_peptides) > 0 THEN 'PEPTIDE_BESIDE_CHANGE' ELSE 'RNA_ONLY' END AS category, list_contains(coalesce(ds, []), g.sample) AND len(coalesce(ds, [])) = 1 AS sample_specific
FROM g LEFT JOIN v ON v.sample = g.sample AND v.chrom = g.chrom AND v.pos = g.pos AND v.ref = g.ref AND v.alt = g.alt
"""


@query(_EVIDENCE)
def variant_evidence_rows(spark, sf_dir):
    mapping = table(spark, sf_dir, "part").select(F.upper(_text("pep", _c("p_partkey") % 50)).alias("sequence")).distinct().withColumn("canonical_absent", F.right("sequence", F.lit(1)).isin("1", "3", "5", "7"))
    out = reports.variant_evidence_rows(_event_rows(spark, sf_dir), _notes(spark, sf_dir), mapping, _spectra(spark, sf_dir), min_length=5, user=F.col("msms") >= 2)
    out = out.withColumn("sample_specific", _c("classes.sample_specific"))
    return _joined(out, "genes", "transcripts", "consequences", *reports.PEPTIDE_SETS, "direct_samples", "transferred_samples").drop("only_transferred", "classes")


@query("""
WITH r AS (SELECT upper('pep' || (l_partkey % 70)) AS sequence, l_suppkey % 6 AS junction, l_linestatus AS status, l_linenumber % 3 AS support, l_returnflag AS sample FROM lineitem WHERE l_linenumber % 2 = 1),
g AS (SELECT sequence, junction, status, support, list_sort(list(DISTINCT sample)) AS src FROM r GROUP BY ALL),
sp AS (SELECT upper('pep' || (event_id % 60)) AS sequence, ['A', 'N', 'R'][event_id % 3 + 1] AS sample, value > 50 AS direct FROM events), d AS (SELECT sequence, list_sort(list(DISTINCT sample) FILTER (direct)) AS ds, list_sort(list(DISTINCT sample) FILTER (NOT direct)) AS ts FROM sp GROUP BY 1)
SELECT g.sequence, junction, status AS reference_status, support, array_to_string(src, ';') AS source_samples, array_to_string(coalesce(ds, []), ';') AS direct_samples, array_to_string(list_filter(coalesce(ts, []), lambda s: NOT list_contains(coalesce(ds, []), s)), ';') AS only_transferred, array_to_string(list_filter(src, lambda s: list_contains(coalesce(ds, []), s)), ';') AS rna_and_direct FROM g LEFT JOIN d USING (sequence)
""")
def junction_evidence_rows(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").select(_text("pep", _c("l_partkey") % 70).alias("sequence"), (_c("l_suppkey") % 6).alias("junction"), _c("l_linestatus").alias("reference_status"), (_c("l_linenumber") % 3).alias("support"), F.lit(2).alias("left"), F.lit(3).alias("right"), _c("l_returnflag").alias("sample"), (_c("l_linenumber") % 2 == 1).alias("spanning"))
    out = reports.junction_evidence_rows(r, _spectra(spark, sf_dir)).withColumn("rna_and_direct", _c("classes.rna_and_direct"))
    return _joined(out, "source_samples", "direct_samples", "only_transferred", "rna_and_direct").select("sequence", "junction", "reference_status", "support", "source_samples", "direct_samples", "only_transferred", "rna_and_direct")


@query("""
WITH r AS (SELECT l_partkey AS k, l_returnflag || l_linestatus AS sample, 'g' || (l_suppkey % 4) AS g, l_quantity AS q, l_orderkey * 10 + l_linenumber AS o FROM lineitem)
SELECT k, array_to_string(list_sort(list(DISTINCT g)), ';') AS genes, sum(q) AS total, min_by(g, o) AS first_gene, array_to_string(list_sort(list(DISTINCT sample)), ';') AS samples FROM r GROUP BY 1
""")
def unique_variants(spark, sf_dir):
    gene = _text("g", _c("l_suppkey") % 4)
    r = table(spark, sf_dir, "lineitem").select(_c("l_partkey").alias("k"), _text(_c("l_returnflag"), _c("l_linestatus")).alias("sample"), F.array(gene).alias("genes"), _c("l_quantity").alias("total"), gene.alias("first_gene"), (_c("l_orderkey") * 10 + _c("l_linenumber")).alias("o"))
    return _joined(evidence.unique_variants(r, ["k"], ["genes"], ["total"], ["first_gene"], "o"), "genes", "samples")


@query("WITH c AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS flags, list_sort(list(DISTINCT l_linestatus)) AS states FROM lineitem WHERE l_quantity > 40 GROUP BY 1) SELECT o_orderkey AS l_orderkey, coalesce(array_to_string(flags, ';'), '') AS l_returnflag, coalesce(array_to_string(states, ';'), '') AS l_linestatus FROM orders LEFT JOIN c ON l_orderkey = o_orderkey")
def attribute_sets(spark, sf_dir):
    hits = table(spark, sf_dir, "orders").select(_c("o_orderkey").alias("l_orderkey"))
    out = evidence.attribute_sets(hits, table(spark, sf_dir, "lineitem").filter("l_quantity > 40"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])
    return _joined(out, "l_returnflag", "l_linestatus")


@query("WITH i AS (SELECT user_id, unnest([event_id % 900, event_id % 700]) AS id FROM events), m AS (SELECT p_partkey AS id, p_size AS scan FROM part WHERE p_partkey <= 800) SELECT user_id, coalesce(array_to_string(list_sort(list(DISTINCT scan) FILTER (scan IS NOT NULL)), ';'), '') AS scans FROM i LEFT JOIN m USING (id) GROUP BY 1")
def spectrum_scans(spark, sf_dir):
    k = _c("event_id")
    rows = table(spark, sf_dir, "events").select("user_id", F.array(k % 900, k % 700).alias("msms_ids"))
    msms = table(spark, sf_dir, "part").filter("p_partkey <= 800").select(_c("p_partkey").alias("id"), _c("p_size").alias("scan"))
    return _joined(evidence.spectra(rows, msms, "user_id"), "scans")


@query("WITH f AS (SELECT l_partkey, max(l_linenumber) AS n, max(l_discount) AS fr FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) SELECT p_partkey AS l_partkey, coalesce(n, 0) AS alt_reads, fr AS fraction, coalesce(n, 0) > 0 AS supported FROM part LEFT JOIN f ON l_partkey = p_partkey")
def direct_support(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'").select("l_partkey", _c("l_linenumber").alias("alt_reads"), _c("l_discount").alias("fraction"))
    return evidence.direct_support(table(spark, sf_dir, "part").select(_c("p_partkey").alias("l_partkey")), f, ["l_partkey"])


@query(f"SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#22') OR p_size % 4 = 3 OR {_TERMS}[p_partkey % 7 + 1] IN ('stop_gained&splice_region_variant')")
def priority_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", _c("p_brand").alias("gene"), F.when(_c("p_size") % 4 == 3, "HIGH").otherwise("LOW").alias("impact"), _term(_c("p_partkey")).alias("consequence"))
    return evidence.priority_filter(p, ["Brand#11", "Brand#22"], ["HIGH"], ["stop_gained"]).select("p_partkey")


@query("""
WITH a AS (SELECT count_if(l_returnflag = 'A') AS altered, count(*) AS n FROM lineitem), b AS (SELECT count_if(o_orderstatus = 'X') AS strict FROM orders), c AS (SELECT count_if(p_size > 100) AS reads FROM part)
SELECT h.hypothesis, CASE WHEN NOT h.told THEN 'NOT_EVALUABLE' WHEN h.yes THEN 'SUPPORTED' ELSE 'NOT_SUPPORTED' END AS conclusion FROM a, b, c, (SELECT 1) x, LATERAL (SELECT * FROM (VALUES ('H1', altered > 0, n > 0), ('H4', strict > 0, n > 0), ('H5', reads > 0, strict > 0)) AS v(hypothesis, yes, told)) AS h
""")
def hypotheses(spark, sf_dir):
    measures = [
        (table(spark, sf_dir, "lineitem"), {"altered": F.count_if(_c("l_returnflag") == "A"), "n": F.count("*")}),
        (table(spark, sf_dir, "orders"), {"strict": F.count_if(_c("o_orderstatus") == "X")}),
        (table(spark, sf_dir, "part"), {"reads": F.count_if(_c("p_size") > 100)}),
    ]
    claims = [("H1", _c("altered") > 0, _c("n") > 0), ("H4", _c("strict") > 0, _c("n") > 0), ("H5", _c("reads") > 0, _c("strict") > 0)]
    return reports.hypotheses(measures, claims)


# --- joins ----------------------------------------------------------------------


@query("""
WITH c AS (SELECT 'chr' || (doc_id % 5) AS contig, doc_id AS chunk_no0, upper(substr(regexp_replace(coalesce(text, ''), '[^A-Za-z]', 'N', 'g') || repeat('N', 64), 1, 64)) AS seq FROM documents),
g AS (SELECT contig, row_number() OVER (PARTITION BY contig ORDER BY chunk_no0) - 1 AS chunk_no, seq FROM c), w AS (SELECT contig, string_agg(seq, '' ORDER BY chunk_no) AS s FROM g GROUP BY 1),
v AS (SELECT p_partkey, (p_partkey % 6)::VARCHAR AS chrom, p_partkey % 900 + 1 AS pos, p_size % 9 + 1 AS length FROM part)
SELECT p_partkey, CASE WHEN s IS NULL OR pos > length(s) THEN NULL ELSE substr(s, pos, v.length) END AS genome_ref FROM v LEFT JOIN w ON w.contig = 'chr' || v.chrom
""")
def genome_slice(spark, sf_dir):
    letters = F.concat(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "N"), F.repeat(F.lit("N"), F.lit(64)))
    d = table(spark, sf_dir, "documents").select(_text("chr", _c("doc_id") % 5).alias("contig"), "doc_id", F.substring(letters, 1, 64).alias("seq"))
    genome = d.withColumn("chunk_no", F.row_number().over(Window.partitionBy("contig").orderBy("doc_id")) - 1).drop("doc_id")
    v = table(spark, sf_dir, "part").select("p_partkey", (_c("p_partkey") % 6).cast("string").alias("chrom"), (_c("p_partkey") % 900 + 1).alias("pos"), (_c("p_size") % 9 + 1).alias("length"))
    return joins.genome_slice(v, genome, 64).select("p_partkey", "genome_ref")


@query("""
WITH n AS (SELECT DISTINCT 'run_S' || (l_suppkey % 12) || '_x' || (l_linenumber % 2) AS name FROM lineitem), s AS (SELECT 'S' || n_nationkey AS sample FROM nation WHERE n_nationkey < 10)
SELECT name, sample FROM n LEFT JOIN s ON regexp_matches(name, '(^|[^A-Za-z0-9])' || sample || '($|[^A-Za-z0-9])')
""")
def name_match(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").select(_text("run_S", _c("l_suppkey") % 12, "_x", _c("l_linenumber") % 2).alias("name")).distinct()
    return joins.name_match(n, table(spark, sf_dir, "nation").filter("n_nationkey < 10").select(_text("S", _c("n_nationkey")).alias("sample")))


# --- checks ---------------------------------------------------------------------


@query("SELECT (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'N') AS failed, (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'N')::BIGINT AS counted, true AS equal")
def merge_invariant(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.when(_c("l_returnflag") != "N", _c("l_returnflag")).alias("primary_failure"))
    return reports.merge_invariant(li, li.filter("primary_failure IS NOT NULL").groupBy("primary_failure").agg(F.count("*").alias("count")))


@query("SELECT count_if(o_orderstatus = 'O')::BIGINT AS marked, count_if(o_orderstatus = 'O' AND o_totalprice > 1000)::BIGINT AS listed, count_if(o_orderstatus = 'O') = count_if(o_orderstatus = 'O' AND o_totalprice > 1000) AS equal FROM orders")
def strict_consistency(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((_c("o_orderstatus") == "O").alias("strict"), "o_totalprice")
    return reports.strict_consistency(o, o.filter("strict AND o_totalprice > 1000"))


@query("WITH s AS (SELECT c_nationkey, count_if(c_custkey % 40 = 0) AS b, count_if(c_custkey % 40 > 0) AS f FROM customer GROUP BY 1) SELECT coalesce(sum(f) FILTER (b = 1), 0)::BIGINT AS expected FROM s")
def expected_pairs(spark, sf_dir):
    return reports.expected_pairs(table(spark, sf_dir, "customer").select(_c("c_nationkey").alias("subject"), (_c("c_custkey") % 40 == 0).alias("baseline")))


@query("SELECT name, 'NOT_DECLARED' AS problem FROM (SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_nationkey < 3 EXCEPT SELECT DISTINCT c_mktsegment FROM customer WHERE c_nationkey = 1) UNION ALL SELECT name, 'NOT_OBSERVED' FROM (SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_nationkey = 1 EXCEPT SELECT c_mktsegment FROM customer WHERE c_custkey < 3)")
def coverage_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(_c("c_mktsegment").alias("name"), "c_nationkey", "c_custkey")
    return quality.coverage_diff(c.filter("c_nationkey = 1"), c.filter("c_custkey < 3"), c.filter("c_nationkey < 3"))


@query(_TASKS + "SELECT 'BAD_STATUS' AS problem, status AS value, count(*) AS n FROM t WHERE status = 'FAILED' GROUP BY ALL")
def trace_check(spark, sf_dir):
    return quality.trace_check(_tasks(spark, sf_dir))


@query("""
WITH d AS (SELECT DISTINCT c_custkey, 'S' || (c_custkey % 90) AS sample, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'R' || (c_custkey % 97) END AS srr, 'T' || c_nationkey AS subject, ['true', 'FALSE', 'maybe', 'false', 'no'][c_custkey % 5 + 1] AS baseline FROM customer)
SELECT 'DUPLICATE_SAMPLE' AS problem, sample AS value FROM d GROUP BY sample HAVING count(*) > 1 UNION ALL SELECT 'DUPLICATE_RUN', srr FROM d WHERE srr <> '' GROUP BY srr HAVING count(*) > 1
UNION ALL SELECT 'BASELINE_NOT_TRUE_OR_FALSE', sample FROM d WHERE lower(baseline) NOT IN ('true', 'false') UNION ALL SELECT 'MULTIPLE_BASELINES', subject FROM d WHERE baseline = 'true' GROUP BY subject HAVING count(*) > 1
""")
def samplesheet_problems(spark, sf_dir):
    k = _c("c_custkey")
    truth = F.get(F.array(*[F.lit(x) for x in ("true", "FALSE", "maybe", "false", "no")]), (k % 5).cast("int"))
    return quality.samplesheet_problems(table(spark, sf_dir, "customer").select(_text("S", k % 90).alias("sample"), F.when(k % 5 == 0, "").otherwise(_text("R", k % 97)).alias("srr"), _text("T", _c("c_nationkey")).alias("subject"), truth.alias("baseline")))


_KINDS = """
WITH v AS (SELECT l_orderkey, l_linenumber, substr('ACG', 1, l_linenumber % 2 + 1) AS ref, substr('TGC', 1, l_partkey % 2 + 1) AS alt, l_quantity / 10 AS qd, l_extendedprice / 500 AS fs, l_discount * 100 AS sor, l_tax * 1000 AS mq, -l_linenumber * 3.0 AS rank FROM lineitem)
"""


@query(
    _KINDS
    + """SELECT l_orderkey, l_linenumber, coalesce(nullif(array_to_string(list_filter([CASE WHEN qd < 2 THEN 'QD2' END, CASE WHEN fs > 60 THEN 'FS60' END, CASE WHEN sor > 3 THEN 'SOR3' END, CASE WHEN mq < 40 THEN 'MQ40' END, CASE WHEN rank < -12.5 THEN 'MQRankSum-12.5' END, CASE WHEN rank < -8 THEN 'ReadPosRankSum-8' END], lambda c: c IS NOT NULL), ';'), ''), 'PASS') AS filter FROM v WHERE length(ref) = 1 AND length(alt) = 1
UNION ALL SELECT l_orderkey, l_linenumber, coalesce(nullif(array_to_string(list_filter([CASE WHEN qd < 2 THEN 'QD2' END, CASE WHEN fs > 200 THEN 'FS200' END, CASE WHEN sor > 10 THEN 'SOR10' END, CASE WHEN rank < -20 THEN 'ReadPosRankSum-20' END], lambda c: c IS NOT NULL), ';'), ''), 'PASS') FROM v WHERE length(ref) <> length(alt)"""
)
def merge_filtered(spark, sf_dir):
    rank = (-_c("l_linenumber") * 3.0).alias("MQRankSum")
    v = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.substr(F.lit("ACG"), F.lit(1), (_c("l_linenumber") % 2 + 1).cast("int")).alias("ref"), F.substr(F.lit("TGC"), F.lit(1), (_c("l_partkey") % 2 + 1).cast("int")).alias("alt"), (_c("l_quantity") / 10).alias("QD"), (_c("l_extendedprice") / 500).alias("FS"), (_c("l_discount") * 100).alias("SOR"), (_c("l_tax") * 1000).alias("MQ"), rank, rank.alias("ReadPosRankSum")
    )
    return reports.merge_filtered(v).select("l_orderkey", "l_linenumber", "filter")


# --- composite jobs -------------------------------------------------------------


@query("""
WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'x' END AS b1, o_orderkey % 3 + o_custkey % 2 AS s, o_orderkey % 5 AS d, o_orderpriority = '5-LOW' AS low, o_orderstatus = 'O' AS frame, list_distinct(['r' || (o_orderkey % 4), 'r' || (o_custkey % 4)]) AS names FROM orders),
c AS (SELECT *, list_filter([CASE WHEN b1 = '' THEN 'MISSING_BREAKPOINT' END, CASE WHEN s < 1 THEN 'SPLIT_READS_BELOW_MINIMUM' END, CASE WHEN s + d < 2 THEN 'TOTAL_SUPPORT_BELOW_MINIMUM' END, CASE WHEN low THEN 'LOW_CONFIDENCE' END, CASE WHEN NOT frame THEN 'NOT_IN_FRAME' END], lambda x: x IS NOT NULL) AS codes FROM f)
SELECT o_orderkey, len(names)::INTEGER AS unique_supporting_read_names, array_to_string(codes, ';') AS codes, CASE WHEN len(codes) = 0 THEN 'RNA_VALIDATED' ELSE 'REJECTED' END AS status FROM c
""")
def rna_fusion_validation(spark, sf_dir):
    k, c = _c("o_orderkey"), _c("o_custkey")
    f = table(spark, sf_dir, "orders").select(
        k, F.when(k % 7 == 0, "").otherwise("x").alias("breakpoint1"), F.lit("y").alias("breakpoint2"), (k % 3).alias("split_reads1"), (c % 2).alias("split_reads2"), (k % 5).alias("discordant_mates"), F.regexp_extract("o_orderpriority", "[A-Z ]+$", 0).alias("confidence"), F.when(_c("o_orderstatus") == "O", "in-frame").otherwise("out-of-frame").alias("reading_frame"), _text("r", k % 4, ", r", c % 4, ",").alias("read_identifiers")
    )
    return composites.rna_fusion_validation(f).select("o_orderkey", "unique_supporting_read_names", F.array_join("failure_codes", ";").alias("codes"), "status")


@query("""
WITH x AS (SELECT DISTINCT l_orderkey AS t, l_returnflag AS chrom, l_partkey * 10 AS s, l_partkey * 10 + l_linenumber AS e FROM lineitem), j AS (SELECT t, chrom, e + 1 AS s, lead(s) OVER (PARTITION BY t, chrom ORDER BY s, e) - 1 AS e FROM x), k AS (SELECT * FROM j WHERE e IS NOT NULL),
r AS (SELECT chrom, s, e, sum(CASE WHEN t % 3 = 0 THEN 0 ELSE 3 END) AS n FROM k WHERE e >= s GROUP BY ALL), y AS (SELECT k.t, coalesce(n, 0) AS n FROM k LEFT JOIN r ON r.chrom = k.chrom AND r.s = k.s AND r.e = k.e), m AS (SELECT t, count(*) AS nj, min(n) AS ms FROM y GROUP BY 1), u AS (SELECT DISTINCT t FROM x)
SELECT u.t AS transcript, coalesce(nj, 0) AS n_junctions, coalesce(ms, 0)::BIGINT AS min_support, CASE WHEN nj IS NULL THEN 'NO_EXON_JUNCTION' WHEN ms < 3 THEN 'JUNCTION_READS_BELOW_MINIMUM' ELSE '' END AS codes FROM u LEFT JOIN m ON m.t = u.t
""")
def rna_splice_validation(spark, sf_dir):
    s = _c("l_partkey") * 10
    x = table(spark, sf_dir, "lineitem").select(_c("l_orderkey").alias("transcript"), _c("l_returnflag").alias("chrom"), s.alias("start"), (s + _c("l_linenumber")).alias("end")).distinct()
    j = windows.exon_junctions(x).filter("transcript % 3 > 0 AND end >= start").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3))))
    reads = j.select(_c("chrom").alias("rname"), F.lit(0).alias("flag"), (_c("start") - 5).alias("pos"), _text("5M", _c("end") - _c("start") + 1, "N5M").alias("cigar"))
    out = composites.rna_splice_validation(x, reads)
    return out.select("transcript", "n_junctions", "min_support", F.array_join("failure_codes", ";").alias("codes"))


@query("""
SELECT c1.code AS event_type, count(*) AS reported, count_if(l_quantity >= 10 AND l_tax <= 0.05)::BIGINT AS validated, count_if(NOT (l_quantity >= 10 AND l_tax <= 0.05))::BIGINT AS rejected FROM lineitem, LATERAL (SELECT l_returnflag AS code) AS c1 GROUP BY 1
""")
def complete_audit_classes(spark, sf_dir):
    return composites.complete_audit(_audits(spark, sf_dir))["classes"]


def _audits(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("event_type"), "l_quantity", "l_tax")
    return rules.with_rules(li, [("RNA_DEPTH_BELOW_MINIMUM", _c("l_quantity") < 10), ("LOW_CONFIDENCE", _c("l_tax") > 0.05)])


@query("SELECT l_returnflag AS event_type, 'RNA_DEPTH_BELOW_MINIMUM' AS code, count(*) AS count FROM lineitem WHERE l_quantity < 10 GROUP BY 1 UNION ALL SELECT l_returnflag, 'LOW_CONFIDENCE', count(*) FROM lineitem WHERE l_tax > 0.05 GROUP BY 1")
def complete_audit_codes(spark, sf_dir):
    return composites.complete_audit(_audits(spark, sf_dir))["codes"]


@query(_VARIANTS + """, f AS (SELECT DISTINCT l_returnflag AS g1, l_linestatus AS g2, 'c' || l_linenumber AS c1, l_suppkey AS p1, 'd' || l_linenumber AS c2, l_partkey AS p2 FROM lineitem),
j AS (SELECT DISTINCT 'T' || o_custkey AS t, 'c' || o_custkey % 5 AS chrom, o_orderkey AS a, o_orderkey + 100 AS b FROM orders)
SELECT 'rna_variant' AS class, chrom, count(DISTINCT sample || '_' || pos || '_' || ref || '_' || alt) AS events, min(pos - 1) AS first0, max(pos - 1 + length(ref)) AS last0, NULL::BIGINT AS last2 FROM v GROUP BY 2
UNION ALL SELECT 'fusion', c1, count(*), min(p1 - 1), max(p1), max(p2) FROM f GROUP BY 2 UNION ALL SELECT 'splice_junction', chrom, count(*), min(a - 1), max(b), NULL FROM j GROUP BY 2
""")
def event_catalogue(spark, sf_dir):
    v = _variants(spark, sf_dir).select("sample", "chrom", "pos", "ref", "alt")
    li = table(spark, sf_dir, "lineitem")
    fusions = li.select(_c("l_returnflag").alias("gene1"), _c("l_linestatus").alias("gene2"), _text("c", _c("l_linenumber"), ":", _c("l_suppkey")).alias("breakpoint1"), _text("d", _c("l_linenumber"), ":", _c("l_partkey")).alias("breakpoint2"))
    junctions = table(spark, sf_dir, "orders").select(_text("T", _c("o_custkey")).alias("transcript"), _text("c", _c("o_custkey") % 5).alias("chrom"), _c("o_orderkey").alias("start"), (_c("o_orderkey") + 100).alias("end"))
    out = composites.event_catalogue(v, fusions, junctions)
    return out.groupBy("class", "chrom").agg(F.countDistinct("event").alias("events"), F.min("start0").alias("first0"), F.max("end0").alias("last0"), F.max("end2").alias("last2"))


@query("""
WITH e AS (SELECT 'n' || n_nationkey AS c, 'r' || n_regionkey AS p FROM nation), g AS (SELECT DISTINCT 'g' || c_custkey AS gene, 'n' || c_nationkey AS term FROM customer)
SELECT gene, term, 'name ' || term AS name, 'P' AS namespace FROM g UNION SELECT gene, p, 'name ' || p, 'P' FROM g JOIN e ON c = term
""")
def go_annotation_closure(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    edges = n.select(_text("n", _c("n_nationkey")).alias("child"), _text("r", _c("n_regionkey")).alias("parent"))
    terms = edges.select(_c("child").alias("id")).union(edges.select("parent")).distinct().withColumns({"name": F.concat(F.lit("name "), "id"), "namespace": F.lit("P")})
    notes = table(spark, sf_dir, "customer").select(_text("g", _c("c_custkey")).alias("gene"), _text("n", _c("c_nationkey")).alias("term"))
    return composites.go_annotation_closure(notes, edges, terms)


@query("""
WITH a AS (SELECT l_partkey % 30 AS chrom, l_suppkey AS pos, max(l_linenumber % 3) AS gt FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL), b AS (SELECT l_partkey % 30 AS chrom, l_suppkey AS pos, max(l_linenumber % 3) AS gt FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT coalesce(a.chrom, b.chrom)::VARCHAR AS chrom, coalesce(a.pos, b.pos) + 1 AS pos, CASE WHEN a.gt IS NOT NULL AND b.gt IS NOT NULL THEN 'shared' WHEN a.gt IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side, CASE WHEN a.gt IS NULL OR b.gt IS NULL THEN 'not_comparable' WHEN a.gt = b.gt THEN 'yes' ELSE 'no' END AS concordance FROM a FULL JOIN b ON a.chrom = b.chrom AND a.pos = b.pos
""")
def caller_comparison(spark, sf_dir):
    """Alleles that one caller writes with a base more in front meet the other's."""

    def calls(status, ref, alt, prefix):
        gt = F.get(F.array(F.lit("0/0"), F.lit("0/1"), F.lit("1/1")), (_c("l_linenumber") % 3).cast("int"))
        li = table(spark, sf_dir, "lineitem").filter(_c("l_linestatus") == status)
        return li.select(_text(prefix, _c("l_partkey") % 30).alias("chrom"), (_c("l_suppkey") + (0 if len(ref) > 1 else 1)).alias("pos"), F.lit(ref).alias("ref"), F.lit(alt).alias("alt"), gt.alias("gt"))

    found, _ = composites.caller_comparison(calls("O", "GA", "GT", "chr"), calls("F", "A", "T", ""))
    return found.select("chrom", "pos", "side", "concordance")


@query(_FOLD + ", s AS (SELECT p_brand, count(*) AS n, median(fc) AS md, avg((fc > 0)::INT) AS up FROM fold JOIN part ON p_partkey = gene GROUP BY 1) SELECT p_brand AS hypothesis, CASE WHEN n < 5 THEN 'INSUFFICIENT_DATA' WHEN md >= 0.25 AND up >= 0.6 THEN 'SUPPORTED' WHEN md <= -0.25 AND up <= 0.4 THEN 'CONTRADICTED' ELSE 'MIXED' END AS verdict FROM s")
def biology_review(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy(_c("l_returnflag").alias("sample"), _c("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("cpm"))
    s = table(spark, sf_dir, "lineitem").select(F.lit("all").alias("subject"), _c("l_returnflag").alias("sample"), (_c("l_returnflag") == "A").alias("baseline")).distinct().filter("sample <> 'N'")
    p = table(spark, sf_dir, "part").select(_c("p_partkey").alias("gene"), _c("p_brand").alias("gene_set"))
    expected = p.select(_c("gene_set").alias("hypothesis"), "gene_set", F.lit("up").alias("direction")).distinct()
    return composites.biology_review(m, s, p, expected)


@query("""
WITH v AS (SELECT l_partkey AS pos, 'N' AS sample, l_suppkey % 5 = 0 AS b FROM lineitem), x AS (SELECT l_returnflag AS sample, l_partkey AS pos FROM lineitem GROUP BY ALL), s AS (SELECT pos, bool_or(sample = 'N') AS b, bool_or(sample <> 'N') AS f FROM x GROUP BY 1)
SELECT 'T' AS subject, pos, CASE WHEN b AND f THEN 'shared' WHEN b THEN 'baseline_only' ELSE 'nonbaseline_only' END AS partition FROM s
""")
def progression_partition(spark, sf_dir):
    v = table(spark, sf_dir, "lineitem").select(_c("l_returnflag").alias("sample"), F.lit("1").alias("chrom"), _c("l_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), _c("l_suppkey").alias("gene"), F.lit("HIGH").alias("impact"))
    samples = v.select(F.lit("T").alias("subject"), "sample", (_c("sample") == "N").alias("baseline")).distinct()
    sets_ = table(spark, sf_dir, "supplier").select(_c("s_suppkey").alias("gene"), _c("s_nationkey").alias("term"))
    return composites.progression_analysis(v, samples, sets_)["partition"].select("subject", "pos", "partition")


@query(_CALLERS + "SELECT side, concordance, count(*) AS n FROM c GROUP BY ALL")
def concordance_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus", (_c("l_linenumber") % 3).alias("gt"))
    c = sets.caller_sets(li.filter("l_linestatus = 'O'"), li.filter("l_linestatus = 'F'"), ["l_partkey", "l_suppkey"], "gt")
    return c.groupBy("side", "concordance").agg(F.count("*").alias("n"))
