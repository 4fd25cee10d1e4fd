"""Annotations, peptides and event regions on the driver's tables, with SQL for DuckDB.

A part is a protein: two parts of its name around a residue that its variant
replaces, repeats or lacks.  A return flag is a sample.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import cigar
from tallyloom.functions.lineage import checkpointed
from tallyloom.operators import annotation, evidence, joins, quality
from tallyloom.plans.queries import _HITS, _patterns, query, table

#: Protein, variant, its kind and transcript of each part and flag.
_PROTEINS = """
WITH p AS (
  SELECT p_partkey AS k, 'MK' || upper(split_part(p_name, ' ', 1)) AS a, upper(split_part(p_name, ' ', 2)) || 'END' AS b, p_size,
    ['missense_variant', 'inframe_insertion', 'inframe_deletion', 'frameshift_variant'][1 + p_partkey % 4] AS consequence, ['Q', 'JQQ', '', 'QQQQ'][1 + p_partkey % 4] AS changed FROM part
),
f AS (SELECT DISTINCT l_partkey AS k, l_returnflag AS sample FROM lineitem),
v AS (SELECT p.*, sample, a || 'J' || b AS ref_seq, a || changed || CASE WHEN consequence = 'frameshift_variant' THEN '' ELSE b END AS alt_seq,
    'ENST' || (1000 + p.k) AS base, sample || '|var_._chr' || p_size || '.' || (100 * p.k) || '.G.T_ENST' || (1000 + p.k) || '.1_0' AS token FROM p JOIN f USING (k))
"""

_ANNOTATED = (
    _PROTEINS
    + """,
n AS (SELECT k, sample, base, CASE WHEN p_size % 2 = 0 THEN base || '.1' ELSE base END AS feature, length(a) + 1 AS place, consequence, CASE WHEN sample = 'A' THEN 'p.' || k ELSE '' END AS hgvsp FROM v WHERE sample <> 'R' AND p_size <= 45),
c AS (SELECT v.k, v.sample AS of, n.*, CASE WHEN n.sample = v.sample THEN 0 ELSE 2 END + CASE WHEN n.feature = n.base THEN 1 ELSE 0 END AS attempt FROM v JOIN n ON n.k = v.k),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY k, of ORDER BY hgvsp = '', attempt, sample) = 1)
"""
)


def _variants(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    word = lambda k: F.upper(F.split_part("p_name", F.lit(" "), F.lit(k)))
    pick = lambda *x: F.get(F.array(*[F.lit(y) for y in x]), (F.col("p_partkey") % 4).cast("int"))
    p = p.select(F.col("p_partkey").alias("k"), "p_size", F.concat(F.lit("MK"), word(1)).alias("a"), F.concat(word(2), F.lit("END")).alias("b"), pick("missense_variant", "inframe_insertion", "inframe_deletion", "frameshift_variant").alias("consequence"), pick("Q", "JQQ", "", "QQQQ").alias("changed"))
    flags = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("sample")).distinct()
    base = F.concat(F.lit("ENST"), F.col("k") + 1000)
    token = F.concat("sample", F.lit("|var_._chr"), "p_size", F.lit("."), F.col("k") * 100, F.lit(".G.T_"), base, F.lit(".1_0"))
    rest = F.when(F.col("consequence") == "frameshift_variant", "").otherwise(F.col("b"))
    # many branches read the variants: they are made once
    return checkpointed(p.join(flags, "k").withColumns({"base": base, "token": token, "ref_seq": F.concat("a", F.lit("J"), "b"), "alt_seq": F.concat("a", "changed", rest)}))


def _notes(v):
    rows = v.filter("sample <> 'R' AND p_size <= 45")
    return rows.select(
        "sample",
        F.col("p_size").cast("string").alias("chrom"),
        (F.col("k") * 100).alias("pos"),
        F.lit("G").alias("ref"),
        F.lit("T,C").alias("alts"),
        F.lit("T").alias("allele"),
        F.when(F.col("p_size") % 2 == 0, F.concat("base", F.lit(".1"))).otherwise(F.col("base")).alias("feature"),
        (F.char_length("a") + 1).cast("string").alias("protein_position"),
        F.when(F.col("sample") == "A", F.concat(F.lit("p."), "k")).otherwise("").alias("hgvsp"),
        F.lit("J/Q").alias("amino_acids"),
        "consequence",
        F.lit("").alias("protein_id"),
    )


@query(_ANNOTATED + "SELECT v.k, v.sample, best.sample AS from_sample, best.attempt, best.feature FROM v LEFT JOIN best ON best.k = v.k AND best.of = v.sample")
def annotation_lookup(spark, sf_dir):
    v = _variants(spark, sf_dir)
    asked = v.select(F.struct("k", "sample").alias("key"), "sample", F.col("p_size").cast("string").alias("chrom"), (F.col("k") * 100).alias("pos"), F.lit("G").alias("ref"), F.lit("T").alias("alt"), F.concat("base", F.lit(".1")).alias("transcript"))
    out = annotation.annotated(asked, _notes(v), "key")
    return out.select("key.k", "sample", F.col("annotation.sample").alias("from_sample"), "attempt", F.col("annotation.feature").alias("feature"))


@query(
    _PROTEINS
    + """, x AS (SELECT DISTINCT k, ref_seq, alt_seq, length(a) AS low, length(a) + CASE consequence WHEN 'missense_variant' THEN 1 WHEN 'inframe_insertion' THEN 3 WHEN 'inframe_deletion' THEN 0 ELSE 4 END AS high, consequence FROM v)
SELECT k, CASE WHEN consequence = 'inframe_insertion' THEN low + 1 ELSE low END AS low, high FROM x"""
)
def changed_spans(spark, sf_dir):
    """One span each; a run around an inserted copy of the residue begins after it."""
    rows = annotation.changed_spans(_variants(spark, sf_dir).select("k", "ref_seq", "alt_seq").distinct())
    return rows.select("k", F.explode("changes").alias("c")).select("k", "c.low", "c.high")


_PEPTIDES = (
    _ANNOTATED
    + """,
d AS (SELECT v.*, CASE p_size % 3 WHEN 0 THEN right(a, 2) || changed || left(b, 2) WHEN 1 THEN left(a, 4) ELSE 'YYYY' END AS peptide FROM v WHERE v.consequence <> 'frameshift_variant' OR v.p_size % 3 > 0
  UNION ALL SELECT v.*, right(a, 2) || changed FROM v WHERE v.consequence = 'frameshift_variant' AND v.p_size % 3 = 0),
r AS (SELECT d.k, d.sample, d.peptide, d.token, best.sample AS noted, best.place, strpos(alt_seq, peptide) AS start, contains(ref_seq, peptide) AS inside, d.consequence, d.a, d.changed FROM d LEFT JOIN best ON best.k = d.k AND best.of = d.sample),
s AS (SELECT *, CASE WHEN start = 0 THEN 'PEPTIDE_NOT_FOUND'
    WHEN peptide = left(a, 4) THEN 'PEPTIDE_DOES_NOT_COVER_EVENT'
    WHEN consequence = 'missense_variant' THEN 'VALIDATED_SUBSTITUTION' WHEN inside THEN 'PEPTIDE_PRESENT_IN_REFERENCE'
    WHEN consequence = 'inframe_insertion' THEN 'VALIDATED_INFRAME_INSERTION' WHEN consequence = 'inframe_deletion' THEN 'VALIDATED_INFRAME_DELETION' ELSE 'VALIDATED_FRAMESHIFT_NOVEL_SEQUENCE' END AS status FROM r WHERE noted IS NOT NULL)
"""
)


def _variant_peptides(spark, sf_dir):
    v = _variants(spark, sf_dir)
    crossing = F.concat(F.right("a", F.lit(2)), "changed", F.when(F.col("consequence") == "frameshift_variant", "").otherwise(F.left("b", F.lit(2))))
    peptide = F.when(F.col("p_size") % 3 == 0, crossing).when(F.col("p_size") % 3 == 1, F.left("a", F.lit(4))).otherwise("YYYY")
    headers = F.concat(F.lit("sp|P1|X; "), "token", F.lit(" p; "), "token", F.lit("; Q|var_"), "k")
    candidates = v.select(F.lower(peptide).alias("peptide"), headers.alias("headers"))
    proteins = v.select(F.concat("token", F.lit(" p")).alias("header"), F.col("alt_seq").alias("sequence"), F.lit("v.fa").alias("file"))
    references = v.select(F.concat(F.lit("ENSP"), "k", F.lit(".1 pep transcript:"), "base", F.lit(".1 x")).alias("header"), F.col("ref_seq").alias("sequence")).distinct()
    return annotation.variant_peptides(candidates, proteins, _notes(v), references)


@query(_PEPTIDES + "SELECT peptide, token, noted AS annotated_by, nullif(start, 0)::INTEGER AS start, CASE WHEN inside THEN 'yes' ELSE 'no' END AS in_reference, CASE WHEN start = 0 THEN 'unknown' WHEN start <= place AND start + length(peptide) - 1 >= place THEN 'yes' ELSE 'no' END AS spans_position, status FROM s")
def variant_peptides(spark, sf_dir):
    rows, _ = _variant_peptides(spark, sf_dir)
    return rows.select("peptide", "token", F.col("annotation.sample").alias("annotated_by"), "start", "in_reference", "spans_position", "status")


@query(_PEPTIDES + "SELECT DISTINCT peptide, token, 'no matching annotation' AS reason FROM r WHERE noted IS NULL UNION SELECT DISTINCT peptide, 'Q|var_' || k, 'variant header not found' FROM d")
def unresolved_peptides(spark, sf_dir):
    return _variant_peptides(spark, sf_dir)[1]


# --- events ---------------------------------------------------------------------

_REGIONS = """
WITH e AS (SELECT 'e' || c_custkey AS event, c_nationkey::VARCHAR AS chrom, c_custkey * 10 AS start0, CASE WHEN c_custkey % 7 > 0 THEN c_custkey * 10 + 5 END AS end0,
  CASE WHEN c_custkey % 2 = 0 THEN 'x' || c_nationkey END AS chrom2, c_custkey * 20 AS start2_0, c_custkey * 20 + CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 1 END AS end2 FROM customer),
f AS (SELECT o_orderkey AS event_id, o_custkey AS c, ['rna_variant', 'splice_junction', 'x;fusion', 'other'][o_orderkey % 4 + 1] AS classes, o_orderkey % 4 = 0 AS allele, o_orderkey % 5 AS n FROM orders),
t AS (SELECT *, CASE WHEN allele THEN CASE WHEN n = 0 THEN 'SNV' ELSE 'INSERTION' END ELSE ['SPLICE_JUNCTION', 'FUSION', 'CONTEXT_EVENT'][event_id % 4] END AS event_type FROM f),
s AS (SELECT event_id, event_type, nth, event, chrom, start0, end0, chrom2, start2_0, end2 FROM t CROSS JOIN (VALUES (0), (1), (2)) AS v(nth) JOIN e ON e.event = 'e' || CASE nth WHEN 0 THEN c WHEN 1 THEN c ELSE c + 1 END),
r AS (
  SELECT event_id, event_type, nth * 2 AS place, chrom, start0, end0, CASE WHEN event_type = 'SPLICE_JUNCTION' THEN 'JUNCTION' ELSE 'BREAKPOINT_1' END AS role FROM s WHERE end0 IS NOT NULL
  UNION ALL SELECT event_id, event_type, nth * 2 + 1, chrom2, start2_0, end2, 'BREAKPOINT_2' FROM s WHERE chrom2 IS NOT NULL),
g AS (SELECT event_id, event_type, chrom, start0, end0, role, min(place) AS place FROM r WHERE event_type IN ('SPLICE_JUNCTION', 'FUSION', 'CONTEXT_EVENT') GROUP BY ALL
  UNION ALL SELECT event_id, event_type, '1', greatest(0, event_id - 1), greatest(0, event_id - 1) + 1, 'TARGET_ALLELE', 0 FROM t WHERE allele),
a AS (SELECT t.event_id, t.event_type, coalesce(string_agg(g.chrom || ':' || g.start0 || '-' || g.end0 || ' ' || g.role, ';' ORDER BY place), '') AS regions, count(g.role) AS n,
  bool_or(g.end0 <= g.start0) AS bad, array_to_string(list_sort(list(DISTINCT g.role)), ',') AS roles FROM t LEFT JOIN g ON g.event_id = t.event_id GROUP BY ALL)
"""


def _regions(spark, sf_dir):
    c = F.col("c_custkey")
    e = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("e"), c).alias("event"), F.col("c_nationkey").cast("string").alias("chrom"), (c * 10).alias("start0"), F.when(c % 7 > 0, c * 10 + 5).alias("end0"),
        F.when(c % 2 == 0, F.concat(F.lit("x"), "c_nationkey")).alias("chrom2"), (c * 20).alias("start2_0"), (c * 20 + F.when(c % 11 == 0, 0).otherwise(1)).alias("end2"),
    )
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    classes = F.get(F.array(*[F.lit(x) for x in ("rna_variant", "splice_junction", "x;fusion", "other")]), (k % 4).cast("int"))
    names = F.concat(F.lit("e"), c, F.lit(";e"), c, F.lit(";e"), c + 1, F.lit(";gone"))
    f = table(spark, sf_dir, "orders").select(k.alias("event_id"), classes.alias("classes"), names.alias("source_events"), F.lit("1").alias("chrom"), k.alias("pos"), F.when(k % 4 == 0, "A").alias("ref"), F.when(k % 4 == 0, F.when(k % 5 == 0, "T").otherwise("AT")).alias("alt"))
    return evidence.event_regions(f, e)


@query(_REGIONS + "SELECT event_id, event_type, regions FROM a")
def event_regions(spark, sf_dir):
    text = F.transform("regions", lambda r: F.concat(r["chrom"], F.lit(":"), r["start0"], F.lit("-"), r["end0"], F.lit(" "), r["role"]))
    return _regions(spark, sf_dir).select("event_id", "event_type", F.array_join(text, ";").alias("regions"))


@query(
    _REGIONS
    + """, v AS (SELECT event_id, list_filter([CASE WHEN n = 0 THEN 'NO_REGIONS' END, CASE WHEN n > 0 AND event_id % 13 = 0 AND event_type <> 'SNV' THEN 'EVENT_TYPE' END, CASE WHEN bad THEN 'INVALID_REGION' END,
  CASE WHEN n > 0 AND event_type = 'FUSION' AND (n < 2 OR roles <> 'BREAKPOINT_1,BREAKPOINT_2') THEN 'FUSION_BREAKPOINTS' END, CASE WHEN event_type = 'SPLICE_JUNCTION' AND contains(roles, 'BREAKPOINT_2') THEN 'SPLICE_REGIONS' END,
  CASE WHEN n > 0 AND event_type IN ('SPLICE_JUNCTION', 'FUSION', 'CONTEXT_EVENT') AND event_id % 3 > 0 THEN 'VISUAL_STATUS' END], lambda x: x IS NOT NULL) AS v FROM a)
SELECT event_id, unnest(v) AS violation FROM v"""
)
def region_invariants(spark, sf_dir):
    k = F.col("event_id")
    stated = F.when(k % 13 == 0, "SNV").otherwise(F.col("event_type"))
    rows = _regions(spark, sf_dir).withColumns({"stated_type": stated, "context": k % 3, "visual_status": F.lit("NO_CONTEXT_ALIGNMENTS")})
    return quality.region_invariants(rows)


@query(_HITS + "SELECT pattern_id, text_id, position FROM h")
def pattern_join_seeded(spark, sf_dir):
    """As pattern_join_all, by the way for patterns beyond an automaton."""
    return joins.pattern_join(*_patterns(spark, sf_dir), seed=12, automaton_letters=0)


@query("""
WITH l AS (SELECT l_returnflag, l_linenumber AS dots, l_partkey % 3 AS ins, l_suppkey % 4 AS t, l_orderkey % 2 AS del FROM lineitem)
SELECT l_returnflag, base, sum(n)::BIGINT AS n FROM (SELECT l_returnflag, 'G' AS base, dots AS n FROM l UNION ALL SELECT l_returnflag, 'G+AC', ins FROM l UNION ALL SELECT l_returnflag, 'T', t FROM l UNION ALL SELECT l_returnflag, 'G-NNNNNNNNNNN', del FROM l) GROUP BY ALL
""")
def pileup_counts(spark, sf_dir):
    times = lambda text, n: F.array_join(F.array_repeat(F.lit(text), n.cast("int")), "")
    text = F.concat(times(".", F.col("l_linenumber")), times("+2aC", F.col("l_partkey") % 3), F.lit("^+"), times("t", F.col("l_suppkey") % 4), times("-11" + "n" * 11, F.col("l_orderkey") % 2), F.lit("$*"))
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.explode(cigar.pileup_counts(text, F.lit("g"))).alias("base", "n"))
    return rows.groupBy("l_returnflag", "base").agg(F.sum("n").alias("n"))
