"""Peptides over junctions and tests of variant sets on the driver's tables, with SQL for DuckDB.

In the first a part is a peptide: its name's words around its number in letters, once
forwards and once backwards.  A return flag is a sample.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.lineage import checkpointed
from tallyloom.operators import enrichment, junctions
from tallyloom.plans import composites
from tallyloom.plans.queries import query, rounded, table

#: Both halves of each part's peptide, and the flags that it was sold under.
_HALVES = """
WITH w AS (SELECT p_partkey AS k, p_size, upper(split_part(p_name, ' ', 1)) AS w1, upper(split_part(p_name, ' ', 2)) AS w2, translate(lpad(p_partkey::VARCHAR, 9, '0'), '0123456789', 'ACDEFGHKMN') AS c FROM part),
p AS (SELECT k, p_size, w1 || c AS a, reverse(c) || w2 AS b, w1 || c || reverse(c) || w2 AS pep, (p_size % 3) * 0.005 AS err, p_size * 2 AS score, p_size % 5 AS msms FROM w),
f AS (SELECT DISTINCT l_partkey AS k, l_returnflag AS sample FROM lineitem)
"""


def _halves(spark, sf_dir):
    word = lambda k: F.upper(F.split_part("p_name", F.lit(" "), F.lit(k)))
    code = F.translate(F.lpad(F.col("p_partkey").cast("string"), 9, "0"), "0123456789", "ACDEFGHKMN")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_size", F.concat(word(1), code).alias("a"), F.concat(F.reverse(code), word(2)).alias("b"))
    p = p.withColumns({"pep": (F.col("p_size") % 3) * F.lit(0.005), "score": (F.col("p_size") * 2).cast("double"), "msms": F.col("p_size") % 5})
    # many branches read the flags: they are made once
    return p, checkpointed(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("sample")).distinct())


def _junction_peptides(spark, sf_dir):
    p, flags = _halves(spark, sf_dir)
    both = F.concat("a", "b")
    k = F.col("k").cast("string")
    role = lambda r, header, text: F.struct(F.lit(r).alias("role"), F.lit(f"{r[0].lower()}.fa").alias("file"), header.alias("header"), text.alias("sequence"))
    canonical = p.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("k") % 3 == 0, role("CANONICAL", F.concat(F.lit("S"), k), F.concat(F.lit("M"), both))),
                    F.when(F.col("k") % 3 > 0, role("CANONICAL", F.concat(F.lit("L"), k), F.concat(F.lit("M"), "a"))),
                    F.when(F.col("k") % 3 == 1, role("CANONICAL", F.concat(F.lit("R"), k), F.concat("b", F.lit("K")))),
                )
            )
        ).alias("x")
    )
    sold = p.join(flags, "k")
    fusion = sold.select(role("FUSION", F.concat("sample", F.lit("|FUSION|1.G"), k, F.lit("(12)-H"), k, F.lit(".x of")), F.concat(F.lit("MK"), both, F.when(F.col("k") % 5 == 0, both).otherwise("RR"))).alias("x"))
    splice = sold.filter("k % 2 = 0").select(role("SPLICE", F.concat("sample", F.lit("|SPLICE|STRG."), k, F.lit(".1.p1 x")), F.concat(F.lit("Q"), both)).alias("x"))
    other = sold.select(role("SPLICE", F.concat("sample", F.lit("|OTHER|"), k), both).alias("x"))
    proteins = canonical.union(fusion).union(splice).union(other).select("x.*")
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'")
    gene = lambda g: F.concat(F.lit(g), "l_partkey", F.lit("(7)"))
    text = lambda c: F.col(c).cast("string")
    calls = li.select(F.lower("l_returnflag").alias("sample"), gene("G").alias("gene1"), gene("H").alias("gene2"), F.concat(F.lit("1:"), "l_partkey").alias("breakpoint1"), F.concat(F.lit("2:"), "l_linenumber").alias("breakpoint2"), text("l_linestatus").alias("confidence"), F.lit("").alias("type"), F.lit("in-frame").alias("reading_frame"), text("l_linenumber").alias("split_reads1"), F.lit("").alias("split_reads2"), F.when(F.col("l_linenumber") > 2, "4").alias("discordant_mates"))
    peptides = p.select(F.lower(both).alias("sequence"), "pep", "score", "msms", "k")
    return junctions.junction_peptides(peptides, proteins, calls)


@query(
    _HALVES
    + """,
s AS (SELECT p.*, sample, CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS places FROM p JOIN f USING (k)),
h AS (
  SELECT s.*, 'FUSION' AS class, sample || '|FUSION|1.G' || k || '(12)-H' || k || '.x of' AS header, sample || '|FUSION|1.G' || k || '(12)-H' || k || '.x:' AS word, unnest(CASE WHEN places = 2 THEN [3, 3 + length(pep)] ELSE [3] END) AS start FROM s
  UNION ALL SELECT s.*, 'SPLICE', sample || '|SPLICE|STRG.' || k || '.1.p1 x', sample || '|SPLICE|STRG.' || k || '.1.p1:', 2 FROM s WHERE k % 2 = 0),
g AS (SELECT k, class, count(*) AS n, string_agg(DISTINCT sample, ';' ORDER BY sample) AS samples, string_agg(header, ';' ORDER BY header, start) AS headers, string_agg(word || start || '-' || (start + length(pep) - 1), ';' ORDER BY header, start) AS positions FROM h GROUP BY ALL),
c AS (SELECT l_partkey AS k, string_agg(DISTINCT '2:' || l_linenumber, ';' ORDER BY '2:' || l_linenumber) AS breakpoint2, string_agg(DISTINCT l_linestatus, ';' ORDER BY l_linestatus) AS confidence,
  'split1=' || string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) || CASE WHEN max(l_linenumber) > 2 THEN ';discordant=4' ELSE '' END AS support FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
r AS (SELECT g.*, p.* EXCLUDE (k), coalesce(c.breakpoint2, '') AS breakpoint2, coalesce(c.confidence, '') AS confidence, coalesce(c.support, '') AS support, c.k IS NOT NULL AS called, g.k % 3 = 1 AS anchored,
  g.k % 3 > 0 AND err <= 0.01 AND score >= 40 AND msms >= 2 AS high FROM g JOIN p USING (k) LEFT JOIN c ON c.k = g.k AND class = 'FUSION')
SELECT k, pep AS sequence, class, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS canonical_matches, n::BIGINT AS novel_matches, samples, lower(class[1]) || '.fa' AS files, headers, positions,
  CASE WHEN anchored THEN length(a) END AS split, CASE WHEN anchored THEN a ELSE '' END AS left_segment, CASE WHEN anchored THEN b ELSE '' END AS right_segment,
  CASE WHEN anchored THEN 'L' || k ELSE '' END AS left_support, CASE WHEN anchored THEN 'R' || k ELSE '' END AS right_support,
  CASE WHEN anchored THEN 'split-anchor-supported' WHEN k % 3 = 0 THEN 'canonical-shared' ELSE 'noncanonical-no-split-anchor' END AS inference,
  CASE WHEN class = 'FUSION' THEN 'G' || k ELSE '' END AS gene1, CASE WHEN class = 'FUSION' THEN 'H' || k ELSE '' END AS gene2, CASE WHEN called THEN '1:' || k ELSE '' END AS breakpoint1, breakpoint2, confidence,
  CASE WHEN called THEN 'in-frame' ELSE '' END AS reading_frame, support, high AS high_confidence, high AND (class = 'SPLICE' OR (anchored AND called)) AS candidate
FROM r"""
)
def junction_peptides(spark, sf_dir):
    return _junction_peptides(spark, sf_dir).drop("pep", "score", "msms", "type", "canonical_absent")


#: Exons of each part's transcript of two or three, in the order in which it runs; a strand of - runs back from 1,000,000.
_SPLICED = (
    _HALVES
    + """,
s AS (SELECT p.*, sample, CASE WHEN k % 4 = 1 THEN '-' ELSE '+' END AS strand, 1 + k % 4 AS orf, 12 + k % 50 AS e1, 10 + k % 17 AS e2 FROM p JOIN f USING (k)),
cut AS (SELECT *, CASE WHEN k % 6 = 5 THEN 2 ELSE 1 END AS times, CASE WHEN k % 7 = 3 THEN 3 ELSE 1 END AS place FROM s),
j AS (SELECT k, sample, 1 AS no, e1 AS after FROM s WHERE k % 9 > 0 UNION ALL SELECT k, sample, 2, e1 + e2 FROM s WHERE k % 9 > 0),
asked AS (SELECT cut.*, sample || '|SPLICE|STRG.' || k || '.1.p1' AS token, CASE WHEN k % 8 = 6 THEN 'header not found in supplied splice FASTAs' WHEN k % 7 = 4 THEN 'peptide not found in splice protein' WHEN times = 2 THEN 'peptide has multiple occurrences in splice protein'
  WHEN k % 9 = 0 THEN 'sample-specific transcript not found in supplied GTF' END AS reason FROM cut),
met AS (SELECT asked.*, no, after, after - orf + 1 AS coding, place + length(pep) - 1 AS last FROM asked JOIN j USING (k, sample) WHERE reason IS NULL AND after >= orf AND after < orf + 3 * (length(pep) + place) - 1),
x AS (SELECT *, coding // 3 + CASE WHEN coding % 3 = 0 THEN 0 ELSE 1 END AS lo, coding // 3 + 1 AS hi FROM met),
y AS (SELECT *, place <= lo AND last >= hi AS crosses FROM x),
z AS (SELECT *, CASE WHEN crosses THEN coding // 3 - place + 1 ELSE 0 END AS anchor_left,
  CASE WHEN strand = '+' THEN after + (no - 1) * 100 ELSE 1000000 - after - no * 100 END AS donor FROM y),
d AS (SELECT *, CASE WHEN NOT crosses THEN 'not-spanning' WHEN least(anchor_left, CASE WHEN coding % 3 = 0 THEN last - hi + 1 ELSE last - hi END) < 2 THEN 'weak-anchor' ELSE 'supported' END AS support,
  CASE WHEN NOT crosses THEN 0 WHEN coding % 3 = 0 THEN last - hi + 1 ELSE last - hi END AS right_anchor,
  'chr' || k || ':' || donor || '-' || (donor + 101) || '(' || strand || ')' AS junction, CASE WHEN k % 2 = 0 AND no = 1 THEN 'known' ELSE 'novel' END AS reference_status FROM z)
"""
)


def _splice_peptides(spark, sf_dir):
    p, flags = _halves(spark, sf_dir)
    k, both = F.col("k"), F.concat("a", "b")
    s = p.join(flags, "k").withColumns({"strand": F.when(k % 4 == 1, "-").otherwise("+"), "orf": 1 + k % 4, "e1": 12 + k % 50, "e2": 10 + k % 17, "peptide": both})
    before = F.when(k % 7 == 3, "GG").otherwise("")
    held = F.when(k % 7 == 4, F.lower(F.reverse("peptide"))).otherwise(F.when(k % 5 == 2, F.translate("peptide", "IL", "LI")).otherwise(F.col("peptide")))
    text = F.concat(before, held, F.when(k % 6 == 5, held).otherwise(""), F.lit("*"))
    stop = F.col("orf") + 3 * (F.char_length("peptide") + F.char_length(before) + 1) - 1
    # a word of another case stands under its sample and protein
    proteins = s.filter("k % 8 <> 6").select(F.concat("sample", F.lit(".fa")).alias("file"), F.concat(F.when(k % 2 == 0, F.lower("sample")).otherwise(F.col("sample")), F.lit("|SPLICE|STRG."), k, F.when(k % 5 == 1, ".2").otherwise(".1"), F.lit(".p1 STRG."), k, F.lit(".1:"), "orf", F.lit("-"), stop, F.lit("(+)")).alias("header"), text.alias("sequence"))
    candidates = p.join(flags.groupBy("k").agg(F.array_sort(F.collect_list("sample")).alias("samples")), "k")
    asked = F.array_join(F.transform("samples", lambda x: F.concat(x, F.lit("|SPLICE|STRG."), k, F.when(k % 5 == 1, ".2").otherwise(".1"), F.lit(".p1 x"))), ";")
    candidates = candidates.select(F.lower(both).alias("sequence"), F.when(k % 10 == 7, "no header").otherwise(asked).alias("headers"), "pep", "msms", "k")
    exon = lambda low, high: F.struct(F.when(F.col("strand") == "+", low).otherwise(1000001 - high).alias("start"), F.when(F.col("strand") == "+", high).otherwise(1000001 - low).alias("end"))
    one, two = F.col("e1"), F.col("e1") + F.col("e2")
    exons = s.filter("k % 9 > 0").select("sample", F.concat(F.lit("STRG."), k, F.lit(".1")).alias("transcript"), F.concat(F.lit("chr"), k).alias("chrom"), "strand", F.explode(F.array(exon(F.lit(1), one), exon(one + 101, two + 100), exon(two + 201, two + 500))).alias("x"), F.lit("j").alias("class_code")).select("*", "x.*").drop("x")
    listed = s.filter("k % 2 = 0").select(F.concat(F.lit("ENST"), k).alias("transcript"), k.cast("string").alias("chrom"), "strand", F.explode(F.array(exon(F.lit(1), one), exon(one + 101, one + 110))).alias("x")).select("*", "x.*").drop("x").distinct()
    return junctions.splice_peptides(candidates, proteins, exons, listed, attributes=["class_code"])


_ASKED = "k % 10 <> 7"


@query(_SPLICED + f"SELECT k, pep AS sequence, sample, no AS junction_no, junction, reference_status, CASE WHEN crosses THEN 'exact-junction-spanning' ELSE 'same-ORF-not-this-junction' END AS classification, anchor_left, right_anchor AS anchor_right, support, CASE WHEN k % 5 = 2 AND (contains(pep, 'I') OR contains(pep, 'L')) THEN 'I/L-equivalent' ELSE 'exact' END AS match_mode FROM d WHERE {_ASKED}")
def splice_peptides(spark, sf_dir):
    return _splice_peptides(spark, sf_dir)["detailed"].select("k", "sequence", "sample", "junction_no", "junction", "reference_status", "classification", "anchor_left", "anchor_right", "support", "match_mode")


@query(_SPLICED + f"SELECT k, sample, junction, anchor_left, right_anchor AS anchor_right FROM d WHERE {_ASKED} AND crosses AND reference_status = 'novel'")
def splice_peptides_prioritized(spark, sf_dir):
    return _splice_peptides(spark, sf_dir)["prioritized"].select("k", "sample", "junction", "anchor_left", "anchor_right")


@query(
    _SPLICED
    + f""", header AS (SELECT *, CASE WHEN reason LIKE 'header%' THEN sample WHEN k % 2 = 0 THEN lower(sample) ELSE sample END || '|SPLICE|STRG.' || k || CASE WHEN k % 5 = 1 THEN '.2' ELSE '.1' END || '.p1' AS shown FROM asked)
SELECT pep AS sequence, shown AS header, coalesce(reason, 'ORF contains no internal exon boundary') AS reason FROM header WHERE {_ASKED} AND NOT EXISTS (SELECT 1 FROM d WHERE d.k = header.k AND d.sample = header.sample)
UNION ALL SELECT pep, '', 'candidate row contains no splice FASTA header' FROM p WHERE k % 10 = 7 AND k IN (SELECT k FROM f)"""
)
def splice_peptides_unresolved(spark, sf_dir):
    return _splice_peptides(spark, sf_dir)["unresolved"]


# --- variant sets ----------------------------------------------------------------

#: A segment is a subject, its statuses of orders samples (F the baseline), a part a gene, its brand a set.
_VARIANT_SETS = """
WITH held AS (SELECT DISTINCT c_mktsegment AS subject, o_orderstatus AS sample, l_partkey AS gene FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE l_quantity >= 49 AND o_orderstatus <> 'F'),
design AS (SELECT subject, list_sort(list(DISTINCT sample)) AS everyone FROM held GROUP BY 1),
each AS (SELECT subject, gene, list(sample) AS inside FROM held GROUP BY ALL),
label AS (SELECT subject, 'common_all_progression' AS analysis, array_to_string(everyone, ',') AS members FROM design UNION ALL SELECT subject, s || kind, s FROM (SELECT subject, unnest(everyone) AS s FROM design), (VALUES ('_all'), ('_exclusive')) AS v(kind)),
fore AS (SELECT l.subject, analysis, members, gene FROM label l JOIN each USING (subject) JOIN design USING (subject) WHERE CASE WHEN analysis LIKE 'common%' THEN len(inside) = len(everyone) WHEN ends_with(analysis, '_all') THEN list_contains(inside, members) ELSE inside = [members] END),
u AS (SELECT p_partkey AS gene, p_brand AS term FROM part WHERE p_partkey % 7 > 0 AND p_size > 3),
st AS (SELECT term, count(*) AS size FROM u GROUP BY 1 HAVING count(*) BETWEEN 3 AND 5000),
dr AS (SELECT l.*, count(u.gene) AS drawn FROM label l LEFT JOIN fore USING (subject, analysis, members) LEFT JOIN u ON u.gene = fore.gene GROUP BY ALL),
h AS (SELECT subject, analysis, term, count(*) AS overlap FROM fore JOIN u USING (gene) GROUP BY ALL),
t AS (SELECT dr.*, st.term, size, coalesce(overlap, 0) AS overlap, (SELECT count(*) FROM u) AS total FROM dr CROSS JOIN st LEFT JOIN h ON h.subject = dr.subject AND h.analysis = dr.analysis AND h.term = st.term),
p AS (SELECT *, least(1.0, list_sum(list_transform(range(greatest(overlap, drawn + size - total), least(drawn, size) + 1), lambda x: exp(lgamma(size + 1) - lgamma(x + 1) - lgamma(size - x + 1) + lgamma(total - size + 1) - lgamma(drawn - x + 1) - lgamma(total - size - drawn + x + 1) - lgamma(total + 1) + lgamma(drawn + 1) + lgamma(total - drawn + 1))))) AS p FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY subject, analysis ORDER BY p) AS k, count(*) OVER (PARTITION BY subject, analysis) AS m FROM p),
q AS (SELECT *, least(1.0, min(p * m / k) OVER (PARTITION BY subject, analysis ORDER BY p, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS fdr FROM r)
"""


def _variant_sets(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_mktsegment").alias("subject"), F.col("o_orderstatus").alias("status"))
    li = table(spark, sf_dir, "lineitem").filter("l_quantity >= 49").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    # a sample is of one subject
    named = F.concat("subject", F.lit("/"), "status")
    genes = li.select(named.alias("sample"), F.col("l_partkey").alias("gene"))
    samples = o.select("subject", named.alias("sample"), (F.col("status") == "F").alias("baseline")).distinct()
    parts = table(spark, sf_dir, "part")
    universe = parts.filter("p_partkey % 7 > 0").select(F.col("p_partkey").alias("gene"))
    sets = parts.filter("p_size > 3").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("term"))
    rows, summary = enrichment.variant_set_tests(genes, samples, universe, sets, smallest=3, largest=5000)
    plain = lambda c: F.regexp_replace(c, "[A-Z]+/", "").alias(c)
    return [df.withColumns({"analysis": plain("analysis"), "members": plain("members")}) for df in (rows, summary)]


@query(_VARIANT_SETS + "SELECT subject, analysis, members, term, size, overlap, drawn, total, round(p, 6) AS p, round(fdr, 6) AS fdr FROM q")
def variant_set_tests(spark, sf_dir):
    return rounded(_variant_sets(spark, sf_dir)[0], "p", "fdr").select("subject", "analysis", "members", "term", "size", "overlap", "drawn", "total", "p", "fdr")


@query(_VARIANT_SETS + "SELECT subject, analysis, members, drawn AS foreground, (SELECT count(*) FROM u) AS background, count(term) AS terms, count(*) FILTER (fdr <= 0.1) AS significant FROM dr LEFT JOIN q USING (subject, analysis, members, drawn) GROUP BY ALL")
def variant_set_summary(spark, sf_dir):
    return _variant_sets(spark, sf_dir)[1]


_BACKGROUND = """
WITH v AS (SELECT DISTINCT l_returnflag AS sample, l_partkey AS pos, l_suppkey AS gene FROM lineitem),
new AS (SELECT DISTINCT sample, gene FROM v WHERE sample <> 'N' AND pos NOT IN (SELECT pos FROM v WHERE sample = 'N')),
u AS (SELECT s_suppkey AS gene, s_nationkey AS term FROM supplier WHERE s_acctbal > 0),
f AS (SELECT sample, count(*) AS drawn FROM new JOIN u USING (gene) GROUP BY 1),
h AS (SELECT sample, term, count(*) AS overlap FROM new JOIN u USING (gene) GROUP BY ALL),
st AS (SELECT term, count(*) AS size FROM u GROUP BY 1)
SELECT f.sample, st.term, size, coalesce(overlap, 0) AS overlap, drawn, (SELECT count(*) FROM u) AS total FROM f CROSS JOIN st LEFT JOIN h ON h.sample = f.sample AND h.term = st.term
"""


@query(_BACKGROUND)
def progression_enrichment(spark, sf_dir):
    v = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("sample"), F.lit("1").alias("chrom"), F.col("l_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("T").alias("alt"), F.col("l_suppkey").alias("gene"), F.lit("HIGH").alias("impact"))
    samples = v.select(F.lit("T").alias("subject"), "sample", (F.col("sample") == "N").alias("baseline")).distinct()
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("gene"), F.col("s_nationkey").alias("term"), "s_acctbal")
    out = composites.progression_analysis(v, samples, s.select("gene", "term"), s.filter("s_acctbal > 0").select("gene"))["enrichment"]
    return out.select("sample", "term", "size", "overlap", "drawn", "total")
