"""Tables behind reports: inventories, evidence rows, hypotheses, rankings, checks between tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import alleles, cigar
from tallyloom.functions.lineage import numbered
from tallyloom.operators import rules

#: The order of impacts, and ranks of consequences.
IMPACTS = ("MODIFIER", "LOW", "MODERATE", "HIGH")
CONSEQUENCE_RANKS = {
    "transcript_ablation": 100,
    "splice_acceptor_variant": 95,
    "splice_donor_variant": 95,
    "stop_gained": 90,
    "frameshift_variant": 90,
    "stop_lost": 85,
    "start_lost": 85,
    "inframe_insertion": 75,
    "inframe_deletion": 75,
    "missense_variant": 70,
    "protein_altering_variant": 65,
    "splice_region_variant": 60,
    "synonymous_variant": 30,
}
#: Chromosomes by name; others are counted together.
CHROMOSOMES = (*map(str, range(1, 23)), "X", "Y", "MT")


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def impact_rank(impact: Column) -> Column:
    """0 to 3; 0 for an unknown impact."""
    return F.greatest(F.lit(0), F.coalesce(F.array_position(F.array(*[F.lit(x) for x in IMPACTS]), impact), F.lit(0)) - 1)


def consequence_rank(consequence: Column) -> Column:
    """The greatest rank of the terms of ``a&b``; 0 for unknown ones."""
    known = _map(CONSEQUENCE_RANKS)
    return F.array_max(F.transform(F.split(F.coalesce(consequence, F.lit("")), "&"), lambda t: F.coalesce(F.try_element_at(known, t), F.lit(0))))


def annotation_order(impact: str = "impact", consequence: str = "consequence", canonical: str = "canonical", biotype: str = "biotype") -> list[Column]:
    """The best annotation first: by impact, consequence, canonical transcript, protein-coding gene."""
    return [F.desc(impact_rank(F.col(impact))), F.desc(consequence_rank(F.col(consequence))), F.desc(F.coalesce(F.col(canonical) == "YES", F.lit(False))), F.desc(F.coalesce(F.col(biotype) == "protein_coding", F.lit(False)))]


# --- inventories ---------------------------------------------------------------


def landscape_terms(records: DataFrame, keys: list[str]) -> DataFrame:
    """keys, category, metric, count of records' FILTER and of their annotations' impacts and consequence terms.

    records: filter and annotations, an array of struct(impact, consequence); a
    term counts once for each annotation.
    """
    note = records.select(*keys, F.explode("annotations").alias("a"))
    terms = note.select(*keys, F.explode(F.array_distinct(F.filter(F.split(F.coalesce("a.consequence", F.lit("")), "&"), lambda t: t != ""))).alias("metric"))
    parts = [
        records.select(*keys, F.lit("filter").alias("category"), F.col("filter").alias("metric")),
        note.select(*keys, F.lit("impact").alias("category"), F.when(F.coalesce("a.impact", F.lit("")) == "", "unannotated").otherwise(F.col("a.impact")).alias("metric")),
        terms.select(*keys, F.lit("consequence").alias("category"), "metric"),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys, "category", "metric").agg(F.count("*").alias("count"))


def filter_counts(records: DataFrame, keys: list[str]) -> DataFrame:
    """keys, filters: ``NAME:count;NAME:count`` in the order of names."""
    n = records.groupBy(*keys, "filter").agg(F.count("*").alias("n"))
    named = F.array_sort(F.collect_list(F.struct("filter", F.concat("filter", F.lit(":"), F.col("n").cast("string")).alias("text"))))
    return n.groupBy(*keys).agg(F.array_join(F.transform(named, lambda x: x["text"]), ";").alias("filters"))


def stage_inventory(records: DataFrame, keys: list[str]) -> DataFrame:
    """keys, records, alleles, snps, indels from records (ref, alts array); symbolic alternatives are no alleles."""
    real = F.filter("alts", lambda a: ~a.isin(*alleles.SYMBOLIC))
    snps = F.size(F.filter(real, lambda a: (F.char_length(a) == 1) & (F.char_length("ref") == 1)))
    n = records.groupBy(*keys).agg(F.count("*").alias("records"), F.sum(F.size(real)).alias("alleles"), F.sum(snps).alias("snps"))
    return n.withColumn("indels", F.col("alleles") - F.col("snps"))


def comparative_matrix(counts: DataFrame, samples: DataFrame, stages: list[str]) -> DataFrame:
    """sample and a column for each stage of counts (sample, stage, n), 0 where there is none; every sample of samples."""
    wide = counts.filter(F.col("stage").isin(stages)).groupBy("sample").agg(*[F.sum(F.when(F.col("stage") == s, F.col("n")).otherwise(0)).alias(s) for s in stages])
    return samples.select("sample").distinct().join(wide, "sample", "left").na.fill(0, stages)


def software_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """tool, class, sample, file, records of tables (class, sample, file) by tool, in one union."""
    rows = [df.select(F.lit(tool).alias("tool"), "class", "sample", "file") for tool, df in tables.items()]
    return reduce(DataFrame.unionByName, rows).groupBy("tool", "class", "sample", "file").agg(F.count("*").alias("records"))


def shard_check(records: DataFrame, shards: DataFrame, sample: str) -> DataFrame:
    """shard, n_records, status of shards (shard, indexed, names array) and their records (shard).

    INDEX_MISSING, SAMPLE_MISMATCH (other names than the sample's) and EMPTY
    are joined by ``;``.
    """
    n = records.groupBy("shard").agg(F.count("*").alias("n_records"))
    rows = shards.join(n, "shard", "left").na.fill(0, ["n_records"])
    found = rules.failure_codes([("EMPTY", F.col("n_records") == 0), ("INDEX_MISSING", ~F.col("indexed")), ("SAMPLE_MISMATCH", F.exists("names", lambda x: x != sample))])
    return rows.select("shard", "n_records", F.when(F.size(found) == 0, "PASS").otherwise(F.array_join(found, ";")).alias("status"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """subject, a, b, contrast, n of contrasted alleles."""
    return rows.groupBy("subject", "a", "b", "contrast").agg(F.count("*").alias("n"))


def chromosome_distribution(rows: DataFrame) -> DataFrame:
    """subject, a, b, chromosome, n of shared alleles; unknown names as Other."""
    plain = F.regexp_replace("chrom", "^chr", "")
    name = F.when(plain.isin(*CHROMOSOMES), plain).otherwise("Other")
    return rows.filter("contrast = 'shared'").groupBy("subject", "a", "b", name.alias("chromosome")).agg(F.count("*").alias("n"))


def shared_gene_counts(rows: DataFrame, top: int = 30) -> DataFrame:
    """gene, n: the top genes of shared alleles by (n, gene), a report's bound."""
    n = rows.filter("contrast = 'shared'").filter(F.coalesce(F.trim("gene"), F.lit("")) != "").groupBy("gene").agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "gene").limit(top)


def comparison_counts(pairs: DataFrame) -> DataFrame:
    """sample, comparisons: how many pairs (a, b) a sample stands in."""
    return pairs.select(F.explode(F.array("a", "b")).alias("sample")).groupBy("sample").agg(F.count("*").alias("comparisons"))


def most_common(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, by (count, value)."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def first_n(df: DataFrame, order: list[Column | str], limit: int) -> DataFrame:
    """The first rows in an order: a diagnostic table's bound."""
    return df.orderBy(*order).limit(limit)


def rank_findings(findings: DataFrame, limit: int = 0) -> DataFrame:
    """findings (event, impact, structural, context, alt, alt_fraction, callable) with rank, the strongest first; a limit of 0 keeps all.

    By impact, then reads for the allele (for structural events alignments
    around them), share and callable reads; ties by event.
    """
    strength = F.when(F.col("structural"), F.col("context")).otherwise(F.col("alt"))
    order = [F.desc(impact_rank(F.col("impact"))), F.desc(strength), F.desc(F.coalesce("alt_fraction", F.lit(-1.0))), F.desc("callable"), F.asc("event")]
    if limit > 0:
        findings = findings.orderBy(*order).limit(limit)
    return numbered(findings, order, "rank").withColumn("rank", F.col("rank").cast("int"))


# --- reads around events -------------------------------------------------------


#: Positions in whose order reads are counted by one task at a time.
COUNT_BIN = 1 << 16


def reads_around(reads: DataFrame, events: DataFrame, pad: int, width: int | None = None) -> DataFrame:
    """events' columns, bam, reads, mapqs (reads that have one) and mapq_sum, to be summed up: how many reads overlap an event widened by pad.

    reads: bam, chrom, start, end, qname, flag, cigar, mapq; one of a name, flag,
    place and CIGAR counts once.  events: chrom, pos, ref.  An event overlaps as
    many reads as begin up to its end, less those that end before it: both are
    running sums over positions, by bins of width, so the work grows with reads
    and events, not with their pairs.  A read that runs on into a bin counts
    from its first position.
    """
    width = width or COUNT_BIN
    at = lambda c: F.floor(c / F.lit(width))
    where = ["bam", "chrom", "_bin"]
    one = reads.filter("chrom IS NOT NULL AND start <= end").groupBy("bam", "chrom", "qname", "flag", "start", "cigar").agg(F.max("end").alias("end"), F.max("mapq").alias("mapq"))
    one = one.select("bam", "chrom", (F.col("start") - pad).cast("long").alias("_low"), (F.col("end") + pad).cast("long").alias("_high"), "mapq")
    bins = one.withColumn("_bin", F.explode(F.sequence(at(F.col("_low")), at(F.col("_high")))))
    begins, last = at(F.col("_low")) == F.col("_bin"), at(F.col("_high") + 1) == F.col("_bin")
    step = lambda point, begun, held: F.struct(point.alias("_at"), begun.cast("int").alias("_begun"), held.cast("int").alias("_held"))
    # begun: reads that begin; held: those that are there from before, less those that have ended
    steps = F.array(step(F.when(begins, F.col("_low")).otherwise(F.col("_bin") * width), begins, F.when(begins, 0).otherwise(1)), step(F.when(last, F.col("_high") + 1), F.lit(0), F.lit(-1)))
    sums = {f"{kind}_{name}": F.col(f"_s.{kind}") * value for kind in ("_begun", "_held") for name, value in (("n", F.lit(1)), ("m", F.col("mapq").isNotNull().cast("int")), ("q", F.coalesce("mapq", F.lit(0))))}
    steps = bins.select(*where, "mapq", F.explode(steps).alias("_s")).filter("_s._at IS NOT NULL").groupBy(*where, F.col("_s._at").alias("_at")).agg(*[F.sum(x.cast("long")).alias(c) for c, x in sums.items()])

    end = F.col("pos") + F.char_length("ref") - 1
    bams = reads.select("chrom", "bam").distinct()
    ask = lambda b, point, begun, held: F.struct(b.cast("long").alias("_bin"), point.cast("long").alias("_at"), begun.alias("_ask_begun"), held.alias("_ask_held"))
    single = F.array(ask(at(F.col("pos")), F.col("pos"), F.lit(True), F.lit(True)))
    # an event of several positions asks for beginnings in each bin up to its end
    parts = F.concat(F.array(ask(at(F.col("pos")), F.col("pos"), F.lit(False), F.lit(True))), F.transform(F.sequence(at(F.col("pos")), at(end)), lambda b: ask(b, F.least(end, (b + 1) * width - 1), F.lit(True), F.lit(False))))
    asked = events.filter(F.col("pos") <= end).withColumn("_event", F.struct(*events.columns)).select("chrom", "_event", F.explode(F.when(F.col("pos") == end, single).otherwise(parts)).alias("_a")).select("chrom", "_event", "_a.*")
    # a row for each sample and chromosome
    asked = asked.join(F.broadcast(bams), "chrom")
    rows = steps.unionByName(asked, allowMissingColumns=True)
    before = Window.partitionBy(*where).orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("_event", "bam", "_ask_begun", "_ask_held", *[F.sum(c).over(before).alias(c) for c in sums]).filter("_event IS NOT NULL")
    total = lambda x: sum(F.when(F.col(f"_ask{kind}"), F.coalesce(f"{kind}_{x}", F.lit(0))).otherwise(0) for kind in ("_begun", "_held"))
    return rows.select("_event.*", "bam", total("n").alias("reads"), total("m").alias("mapqs"), total("q").alias("mapq_sum"))


def event_read_summary(reads: DataFrame, keys: list[str], around: DataFrame | None = None) -> DataFrame:
    """keys, ref_reads, alt_reads, other_reads, alt_fraction (null without either), alt reads by strand and mate, mean mapq and base quality.

    reads: keys, class, flag, mapq, base_quality (null if there is none).
    around: keys, reads, mapqs, mapq_sum as of reads_around; reads then needs
    only those that can show the event, and all others count as other.
    """
    alt, ref = F.col("class") == "EXACT_ALT", F.col("class") == "CLEAN_REFERENCE"

    def bit(mask: int) -> Column:
        return F.col("flag").bitwiseAND(F.lit(mask)) != 0

    counts = ("reads", "mapqs", "mapq_sum")
    if around is not None:
        reads = reads.select(*keys, "class", "flag", "base_quality").unionByName(around.select(*keys, *counts), allowMissingColumns=True)
    n = reads.groupBy(*keys).agg(
        F.count_if(ref).alias("ref_reads"),
        F.count_if(alt).alias("alt_reads"),
        F.count_if(~alt & ~ref).alias("other_reads"),
        F.count_if(alt & ~bit(16)).alias("alt_forward"),
        F.count_if(alt & bit(16)).alias("alt_reverse"),
        F.count_if(alt & bit(64)).alias("alt_r1"),
        F.count_if(alt & ~bit(64) & bit(128)).alias("alt_r2"),
        *([F.avg("mapq").alias("mean_mapq")] if around is None else [F.coalesce(F.sum(c), F.lit(0)).alias(f"_{c}") for c in counts]),
        F.avg("base_quality").alias("mean_base_quality"),
    )
    if around is not None:
        n = n.filter("_reads > 0").withColumns({"other_reads": F.col("_reads") - F.col("alt_reads") - F.col("ref_reads"), "mean_mapq": F.try_divide(F.col("_mapq_sum"), F.col("_mapqs"))}).drop(*[f"_{c}" for c in counts])
    return n.withColumn("alt_fraction", F.try_divide("alt_reads", F.col("alt_reads") + F.col("ref_reads")))


def allele_read_counts(reads: DataFrame, keys: list[str]) -> DataFrame:
    """keys, alt_reads, ref_reads, depth (both), alt_fraction, alleles ``REF:n;ALT:n``; a read of one name, flag, place and CIGAR counts once, as alternative if any of its rows is, else as reference."""
    # a number is summed up in a hash table, a text would be sorted; of several classes the first counts
    rank = F.when(F.col("class") == "EXACT_ALT", 0).when(F.col("class") == "CLEAN_REFERENCE", 1).otherwise(2)
    rows = reads.groupBy(*keys, "qname", "flag", "read_start", "cigar").agg(F.min(rank).alias("_class"))
    n = rows.groupBy(*keys).agg(F.count_if(F.col("_class") == 0).alias("alt_reads"), F.count_if(F.col("_class") == 1).alias("ref_reads"))
    both = F.col("alt_reads") + F.col("ref_reads")
    return n.withColumns({"depth": both, "alt_fraction": cigar.alt_fraction(F.col("alt_reads"), F.col("ref_reads")), "alleles": F.concat(F.lit("REF:"), F.col("ref_reads").cast("string"), F.lit(";ALT:"), F.col("alt_reads").cast("string"))})


def wanted_features(features: DataFrame, genes: DataFrame) -> DataFrame:
    """Features of wanted genes alone."""
    return features.join(genes.select("gene").distinct(), "gene", "left_semi")


def class_code_lines(lines: DataFrame, codes: tuple[str, ...] = ("j", "u")) -> DataFrame:
    """All lines of transcripts whose transcript line has an allowed class code; lines: feature, transcript, attributes."""
    kept = lines.filter((F.col("feature") == "transcript") & F.try_element_at("attributes", F.lit("class_code")).isin(*codes)).select("transcript").distinct()
    return lines.join(kept, "transcript", "left_semi")


# --- evidence rows -------------------------------------------------------------


def annotated_events(events: DataFrame, annotations: DataFrame, *, match_alt: bool = False) -> DataFrame:
    """events (sample, chrom, pos, ref, alt, transcript) with struct ``note`` of the peptide annotations at the same place and transcript, null if none.

    Transcripts are compared without version.  The alternative allele is no part of
    the key, but with match_alt.  Of annotations alike in sequence, transcript,
    hgvsp and header one stands.
    """
    key = ["sample", "chrom", "pos", "ref", *(["alt"] if match_alt else [])]
    plain = F.substring_index("transcript", ".", 1).alias("_t")
    notes = annotations.select(*key, plain, F.struct(*[F.col(c) for c in annotations.columns if c not in ("chrom", "pos", "ref", "alt")]).alias("note"))
    rows = events.withColumn("_t", plain).join(notes, [*key, "_t"], "left").drop("_t")
    identity = [F.col(f"note.{c}") for c in ("sequence", "transcript", "hgvsp", "header")]
    best = Window.partitionBy("sample", "chrom", "pos", "ref", "alt", "transcript", *identity).orderBy("note")
    return rows.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")


PEPTIDE_SETS = ("all_peptides", "altered", "search_consistent", "canonical_absent", "reference_absent", "both_absent", "user_filtered")


def variant_evidence_rows(events: DataFrame, annotations: DataFrame, mapping: DataFrame, spectra: DataFrame, *, min_length: int = 0, user: Column | None = None, match_alt: bool = False) -> DataFrame:
    """One row per event (sample, chrom, pos, ref, alt): genes, transcripts, consequences, seven peptide sets, direct and transferred samples, category.

    events: a row per consequence, with transcript, gene, consequence;
    annotations: sample, chrom, pos, ref, transcript, hgvsp, header, sequence,
    status, msms, in_reference (yes, no or unknown); mapping: sequence,
    canonical_absent; spectra: sequence, sample, direct, clean.  user is a
    condition on annotation columns.
    """
    key = ["sample", "chrom", "pos", "ref", "alt"]
    clean = spectra.groupBy("sequence").agg(F.bool_or(F.col("direct") & F.col("clean")).alias("_clean"))
    notes = annotations.withColumn("sequence", F.upper("sequence")).join(mapping.select("sequence", "canonical_absent"), "sequence", "left").join(clean, "sequence", "left")
    notes = notes.withColumn("_user", F.lit(True) if user is None else F.coalesce(user, F.lit(False)))
    rows = annotated_events(events, notes, match_alt=match_alt)
    n, sequence = F.col("note"), F.when(F.coalesce("note.sequence", F.lit("")) != "", F.col("note.sequence"))
    altered = F.coalesce(n["status"].startswith("VALIDATED_"), F.lit(False))
    canonical, reference = F.coalesce(n["canonical_absent"], F.lit(False)), n["in_reference"].isin("no", "unknown")
    consistent = (F.char_length("note.sequence") >= min_length) & (n["msms"] >= 1) & F.coalesce(n["_clean"], F.lit(False))
    when = dict(zip(PEPTIDE_SETS, [F.lit(True), altered, altered & consistent, altered & canonical, altered & reference, altered & canonical & reference, altered & n["_user"]], strict=True))
    sets = [F.array_sort(F.collect_set(F.when(F.coalesce(c, F.lit(False)), sequence))).alias(name) for name, c in when.items()]
    out = rows.groupBy(*key).agg(*[F.array_sort(F.collect_set(c)).alias(f"{c}s") for c in ("gene", "transcript", "consequence")], *sets)
    # a peptide has many spectra but few samples: these meet the events
    kinds = {"direct_samples": F.col("direct"), "transferred_samples": ~F.col("direct")}
    of_peptide = spectra.groupBy("sequence").agg(*[F.collect_set(F.when(c, F.col("sample"))).alias(name) for name, c in kinds.items()])
    seen = out.select(*key, F.explode("altered").alias("sequence")).join(of_peptide, "sequence")
    seen = seen.groupBy(*key).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_set(name)))).alias(name) for name in kinds])
    out = out.join(seen, key, "left")
    empty = F.array().cast("array<string>")
    out = out.withColumns({c: F.coalesce(c, empty) for c in ("direct_samples", "transferred_samples")}).withColumn("only_transferred", F.array_except("transferred_samples", "direct_samples"))
    kind = F.when(F.size("altered") > 0, "ALTERED_RESIDUE").when(F.size("all_peptides") > 0, "PEPTIDE_BESIDE_CHANGE").otherwise("RNA_ONLY")
    return out.withColumns({"category": kind, "classes": rules.evidence_classes(F.array("sample"), F.col("direct_samples"), F.col("only_transferred"))})


def junction_evidence_rows(rows: DataFrame, spectra: DataFrame) -> DataFrame:
    """One row per (sequence, junction, reference_status, support, left, right) of peptides that span a junction: source samples, direct and transferred samples, classes.

    rows: those columns, sample and spanning; spectra: sequence, sample, direct.
    """
    key = ["sequence", "junction", "reference_status", "support", "left", "right"]
    found = rows.filter("spanning").withColumn("sequence", F.upper("sequence")).groupBy(*key).agg(F.array_sort(F.collect_set("sample")).alias("source_samples"))
    seen = spectra.groupBy("sequence").agg(F.array_sort(F.collect_set(F.when(F.col("direct"), F.col("sample")))).alias("direct_samples"), F.array_sort(F.collect_set(F.when(~F.col("direct"), F.col("sample")))).alias("transferred_samples"))
    out = found.join(seen, "sequence", "left")
    empty = F.array().cast("array<string>")
    out = out.withColumns({c: F.coalesce(c, empty) for c in ("direct_samples", "transferred_samples")}).withColumn("only_transferred", F.array_except("transferred_samples", "direct_samples"))
    return out.withColumn("classes", rules.evidence_classes(F.col("source_samples"), F.col("direct_samples"), F.col("only_transferred")))


# --- hypotheses ----------------------------------------------------------------


def hypotheses(measures: list[tuple[DataFrame, dict[str, Column]]], claims: list[tuple[str, Column, Column]]) -> DataFrame:
    """hypothesis, conclusion, one row per claim.

    measures: tables and named aggregates of each, one row together; claims:
    name, whether it is supported and whether it can be told, from those names.
    """
    one = reduce(lambda a, b: a.join(F.broadcast(b)), [df.agg(*[c.alias(n) for n, c in named.items()]) for df, named in measures])
    rows = F.array(*[F.struct(F.lit(name).alias("hypothesis"), rules.hypothesis_gate(F.coalesce(yes, F.lit(False)), F.coalesce(told, F.lit(False))).alias("conclusion")) for name, yes, told in claims])
    return one.select(F.explode(rows).alias("h")).select("h.*")


# --- checks between tables -----------------------------------------------------


def merge_invariant(rows: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: failed rows (primary_failure set), the failure table's total (count), whether they are equal."""
    a, b = rows.agg(F.count("primary_failure").alias("failed")), failures.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("counted"))
    return a.join(F.broadcast(b)).withColumn("equal", F.col("failed") == F.col("counted"))


def strict_consistency(everything: DataFrame, strict: DataFrame) -> DataFrame:
    """One row: rows marked strict among all, rows of the strict table, whether they are equal."""
    a, b = everything.agg(F.count_if("strict").alias("marked")), strict.agg(F.count("*").alias("listed"))
    return a.join(F.broadcast(b)).withColumn("equal", F.col("marked") == F.col("listed"))


def expected_pairs(samples: DataFrame) -> DataFrame:
    """One row: how many follow-ups subjects (subject, sample, baseline) with exactly one baseline have."""
    n = samples.groupBy("subject").agg(F.count_if("baseline").alias("b"), F.count_if(~F.col("baseline")).alias("f"))
    return n.agg(F.coalesce(F.sum(F.when(F.col("b") == 1, F.col("f"))), F.lit(0)).alias("expected"))


def select_type(df: DataFrame, kind: str) -> DataFrame:
    """Rows (ref, alt) of one kind: SNP, or INDEL for everything of other lengths."""
    snv = alleles.allele_type(F.col("ref"), F.col("alt")) == "SNV"
    return df.filter(snv) if kind == "SNP" else df.filter(F.char_length("ref") != F.char_length("alt"))


def merge_filtered(df: DataFrame, out: str = "filter") -> DataFrame:
    """Both branches, each with the filters of its kind, as one table again; rows that are neither SNP nor INDEL leave."""
    return rules.hard_filter(select_type(df, "SNP"), rules.SNP_FILTERS, out).unionByName(rules.hard_filter(select_type(df, "INDEL"), rules.INDEL_FILTERS, out))
