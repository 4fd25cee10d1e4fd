"""Composite jobs: operators put together as the reference workflow's stages are.

Each takes and returns DataFrames; a job is one lazy plan, and a sample is a
column of it, not a process.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import alleles, cigar, sequences, units
from tallyloom.functions.lineage import checkpointed
from tallyloom.operators import aggregates, enrichment, evidence, joins, reports, rules, sets, windows


def rna_variant_validation(calls: DataFrame, genome: DataFrame, fields: list[str], consequences: tuple[str, ...] = rules.RNA_ALTERING, **bounds) -> DataFrame:
    """calls (sample, chrom, pos, ref, alt, filter, info, format) with genome_ref, failure_codes, status, observed."""
    ad = F.transform(F.split(F.try_element_at("format", F.lit("AD")), ","), lambda x: x.try_cast("int"))
    depth = F.coalesce(F.try_element_at("format", F.lit("DP")).try_cast("int"), F.lit(0))
    values = F.transform(F.split(F.coalesce(F.try_element_at("info", F.lit("CSQ")), F.lit("")), ","), lambda a: F.split(a, r"\|"))
    term = fields.index("Consequence")
    altering = F.exists(values, lambda a: rules.protein_altering(F.get(a, F.lit(term)), consequences))
    rows = joins.genome_slice(calls.withColumn("length", F.char_length("ref")), genome).drop("length")
    rows = rows.withColumns({"alt_reads": F.coalesce(F.array_max(F.slice(ad, 2, 1000)), F.lit(0)), "depth": depth, "altering": altering})
    found = rules.variant_rules(filter_=F.col("filter"), alt_count=F.size(F.split("alt", ",")), ref=F.col("ref"), genome_ref=F.col("genome_ref"), depth=F.col("depth"), alt_reads=F.col("alt_reads"), altering=F.col("altering"), **bounds)
    return audited(rules.with_rules(rows, found), DP=F.col("depth"), ALT=F.col("alt_reads"), FILTER=F.col("filter"))


def audited(rows: DataFrame, passed: str = "Passed all rules", **seen: Column) -> DataFrame:
    """rows (failure_codes) with explanation and observed evidence."""
    return rows.withColumns({"explanation": rules.explain(F.col("failure_codes"), passed), "observed": units.observed(**seen)})


def rna_fusion_validation(fusions: DataFrame, **bounds) -> DataFrame:
    """fusions with distinct read names, failure_codes, status, observed."""
    names = F.array_distinct(F.filter(F.transform(F.split("read_identifiers", ","), lambda x: F.trim(x)), lambda x: x != ""))
    rows = fusions.withColumns({"read_identifiers": F.array_join(names, ","), "unique_supporting_read_names": F.coalesce(F.size(names), F.lit(0))})
    return audited(rules.with_rules(rows, rules.fusion_rules(**bounds)), SPLIT=F.coalesce("split_reads1", F.lit(0)) + F.coalesce("split_reads2", F.lit(0)), CONFIDENCE=F.col("confidence"), FRAME=F.col("reading_frame"))


def rna_splice_validation(exons: DataFrame, reads: DataFrame, min_reads: int = 3) -> DataFrame:
    """transcript, n_junctions, counts, min_support, failure_codes, status; transcripts of one exon have no junction."""
    counts = aggregates.junction_counts(reads.withColumnRenamed("rname", "chrom"), ["chrom"])
    found = aggregates.junction_support(windows.exon_junctions(exons), counts)
    rows = exons.select("transcript").distinct().join(found, "transcript", "left").na.fill(0, ["n_junctions", "min_support"])
    return audited(rules.with_rules(rows, rules.splice_rules(min_reads)), JUNCTIONS=F.col("n_junctions"), MIN=F.col("min_support"))


#: Mapping quality that a read needs to say something.
MIN_MAPQ = 20


def classified_reads(reads: DataFrame, variants: DataFrame, *, width: int = 1024, min_mapq: int = MIN_MAPQ, min_baseq: int = 20, pad: int = 0, across: bool = False) -> DataFrame:
    """reads that overlap a variant of their sample, with class, reason, observed and base_quality (of its first base); a read of one name, flag, place and CIGAR counts once.

    reads: sample, qname, flag, rname, pos, mapq, cigar, seq, qual; variants:
    sample, chrom, pos, ref, alt.  across: every sample's reads meet every
    variant, and bam is the read's sample.
    """
    left = reads.select(*_read_place(), "qname", "flag", "mapq", "cigar", "seq", "qual")
    right = variants.select("sample", alleles.norm_chrom(F.col("chrom")).alias("chrom"), F.col("pos").alias("start"), (F.col("pos") + F.char_length("ref") - 1).alias("end"), "ref", "alt")
    keys = ["chrom"] if across else ["sample", "chrom"]
    both = joins.range_join(left, right, keys, width, pad=pad, alike=["qname", "flag", "cigar"], with_bins=True)
    bins = joins.range_bins(keys)
    rows = both.select(*bins, F.col("r.sample").alias("sample"), F.col("l.sample").alias("bam"), F.col("l.chrom").alias("chrom"), F.col("r.start").alias("pos"), "r.ref", "r.alt", "l.qname", "l.flag", F.col("l.start").alias("read_start"), F.col("l.end").alias("_read_end"), "l.cigar", "l.mapq", "l.seq", "l.qual")
    fields = {c: F.col(c) for c in ("flag", "mapq", "cigar", "seq", "qual", "pos", "ref", "alt")}
    rows = cigar.with_read_class(rows, "k", start=F.col("read_start"), end=F.col("_read_end"), min_mapq=min_mapq, min_baseq=min_baseq, **fields)
    first = F.split_part("k.quality", F.lit(";"), F.lit(1)).try_cast("int")
    rows = rows.select("*", "k.class", "k.reason", "k.observed", F.when(first >= 0, first).alias("base_quality")).drop("k", "seq", "qual", "_read_end", *([] if across else ["bam", "mapq"]))
    # with the bins, by which the pairs lie already, rows needn't travel again
    return rows.dropDuplicates([*bins, "sample", *(["bam"] if across else []), "chrom", "pos", "ref", "alt", "qname", "flag", "read_start", "cigar"]).drop(*bins)


ALLELE = ["sample", "chrom", "pos", "ref", "alt"]


def _read_place() -> list[Column]:
    """sample, chrom, start and end of a read."""
    ends = F.greatest(F.col("pos"), cigar.last_position(F.col("cigar"), F.col("pos")))
    return [F.col("sample"), alleles.norm_chrom(F.col("rname")).alias("chrom"), F.col("pos").alias("start"), F.coalesce(ends, F.col("pos")).alias("end")]


def variant_codon_validation(variants: DataFrame, reads: DataFrame, annotations: DataFrame, genome: DataFrame, *, min_alt: int = 3, min_fraction: float = 0.05, chunk: int = 65536) -> DataFrame:
    """One row per variant and annotation with read counts, codon status, failure codes and overall status.

    annotations: ALLELE and codons, amino_acids, consequence, transcript; their
    contigs may be named with or without ``chr``.  genome is in pieces of chunk
    bases.
    """
    annotations = annotations.withColumn("chrom", alleles.norm_chrom(F.col("chrom")))
    reads_by = read_counts(classified_reads(reads, variants))
    rows = joins.genome_slice(variants.withColumn("length", F.char_length("ref")), genome, chunk).drop("length").withColumn("chrom", alleles.norm_chrom(F.col("chrom")))
    rows = rows.join(reads_by, ALLELE, "left").na.fill(0, ["alt_reads", "ref_reads", "excluded_reads"]).join(annotations, ALLELE, "left")
    codon = rules.codon_status(F.col("codons"), F.col("amino_acids"), F.col("consequence"))
    kind = alleles.allele_type(F.col("ref"), F.col("alt"))
    comparable = kind.isin("SNV", "INSERTION", "DELETION")
    rows = rows.withColumns(
        {
            "alt_fraction": F.try_divide("alt_reads", F.col("alt_reads") + F.col("ref_reads")),
            "genome_status": F.when(F.col("genome_ref") == F.upper("ref"), "GENOME_REF_VALIDATED").otherwise("GENOME_REF_MISMATCH"),
            "codon_status": codon["status"],
            "codon_eligible": codon["eligible"],
        }
    )
    rows = rows.withColumn("read_status", rules.read_status(comparable, F.col("alt_reads"), F.col("alt_fraction"), min_alt, min_fraction))
    return rules.variant_evidence(rows)


def read_counts(classified: DataFrame) -> DataFrame:
    """ALLELE with alt_reads, ref_reads, excluded_reads."""
    kinds = {"alt_reads": "EXACT_ALT", "ref_reads": "CLEAN_REFERENCE", "excluded_reads": "EXCLUDED"}
    return classified.groupBy(*ALLELE).agg(*[F.count_if(F.col("class") == k).alias(n) for n, k in kinds.items()])


def variant_read_provenance(reads: DataFrame, variants: DataFrame) -> DataFrame:
    """Reads for an allele with mate, strand, place in the read and alignment end."""
    rows = classified_reads(reads, variants).filter(F.col("class") == "EXACT_ALT")
    where = cigar.provenance(F.col("flag"), cigar.blocks(F.col("cigar"), F.col("read_start")), F.col("read_start"), F.col("pos"))
    found = rows.withColumn("p", where).select(*ALLELE, "qname", "p.mate", "p.strand", "p.read_position", "p.alignment_end")
    # a sort samples its rows first, and would join twice
    return checkpointed(found).orderBy("sample", *windows.chromosome_order(), "pos", "qname")


def codon_mismatch_report(rows: DataFrame) -> DataFrame:
    """rows (chrom, ref, alt, codons, amino_acids, consequence) with category and whether it needs a look by hand."""
    pair = [F.split_part(F.upper(F.col(c)), F.lit("/"), F.lit(k)) for c in ("codons", "amino_acids") for k in (1, 2)]
    category = rules.mismatch_diagnosis(F.col("chrom"), F.col("ref"), F.col("alt"), *pair, F.col("consequence"))
    return rows.withColumn("category", category).withColumn("needs_manual_review", F.col("category").isin("UNEXPLAINED_TRANSLATION_MISMATCH", "CODON_CHANGE_INCONSISTENT_WITH_VCF_ALLELES"))


def progression_analysis(variants: DataFrame, samples: DataFrame, gene_sets: DataFrame, background: DataFrame | None = None) -> dict[str, DataFrame]:
    """partition, genes, enrichment and contrasts of variants (sample, chrom, pos, ref, alt, gene, impact) by samples (subject, sample, baseline).

    background: gene, of the calls that a new variant is measured against; all
    variants' genes without it.
    """
    key = ["chrom", "pos", "ref", "alt"]
    rows = variants.join(samples, "sample")
    split = sets.baseline_partition(rows, "subject", key, "baseline")
    new = rows.join(split.filter("partition = 'nonbaseline_only'"), ["subject", *key], "left_semi").filter("NOT baseline")
    pairs = sets.sample_pairs(samples, "subject", "sample")
    sides = [variants.select(F.col("sample").alias(s), *key).distinct().join(pairs, s) for s in ("a", "b")]
    both = sides[0].withColumn("_a", F.lit(1)).join(sides[1].withColumn("_b", F.lit(1)), ["subject", "a", "b", *key], "full")
    kind = F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), "shared").when(F.col("_a").isNotNull(), "A_only").otherwise("B_only")
    return {
        "partition": split,
        "genes": aggregates.progression_genes(new),
        "enrichment": enrichment.over_representation(new.select("sample", "gene"), (variants if background is None else background).select("gene"), gene_sets, keys=["sample"]),
        "contrasts": both.select("subject", "a", "b", *key, kind.alias("contrast")),
    }


def expression_go(counts: DataFrame, exons: DataFrame, samples: DataFrame, gene_sets: DataFrame) -> dict[str, DataFrame]:
    """matrix, summary, per-sample enrichment of expressed genes, ranked tests against the baseline, skipped subjects."""
    matrix = aggregates.expression_matrix(counts, aggregates.gene_model(exons))
    expressed = matrix.filter(rules.gene_expressed(F.col("cpm"), F.col("tpm")))
    pairs = sets.baseline_pairs(samples, "subject", "sample", "baseline")
    fold = aggregates.gene_fold_change(matrix, pairs)
    return {
        "matrix": matrix,
        "summary": aggregates.expression_summary(counts),
        "enrichment": enrichment.over_representation(expressed.select("sample", "gene"), matrix.select("gene"), gene_sets, keys=["sample"]),
        "ranked": enrichment.ranked_set_test(fold.select("base", "followup", "gene", F.col("log2_fc").alias("score")), gene_sets, keys=["base", "followup"]),
        "skipped": samples.groupBy("subject").agg(F.count_if("baseline").alias("n")).filter("n <> 1").select("subject", F.lit("SKIPPED").alias("status")),
    }


def go_annotation_closure(annotations: DataFrame, edges: DataFrame, terms: DataFrame) -> DataFrame:
    """gene, term, name, namespace of annotations (gene, term) and all their ancestors."""
    up = joins.closure(edges).withColumnsRenamed({"node": "term", "ancestor": "up"})
    rows = annotations.join(up, "term", "left").select("gene", F.coalesce("up", "term").alias("id")).union(annotations.select("gene", "term")).distinct()
    return rows.join(terms, "id").select("gene", F.col("id").alias("term"), "name", "namespace")


def peptide_mapping(peptides: DataFrame, proteins: DataFrame, *, merge_il: bool = False, seed: int = 7) -> DataFrame:
    """peptides (sequence, pep, score, msms) with counts by protein class and whether they are novel of high confidence.

    proteins: header, sequence.
    """
    classes = ["CANONICAL", "VARIANT", "FUSION", "SPLICE", "PROGRESSION", "CONTAMINANT", "DECOY"]
    clean = peptides.withColumn("pattern", sequences.normalize_sequence(F.col("sequence"), merge_il))
    texts = proteins.select(F.xxhash64("header", "sequence").alias("text_id"), "header", sequences.normalize_sequence(F.col("sequence"), merge_il).alias("text"))
    hits = joins.pattern_join(clean.select(F.col("sequence").alias("pattern_id"), "pattern").distinct(), texts.select("text_id", "text"), seed=seed, first=True)
    hits = hits.join(texts.select("text_id", "header"), "text_id").select(F.col("pattern_id").alias("peptide"), "position", sequences.header_class(F.col("header")).alias("class"), sequences.header_sample(F.col("header")).alias("sample"))
    rows = peptides.join(evidence.peptide_summary(hits, classes).withColumnRenamed("peptide", "sequence"), "sequence", "left")
    good = rules.high_confidence_peptide(F.col("pep"), F.col("score"), F.col("msms"), F.col("sequence"), F.coalesce("absent_from_canonical", F.lit(False)))
    return rows.withColumn("high_confidence", good & (F.coalesce("novel_classes", F.lit("")) != ""))


def caller_comparison(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Allele sets and metrics of two callers' tables (chrom, pos, ref, alt, gt): split, trimmed and named alike."""

    def normal(df: DataFrame) -> DataFrame:
        rows = alleles.split_multiallelic(df.withColumn("chrom", alleles.norm_chrom(F.col("chrom"))))
        return alleles.trim_allele(rows.withColumn("dosage", alleles.alt_dosage(F.col("gt"), F.col("allele_index"))))

    found = sets.caller_sets(normal(left), normal(right), ["chrom", "pos", "ref", "alt"], "dosage")
    return found, sets.caller_metrics(found)


def finding_review(reads: DataFrame, variants: DataFrame, limits: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Counts of each event's reads, and the reads to display: as a report, some of each class."""
    limits = limits or {"EXACT_ALT": 100, "CLEAN_REFERENCE": 20, "EXCLUDED": 100}
    rows = classified_reads(reads, variants, pad=2)
    most = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in limits.items() for x in p]), F.col("class")), F.lit(0))
    shown = windows.cap_per_group(rows, [*ALLELE, "class"], ["qname", "flag", "read_start"], most)
    shown = shown.withColumn("alignment_key", sequences.alignment_key(*[F.col(c) for c in ("qname", "chrom", "read_start", "flag", "cigar", "class")]))
    n = read_counts(rows)
    return n.withColumns({"status": cigar.evidence_status(F.col("alt_reads"), F.col("ref_reads")), "alt_fraction": cigar.alt_fraction(F.col("alt_reads"), F.col("ref_reads"))}), shown


def event_catalogue(variants: DataFrame, fusions: DataFrame, junctions: DataFrame) -> DataFrame:
    """event, class, chrom, start0, end0 and a second place of variants, fusions (breakpoints ``chr:pos``) and junctions."""

    def place(c: str, k: int) -> Column:
        return F.split_part(F.col(c), F.lit(":"), F.lit(k))

    none = F.lit(None)
    v = variants.select(sequences.safe_id(*[F.col(c) for c in ALLELE]).alias("event"), F.lit("rna_variant").alias("class"), "chrom", (F.col("pos") - 1).alias("start0"), (F.col("pos") - 1 + F.char_length("ref")).alias("end0"), none.cast("string").alias("chrom2"), none.cast("bigint").alias("start2_0"), none.cast("bigint").alias("end2"))
    one, two = (place(f"breakpoint{k}", 2).try_cast("bigint") for k in (1, 2))
    f = fusions.select(sequences.safe_id(F.col("gene1"), F.col("gene2"), F.col("breakpoint1"), F.col("breakpoint2")), F.lit("fusion"), place("breakpoint1", 1), one - 1, one, place("breakpoint2", 1), two - 1, two)
    j = junctions.select(sequences.safe_id(F.col("transcript"), F.col("start"), F.col("end")), F.lit("splice_junction"), "chrom", F.col("start") - 1, F.col("end"), none.cast("string"), none.cast("bigint"), none.cast("bigint"))
    return v.union(f).union(j)


def complete_audit(audits: DataFrame) -> dict[str, DataFrame]:
    """classes and failure codes of all audits (event_type, status, failure_codes)."""
    return {"classes": aggregates.status_counts(audits, ["event_type"], F.col("status") == "RNA_VALIDATED"), "codes": aggregates.code_counts(audits, ["event_type"])}


def biology_review(matrix: DataFrame, samples: DataFrame, gene_sets: DataFrame, expected: DataFrame) -> DataFrame:
    """hypothesis, verdict from expression: expected has hypothesis, gene_set, direction."""
    pairs = sets.baseline_pairs(samples, "subject", "sample", "baseline")
    scores = aggregates.pathway_scores(aggregates.gene_fold_change(matrix, pairs), gene_sets)
    rows = scores.join(expected, "gene_set")
    status = rules.pathway_verdict(F.col("genes"), F.col("median"), F.col("up_fraction"), F.col("down_fraction"), F.col("direction"))
    n = pairs.select("followup").distinct().count()
    return rules.hypothesis_verdicts(rows.withColumn("status", status), n)


def last_rows(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key: what a later row replaces goes."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def stage_qc(records: DataFrame, keys: list[str]) -> DataFrame:
    """keys with alleles, kinds, Ti/Tv, contigs, multiallelic alleles, filter counts of records (chrom, ref, alt with ``,``, filter)."""
    rows = alleles.split_multiallelic(records.withColumn("n_alts", F.size(F.split("alt", ","))))
    n = aggregates.stage_summary(rows, keys)
    multi = rows.groupBy(*keys).agg(F.count_if(F.col("n_alts") > 1).alias("multiallelic"))
    return n.join(multi, keys, "left").join(reports.filter_counts(records, keys), keys, "left")


def proteogenomic_evidence(events: DataFrame, annotations: DataFrame, mapping: DataFrame, spectra: DataFrame, junctions: DataFrame, **options) -> dict[str, DataFrame]:
    """variants and junctions with their evidence, and unique variants over samples; see reports."""
    rows = reports.variant_evidence_rows(events, annotations, mapping, spectra, **options)
    key = ["chrom", "pos", "ref", "alt", "altered"]
    unique = rows.filter(F.size("altered") > 0).groupBy(*key).agg(F.array_sort(F.collect_set("sample")).alias("samples"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("genes")))).alias("genes"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("direct_samples")))).alias("direct_samples"))
    return {"variants": rows, "junctions": reports.junction_evidence_rows(junctions, spectra), "unique": unique}


def proteogenomic_read_validation(reads: DataFrame, variants: DataFrame, features: DataFrame, *, pad: int = 150, width: int = 1024) -> tuple[DataFrame, DataFrame]:
    """Per event and sample of reads a summary, with the number of features (chrom, start, end, gene) at the event; and the reads.

    Every sample's reads around every event are looked at.
    """
    return proteogenomic_read_counts(reads, variants, features, pad=pad, width=width), classified_reads(reads, variants, pad=pad, width=width, across=True)


def proteogenomic_read_counts(reads: DataFrame, variants: DataFrame, features: DataFrame, *, pad: int = 150, width: int = 1024) -> DataFrame:
    """The summary alone: what a read says is asked only where it can show the event; those around are but counted, without pairs."""
    keys = [*ALLELE, "bam"]
    good = cigar.primary(F.col("flag"), F.coalesce("mapq", F.lit(0)), MIN_MAPQ)
    near = classified_reads(reads.filter(good), variants, width=width, across=True)
    events = variants.select("sample", alleles.norm_chrom(F.col("chrom")).alias("chrom"), "pos", "ref", "alt").distinct()
    placed = reads.select(*_read_place(), "qname", "flag", "cigar", "mapq")
    around = reports.reads_around(placed.withColumnRenamed("sample", "bam"), events, pad)
    places = events.select("chrom", F.col("pos").alias("start"), F.col("pos").alias("end")).distinct()
    known = features.select(alleles.norm_chrom(F.col("chrom")).alias("chrom"), "start", "end", "gene")
    at = joins.range_join(places, known, ["chrom"], width).groupBy(F.col("l.chrom").alias("chrom"), F.col("l.start").alias("pos")).agg(F.count("*").alias("features"))
    return reports.event_read_summary(near, keys, around).join(at, ["chrom", "pos"], "left").na.fill(0, ["features"])


def splice_junction_validation(proteins: DataFrame, exons: DataFrame, peptides: DataFrame, *, min_anchor: int = 2) -> dict[str, DataFrame]:
    """junctions that peptides span, one choice for each peptide and transcript, and proteins without a model, with the reason.

    proteins: header, sequence; exons: transcript, chrom, strand, start, end;
    peptides: peptide.  A header's transcript and reading frame say where the
    protein begins in the transcript.
    """
    parsed = proteins.withColumn("h", sequences.splice_header(F.col("header"))).select("header", "sequence", "h.*")
    known = exons.select("transcript").distinct().withColumn("_known", F.lit(True))
    parsed = parsed.join(known, "transcript", "left")
    reason = F.when(F.coalesce("transcript", F.lit("")) == "", "NO_TRANSCRIPT_IN_HEADER").when(F.col("orf_start").isNull(), "NO_READING_FRAME").when(F.col("_known").isNull(), "TRANSCRIPT_NOT_IN_MODEL")
    parsed = parsed.withColumn("reason", reason)
    usable = parsed.filter("reason IS NULL").withColumn("text_id", F.xxhash64("header", "sequence"))
    wanted = peptides.select(F.col("peptide").alias("pattern_id"), F.col("peptide").alias("pattern")).distinct()
    hits = joins.pattern_join(wanted, usable.select("text_id", F.col("sequence").alias("text")))
    hits = hits.join(usable.select("text_id", "transcript", "orf_start"), "text_id").select(F.col("pattern_id").alias("peptide"), "transcript", "orf_start", F.col("position").alias("start"))
    spans = windows.junction_phase(windows.exon_junctions(exons, by_strand=True).withColumnsRenamed({"start": "intron_start", "end": "intron_end"}), hits, min_anchor)
    choice = windows.occurrence_choice(spans.withColumn("validated", F.col("spanning")), ["peptide", "transcript"])
    return {"spans": spans, "choice": choice, "unresolved": parsed.filter("reason IS NOT NULL").select("header", "reason")}


def ms_hypotheses(variants: DataFrame, junctions: DataFrame, integrated: DataFrame, failures: DataFrame) -> DataFrame:
    """hypothesis, conclusion over evidence tables: altered peptides, novel ones, sample-matched spectra, strict rows, junctions.

    variants and junctions as of proteogenomic_evidence; integrated: strict;
    failures: the failed tasks, of which there must be none.
    """
    matched = F.col("classes.sample_specific")
    measures = [
        (variants, {"events": F.count("*"), "altered": F.count_if(F.size("altered") > 0), "novel": F.count_if(F.size("both_absent") > 0), "matched": F.count_if(matched)}),
        (junctions, {"junctions": F.count("*"), "novel_junctions": F.count_if(F.col("reference_status") == "novel"), "matched_junctions": F.count_if(matched)}),
        (integrated, {"rows": F.count("*"), "strict": F.count_if("strict")}),
        (failures, {"failed": F.count("*")}),
    ]
    claims = [
        ("ALTERED_PEPTIDES", F.col("altered") > 0, (F.col("events") > 0) & (F.col("failed") == 0)),
        ("NOVEL_PEPTIDES", F.col("novel") > 0, F.col("events") > 0),
        ("SAMPLE_MATCHED_SPECTRA", F.col("matched") > 0, F.col("events") > 0),
        ("STRICT_EVENTS", F.col("strict") > 0, F.col("rows") > 0),
        ("NOVEL_JUNCTIONS", F.col("novel_junctions") > 0, F.col("junctions") > 0),
        ("SAMPLE_MATCHED_JUNCTIONS", F.col("matched_junctions") > 0, F.col("junctions") > 0),
    ]
    return reports.hypotheses(measures, claims)
