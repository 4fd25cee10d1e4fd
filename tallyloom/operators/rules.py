"""Rule classifiers: failure codes, verdicts and filters as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import sequences

#: What a failure code means.
FAILURE_TEXT = {
    "VCF_FILTER_NOT_PASS": "The record did not pass the upstream filter.",
    "MULTIALLELIC_REQUIRES_NORMALIZATION": "The record holds several alternative alleles; support can't be assigned to one.",
    "REFERENCE_ALLELE_MISMATCH": "The reference allele differs from the genome.",
    "REFERENCE_LOOKUP_FAILED": "The genome has no sequence at this place.",
    "RNA_DEPTH_BELOW_MINIMUM": "Read depth is below the minimum.",
    "RNA_ALT_READS_BELOW_MINIMUM": "Reads for the alternative allele are below the minimum.",
    "RNA_ALT_FRACTION_BELOW_MINIMUM": "The alternative allele's share is below the minimum.",
    "NO_SUPPORTED_PROTEIN_ALTERING_CONSEQUENCE": "No consequence changes a protein.",
    "MISSING_BREAKPOINT": "A breakpoint is missing.",
    "SPLIT_READS_BELOW_MINIMUM": "Split reads are below the minimum.",
    "TOTAL_SUPPORT_BELOW_MINIMUM": "All supporting reads are below the minimum.",
    "LOW_CONFIDENCE": "The caller has low confidence.",
    "NOT_IN_FRAME": "The fusion is not in frame.",
    "NO_EXON_JUNCTION": "The transcript has no junction.",
    "JUNCTION_READS_BELOW_MINIMUM": "A junction has too few reads.",
}

#: Consequences that change a protein.
PROTEIN_ALTERING = (
    "missense_variant",
    "frameshift_variant",
    "inframe_insertion",
    "inframe_deletion",
    "stop_gained",
    "stop_lost",
    "start_lost",
    "protein_altering_variant",
    "splice_acceptor_variant",
    "splice_donor_variant",
)

#: Those of them that the rules on RNA calls ask for.
RNA_ALTERING = tuple(x for x in PROTEIN_ALTERING if x != "protein_altering_variant")

#: Hard filters by kind of variant: name, field, whether it fails above or below, bound.
SNP_FILTERS = (("QD2", "QD", "<", 2.0), ("FS60", "FS", ">", 60.0), ("SOR3", "SOR", ">", 3.0), ("MQ40", "MQ", "<", 40.0), ("MQRankSum-12.5", "MQRankSum", "<", -12.5), ("ReadPosRankSum-8", "ReadPosRankSum", "<", -8.0))
INDEL_FILTERS = (("QD2", "QD", "<", 2.0), ("FS200", "FS", ">", 200.0), ("SOR10", "SOR", ">", 10.0), ("ReadPosRankSum-20", "ReadPosRankSum", "<", -20.0))


def failure_codes(rules: list[tuple[str, Column]]) -> Column:
    """Array of the codes whose condition holds, in the rules' order; a null condition doesn't fail."""
    return F.array_compact(F.array(*[F.when(F.coalesce(when, F.lit(False)), code) for code, when in rules]))


def explain(codes: Column, passed: str) -> Column:
    """Texts of an array of codes, or passed for none; a code without a text stands for itself."""
    texts = F.create_map(*[F.lit(x) for pair in FAILURE_TEXT.items() for x in pair])
    return F.when(F.size(codes) == 0, passed).otherwise(F.array_join(F.transform(codes, lambda c: F.coalesce(F.try_element_at(texts, c), c)), "; "))


def with_rules(df: DataFrame, rules: list[tuple[str, Column]], valid: str = "RNA_VALIDATED", invalid: str = "REJECTED") -> DataFrame:
    """df with failure_codes (array), status and primary_failure (the first code or null)."""
    df = df.withColumn("failure_codes", failure_codes(rules))
    return df.withColumns({"status": F.when(F.size("failure_codes") == 0, valid).otherwise(invalid), "primary_failure": F.try_element_at("failure_codes", F.lit(1))})


def variant_rules(*, filter_: Column, alt_count: Column, ref: Column, genome_ref: Column, depth: Column, alt_reads: Column, altering: Column, min_depth: int = 10, min_alt: int = 3, min_fraction: float = 0.05) -> list[tuple[str, Column]]:
    return [
        ("VCF_FILTER_NOT_PASS", ~filter_.isin("PASS", ".")),
        ("MULTIALLELIC_REQUIRES_NORMALIZATION", alt_count > 1),
        ("REFERENCE_ALLELE_MISMATCH", genome_ref != F.upper(ref)),
        ("REFERENCE_LOOKUP_FAILED", genome_ref.isNull()),
        ("RNA_DEPTH_BELOW_MINIMUM", depth < min_depth),
        ("RNA_ALT_READS_BELOW_MINIMUM", alt_reads < min_alt),
        ("RNA_ALT_FRACTION_BELOW_MINIMUM", F.coalesce(F.try_divide(alt_reads, depth), F.lit(0.0)) < min_fraction),
        ("NO_SUPPORTED_PROTEIN_ALTERING_CONSEQUENCE", ~altering),
    ]


def fusion_rules(min_split: int = 1, min_total: int = 2) -> list[tuple[str, Column]]:
    """On breakpoint1, breakpoint2, split_reads1, split_reads2, discordant_mates, confidence, reading_frame."""
    split = F.coalesce("split_reads1", F.lit(0)) + F.coalesce("split_reads2", F.lit(0))
    missing = [F.coalesce(F.col(c), F.lit("")) == "" for c in ("breakpoint1", "breakpoint2")]
    return [
        ("MISSING_BREAKPOINT", missing[0] | missing[1]),
        ("SPLIT_READS_BELOW_MINIMUM", split < min_split),
        ("TOTAL_SUPPORT_BELOW_MINIMUM", split + F.coalesce("discordant_mates", F.lit(0)) < min_total),
        ("LOW_CONFIDENCE", F.lower("confidence") == "low"),
        ("NOT_IN_FRAME", F.lower(F.coalesce("reading_frame", F.lit(""))) != "in-frame"),
    ]


def splice_rules(min_reads: int = 3) -> list[tuple[str, Column]]:
    """On n_junctions and min_support."""
    return [("NO_EXON_JUNCTION", F.col("n_junctions") == 0), ("JUNCTION_READS_BELOW_MINIMUM", (F.col("n_junctions") > 0) & (F.col("min_support") < min_reads))]


def hard_filter(df: DataFrame, filters: tuple, out: str = "filter") -> DataFrame:
    """df with the names of failed filters joined by ``;``, or PASS; a missing value doesn't fail."""
    rules = [(name, F.col(field) < bound if side == "<" else F.col(field) > bound) for name, field, side, bound in filters]
    codes = failure_codes(rules)
    return df.withColumn(out, F.when(F.size(codes) == 0, "PASS").otherwise(F.array_join(codes, ";")))


def protein_altering(consequence: Column, terms: tuple[str, ...] = PROTEIN_ALTERING) -> Column:
    """Whether any term of ``a&b`` is one of the terms."""
    return F.arrays_overlap(F.split(F.coalesce(consequence, F.lit("")), "&"), F.array(*[F.lit(x) for x in terms]))


def codon_status(codons: Column, amino_acids: Column, consequence: Column) -> Column:
    """struct(status, eligible) of an annotation's codons ``aAa/aGa`` and amino acids ``K/R``."""
    codons, amino = F.upper(F.replace(F.coalesce(codons, F.lit("")), F.lit("-"))), F.upper(F.coalesce(amino_acids, F.lit("")))
    ref_codon, alt_codon = F.split_part(codons, F.lit("/"), F.lit(1)), F.split_part(codons, F.lit("/"), F.lit(2))
    ref_aa, alt_aa = F.split_part(amino, F.lit("/"), F.lit(1)), F.split_part(amino, F.lit("/"), F.lit(2))
    ref_t, alt_t = sequences.translate_codon(ref_codon), sequences.translate_codon(alt_codon)
    terms = F.split(F.coalesce(consequence, F.lit("")), "&")
    complex_terms = F.array(*[F.lit(x) for x in ("frameshift_variant", "inframe_insertion", "inframe_deletion", "protein_altering_variant")])

    def out(status: str, eligible: bool) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(eligible).alias("eligible"))

    same = (ref_t == alt_t) & ((ref_aa == "") | (ref_aa == ref_t)) & ((alt_aa == "") | (alt_aa == alt_t))
    return (
        F.when(F.arrays_overlap(terms, complex_terms), out("COMPLEX_CONSEQUENCE_NOT_SINGLE_CODON_COMPARABLE", False))
        .when((F.char_length(ref_codon) != 3) | (F.char_length(alt_codon) != 3) | (ref_t == "") | (alt_t == ""), out("CODON_NOT_SINGLE_TRIPLET", False))
        .when(F.array_contains(terms, "synonymous_variant") & same, out("SYNONYMOUS_CODON_TRANSLATION_CONFIRMED", True))
        .when((ref_aa != "") & (alt_aa != "") & (ref_t == ref_aa) & (alt_t == alt_aa), out("CODON_TRANSLATION_MATCH", True))
        .otherwise(out("CODON_TRANSLATION_MISMATCH", False))
    )


def variant_evidence(df: DataFrame) -> DataFrame:
    """df (genome_status, read_status, codon_status, codon_eligible) with failure_codes, primary_failure, overall_status."""
    rules = [
        (F.col("genome_status"), F.col("genome_status") != "GENOME_REF_VALIDATED"),
        (F.col("read_status"), F.col("read_status") != "ALT_READS_VALIDATED"),
        (F.col("codon_status"), F.col("codon_status") == "CODON_TRANSLATION_MISMATCH"),
    ]
    df = df.withColumn("failure_codes", F.array_compact(F.array(*[F.when(when, code) for code, when in rules])))
    status = F.when(F.size("failure_codes") > 0, "VALIDATION_FAILED").when(F.col("codon_eligible"), "VARIANT_CODON_VALIDATED").otherwise("VARIANT_EVIDENCE_PARTIAL")
    return df.withColumns({"primary_failure": F.try_element_at("failure_codes", F.lit(1)), "overall_status": status})


def read_status(comparable: Column, alt_reads: Column, fraction: Column, min_alt: int = 3, min_fraction: float = 0.05) -> Column:
    return F.when(~comparable, "COMPLEX_ALLELE_NOT_COUNTED").when(alt_reads < min_alt, "ALT_READS_BELOW_MINIMUM").when(fraction < min_fraction, "ALT_FRACTION_BELOW_MINIMUM").otherwise("ALT_READS_VALIDATED")


def mismatch_diagnosis(chrom: Column, ref: Column, alt: Column, ref_codon: Column, alt_codon: Column, ref_aa: Column, alt_aa: Column, consequence: Column) -> Column:
    """Why a codon's translation differs from its annotation: one of ten categories."""
    orientation = sequences.mutation_orientation(ref, alt, ref_codon, alt_codon)
    std = sequences.translate_codon(ref_codon), sequences.translate_codon(alt_codon)
    mito = sequences.translate_codon(ref_codon, True), sequences.translate_codon(alt_codon, True)
    return (
        F.when((F.char_length(ref_codon) != 3) | (F.char_length(alt_codon) != 3), "NON_SINGLE_TRIPLET_NOT_COMPARABLE")
        .when((F.char_length(ref_aa) != 1) | (F.char_length(alt_aa) != 1), "VEP_AMINO_ACID_NOT_SINGLE_SYMBOL")
        .when(F.upper(F.regexp_replace(chrom, "chr", "")).isin("M", "MT") & (mito[0] == ref_aa) & (mito[1] == alt_aa), "MITOCHONDRIAL_CODE_RESOLVES_MISMATCH")
        .when((ref_aa == "U") & (F.upper(ref_codon) == "TGA"), "SELENOCYSTEINE_RECODING")
        .when((std[0] == ref_aa) & (std[1] == alt_aa), "NO_REPRODUCIBLE_MISMATCH")
        .when((std[0] != ref_aa) & (std[1] == alt_aa), "REFERENCE_AMINO_ACID_MISMATCH_ONLY")
        .when((std[0] == ref_aa) & (std[1] != alt_aa), "ALTERNATE_AMINO_ACID_MISMATCH_ONLY")
        .when(F.contains(consequence, F.lit("frameshift_variant")), "FRAMESHIFT_NOT_SINGLE_CODON_COMPARABLE")
        .when(orientation == "CODON_ALLELE_INCONSISTENT", "CODON_CHANGE_INCONSISTENT_WITH_VCF_ALLELES")
        .otherwise("UNEXPLAINED_TRANSLATION_MISMATCH")
    )


def peptide_event(peptide: Column, start: Column, alt_seq: Column, ref_seq: Column, position: tuple[Column, Column], amino_acids: Column, consequence: Column, changes: Column) -> Column:
    """Whether a peptide proves a protein change: the status of a decision list.

    start is 0-based, negative if the peptide isn't in the changed protein;
    changes are the changed spans of alt_seq (see annotation.changed_spans).
    """
    ref_aa, alt_aa = F.split_part(F.upper(amino_acids), F.lit("/"), F.lit(1)), F.split_part(F.upper(amino_acids), F.lit("/"), F.lit(2))
    terms = F.split(F.coalesce(consequence, F.lit("")), "&")
    first, last = position
    end = start + F.char_length(peptide)
    # an empty span, where letters are missing, has to lie inside the peptide
    overlap = F.exists(F.coalesce(changes, F.array().cast("array<struct<low:int,high:int>>")), lambda c: (start < c["high"]) & (end > c["low"]))
    single = F.array_contains(terms, "missense_variant") & (first == last) & (F.char_length(ref_aa) == 1) & (F.char_length(alt_aa) == 1)

    def at(seq: Column, i: Column) -> Column:
        return F.substr(seq, i, F.lit(1))

    out = (
        F.when(start < 0, "PEPTIDE_NOT_FOUND")
        .when(F.coalesce(ref_seq, F.lit("")) == "", "REFERENCE_PROTEIN_UNAVAILABLE")
        .when(single & ((first > F.char_length(ref_seq)) | (first > F.char_length(alt_seq))), "PROTEIN_POSITION_MISMATCH")
        .when(single & (at(ref_seq, first) != ref_aa), "REFERENCE_RESIDUE_MISMATCH")
        .when(single & (at(alt_seq, first) != alt_aa), "ALTERNATE_RESIDUE_MISMATCH")
        .when(single & ~((first - 1 >= start) & (first - 1 < end)), "PEPTIDE_DOES_NOT_COVER_EVENT")
        .when(single & (at(peptide, first - start) != alt_aa), "ALTERNATE_RESIDUE_MISMATCH")
        .when(single, "VALIDATED_SUBSTITUTION")
        .when(~overlap, "PEPTIDE_DOES_NOT_COVER_EVENT")
        .when(F.contains(ref_seq, peptide), "PEPTIDE_PRESENT_IN_REFERENCE")
    )
    #: Consequences in the order in which they decide.
    for term, status in (
        ("inframe_insertion", "VALIDATED_INFRAME_INSERTION"),
        ("inframe_deletion", "VALIDATED_INFRAME_DELETION"),
        ("frameshift_variant", "VALIDATED_FRAMESHIFT_NOVEL_SEQUENCE"),
        ("stop_lost", "VALIDATED_STOP_LOSS_EXTENSION"),
        ("stop_gained", "VALIDATED_STOP_GAIN_JUNCTION"),
    ):
        out = out.when(F.array_contains(terms, term), status)
    return out.otherwise("UNSUPPORTED_EVENT_TYPE")


def high_confidence_peptide(pep: Column, score: Column, msms: Column, sequence: Column, canonical_absent: Column, *, max_pep: float = 0.01, min_score: float = 40, min_msms: int = 2, min_length: int = 8, missing_pep_as_zero: bool = False) -> Column:
    """A missing PEP fails, but with missing_pep_as_zero."""
    kept = pep <= max_pep
    kept = F.coalesce(kept, F.lit(missing_pep_as_zero))
    return kept & F.coalesce(score >= min_score, F.lit(False)) & F.coalesce(msms >= min_msms, F.lit(False)) & (F.char_length(sequence) >= min_length) & canonical_absent


def user_filters(df: DataFrame, bounds: dict[str, tuple[str, float]]) -> DataFrame:
    """Rows that meet all optional bounds: column to (">=" or "<=", value); none means all rows."""
    for column, (side, value) in bounds.items():
        df = df.filter(F.col(column) >= value if side == ">=" else F.col(column) <= value)
    return df


def evidence_classes(rna: Column, direct: Column, transferred: Column) -> Column:
    """struct of sample sets: with RNA and direct evidence, only direct, only transferred, RNA alone; and whether direct evidence is in the RNA's samples alone."""
    both = F.array_intersect(rna, direct)
    return F.struct(
        both.alias("rna_and_direct"),
        F.array_except(direct, rna).alias("direct_only"),
        F.array_except(transferred, direct).alias("transferred_only"),
        F.array_except(rna, F.array_union(direct, transferred)).alias("rna_only"),
        ((F.size(both) > 0) & (F.size(F.array_except(direct, rna)) == 0)).alias("sample_specific"),
    )


def observed_pattern(present: Column, groups: list[str]) -> Column:
    """Of the groups present: for exactly three groups ``X-only``, ``Y+Z`` or ``all-three``, else joined by ``+``."""
    named = F.filter(F.array(*[F.lit(g) for g in groups]), lambda g: F.array_contains(present, g))
    joined = F.array_join(named, "+")
    if len(groups) != 3:
        return F.when(F.size(named) == 0, "none").otherwise(joined)
    return F.when(F.size(named) == 0, "none").when(F.size(named) == 1, F.concat(joined, F.lit("-only"))).when(F.size(named) == 3, "all-three").otherwise(joined)


def gene_expressed(cpm: Column, tpm: Column, min_cpm: float = 1.0, min_tpm: float = 0.0) -> Column:
    return (cpm >= min_cpm) & (tpm >= min_tpm)


def pathway_verdict(detected: Column, median: Column, up_fraction: Column, down_fraction: Column, direction: Column) -> Column:
    """SUPPORT, CONTRADICT, MIXED or INSUFFICIENT_DATA (under 5 genes) for an expected direction."""
    share = F.when(direction == "up", up_fraction).otherwise(down_fraction)
    towards = F.when(direction == "up", median).otherwise(-median)
    return F.when((detected < 5) | median.isNull(), "INSUFFICIENT_DATA").when((towards >= 0.25) & (share >= 0.6), "SUPPORT").when((towards <= -0.25) & (share <= 0.4), "CONTRADICT").otherwise("MIXED")


def hypothesis_verdicts(components: DataFrame, followups: int) -> DataFrame:
    """hypothesis, verdict from components (hypothesis, followup, status): by votes per follow-up, then over them."""
    votes = components.groupBy("hypothesis", "followup").agg(F.count_if(F.col("status") != "INSUFFICIENT_DATA").alias("n"), F.count_if(F.col("status") == "SUPPORT").alias("yes"), F.count_if(F.col("status") == "CONTRADICT").alias("no"))
    need = F.greatest(F.lit(1), F.ceil(F.col("n") / 2))
    each = votes.select("hypothesis", F.when(F.col("n") == 0, "INSUFFICIENT_DATA").when((F.col("yes") >= need) & (F.col("no") == 0), "SUPPORTED").when((F.col("no") >= need) & (F.col("yes") == 0), "CONTRADICTED").otherwise("MIXED").alias("v"))
    n = each.groupBy("hypothesis").agg(F.count_if(F.col("v") != "INSUFFICIENT_DATA").alias("n"), F.count_if(F.col("v") == "SUPPORTED").alias("yes"), F.count_if(F.col("v") == "CONTRADICTED").alias("no"))
    verdict = F.when(F.col("n") == 0, "INSUFFICIENT_DATA").when(F.col("n") < followups, "PARTIAL_DATA").when(F.col("yes") == F.col("n"), "SUPPORTED").when(F.col("no") == F.col("n"), "CONTRADICTED").otherwise("MIXED")
    return n.select("hypothesis", verdict.alias("verdict"))


def hypothesis_gate(supported: Column, evaluable: Column) -> Column:
    return F.when(~evaluable, "NOT_EVALUABLE").when(supported, "SUPPORTED").otherwise("NOT_SUPPORTED")


def design_status(df: DataFrame) -> DataFrame:
    """subject, n_samples, n_baseline, design from samples (subject, sample, baseline); several baselines are an error."""
    n = df.groupBy("subject").agg(F.count("*").alias("n_samples"), F.count_if("baseline").alias("n_baseline"))
    several = F.raise_error(F.concat(F.lit("multiple baselines for "), F.col("subject").cast("string")))
    return n.withColumn("design", F.when(F.col("n_baseline") > 1, several).when(F.col("n_baseline") == 0, "SKIPPED_NO_BASELINE").when(F.col("n_samples") == 1, "NO_NONBASELINE").otherwise("ENABLED"))


def keyword_match(rows: DataFrame, keywords: dict[str, list[str]], text: str = "name", most_fdr: float = 0.1) -> DataFrame:
    """One row for each row and hypothesis with a keyword in its text: hypothesis, keywords, significant.

    keywords is a small table of the caller's.
    """
    known = F.array(*[F.struct(F.lit(h).alias("hypothesis"), F.array(*[F.lit(k) for k in ks]).alias("all")) for h, ks in keywords.items()])
    out = rows.withColumn("_h", F.explode(known)).withColumn("keywords", F.filter(F.col("_h.all"), lambda k: F.contains(F.lower(F.col(text)), F.lower(k))))
    return out.filter(F.size("keywords") > 0).withColumns({"hypothesis": F.col("_h.hypothesis"), "significant": F.col("fdr") <= most_fdr}).drop("_h")
