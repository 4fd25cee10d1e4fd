"""Annotations of alleles, and peptides held against the protein changes that they are said to prove."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import alleles, sequences
from tallyloom.functions.lineage import checkpointed
from tallyloom.operators.rules import peptide_event

#: An annotation's key, and what makes it the better one of several: a protein position, a protein change, amino acids.
PLACE = ["chrom", "pos", "ref", "feature"]
BETTER = ["protein_position", "hgvsp", "amino_acids"]
#: Compared pairs of proteins that a task keeps; then it begins anew.
KEPT_PAIRS = 1000


def changed_spans(df: DataFrame, ref: str = "ref_seq", alt: str = "alt_seq", out: str = "changes") -> DataFrame:
    """df with the spans of alt that differ from ref: array of (low, high), 0-based, high excluded, null if nothing differs.

    Spans lie between the matching blocks: the longest common run first, then
    those on its left and right.  An empty span marks where letters of ref are
    missing.  A task keeps the last pairs that it compared, so that rows of one
    pair that lie together cost one comparison.
    """

    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept: dict[tuple[str, str], list | None] = {}
        for refs, alts in batches:
            found = []
            for pair in zip(refs, alts, strict=True):
                if pair not in kept:
                    if len(kept) >= KEPT_PAIRS:
                        kept.clear()
                    same = None in pair or pair[0] == pair[1]
                    kept[pair] = None if same else [{"low": low, "high": high} for kind, _, _, low, high in SequenceMatcher(None, *pair, autojunk=False).get_opcodes() if kind != "equal"]
                found.append(kept[pair])
            yield pd.Series(found, dtype=object)

    return df.withColumn(out, F.pandas_udf(compare, "array<struct<low:int,high:int>>")(ref, alt))


def annotation_index(annotations: DataFrame) -> DataFrame:
    """PLACE, sample and alt (null: any), best: the best annotation under every key by which an allele may ask.

    annotations: sample, chrom, pos, ref, alts (as the file lists them, by
    ``,``), allele (as the annotation names it), feature and BETTER.  Of several
    the one with a protein position, a protein change, amino acids is the
    better one, then the one that names the allele among those of its row.
    One row a key, so that samples aren't paired with samples.
    """
    known = F.array_union(F.split("alts", ","), F.array("allele"))
    other = lambda x: ~F.array_contains(alleles.annotated_forms(F.col("ref"), x), F.col("allele"))
    keys = F.concat(F.transform(known, lambda x: F.struct(x.alias("alt"), other(x).alias("other"))), F.array(F.struct(F.lit(None).cast("string").alias("alt"), F.lit(True).alias("other"))))
    rows = annotations.withColumn("_row", F.struct("*")).withColumn("_key", F.explode(keys)).withColumn("_sample", F.explode(F.array("sample", F.lit(None).cast("string"))))
    lacks = [(F.coalesce(F.col(c), F.lit("")) == "").alias(f"no_{c}") for c in BETTER]
    best = F.min(F.struct(*lacks, F.col("_key.other").alias("other"), F.col("_row").alias("row"))).alias("best")
    return rows.groupBy(*PLACE, F.col("_sample").alias("sample"), F.col("_key.alt").alias("alt")).agg(best)


def annotated(variants: DataFrame, annotations: DataFrame, key: str) -> DataFrame:
    """variants with ``annotation`` (struct), ``attempt`` and ``exact``, null where none is found.

    variants: key (unique), sample, chrom, pos, ref, alt, transcript.  Asked in
    turn are the sample's annotations of the transcript, of the transcript
    without version, any sample's of the one and the other (attempt 0 to 3).
    Annotations that name the allele, or whose row lists it, come first; then
    those with a protein position, a protein change, amino acids; then by
    attempt.
    """
    asked = F.array(*[F.struct(s.alias("sample"), t.alias("feature"), F.lit(n).alias("attempt")) for n, (s, t) in enumerate((s, t) for s in (F.col("sample"), F.lit(None).cast("string")) for t in (F.col("transcript"), sequences.strip_version(F.col("transcript"))))])
    rows = variants.withColumn("_asked", F.explode(asked)).withColumn("_alt", F.explode(F.array("alt", F.lit(None).cast("string"))))
    a, b = rows.select(key, "chrom", "pos", "ref", "_asked", "_alt").alias("a"), annotation_index(annotations).alias("b")
    same = (F.col("a.chrom") == F.col("b.chrom")) & (F.col("a.pos") == F.col("b.pos")) & (F.col("a.ref") == F.col("b.ref")) & (F.col("a._asked.feature") == F.col("b.feature"))
    same = same & F.col("a._asked.sample").eqNullSafe(F.col("b.sample")) & F.col("a._alt").eqNullSafe(F.col("b.alt"))
    flags = [F.col(f"b.best.no_{c}").alias(c) for c in BETTER]
    found = a.join(b, same).groupBy(key).agg(F.min(F.struct(F.col("b.alt").isNull().alias("inexact"), *flags, F.col("a._asked.attempt").alias("attempt"), F.col("b.best.row").alias("row"))).alias("_found"))
    return variants.join(found, key, "left").withColumns({"annotation": F.col("_found.row"), "attempt": F.col("_found.attempt"), "exact": ~F.col("_found.inexact")}).drop("_found")


def occurrences(sequence: Column, peptide: Column) -> Column:
    """Array of the 0-based starts of all occurrences, overlapping ones too."""
    last = F.char_length(sequence) - F.char_length(peptide)
    places = F.when((last >= 0) & (peptide != ""), F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: F.substr(sequence, i + 1, F.char_length(peptide)) == peptide)


def reference_sequences(proteins: DataFrame) -> DataFrame:
    """name, sequence of reference proteins (header, sequence) by transcript and protein id, with and without version; of repeated names the greatest sequence."""
    ids = [F.regexp_extract("header", r"\btranscript:(ENST\d+(?:\.\d+)?)", 1), F.regexp_extract("header", r"^(ENSP\d+(?:\.\d+)?)\b", 1)]
    names = F.array_distinct(F.array(*[x for i in ids for x in (i, sequences.strip_version(i))]))
    return proteins.select(F.explode(names).alias("name"), "sequence").filter("name <> ''").groupBy("name").agg(F.max("sequence").alias("sequence"))


def variant_peptides(candidates: DataFrame, proteins: DataFrame, annotations: DataFrame, references: DataFrame, il_equivalent: bool = False) -> tuple[DataFrame, DataFrame]:
    """Peptides with the variants of the proteins that hold them and a status each; and what can't be resolved.

    candidates: peptide, headers (by ``;``); proteins: header, sequence, file of
    variant proteins; annotations as annotation_index takes them, with
    consequence and protein_id; references: header, sequence.  The first table
    has a row for each peptide, token and protein of that token: token, sample,
    file, chrom, pos, ref, alt, transcript, annotation, starts, match_mode,
    start and end (from 1), in_reference, spans_position, status.  The second:
    peptide, token, reason.  A peptide with one validated occurrence has that
    one's status; several are ambiguous.  Headers that aren't of variants are
    left out; null peptides are too.
    """
    headers = candidates.filter("peptide IS NOT NULL").select(F.upper("peptide").alias("peptide"), F.explode(F.split("headers", ";")).alias("_header")).filter(F.contains("_header", F.lit("|var_")))
    asked = headers.select("peptide", F.regexp_extract(F.trim("_header"), r"^(\S+)", 1).alias("token")).distinct()
    # exploded, so that conditions on its fields don't parse the header again
    known = proteins.withColumn("_v", F.explode(F.array(sequences.allele_token(F.col("header"))))).filter("_v.sample IS NOT NULL")
    known = known.select(F.col("_v.token").alias("token"), F.upper("_v.sample").alias("sample"), "_v.chrom", "_v.pos", "_v.ref", "_v.alt", "_v.transcript", F.col("sequence").alias("alt_seq"), "file").distinct()
    known = checkpointed(known)
    # annotations are looked up once an allele, not once a peptide
    alleles_ = known.select("sample", "chrom", "pos", "ref", "alt", "transcript").distinct().withColumn("_key", F.struct("sample", "chrom", "pos", "ref", "alt", "transcript"))
    known = known.withColumn("_key", F.struct("sample", "chrom", "pos", "ref", "alt", "transcript")).join(annotated(alleles_, annotations, "_key").select("_key", "annotation"), "_key").drop("_key")
    # peptides meet these, and the references that are wanted come from them
    known = checkpointed(known)
    rows = asked.join(known, "token", "left")
    missing = F.when(F.col("alt_seq").isNull(), "variant header not found").when(F.col("annotation").isNull(), "no matching annotation")
    unresolved = rows.filter(missing.isNotNull()).select("peptide", "token", missing.alias("reason")).distinct()
    rows = rows.filter(missing.isNull())
    names = reference_sequences(references)
    protein = F.col("annotation.protein_id")
    changed = known.filter("annotation IS NOT NULL").select("transcript", protein.alias("_protein"), "alt_seq").distinct()
    tries = changed.select("transcript", "_protein").distinct().select("transcript", "_protein", F.posexplode(F.array("transcript", sequences.strip_version(F.col("transcript")), "_protein", sequences.strip_version(F.col("_protein")))).alias("_n", "name"))
    found = tries.join(names, "name").groupBy("transcript", "_protein").agg(F.min_by("sequence", "_n").alias("ref_seq"))
    # a protein is held against its reference once, not once a peptide and sample
    a, b = changed.alias("a"), found.alias("b")
    found = changed_spans(a.join(b, (F.col("a.transcript") == F.col("b.transcript")) & F.col("a._protein").eqNullSafe(F.col("b._protein"))).select("a.*", "b.ref_seq"))
    a, b = rows.withColumn("_protein", protein).alias("a"), found.alias("b")
    same = (F.col("a.transcript") == F.col("b.transcript")) & F.col("a._protein").eqNullSafe(F.col("b._protein")) & (F.col("a.alt_seq") == F.col("b.alt_seq"))
    rows = a.join(b, same, "left").select("a.*", "b.ref_seq", "b.changes")
    plain = {c: F.col(c) for c in ("peptide", "alt_seq", "ref_seq")}
    merged = {c: sequences.norm_amino_acids(x, True) for c, x in plain.items()}
    starts = occurrences(plain["alt_seq"], plain["peptide"])
    there = F.when(F.col("ref_seq").isNull(), "unknown").when(F.contains(plain["ref_seq"], plain["peptide"]), "yes")
    mode = F.lit("exact")
    if il_equivalent:
        mode = F.when(F.size(starts) > 0, "exact").otherwise("I/L-equivalent")
        starts = F.when(F.size(starts) > 0, starts).otherwise(occurrences(merged["alt_seq"], merged["peptide"]))
        there = there.when(F.contains(merged["ref_seq"], merged["peptide"]), "I/L-equivalent")
    rows = rows.withColumns({"match_mode": mode, "starts": starts, "in_reference": there.otherwise("no")})
    rows = rows.withColumn("match_mode", F.when(F.size("starts") > 0, F.col("match_mode")).otherwise("not-found"))
    tried = F.when(F.size("starts") > 0, F.col("starts")).otherwise(F.array(F.lit(-1)))
    position = sequences.protein_position(F.col("annotation.protein_position"))
    status = lambda s: peptide_event(plain["peptide"], s, plain["alt_seq"], plain["ref_seq"], position, F.coalesce("annotation.amino_acids", F.lit("")), F.col("annotation.consequence"), F.col("changes"))
    rows = rows.withColumn("_each", F.transform(tried, lambda s: F.struct(s.alias("start"), status(s).alias("status"))))
    rows = rows.withColumn("_valid", F.filter("_each", lambda x: x["status"].startswith("VALIDATED_")))
    rows = rows.withColumn("_one", F.coalesce(F.get("_valid", F.lit(0)), F.get("_each", F.lit(0))))
    start = F.when(F.col("_one.start") >= 0, F.col("_one.start") + 1)
    end = start + F.char_length("peptide") - 1
    spans = F.when(start.isNull() | position[0].isNull(), "unknown").when((start <= position[1]) & (end >= position[0]), "yes").otherwise("no")
    chosen = F.when(F.size("_valid") > 1, "AMBIGUOUS_MULTIPLE_OCCURRENCES").otherwise(F.col("_one.status"))
    columns = ["peptide", "token", "sample", "file", "chrom", "pos", "ref", "alt", "transcript", "annotation", F.size("starts").alias("occurrences"), "match_mode", start.alias("start"), end.alias("end"), "in_reference", spans.alias("spans_position"), chosen.alias("status")]
    return rows.select(*columns), unresolved


def prioritised(rows: DataFrame) -> DataFrame:
    """The validated rows of variant_peptides whose peptide isn't in the reference, by peptide, sample, place and transcript."""
    good = F.col("status").startswith("VALIDATED_") & F.col("in_reference").isin("no", "unknown")
    return rows.filter(good).orderBy("peptide", "sample", "chrom", "pos", "transcript")
