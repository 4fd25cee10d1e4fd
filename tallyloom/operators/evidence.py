"""Peptide and read evidence for events, and its integration across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.alleles import allele_type


def peptide_summary(hits: DataFrame, classes: list[str], canonical: str = "CANONICAL") -> DataFrame:
    """peptide, a count per class, samples, first position, absent_from_canonical, novel_classes from hits (peptide, class, sample, position)."""
    counts = [F.count_if(F.col("class") == c).alias(c) for c in classes]
    n = hits.groupBy("peptide").agg(*counts, F.array_sort(F.collect_set("sample")).alias("samples"), F.min("position").alias("first_position"))
    novel = F.array_compact(F.array(*[F.when((F.col(c) > 0), c) for c in classes if c != canonical]))
    return n.withColumns({"absent_from_canonical": F.col(canonical) == 0, "novel_classes": F.array_join(novel, ";")})


def evidence_summary(rows: DataFrame, key: str) -> DataFrame:
    """Per key from rows (raw_file, sample, pep, score, msms_ids array, direct): files, samples, spectra, best values, rows by kind.

    Direct rows have spectrum ids; the others were transferred between runs.
    """
    direct = F.size("msms_ids") > 0
    n = rows.groupBy(key).agg(
        F.array_sort(F.collect_set("raw_file")).alias("raw_files"),
        F.array_sort(F.collect_set(F.when(direct, F.col("sample")))).alias("direct_samples"),
        F.array_sort(F.collect_set(F.when(~direct, F.col("sample")))).alias("transferred_samples"),
        F.min("pep").alias("best_pep"),
        F.max("score").alias("best_score"),
        F.count_if(direct).alias("direct_rows"),
        F.count_if(~direct).alias("transferred_rows"),
    )
    psm = rows.select(key, F.explode("msms_ids").alias("id")).groupBy(key).agg(F.countDistinct("id").alias("psm_count"))
    out = n.join(psm, key, "left").withColumn("psm_count", F.coalesce("psm_count", F.lit(0)))
    return out.withColumn("only_transferred", F.array_except("transferred_samples", "direct_samples"))


def integrated_evidence(variants: DataFrame, codons: DataFrame, key: list[str]) -> DataFrame:
    """variants with numbers of codon rows by status, strict, and the reasons against it.

    codons: key, overall_status.  A row is strict if a codon row is validated
    and none failed.
    """
    n = codons.groupBy(*key).agg(F.count("*").alias("codon_rows"), F.count_if(F.col("overall_status") == "VARIANT_CODON_VALIDATED").alias("validated_rows"), F.count_if(F.col("overall_status") == "VALIDATION_FAILED").alias("failed_rows"))
    out = variants.join(n, key, "left").na.fill(0, ["codon_rows", "validated_rows", "failed_rows"])
    reasons = F.array_compact(F.array(F.when(F.col("codon_rows") == 0, "NO_CODON_ROW"), F.when(F.col("failed_rows") > 0, "CODON_ROW_FAILED"), F.when((F.col("codon_rows") > 0) & (F.col("validated_rows") == 0), "NO_VALIDATED_CODON_ROW")))
    return out.withColumn("exclusion_reasons", F.array_join(reasons, ";")).withColumn("strict", F.col("exclusion_reasons") == "")


def unique_variants(rows: DataFrame, key: list[str], lists: list[str], totals: list[str], first: list[str], order: str) -> DataFrame:
    """One row per key over samples: list columns united, totals summed, the rest from the first row by order."""
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists]
    return rows.groupBy(*key).agg(*united, *[F.sum(c).alias(c) for c in totals], *[F.min_by(c, order).alias(c) for c in first], F.array_sort(F.collect_set("sample")).alias("samples"))


def attribute_sets(hits: DataFrame, calls: DataFrame, key: list[str], attributes: list[str]) -> DataFrame:
    """hits with the sorted sets of the calls' attributes; empty without a call."""
    sets = calls.groupBy(*key).agg(*[F.array_sort(F.collect_set(a)).alias(a) for a in attributes])
    out = hits.join(sets, key, "left")
    return out.withColumns({a: F.coalesce(a, F.array().cast("array<string>")) for a in attributes})


def spectra(rows: DataFrame, msms: DataFrame, key: str) -> DataFrame:
    """key, scans: the scan numbers of a row's spectrum ids (array msms_ids), sorted."""
    ids = rows.select(key, F.explode("msms_ids").alias("id"))
    return ids.join(msms.select("id", "scan"), "id", "left").groupBy(key).agg(F.array_sort(F.collect_set("scan")).alias("scans"))


def known_junctions(junctions: DataFrame, reference: DataFrame, key: list[str]) -> DataFrame:
    """junctions with reference_status known or novel."""
    known = reference.select(*key).distinct().withColumn("_known", F.lit(True))
    return junctions.join(known, key, "left").withColumn("reference_status", F.when(F.col("_known"), "known").otherwise("novel")).drop("_known")


def direct_support(alleles: DataFrame, findings: DataFrame, key: list[str]) -> DataFrame:
    """alleles with the greatest numbers of a finding that directly supports them, 0 without one."""
    n = findings.groupBy(*key).agg(F.max("alt_reads").alias("alt_reads"), F.max("fraction").alias("fraction"))
    out = alleles.join(n, key, "left").na.fill(0, ["alt_reads"])
    return out.withColumn("supported", F.col("alt_reads") > 0)


def strict_identity(rows: DataFrame, baseline: str) -> DataFrame:
    """One row: rows, unique alleles, genes and peptides, and alleles in all, baseline-only and follow-up-only samples."""
    total = rows.agg(F.countDistinct("sample").alias("_s"))
    each = rows.groupBy("allele").agg(F.countDistinct("sample").alias("n"), F.bool_or(baseline).alias("b"), F.bool_or(~F.col(baseline)).alias("f"))
    n = each.join(F.broadcast(total)).agg(F.count_if(F.col("n") == F.col("_s")).alias("in_all"), F.count_if(F.col("b") & ~F.col("f")).alias("baseline_only"), F.count_if(F.col("f") & ~F.col("b")).alias("followup_only"))
    return rows.agg(F.count("*").alias("rows"), F.countDistinct("allele").alias("alleles"), F.countDistinct("gene").alias("genes"), F.countDistinct("peptide").alias("peptides")).join(F.broadcast(n))


def event_geometry(kind: Column, chrom: Column, pos: Column, ref: Column) -> Column:
    """struct(chrom, start0, end0) of an allele: its reference span, one base at least."""
    start0 = F.greatest(F.lit(0), pos - 1)
    return F.when(kind.isin("SNV", "MNV", "INSERTION", "DELETION", "COMPLEX"), F.struct(chrom.alias("chrom"), start0.alias("start0"), (start0 + F.greatest(F.lit(1), F.char_length(ref))).alias("end0")))


#: Times that lists hold a name, beyond which it isn't shuffled.
COMMON = 100_000


def event_regions(findings: DataFrame, events: DataFrame, common: int = COMMON) -> DataFrame:
    """findings with event_type, regions and found_events: what a finding covers, by its allele or the events that it comes from.

    findings: classes and source_events (by ``;``), chrom, pos, ref, alt;
    events: event (unique), chrom, start0, end0, chrom2, start2_0, end2.  A
    fusion has its events' breakpoints, a splice junction their junctions,
    anything else without an allele their first places as breakpoints; an allele
    has its own span.  Regions stand in the order of source_events, each once;
    an event without a whole place gives none.  Names that lists hold more than
    common times meet their events by a broadcast: there is at most one such
    name for every common names of all lists.
    """
    classes = F.split(F.coalesce("classes", F.lit("")), ";")
    allele = allele_type(F.col("ref"), F.col("alt"))
    kind = F.when(F.array_contains(classes, "fusion"), "FUSION").when(F.array_contains(classes, "splice_junction"), "SPLICE_JUNCTION").otherwise(F.coalesce(F.when(allele == "COMPLEX", "COMPLEX_ALLELE").otherwise(allele), F.lit("CONTEXT_EVENT")))
    rows = findings.withColumns({"event_type": kind, "_names": F.coalesce("source_events", F.lit(""))})
    # findings share lists of events: a list meets the events once, and findings travel once, to their lists
    asked = rows.select("_names").distinct().select("_names", F.posexplode(F.split("_names", ";")).alias("_nth", "event"))
    region = lambda c, a, b, r: F.struct(F.col(c).alias("chrom"), F.col(a).cast("long").alias("start0"), F.col(b).cast("long").alias("end0"), F.lit(r).alias("role"))
    both = F.array(region("chrom", "start0", "end0", "BREAKPOINT_1"), region("chrom2", "start2_0", "end2", "BREAKPOINT_2"))
    whole = F.filter(both, lambda r: (F.coalesce(r["chrom"], F.lit("")) != "") & r["start0"].isNotNull() & r["end0"].isNotNull())
    # a name that very many lists hold would go to one task, whatever the number of partitions
    often = F.broadcast(asked.groupBy("event").count().filter(F.col("count") > common).select("event"))
    met = asked.join(often, "event", "left_anti").join(events, "event").unionByName(asked.join(F.broadcast(events.join(often, "event", "left_semi")), "event"))
    met = met.select(F.col("_names").cast("binary").alias("_list"), "_nth", "event", whole.alias("_regions"))
    # a window sorts a list's events once; it goes by the list's bytes, so that the join below, by its text, has a shuffle of its own:
    # Spark splits that where many findings share a list, and no task holds the sorts of both
    nth = Window.partitionBy("_list").orderBy("_nth")
    gathered = F.array_sort(F.collect_list(F.struct("_nth", "event", "_regions")).over(nth.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    lists = met.select("_list", gathered.alias("_met"), F.row_number().over(nth).alias("_n")).filter("_n = 1")
    lists = lists.select(F.col("_list").cast("string").alias("_names"), F.array_distinct(F.flatten(F.transform("_met", lambda x: x["_regions"]))).alias("_places"), F.transform("_met", lambda x: x["event"]).alias("_found"))
    start0 = F.greatest(F.lit(0), F.col("pos") - 1).cast("long")
    own = F.array(F.struct(F.col("chrom").alias("chrom"), start0.alias("start0"), (start0 + F.greatest(F.lit(1), F.char_length("ref"))).alias("end0"), F.lit("TARGET_ALLELE").alias("role")))
    none = F.array().cast("array<struct<chrom:string,start0:bigint,end0:bigint,role:string>>")
    junctions = F.transform("_places", lambda r: r.withField("role", F.when(r["role"] == "BREAKPOINT_1", "JUNCTION").otherwise(r["role"])))
    places = F.coalesce(F.when(F.col("event_type") == "SPLICE_JUNCTION", junctions).otherwise(F.col("_places")), none)
    regions = F.when(F.col("event_type").isin("FUSION", "SPLICE_JUNCTION", "CONTEXT_EVENT"), places).otherwise(own)
    return rows.join(lists, "_names", "left").withColumns({"regions": regions, "found_events": F.coalesce("_found", F.array().cast("array<string>"))}).drop("_names", "_places", "_found")


def event_description(kind: Column, chrom: Column, pos: Column, ref: Column, alt: Column, chrom2: Column, pos2: Column) -> Column:
    """``SUBSTITUTE A WITH T AT chr1:10`` and the like."""
    from tallyloom.functions.alleles import coordinate_label as at

    inserted = F.right(alt, F.char_length(alt) - F.char_length(ref))
    deleted = F.right(ref, F.char_length(ref) - F.char_length(alt))
    return (
        F.when(kind == "SNV", F.concat(F.lit("SUBSTITUTE "), ref, F.lit(" WITH "), alt, F.lit(" AT "), at(chrom, pos)))
        .when(kind == "MNV", F.concat(F.lit("REPLACE "), ref, F.lit(" WITH "), alt, F.lit(" AT "), at(chrom, pos), F.lit("-"), F.format_number(pos + F.char_length(ref) - 1, 0)))
        .when(kind == "INSERTION", F.concat(F.lit("INSERT "), inserted, F.lit(" AFTER "), at(chrom, pos + F.char_length(ref) - 1), F.lit(" "), ref))
        .when(kind == "DELETION", F.concat(F.lit("DELETE "), deleted, F.lit(" AFTER "), at(chrom, pos + F.char_length(alt) - 1), F.lit(" "), alt))
        .when(kind == "SPLICE_JUNCTION", F.concat(F.lit("SPLICE "), at(chrom, pos), F.lit(" TO "), at(chrom2, pos2)))
        .when(kind == "FUSION", F.concat(F.lit("FUSE "), at(chrom, pos), F.lit(" TO "), at(chrom2, pos2)))
        .otherwise(F.concat(F.lit("CONTEXT AT "), at(chrom, pos)))
    )


def visual_status(kind: Column, status: Column, context: Column) -> Column:
    return F.when(kind.isin("FUSION", "SPLICE_JUNCTION", "CONTEXT_EVENT"), F.when(F.coalesce(context, F.lit(0)) > 0, "CONTEXT_ALIGNMENTS_AVAILABLE").otherwise("NO_CONTEXT_ALIGNMENTS")).otherwise(status)


def finding_search(findings: DataFrame, *, word: str = "", equal: dict[str, str] | None = None, contains: dict[str, str] | None = None, texts: list[str] | None = None, order: list[str], offset: int = 0, limit: int = 100) -> tuple[DataFrame, DataFrame]:
    """The total, as one row, and one page of findings: all given criteria hold; an empty one is none."""
    rows = findings
    for column, value in (equal or {}).items():
        rows = rows.filter(F.col(column) == value) if value else rows
    for column, value in (contains or {}).items():
        rows = rows.filter(F.contains(F.col(column), F.lit(value))) if value else rows
    if word:
        rows = rows.filter(F.contains(F.lower(F.concat_ws(" ", *(texts or []))), F.lit(word.lower())))
    return rows.agg(F.count("*").alias("total")), rows.orderBy(*order).offset(max(0, offset)).limit(min(500, limit))


def priority_filter(findings: DataFrame, genes: list[str], impacts: list[str], consequences: list[str]) -> DataFrame:
    """Findings that meet any of three criteria."""
    return findings.filter(F.col("gene").isin(genes) | F.col("impact").isin(impacts) | F.arrays_overlap(F.split("consequence", "&"), F.array(*[F.lit(c) for c in consequences]) if consequences else F.array().cast("array<string>")))
