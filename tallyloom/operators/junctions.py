"""Peptides over fusion and splice junctions: where they come from, and which junction they prove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import sequences
from tallyloom.functions.lineage import checkpointed
from tallyloom.operators import evidence, joins, rules, windows

#: What is reported of a fusion's calls.
CALL_ATTRIBUTES = ["breakpoint1", "breakpoint2", "confidence", "type", "reading_frame", "split_reads1", "split_reads2", "discordant_mates"]
#: How a call's read numbers are named in a peptide's support.
SUPPORT_NAMES = {"split1": "split_reads1", "split2": "split_reads2", "discordant": "discordant_mates"}


def first_word(header: Column) -> Column:
    return F.regexp_extract(header, r"^\s*(\S+)", 1)


def joined(values: Column, by: str = ";") -> Column:
    """The values in order, joined; empty without any."""
    return F.coalesce(F.array_join(F.array_sort(values), by), F.lit(""))


def fusion_genes(header: Column) -> Column:
    """Array of the two genes of a fusion protein's header ``sample|FUSION|n.A(12)-B(34).x``, without distances; both empty for other headers."""
    body = F.split(F.regexp_extract(first_word(header), r"\|FUSION\|(.*)$", 1), r"\.")
    pair = F.coalesce(F.get(body, F.lit(1)), F.get(body, F.lit(0)), F.lit(""))
    # only a pair has distances; a single name stays as it stands
    left = F.when(F.contains(pair, F.lit("-")), F.regexp_replace(F.regexp_extract(pair, "^([^-]*)-", 1), r"\([^)]*\)", "")).otherwise(pair)
    return F.array(left, F.regexp_replace(F.regexp_extract(pair, "^[^-]*-(.*)$", 1), r"\([^)]*\)", ""))


def junction_peptides(peptides: DataFrame, proteins: DataFrame, calls: DataFrame, *, merge_il: bool = True, least: int = 4, most_headers: int = 100, **bounds) -> DataFrame:
    """Peptides (sequence, pep, score, msms and others) found in fusion or splice proteins: a row for each peptide and class.

    proteins: role (CANONICAL, FUSION or SPLICE: the kind of file), file,
    header, sequence; of fusion and splice files only proteins whose header is
    of that class count.  calls: sample, gene1, gene2, CALL_ATTRIBUTES as text.

    Result: the peptide's columns and class, canonical_matches,
    canonical_absent, novel_matches (places, not proteins), samples, files,
    headers, positions, split, left_segment, right_segment, left_support,
    right_support, inference, gene1, gene2, CALL_ATTRIBUTES but the read
    numbers, support, high_confidence, candidate.  Lists are text joined by
    ``;``; of headers and positions, as a report, the first most_headers by
    file, header and place are named, the rest counted.  A peptide that no
    canonical protein holds may be split in two parts that different canonical
    proteins hold.  A fusion candidate has such a split and a call with both
    breakpoints.  Missing scores count as 0, a missing PEP too; bounds are
    high_confidence_peptide's.  Null and empty sequences are left out, repeated
    rows stay.
    """
    rows = peptides.withColumn("sequence", F.upper(F.trim("sequence"))).filter("sequence <> ''").withColumn("_pattern", sequences.normalize_sequence(F.col("sequence"), merge_il))
    kept = (F.col("role") == "CANONICAL") | (F.contains(F.upper("header"), F.concat(F.lit("|"), F.col("role"), F.lit("|"))) & ~((F.col("role") == "SPLICE") & F.contains(F.upper("header"), F.lit("|FUSION|"))))
    known = proteins.filter(kept).select("role", "file", "header", sequences.normalize_sequence(F.col("sequence"), merge_il).alias("text")).filter("text <> ''").withColumn("text_id", F.unhex(F.md5("text")))
    # proteins and hits are read by many branches: each is made once
    known = checkpointed(known)
    # a sequence that many samples share is searched once
    patterns = rows.select(F.col("_pattern").alias("pattern_id"), F.col("_pattern").alias("pattern")).distinct()
    # whole up to PART_SEED letters: many peptides may begin alike
    found = joins.pattern_join(patterns, known.select("text_id", "text").distinct(), seed=joins.PART_SEED)
    places = found.withColumnRenamed("pattern_id", "_pattern").groupBy("_pattern", "text_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("position")).alias("starts"))
    hits = checkpointed(places.join(known.drop("text"), "text_id")).withColumns({"sample": sequences.header_sample(F.col("header")), "genes": fusion_genes(F.col("header"))})

    canonical = hits.filter("role = 'CANONICAL'").groupBy("_pattern").agg(F.sum("n").alias("canonical_matches"))
    novel = hits.filter("role <> 'CANONICAL'").withColumnRenamed("role", "class")
    named = F.when(F.coalesce("sample", F.lit("")) != "", F.col("sample"))
    order = F.struct("file", "header")
    with_gene = (F.col("class") == "FUSION") & (F.col("genes")[0] != "")
    totals = novel.groupBy("_pattern", "class").agg(F.sum("n").alias("novel_matches"), joined(F.collect_set(named)).alias("samples"), joined(F.collect_set("file")).alias("files"), F.min_by("genes", F.when(with_gene, order)).alias("_genes"))
    # the first rows of a peptide, then their places: a row has one place at least
    shown = windows.cap_per_group(novel.select("_pattern", "class", "file", "header", "starts"), ["_pattern", "class"], ["file", "header", "starts"], most_headers)
    shown = windows.cap_per_group(shown.drop("rank").withColumn("start", F.explode("starts")), ["_pattern", "class"], ["file", "header", "start"], most_headers)
    span = F.concat(first_word(F.col("header")), F.lit(":"), "start", F.lit("-"), F.col("start") + F.char_length("_pattern") - 1)
    lists = shown.groupBy("_pattern", "class").agg(F.array_sort(F.collect_list(F.struct("rank", "header", span.alias("place")))).alias("_shown"))
    of_class = checkpointed(totals.join(lists, ["_pattern", "class"]).join(canonical, "_pattern", "left").na.fill(0, ["canonical_matches"]))

    asked = of_class.filter("canonical_matches = 0").select(F.col("_pattern").alias("peptide")).distinct()
    splits = joins.split_anchor(asked, known.filter("role = 'CANONICAL'").select(F.col("header").alias("protein_id"), F.col("text").alias("sequence")), least=least)
    gene = lambda c: F.substring_index(c, "(", 1).alias(c)
    reads = calls.select(F.upper("sample").alias("sample"), gene("gene1"), gene("gene2"), *CALL_ATTRIBUTES)
    of_call = novel.filter("class = 'FUSION'").select("_pattern", "sample", F.col("genes")[0].alias("gene1"), F.col("genes")[1].alias("gene2")).distinct()
    sets = of_call.join(reads, ["sample", "gene1", "gene2"]).groupBy("_pattern").agg(*[F.collect_set(F.when(F.col(c) != "", F.col(c))).alias(f"_{c}") for c in CALL_ATTRIBUTES])

    out = rows.join(of_class, "_pattern").join(splits.withColumnRenamed("peptide", "_pattern"), "_pattern", "left")
    out = out.join(sets.withColumn("class", F.lit("FUSION")), ["_pattern", "class"], "left")
    absent = F.col("canonical_matches") == 0
    support = F.concat_ws(";", *[F.when(F.size(f"_{c}") > 0, F.concat(F.lit(f"{name}="), joined(F.col(f"_{c}"), ","))) for name, c in SUPPORT_NAMES.items()])
    fusion_gene = lambda k: F.when(F.col("class") == "FUSION", F.coalesce(F.col("_genes")[k], F.lit(""))).otherwise("")
    out = out.withColumns(
        {
            "canonical_absent": absent,
            "headers": F.array_join(F.transform("_shown", lambda x: x["header"]), ";"),
            "positions": F.array_join(F.transform("_shown", lambda x: x["place"]), ";"),
            "left_segment": F.coalesce(F.left("sequence", F.col("split")), F.lit("")),
            "right_segment": F.coalesce(F.expr("substring(sequence, split + 1)"), F.lit("")),
            "left_support": F.coalesce("left_protein", F.lit("")),
            "right_support": F.coalesce("right_protein", F.lit("")),
            "inference": F.when(F.col("split").isNotNull(), "split-anchor-supported").when(absent, "noncanonical-no-split-anchor").otherwise("canonical-shared"),
            "gene1": fusion_gene(0),
            "gene2": fusion_gene(1),
            **{c: joined(F.col(f"_{c}")) for c in CALL_ATTRIBUTES[:5]},
            "support": support,
            "high_confidence": rules.high_confidence_peptide(F.col("pep"), F.col("score"), F.col("msms"), F.col("sequence"), absent, missing_pep_as_zero=True, **bounds),
        }
    )
    called = F.col("split").isNotNull() & (F.col("breakpoint1") != "") & (F.col("breakpoint2") != "")
    out = out.withColumn("candidate", F.col("high_confidence") & ((F.col("class") == "SPLICE") | called))
    return out.drop("_pattern", "_shown", "_genes", "left_protein", "right_protein", *[f"_{c}" for c in CALL_ATTRIBUTES])


def splice_protein(header: Column) -> Column:
    """Struct of a splice protein's header ``sample|SPLICE|transcript.pN ... STRG.1.1:4-90(+)``; null without that."""
    token = first_word(header)
    # matched once, then cut: name:low-high(strand)
    frame = F.regexp_extract(header, r"(?:^|\s)(STRG\.\d+\.\d+:\d+-\d+\([+-]\))", 1)
    span = F.substring_index(F.substring_index(frame, ":", -1), "(", 1)
    name = F.regexp_extract(token, r"\|SPLICE\|(.*)$", 1)
    low, high = F.substring_index(span, "-", 1).try_cast("long"), F.substring_index(span, "-", -1).try_cast("long")
    found = F.struct(
        token.alias("token"),
        F.upper(F.substring_index(token, "|", 1)).alias("sample"),
        name.alias("protein_id"),
        F.when(F.contains(name, F.lit(".p")), F.regexp_extract(name, r"^(.*)\.p.*?$", 1)).otherwise(name).alias("transcript"),
        F.substring_index(frame, ":", 1).alias("placed_transcript"),
        F.least(low, high).alias("orf_start"),
        F.greatest(low, high).alias("orf_end"),
        F.left(F.right(frame, F.lit(2)), F.lit(1)).alias("orientation"),
    )
    return F.when(F.contains(token, F.lit("|SPLICE|")) & (frame != ""), found)


def transcript_models(exons: DataFrame, attributes: list[str]) -> tuple[DataFrame, DataFrame]:
    """Models (sample, model, chrom, strand, attributes) and their junctions (sample, model, junction_no, left, right exon, bases before, donor, acceptor).

    exons: sample, transcript, chrom, strand, start, end, attributes.  A
    transcript on two contigs or strands is an error.  Junctions are numbered
    as the transcript runs; donor and acceptor are the exon bases beside the
    intron in genomic order.
    """
    keys = ["sample", "model"]
    rows = exons.withColumnRenamed("transcript", "model")
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.raise_error(F.concat(F.lit("conflicting transcript model "), F.first("model")))).alias(c)
    models = rows.groupBy(*keys).agg(one("chrom"), one("strand"), *[F.coalesce(F.max(F.when(F.col(a) != "", F.col(a))), F.lit("")).alias(a) for a in attributes])
    back = F.when(F.col("strand") == "-", -1).otherwise(1)
    order = Window.partitionBy(*keys).orderBy(F.col("start") * back, F.col("end") * back)
    exon = F.struct("start", "end")
    steps = rows.select(*keys, "strand", "start", "end").distinct().withColumns({"left_exon": exon, "right_exon": F.lead(exon).over(order), "junction_no": F.row_number().over(order), "after_nt": F.sum(F.col("end") - F.col("start") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    minus = F.col("strand") == "-"
    donor = F.when(minus, F.col("right_exon.end")).otherwise(F.col("left_exon.end"))
    acceptor = F.when(minus, F.col("left_exon.start")).otherwise(F.col("right_exon.start"))
    return models, steps.filter("right_exon IS NOT NULL").select(*keys, "junction_no", "left_exon", "right_exon", "after_nt", donor.alias("donor"), acceptor.alias("acceptor"))


def splice_peptides(candidates: DataFrame, proteins: DataFrame, exons: DataFrame, reference: DataFrame, *, merge_il: bool = True, attributes: list[str] | None = None) -> dict[str, DataFrame]:
    """Whether candidate peptides cross exon junctions of their sample's transcripts, and whether the reference has these: detailed, prioritized, unresolved.

    candidates: sequence, headers (by ``;``), pep, msms and others; proteins:
    file (named by its sample), header, sequence; exons: sample, transcript,
    chrom, strand, start, end, attributes; reference: transcript, chrom, strand,
    start, end.

    A header is looked up by its first word, else by sample and protein; a
    protein's transcript by its name, else by that of its reading frame.  Of
    rows with one sequence, sample, protein and file the first (by token, header
    and sequence of the protein, then PEP) is analysed.  detailed has a row for
    each junction inside the reading frame; prioritized those over a junction
    that the reference lacks, the most balanced of each sequence, sample and
    junction; unresolved: sequence, header, reason, for whatever has no row.
    """
    attributes = attributes or []
    asked = candidates.withColumn("sequence", F.upper("sequence")).filter("sequence <> ''")
    words = F.transform(F.filter(F.transform(F.split(F.coalesce("headers", F.lit("")), ";"), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit("|SPLICE|"))), first_word)
    asked = asked.withColumn("_tokens", F.array_distinct(words))
    bare = asked.filter(F.size("_tokens") == 0).select("sequence", F.lit("").alias("header"), F.lit("candidate row contains no splice FASTA header").alias("reason"))
    asked = asked.filter(F.size("_tokens") > 0).withColumn("_row", F.struct(*asked.drop("_tokens", "headers").columns)).select("_row", F.explode("_tokens").alias("asked"))
    asked = asked.withColumns({"sample": F.upper(F.substring_index("asked", "|", 1)), "protein_id": F.regexp_extract("asked", r"\|SPLICE\|(.*)$", 1)})

    h = F.col("_h")
    # exploded, so that conditions on its fields don't parse the header again
    known = proteins.withColumn("_h", F.explode(F.array(splice_protein(F.col("header"))))).filter("_h IS NOT NULL")
    of_file = F.substring_index("file", ".", 1)
    sample = F.when(h["sample"] == of_file, h["sample"]).otherwise(F.raise_error(F.concat(F.lit("protein of sample "), h["sample"], F.lit(" in file "), "file")))
    known = known.select("file", "header", F.regexp_replace(F.upper("sequence"), r"\*+$", "").alias("protein"), sample.alias("sample"), *[h[c].alias(c) for c in ("token", "protein_id", "transcript", "placed_transcript", "orf_start", "orf_end", "orientation")])
    # both look-ups are one: a first word names sample and protein; whether any protein has the word itself is known before rows meet
    of_name = Window.partitionBy("sample", "protein_id")
    rows = asked.join(known.withColumn("_tokens", F.collect_set("token").over(of_name)), ["sample", "protein_id"], "left")
    rows = rows.filter("token IS NULL OR token = asked OR NOT array_contains(_tokens, asked)").drop("_tokens").withColumn("sequence", F.col("_row.sequence"))
    # rows stay where the look-up put them; those without a protein all stay, too
    best = Window.partitionBy("sample", "protein_id", "sequence", "file").orderBy("token", "header", "protein", F.col("_row.pep").asc_nulls_last(), "_row")
    rows = rows.withColumn("_n", F.row_number().over(best)).filter("_n = 1 OR token IS NULL").drop("_n")

    def times(text: Column, part: Column) -> tuple[Column, Column]:
        """Where part first stands in text, and whether again; overlapping too."""
        first = F.position(part, text)
        return first, (first > 0) & (F.position(part, text, first + 1) > 0)

    exact = times(F.col("protein"), F.col("sequence"))
    merged = times(*[sequences.normalize_sequence(F.col(c), True) for c in ("protein", "sequence")])
    loose = (exact[0] == 0) & F.lit(merge_il)
    rows = rows.withColumns({"peptide_start": F.when(loose, merged[0]).otherwise(exact[0]), "_again": F.when(loose, merged[1]).otherwise(exact[1]), "match_mode": F.when(loose, "I/L-equivalent").otherwise("exact")})
    rows = rows.withColumns({"peptide_end": F.col("peptide_start") + F.char_length("sequence") - 1, "protein_length": F.char_length("protein")})

    models, junctions = transcript_models(exons, attributes)
    # by the transcript's name, else by that of its reading frame; rows without a protein look for their own names, not all for null
    named = F.col("transcript")
    of_model = ["chrom", "strand", *attributes]
    one = models.select("sample", F.col("model").alias("_name"), F.struct("model", *of_model).alias("_by_name"))
    other = models.select("sample", F.col("model").alias("_place"), F.struct("model", *of_model).alias("_by_place"))
    rows = rows.withColumns({"_name": F.coalesce(named, "protein_id"), "_place": F.coalesce("placed_transcript", "protein_id")})
    rows = rows.join(one, ["sample", "_name"], "left").join(other, ["sample", "_place"], "left")
    chosen = F.coalesce("_by_name", "_by_place")
    rows = rows.withColumns({c: chosen[c] for c in ["model", *of_model]}).drop("_name", "_place", "_by_name", "_by_place")
    nt = F.col("orf_end") - F.col("orf_start") + 1
    rows = rows.withColumn("orf_length_status", F.when(F.abs(nt - F.col("protein_length") * 3) <= 3, "consistent").otherwise(F.concat(F.lit("mismatch:"), nt, F.lit("nt_vs_"), F.col("protein_length") * 3, F.lit("nt"))))
    fault = F.when(F.col("token").isNull(), "header not found in supplied splice FASTAs").when(F.col("_again"), "peptide has multiple occurrences in splice protein").when(F.col("peptide_start") == 0, "peptide not found in splice protein").when(F.col("model").isNull(), "sample-specific transcript not found in supplied GTF")
    rows = rows.withColumn("reason", fault).drop("_again")

    a, b = rows.alias("a"), junctions.withColumn("_met", F.lit(True)).alias("b")
    inside = F.col("a.reason").isNull() & (F.col("a.sample") == F.col("b.sample")) & (F.col("a.model") == F.col("b.model")) & (F.col("b.after_nt") >= F.col("a.orf_start")) & (F.col("b.after_nt") < F.col("a.orf_end"))
    met = a.join(b, inside, "left").select("a.*", *[f"b.{c}" for c in ("junction_no", "left_exon", "right_exon", "after_nt", "donor", "acceptor", "_met")])
    faulty = met.filter("_met IS NULL").select("sequence", F.coalesce("token", "asked").alias("header"), F.coalesce("reason", F.lit("ORF contains no internal exon boundary")).alias("reason"))

    coding = F.col("after_nt") - F.col("orf_start") + 1
    phase = F.pmod(coding, F.lit(3))
    left_aa = F.floor(coding / 3) + F.when(phase == 0, 0).otherwise(1)
    rows = met.filter("_met").withColumns({"aa_left": left_aa, "aa_right": left_aa + F.when(phase == 0, 1).otherwise(0), "boundary_type": F.when(phase == 0, "between-codons").otherwise(F.concat(F.lit("within-codon-phase-"), phase))})
    crosses = (F.col("peptide_start") <= F.col("aa_left")) & (F.col("peptide_end") >= F.col("aa_right"))
    # the residue of a codon that the junction cuts is neither side's
    whole = F.when(phase == 0, 1).otherwise(0)
    rows = rows.withColumns({"anchor_left": F.when(crosses, F.col("aa_left") - F.col("peptide_start") + whole).otherwise(0), "anchor_right": F.when(crosses, F.col("peptide_end") - F.col("aa_right") + whole).otherwise(0), "classification": F.when(crosses, "exact-junction-spanning").otherwise("same-ORF-not-this-junction")})
    rows = rows.withColumns(
        {
            "support": F.when(~crosses, "not-spanning").when(F.least("anchor_left", "anchor_right") < 2, "weak-anchor").otherwise("supported"),
            "junction": F.concat("chrom", F.lit(":"), "donor", F.lit("-"), "acceptor", F.lit("("), "strand", F.lit(")")),
            "_chrom": F.regexp_replace("chrom", "^chr", ""),
        }
    )
    _, listed = transcript_models(reference.withColumn("sample", F.lit("")), [])
    contigs = reference.select(F.col("transcript").alias("model"), F.regexp_replace("chrom", "^chr", "").alias("_chrom"), "strand").distinct()
    rows = evidence.known_junctions(rows, listed.join(contigs, "model"), ["_chrom", "donor", "acceptor", "strand"])
    others = [c for c in candidates.columns if c not in ("sequence", "headers")]
    columns = ["sample", "protein_id", "token", "file", "model", "chrom", "strand", "orientation", "orf_start", "orf_end", "orf_length_status", "protein_length", "peptide_start", "peptide_end", "match_mode", "junction_no", "after_nt", "aa_left", "aa_right", "boundary_type", "left_exon", "right_exon", "junction", "reference_status", "classification", "anchor_left", "anchor_right", "support", *attributes, "header"]
    detailed = rows.select("sequence", *[F.col(f"_row.{c}").alias(c) for c in others if c not in columns], *columns)
    new = detailed.filter("classification = 'exact-junction-spanning' AND reference_status = 'novel'")
    first = windows.best_by(new, ["sequence", "sample", "junction"], [F.desc(F.least("anchor_left", "anchor_right")), "token", "file", "junction_no"])
    prioritized = first.orderBy(F.coalesce("pep", F.lit(1)), F.desc(F.coalesce("msms", F.lit(0))), "sequence", "sample", "junction")
    return {"detailed": detailed, "prioritized": prioritized, "unresolved": bare.union(faulty)}
