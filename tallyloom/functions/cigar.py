"""Aligned reads: CIGAR strings as arrays, and what a read says about an allele.

Positions are 1-based.  A block is struct(op, len, ref, read): where it begins on
the reference and, from 0, in the read.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: SAM flags that exclude a read, in the order in which they are looked at.
EXCLUDING_FLAGS = ((4, "UNMAPPED"), (256, "SECONDARY"), (2048, "SUPPLEMENTARY"), (1024, "DUPLICATE_FLAG"), (512, "QC_FAIL"))

_BLOCKS = "array<struct<op:string,len:int,ref:bigint,read:int>>"


def blocks(cigar: Column, start: Column) -> Column:
    """All operations of a CIGAR with their places."""
    sizes = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), 1), lambda x: x.cast("int"))
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), 2)
    pairs = F.arrays_zip(sizes.alias("n"), ops.alias("o"))

    def step(acc: Column, x: Column) -> Column:
        n, o = x["n"], x["o"]
        row = F.struct(o.alias("op"), n.alias("len"), acc["ref"].alias("ref"), acc["read"].alias("read"))
        return F.struct(
            F.concat(acc["out"], F.array(row)).alias("out"),
            (acc["ref"] + F.when(o.isin("M", "=", "X", "D", "N"), n).otherwise(0)).cast("bigint").alias("ref"),
            (acc["read"] + F.when(o.isin("M", "=", "X", "I", "S"), n).otherwise(0)).cast("int").alias("read"),
        )

    first = F.struct(F.array().cast(_BLOCKS).alias("out"), start.cast("bigint").alias("ref"), F.lit(0).alias("read"))
    return F.aggregate(pairs, first, step)["out"]


def well_formed(cigar: Column) -> Column:
    return cigar.rlike(r"^(\d+[MIDNSHP=X])+$")


def aligned(parts: Column) -> Column:
    return F.filter(parts, lambda b: b["op"].isin("M", "=", "X"))


def alignment_end(parts: Column, start: Column) -> Column:
    """The last reference position that a read covers, gaps included."""
    return F.aggregate(parts, start.cast("bigint") - 1, lambda end, b: F.when(b["op"].isin("M", "=", "X", "D", "N"), (b["ref"] + b["len"] - 1).cast("bigint")).otherwise(end))


def last_position(cigar: Column, start: Column) -> Column:
    """As alignment_end, from the text alone."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return start.cast("bigint") - 1 + F.aggregate(lengths, F.lit(0).cast("bigint"), lambda n, x: n + x.cast("bigint"))


def junctions(parts: Column) -> Column:
    """Array of struct(start, end): first and last base of each intron gap."""
    return F.transform(F.filter(parts, lambda b: b["op"] == "N"), lambda b: F.struct(b["ref"].alias("start"), (b["ref"] + b["len"] - 1).alias("end")))


def observes(parts: Column, start0: Column, end0: Column) -> Column:
    """Whether an aligned block, and not a gap, overlaps [start0, end0) in 0-based coordinates."""
    return F.exists(aligned(parts), lambda b: (b["ref"] - 1 < end0) & (b["ref"] - 1 + b["len"] > start0))


def _least_quality(qual: Column, size: Column) -> Column:
    """Of Phred+33 letters; -1 for a read without qualities, or with fewer than size."""
    letters = F.filter(F.split(qual, ""), lambda c: c != "")
    least = F.array_min(F.transform(letters, lambda c: F.ascii(c) - 33))
    return F.when((F.char_length(qual) < size) | (qual == "*"), -1).otherwise(F.coalesce(least, F.lit(-1)))


def _numbers(letters: Column) -> Column:
    """``Q;Q`` of Phred+33 letters."""
    return F.array_join(F.transform(F.filter(F.split(letters, ""), lambda c: c != ""), lambda c: (F.ascii(c) - 33).cast("string")), ";")


def span(parts: Column, seq: Column, qual: Column, pos: Column, size: Column) -> Column:
    """struct(covered, one, bases, letters, quality) of the read over [pos, pos + size): whether aligned blocks cover it, whether one does, its bases, their quality letters and the least of these.

    A sequence that ends before its CIGAR does covers nothing there.
    """
    end = pos + size - 1
    m = aligned(parts)
    zero = F.lit(0).cast("bigint")
    reach = F.aggregate(m, zero, lambda a, b: a + F.greatest(zero, F.least(end, b["ref"] + b["len"] - 1, b["ref"] + F.char_length(seq) - b["read"] - 1) - F.greatest(pos, b["ref"]) + 1))
    one = F.try_element_at(F.filter(m, lambda b: (b["ref"] <= pos) & (b["ref"] + b["len"] - 1 >= end)), F.lit(1))
    at = (one["read"] + (pos - one["ref"]) + 1).cast("int")
    bases = F.substring(seq, at, size.cast("int"))
    letters = F.when(qual == "*", "").otherwise(F.substring(qual, at, size.cast("int")))
    quality = _least_quality(letters, size)
    return F.struct((reach >= size).alias("covered"), F.coalesce(one.isNotNull() & (F.char_length(bases) == size), F.lit(False)).alias("one"), bases.alias("bases"), letters.alias("letters"), quality.alias("quality"))


def with_read_class(df: DataFrame, out: str, *, flag: Column, mapq: Column, cigar: Column, seq: Column, qual: Column, start: Column, pos: Column, ref: Column, alt: Column, end: Column | None = None, min_mapq: int = 20, min_baseq: int = 20) -> DataFrame:
    """df with read_class in a column; blocks and the allele's span are computed once, in projections of their own.

    end: the read's last position, if at hand; later ones do no harm.  A read
    that can't show the allele gets its reason alone, and no more than its class
    where nobody asks for that.
    """
    size = F.least(F.char_length(ref), F.char_length(alt))
    # a read that its flag or quality excludes, or that lies beside the allele, needs no blocks
    vain = (flag.bitwiseAND(F.lit(sum(mask for mask, _ in EXCLUDING_FLAGS))) != 0) | (F.coalesce(mapq, F.lit(0)) < min_mapq) | (pos + size - 1 < start) | ((last_position(cigar, start) if end is None else end) < pos)
    known = df.withColumn("_vain", F.coalesce(vain, F.lit(False)))
    near = ~F.col("_vain")
    known = known.withColumn("_blocks", F.when(near, blocks(cigar, start)))
    known = known.withColumn("_span", F.when(near, span(F.col("_blocks"), F.upper(seq), qual, pos, size)))
    kind = read_class(flag, mapq, cigar, seq, qual, start, pos, ref, alt, min_mapq, min_baseq, parts=F.col("_blocks"), shared=F.col("_span"))
    known = known.withColumn("_near", F.when(near, kind))
    beside = {"class": F.lit("EXCLUDED"), "reason": _vain_reason(flag, mapq, cigar, seq, start, ref, alt, min_mapq), "observed": F.lit(""), "quality": F.lit("")}
    found = F.struct(*[F.when(F.col("_vain"), x).otherwise(F.col("_near")[c]).alias(c) for c, x in beside.items()])
    return known.withColumn(out, found).drop("_blocks", "_span", "_near", "_vain")


def _faults(flag: Column, mapq: Column, cigar: Column, seq: Column, start: Column, ref: Column, alt: Column, min_mapq: int) -> list[tuple[Column, str]]:
    """Why a read says nothing about an allele wherever it lies."""
    return [
        (flag.isNull() | start.isNull(), "MALFORMED_SAM_RECORD"),
        *[(flag.bitwiseAND(F.lit(mask)) != 0, reason) for mask, reason in EXCLUDING_FLAGS],
        (F.coalesce(mapq, F.lit(0)) < min_mapq, "LOW_MAPQ"),
        (cigar.isNull() | cigar.isin("", "*") | seq.isNull() | seq.isin("", "*"), "MISSING_CIGAR_OR_SEQUENCE"),
        (~well_formed(cigar), "UNSUPPORTED_CIGAR"),
        (ref.isNull() | alt.isNull() | (F.char_length(ref) == 0) | (F.char_length(alt) == 0) | (ref == alt), "INVALID_ALLELES"),
    ]


def _vain_reason(flag: Column, mapq: Column, cigar: Column, seq: Column, start: Column, ref: Column, alt: Column, min_mapq: int) -> Column:
    """Reason of a read that its fields exclude or that lies beside the allele."""
    ref, alt = F.upper(ref), F.upper(alt)
    n_ref, n_alt = F.char_length(ref), F.char_length(alt)
    simple = (n_ref == n_alt) | ((n_alt > n_ref) & alt.startswith(ref)) | ((n_ref > n_alt) & ref.startswith(alt))
    faults = _faults(flag, mapq, cigar, seq, start, ref, alt, min_mapq)
    found = F.when(faults[0][0], faults[0][1])
    for condition, reason in faults[1:]:
        found = found.when(condition, reason)
    return found.when(simple, "DOES_NOT_SPAN_COMPLETE_ALLELE").otherwise("UNSUPPORTED_COMPLEX_REPLACEMENT")


def read_class(flag: Column, mapq: Column, cigar: Column, seq: Column, qual: Column, start: Column, pos: Column, ref: Column, alt: Column, min_mapq: int = 20, min_baseq: int = 20, *, parts: Column | None = None, shared: Column | None = None) -> Column:
    """struct(class, reason, observed, quality): EXACT_ALT, CLEAN_REFERENCE or EXCLUDED, why, what the read shows, qualities of that as ``Q;Q``.

    A substitution needs all of its bases in one aligned block; an insertion
    its anchor and exactly the inserted bases behind it; a deletion what it
    keeps in front and exactly the deleted gap.  A null field counts as missing.
    observed and quality are empty where the read shows nothing at the allele; a
    deletion is seen as ``first-last``, with the qualities of what is kept.
    parts and shared: blocks and the span of the shorter allele, if at hand.
    """
    ref, alt, seq = F.upper(ref), F.upper(alt), F.upper(seq)
    parts = blocks(cigar, start) if parts is None else parts
    n_ref, n_alt = F.char_length(ref), F.char_length(alt)
    shared = span(parts, seq, qual, pos, F.least(n_ref, n_alt)) if shared is None else shared

    nothing = F.lit("")

    def out(kind: str, reason: str, observed: Column = nothing, quality: Column = nothing) -> Column:
        return F.struct(F.lit(kind).alias("class"), F.lit(reason).alias("reason"), observed.alias("observed"), quality.alias("quality"))

    def no(reason: str, observed: Column = nothing, quality: Column = nothing) -> Column:
        return out("EXCLUDED", reason, observed, quality)

    cases = [(condition, no(reason)) for condition, reason in _faults(flag, mapq, cigar, seq, start, ref, alt, min_mapq)]

    def spanned(when: Column, over: Column) -> tuple[list, Column]:
        covered, one, bases, quality = (over[x] for x in ("covered", "one", "bases", "quality"))
        return [(when & ~covered, no("DOES_NOT_SPAN_COMPLETE_ALLELE")), (when & ~one, no("ALLELE_NOT_CONTIGUOUSLY_ALIGNED")), (when & (quality < min_baseq), no("LOW_ALLELE_BASE_QUALITY"))], bases

    kept = _numbers(shared["letters"])
    # substitutions
    sub = n_ref == n_alt
    checks, bases = spanned(sub, shared)
    cases += [*checks, (sub & (bases == alt), out("EXACT_ALT", "EXACT_SUBSTITUTION", bases, kept)), (sub & (bases == ref), out("CLEAN_REFERENCE", "EXACT_REFERENCE_HAPLOTYPE", bases, kept)), (sub, no("OTHER_ALLELE", bases, kept))]
    # insertions behind the anchor
    ins = (n_alt > n_ref) & alt.startswith(ref)
    checks, bases = spanned(ins, shared)
    behind = pos + n_ref
    inserted = F.filter(parts, lambda b: (b["op"] == "I") & (b["ref"] == behind))
    exact = F.try_element_at(F.filter(inserted, lambda b: F.substring(seq, b["read"] + 1, b["len"]) == F.substring(alt, n_ref + 1, n_alt - n_ref)), F.lit(1))
    exact_letters = F.when(qual == "*", "").otherwise(F.substring(qual, exact["read"] + 1, exact["len"]))
    exact_quality = _least_quality(exact_letters, exact["len"])
    added, seen = F.substring(alt, n_ref + 1, n_alt - n_ref), F.array_join(F.transform(inserted, lambda b: F.substring(seq, b["read"] + 1, b["len"])), ";")
    one = span(parts, seq, qual, pos, n_ref + 1)["one"]
    next_block = F.try_element_at(F.filter(aligned(parts), lambda b: (b["ref"] <= behind) & (b["ref"] + b["len"] - 1 >= behind)), F.lit(1))
    next_at = (next_block["read"] + (behind - next_block["ref"]) + 1).cast("int")
    next_quality = F.when(qual == "*", -1).otherwise(_least_quality(F.substring(qual, next_at, F.lit(1)), F.lit(1)))
    next_number = next_quality.cast("string")
    cases += [
        *checks,
        (ins & (bases != ref), no("OTHER_ANCHOR_ALLELE", bases, kept)),
        (ins & exact.isNotNull() & (exact_quality < min_baseq), no("LOW_INSERTION_BASE_QUALITY", added, _numbers(exact_letters))),
        (ins & exact.isNotNull(), out("EXACT_ALT", "EXACT_INSERTION", added, _numbers(exact_letters))),
        (ins & (F.size(inserted) > 0), no("OTHER_INSERTION_AT_BREAKPOINT", seen)),
        (ins & next_block.isNull(), no("DOES_NOT_SPAN_BOTH_SIDES_OF_INSERTION")),
        (ins & ~one, no("INSERTION_BREAKPOINT_NOT_CONTIGUOUSLY_ALIGNED")),
        (ins & (next_quality < min_baseq), no("LOW_BREAKPOINT_BASE_QUALITY", F.substring(seq, next_at, F.lit(1)), next_number)),
        (ins, out("CLEAN_REFERENCE", "REFERENCE_CONTIGUOUS_ACROSS_INSERTION_BREAKPOINT", ref, F.concat_ws(";", kept, next_number))),
    ]
    # deletions behind what is kept
    gone = (n_ref > n_alt) & ref.startswith(alt)
    checks, bases = spanned(gone, shared)
    first, last = pos + n_alt, pos + n_ref - 1
    gaps = F.filter(parts, lambda b: b["op"] == "D")
    cases += [*checks, (gone & (bases != alt), no("OTHER_ANCHOR_ALLELE", bases, kept))]
    cases += [
        (gone & F.exists(gaps, lambda b: (b["ref"] == first) & (b["ref"] + b["len"] - 1 == last)), out("EXACT_ALT", "EXACT_DELETION", F.concat_ws("-", first, last), kept)),
        (gone & F.exists(gaps, lambda b: (b["ref"] <= last) & (b["ref"] + b["len"] - 1 >= first)), no("OTHER_DELETION_AT_BREAKPOINT")),
    ]
    whole = span(parts, seq, qual, pos, n_ref)
    checks, bases = spanned(gone, whole)
    over = _numbers(whole["letters"])
    cases += [*checks, (gone & (bases == ref), out("CLEAN_REFERENCE", "EXACT_REFERENCE_HAPLOTYPE", bases, over)), (gone, no("OTHER_ALLELE", bases, over))]
    found = F.when(*cases[0])
    for condition, value in cases[1:]:
        found = found.when(condition, value)
    return found.otherwise(no("UNSUPPORTED_COMPLEX_REPLACEMENT"))


def evidence_status(alt: Column, ref: Column) -> Column:
    """By the numbers of reads for the allele and for the reference."""
    return F.when((alt > 0) & (ref > 0), "MIXED_ALT_AND_REFERENCE").when(alt > 0, "ALT_SUPPORTED").when(ref > 0, "NO_EXACT_ALT_SUPPORT").otherwise("NO_CALLABLE_READS")


def alt_fraction(alt: Column, ref: Column) -> Column:
    """Null, not 0, without a callable read."""
    return F.try_divide(alt, alt + ref)


def provenance(flag: Column, parts: Column, start: Column, pos: Column) -> Column:
    """struct(mate, strand, read_position, alignment_end) of a read at a reference position."""
    block = F.try_element_at(F.filter(aligned(parts), lambda b: (b["ref"] <= pos) & (b["ref"] + b["len"] - 1 >= pos)), F.lit(1))
    return F.struct(
        F.when(flag.bitwiseAND(F.lit(64)) != 0, "R1").when(flag.bitwiseAND(F.lit(128)) != 0, "R2").otherwise("UNPAIRED").alias("mate"),
        F.when(flag.bitwiseAND(F.lit(16)) != 0, "-").otherwise("+").alias("strand"),
        (block["read"] + (pos - block["ref"]) + 1).alias("read_position"),
        alignment_end(parts, start).alias("alignment_end"),
    )


def primary(flag: Column, mapq: Column | None = None, min_mapq: int = 20) -> Column:
    """Neither unmapped nor secondary, supplementary, duplicate or failed; and of min_mapq, if given."""
    kept = flag.bitwiseAND(F.lit(sum(mask for mask, _ in EXCLUDING_FLAGS))) == 0
    return kept if mapq is None else kept & (mapq >= min_mapq)


#: What says something in a pile-up's text: a hidden sign, an indel's head, a base.
_PILEUP = re.compile(r"(\^.?)|([+-])([0-9]+)|([.,ACGTNacgtn])", re.DOTALL)


def pileup_counts(text: Column, reference: Column) -> Column:
    """Map of the bases and indels in a pile-up's text to their numbers.

    ``.`` and ``,`` are the reference's base, letters their own; ``+`` or ``-``
    with a length and so many letters is an indel, named by the reference, its
    sign and letters.  ``^`` hides the next sign; all others say nothing.  An
    indel that the text's end cuts counts with the letters that it has.  How far
    an indel reaches stands in its head, so no pattern finds its end; a
    vectorised function goes from head to head.
    """

    def count(texts: pd.Series, references: pd.Series) -> pd.Series:
        found = []
        for t, r in zip(texts, references, strict=True):
            counts: Counter[str] = Counter()
            at = 0
            while t and (m := _PILEUP.search(t, at)):
                at = m.end()
                if m[2]:
                    counts[f"{r.upper()}{m[2]}{t[at : at + int(m[3])].upper()}"] += 1
                    at += int(m[3])
                elif m[4]:
                    counts[r.upper() if m[4] in ".," else m[4].upper()] += 1
            found.append(dict(counts))
        return pd.Series(found)

    return F.pandas_udf(count, "map<string,int>")(text, reference)
