"""Expressions on protein and nucleotide sequences, peptide headers and identifiers."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the standard genetic code, codons in the order TCAG of each base.
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Where the vertebrate mitochondrial code differs.
MITOCHONDRIAL_CHANGES = {"AGA": "*", "AGG": "*", "ATA": "M", "TGA": "W"}


def genetic_code(mitochondrial: bool = False) -> dict[str, str]:
    code = {"".join(c): a for c, a in zip(product("TCAG", repeat=3), STANDARD_CODE, strict=True)}
    return code | MITOCHONDRIAL_CHANGES if mitochondrial else code


def translate_codon(codon: Column, mitochondrial: bool = False) -> Column:
    """One amino acid letter; empty for anything but a triplet of A, C, G and T."""
    code = F.create_map(*[F.lit(x) for pair in genetic_code(mitochondrial).items() for x in pair])
    clean = F.regexp_replace(F.upper(F.coalesce(codon, F.lit(""))), "[^ACGT]", "")
    return F.coalesce(F.try_element_at(code, clean), F.lit(""))


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(F.upper(sequence), "ACGT", "TGCA"))


def normalize_sequence(sequence: Column, merge_il: bool = False) -> Column:
    """Letters only, in upper case; with merge_il I and L become J."""
    letters = F.upper(F.regexp_replace(sequence, "[^A-Za-z]", ""))
    return F.translate(letters, "IL", "JJ") if merge_il else letters


def norm_amino_acids(sequence: Column, merge_il: bool = False) -> Column:
    """Letters and ``*``, without ``*`` at the end."""
    letters = F.regexp_replace(F.upper(F.regexp_replace(sequence, "[^A-Za-z*]", "")), r"\*+$", "")
    return F.translate(letters, "IL", "JJ") if merge_il else letters


def strip_version(identifier: Column) -> Column:
    return F.substring_index(identifier, ".", 1)


def mutation_orientation(ref: Column, alt: Column, ref_codon: Column, alt_codon: Column) -> Column:
    """Whether a codon's one change is the allele's, on which strand."""
    pairs = F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: F.substr(ref_codon, i, F.lit(1)) != F.substr(alt_codon, i, F.lit(1)))
    at = F.try_element_at(pairs, F.lit(1))
    one = F.substr(ref_codon, at, F.lit(1)), F.substr(alt_codon, at, F.lit(1))
    odd = (F.char_length(ref) != 1) | (F.char_length(alt) != 1) | (F.char_length(ref_codon) != 3) | (F.char_length(alt_codon) != 3)
    return (
        F.when(odd, "NON_SNV_OR_NON_TRIPLET")
        .when(F.size(pairs) != 1, F.concat(F.lit("CODON_DIFFERENCES_"), F.size(pairs).cast("string")))
        .when((one[0] == F.upper(ref)) & (one[1] == F.upper(alt)), "PLUS_STRAND_ALLELE_CONSISTENT")
        .when((one[0] == reverse_complement(ref)) & (one[1] == reverse_complement(alt)), "MINUS_STRAND_ALLELE_CONSISTENT")
        .otherwise("CODON_ALLELE_INCONSISTENT")
    )


def protein_position(text: Column) -> tuple[Column, Column]:
    """First and last position of ``12-14/300``; null where there is none."""
    span = F.substring_index(text, "/", 1)
    first = F.regexp_extract(span, r"^(\d+)", 1).try_cast("int")
    return first, F.coalesce(F.regexp_extract(span, r"-(\d+)$", 1).try_cast("int"), first)


def header_class(header: Column) -> Column:
    """Of a protein's header: the first that fits of PROGRESSION, FUSION, SPLICE, VARIANT, CONTAMINANT, DECOY, CANONICAL."""
    h = F.upper(header)
    return (
        F.when(h.rlike(r"(^|[| ])PROGRESSION[| ]"), "PROGRESSION")
        .when(F.contains(h, F.lit("|FUSION|")), "FUSION")
        .when(F.contains(h, F.lit("|SPLICE|")), "SPLICE")
        .when(F.contains(h, F.lit("|VAR_")), "VARIANT")
        .when(h.startswith("CON__") | F.contains(h, F.lit(" CONTAMINANT")), "CONTAMINANT")
        .when(h.startswith("REV__") | h.startswith("DECOY_"), "DECOY")
        .otherwise("CANONICAL")
    )


def header_sample(header: Column) -> Column:
    """What stands before the first ``|``, in upper case; empty without one."""
    return F.upper(F.regexp_extract(header, r"^([^|]+)\|", 1))


def header_accession(header: Column) -> Column:
    """The middle of ``sp|P12345|NAME``, else the first word."""
    word = F.regexp_extract(header, r"^\s*(\S+)", 1)
    middle = F.regexp_extract(word, r"^(?:sp|tr)\|([^|]*)\|", 1)
    return F.when(word.rlike(r"^(sp|tr)\|[^|]*\|"), middle).otherwise(word)


def variant_header(header: Column) -> Column:
    """Struct of a variant protein's header ``sample|VARIANT|... VAR_chrom:pos:ref:alt:transcript``."""
    parts = r"VAR_([^:|]+):(\d+):([A-Za-z]+):([A-Za-z]+)(?::([^|\s]+))?"
    return F.struct(
        header_sample(header).alias("sample"),
        F.regexp_extract(header, parts, 1).alias("chrom"),
        F.regexp_extract(header, parts, 2).try_cast("long").alias("pos"),
        F.regexp_extract(header, parts, 3).alias("ref"),
        F.regexp_extract(header, parts, 4).alias("alt"),
        F.regexp_extract(header, parts, 5).alias("transcript"),
    )


def allele_token(header: Column) -> Column:
    """Struct of a header's first word ``sample|var_._chrom.pos.ref.alt_transcript_product``; null fields without one."""
    token = F.regexp_extract(header, r"^\s*(\S+)", 1)
    parts = r"(?i)^([^|]+)\|var_\.?_([^._]+)\.(\d+)\.([^._]+)\.([^_]+)_(ENST\d+(?:\.\d+)?)_(\d+)$"
    # matched once: a word has no line feed, one that doesn't fit stays one piece
    fields = F.split(F.regexp_replace(token, parts, "\n$1\n$2\n$3\n$4\n$5\n$6\n$7"), "\n")
    field = lambda k: F.get(fields, F.lit(k))
    return F.struct(
        token.alias("token"),
        field(1).alias("sample"),
        F.regexp_replace(field(2), "^chr", "").alias("chrom"),
        field(3).try_cast("long").alias("pos"),
        field(4).alias("ref"),
        field(5).alias("alt"),
        field(6).alias("transcript"),
        strip_version(field(6)).alias("transcript_base"),
        field(7).alias("product"),
    )


def splice_header(header: Column) -> Column:
    """Struct of a splice protein's header: transcript and its reading frame ``start-end(strand)``."""
    frame = r":(\d+)-(\d+)\(([+-])\)"
    return F.struct(
        F.regexp_extract(header, r"(?:^|[|>\s])((?:MSTRG|STRG|ENST)[\w.]+)", 1).alias("transcript"),
        F.regexp_extract(header, frame, 1).try_cast("long").alias("orf_start"),
        F.regexp_extract(header, frame, 2).try_cast("long").alias("orf_end"),
        F.regexp_extract(header, frame, 3).alias("orientation"),
    )


def gene_pair(text: Column) -> Column:
    """Array of the two genes of ``A(123),B--C``: distances stripped."""
    return F.transform(F.split(F.regexp_replace(text, r"\([^)]*\)", ""), "--|::"), lambda x: F.trim(x))


def sequence_hash(sequence: Column) -> Column:
    return F.left(F.sha2(F.upper(sequence), 256), F.lit(24))


def alignment_key(*fields: Column) -> Column:
    """SHA-256 of the fields joined by the unit separator."""
    return F.sha2(F.concat_ws("\x1f", *[f.cast("string") for f in fields]), 256)


def safe_id(*fields: Column) -> Column:
    """A composite key of letters, digits, ``.``, ``_`` and ``-``."""
    return F.regexp_replace(F.concat_ws("_", *[f.cast("string") for f in fields]), r"[^A-Za-z0-9._-]+", "_")
