"""Scans of the text formats of genomics as DataFrames; files are read by Spark alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Paths = str | list[str]


def tsv(spark: SparkSession, paths: Paths, schema: str | None = None) -> DataFrame:
    """Tab-separated with header, quotes doubled inside quotes; compressed files too."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(paths)


def delimited(spark: SparkSession, path: str) -> DataFrame:
    """Tab- or comma-separated, by what the first line holds."""
    first = spark.read.text(path).limit(1).collect()
    sep = "\t" if first and "\t" in first[0][0] else ","
    return spark.read.option("sep", sep).option("header", True).option("escape", '"').csv(path)


def samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated; a byte-order mark in front of the first name is dropped."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def coalesce_columns(df: DataFrame, names: list[str], out: str) -> DataFrame:
    """df with the first value of the columns that go by any of the names, in any case."""
    by = {c.lower(): c for c in df.columns}
    found = [F.col(f"`{by[n.lower()]}`") for n in names if n.lower() in by]
    return df.withColumn(out, F.coalesce(*found) if found else F.lit(None).cast("string"))


def _last_wins(entries: Column) -> Column:
    """A map from array<struct<key,value>>; of repeated keys the last value."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    back = F.reverse(entries)
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(back, lambda e: e["key"] == k), 1)["value"].alias("value"))))


def info_map(info: Column) -> Column:
    """``k=v;k=v`` as a map; flags without a value are left out, the last of repeated keys stays."""
    pairs = F.filter(F.split(info, ";"), lambda x: F.contains(x, F.lit("=")))
    return _last_wins(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.regexp_replace(x, "^[^=]*=", "").alias("value"))))


def vcf(spark: SparkSession, paths: Paths) -> DataFrame:
    """sample (from the file's name), chrom, pos, id, ref, alt, qual, filter, info, format (of the first sample column)."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file")).filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    f = F.split("value", "\t")
    names, values = F.split(F.try_element_at(f, F.lit(9)), ":"), F.split(F.try_element_at(f, F.lit(10)), ":")
    entries = F.transform(F.arrays_zip(names.alias("k"), values.alias("v")), lambda x: F.struct(x["k"].alias("key"), x["v"].alias("value")))
    return lines.select(
        F.regexp_replace("file", r"\.vcf.*$", "").alias("sample"),
        f[0].alias("chrom"),
        f[1].try_cast("long").alias("pos"),
        f[2].alias("id"),
        f[3].alias("ref"),
        f[4].alias("alt"),
        f[5].try_cast("double").alias("qual"),
        f[6].alias("filter"),
        info_map(f[7]).alias("info"),
        F.when(F.size(f) >= 10, _last_wins(entries)).alias("format"),
    )


#: Files whose headers are given to every task; those of more are joined by a shuffle.
HEADER_FILES = 10_000


def vcf_file_headers(spark: SparkSession, paths: Paths) -> DataFrame:
    """path, columns (the names of sample columns), fields (the annotation's, null without a header) of each file."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path")).filter(F.startswith("value", F.lit("#")))
    names = F.split(F.rtrim(F.col("value")), "\t")
    columns = F.when(F.startswith("value", F.lit("#CHROM\t")), F.slice(names, F.lit(10), F.greatest(F.size(names) - 9, F.lit(0))))
    stated = F.regexp_extract("value", r"^##INFO=<ID=CSQ.*Format: ([^\">]+)", 1)
    fields = F.when(stated != "", F.transform(F.split(stated, r"\|"), lambda x: F.trim(x)))
    return lines.groupBy("path").agg(F.max(columns).alias("columns"), F.max(fields).alias("fields"))


def vcf_calls(spark: SparkSession, paths: Paths) -> DataFrame:
    """Calls of files with different headers: path, sample, column, chrom, pos, id, ref, alt, qual, filter, info, format, fields.

    A row per record and sample column, one with a null column where a file has
    none.  sample is the file's name up to its first dot, column the sample
    column's name; fields is the file's own order of annotation fields.  A
    record with fewer sample values than columns has null formats for the rest.
    """
    headers = vcf_file_headers(spark, paths)
    if headers.limit(HEADER_FILES + 1).count() <= HEADER_FILES:
        headers = F.broadcast(headers)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path")).filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    lines = lines.join(headers, "path", "left").withColumn("f", F.split("value", "\t"))
    columns = F.when(F.size("columns") > 0, F.transform("columns", lambda c, i: F.struct(c.alias("name"), (i + 10).alias("at")))).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(10).alias("at"))))
    rows = lines.withColumn("c", F.explode(columns))
    f, value = F.col("f"), F.try_element_at("f", F.col("c.at"))
    entries = F.transform(F.arrays_zip(F.split(F.try_element_at(f, F.lit(9)), ":").alias("k"), F.split(value, ":").alias("v")), lambda x: F.struct(x["k"].alias("key"), x["v"].alias("value")))
    return rows.select(
        "path",
        F.regexp_extract("path", r"([^/.]+)[^/]*$", 1).alias("sample"),
        F.col("c.name").alias("column"),
        f[0].alias("chrom"),
        f[1].try_cast("long").alias("pos"),
        f[2].alias("id"),
        f[3].alias("ref"),
        f[4].alias("alt"),
        f[5].try_cast("double").alias("qual"),
        f[6].alias("filter"),
        info_map(f[7]).alias("info"),
        F.when(value.isNotNull(), _last_wins(entries)).alias("format"),
        "fields",
    )


def csq_fields(spark: SparkSession, path: str) -> list[str]:
    """The order of annotation fields that the headers of a path's files state; other orders among them are an error (see vcf_calls)."""
    found = vcf_file_headers(spark, path).filter("fields IS NOT NULL").select("fields").distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{path}: " + ("several orders of annotation fields" if found else "no annotation header"))
    return list(found[0][0])


def explode_csq(calls: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One row per annotation, its fields as a map; missing ones are empty.

    Without fields every row's own column ``fields`` names them; an annotation
    in a file that states no order is an error.
    """
    rows = calls.withColumn("_one", F.explode(F.split(F.try_element_at("info", F.lit("CSQ")), ",")))
    names = F.array(*[F.lit(x) for x in fields]) if fields else F.coalesce("fields", F.raise_error(F.concat(F.lit("no annotation header: "), F.col("path"))).cast("array<string>"))
    values = F.split("_one", r"\|")
    padded = F.slice(F.concat(values, F.array_repeat(F.lit(""), F.size(names))), F.lit(1), F.size(names))
    return rows.filter("_one <> ''").withColumn("csq", F.map_from_arrays(names, padded)).drop("_one")


def annotations(calls: DataFrame) -> DataFrame:
    """vcf_calls as annotation.annotation_index takes them: one row per record's annotation, whatever its file's order of fields."""
    rows = explode_csq(calls.dropDuplicates(["path", "chrom", "pos", "ref", "alt", "id"]))
    named = {"allele": "Allele", "feature": "Feature", "protein_position": "Protein_position", "hgvsp": "HGVSp", "amino_acids": "Amino_acids", "consequence": "Consequence", "protein_id": "ENSP", "gene": "SYMBOL", "impact": "IMPACT"}
    return rows.select(F.upper("sample").alias("sample"), F.regexp_replace("chrom", "^chr", "").alias("chrom"), "pos", "ref", F.col("alt").alias("alts"), *[F.coalesce(F.try_element_at("csq", F.lit(k)), F.lit("")).alias(n) for n, k in named.items()])


def fasta(spark: SparkSession, paths: Paths) -> DataFrame:
    """file, header, sequence of records over several lines; letters before the first header are an error."""
    records = spark.read.option("lineSep", "\n>").text(paths).select(F.replace("value", F.lit("\r"), F.lit("")).alias("value"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("nth"))
    # the first record of a file keeps its mark; others lost theirs with the separator
    heads = records.groupBy("file").agg(F.min_by("value", F.struct("begin", "nth")).alias("head")).filter(~F.ltrim("head").startswith(">") & (F.trim("head") != "")).select("file")
    wrong = heads.agg(F.min("file").alias("wrong"))
    records = records.join(F.broadcast(wrong)).filter(F.trim("value") != "")
    body = F.when(F.col("wrong").isNotNull(), F.raise_error(F.concat(F.lit("letters before the first header: "), F.col("wrong")))).otherwise(F.regexp_replace("value", r"^\s*>", ""))
    return records.select("file", F.trim(F.split_part(body, F.lit("\n"), F.lit(1))).alias("header"), F.regexp_replace(F.regexp_replace(body, r"^[^\n]*\n?", ""), r"\s", "").alias("sequence"))


def _attributes(text: Column) -> Column:
    """``k "v";`` and ``k=v`` as a map, the last of repeated keys."""
    a = F.lit(r'([A-Za-z_][\w.-]*)\s*[ =]\s*"?([^";]*)"?\s*(?:;|$)')
    return _last_wins(F.transform(F.arrays_zip(F.regexp_extract_all(text, a, 1).alias("k"), F.regexp_extract_all(text, a, 2).alias("v")), lambda x: F.struct(x["k"].alias("key"), x["v"].alias("value"))))


def gtf(spark: SparkSession, paths: Paths, feature: str | None = "exon") -> DataFrame:
    """chrom, source, feature, start, end, strand, transcript, gene, attributes."""
    f = F.split("value", "\t")
    rows = spark.read.text(paths).filter(~F.col("value").startswith("#")).filter(F.size(f) >= 9)
    out = rows.select(f[0].alias("chrom"), f[1].alias("source"), f[2].alias("feature"), f[3].try_cast("long").alias("start"), f[4].try_cast("long").alias("end"), f[6].alias("strand"), _attributes(f[8]).alias("attributes"))
    out = out.withColumns({"transcript": F.try_element_at("attributes", F.lit("transcript_id")), "gene": F.try_element_at("attributes", F.lit("gene_id"))})
    return out.filter(F.col("feature") == feature) if feature else out


def sam(spark: SparkSession, paths: Paths) -> DataFrame:
    """Aligned reads from text: qname, flag, rname, pos, mapq, cigar, seq, qual."""
    f = F.split("value", "\t")
    rows = spark.read.text(paths).filter(~F.col("value").startswith("@")).filter(F.size(f) >= 11)
    return rows.select(f[0].alias("qname"), f[1].try_cast("int").alias("flag"), f[2].alias("rname"), f[3].try_cast("long").alias("pos"), f[4].try_cast("int").alias("mapq"), f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"))


def gene_counts(spark: SparkSession, paths: Paths) -> DataFrame:
    """sample (from the file's name), gene, count (the last column)."""
    f = F.split("value", "\t")
    rows = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file")).filter(~F.col("value").startswith("#") & ~F.col("value").startswith("Geneid"))
    return rows.select(F.regexp_replace("file", r"\..*$", "").alias("sample"), f[0].alias("gene"), F.element_at(f, -1).try_cast("double").alias("count"))


def obo(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """terms (id, name, namespace), edges (child, parent) and aliases (alias, id) of an ontology, without obsolete terms."""
    text = spark.read.option("lineSep", "\n\n").text(path) if "\r" not in "".join(r[0] for r in spark.read.option("lineSep", "\n").text(path).limit(1).collect()) else spark.read.option("lineSep", "\r\n\r\n").text(path).select(F.replace("value", F.lit("\r"), F.lit("")).alias("value"))
    stanzas = text.filter(F.trim("value").startswith("[Term]")).filter(~F.col("value").rlike(r"(?m)^is_obsolete:\s*true"))

    def tag(name: str) -> Column:
        return F.regexp_extract("value", rf"(?m)^{name}:\s*(\S.*?)\s*$", 1)

    def tags(pattern: str) -> Column:
        return F.explode(F.regexp_extract_all(F.col("value"), F.lit(pattern), 1))

    terms = stanzas.select(tag("id").alias("id"), tag("name").alias("name"), tag("namespace").alias("namespace"))
    is_a = stanzas.select(tag("id").alias("child"), tags(r"(?m)^is_a:\s*(\S+)").alias("parent"))
    part = stanzas.select(tag("id").alias("child"), tags(r"(?m)^relationship:\s*part_of\s+(\S+)").alias("parent"))
    aliases = stanzas.select(tags(r"(?m)^alt_id:\s*(\S+)").alias("alias"), tag("id").alias("id"))
    return terms, is_a.union(part), aliases


def gaf(spark: SparkSession, path: str, terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """gene, term of positive annotations to known terms."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("!")).filter(F.size(f) >= 9)
    rows = rows.filter(~F.array_contains(F.split(f[3], r"\|"), "NOT") & f[8].isin("P", "F", "C")).select(f[2].alias("gene"), f[4].alias("alias"))
    rows = rows.join(aliases, "alias", "left").select("gene", F.coalesce("id", "alias").alias("id"))
    return rows.join(terms, "id", "left_semi").select("gene", F.col("id").alias("term")).distinct()


def search_parameters(spark: SparkSession, path: str) -> DataFrame:
    """version, peptide and protein thresholds and FASTA files of a search engine's XML."""
    x = spark.read.text(path, wholetext=True)
    return x.selectExpr("xpath_string(value, '//maxQuantVersion') AS version", "xpath_string(value, '//peptideFdr') AS peptide_fdr", "xpath_string(value, '//proteinFdr') AS protein_fdr", "xpath(value, '//fastaFilePath/text()') AS fasta_files")


def findings(spark: SparkSession, paths: Paths, schema: str) -> tuple[DataFrame, DataFrame]:
    """Line-delimited JSON, and the lines that are none."""
    lines = spark.read.text(paths).filter(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", schema + ", _corrupt_record string", {"mode": "PERMISSIVE"}).alias("r"))
    return rows.filter(F.col("r._corrupt_record").isNull()).select("r.*").drop("_corrupt_record"), rows.filter(F.col("r._corrupt_record").isNotNull()).select(F.col("value").alias("_corrupt_record"))


def geometry(spark: SparkSession, path: str) -> DataFrame:
    """event, event_type, chrom, start0, end0, role from a JSON map of events."""
    kind = "MAP<STRING, STRUCT<event_type: STRING, regions: ARRAY<STRUCT<chrom: STRING, start0: BIGINT, end0: BIGINT, role: STRING>>>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("event", "g"))
    return rows.select("event", "g.event_type", F.explode_outer("g.regions").alias("r")).select("event", "event_type", "r.*")


def event_tables(spark: SparkSession, paths: list[str], columns: dict[str, list[str]]) -> DataFrame:
    """Tables of different headers under one set of names; audit, rejected, failed and summary files are skipped."""
    kept = [p for p in paths if not any(w in p.rsplit("/", 1)[-1].lower() for w in ("audit", "rejected", "failed", "summary"))]
    out: DataFrame | None = None
    for p in kept:
        df = tsv(spark, p)
        for name, aliases in columns.items():
            df = coalesce_columns(df, aliases, name)
        df = df.select(*columns)
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("no table of events")
    return out


def discover(spark: SparkSession, paths: Paths, extensions: list[str]) -> DataFrame:
    """path, size of all files below the paths that end in one of the extensions, once each, in natural order; none is an error."""
    from tallyloom.functions.units import natural_key

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", F.col("length").alias("size"))
    ends = F.array(*[F.lit(x.lower()) for x in extensions])
    found = files.filter(F.exists(ends, lambda e: F.endswith(F.lower(F.col("path")), e))).distinct()
    if found.isEmpty():
        raise ValueError(f"no file ends in {extensions}")
    return found.orderBy(natural_key(F.col("path")))


def raw_file_map(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """raw_file, sample of a table that names them by any alias; a gap, an unknown sample or two samples of one file are errors."""
    from tallyloom.functions.units import raw_file_name

    df = coalesce_columns(coalesce_columns(rows, ["raw_file", "Raw file", "raw", "filename"], "_raw"), ["sample", "rna_sample"], "_sample")
    raw, sample = F.coalesce(raw_file_name(F.trim("_raw")), F.lit("")), F.coalesce(F.trim("_sample"), F.lit(""))
    named = df.select(raw.alias("raw_file"), sample.alias("sample")).distinct().join(samples.select("sample", F.lit(True).alias("_known")).distinct(), "sample", "left")
    n = named.groupBy("raw_file").agg(F.min("sample").alias("sample"), F.max("sample").alias("_other"), F.bool_and(F.coalesce("_known", F.lit(False))).alias("_known"))

    def wrong(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(what + ": "), F.col("raw_file"), F.lit(" "), F.col("sample")))

    checked = F.when((F.col("raw_file") == "") | (F.col("sample") == ""), wrong("incomplete row")).when(F.col("sample") != F.col("_other"), wrong("several samples")).when(~F.col("_known"), wrong("unknown sample")).otherwise(F.col("sample"))
    return n.select("raw_file", checked.alias("sample"))


def vcf_headers(spark: SparkSession, paths: Paths) -> DataFrame:
    """file, has_format, has_columns, rows, status (PASS or FAIL): whether a file's header states its format and columns."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file"))
    columns = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"
    n = lines.groupBy("file").agg(F.bool_or(F.startswith("value", F.lit("##fileformat=VCF"))).alias("has_format"), F.bool_or(F.startswith("value", F.lit(columns))).alias("has_columns"), F.count_if(~F.startswith("value", F.lit("#")) & (F.col("value") != "")).alias("rows"))
    return n.withColumn("status", F.when(F.col("has_format") & F.col("has_columns"), "PASS").otherwise("FAIL"))
