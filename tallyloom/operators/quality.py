"""Data-quality checks: each gives the rows or counts that speak against a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, if it has the columns, and each once."""
    missing = [c for c in columns if c not in df.columns]
    twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if missing or twice:
        raise ValueError(f"missing columns {missing}, repeated columns {twice}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the table is empty")
    return df


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key, violation: one row for each rule that a row breaks; a null condition isn't broken."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in rules.items()]))
    return df.select(key, F.explode(broken).alias("violation"))


def finding_invariants(findings: DataFrame) -> DataFrame:
    """Breaches by findings (event_id, alt, ref, excluded, callable, examined, status, alt_fraction)."""
    from tallyloom.functions.cigar import evidence_status

    return violations(
        findings,
        "event_id",
        {
            "CALLABLE_NOT_ALT_PLUS_REF": F.col("callable") != F.col("alt") + F.col("ref"),
            "EXAMINED_NOT_CALLABLE_PLUS_EXCLUDED": F.col("examined") != F.col("callable") + F.col("excluded"),
            "STATUS_DOES_NOT_MATCH_COUNTS": F.col("status") != evidence_status(F.col("alt"), F.col("ref")),
            "FRACTION_WITHOUT_CALLABLE": (F.col("callable") == 0) & F.col("alt_fraction").isNotNull(),
            "NO_FRACTION_DESPITE_CALLABLE": (F.col("callable") > 0) & F.col("alt_fraction").isNull(),
        },
    )


def region_invariants(findings: DataFrame) -> DataFrame:
    """Breaches by findings (event_id, event_type, stated_type, regions, context, visual_status) of what their regions have to be."""
    roles = F.transform("regions", lambda r: r["role"])
    seen = F.when(F.coalesce("context", F.lit(0)) > 0, "CONTEXT_ALIGNMENTS_AVAILABLE").otherwise("NO_CONTEXT_ALIGNMENTS")
    wrong = F.exists("regions", lambda r: (F.coalesce(r["chrom"], F.lit("")) == "") | (r["start0"] < 0) | (r["end0"] <= r["start0"]))
    there = F.size("regions") > 0
    kind = F.col("event_type")
    return violations(
        findings.withColumn("regions", F.coalesce("regions", F.array().cast("array<struct<chrom:string,start0:bigint,end0:bigint,role:string>>"))),
        "event_id",
        {
            "NO_REGIONS": ~there,
            "EVENT_TYPE": there & ~F.col("stated_type").eqNullSafe(kind),
            "INVALID_REGION": there & wrong,
            "FUSION_BREAKPOINTS": there & (kind == "FUSION") & ((F.size("regions") < 2) | (F.array_sort(F.array_distinct(roles)) != F.array(F.lit("BREAKPOINT_1"), F.lit("BREAKPOINT_2")))),
            "SPLICE_REGIONS": there & (kind == "SPLICE_JUNCTION") & F.exists(roles, lambda r: r != "JUNCTION"),
            "VISUAL_STATUS": there & kind.isin("FUSION", "SPLICE_JUNCTION", "CONTEXT_EVENT") & ~F.col("visual_status").eqNullSafe(seen),
        },
    )


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def samplesheet_problems(samples: DataFrame) -> DataFrame:
    """problem, value: repeated samples and runs, unknown truth values, subjects with several baselines."""
    low = F.lower("baseline")
    return (
        duplicates(samples, ["sample"])
        .select(F.lit("DUPLICATE_SAMPLE").alias("problem"), F.col("sample").alias("value"))
        .union(duplicates(samples.filter(F.col("srr") != ""), ["srr"]).select(F.lit("DUPLICATE_RUN"), "srr"))
        .union(samples.filter(~F.coalesce(low, F.lit("")).isin("true", "false")).select(F.lit("BASELINE_NOT_TRUE_OR_FALSE"), "sample"))
        .union(samples.filter(low == "true").groupBy("subject").count().filter("count > 1").select(F.lit("MULTIPLE_BASELINES"), "subject"))
    )


def bed_problems(rows: DataFrame) -> DataFrame:
    """file, bad: numbers of intervals (start, end) below 0 or not of positive length."""
    return rows.groupBy("file").agg(F.count("*").alias("n"), F.count_if((F.col("start") < 0) | (F.col("end") <= F.col("start"))).alias("bad"))


def rectangular(spark: SparkSession, paths: str | list[str], sep: str = "\t") -> DataFrame:
    """file, rows, bad_rows: lines whose number of fields isn't that of the file's first line."""
    lines = spark.read.text(paths).select(F.input_file_name().alias("file"), F.size(F.split("value", sep)).alias("w"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    head = lines.groupBy("file").agg(F.min_by("w", F.struct("b", "i")).alias("h"))
    return lines.join(head, "file").groupBy("file").agg((F.count("*") - 1).alias("rows"), F.count_if(F.col("w") != F.col("h")).alias("bad_rows"))


#: Bytes that a task reads of a file at once, and that tasks are dealt at least.
BLOCK_BYTES, TASK_BYTES = 1 << 22, 1 << 28


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, size, modified, sha256 of all files below a folder, of any size.

    Tasks stream the files, dealt by size, so no file is a value.  They open
    them with Arrow's file systems, which know local and mounted folders and the
    usual stores; a path of another scheme is read by Spark, up to its limit of
    2 GB a file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    listed = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    total = listed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*"), F.first("path")).first()
    if total[2] and total[2].split(":", 1)[0] not in ("file", "s3", "gs", "hdfs", "abfs", "abfss"):
        return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    tasks = max(1, min(total[1], total[0] // TASK_BYTES + 1))

    def digest(batches):
        import hashlib
        import urllib.parse

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                # Arrow wants file:///x with escapes, Spark gives file:/x without
                store, place = (fs.LocalFileSystem(), "/" + name.split(":", 1)[1].lstrip("/")) if name.startswith("file:") else fs.FileSystem.from_uri(urllib.parse.quote(name, safe=":/@"))
                sha = hashlib.sha256()
                with store.open_input_stream(place, buffer_size=0) as stream:
                    while block := stream.read(BLOCK_BYTES):
                        sha.update(block)
                found.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "sha256"])

    return listed.repartition(tasks, "path", "size").mapInArrow(digest, "path string, size long, modified timestamp, sha256 string")


def verify_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """path, status (OK, MISSING, MISMATCH) of a manifest (path, sha256)."""
    both = manifest.select("path", F.col("sha256").alias("want")).join(files.select("path", F.col("sha256").alias("have")), "path", "left")
    return both.select("path", F.when(F.col("have").isNull(), "MISSING").when(F.col("have") == F.col("want"), "OK").otherwise("MISMATCH").alias("status"))


def artifact_contract(files: DataFrame, contracts: list[tuple[str, str, int]]) -> DataFrame:
    """label, found, needed, status: files of a size over 0 that match a pattern; contracts is a list of the caller's."""
    known = F.array(*[F.struct(F.lit(n).alias("label"), F.lit(p).alias("pattern"), F.lit(k).alias("needed")) for n, p, k in contracts])
    one = files.sparkSession.range(1).select(F.explode(known).alias("c")).select("c.*")
    hits = files.filter("size > 0").withColumn("c", F.explode(known)).filter(F.rlike("path", "c.pattern")).groupBy("c.label").agg(F.count("*").alias("found"))
    out = one.join(hits, "label", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return out.select("label", "found", "needed", F.when(F.col("found") >= F.col("needed"), "PASS").otherwise("FAIL").alias("status"))


def trace_check(tasks: DataFrame) -> DataFrame:
    """problem, value, n: tasks that didn't end well and repeated task ids."""
    bad = tasks.filter(~F.col("status").isin("COMPLETED", "CACHED")).groupBy("status").agg(F.count("*").alias("n")).select(F.lit("BAD_STATUS").alias("problem"), F.col("status").alias("value"), "n")
    return bad.union(duplicates(tasks, ["task_id"]).select(F.lit("DUPLICATE_TASK"), F.col("task_id").cast("string"), "n"))


def coverage_diff(declared: DataFrame, observed: DataFrame, required: DataFrame) -> DataFrame:
    """name, problem: required but not declared, or declared but not observed."""
    a = required.select("name").subtract(declared.select("name")).withColumn("problem", F.lit("NOT_DECLARED"))
    return a.union(declared.select("name").subtract(observed.select("name")).withColumn("problem", F.lit("NOT_OBSERVED")))
