"""Exact duplicates by sorting contents.

Spark samples splitters and deals the normalised texts to ranges; inside a range
its external sort puts equal texts side by side, and a run of them ends where a
text differs from its neighbour, whole texts compared.  A run keeps one row.

Only DataFrame functions are used.  Splitters are sampled on the driver, so the
range key is short: a text's first characters, then its hash.  A text that very
many rows share would be one key; such a text's rows are dealt to several runs,
whose first rows are compared once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Work

#: Fixed value: the characters that make no difference, [\x20\x09-\x0D].
IGNORED = " \t\n\x0b\x0c\r"
#: Characters of a text that splitters are taken from, before its hash.
LEAD = 16
#: Rows of one text that a run may have before it is split.
RUN_ROWS = 500
#: Texts that are split at most, which bounds the broadcast; any other text has at most one row in so many.
SPLIT_TEXTS = 100_000
#: Runs that one text's rows are dealt to at most.
RUNS = 10_000


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id, content, chars: a text without its white space, and the original's code points; null counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.translate(text, IGNORED, "").alias("content"), F.char_length(text).cast("long").alias("chars"))


def frequent(rows: DataFrame) -> DataFrame:
    """digest, runs: the texts of most rows, SPLIT_TEXTS at most, and into how many runs each is dealt."""
    counts = rows.groupBy(F.xxhash64("content").alias("digest")).agg(F.count("*").alias("n")).filter(F.col("n") > RUN_ROWS)
    top = counts.orderBy(F.desc("n"), "digest").limit(SPLIT_TEXTS)
    return top.select("digest", F.least(F.ceil(F.col("n") / RUN_ROWS), F.lit(RUNS)).cast("int").alias("runs"))


def sorted_runs(rows: DataFrame) -> DataFrame:
    """Each row with its run's best row and size: doc_id, chars, run, keep, size, first, text_sha256, content.

    run is null where the run holds all rows of its text; content is null but in
    the first row of other runs.
    """
    rows = rows.withColumn("digest", F.xxhash64("content"))
    # rows of equal rank share a run, so that one run alone has the best row
    run = F.when(F.col("runs").isNotNull(), F.pmod(F.xxhash64("doc_id", "chars"), F.col("runs")).cast("int"))
    rows = rows.join(F.broadcast(frequent(rows)), "digest", "left").withColumn("run", run).withColumn("lead", F.substring("content", 1, LEAD))
    ranges = rows.select("lead", "digest", "run", "content", "chars", "doc_id").repartitionByRange("lead", "digest", "run")
    # the ranges' keys are among the window's, so rows stay where they are; the window's runs are equal neighbours
    same = Window.partitionBy("lead", "digest", "run", "content")
    best = same.orderBy(F.desc("chars"), F.asc_nulls_last("doc_id"))
    place = F.row_number().over(best)
    return ranges.select(
        "doc_id",
        "chars",
        "run",
        F.first(F.struct("chars", "doc_id")).over(best).alias("keep"),
        F.count("*").over(same).alias("size"),
        (place == 1).alias("first"),
        F.sha2("content", 256).alias("text_sha256"),
        F.when(F.col("run").isNotNull() & (place == 1), F.col("content")).alias("content"),
    )


def duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    docs: doc_id and text; other columns are not looked at.  Texts are equal
    that are identical without white space; null counts as empty, and so does
    white space alone, so all these are one group.  Of a group the row of most
    code points stays, of those the smallest doc_id, a null one last; of
    repeated rows one stays, and kept is true in exactly one row of a group.
    text_sha256 is that of the normalised text in UTF-8.  An empty table gives
    none.
    """
    runs = Work(spark, "content-sort").save(sorted_runs(normalised(docs)), "runs")
    heads = runs.filter("content IS NOT NULL")
    better = F.struct((-F.col("keep.chars")).alias("less"), F.col("keep.doc_id").isNull().alias("unnamed"), F.col("keep.doc_id").alias("doc_id"))
    whole = heads.groupBy("content").agg(F.min(better).alias("best"), F.sum("size").alias("whole_size"), F.first("text_sha256").alias("text_sha256")).drop("content")
    # at most SPLIT_TEXTS rows
    joined = runs.join(F.broadcast(whole), "text_sha256", "left")
    split = F.col("run").isNotNull()
    won = (F.col("keep.chars") == -F.col("best.less")) & F.col("keep.doc_id").eqNullSafe(F.col("best.doc_id"))
    return joined.select(
        "doc_id",
        F.when(split, F.col("best.doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.when(split, F.col("whole_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("first") & F.when(split, won).otherwise(True)).alias("kept"),
        "text_sha256",
    )
