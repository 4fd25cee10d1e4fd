"""Sinks; Spark writes all files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def tsv(df: DataFrame, path: str, fields: list[str]) -> None:
    """The fields in this order, nulls empty, with a header even without rows."""
    df.select(*fields).write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


def split_by_status(df: DataFrame, path: str, status: str = "status") -> None:
    """One pass, a folder for each status."""
    df.write.mode("overwrite").partitionBy(status).parquet(path)


def bed(df: DataFrame, path: str, name: Column) -> None:
    """chrom, start0, end0 and a name."""
    df.select("chrom", "start0", "end0", name.alias("name")).write.mode("overwrite").option("sep", "\t").csv(path)


def bedpe(df: DataFrame, path: str, name: Column) -> None:
    df.select("chrom", "start0", "end0", "chrom2", "start2_0", "end2", name.alias("name")).write.mode("overwrite").option("sep", "\t").csv(path)


def jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def compact_rows(df: DataFrame, fields: list[str]) -> DataFrame:
    """row: each row as a JSON array of its fields' texts."""
    return df.select(F.to_json(F.array(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])).alias("row"))


def geometry(df: DataFrame, path: str) -> None:
    """event and its type and regions (array of structs) as one JSON object a line, in the order of events."""
    df.select(F.to_json(F.struct("event", "event_type", "regions")).alias("value")).orderBy("value").write.mode("overwrite").text(path)


def fasta(df: DataFrame, path: str, prefix: Column | None = None) -> None:
    """header and sequence, with a prefix such as ``sample|CLASS|``."""
    head = F.col("header") if prefix is None else F.concat(prefix, F.col("header"))
    df.select(F.concat(F.lit(">"), head, F.lit("\n"), F.col("sequence")).alias("value")).write.mode("overwrite").text(path)


def _files(df: DataFrame):
    """The JVM's file system classes, which reach every store that Spark does."""
    jvm = df.sparkSession._jvm
    fs = jvm.org.apache.hadoop.fs
    conf = df.sparkSession._jsc.hadoopConfiguration()
    return lambda path: (fs.Path(path).getFileSystem(conf), fs.Path(path))


def append_once(df: DataFrame, path: str, run: str) -> bool:
    """Appends df to a history under the name of its run, once; whether this call did.

    Parts are written first and named by no one; the file ``commits/<run>``,
    made only where it isn't there yet, publishes them at once.  A repeat of a
    run, at the same time too, changes nothing, and what a failed one has
    written isn't read.
    """
    at = _files(df)
    safe = "".join(c if c.isalnum() or c in "-." else f"_{ord(c):x}" for c in run)
    fs, commit = at(f"{path}/commits/{safe}")
    if fs.exists(commit):
        return False
    part = f"{safe}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/parts/{part}")
    _, draft = at(f"{path}/drafts/{part}")
    out = fs.create(draft, False)
    out.write(bytearray(f"{part}\n".encode()))
    out.close()
    fs.mkdirs(commit.getParent())
    # a rename doesn't replace what is there
    if fs.exists(commit) or not fs.rename(draft, commit):
        fs.delete(at(f"{path}/parts/{part}")[1], True)
        fs.delete(draft, False)
        return False
    return True


def read_history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The published runs' rows; before the first one none."""
    empty = spark.createDataFrame([], schema)
    fs, commits = _files(empty)(f"{path}/commits")
    if not fs.exists(commits):
        return empty
    parts = [r.value for r in spark.read.text(f"{path}/commits").filter("value <> ''").collect()]  # a line a run
    return spark.read.schema(schema).parquet(*[f"{path}/parts/{x}" for x in parts]) if parts else empty


class TooLarge(ValueError):
    """An output beyond its bound; nothing was published."""


def guarded(df: DataFrame, path: str, *, most_rows: int | None = None, most_bytes: int | None = None, write: Callable[[DataFrame, str], None] | None = None) -> dict[str, int]:
    """Writes df, published at path only if it is within both bounds; rows and bytes.

    df is evaluated once: rows are observed as they are written, bytes are
    those of the files.  Beyond a bound what was written goes and TooLarge is
    raised; path stays as it was.  write(df, path) writes it, Parquet otherwise.
    """
    seen = Observation()
    at = _files(df)
    draft = f"{path.rstrip('/')}-draft-{uuid.uuid4().hex}"
    try:
        (write or (lambda d, p: d.write.parquet(p)))(df.observe(seen, F.count(F.lit(1)).alias("rows")), draft)
        fs, folder = at(draft)
        found = {"rows": seen.get["rows"], "bytes": fs.getContentSummary(folder).getLength()}
        for name, most in (("rows", most_rows), ("bytes", most_bytes)):
            if most is not None and found[name] > most:
                raise TooLarge(f"{path}: {found[name]} {name}, {most} at most")
        fs, target = at(path)
        if fs.exists(target):
            fs.delete(target, True)
        fs.rename(folder, target)
        return found
    finally:
        fs, folder = at(draft)
        if fs.exists(folder):
            fs.delete(folder, True)
