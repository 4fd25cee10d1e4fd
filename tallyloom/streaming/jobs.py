"""Two streams over append-only task logs; extensions of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.aggregates import failure_ledger
from tallyloom.sources.writers import append_once


def ledger(tasks: DataFrame, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Appends each failed task once (task_id, ts, status, exit); a repeat within the delay is dropped."""
    rows = failure_ledger(tasks).withWatermark("ts", delay).dropDuplicatesWithinWatermark(["task_id"])
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger_once(tasks: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    """As ledger, into a history that takes each batch once (see writers.append_once), a repeated one too."""

    def publish(batch: DataFrame, number: int) -> None:
        if not append_once(batch, path, f"{name}-{number}"):
            batch.write.format("noop").mode("overwrite").save()  # the batch's state has to be written even so

    rows = failure_ledger(tasks).withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["task_id"])
    return rows.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rollup(tasks: DataFrame, window: str = "1 hour", delay: str = "1 day", max_seconds: float = 43200) -> DataFrame:
    """Per process and window: tasks, greatest and mean runtime, failures, a warning; works on streams and on tables."""
    rows = tasks.withWatermark("ts", delay) if tasks.isStreaming else tasks
    n = rows.groupBy(F.window("ts", window).alias("w"), "process").agg(F.count("*").alias("tasks"), F.max("seconds").alias("max_seconds"), F.avg("seconds").alias("mean_seconds"), F.count_if(~F.col("status").isin("COMPLETED", "CACHED")).alias("failures"))
    return n.select(F.col("w.start").alias("window_start"), "process", "tasks", "max_seconds", "mean_seconds", "failures", (F.col("max_seconds") > max_seconds).alias("slow"))


def write_rollup(tasks: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    return rollup(tasks, **options).writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
