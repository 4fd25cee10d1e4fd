"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores behind it as no column of df has it; Spark compares names without case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``.  Where that is unset in a
    local session, as in tests, a temporary folder is set in its place; on a
    cluster, whose executors can't read one, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found


class Work:
    """Intermediate tables of one run, written as Parquet to the shared folder.

    A written table cuts lineage: an executor that is lost later costs only
    the reading of its files, not the work that made them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.saved: list[DataFrame] = []

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        df.write.option("compression", compression).parquet(path := self.path(name))
        found = self.spark.read.schema(df.schema).parquet(path)
        found._work_path = path
        self.saved.append(found)
        return found

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing needs any more."""
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._work_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, *tables: DataFrame) -> None:
        """Deletes all saved tables but these: what a run's result still reads."""
        paths = {df._work_path for df in tables}
        self.drop(*(df for df in self.saved if df._work_path not in paths))
        self.saved = list(tables)


_WORKER: dict[Hashable, Any] = {}


def per_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: one thing at a time, so that stages don't add up in memory."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]
