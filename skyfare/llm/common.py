"""Shared helpers of the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Workspace:
    """Intermediate tables of one operator run, in the cluster's shared folder.

    ``table`` writes a DataFrame and reads it back: lineage is cut, a lost
    executor costs at most the step that was running, and later joins get
    exact file sizes."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = new_run_dir(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def spread(df: DataFrame) -> DataFrame:
    """Row-level work on a scan of few files: let Spark even out the partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def train_fold(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, mod 3, is not 1."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    """Null ids count as text '' (crc32 0): they belong to the training fold."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def bounded_sample_share(total: int, bound: int) -> float:
    """Share of rows to keep so that about ``bound`` of ``total`` remain."""
    return 1.0 if total <= bound else bound / total


def in_share(key: Column, share: float | Column, seed: int = 17) -> Column:
    """Repeatable sampling by hash: true for about ``share`` of the keys."""
    unit = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return unit < share


class Numbered(dict):
    """Numbers keys in the order they are met; ``new`` lists those that wait for their values."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        n = self[key] = len(self)
        self.new.append(key)
        return n


def kept(name: str, key: tuple, make: Callable):
    """An object of this Python worker process, made anew when ``key`` changes: the tasks
    that a worker runs one after another share what they have looked up."""
    held = sys.modules.setdefault("skyfare_worker", types.ModuleType("skyfare_worker")).__dict__
    if name not in held or held[name][0] != key:
        held[name] = (key, make())
    return held[name][1]


def release(name: str) -> None:
    """Forget what ``kept`` holds under a name."""
    held = sys.modules.get("skyfare_worker")
    if held is not None:
        held.__dict__.pop(name, None)
