"""Dense numbers 1, 2, 3 ... in an order, without sorting a table in one task.

Two passes: the rows are range-partitioned and sorted within partitions, written
with their place in the partition, and the partitions' row counts (one row per
partition, the only thing that reaches the driver) give each its offset.  Equal
rows get consecutive numbers; nulls come first; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_run_dir


def written(df: DataFrame) -> DataFrame:
    """``df`` stored in a fresh folder of the shared root and read back."""
    path = new_run_dir(df.sparkSession, "numbering")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_number(df: DataFrame, order: list[str], write: Callable[[DataFrame], DataFrame] = written,
                 number: str = "number") -> DataFrame:
    """``df`` with ``number``: its rank by ``order`` from 1 on, without gaps.

    ``write`` stores a DataFrame and reads it back, so that both passes see the
    same partitions."""
    placed = write(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = sorted((r["part"], r["first"], r["n"]) for r in placed.groupBy(part.alias("part"))
                   .agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n")).collect())
    offsets, before = [], 0
    for p, first, n in sizes:
        offsets.append((p, first - before))
        before += n
    # one row per partition of the table
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "__part int, __start long"))
    return (placed.withColumn("__part", part.cast("int")).join(starts, "__part")
            .withColumn(number, F.col("__at") - F.col("__start") + 1).drop("__part", "__at", "__start"))
