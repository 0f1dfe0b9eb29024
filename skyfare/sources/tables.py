"""Reading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than the cluster has
    cores (e.g. one large single-row-group file), so the map-side work after
    it runs on every core.  A scan of many files already has more partitions
    than cores and passes through untouched."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism  # classic sessions only
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001  (no RDD access, e.g. a Connect session)
        return df
    if parts < cores:
        return df.repartition(cores)
    return df
