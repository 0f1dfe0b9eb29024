"""Synthetic benchmark tickets (the store-comparison test data).

Row i: price 5000 + (i % 10) * 1000, airline 'airline_' || (i % 5),
transfers i % 3, direct when i % 3 = 0.  Generated in parallel from
``range``; used by the benchmark harness only, never as a query input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def generate_tickets(spark: SparkSession, n: int, stamp: str) -> DataFrame:
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("test_ticket_"), i.cast("string")).alias("ticket_id"),
        F.lit("MOW").alias("origin"), F.lit("LED").alias("destination"),
        (F.lit(5000) + (i % 10) * 1000).cast("double").alias("price"),
        F.concat(F.lit("airline_"), (i % 5).cast("string")).alias("airline"),
        F.concat(F.lit("FL"), i.cast("string")).alias("flight_number"),
        (i % 3).cast("int").alias("transfers"),
        ((i % 3) == 0).alias("is_direct"),
        F.lit("2025-10-15").alias("departure_at"),
        F.lit(stamp.replace(" ", "T")).alias("extracted_at"))
