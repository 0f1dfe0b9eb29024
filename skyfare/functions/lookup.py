"""Code -> attributes lookup with a default for unknown codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators.joins import unhinted


def airline_lookup_table(spark: SparkSession) -> DataFrame:
    """The fixed 18-code airline lookup as a DataFrame."""
    return spark.createDataFrame(
        fixed.AIRLINE_LOOKUP, "code string, name string, country string")


def with_airline_info(codes: DataFrame, lookup: DataFrame,
                      code_col: str = "airline_bk", hint=unhinted) -> DataFrame:
    """Attach (airline_name, country); unknown codes give (code, 'Unknown').

    ``lookup`` is a code table (code, name, country) with unique codes; it is
    a curated reference list; ``hint`` broadcasts it unless the caller
    found it too large.
    """
    lk = hint(lookup.select(
        F.col("code").alias("_lk_code"), F.col("name").alias("_lk_name"),
        F.col("country").alias("_lk_country")))
    j = codes.join(lk, codes[code_col] == lk["_lk_code"], "left")
    return (j.withColumn("airline_name", F.coalesce("_lk_name", F.col(code_col)))
             .withColumn("country", F.coalesce("_lk_country", F.lit(fixed.UNKNOWN_COUNTRY)))
             .drop("_lk_code", "_lk_name", "_lk_country"))
