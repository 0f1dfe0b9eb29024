"""Type-2 airline dimension on immutable files.

Parquet tables cannot be updated in place, so a merge returns the *next
version* of the dimension (untouched rows + closed rows + inserted rows);
the caller writes it to a new folder and switches to it (see
``plans.warehouse``).  One ``batch_ts`` per run, so a closed version's
``valid_to`` equals its successor's ``valid_from`` exactly.

The work runs over the distinct business keys of the source (bounded by the
airline code domain), never over tickets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import unhinted
from .numbering import dense_number


DIM_AIRLINE_COLUMNS = ["airline_sk", "airline_bk", "airline_name", "country",
                       "valid_from", "valid_to", "is_current"]
REQUIRED_COLUMNS = {"airline_sk", "airline_bk", "valid_from", "valid_to", "is_current"}


def _ts(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


def empty_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "airline_sk bigint, airline_bk string, airline_name string, country string, "
            "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current int")


def source_codes(ods: DataFrame) -> DataFrame:
    """Distinct non-null airline codes of the ODS (partial + final
    aggregate; the result is bounded by the code domain)."""
    return (ods.where(F.col("airline").isNotNull())
               .select(F.col("airline").alias("airline_bk")).distinct())


def scd2_initial(dim: DataFrame, source: DataFrame, batch_ts: str,
                 dim_rows: int) -> DataFrame:
    """First load: one current version per source key, keys 1..n in code
    order.  Skipped (dimension returned as is) when it already has rows."""
    if dim_rows > 0:
        return dim
    return dense_number(source, ["airline_bk"]).select(
        F.col("number").cast("bigint").alias("airline_sk"),
        "airline_bk", "airline_name", "country",
        _ts(batch_ts).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(1).alias("is_current"))


def scd2_changes(dim: DataFrame, source: DataFrame) -> DataFrame:
    """Source keys classified against the current versions:
    new / updated (name or country differs, NULL-safe) / unchanged."""
    cur = dim.where(F.col("is_current") == 1).select(
        "airline_bk", F.col("airline_sk").alias("cur_sk"),
        F.col("airline_name").alias("cur_name"), F.col("country").alias("cur_country"))
    j = source.join(cur, "airline_bk", "left")
    same = (F.col("airline_name").eqNullSafe(F.col("cur_name"))
            & F.col("country").eqNullSafe(F.col("cur_country")))
    status = (F.when(F.col("cur_sk").isNull(), "new")
               .when(~same, "updated").otherwise("unchanged"))
    return j.withColumn("status", status)


def scd2_merge(dim: DataFrame, source: DataFrame, batch_ts: str, hint=unhinted) -> DataFrame:
    """Next version of the dimension after applying ``source``.

    Keys missing from the source stay current.  New surrogate keys continue
    from ``max(airline_sk)`` in code order.
    """
    ch = scd2_changes(dim, source).where(F.col("status") != "unchanged")
    # highest key so far, as an uncorrelated scalar subquery (no driver trip)
    max_sk = dim.select(F.coalesce(F.max("airline_sk"), F.lit(0)).cast("bigint")).scalar()
    closing = (ch.where(F.col("status") == "updated")
                 .select(F.col("cur_sk").alias("airline_sk"), F.lit(True).alias("_close")))
    kept = (dim.join(hint(closing), "airline_sk", "left")
               .select("airline_sk", "airline_bk", "airline_name", "country", "valid_from",
                       F.when(F.col("_close"), _ts(batch_ts)).otherwise(F.col("valid_to"))
                        .alias("valid_to"),
                       F.when(F.col("_close"), F.lit(0)).otherwise(F.col("is_current"))
                        .alias("is_current")))
    inserted = dense_number(ch.select("airline_bk", "airline_name", "country"), ["airline_bk"]).select(
        (max_sk + F.col("number")).cast("bigint").alias("airline_sk"),
        "airline_bk", "airline_name", "country",
        _ts(batch_ts).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(1).alias("is_current"))
    return kept.unionByName(inserted)


def scd2_change_counts(dim: DataFrame, source: DataFrame) -> DataFrame:
    """(status, n) for the source keys: updated / new / unchanged."""
    return (scd2_changes(dim, source).groupBy("status")
            .agg(F.count(F.lit(1)).alias("n")))


def scd2_stats(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("airline_bk").alias("unique_airlines"),
        F.sum(F.when(F.col("is_current") == 1, 1).otherwise(0)).cast("bigint").alias("current_versions"),
        F.sum(F.when(F.col("is_current") == 0, 1).otherwise(0)).cast("bigint").alias("historical_versions"))


def scd2_multiple_current(dim: DataFrame) -> DataFrame:
    """Keys with more than one current version (must be empty)."""
    return (dim.where(F.col("is_current") == 1).groupBy("airline_bk")
               .agg(F.count(F.lit(1)).alias("current_count"))
               .where(F.col("current_count") > 1))


def scd2_no_current(dim: DataFrame) -> DataFrame:
    """Keys with no current version (must be empty)."""
    cur = dim.where(F.col("is_current") == 1).select("airline_bk")
    return (dim.select("airline_bk").join(cur, "airline_bk", "left_anti").distinct())


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current") == 1)


def _month(t: Column) -> Column:
    return F.year(t) * 12 + F.month(t)


def with_version_at(rows: DataFrame, dim: DataFrame, key: str, time: str, hint=unhinted) -> DataFrame:
    """``rows`` with ``airline_sk``, the version of airline ``key`` that was valid at ``time``.

    Intervals are half open (a version ends where its successor starts).  Times
    before a key's first version take that one; a null time takes the current
    version; keys that the dimension does not know give NULL.  Closed versions
    are laid out by the months they cover, so a row meets the versions of one
    month of its key, however many the key has had."""
    v = dim.select(F.col("airline_bk").alias("__bk"), "airline_sk", "valid_from", "valid_to", "is_current")
    ends = v.groupBy("__bk").agg(
        F.max(F.when(F.col("is_current") == 1, F.struct("valid_from", "airline_sk"))).alias("__cur"),
        F.min(F.struct("valid_from", "airline_sk")).alias("__first"))
    closed = (v.where(F.col("valid_to").isNotNull() & (F.col("valid_to") > F.col("valid_from")))
              .select(F.col("__bk").alias("__bk2"), F.col("airline_sk").alias("__sk"), "valid_from", "valid_to",
                      F.explode(F.sequence(_month(F.col("valid_from")), _month(F.col("valid_to")))).alias("__month")))
    t = F.col(time)
    j = (rows.join(hint(ends), F.col(key) == F.col("__bk"), "left")
         .join(hint(closed), (F.col(key) == F.col("__bk2")) & (_month(t) == F.col("__month"))
               & (t >= F.col("valid_from")) & (t < F.col("valid_to")), "left"))
    now = t.isNull() | (t >= F.col("__cur")["valid_from"])
    sk = F.coalesce(F.when(now, F.col("__cur")["airline_sk"]), F.col("__sk"), F.col("__first")["airline_sk"])
    return j.select(*[rows[c] for c in rows.columns], sk.alias("airline_sk"))


def schema_compatible(columns, required=REQUIRED_COLUMNS) -> tuple[bool, list[str]]:
    """Required columns must be a subset of the table's columns."""
    have = {c.lower() for c in columns}
    missing = sorted(c for c in required if c.lower() not in have)
    return (not missing, missing)
