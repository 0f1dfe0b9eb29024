"""Data-quality checks as DataFrames.

Every check is an aggregate over the warehouse tables; reports are built by
``unionByName`` of one-row aggregates (no driver round trips, no cross
joins).  Report rows: (check_name, value, threshold, passed, severity).
Only ``assert_marts_nonempty`` raises; callers decide about the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import unhinted


def price_anomalies(fact: DataFrame, max_price: int = 1_000_000) -> DataFrame:
    return fact.where(_is_anomaly(max_price))


def null_key_rows(fact: DataFrame) -> DataFrame:
    return fact.where(_has_null_key())


def _is_anomaly(max_price: int):
    return (F.col("price") <= 0) | (F.col("price") > max_price)


def _has_null_key():
    return F.col("route_id").isNull() | F.col("airline_sk").isNull() | F.col("date_id").isNull()


def with_links(fact: DataFrame, route: DataFrame, airline: DataFrame,
               calendar: DataFrame, ftype: DataFrame, hint=unhinted) -> DataFrame:
    """The fact with ``_broken``: whether any of its four keys is dangling.

    Every dimension key is unique, so each lookup adds a flag and no rows."""
    def flag(df, key, name):
        return hint(df.select(key, F.lit(True).alias(name)))
    j = (fact.join(flag(route, "route_id", "_r"), "route_id", "left")
             .join(flag(airline, "airline_sk", "_a"), "airline_sk", "left")
             .join(flag(calendar, "date_id", "_d"), "date_id", "left")
             .join(flag(ftype, "flight_type_id", "_t"), "flight_type_id", "left"))
    broken = F.col("_r").isNull() | F.col("_a").isNull() | F.col("_d").isNull() | F.col("_t").isNull()
    return j.withColumn("_broken", broken).drop("_r", "_a", "_d", "_t")


def broken_links(fact: DataFrame, route: DataFrame, airline: DataFrame,
                 calendar: DataFrame, ftype: DataFrame, hint=unhinted) -> DataFrame:
    """Facts with any dangling foreign key."""
    return with_links(fact, route, airline, calendar, ftype, hint).where("_broken").drop("_broken")


def _count_check(df: DataFrame, name: str, limit: float, op: str, severity: str) -> DataFrame:
    v = F.count(F.lit(1)).cast("double")
    return df.agg(_row(name, v, limit, op, severity))


def _row(name: str, value, limit: float, op: str, severity: str):
    passed = {"eq": value == F.lit(limit), "ge": value >= F.lit(limit),
              "gt": value > F.lit(limit)}[op]
    return F.struct(F.lit(name).alias("check_name"), value.alias("value"),
                    F.lit(float(limit)).alias("threshold"), F.lit(op).alias("rule"),
                    passed.alias("passed"), F.lit(severity).alias("severity")).alias("r")


def _flatten(df: DataFrame) -> DataFrame:
    return df.select("r.*")


def volume(ods: DataFrame, fact: DataFrame) -> DataFrame:
    """ODS rows, fact rows and round(fact/ods*100, 2) (0 when ODS empty).

    Both counts come from one pass over the union of the two key columns."""
    u = (ods.select(F.lit(1).alias("_o"), F.lit(0).alias("_f"))
            .unionByName(fact.select(F.lit(0).alias("_o"), F.lit(1).alias("_f"))))
    a = u.agg(F.coalesce(F.sum("_o"), F.lit(0)).cast("bigint").alias("ods_rows"),
              F.coalesce(F.sum("_f"), F.lit(0)).cast("bigint").alias("dds_rows"))
    pct = F.when(F.col("ods_rows") > 0,
                 F.round((F.col("dds_rows") * F.lit(100)).cast("decimal(28,2)")
                         / F.col("ods_rows"), 2).cast("double")).otherwise(F.lit(0.0))
    return a.withColumn("success_pct", pct)


def _report(sums: DataFrame, checks: list) -> DataFrame:
    """Rows of a report from one row of sums: (name, value column, limit, rule, severity)."""
    rows = F.array(*[_row(*c) for c in checks])
    return _flatten(sums.select(F.explode(rows).alias("r")))


def _int(c):
    return F.coalesce(c, F.lit(False)).cast("int")


def dq_report(ods: DataFrame, fact: DataFrame, min_success_pct: float = 90.0,
              max_price: int = 1_000_000) -> DataFrame:
    """Volume, price anomalies and null keys in one pass over the ODS and the fact."""
    zero = F.lit(0)
    u = (ods.select(F.lit(1).alias("_o"), zero.alias("_f"), zero.alias("_p"), zero.alias("_n"))
            .unionByName(fact.select(zero.alias("_o"), F.lit(1).alias("_f"),
                                     _int(_is_anomaly(max_price)).alias("_p"),
                                     _int(_has_null_key()).alias("_n"))))
    a = u.agg(*[F.coalesce(F.sum(c), zero).cast("bigint").alias(c) for c in ("_o", "_f", "_p", "_n")])
    pct = F.when(F.col("_o") > 0, F.round((F.col("_f") * F.lit(100)).cast("decimal(28,2)") / F.col("_o"), 2)
                 .cast("double")).otherwise(F.lit(0.0))
    return _report(a, [("volume_success_pct", pct, min_success_pct, "ge", "warning"),
                       ("price_anomalies", F.col("_p").cast("double"), 0, "eq", "warning"),
                       ("null_foreign_keys", F.col("_n").cast("double"), 0, "eq", "warning")])


def fact_validate(fact: DataFrame, route, airline, calendar, ftype,
                  max_price: int = 1_000_000, hint=unhinted) -> DataFrame:
    """Row count, dangling keys and price anomalies in one pass over the fact."""
    a = with_links(fact, route, airline, calendar, ftype, hint).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        F.count_if("_broken").cast("double").alias("_b"),
        F.count_if(_is_anomaly(max_price)).cast("double").alias("_p"))
    return _report(a, [("total_rows", F.col("_n"), 0, "gt", "error"),
                       ("broken_links", F.col("_b"), 0, "eq", "error"),
                       ("price_anomalies", F.col("_p"), 0, "eq", "warning")])


def missing_airlines(ods: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-null ODS airline codes absent from ``dim[key]``
    (``NOT IN`` over a NOT NULL key == anti join)."""
    return (ods.where(F.col("airline").isNotNull()).select("airline").distinct()
               .join(dim.select(F.col(key).alias("airline")), "airline", "left_anti"))


def scd2_validate(dim: DataFrame, ods: DataFrame) -> DataFrame:
    from .scd2 import current_versions, scd2_multiple_current, scd2_no_current
    multi = _count_check(scd2_multiple_current(dim), "multiple_current_versions", 0, "eq",
                         "error")
    none = _count_check(scd2_no_current(dim), "keys_without_current_version", 0, "eq",
                        "error")
    miss = _count_check(missing_airlines(ods, current_versions(dim), "airline_bk"),
                        "ods_airlines_missing_current", 0, "eq", "warning")
    return _flatten(multi).unionByName(_flatten(none)).unionByName(_flatten(miss))


def mart_counts(marts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in marts.items():
        one = _flatten(_count_check(df, name, 0, "gt", "error"))
        out = one if out is None else out.unionByName(one)
    return out


def assert_marts_nonempty(marts: dict[str, DataFrame]) -> None:
    """Raise when any mart is empty (the one check that fails a run)."""
    empty = mart_counts(marts).where(~F.col("passed")).select("check_name").collect()
    if empty:
        raise ValueError(f"empty marts: {[r[0] for r in empty]}")
