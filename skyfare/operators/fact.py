"""Fact load: lookups, named rejects and first-wins de-duplication.

Plan shape: ODS scan -> completeness filter -> date parsing -> broadcast
lookups (routes, current airline versions, calendar) -> reject reason ->
ONE aggregate by ``flight_id`` (sort-based, as its buffer holds a struct;
it spills like any sort).  That aggregate keeps, per key, the
first valid row (minimum of an ordered struct, so the choice is total and
repeatable), the number of valid rows (duplicates = n - 1) and the number of
rows per reject reason.  Partial aggregation runs map-side, so a hot key
(say a third of all rows) collapses to one row per task before the shuffle;
no window sorts a hot group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, parse_ts
from ..functions.scalar import flight_type_id
from .joins import unhinted


FACT_COLUMNS = ["flight_id", "route_id", "airline_sk", "date_id", "flight_type_id",
                "price", "duration", "extracted_at"]

# reject reasons in the order they are tested; the first failure names it
REASONS = ["bad_departure_date", "unknown_route", "unknown_airline",
           "null_duration", "date_outside_calendar", "null_flight_id"]
REQUIRED = ["origin", "destination", "departure_at", "price", "airline"]


def complete_rows(ods: DataFrame) -> DataFrame:
    """Rows with all five required columns present (others are skipped
    silently, as the source query filtered them)."""
    cond = None
    for c in REQUIRED:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return ods.where(cond)


def route_codes(dim_route: DataFrame, airports: DataFrame, hint=unhinted) -> DataFrame:
    """(origin, destination, route_id): routes with their two airport codes."""
    o = airports.select(F.col("airport_id").alias("origin_airport_id"),
                        F.col("airport_code").alias("origin"))
    d = airports.select(F.col("airport_id").alias("destination_airport_id"),
                        F.col("airport_code").alias("destination"))
    return (dim_route.join(hint(o), "origin_airport_id")
                     .join(hint(d), "destination_airport_id")
                     .select("origin", "destination", "route_id"))


def stage(ods: DataFrame, routes: DataFrame, airline_current: DataFrame,
          calendar: DataFrame, batch_ts: str) -> DataFrame:
    """Per complete ticket: looked-up keys and the first failing reason.

    ``routes`` (origin, destination, route_id), ``airline_current``
    (airline_bk, airline_sk, one row per key) and ``calendar`` (date_id) are
    dimension-sized; the caller decides whether they are broadcast.
    """
    dep = parse_ts(F.col("departure_at"))
    ext = F.coalesce(parse_ts(F.col("extracted_at")), F.lit(batch_ts).cast("timestamp_ntz"))
    t = (complete_rows(ods)
         .select(F.col("ticket_id").alias("flight_id"), "origin", "destination", "airline",
                 F.col("price").cast("decimal(18,2)").alias("price"),
                 F.col("duration").cast("int").alias("duration"),
                 flight_type_id(F.col("transfers")).alias("flight_type_id"),
                 dep.alias("departure_ts"), ext.alias("extracted_at"))
         .withColumn("date_id", date_key(F.col("departure_ts"))))
    cal = calendar.select("date_id", F.lit(True).alias("_in_calendar"))
    al = airline_current.select(F.col("airline_bk").alias("airline"), "airline_sk")
    j = (t.join(routes, ["origin", "destination"], "left")
          .join(al, "airline", "left")
          .join(cal, "date_id", "left"))
    reason = (F.when(F.col("departure_ts").isNull(), "bad_departure_date")
               .when(F.col("route_id").isNull(), "unknown_route")
               .when(F.col("airline_sk").isNull(), "unknown_airline")
               .when(F.col("duration").isNull(), "null_duration")
               .when(F.col("_in_calendar").isNull(), "date_outside_calendar")
               .when(F.col("flight_id").isNull(), "null_flight_id"))
    return j.withColumn("reject_reason", reason).drop("_in_calendar")


def outcomes(staged: DataFrame, airline: str = "airline_sk") -> DataFrame:
    """One row per flight_id: the winning row (struct, NULL if none valid),
    valid-row count and per-reason counts.  Single shuffle.

    ``airline="airline"`` keeps the airline's code in place of a version's key:
    such rows stay right when the dimension gets new versions, and outcomes of
    several loads merge (``merge_outcomes``)."""
    valid = F.col("reject_reason").isNull()
    first = F.struct("extracted_at", "departure_ts", "price", "duration", "route_id",
                     airline, "flight_type_id", "date_id")
    aggs = [F.min(F.when(valid, first)).alias("w"),
            F.count(F.when(valid, F.lit(1))).alias("n_valid")]
    aggs += [F.count(F.when(F.col("reject_reason") == r, F.lit(1))).alias(f"n_{r}")
             for r in REASONS]
    return staged.groupBy("flight_id").agg(*aggs)


def merge_outcomes(out: DataFrame) -> DataFrame:
    """Outcomes of several loads as one: the first winner, counts added.  On a
    table bucketed by flight_id this is one aggregate without a shuffle."""
    return out.groupBy("flight_id").agg(
        F.min("w").alias("w"), F.sum("n_valid").alias("n_valid"),
        *[F.sum(f"n_{r}").alias(f"n_{r}") for r in REASONS])


def facts_by_code(out: DataFrame, airline_current: DataFrame) -> DataFrame:
    """Facts of outcomes kept by airline code, on the current versions."""
    al = airline_current.select(F.col("airline_bk").alias("__bk"), "airline_sk")
    f = out.where(F.col("w").isNotNull()).select("flight_id", "w.*")
    return (f.join(al, F.col("airline") == F.col("__bk"))
            .select("flight_id", F.col("route_id").cast("int").alias("route_id"),
                    F.col("airline_sk").cast("bigint").alias("airline_sk"), "date_id", "flight_type_id",
                    "price", "duration", "extracted_at"))


def fact_from_outcomes(out: DataFrame) -> DataFrame:
    return (out.where(F.col("w").isNotNull())
               .select("flight_id", F.col("w.route_id").cast("int").alias("route_id"),
                       F.col("w.airline_sk").cast("bigint").alias("airline_sk"),
                       F.col("w.date_id").alias("date_id"),
                       F.col("w.flight_type_id").alias("flight_type_id"),
                       F.col("w.price").alias("price"),
                       F.col("w.duration").alias("duration"),
                       F.col("w.extracted_at").alias("extracted_at")))


def rejects_from_outcomes(out: DataFrame) -> DataFrame:
    """(flight_id, reject_reason, n_rows) for every key with rejected rows;
    duplicates are the valid rows beyond the first."""
    pairs = ", ".join(f"'{r}', n_{r}" for r in REASONS)
    long = out.selectExpr(
        "flight_id",
        f"stack({len(REASONS) + 1}, 'duplicate_key', greatest(n_valid - 1, 0), {pairs}) "
        "as (reject_reason, n_rows)")
    return long.where(F.col("n_rows") > 0)


def load_stats(out: DataFrame) -> DataFrame:
    """Load counters as one row: complete rows, inserted, errors by kind
    and the success percentage (0 when there was nothing to load)."""
    n_reason = {r: F.sum(f"n_{r}") for r in REASONS}
    total = F.sum("n_valid")
    for r in REASONS:
        total = total + F.sum(f"n_{r}")
    inserted = F.count(F.col("w"))
    agg = out.agg(total.alias("complete_rows"), inserted.alias("inserted"),
                  (F.sum("n_valid") - inserted).alias("duplicate_key"),
                  *[v.alias(k) for k, v in n_reason.items()])
    errors = F.col("complete_rows") - F.col("inserted")
    pct = F.when(F.col("complete_rows") > 0,
                 F.round((F.col("inserted") * F.lit(100)).cast("decimal(28,2)")
                         / F.col("complete_rows"), 2).cast("double")).otherwise(F.lit(0.0))
    cols = ["complete_rows", "inserted", "duplicate_key"] + REASONS
    return agg.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols],
                      F.coalesce(errors, F.lit(0)).cast("bigint").alias("errors"),
                      pct.alias("success_pct"))
