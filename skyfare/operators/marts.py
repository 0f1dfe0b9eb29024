"""The fact cube and the five aggregate marts.

``fact_cube`` aggregates the fact once at the finest grain any mart or
aggregate report needs (route x airline version x flight type x day):
flights, exact decimal price sum, min / max price and duration sum.  Sums,
counts, minima and maxima compose, so every mart re-aggregated from the cube
equals the mart computed from the fact, while the fact is scanned once for
all of them and the cube's size is bounded by the dimensions, not by the
number of flights.

Each mart is cube -> dimension joins -> one partial + final aggregate.
``hint`` is applied to the dimension sides: ``F.broadcast`` when the caller
has checked their size, identity otherwise (Spark then picks the join).
Averages are exact decimal arithmetic rounded half away from zero, as the
source store's NUMBER type does; money totals keep decimal type.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_avg, round_ratio_pct
from .joins import unhinted


CUBE_KEYS = ["route_id", "airline_sk", "flight_type_id", "date_id"]


def fact_cube(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("flights"),
        F.sum("price").cast("decimal(28,2)").alias("sum_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("duration").cast("bigint").alias("sum_duration"))


def n_flights():
    return F.coalesce(F.sum("flights"), F.lit(0)).cast("bigint")


def avg_price():
    """ROUND(AVG(price), 2) from cube cells (decimal(28,2) sum keeps 12
    digits of scale in the quotient)."""
    return round_avg(F.sum("sum_price").cast("decimal(28,2)"), F.sum("flights"))


def avg_duration():
    """ROUND(AVG(duration), 0) from cube cells."""
    return F.round(F.sum("sum_duration") / F.sum("flights"), 0).cast("bigint")


def route_analysis(cube: DataFrame, route: DataFrame, airports: DataFrame,
                   hint=unhinted) -> DataFrame:
    o = airports.select(F.col("airport_id").alias("origin_airport_id"),
                        F.col("airport_code").alias("origin_code"),
                        F.col("city").alias("origin_city"))
    d = airports.select(F.col("airport_id").alias("destination_airport_id"),
                        F.col("airport_code").alias("dest_code"),
                        F.col("city").alias("dest_city"))
    r = (route.select("route_id", "origin_airport_id", "destination_airport_id")
              .join(o, "origin_airport_id").join(d, "destination_airport_id")
              .select("route_id", "origin_code", "origin_city", "dest_code", "dest_city"))
    return (cube.join(hint(r), "route_id")
                .groupBy("route_id", "origin_code", "origin_city", "dest_code", "dest_city")
                .agg(n_flights().alias("total_flights"),
                     avg_price().alias("avg_price"),
                     F.min("min_price").alias("min_price"),
                     F.max("max_price").alias("max_price"),
                     avg_duration().alias("avg_duration_min")))


def airline_performance(cube: DataFrame, airline: DataFrame, ftype: DataFrame,
                        hint=unhinted) -> DataFrame:
    """Facts on closed airline versions drop out (current versions only)."""
    a = airline.where(F.col("is_current") == 1).select(
        "airline_sk", F.col("airline_bk").alias("airline_code"), "airline_name", "country")
    ft = ftype.select("flight_type_id", "type_category")
    direct = F.sum(F.when(F.col("type_category") == "direct", F.col("flights")).otherwise(0))
    return (cube.join(hint(a), "airline_sk").join(hint(ft), "flight_type_id")
                .groupBy("airline_code", "airline_name", "country")
                .agg(n_flights().alias("flights_operated"),
                     avg_price().alias("avg_ticket_price"),
                     avg_duration().alias("avg_flight_duration_min"),
                     direct.cast("bigint").alias("direct_flights_count"),
                     round_ratio_pct(direct, F.sum("flights")).alias("direct_flights_percent")))


def temporal_patterns(cube: DataFrame, calendar: DataFrame, hint=unhinted) -> DataFrame:
    c = calendar.select("date_id", "year", "month", "month_name", "day_of_week",
                        "day_name", "is_weekend")
    return (cube.join(hint(c), "date_id")
                .groupBy("year", "month", "month_name", "day_of_week", "day_name", "is_weekend")
                .agg(n_flights().alias("flights_count"),
                     avg_price().alias("avg_price_this_period"),
                     F.sum("sum_price").cast("decimal(38,2)").alias("total_revenue_this_period")))


def flight_type_analysis(cube: DataFrame, ftype: DataFrame, hint=unhinted) -> DataFrame:
    """Share of all facts per flight type; the grand total is an
    uncorrelated scalar subquery (evaluated once, one row)."""
    total = cube.select(F.sum("flights")).scalar()
    return (cube.join(hint(ftype), "flight_type_id")
                .groupBy("flight_type_id", "type_category", "description", "transfers_count")
                .agg(n_flights().alias("total_flights"),
                     avg_price().alias("avg_price_for_type"),
                     avg_duration().alias("avg_duration_for_type"))
                .select("flight_type_id", "type_category", "description", "transfers_count",
                        "total_flights",
                        round_ratio_pct(F.col("total_flights"), total).alias("percentage_of_total"),
                        "avg_price_for_type", "avg_duration_for_type"))


def price_summary(cube: DataFrame, calendar: DataFrame, as_of: dt.date,
                  hint=unhinted) -> DataFrame:
    """Global aggregate for the month of ``as_of``: always exactly one row
    (count 0 and NULLs for an empty month)."""
    c = calendar.where((F.col("month") == as_of.month) & (F.col("year") == as_of.year)) \
                .select("date_id")
    # the month's key range as a plain predicate as well: it reaches the
    # parquet scan and skips row groups outside the month (the cube is
    # written sorted by date_id); the calendar join keeps the semantics
    first = as_of.year * 10000 + as_of.month * 100
    month_cells = cube.where(F.col("date_id").between(first + 1, first + 31))
    f = month_cells.join(hint(c), "date_id")
    return f.agg(F.lit("current_month").alias("period"),
                 n_flights().alias("total_flights"),
                 avg_price().alias("avg_price"),
                 F.round(F.min("min_price"), 2).cast("decimal(18,2)").alias("min_price"),
                 F.round(F.max("max_price"), 2).cast("decimal(18,2)").alias("max_price"),
                 F.sum("sum_price").cast("decimal(38,2)").alias("total_revenue"))
