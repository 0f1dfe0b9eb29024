"""Dimensions: calendar, airports, flight types, routes, airline snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import calendar_columns
from .joins import unhinted
from .numbering import dense_number


DIM_DATE_COLUMNS = ["date_id", "full_date", "year", "quarter", "month",
                    "month_name", "day", "day_of_week", "day_name", "is_weekend"]


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in [start, end] (inclusive), built from ``range`` so
    the rows are generated in parallel rather than in one exploded array."""
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError("calendar end precedes start")
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(days).select(*calendar_columns(d))


def dim_airport_fixed(spark: SparkSession) -> DataFrame:
    """The eleven fixed airports."""
    return spark.createDataFrame(
        fixed.AIRPORTS, "airport_id int, airport_code string, city string, country string")


def dim_flight_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed.FLIGHT_TYPES,
        "flight_type_id int, transfers_count int, type_category string, description string")


def dim_airline_snapshot_fixed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed.AIRLINE_SNAPSHOT,
        "airline_id int, airline_code string, airline_name string, country string")


def route_pairs(ods: DataFrame) -> DataFrame:
    """Distinct (origin, destination) pairs with both ends present.

    The distinct runs as a partial (map-side) + final aggregate, so the
    shuffle carries at most one row per pair per task."""
    return (ods.where(F.col("origin").isNotNull() & F.col("destination").isNotNull())
               .select("origin", "destination").distinct())


ROUTE_COLUMNS = ["route_id", "origin_airport_id", "destination_airport_id", "distance_km",
                 "popularity_category"]


def new_routes(ods: DataFrame, airports: DataFrame, existing: DataFrame | None = None,
               hint=unhinted) -> DataFrame:
    """Routes of ``ods`` that ``existing`` does not hold: distinct pairs whose
    two airports are known, numbered from the highest existing id on in the
    order of their codes (in two passes, see ``numbering``)."""
    ap = hint(airports.select("airport_id", "airport_code"))
    o = ap.select(F.col("airport_id").alias("origin_airport_id"),
                  F.col("airport_code").alias("origin"))
    d = ap.select(F.col("airport_id").alias("destination_airport_id"),
                  F.col("airport_code").alias("destination"))
    pairs = route_pairs(ods).join(o, "origin").join(d, "destination")
    base = F.lit(0)
    if existing is not None:
        pairs = pairs.join(existing.select("origin_airport_id", "destination_airport_id"),
                           ["origin_airport_id", "destination_airport_id"], "left_anti")
        base = existing.select(F.coalesce(F.max("route_id"), F.lit(0))).scalar()
    return dense_number(pairs, ["origin", "destination"]).select(
        (base + F.col("number")).cast("int").alias("route_id"),
        F.col("origin_airport_id").cast("int"),
        F.col("destination_airport_id").cast("int"),
        F.lit(None).cast("int").alias("distance_km"),
        F.lit(None).cast("string").alias("popularity_category"))


def dim_route(ods: DataFrame, airports: DataFrame,
              existing: DataFrame | None = None, hint=unhinted,
              frozen: bool = False) -> DataFrame:
    """Route dimension: the existing routes, which keep their ids, and the new
    ones.  Unknown airports drop a pair.  Pass ``existing=None`` for a first
    build.  ``frozen=True`` keeps an existing dimension as it is (create-once
    behaviour: new routes then become unknown-route rejects).
    """
    if existing is None:
        return new_routes(ods, airports, hint=hint)
    return existing if frozen else existing.unionByName(new_routes(ods, airports, existing, hint))
