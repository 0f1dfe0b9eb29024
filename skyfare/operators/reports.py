"""Report, dashboard and finding queries over the fact and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import oracle_day_text
from ..functions.scalar import oracle_concat, round_avg


def _n():
    return F.count(F.lit(1))


def _avg2(c="price"):
    return round_avg(F.sum(c), _n())


def _cube_n():
    return F.coalesce(F.sum("flights"), F.lit(0)).cast("bigint")


def _cube_avg2():
    return round_avg(F.sum("sum_price").cast("decimal(28,2)"), F.sum("flights"))


def _airport_roles(airports: DataFrame):
    o = airports.select(F.col("airport_id").alias("origin_airport_id"),
                        F.col("airport_code").alias("origin_code"),
                        F.col("city").alias("origin_city"))
    d = airports.select(F.col("airport_id").alias("destination_airport_id"),
                        F.col("airport_code").alias("dest_code"),
                        F.col("city").alias("dest_city"))
    return o, d


def route_cities(route: DataFrame, airports: DataFrame) -> DataFrame:
    """route_id -> (origin/destination codes and cities): one airport table
    in two roles.  Route-sized, so it can be broadcast to the fact."""
    o, d = _airport_roles(airports)
    return (route.select("route_id", "origin_airport_id", "destination_airport_id")
                 .join(o, "origin_airport_id").join(d, "destination_airport_id")
                 .select("route_id", "origin_code", "origin_city", "dest_code", "dest_city"))


def ods_by_destination(ods: DataFrame) -> DataFrame:
    return ods.groupBy("destination").agg(_n().alias("tickets"), _avg2().alias("avg_price"))


def ods_by_category(ods: DataFrame) -> DataFrame:
    return ods.groupBy("price_category").agg(_n().alias("tickets"))


def sample_then_distinct(ods: DataFrame, order_cols, n: int, cols) -> DataFrame:
    """``SELECT DISTINCT cols ... WHERE ROWNUM <= n``: the limit applies
    first.  A total order makes the sample repeatable (top-n per partition,
    then a merge of n rows per partition)."""
    return ods.orderBy(*order_cols).limit(n).select(*cols).distinct()


def price_filter_count(ods: DataFrame, limit: int) -> DataFrame:
    """Range filter + count; the predicate reaches the parquet scan."""
    return (ods.where(F.col("price") < limit)
               .agg(_n().alias("tickets_below"))
               .withColumn("price_limit", F.lit(limit)))


def _id(df):
    return df


def flights_by_type(cube: DataFrame, ftype: DataFrame, hint=_id) -> DataFrame:
    return (cube.join(hint(ftype), "flight_type_id")
                .groupBy("type_category", "flight_type_id")
                .agg(_cube_n().alias("flights"), _cube_avg2().alias("avg_price")))


def top_expensive(fact, route, airports, airline, calendar, ftype, k: int = 10,
                  hint=_id) -> DataFrame:
    """The k dearest flights across the whole star.  The top-k runs as a
    per-partition partial top-k then a merge (TakeOrderedAndProject)."""
    rc = route_cities(route, airports)
    j = (fact.join(hint(rc), "route_id")
             .join(hint(airline.select("airline_sk", "airline_name")), "airline_sk")
             .join(hint(calendar.select("date_id", "full_date")), "date_id")
             .join(hint(ftype.select("flight_type_id", "transfers_count")), "flight_type_id"))
    return (j.select("flight_id",
                     oracle_concat(F.col("origin_city"), F.lit(" -> "), F.col("dest_city"))
                     .alias("route"),
                     "airline_name", oracle_day_text(F.col("full_date")).alias("full_date"),
                     "price", F.col("transfers_count").alias("transfers"), "duration")
             .orderBy(F.col("price").desc(), F.col("flight_id")).limit(k))


def route_city_summary(cube, route, airports, hint=_id) -> DataFrame:
    """Per city pair: airports of one city merge."""
    rc = route_cities(route, airports)
    return (cube.join(hint(rc), "route_id").groupBy("origin_city", "dest_city")
                .agg(_cube_n().alias("flights"), _cube_avg2().alias("avg_price"),
                     F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"))
                .select(oracle_concat(F.col("origin_city"), F.lit(" -> "), F.col("dest_city"))
                        .alias("route"), "flights", "avg_price", "min_price", "max_price"))


def route_short(cube, route, airports, hint=_id) -> DataFrame:
    rc = route_cities(route, airports)
    return (cube.join(hint(rc), "route_id").groupBy("route_id", "origin_city", "dest_city")
                .agg(_cube_n().alias("total_flights"), _cube_avg2().alias("avg_price")))


def airline_stats(cube, airline, k: int | None = 5, hint=_id) -> DataFrame:
    a = airline.where(F.col("is_current") == 1).select("airline_sk", "airline_bk", "airline_name")
    out = (cube.join(hint(a), "airline_sk").groupBy("airline_bk", "airline_name")
               .agg(_cube_n().alias("flight_count"), _cube_avg2().alias("avg_price")))
    if k is not None:
        out = out.orderBy(F.col("flight_count").desc(), F.col("airline_bk")).limit(k)
    return out


def flight_type_stats(cube, ftype, hint=_id) -> DataFrame:
    return (cube.join(hint(ftype.select("flight_type_id", "type_category")), "flight_type_id")
                .groupBy("type_category").agg(_cube_n().alias("flight_count"),
                                              _cube_avg2().alias("avg_price")))


def date_coverage(cube, calendar, hint=_id) -> DataFrame:
    return (cube.join(hint(calendar.select("date_id", "full_date")), "date_id")
                .agg(F.min("full_date").alias("earliest_date"),
                     F.max("full_date").alias("latest_date"),
                     F.countDistinct("date_id").alias("unique_dates")))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(_n().alias("row_count")).select(F.lit(name).alias("table_name"),
                                                     "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def top_routes(route_mart: DataFrame, k: int = 10) -> DataFrame:
    return (route_mart.select("route_id", "origin_city", "dest_city", "total_flights")
                      .orderBy(F.col("total_flights").desc(), F.col("route_id")).limit(k))


def top3_routes(route_mart: DataFrame) -> DataFrame:
    return (route_mart.orderBy(F.col("total_flights").desc(), F.col("route_id")).limit(3)
                      .select(oracle_concat(F.col("origin_city"), F.lit(" -> "),
                                            F.col("dest_city")).alias("route"),
                              "total_flights"))


def price_by_weekday(temporal: DataFrame) -> DataFrame:
    """Weighted average price per weekday from the temporal mart."""
    return (temporal.groupBy("day_of_week", "day_name")
                    .agg(F.sum("flights_count").alias("flights"),
                         round_avg(F.sum("total_revenue_this_period").cast("decimal(28,2)"),
                                   F.sum("flights_count")).alias("avg_price")))


def filtered_airlines(cube, airline, ftype, airline_codes=None,
                      type_categories=None, hint=_id) -> DataFrame:
    """Dashboard filters (airline, flight type) applied to the airline table
    dataset; filters are plain predicates, pushed below the aggregate."""
    a = airline.where(F.col("is_current") == 1).select(
        "airline_sk", F.col("airline_bk").alias("airline_code"), "airline_name")
    ft = ftype.select("flight_type_id", "type_category")
    if airline_codes is not None:
        a = a.where(F.col("airline_code").isin(list(airline_codes)))
    if type_categories is not None:
        ft = ft.where(F.col("type_category").isin(list(type_categories)))
    return (cube.join(hint(a), "airline_sk").join(hint(ft), "flight_type_id")
                .groupBy("airline_code", "airline_name")
                .agg(_cube_n().alias("flights"), _cube_avg2().alias("avg_price")))


def _first(df: DataFrame, finding: str, label: str, value, order) -> DataFrame:
    return (df.orderBy(*order).limit(1)
              .select(F.lit(finding).alias("finding"), F.col(label).alias("label"),
                      value.cast("double").alias("value")))


def findings(temporal: DataFrame, airline_mart: DataFrame, type_mart: DataFrame) -> DataFrame:
    """Headline findings as (finding, label, value) rows."""
    wd = price_by_weekday(temporal)
    rows = [
        _first(wd, "dearest_weekday", "day_name", F.col("avg_price"),
               [F.col("avg_price").desc(), F.col("day_of_week")]),
        _first(wd, "cheapest_weekday", "day_name", F.col("avg_price"),
               [F.col("avg_price").asc(), F.col("day_of_week")]),
        _first(airline_mart, "busiest_airline", "airline_name", F.col("flights_operated"),
               [F.col("flights_operated").desc(), F.col("airline_code")]),
        _first(airline_mart, "dearest_airline", "airline_name", F.col("avg_ticket_price"),
               [F.col("avg_ticket_price").desc(), F.col("airline_code")]),
        type_mart.agg(F.lit("total_flights").alias("finding"),
                      F.lit(None).cast("string").alias("label"),
                      F.sum("total_flights").cast("double").alias("value")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def schema_report(spark: SparkSession, tables: dict[str, DataFrame], required) -> DataFrame:
    """Schema compatibility of tables: required columns must be a subset.
    Reads only table metadata (schemas), never rows."""
    from .scd2 import schema_compatible
    rows = []
    for name, df in tables.items():
        ok, missing = schema_compatible(df.columns, required)
        rows.append((name, ok, ",".join(missing)))
    return spark.createDataFrame(rows, "table_name string, compatible boolean, "
                                       "missing_columns string")


def fastest(timings: DataFrame, name_col: str = "store", time_col: str = "seconds") -> DataFrame:
    """Arg-min over measured times."""
    return timings.agg(F.min_by(name_col, time_col).alias(f"fastest_{name_col}"),
                       F.min(time_col).alias(time_col))
