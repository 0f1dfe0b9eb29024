"""Fare feeds as landing JSON, built from the driver tables.

Three feeds, each one JSON object per request, as the fare API returns them:

* grouped prices  request (origin, destination, month, poll); ``data`` maps
                  departure day -> ticket
* city directions request (origin, day, poll); ``data`` maps destination ->
                  ticket
* price calendar  request (origin, destination, month, poll); ``data`` maps
                  day -> ticket

A landing record is ``{"origin", "destination", "month", "poll", "body"}``
where ``body`` is the raw response text (``month`` is the day for directions).
An API is polled again and again and answers one ticket per route and day each
time, so every flight lands once: the flights of a route and day are numbered,
and the number is the poll.  The numbering runs within salted (route, day)
groups, so no window holds a whole hot route, and an object holds at most 31
entries (one per day of a month) or one per destination.

Fault cases, so the parser's failure paths run over real volumes:

object level (by the request's nation keys ``o``, ``d``)
    o = d -> ``success: false``;  o+d = 5 -> no ``data``;  o+d = 7 -> ``data``
    is an array;  o+d = 9 -> empty body;  o+d = 11 -> truncated JSON;
    o+d = 13 -> ``success: 1``;  o+d = 15 -> ``success: "yes"`` (both load)
ticket level (by the ticket's duration in minutes)
    10 -> price missing;  20 -> price null;  30 -> price "abc";  40 -> price
    as text;  50 -> transfers as text;  60 -> airline and flight number
    missing;  70 -> transfers missing;  80 -> duration missing;
    90 -> transfers "x";  100 -> price 1e20;  110 -> price "nan";
    120 -> transfers 2**40;  130 -> duration 99999999999
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import transient_shuffles

# fixture fault rules (request level, by nation keys)
OBJECT_FAULTS = {"not_success": "o = d", "no_data": "o + d = 5", "data_not_object": "o + d = 7",
                 "empty_body": "o + d = 9", "broken_json": "o + d = 11"}
DIRECTION_FAULTS = {"not_success": "o = 7", "no_data": "o = 5", "data_not_object": "o = 13",
                    "empty_body": "o = 9", "broken_json": "o = 11"}


def flights(lines: DataFrame) -> DataFrame:
    """Every joined lineitem (``fixture.joined_lines``) as a priced flight
    with its route's nation keys: the columns that number it and that its
    texts are written from."""
    return lines.select(
        "o", "d", "origin", "destination",
        F.to_date("l_shipdate").alias("day"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("p_brand").alias("airline"),
        (F.col("l_quantity").cast("int") * 10).alias("duration"),
        "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _written(polled: DataFrame) -> DataFrame:
    """Polled flights with the values that their feed entries show."""
    hh = F.lpad(F.col("l_linenumber").cast("string"), 2, "0")
    return polled.withColumns({
        "flight_number": F.col("l_partkey"),
        "transfers": (F.col("l_linenumber") - 1).cast("int"),
        "departure_at": F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T"), hh, F.lit(":30:00")),
        "return_at": F.concat(F.date_format(F.date_add("day", 7), "yyyy-MM-dd"), F.lit("T18:00:00")),
        "expires_at": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")})


#: Sub-groups of a (route, day) that are numbered on their own.
POLL_SALTS = 8

#: What the objects of a feed are grouped by, beside the poll and its salt.
MONTHLY = ["o", "d", "origin", "destination", "month"]
DAILY = ["o", "origin", "day"]


def polls(fl: DataFrame, salts: int = POLL_SALTS, by: list[str] | None = None) -> DataFrame:
    """Every flight with the ``poll`` that returned it: its number among the
    flights of its route and day, in a total order that starts with the line's
    keys.  Polls of salted sub-groups interleave, so they never collide.

    ``by`` (``MONTHLY``, ``DAILY``) are keys coarser than route and day: the
    rows are dealt by them and the salt, so that numbering and the grouping
    into objects that follows share one shuffle."""
    fl = fl.withColumns({"salt": F.pmod(F.col("l_orderkey"), F.lit(salts)), "month": F.trunc("day", "month")})
    if by:
        fl = fl.repartition(*by, "salt")
    w = (Window.partitionBy("o", "d", "origin", "destination", "month", "day", "salt")
         .orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price", "airline", "duration", "o_orderdate"))
    return fl.withColumn("poll", (F.col("salt") + F.lit(salts) * (F.row_number().over(w) - 1)).cast("int"))


def _text(c: Column) -> Column:
    """A text as a JSON string."""
    escaped = F.to_json(F.struct(c.alias("v")))
    return (F.when(c.rlike(r'[\x00-\x1f"\\\\]'), escaped.substr(F.lit(6), F.length(escaped) - 6))
             .otherwise(_quoted(c)))


def _quoted(c: Column) -> Column:
    """A text without characters to escape (a number, a time) as a JSON string."""
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def _ticket(**members: Column) -> Column:
    """A JSON object of member texts; a NULL member is left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v.cast("string"))
                                                   for k, v in members.items()]), F.lit("}"))


def price_value(price: Column, duration: Column) -> Column:
    return (F.when(duration == 10, F.lit(None).cast("string"))
             .when(duration == 20, F.lit("null"))
             .when(duration == 30, F.lit('"abc"'))
             .when(duration == 40, _quoted(price))
             .when(duration == 100, F.lit("1e20"))
             .when(duration == 110, F.lit('"nan"'))
             .otherwise(price.cast("string")))


def transfers_value(transfers: Column, duration: Column) -> Column:
    return (F.when(duration == 50, _quoted(transfers))
             .when(duration == 70, F.lit(None).cast("string"))
             .when(duration == 90, F.lit('"x"'))
             .when(duration == 120, F.lit("1099511627776"))
             .otherwise(transfers.cast("string")))


def duration_value(duration: Column) -> Column:
    return (F.when(duration == 80, F.lit(None).cast("string"))
             .when(duration == 130, F.lit("99999999999"))
             .otherwise(duration.cast("string")))


def _opt(c: Column, duration: Column) -> Column:
    """airline / flight_number: missing for duration 60."""
    return F.when(duration != 60, c)


def _body(o: Column, d: Column, faults: dict[str, str]) -> Column:
    def answer(success: str) -> Column:
        return F.concat(F.lit(f'{{"success":{success},"currency":"rub","data":'), F.col("_data"), F.lit("}"))

    ok = answer("true")
    rule = {k: F.expr(v.replace("o", "_o").replace("d", "_d")) for k, v in faults.items()}
    return (F.when(rule["not_success"], F.concat(F.lit('{"success":false,"data":'), F.col("_data"), F.lit("}")))
             .when(rule["no_data"], F.lit('{"success":true,"currency":"rub"}'))
             .when(rule["data_not_object"],
                   F.concat(F.lit('{"success":true,"currency":"rub","data":['),
                            F.concat_ws(",", F.map_values("_m")), F.lit("]}")))
             .when(rule["empty_body"], F.lit(""))
             .when(rule["broken_json"], F.substring(ok, 1, 25))
             .when(o + d == 13, answer("1")).when(o + d == 15, answer('"yes"'))
             .otherwise(ok))


def _landing(tickets: DataFrame, by: list[str], faults: dict[str, str], month: Column) -> DataFrame:
    """One object per ``by`` and poll; ``_entry`` is (key of the entry, ticket text).
    The poll fixes the salt: grouping by it too keeps the rows where the polls were numbered."""
    g = tickets.groupBy(*by, "salt", "poll").agg(F.map_from_entries(F.collect_list("_entry")).alias("_m"))
    data = F.concat(F.lit("{"), F.concat_ws(",", F.transform(
        F.map_entries("_m"), lambda e: F.concat(_text(e["key"]), F.lit(":"), e["value"]))), F.lit("}"))
    _o, _d = F.col("o"), F.col("d") if "d" in by else F.lit(0)
    g = g.withColumn("_data", data).withColumns({"_o": _o, "_d": _d})
    body = _body(F.col("_o"), F.col("_d"), faults)
    cols = [F.col("origin"), F.col("destination") if "destination" in by
            else F.lit(None).cast("string").alias("destination"), month.alias("month"), F.col("poll")]
    return g.select(*cols, body.alias("body"))


def _monthly(fl: DataFrame, ticket: Column) -> DataFrame:
    t = _written(polls(fl, by=MONTHLY))
    t = t.withColumn("_entry", F.struct(F.date_format("day", "yyyy-MM-dd").alias("k"), ticket.alias("t")))
    return _landing(t, MONTHLY, OBJECT_FAULTS, F.date_format("month", "yyyy-MM"))


def grouped_prices_landing(fl: DataFrame) -> DataFrame:
    """Objects from all flights (``flights(lines)``)."""
    dur = F.col("duration")
    return _monthly(fl, _ticket(
        origin=_text(F.col("origin")), airline=_opt(_text(F.col("airline")), dur),
        flight_number=_opt(F.col("flight_number"), dur), departure_at=_quoted(F.col("departure_at")),
        origin_airport=_text(F.col("origin")), destination_airport=_text(F.col("destination")),
        link=_text(F.concat(F.lit("/search/"), "origin", "destination")),
        price=price_value(F.col("price"), dur), transfers=transfers_value(F.col("transfers"), dur),
        duration=duration_value(dur)))


def price_calendar_landing(fl: DataFrame) -> DataFrame:
    """Objects from all flights (``flights(lines)``)."""
    dur = F.col("duration")
    return _monthly(fl, _ticket(
        price=price_value(F.col("price"), dur), airline=_opt(_text(F.col("airline")), dur),
        flight_number=_opt(F.col("flight_number"), dur), departure_at=_quoted(F.col("departure_at")),
        return_at=_quoted(F.col("return_at")), transfers=transfers_value(F.col("transfers"), dur),
        expires_at=_quoted(F.col("expires_at"))))


def directions_landing(fl: DataFrame) -> DataFrame:
    """Objects from all flights (``flights(lines)``)."""
    dur = F.col("duration")
    ticket = _ticket(
        price=price_value(F.col("price"), dur), airline=_opt(_text(F.col("airline")), dur),
        flight_number=_opt(F.col("flight_number"), dur), departure_at=_quoted(F.col("departure_at")),
        return_at=_quoted(F.col("return_at")), expires_at=_quoted(F.col("expires_at")),
        transfers=transfers_value(F.col("transfers"), dur))
    t = _written(polls(fl, by=DAILY)).withColumn("_entry", F.struct(F.col("destination").alias("k"), ticket.alias("t")))
    return _landing(t, DAILY, DIRECTION_FAULTS, F.date_format("day", "yyyy-MM-dd"))


def write_landing(df: DataFrame, path: str) -> str:
    """Landing files: JSON lines {origin, destination, month, poll, body}, compressed
    (fast level): the texts repeat their member names in every entry.  A compressed
    file is read by one task, so files are kept small enough to share them out evenly."""
    with transient_shuffles(df.sparkSession):
        (df.write.mode("errorifexists").option("compression", "gzip").option("maxRecordsPerFile", "50000")
         .option("zlib.compress.level", "BEST_SPEED").json(path))
    return path


LANDING_SCHEMA = "origin string, destination string, month string, poll int, body string"


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING_SCHEMA).json(path)
