"""Hand-made cases for the semantic traps (date shapes, JSON defaults,
flight-type buckets, rounding, Oracle string rules)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from skyfare.functions.dates import calendar_columns, parse_ts
from skyfare.functions.scalar import flight_type_id, key_join, oracle_concat, round_avg


def _parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    return [r[0] for r in df.select(parse_ts(F.col("s"))).collect()]


def test_date_shapes(spark):
    got = _parse(spark, [
        "2025-12-01T10:00:00", "2025-12-01 10:00:00", "2025-12-01", "2025-1-5",
        "01.12.2025 10:00:00", "01.12.2025", "2025-12-01T10:00:00+03:00",
        "2025-12-01T10:00:00.123456", "x 2025-12-01 y", "2025-12-01  10:00:00",
        "2025-001-01", "2025-13-45", "2025-02-30", "abc", "", None])
    D = dt.datetime
    assert got == [D(2025, 12, 1, 10), D(2025, 12, 1, 10), D(2025, 12, 1), D(2025, 1, 5),
                   D(2025, 12, 1, 10), D(2025, 12, 1), D(2025, 12, 1), D(2025, 12, 1),
                   D(2025, 12, 1), D(2025, 12, 1, 10), None, None, None, None, None, None]


def test_calendar_monday_is_one(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    rows = df.select(*calendar_columns(F.col("d"))).collect()
    assert rows[0]["day_of_week"] == 1 and rows[0]["day_name"] == "Monday"
    assert rows[1]["day_of_week"] == 7 and rows[1]["is_weekend"] == 1
    assert rows[0]["date_id"] == 20240101 and rows[0]["month_name"] == "January"


def test_dim_date_range_rows(spark):
    from skyfare.operators.dims import dim_date
    assert dim_date(spark, dt.date(2020, 1, 1), dt.date(2025, 12, 31)).count() == 2192


def test_flight_type_bucket_null_is_multi(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (5,), (None,)], "t int")
    assert [r[0] for r in df.select(flight_type_id(F.col("t"))).collect()] == [1, 2, 3, 3, 3]


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([("a", "53677.01"), ("a", "53677.02")], "k string, p string")
    df = df.withColumn("p", F.col("p").cast("decimal(18,2)"))
    r = df.groupBy("k").agg(round_avg(F.sum("p"), F.count(F.lit(1))).alias("a")).first()
    assert r["a"] == 53677.02


def test_oracle_concat_treats_null_as_empty(spark):
    df = spark.createDataFrame([("A", None)], "a string, b string")
    r = df.select(oracle_concat(F.col("a"), F.lit(" -> "), F.col("b")).alias("x"),
                  key_join(F.col("a"), F.col("b")).alias("k")).first()
    assert r["x"] == "A -> " and r["k"] == "A_"


def _landing(spark, bodies):
    rows = [("MOW", "LED", "2025-12", b) for b in bodies]
    return spark.createDataFrame(rows, "origin string, destination string, month string, body string")


def test_json_missing_vs_null_vs_bad(spark):
    from skyfare.sources.landing import extract_grouped_prices, parse_objects
    t = lambda **kw: {"airline": "SU", "flight_number": 1448, "departure_at": "2025-12-01T10:00:00",
                      **kw}
    body = json.dumps({"success": True, "currency": "rub", "data": {
        "2025-12-01": t(price=5000, transfers=0, duration=90),
        "2025-12-02": t(transfers=1),                      # price missing -> 0
        "2025-12-03": t(price=None),                       # explicit null -> quarantine
        "2025-12-04": t(price="abc"),                      # bad cast -> quarantine
        "2025-12-05": t(price="12.5", transfers="0"),      # text '0' is not direct
        "2025-12-06": t(price=7000, transfers=3.7),        # int() truncates
        "2025-12-07": t(price=7000, transfers="3.5"),      # int('3.5') fails
    }})
    bad = ["", "{broken", json.dumps({"success": False}), json.dumps({"success": True}),
           json.dumps({"success": True, "data": [1, 2]})]
    land = _landing(spark, [body] + bad)
    from skyfare.sources.landing import FIELDS
    st = sorted(r[0] for r in parse_objects(land, FIELDS["grouped_prices"]).select("status").collect())
    assert st == sorted(["ok", "empty_body", "broken_json", "not_success", "no_data",
                         "data_not_object"])
    ex = {r["departure_date"]: r for r in extract_grouped_prices(land, "2025-12-01 00:00:00").collect()}
    assert ex["2025-12-01"]["reject_reason"] is None and ex["2025-12-01"]["is_direct"]
    assert ex["2025-12-02"]["price"] == 0.0 and ex["2025-12-02"]["price_kind"] == "missing"
    assert ex["2025-12-03"]["reject_reason"] == "null_price"
    assert ex["2025-12-04"]["reject_reason"] == "bad_price"
    assert ex["2025-12-05"]["price"] == 12.5 and ex["2025-12-05"]["is_direct"] is False
    assert ex["2025-12-05"]["transfers"] == 0
    assert ex["2025-12-06"]["transfers"] == 3 and ex["2025-12-06"]["reject_reason"] is None
    assert ex["2025-12-07"]["reject_reason"] == "bad_transfers"
    assert ex["2025-12-01"]["ticket_id"] == "SU_1448_LED"
    assert ex["2025-12-01"]["origin"] == "MOW"   # missing origin -> request origin


def test_store_edge_empty_is_null(spark):
    from skyfare.sources.landing import to_store
    df = spark.createDataFrame([("", True, 1.005)], "airline string, is_direct boolean, price double")
    r = to_store(df).first()
    assert r["airline"] is None and r["is_direct"] == 1


def test_bad_entry_fails_object_and_null_text_renders_none(spark):
    from skyfare.sources.landing import FIELDS, extract_grouped_prices, parse_objects
    good = json.dumps({"success": True, "data": {"2025-12-01": {"airline": None, "flight_number": 7,
                                                                  "price": 100}}})
    bad = json.dumps({"success": True, "data": {"2025-12-03": {"price": 1}, "2025-12-04": 5,
                                                "2025-12-05": {"price": 2}}})
    land = _landing(spark, [good, bad])
    st = sorted(r[0] for r in parse_objects(land, FIELDS["grouped_prices"]).select("status").collect())
    assert st == ["bad_entry", "ok"]
    r = {x["departure_date"]: x for x in extract_grouped_prices(land, "2025-12-01 00:00:00").collect()}
    # entries before the first non-object entry are kept, the rest is lost
    assert sorted(r) == ["2025-12-01", "2025-12-03"]
    assert r["2025-12-01"]["ticket_id"] == "None_7_LED" and r["2025-12-01"]["airline"] is None
