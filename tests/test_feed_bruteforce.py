"""Feed extraction on generated bodies: what each ticket must become is fixed
with the values it is made from."""

import json
import random

from skyfare.operators.keyed import plain_double
from skyfare.sources.landing import (extract_grouped_prices, normalize_tickets, parse_objects, quarantine, to_store,
                                     FIELDS)

DEST, ORIGIN = "LED", "A-B"
GONE = object()

#: (value in the JSON, price read, reason)
PRICES = [(GONE, 0.0, None), (None, None, "null_price"), (0, 0.0, None), (3, 3.0, None), (3.7, 3.7, None),
          (-2.5, -2.5, None), ("3", 3.0, None), (" 4 ", 4.0, None), ("12.25", 12.25, None), ("1e3", 1000.0, None),
          (True, 1.0, None), ("abc", None, "bad_price"), ("", None, "bad_price"), ([1], None, "bad_price"),
          ({"a": 1}, None, "bad_price"), ("nan", None, "bad_price"), ("inf", None, "bad_price"),
          (1e20, 1e20, "range_price")]
#: (value, whole number read, fault, is it the number zero)
WHOLES = [(GONE, 0, None, True), (None, None, "null", False), (0, 0, None, True), (0.0, 0, None, True),
          (3, 3, None, False), (3.7, 3, None, False), (-2.5, -2, None, False), ("0", 0, None, False),
          ("3", 3, None, False), (" 4 ", 4, None, False), ("3.5", None, "bad", False), ("abc", None, "bad", False),
          ("", None, "bad", False), (True, 1, None, False), (False, 0, None, True), ([1], None, "bad", False),
          (1 << 40, 1 << 40, "range", False)]
#: (value, as a part of the key)
CODES = [(GONE, ""), (None, "None"), ("SU", "SU"), (1448, "1448"), ("S7", "S7")]


def ticket(rnd, day):
    """(JSON object, expected row)."""
    t = {}

    def put(name, choices):
        pick = rnd.choice(choices)
        if pick[0] is not GONE:
            t[name] = pick[0]
        return pick

    _, price, price_fault = put("price", PRICES)
    _, stops, stops_fault, direct = put("transfers", WHOLES)
    _, minutes, minutes_fault, _ = put("duration", WHOLES)
    code, number = put("airline", CODES)[1], put("flight_number", CODES)[1]
    origin = rnd.choice([GONE, None, "SU", "LED"])
    if origin is not GONE:
        t["origin"] = origin
    faults = [price_fault, stops_fault and f"{stops_fault}_transfers", minutes_fault and f"{minutes_fault}_duration"]
    return t, (day, f"{code}_{number}_{DEST}", ORIGIN if origin is GONE else origin, direct, price, stops, minutes,
               next((f for f in faults if f), None))


def answer(rnd):
    """(body, expected rows, status of the request)."""
    made = [(f"2025-12-{k + 1:02d}", *ticket(rnd, f"2025-12-{k + 1:02d}")) for k in range(rnd.randint(0, 6))]
    data, rows = {day: t for day, t, _ in made}, [row for _, _, row in made]
    obj = {"success": True, "currency": "rub", "data": data}
    kind = rnd.randrange(20)
    if kind < 2:
        obj["success"] = rnd.choice([False, 0, "", None, [], 0.0])
        return json.dumps(obj), [], "not_success"
    if kind == 2:
        del obj["data"]
        return json.dumps(obj), [], "no_data"
    if kind == 3:
        obj["data"] = [t for _, t, _ in made]
        return json.dumps(obj), [], "data_not_object"
    if kind == 4:
        return json.dumps(obj)[:30], [], "broken_json"
    if kind == 5:
        return rnd.choice(["", "  "]), [], "empty_body"
    if kind == 6 and made:  # the entry after which nothing more is taken
        data["2025-12-20"] = rnd.choice([5, None, "x", [1]])
        data["2025-12-21"] = {"price": 1}
        return json.dumps(obj), rows, "bad_entry"
    if kind < 10:
        obj["success"] = rnd.choice([1, "yes", "false", "0", [0], 2.5])
    return json.dumps(obj), rows, "ok"


COLUMNS = ["departure_date", "ticket_id", "origin", "is_direct", "price", "transfers", "duration", "reject_reason"]


def landing(spark, bodies):
    return spark.createDataFrame([(ORIGIN, DEST, f"m{i}", b) for i, b in enumerate(bodies)],
                                 "origin string, destination string, month string, body string")


def test_extract(spark):
    rnd = random.Random(11)
    made = [answer(rnd) for _ in range(400)]
    land = landing(spark, [b for b, _, _ in made])
    got = {}
    for r in extract_grouped_prices(land, "2025-12-01 00:00:00").collect():
        got.setdefault(r["month"], []).append(tuple(r[c] for c in COLUMNS))
    bad = [(b, rows, got.get(f"m{i}")) for i, (b, rows, _) in enumerate(made)
           if sorted(rows, key=repr) != sorted(got.get(f"m{i}", []), key=repr)]
    assert not bad, bad[:3]
    status = {r["month"]: r["status"] for r in
              parse_objects(land, FIELDS["grouped_prices"]).select("month", "status").collect()}
    wrong = [(b, status[f"m{i}"], s) for i, (b, _, s) in enumerate(made) if status[f"m{i}"] != s]
    assert not wrong, wrong[:5]


def test_bad_numbers_do_not_stop_the_load(spark):
    """Values that no store column holds are set aside; the rows beside them load."""
    data = {"2025-12-01": {"price": 1e20}, "2025-12-02": {"transfers": 1 << 40, "price": 5},
            "2025-12-03": {"price": "nan"}, "2025-12-04": {"price": 7, "duration": -(1 << 31) - 1},
            "2025-12-05": {"price": 8, "transfers": 2}}
    land = landing(spark, [json.dumps({"success": 1, "data": data})])
    ext = extract_grouped_prices(land, "2025-12-01 00:00:00")
    assert [float(r["price"]) for r in to_store(normalize_tickets(ext, "2025-12-01 00:00:00")).collect()] == [8.0]
    aside = quarantine("grouped_prices", parse_objects(land, FIELDS["grouped_prices"]), ext, "departure_date")
    assert {(r["origin"], r["entry_key"][-2:], r["reason"]) for r in aside.collect()} == {
        (ORIGIN, "01", "range_price"), (ORIGIN, "02", "range_transfers"), (ORIGIN, "03", "bad_price"),
        (ORIGIN, "04", "range_duration")}


def test_double_text(spark):
    values = [0.0, 1.0, -2.5, 12.25, 1e7, 12345678.25, 1e15, 123456789012345.6, 1e16, 1.5e17, 1e-3, 1.25e-4, 1e-5, 2.5e-7]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r["t"] for r in df.select(plain_double(df["v"]).alias("t")).collect()] == [repr(v) for v in values]


def test_equal_stamps_leave_one_store(spark):
    """The store is the same however the writes are partitioned."""
    from pyspark.sql import functions as F

    from skyfare.operators import keyed
    rows = spark.createDataFrame([("k", f"v{i * 37 % 100:02d}", "2025") for i in range(500)], "id string, v string, at string")
    seen = set()
    for n in (1, 3, 7):
        batch = keyed.kv_encode(rows.repartition(n, "v"), "t:", ["id"])
        out = keyed.kv_upsert(None, batch, F.col("fields")["at"])
        seen |= {r["fields"]["v"] for r in out.collect()}
    assert seen == {"v99"}


def test_key_value_store_is_built_straight_from_the_landing(spark, tmp_path, monkeypatch):
    """One parse, which nothing is written of; the same store as from the parsed table."""
    from pyspark.sql import functions as F

    from skyfare.operators import keyed
    from skyfare.plans import registry
    from skyfare.plans.warehouse import Warehouse

    rnd = random.Random(5)
    raw = landing(spark, [answer(rnd)[0] for _ in range(60)]).withColumn("poll", F.lit(1))
    raw.write.json(f"{tmp_path}/in")

    def made():
        w = Warehouse(spark, str(tmp_path))
        w.paths["landing_grouped_prices"] = f"{tmp_path}/in"
        monkeypatch.setattr(registry, "wh", lambda *_: w)
        return w

    w = made()
    plan = w.accepted("grouped_prices")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(_txt") == 1
    counts = registry.q_kv_field_count(spark, str(tmp_path)).collect()
    assert "kv_tickets" in w.paths and "parsed_grouped_prices" not in w.paths
    store = sorted(registry._kv_store(spark, str(tmp_path)).collect(), key=repr)
    assert counts and sorted(counts) == [(r["key"], 14) for r in sorted(store)]

    w = made()
    n = normalize_tickets(w.extract("grouped_prices"), registry.DEFAULT.batch_ts)
    batch = (keyed.kv_encode(n, *keyed.TICKET_KEY).withColumn("_dep", F.col("fields")["departure_at"])
             .withColumn("_org", F.col("fields")["origin"]))
    upsert = keyed.kv_upsert(None, batch, F.col("fields")["extracted_at"], ["_dep", "_org"])
    assert sorted(upsert.collect(), key=repr) == store
    assert sorted(registry._kv_store(spark, str(tmp_path)).collect(), key=repr) == store


def test_numbers_and_texts_like_them(spark):
    """(value as written) -> (kind, whole number, is it the number zero)."""
    cases = {"0.4": ("number", 0, False), "-0.0": ("number", 0, True), "1e30": ("number", None, False),
             "9007199254740993": ("number", 9007199254740993, False), "false": ("number", 0, True),
             '"0"': ("text", 0, False), '"2"': ("text", 2, False), "null": ("null", None, False),
             '0,"x":{"transfers":"1"}': ("number", 0, True), '2,"transfers":3': ("missing", 0, True),
             '5,"link":"\\"transfers\\":\\""': ("number", 5, False)}
    blank = {f' : {v}' if i % 2 else f':{v}': e for i, (v, e) in enumerate(cases.items())}
    land = landing(spark, [f'{{"success":true,"data":{{"d":{{"transfers"{v}}}}}}}' for v in blank])
    got = {r["month"]: (r["transfers_kind"], r["transfers"], r["is_direct"])
           for r in extract_grouped_prices(land, "2025-12-01 00:00:00").collect()}
    assert got == {f"m{i}": e for i, e in enumerate(blank.values())}
