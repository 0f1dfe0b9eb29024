"""What the layers write and move: the work of a query, not that of its neighbours."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from skyfare.operators import keyed
from skyfare.plans import registry
from skyfare.plans.warehouse import Warehouse
from skyfare.sources import feeds, fixture, landing

SF_SMALL = "/root/testdata/sf0.001"


def _exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return sum("Exchange hashpartitioning" in line for line in plan.split("\n"))


def test_feed_objects_take_one_shuffle(spark):
    """Numbering the polls and grouping them into objects share a shuffle."""
    w = Warehouse(spark, SF_SMALL)
    fl = feeds.flights(w.read("fixture_lines"))
    for make in (feeds.grouped_prices_landing, feeds.price_calendar_landing, feeds.directions_landing):
        assert _exchanges(make(fl)) == 1
    w.landing_path("directions")
    assert "landing_polls" not in w.paths
    assert glob.glob(f"{w.paths['landing_directions']}/*.json.gz")


def test_names_escaped_in_feeds(spark):
    """Texts with quotes, backslashes and control characters come back from a feed as they were."""
    lines = spark.sql("""SELECT 1 o, 3 d, 'A"b\\\\\\\\c' origin, 'x\\ty' destination, timestamp'1995-01-02' l_shipdate, 12.5D l_extendedprice,
        'é/"' p_brand, 2.0D l_quantity, 5L l_partkey, 7L l_orderkey, 1 l_linenumber, 9L l_suppkey, timestamp'1995-01-01' o_orderdate""")
    row = lines.first()
    for make, extract in ((feeds.grouped_prices_landing, landing.extract_grouped_prices),
                          (feeds.directions_landing, landing.extract_directions)):
        got = extract(make(feeds.flights(lines)), "2025-12-01 00:00:00").first()
        assert (got["origin"], got["destination"], got["airline"]) == (row["origin"], row["destination"], row["p_brand"])


def test_hashes_of_one_feed_build_that_feed(spark, monkeypatch):
    w = Warehouse(spark, SF_SMALL)
    monkeypatch.setattr(registry, "wh", lambda spark, d: w)
    registry.q_kv_upsert_trends(spark, SF_SMALL)
    assert "landing_calendar" in w.paths and "landing_grouped_prices" not in w.paths


def test_quarantine_reads_one_parse(spark, monkeypatch):
    w = Warehouse(spark, SF_SMALL)
    monkeypatch.setattr(registry, "wh", lambda spark, d: w)
    q = registry.q_ingest_quarantine(spark, SF_SMALL)
    assert "from_json" not in q._jdf.queryExecution().optimizedPlan().toString()


def test_quarantine_parses_no_whole_tickets(spark, monkeypatch):
    """Without a parsed table none is made: only the members that can be at fault are read."""
    w = Warehouse(spark, SF_SMALL)
    monkeypatch.setattr(registry, "wh", lambda spark, d: w)
    straight = sorted(map(tuple, registry.q_ingest_quarantine(spark, SF_SMALL).collect()), key=repr)
    assert not [name for name in w.paths if name.startswith("parsed_")]
    parsed = Warehouse(spark, SF_SMALL)
    monkeypatch.setattr(registry, "wh", lambda spark, d: parsed)
    for feed in Warehouse.FEEDS:
        parsed.parsed(feed)
    assert straight == sorted(map(tuple, registry.q_ingest_quarantine(spark, SF_SMALL).collect()), key=repr)


def test_quarantine_straight_from_landing_is_that_of_the_parsed_rows(spark):
    def answer(data):
        return f'{{"success":true,"currency":"rub","data":{data}}}'

    bodies = [answer('{"d1":{"price":1.5,"transfers":0,"airline":"A"},"d2":{"price":null,"transfers":1},"d3":{"transfers":"x"}}'),
              answer('{"d4":{"price":1e20,"transfers":1},"d5":{"price":"nan"},"d6":7,"d7":{"price":"abc"}}'),
              answer('[1]'), answer('{}'), '{"success":true}', '{"success":false,"data":{"d8":{"price":1}}}', "", None, '{"succ',
              answer('{"d9":{"price":2,"price":3,"transfers":1099511627776}}'), answer('{"d10":{"price":3,"transfers":1099511627776}}')]
    raw = spark.createDataFrame([("O", "D", str(i), i, b) for i, b in enumerate(bodies)], feeds.LANDING_SCHEMA)
    ext = landing.extract_calendar(raw, "2025-12-01 00:00:00", skips=True)
    straight = landing.quarantine_of("calendar", ext, "date", stored=False)
    plan = straight._jdf.queryExecution().optimizedPlan().toString()
    assert "price" in plan and "airline" not in plan
    got = [(r["poll"], r["entry_key"], r["reason"]) for r in straight.collect()]
    assert sorted(got, key=repr) == sorted(
        [(0, "d2", "null_price"), (0, "d3", "bad_transfers"), (1, "d4", "range_price"), (1, "d5", "bad_price"), (1, None, "bad_entry"),
         (2, None, "data_not_object"), (4, None, "no_data"), (5, None, "not_success"), (6, None, "empty_body"),
         (7, None, "empty_body"), (8, None, "broken_json"), (10, "d10", "range_transfers")], key=repr)
    kept = landing.quarantine_of("calendar", ext, "date")
    assert sorted(map(tuple, straight.collect()), key=repr) == sorted(map(tuple, kept.collect()), key=repr)


def test_names_not_carried_through_merges(spark):
    """Writes whose fields are the same are merged without their names, to the same hashes."""
    df = spark.createDataFrame([("k", "1"), ("k", "3"), ("k", "2")], "id string, v string")
    batch = keyed.kv_encode(df, "", ["id"])
    with_names, without = (keyed.kv_writes(batch, F.lit("s"), [], n) for n in (None, df.columns))
    assert with_names.collect() == without.collect()
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (with_names, without)]
    assert "map_keys" in plans[0] and "map_keys" not in plans[1]


def test_names_of_nations_joined_last(spark):
    plan = fixture.joined_lines(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = {k: min(len(x) - len(x.lstrip(" :+-")) for x in plan if k in x and "Relation" in x) for k in ("n_name", "p_brand")}
    assert depth["n_name"] < depth["p_brand"]
