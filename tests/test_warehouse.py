"""SCD2 invariants over several batches, fact row conservation, rejects
and the fixed-value dimensions."""

import datetime as dt

from pyspark.sql import functions as F

from skyfare.operators import fact, scd2
from skyfare.plans.warehouse import warehouse
from tests.conftest import SF_SMALL

T0, T1, T2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00", "2025-03-01 00:00:00"


def _src(spark, rows):
    return spark.createDataFrame(rows, "airline_bk string, airline_name string, country string")


def test_scd2_batches(spark):
    dim0 = scd2.empty_dim(spark)
    v1 = scd2.scd2_initial(dim0, _src(spark, [("SU", "Aeroflot", "Russia"),
                                              ("S7", "S7 Airlines", "Russia")]), T0, 0)
    assert v1.count() == 2
    # second initial load is skipped when the dimension has rows
    assert scd2.scd2_initial(v1, _src(spark, [("XX", "x", "y")]), T0, 2).count() == 2
    src2 = _src(spark, [("SU", "Aeroflot", "RU"), ("TK", "Turkish Airlines", "Turkey")])
    v2 = scd2.scd2_merge(v1, src2, T1).cache()
    rows = {(r.airline_bk, r.is_current): r for r in v2.collect()}
    assert len(rows) == 4                                    # S7 absent, kept current
    assert rows[("SU", 0)].valid_to == dt.datetime(2025, 2, 1)
    assert rows[("SU", 1)].valid_from == rows[("SU", 0)].valid_to  # intervals touch
    assert rows[("SU", 1)].airline_sk == 3 and rows[("TK", 1)].airline_sk == 4
    assert rows[("S7", 1)].valid_to is None
    assert scd2.scd2_multiple_current(v2).count() == 0
    assert scd2.scd2_no_current(v2).count() == 0
    # an identical rerun adds nothing
    v3 = scd2.scd2_merge(v2, src2, T2)
    assert v3.count() == 4
    counts = {r.status: r.n for r in scd2.scd2_change_counts(v2, src2).collect()}
    assert counts == {"unchanged": 2}


def test_scd2_null_safe_change(spark):
    v1 = scd2.scd2_initial(scd2.empty_dim(spark), _src(spark, [("AA", None, "X")]), T0, 0)
    same = scd2.scd2_merge(v1, _src(spark, [("AA", None, "X")]), T1)
    assert same.count() == 1
    changed = scd2.scd2_merge(v1, _src(spark, [("AA", "Name", "X")]), T1)
    assert changed.count() == 2


def test_lookup_default(spark):
    from skyfare.functions.lookup import airline_lookup_table, with_airline_info
    codes = spark.createDataFrame([("SU",), ("ZZ",)], "airline_bk string")
    got = {r.airline_bk: (r.airline_name, r.country)
           for r in with_airline_info(codes, airline_lookup_table(spark)).collect()}
    assert got == {"SU": ("Aeroflot", "Russia"), "ZZ": ("ZZ", "Unknown")}


def test_fact_conservation_and_rejects(spark):
    w = warehouse(spark, SF_SMALL)
    out = w.read("fact_outcomes")
    stats = fact.load_stats(out).first()
    ods = w.read("ods_cheap_tickets")
    assert stats.complete_rows == fact.complete_rows(ods).count()
    n_rejected = fact.rejects_from_outcomes(out).agg(F.sum("n_rows")).first()[0]
    assert stats.inserted + n_rejected == stats.complete_rows
    assert stats.inserted == w.read("fact_flights").count()
    assert stats.bad_departure_date > 0 and stats.unknown_route > 0
    assert stats.date_outside_calendar > 0 and stats.duplicate_key > 0
    f = w.read("fact_flights")
    assert f.groupBy("flight_id").count().where("count > 1").count() == 0


def test_unknown_airline_and_null_duration_rejects(spark):
    ods = spark.createDataFrame(
        [("t1", "A", "B", "2025-12-01", 100.0, "SU", 0, 60, "2025-11-01T00:00:00"),
         ("t2", "A", "B", "2025-12-01", 100.0, "ZZ", 0, 60, "2025-11-01T00:00:00"),
         ("t3", "A", "B", "2025-12-01", 100.0, "SU", 0, None, "2025-11-01T00:00:00"),
         ("t4", "A", "C", "2025-12-01", 100.0, "SU", 0, 60, "2025-11-01T00:00:00"),
         ("t5", "A", "B", "2031-12-01", 100.0, "SU", 0, 60, "2025-11-01T00:00:00"),
         ("t1", "A", "B", "2025-12-02", 90.0, "SU", 1, 60, "2025-11-02T00:00:00"),
         ("t6", None, "B", "2025-12-01", 100.0, "SU", 0, 60, "2025-11-01T00:00:00")],
        "ticket_id string, origin string, destination string, departure_at string, price double, "
        "airline string, transfers int, duration int, extracted_at string")
    routes = spark.createDataFrame([("A", "B", 1)], "origin string, destination string, route_id int")
    air = spark.createDataFrame([("SU", 7)], "airline_bk string, airline_sk bigint")
    from skyfare.operators.dims import dim_date
    cal = dim_date(spark, dt.date(2025, 1, 1), dt.date(2025, 12, 31))
    out = fact.outcomes(fact.stage(ods, routes, air, cal, T0))
    rej = {(r.flight_id, r.reject_reason): r.n_rows
           for r in fact.rejects_from_outcomes(out).collect()}
    assert rej == {("t2", "unknown_airline"): 1, ("t3", "null_duration"): 1,
                   ("t4", "unknown_route"): 1, ("t5", "date_outside_calendar"): 1,
                   ("t1", "duplicate_key"): 1}
    f = fact.fact_from_outcomes(out).collect()
    assert len(f) == 1 and f[0].flight_id == "t1" and float(f[0].price) == 100.0  # oldest wins


def test_price_summary_empty_month_is_one_row(spark):
    from skyfare.operators.marts import price_summary
    w = warehouse(spark, SF_SMALL)
    r = price_summary(w.read("fact_cube"), w.read("dim_date"), dt.date(1890, 1, 1)).collect()
    assert len(r) == 1 and r[0].total_flights == 0 and r[0].avg_price is None


def test_marts_validate_raises_on_empty(spark):
    import pytest
    from skyfare.operators.quality import assert_marts_nonempty
    w = warehouse(spark, SF_SMALL)
    assert_marts_nonempty({"mart_route_analysis": w.read("mart_route_analysis")})
    with pytest.raises(ValueError):
        assert_marts_nonempty({"empty": w.read("mart_route_analysis").limit(0)})


def test_fixed_dimensions(spark):
    from skyfare.operators.dims import (dim_airline_snapshot_fixed, dim_airport_fixed,
                                        dim_flight_type)
    assert dim_airport_fixed(spark).count() == 11
    assert dim_airport_fixed(spark).where("city = 'Moscow'").count() == 3
    assert dim_flight_type(spark).count() == 3
    assert dim_airline_snapshot_fixed(spark).count() == 10


def test_route_extension_keeps_ids(spark):
    from skyfare.operators.dims import dim_route
    ap = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "airport_id int, airport_code string")
    ods1 = spark.createDataFrame([("B", "C"), ("A", "B")], "origin string, destination string")
    r1 = dim_route(ods1, ap)
    ods2 = spark.createDataFrame([("A", "C"), ("A", "B"), ("X", "A")], "origin string, destination string")
    r2 = {(r.origin_airport_id, r.destination_airport_id): r.route_id
          for r in dim_route(ods2, ap, existing=r1).collect()}
    assert r2 == {(1, 2): 1, (2, 3): 2, (1, 3): 3}


def test_stream_equals_batch(spark):
    w = warehouse(spark, SF_SMALL)
    from skyfare.plans.registry import QUERIES
    a = QUERIES["ods_incremental"](spark, SF_SMALL)
    b = QUERIES["ingest_to_ods"](spark, SF_SMALL)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    del w


def test_bench_generator_price_filter(spark):
    from skyfare.sources.generator import generate_tickets
    df = generate_tickets(spark, 500, "2025-10-15 00:00:00")
    assert df.count() == 500 and df.where("price < 8000").count() == 150


def test_cube_marts_equal_fact_marts(spark):
    """Marts from the cube equal the same aggregates straight off the fact."""
    from pyspark.sql import functions as F
    from skyfare.functions.scalar import round_avg
    w = warehouse(spark, SF_SMALL)
    f = w.read("fact_flights")
    direct = (f.groupBy("route_id").agg(F.count(F.lit(1)).alias("total_flights"),
                                        round_avg(F.sum("price"), F.count(F.lit(1))).alias("avg_price"),
                                        F.min("price").alias("min_price"),
                                        F.round(F.avg("duration"), 0).cast("bigint").alias("avg_duration_min")))
    mart = w.read("mart_route_analysis").select("route_id", "total_flights", "avg_price",
                                                "min_price", "avg_duration_min")
    assert direct.exceptAll(mart).count() == 0 and mart.exceptAll(direct).count() == 0


def test_sql_over_registered_views(spark):
    """The report SQL of the source system runs unchanged on the views."""
    w = warehouse(spark, SF_SMALL)
    w.register_views()
    rows = spark.sql("""
        SELECT ft.type_category, COUNT(*) AS flights, ROUND(AVG(f.price), 2) AS avg_price
        FROM fact_flights f JOIN dim_flight_type ft ON f.flight_type_id = ft.flight_type_id
        GROUP BY ft.type_category, ft.flight_type_id ORDER BY ft.flight_type_id""").collect()
    from skyfare.plans.registry import QUERIES
    ref = {r.type_category: (r.flights, r.avg_price)
           for r in QUERIES["flights_by_type"](spark, SF_SMALL).collect()}
    assert {r.type_category: (r.flights, float(r.avg_price)) for r in rows} == ref


def test_frozen_routes(spark):
    from skyfare.operators.dims import dim_route
    ap = spark.createDataFrame([(1, "A"), (2, "B")], "airport_id int, airport_code string")
    r1 = dim_route(spark.createDataFrame([("A", "B")], "origin string, destination string"), ap)
    ods2 = spark.createDataFrame([("B", "A")], "origin string, destination string")
    assert dim_route(ods2, ap, existing=r1, frozen=True).count() == 1
    assert dim_route(ods2, ap, existing=r1).count() == 2


def test_stream_second_run_appends_only_new_files(spark):
    """Two scheduled runs: the second picks up only the files that arrived
    since the first (the checkpoint remembers consumed files)."""
    from skyfare.session import new_run_dir
    from skyfare.sources.feeds import read_landing
    from skyfare.streaming.incremental import read_ods, read_quarantine, run_available_now
    w = warehouse(spark, SF_SMALL)
    land = read_landing(spark, w.landing_path("grouped_prices"))
    run = new_run_dir(spark, "stream-test")
    first = land.where("origin < 'NATION_5'")
    second = land.where("origin >= 'NATION_5'")
    first.write.json(f"{run}/landing")
    from skyfare.config import DEFAULT
    run_available_now(spark, f"{run}/landing", f"{run}/out", f"{run}/ckpt", DEFAULT.batch_ts)
    n1 = read_ods(spark, f"{run}/out").count()
    second.write.mode("append").json(f"{run}/landing")
    run_available_now(spark, f"{run}/landing", f"{run}/out", f"{run}/ckpt", DEFAULT.batch_ts)
    out = read_ods(spark, f"{run}/out")
    assert read_quarantine(spark, f"{run}/out").count() > 0
    from skyfare.plans.registry import QUERIES
    batch = QUERIES["ingest_to_ods"](spark, SF_SMALL)
    assert 0 < n1 < out.count() == batch.count()
    assert out.exceptAll(batch).count() == 0


def test_fact_load_with_a_hot_key(spark):
    """A third of all rows share one flight id: one winner, the rest are
    duplicate rejects; the aggregate collapses them map-side."""
    from skyfare.operators.dims import dim_date
    rows = [(f"t{i}", "A", "B", "2025-12-01", 100.0 + i, "SU", 0, 60,
             f"2025-11-01T00:00:{i % 60:02d}") for i in range(200)]
    rows += [("hot", "A", "B", "2025-12-02", 50.0 + i, "SU", 1, 60, "2025-11-02T00:00:00")
             for i in range(100)]
    ods = spark.createDataFrame(rows, "ticket_id string, origin string, destination string, "
                                "departure_at string, price double, airline string, "
                                "transfers int, duration int, extracted_at string").repartition(8)
    routes = spark.createDataFrame([("A", "B", 1)], "origin string, destination string, route_id int")
    air = spark.createDataFrame([("SU", 7)], "airline_bk string, airline_sk bigint")
    cal = dim_date(spark, dt.date(2025, 1, 1), dt.date(2025, 12, 31))
    out = fact.outcomes(fact.stage(ods, routes, air, cal, T0)).cache()
    f = {r.flight_id: r for r in fact.fact_from_outcomes(out).collect()}
    assert len(f) == 201 and float(f["hot"].price) == 50.0
    rej = fact.rejects_from_outcomes(out).collect()
    assert [(r.flight_id, r.reject_reason, r.n_rows) for r in rej] == [("hot", "duplicate_key", 99)]


def test_warehouse_from_landing_files(spark):
    """The warehouse built from fare-feed JSON with the fixed airports and
    airline lookup, as a user of the source system would run it."""
    import json

    from skyfare.config import RunConfig
    from skyfare.plans.warehouse import Warehouse
    from skyfare.session import new_run_dir

    def t(airline, fn, dep, price, transfers, duration):
        return {"origin": "MOW", "airline": airline, "flight_number": fn, "departure_at": dep,
                "price": price, "transfers": transfers, "duration": duration}
    objs = [
        ("MOW", "LED", {"2025-12-01": t("SU", 1448, "2025-12-01T10:00:00", 5000, 0, 90),
                        "2025-12-02": t("SU", 1448, "2025-12-02T10:00:00", 5500, 0, 90),
                        "2025-12-03": t("DP", 6001, "2025-12-03T07:00:00", 3900, 1, 150)}),
        ("MOW", "AER", {"2025-12-05": t("XX", 7, "2025-12-05T12:00:00", 12000, 2, 400)}),
        ("MOW", "IST", {"2025-12-06": t("TK", 414, "2025-12-06 09:15:00", 23000, 0, 240)}),
    ]
    run = new_run_dir(spark, "landing-test")
    rows = [(o, d, "2025-12", json.dumps({"success": True, "currency": "rub", "data": data}))
            for o, d, data in objs]
    spark.createDataFrame(rows, "origin string, destination string, month string, body string") \
         .write.json(f"{run}/landing")
    cfg = RunConfig(calendar_start=dt.date(2020, 1, 1), calendar_end=dt.date(2025, 12, 31),
                    as_of=dt.date(2025, 12, 15))
    w = Warehouse.from_landing(spark, f"{run}/landing", cfg).build_all()
    fact_rows = {r.flight_id: r for r in w.read("fact_flights").collect()}
    assert sorted(fact_rows) == ["DP_6001_LED", "SU_1448_LED", "TK_414_IST", "XX_7_AER"]
    assert float(fact_rows["SU_1448_LED"].price) == 5000.0          # first departure wins
    assert w.read("dim_date").count() == 2192
    routes = {(r.origin_city, r.dest_city): r.total_flights
              for r in w.read("mart_route_analysis").collect()}
    assert routes == {("Moscow", "Saint Petersburg"): 2, ("Moscow", "Sochi"): 1,
                      ("Moscow", "Istanbul"): 1}
    airlines = {r.airline_code: (r.airline_name, r.country)
                for r in w.read("mart_airline_performance").collect()}
    assert airlines == {"SU": ("Aeroflot", "Russia"), "DP": ("Pobeda", "Russia"),
                        "TK": ("Turkish Airlines", "Turkey"), "XX": ("XX", "Unknown")}
    summary = w.read("mart_price_summary").first()
    assert summary.total_flights == 4


def test_publish_creates_then_switches_tables(spark):
    """Catalog tables: created when absent, switched to a new version."""
    from skyfare.operators import scd2 as s2
    w = warehouse(spark, SF_SMALL)
    db = "skyfare_pub_test"
    w.publish(db, ["dim_airline", "fact_flights"])
    n_before = spark.sql(f"SELECT COUNT(*) FROM {db}.dim_airline").first()[0]
    assert spark.sql(f"SELECT COUNT(*) FROM {db}.fact_flights").first()[0] == \
        w.read("fact_flights").count()
    # a new SCD2 version (one changed airline) is written next to the old one
    saved = (w.paths["dim_airline"], w.rows["dim_airline"])
    try:
        src = w.read("scd2_source").orderBy("airline_bk").limit(1) \
               .withColumn("country", F.lit("Elsewhere"))
        w.write("dim_airline", s2.scd2_merge(w.read("dim_airline"), src, T2), count=True)
        w.publish(db, ["dim_airline"])
        assert spark.sql(f"SELECT COUNT(*) FROM {db}.dim_airline").first()[0] == n_before + 1
    finally:   # versions are immutable: switching back restores the old state
        w.paths["dim_airline"], w.rows["dim_airline"] = saved
    w.unpublish(db)
    assert not spark.catalog.tableExists(f"{db}.fact_flights")
    assert w.read("fact_flights").count() > 0          # files are kept
