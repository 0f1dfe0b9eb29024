import glob
import random
import time

import pytest
from pyspark.sql import functions as F

from skyfare.config import RunConfig
from skyfare.operators import fact, keyed, scd2
from skyfare.operators.numbering import dense_number
from skyfare.plans.store import Conflict, SchemaChanged, Store
from skyfare.plans.stored import OUTCOMES, StoredWarehouse
from skyfare.session import CLEANUP, new_run_dir
from skyfare.sources import landing
from skyfare.streaming import incremental

ODS = ("ticket_id string, origin string, destination string, departure_at string, price decimal(18,2), airline string, "
       "flight_number string, transfers int, duration int, is_direct int, price_category string, extracted_at string, "
       "processed_at string, route string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def root(spark):
    return new_run_dir(spark, "test-store")


# ---- store -----------------------------------------------------------------


def test_a_run_is_visible_only_after_its_commit(spark, root):
    store = Store(spark, root, buckets=4)
    assert store.version() == 0 and not store.has("t")
    run = store.begin("one")
    run.append("t", spark.range(10))
    run.append("k", spark.range(10).selectExpr("id", "cast(id as string) as v"), key="id")
    assert store.version() == 0 and run.read("t").count() == 10
    assert run.commit() == 1 and store.batches() == {"one"} and store.rows("t") == 10
    killed = store.begin("two")
    killed.append("t", spark.range(10, 20))
    killed.append("k", spark.range(10, 20).selectExpr("id", "cast(id as string) as v"))
    for s in (store, Store(spark, root, buckets=4)):    # the run never ends: its parts are not read
        assert s.version() == 1 and s.read("t").count() == 10 and s.read("k").count() == 10
    again = store.begin("two")
    again.append("t", spark.range(10, 15))
    again.replace("k", again.read("k").where("id > 4"))
    assert again.commit() == 2
    assert (store.read("t").count(), store.read("k").count(), store.batches()) == (15, 5, {"one", "two"})
    assert store.read("t", 1).count() == 10 and store.read("k", 1).count() == 10    # the old version stays readable


def test_commits_of_others(spark, root):
    store = Store(spark, root)
    a, b = store.begin("a"), store.begin("b")
    a.append("t", spark.range(1))
    b.append("t", spark.range(2))
    assert a.commit() == 1
    with pytest.raises(Conflict):
        b.commit()
    assert store.rows("t") == 1
    # a commit folder that was begun and holds no rows is passed over
    import pathlib
    pathlib.Path(f"{root.removeprefix('file:')}/commits/v=2/_temporary/0").mkdir(parents=True)
    c = store.begin("c")
    c.append("t", spark.range(5))
    assert c.commit() == 3 and store.version() == 3 and store.rows("t") == 6


def test_other_columns_are_refused(spark, root):
    store = Store(spark, root)
    run = store.begin("a")
    run.append("t", spark.range(3))
    run.commit()
    run = store.begin("b")
    for other in (spark.range(3).selectExpr("cast(id as int) as id"), spark.range(3).selectExpr("id", "1 as x")):
        with pytest.raises(SchemaChanged):
            run.append("t", other)
    run.replace("t", spark.range(4).selectExpr("id", "1 as x"))
    run.commit()
    assert store.read("t").columns == ["id", "x"] and store.read("t", 1).columns == ["id"]


# ---- warehouse in loads -------------------------------------------------------


def tickets(rng, n):
    out = []
    for i in range(n):
        dep = rng.choice(["2025-12-0%d" % rng.randrange(1, 9), "2025-12-0%dT10:00:00" % rng.randrange(1, 9), "soon", "2031-01-01"])
        out.append((f"t{rng.randrange(n // 2)}" if i % 50 else None, rng.choice(["A", "B", "C", "?"]), rng.choice(["A", "B", "C"]), dep,
                    None if i % 41 == 0 else rng.randrange(100, 104), rng.choice(["x", "y", "z", "w"]), "1", rng.randrange(3),
                    None if i % 37 == 0 else 60, 1, "cheap", rng.choice(["2025-11-01T00:00:00", "2025-12-02T00:00:00", None]), "p", "r"))
    return out


def loaded(spark, root, batches, cfg, airports):
    w = StoredWarehouse(spark, root, cfg, buckets=4)
    for i, (rows, lookup) in enumerate(batches):
        ods = spark.createDataFrame(rows, ODS.replace("decimal(18,2)", "int")).withColumn("price", F.col("price").cast("decimal(18,2)"))
        table = spark.createDataFrame(lookup, "code string, name string, country string")
        assert w.load(f"b{i}", ods.select(*[c.split(" ")[0] for c in ODS.replace("decimal(18,2)", "int").split(", ")]), airports,
                      table, cfg.batch_ts) is not None
    return w


def rows(df, *without):
    return sorted([tuple(v for k, v in r.asDict().items() if k not in without) for r in df.collect()], key=repr)


def test_loads_one_by_one_equal_one_load(spark, root):
    import datetime as dt
    cfg = RunConfig(batch_ts="2025-12-05 00:00:00", calendar_start=dt.date(2025, 12, 1), calendar_end=dt.date(2025, 12, 31))
    airports = spark.createDataFrame([(1, "A", "a", "q"), (2, "B", "b", "q"), (3, "C", "c", "q")],
                                     "airport_id int, airport_code string, city string, country string")
    lookup = [("x", "X", "1"), ("y", "Y", "2")]
    rng = random.Random(3)
    all_rows = tickets(rng, 300)
    parts = [all_rows[:120], all_rows[120:130], all_rows[130:]]
    w = loaded(spark, root, [(p, lookup) for p in parts], cfg, airports)
    one = loaded(spark, root + "-one", [(all_rows, lookup)], cfg, airports)
    assert rows(w.read("ods_cheap_tickets")) == rows(one.read("ods_cheap_tickets"))
    assert rows(w.rejects()) == rows(one.rejects()) and w.rejects().count() > 0
    names = {r["airline_sk"]: r["airline_bk"] for r in w.read("dim_airline").collect()}
    names_one = {r["airline_sk"]: r["airline_bk"] for r in one.read("dim_airline").collect()}

    def by_names(x, airline):
        codes = fact.route_codes(x.read("dim_route"), x.read("dim_airport"))
        f = x.facts().join(codes, "route_id").drop("route_id").collect()
        return sorted([tuple(airline[v] if k == "airline_sk" else v for k, v in r.asDict().items()) for r in f], key=repr)
    assert by_names(w, names) == by_names(one, names_one) and len(by_names(w, names)) > 50
    ids = sorted(r["route_id"] for r in w.read("dim_route").collect())
    assert ids == list(range(1, len(ids) + 1))
    # a batch that was loaded is not loaded again
    before = w.store.version()
    assert w.load("b1", w.read("ods_cheap_tickets"), airports, spark.createDataFrame(lookup, "code string, name string, country string"),
                  cfg.batch_ts) is None and w.store.version() == before
    # the stored side is aggregated where it lies
    assert "hashpartitioning(flight_id" not in plan_of(w.outcomes()) and "Bucketed: true" in plan_of(w.outcomes())
    had = rows(w.facts())
    w.compact(OUTCOMES)
    assert rows(w.facts()) == had and w.store.rows(OUTCOMES) == w.outcomes().count()
    assert w.facts(before).count() == len(had)


def test_a_changed_lookup_closes_versions_and_moves_facts(spark, root):
    import datetime as dt
    cfg = RunConfig(batch_ts="2025-12-05 00:00:00", calendar_start=dt.date(2025, 12, 1), calendar_end=dt.date(2025, 12, 31))
    airports = spark.createDataFrame([(1, "A", "a", "q"), (2, "B", "b", "q")], "airport_id int, airport_code string, city string, country string")
    row = ("t1", "A", "B", "2025-12-03", 100, "x", "1", 0, 60, 1, "cheap", "2025-12-01T00:00:00", "p", "r")
    late = ("t2", "A", "B", "2025-12-03", 100, "x", "1", 0, 60, 1, "cheap", "2025-12-20T00:00:00", "p", "r")
    w = loaded(spark, root, [([row], [("x", "Old", "1")])], cfg, airports)
    again = RunConfig(batch_ts="2025-12-10 00:00:00", calendar_start=cfg.calendar_start, calendar_end=cfg.calendar_end)
    table = spark.createDataFrame([("x", "New", "1")], "code string, name string, country string")
    ods = spark.createDataFrame([late], ODS.replace("decimal(18,2)", "int")).withColumn("price", F.col("price").cast("decimal(18,2)"))
    w.load("later", ods, airports, table, again.batch_ts)
    assert {r["flight_id"]: r["airline_sk"] for r in w.facts().collect()} == {"t1": 2, "t2": 2}
    assert {r["flight_id"]: r["airline_sk"] for r in w.facts_as_of().collect()} == {"t1": 1, "t2": 2}
    # only the fact on the current version counts
    assert [(r["airline_name"], r["flights_operated"]) for r in w.airline_mart(w.facts_as_of()).collect()] == [("New", 1)]


def test_hashes_keep_the_latest_write_and_open_few_buckets(spark, root):
    w = StoredWarehouse(spark, root, buckets=8)
    schema = "ticket_id string, origin string, price double, departure_at string, extracted_at string"
    first = spark.createDataFrame([(f"t{i}", "A", float(i), "2025-12-01", "1") for i in range(100)] * 2, schema)
    second = spark.createDataFrame([(f"t{i}", "B", float(-i), "2025-12-01", "2") for i in range(50, 120)], schema)
    assert w.write_hashes("kv_tickets", "a", first, "extracted_at") and w.write_hashes("kv_tickets", "b", second, "extracted_at")
    assert w.write_hashes("kv_tickets", "a", first, "extracted_at") is None
    got = {r["key"]: r["fields"]["price"] for r in w.hashes("kv_tickets").collect()}
    assert len(got) == 120 and got["ticket:t10"] == "10.0" and got["ticket:t60"] == "-60.0"
    assert "hashpartitioning(key" not in plan_of(w.hashes("kv_tickets"))
    one = w.get("kv_tickets", ["ticket:t60", "ticket:none"])
    assert [(r["key"], r["fields"]["origin"]) for r in one.collect()] == [("ticket:t60", "B")]
    formatted = one._jdf.queryExecution().explainString(one.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert any(f"SelectedBucketsCount: {n} out of 8" in formatted for n in (1, 2))
    w.compact("kv_tickets")
    assert {r["key"]: r["fields"]["price"] for r in w.hashes("kv_tickets").collect()} == got
    assert w.store.rows("kv_tickets") == 120


# ---- operators ------------------------------------------------------------------


def _shuffle_files(spark) -> set:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}


def test_shuffles_of_a_write_do_not_outlive_it(spark, root):
    """The files of a merge go with its write, not with the driver's garbage; the session's setting stays."""
    setting = spark.conf.get(CLEANUP, None)
    rows = spark.range(2000).selectExpr("cast(id % 700 as string) ticket_id", "cast(id as string) departure_at", "'a' processed_at")
    w = StoredWarehouse(spark, root)
    before = _shuffle_files(spark)
    w.write_hashes("kv_trends", "b", rows, "processed_at")
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP, None) == setting
    assert w.hashes("kv_trends").count() == 700


def test_dense_numbers(spark):
    values = [(v, i) for i, v in enumerate(["b", None, "a", "b", "zz", "", "c"] * 40)]
    got = dense_number(spark.createDataFrame(values, "v string, i int").repartition(7), ["v", "i"])
    assert "Window" not in plan_of(got)
    order = sorted(values, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r["v"], r["i"]) for r in sorted(got.collect(), key=lambda r: r["number"])] == order
    assert sorted(r["number"] for r in got.collect()) == list(range(1, len(values) + 1))
    assert dense_number(spark.createDataFrame([], "v string"), ["v"]).count() == 0


def test_versions_at_a_time_equal_plain_ones(spark):
    import datetime as dt
    rng, versions, sk = random.Random(8), [], 0
    t0 = dt.datetime(2020, 1, 1)
    for bk in "abcd":
        at = t0 + dt.timedelta(days=rng.randrange(100))
        for k in range(rng.choice([1, 2, 6])):
            sk += 1
            end = at + dt.timedelta(days=rng.choice([0, 1, 40, 400]))
            versions.append([sk, bk, at, end, 0])
            at = end
        versions[-1][3], versions[-1][4] = None, 1
    facts = [(i, rng.choice("abcde"), None if i % 30 == 0 else t0 + dt.timedelta(days=rng.randrange(-50, 1500), hours=rng.randrange(24)))
             for i in range(400)] + [(1000 + i, v[1], v[2]) for i, v in enumerate(versions)]

    def plain(bk, t):
        own = [v for v in versions if v[1] == bk]
        if not own:
            return None
        if t is None:
            return own[-1][0]
        hit = [v for v in own if v[2] <= t and (v[3] is None or t < v[3])]
        return hit[0][0] if hit else own[0][0]
    dim = spark.createDataFrame([(s, bk, "n", "c", a, b, cur) for s, bk, a, b, cur in versions],
                                "airline_sk long, airline_bk string, airline_name string, country string, "
                                "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current int")
    f = spark.createDataFrame(facts, "id int, airline string, extracted_at timestamp_ntz")
    got = {r["id"]: r["airline_sk"] for r in scd2.with_version_at(f, dim, "airline", "extracted_at").collect()}
    assert got == {i: plain(bk, t) for i, bk, t in facts}


# ---- feeds ------------------------------------------------------------------------


def objects(spark, bodies):
    return spark.createDataFrame([("A", "B", "2025-12", i, b) for i, b in enumerate(bodies)],
                                 "origin string, destination string, month string, poll int, body string")


def test_success_is_read_as_the_member_it_is(spark):
    entry = '{"d":{"price":1,"success":"yes"}}'
    bodies = {f'{{"success":{v},"data":{entry}}}': ok for v, ok in
              [("true", True), ("false", False), ("0", False), ("0.0", False), ("null", False), ('""', False), ('"0"', True),
               ('"false"', True), ("[]", False), ("{}", False), ("[0]", True), ("1", True), ('"yes"', True)]}
    got = landing.parse_objects(objects(spark, list(bodies)), landing.FIELDS["grouped_prices"]).select("body", "status").collect()
    assert {r["body"]: r["status"] == "ok" for r in got} == bodies


BODIES = ['{"success":true,"data":{"2025-12-01":{"price":5,"airline":"x"},"2025-12-02":{"price":null}}}',
          '{"success":true,"data":{"2025-12-01":{"price":7},"2025-12-02":3,"2025-12-03":{"price":9}}}', "", "{", '{"success":false}',
          '{"success":true}', '{"success":true,"data":[1]}', '{"success":true,"data":{}}']


@pytest.mark.parametrize("feed", list(incremental.FEEDS))
def test_streams_equal_the_batch_and_repeat_nothing(spark, tmp_path, feed):
    extract, normalise, key = incremental.FEEDS[feed]
    raw = objects(spark, BODIES)
    if feed == "directions":
        raw = raw.withColumn("destination", F.lit(None).cast("string"))
    raw.coalesce(1).write.json(f"{tmp_path}/in")
    raw.where("poll < 2").coalesce(1).write.mode("append").json(f"{tmp_path}/in")      # a file that repeats requests
    out, ts = f"{tmp_path}/out", "2025-12-05 00:00:00"
    args = dict(feed=feed, once=True, max_files_per_trigger=1)
    assert incremental.run_available_now(spark, f"{tmp_path}/in", out, f"{out}/_checkpoint", ts, **args) >= 1
    raw.where("poll = 0").coalesce(1).write.mode("append").json(f"{tmp_path}/in")      # ... and one that comes late
    incremental.run_available_now(spark, f"{tmp_path}/in", out, f"{out}/_checkpoint", ts, **args)
    ext = extract(raw, ts)
    assert rows(incremental.read_ods(spark, out)) == rows(landing.to_store(normalise(ext, ts)))
    assert rows(incremental.read_quarantine(spark, out)) == rows(
        landing.quarantine(feed, landing.parse_objects(raw, landing.FIELDS[feed]), ext, key))
    # a batch that was written and not finished is not read
    incremental.read_ods(spark, out).write.parquet(f"{out}/ods/batch_id=99")
    assert rows(incremental.read_ods(spark, out)) == rows(landing.to_store(normalise(ext, ts)))


def test_ties_do_not_depend_on_partitions(spark):
    batch = spark.createDataFrame([("k", {"a": str(i)}) for i in range(30)], "key string, fields map<string,string>")
    for df in (batch.coalesce(1), batch.repartition(9)):
        assert keyed.kv_fields(keyed.kv_writes(df, F.lit("s"), [])).first()["fields"] == {"a": "9"}


def test_documents_of_any_shape(spark, tmp_path):
    path = f"{tmp_path}/docs"
    one = spark.createDataFrame([(1, "a", 5.0), (2, "b", None)], "id long, city string, price double")
    other = spark.createDataFrame([(3, ("z", 7)), (4, (None, 8))], "id string, deep struct<name:string,n:int>")
    keyed.write_variants(one, path)
    keyed.write_variants(other, path)
    docs = keyed.read_variants(spark, path)
    assert docs.count() == 4
    assert [r["id"] for r in keyed.path_find(docs, {"$.city": "b"}, "$.id").collect()] == ["2"]
    assert [r["n"] for r in keyed.path_find(docs, {"$.deep.name": "z"}, "$.deep.n", "$.city").collect()] == ["7"]
    assert rows(keyed.path_group(docs, "$.city", "city")) == [("a", 1), ("b", 1), (None, 2)]
    assert docs.select(F.sum(keyed.at_path("$.id", "long"))).first()[0] == 10
    assert keyed.path_find(docs, {"$.none.such": "x"}, "$.id").count() == 0
    # only the asked paths reach the scan, the condition too
    plan = plan_of(keyed.path_group(docs.where(keyed.at_path("$.city") == "a"), "$.price", "price"))
    assert "ReadSchema: struct<doc:struct<0:string,1:string>>" in plan and "EqualTo(doc" in plan
