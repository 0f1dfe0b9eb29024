"""End-to-end run: ODS -> (SCD2 airline || dimensions) -> fact -> marts.

Every layer is written as parquet to its own fresh versioned folder under the
cluster's shared checkpoint folder and read back from there.  That cuts the
lineage between layers (a lost executor recomputes from the last written
layer, never from the raw feed), gives downstream joins exact file-size
statistics, and makes a layer switch atomic: a new version is written next
to the old one and the pointer moves only after the write succeeded.

Layers are built on first use, so a query that needs only the ODS does not
pay for the fact load.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, RunConfig
from ..functions.lookup import with_airline_info
from ..operators import dims, fact, marts, quality, scd2
from ..operators.joins import bounded_broadcast, unhinted
from ..session import app_id, new_run_dir, transient_shuffles
from ..sources import feeds, fixture, landing
from .inputs import FixtureInputs, LandingInputs

MARTS = ["mart_route_analysis", "mart_airline_performance", "mart_temporal_patterns",
         "mart_flight_type_analysis", "mart_price_summary"]


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig = DEFAULT,
                 inputs=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.inputs = inputs if inputs is not None else FixtureInputs()
        self.run_dir = new_run_dir(spark, "warehouse")
        self.paths: dict[str, str] = {}
        self.versions: dict[str, int] = {}
        self.rows: dict[str, int] = {}
        self._lock = threading.RLock()

    # ---- storage -------------------------------------------------------
    def write(self, name: str, df: DataFrame, count: bool = False,
              sort_within: list[str] | None = None) -> DataFrame:
        """Write ``df`` as the next version of table ``name`` and switch.

        With ``count`` the row count is taken by an ``Observation`` during
        the write itself (no second job); it backs the broadcast checks.
        """
        v = self.versions.get(name, 0) + 1
        path = f"{self.run_dir}/{name}/v{v}"
        if sort_within:
            df = df.sortWithinPartitions(*sort_within)
        obs = None
        if count:
            obs = Observation(f"{name}_v{v}")
            df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        with transient_shuffles(self.spark):
            df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        self.paths[name] = path
        self.versions[name] = v
        if obs is not None:
            self.rows[name] = int(obs.get["rows"])
        return self.spark.read.parquet(path)

    def read(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self.paths:
                getattr(self, f"_build_{name}")()
        return self.spark.read.parquet(self.paths[name])

    def version_path(self, name: str, v: int) -> str:
        return f"{self.run_dir}/{name}/v{v}"

    def small(self, name: str) -> DataFrame:
        """A dimension, broadcast when its counted size is within bound."""
        df = self.read(name)
        return bounded_broadcast(df, self.rows.get(name), self.cfg.broadcast_max_rows)

    def hint(self, *names: str):
        """``F.broadcast`` when the named dimensions were counted at write
        time and together stay within ``broadcast_max_rows``; identity
        otherwise, leaving the join strategy to Spark's size estimates."""
        for n in names:
            self.read(n)
        rows = [self.rows.get(n) for n in names]
        if all(r is not None for r in rows) and sum(rows) <= self.cfg.broadcast_max_rows:
            return F.broadcast
        return unhinted

    # ---- ODS -------------------------------------------------------------
    def _build_fixture_lines(self):
        self.write("fixture_lines", fixture.joined_lines(self.spark, self.sf_dir))

    @classmethod
    def from_landing(cls, spark: SparkSession, landing_dir: str,
                     cfg: RunConfig = DEFAULT) -> "Warehouse":
        """A warehouse fed by grouped-prices landing files (fixed airports,
        airline lookup and snapshot)."""
        return cls(spark, landing_dir, cfg, inputs=LandingInputs(landing_dir))

    def _build_ods_cheap_tickets(self):
        self.write("ods_cheap_tickets", self.inputs.ods(self))

    # ---- dimensions --------------------------------------------------------
    def _build_dim_airport(self):
        self.write("dim_airport", self.inputs.airports(self), count=True)

    def _build_dim_flight_type(self):
        self.write("dim_flight_type", dims.dim_flight_type(self.spark), count=True)

    def _build_dim_date(self):
        self.write("dim_date", dims.dim_date(self.spark, self.cfg.calendar_start,
                                             self.cfg.calendar_end), count=True)

    def _build_dim_route(self):
        self.write("dim_route", dims.dim_route(self.read("ods_cheap_tickets"),
                                               self.read("dim_airport"),
                                               hint=self.hint("dim_airport")), count=True)

    def _build_dim_airline_snapshot(self):
        self.write("dim_airline_snapshot", self.inputs.snapshot(self), count=True)

    def _build_airline_lookup(self):
        self.write("airline_lookup", self.inputs.lookup(self, previous=False), count=True)

    def _build_airline_lookup_previous(self):
        prev = self.inputs.lookup(self, previous=True)
        self.write("airline_lookup_previous",
                   prev if prev is not None else self.read("airline_lookup"), count=True)

    def lookup(self, previous: bool = False) -> DataFrame:
        return self.read("airline_lookup_previous" if previous else "airline_lookup")

    def _build_dim_airline(self):
        """The Type-2 airline dimension, built under private names and made
        current by its last write alone.

        Inputs with an earlier lookup release replay it as a run of its own
        (stamp ``prev_batch_ts``): initial load, then a merge that finds
        nothing.  Inputs without one are loaded once, valid from this run."""
        ods = self.read("ods_cheap_tickets")
        codes = self.write("ods_airline_codes", scd2.source_codes(ods), count=True)
        src = self.write("scd2_source", with_airline_info(codes, self.lookup(previous=False),
                                                          hint=self.hint("airline_lookup")), count=True)
        empty, previous = scd2.empty_dim(self.spark), self.inputs.lookup(self, previous=True)
        first_src, stamp = src, self.cfg.batch_ts
        if previous is not None:
            first_src = with_airline_info(codes, self.lookup(previous=True),
                                          hint=self.hint("airline_lookup_previous"))
            stamp = self.cfg.prev_batch_ts
        v1 = self.write("dim_airline_initial", scd2.scd2_initial(empty, first_src, stamp, dim_rows=0), count=True)
        v2 = self.write("dim_airline_previous", scd2.scd2_merge(v1, first_src, stamp,
                                                                hint=self.hint("dim_airline_initial")), count=True)
        self.write("dim_airline", scd2.scd2_merge(v2, src, self.cfg.batch_ts,
                                                  hint=self.hint("dim_airline_previous")), count=True)

    def _build_dim_airline_initial(self):
        self._build_dim_airline()

    def _build_dim_airline_previous(self):
        self._build_dim_airline()

    def _build_scd2_source(self):
        self._build_dim_airline()

    # ---- fact ----------------------------------------------------------------
    def routes_by_code(self) -> DataFrame:
        return fact.route_codes(self.read("dim_route"), self.read("dim_airport"),
                                hint=self.hint("dim_airport"))

    def staged(self) -> DataFrame:
        cfg = self.cfg
        routes = bounded_broadcast(self.routes_by_code(), self.rows.get("dim_route"),
                                   cfg.broadcast_max_rows)
        cur = scd2.current_versions(self.read("dim_airline"))
        cur = bounded_broadcast(cur, self.rows.get("dim_airline"), cfg.broadcast_max_rows)
        cal = self.small("dim_date")
        return fact.stage(self.read("ods_cheap_tickets"), routes, cur, cal, cfg.batch_ts)

    def _build_fact_outcomes(self):
        self.write("fact_outcomes", fact.outcomes(self.staged()))

    def _build_fact_flights(self):
        self.write("fact_flights", fact.fact_from_outcomes(self.read("fact_outcomes")),
                   sort_within=["date_id"])

    def _build_fact_cube(self):
        self.write("fact_cube", marts.fact_cube(self.read("fact_flights")),
                   sort_within=["date_id"])

    # ---- marts (all from the cube: one fact scan for all of them) ----------
    def _build_mart_route_analysis(self):
        self.write("mart_route_analysis", marts.route_analysis(
            self.read("fact_cube"), self.read("dim_route"), self.read("dim_airport"),
            hint=self.hint("dim_route", "dim_airport")))

    def _build_mart_airline_performance(self):
        self.write("mart_airline_performance", marts.airline_performance(
            self.read("fact_cube"), self.read("dim_airline"), self.read("dim_flight_type"),
            hint=self.hint("dim_airline", "dim_flight_type")))

    def _build_mart_temporal_patterns(self):
        self.write("mart_temporal_patterns", marts.temporal_patterns(
            self.read("fact_cube"), self.read("dim_date"), hint=self.hint("dim_date")))

    def _build_mart_flight_type_analysis(self):
        self.write("mart_flight_type_analysis", marts.flight_type_analysis(
            self.read("fact_cube"), self.read("dim_flight_type"),
            hint=self.hint("dim_flight_type")))

    def _build_mart_price_summary(self):
        self.write("mart_price_summary", marts.price_summary(
            self.read("fact_cube"), self.read("dim_date"), self.cfg.as_of,
            hint=self.hint("dim_date")))

    # ---- landing feeds ------------------------------------------------------
    FEEDS = {"grouped_prices": (feeds.grouped_prices_landing, landing.extract_grouped_prices),
             "directions": (feeds.directions_landing, landing.extract_directions),
             "calendar": (feeds.price_calendar_landing, landing.extract_calendar)}

    def _build_landing_polls(self):
        self.write("landing_polls", feeds.polls(feeds.flights(self.read("fixture_lines"))))

    def landing_path(self, feed: str) -> str:
        """Landing JSON files of a feed (written once per run)."""
        with self._lock:
            key = f"landing_{feed}"
            if key not in self.paths:
                path = f"{self.run_dir}/landing/{feed}"
                feeds.write_landing(self.FEEDS[feed][0](feeds.flights(self.read("fixture_lines"))), path)
                self.paths[key] = path
            return self.paths[key]

    def landing(self, feed: str) -> DataFrame:
        return feeds.read_landing(self.spark, self.landing_path(feed))

    def parsed(self, feed: str) -> DataFrame:
        """Taken entries and, with an ``object_status``, the objects that were not
        (fully) loaded, from one parse of the landing files."""
        name = f"parsed_{feed}"
        with self._lock:
            if name not in self.paths:
                self.write(name, self.FEEDS[feed][1](self.landing(feed), self.cfg.batch_ts, skips=True))
        return self.spark.read.parquet(self.paths[name])

    def extract(self, feed: str) -> DataFrame:
        return self.parsed(feed).where(F.col("object_status").isNull()).drop("object_status")

    def accepted(self, feed: str) -> DataFrame:
        """Good rows for a table that is itself written once: from the parsed table if
        there is one, else straight from the landing files, so that entries of which
        few columns are needed are not written and read again."""
        with self._lock:
            if f"parsed_{feed}" in self.paths:
                return self.extract(feed).where(F.col("reject_reason").isNull())
        return landing.accepted(self.FEEDS[feed][1](self.landing(feed), self.cfg.batch_ts))

    def quarantine(self, feed: str, key_col: str) -> DataFrame:
        """What was set aside of a feed: from the parsed table if there is one, else straight
        from the landing files, reading only the members that can be at fault."""
        name = f"quarantine_{feed}"
        with self._lock:
            if name not in self.paths:
                stored = f"parsed_{feed}" in self.paths
                ext = (self.parsed(feed) if stored else
                       self.FEEDS[feed][1](self.landing(feed), self.cfg.batch_ts, skips=True))
                self.write(name, landing.quarantine_of(feed, ext, key_col, stored))
        return self.spark.read.parquet(self.paths[name])

    def register_views(self, names: list[str] | None = None) -> list[str]:
        """Temp views over the current version of each layer, so the
        warehouse can be queried with plain Spark SQL (``fact_flights``,
        ``dim_route``, ``mart_route_analysis``, ...)."""
        names = names or (["ods_cheap_tickets", "dim_date", "dim_airport", "dim_route",
                           "dim_flight_type", "dim_airline", "fact_flights"] + MARTS)
        for n in names:
            self.read(n).createOrReplaceTempView(n)
        return names

    def publish(self, database: str = "skyfare", names: list[str] | None = None) -> list[str]:
        """Catalog tables over the current version of each layer.

        A table that does not exist yet is created over the version's folder
        (create-if-absent, checked with ``spark.catalog.tableExists``); an
        existing one is switched to the new folder with ``ALTER TABLE ...
        SET LOCATION`` -- a full refresh that never rewrites the files a
        reader may be scanning."""
        names = names or (["ods_cheap_tickets", "dim_date", "dim_airport", "dim_route",
                           "dim_flight_type", "dim_airline", "fact_flights"] + MARTS)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for n in names:
            self.read(n)
            path = self.paths[n].replace("'", "''")
            table = f"{database}.{n}"
            if self.spark.catalog.tableExists(table):
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                self.spark.sql(f"REFRESH TABLE {table}")
            else:
                self.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
        return [f"{database}.{n}" for n in names]

    def unpublish(self, database: str = "skyfare") -> None:
        """Drop the catalog tables of ``database`` (clean-up).  They are
        external tables, so the versioned files stay where they are."""
        if not self.spark.catalog.databaseExists(database):
            return
        for t in self.spark.catalog.listTables(database):
            self.spark.sql(f"DROP TABLE IF EXISTS {database}.{t.name}")

    # ---- quality ---------------------------------------------------------
    def _build_dq_report(self):
        self.write("dq_report", quality.dq_report(self.read("ods_cheap_tickets"), self.read("fact_flights"),
                                                  self.cfg.min_success_pct, self.cfg.max_valid_price))

    def _build_fact_validate(self):
        names = ("dim_route", "dim_airline", "dim_date", "dim_flight_type")
        self.write("fact_validate", quality.fact_validate(
            self.read("fact_flights"), *[self.read(n) for n in names], self.cfg.max_valid_price,
            hint=self.hint(*names)))

    def _build_scd2_validate(self):
        self.write("scd2_validate", quality.scd2_validate(self.read("dim_airline"),
                                                          self.read("ods_cheap_tickets")))

    def build_all(self) -> "Warehouse":
        for m in MARTS:
            self.read(m)
        return self


_CACHE: dict = {}
_CACHE_LOCK = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str, cfg: RunConfig = DEFAULT) -> Warehouse:
    """The warehouse of this session for ``sf_dir`` (built lazily, once)."""
    key = (app_id(spark), sf_dir.rstrip("/"), cfg)
    with _CACHE_LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            wh = _CACHE[key] = Warehouse(spark, sf_dir, cfg)
    return wh


def run_pipeline(spark: SparkSession, sf_dir: str, cfg: RunConfig = DEFAULT) -> Warehouse:
    """Ingest -> (SCD2 || dimensions) -> fact -> marts -> quality, in that order.

    The quality reports are layers like the others (``dq_report``,
    ``fact_validate``, ``scd2_validate``); an empty mart fails the run."""
    wh = warehouse(spark, sf_dir, cfg)
    for name in ["ods_cheap_tickets", "dim_airline", "dim_date", "dim_airport",
                 "dim_route", "dim_flight_type", "fact_outcomes", "fact_flights"]:
        wh.read(name)
    wh.build_all()
    for name in ("dq_report", "fact_validate", "scd2_validate"):
        wh.read(name)
    quality.assert_marts_nonempty({m: wh.read(m) for m in MARTS})
    return wh
