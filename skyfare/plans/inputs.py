"""Where a warehouse run takes its inputs from.

* ``FixtureInputs`` — the driver's TPC-H-like tables mapped onto flights
  (airports = nations, airline lookups = rules over the brands, and an
  earlier lookup release replayed as a previous SCD2 run).
* ``LandingInputs`` — grouped-prices landing files as the fare API returns
  them, with the fixed airports, airline lookup and airline snapshot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.lookup import airline_lookup_table
from ..operators import dims
from ..sources import feeds, fixture, landing


@dataclass(frozen=True)
class FixtureInputs:
    def ods(self, wh) -> DataFrame:
        return fixture.ods_tickets(wh.spark, wh.sf_dir, wh.cfg, lines=wh.read("fixture_lines"))

    def airports(self, wh) -> DataFrame:
        return fixture.airports(wh.spark, wh.sf_dir, wh.cfg)

    def lookup(self, wh, previous: bool) -> DataFrame | None:
        return fixture.airline_lookup(wh.spark, wh.sf_dir, wh.cfg, previous)

    def snapshot(self, wh) -> DataFrame:
        return fixture.airline_snapshot(wh.spark, wh.sf_dir, wh.cfg)


@dataclass(frozen=True)
class LandingInputs:
    landing_dir: str

    def ods(self, wh) -> DataFrame:
        raw = feeds.read_landing(wh.spark, self.landing_dir)
        ext = wh.write("ext_grouped_prices", landing.extract_grouped_prices(raw, wh.cfg.batch_ts))
        return landing.to_store(landing.normalize_tickets(ext, wh.cfg.batch_ts))

    def airports(self, wh) -> DataFrame:
        return dims.dim_airport_fixed(wh.spark)

    def lookup(self, wh, previous: bool) -> DataFrame | None:
        return None if previous else airline_lookup_table(wh.spark)

    def snapshot(self, wh) -> DataFrame:
        return dims.dim_airline_snapshot_fixed(wh.spark)
