"""Run parameters.  Nothing reads the wall clock: every time-dependent
value (load stamp, "current month") is an explicit parameter."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunConfig:
    # one load stamp per run, used for processed_at, SCD2 validity and the
    # extracted_at fallback; the reference called now() several times
    batch_ts: str = "2025-12-01 00:00:00"
    # load stamp of the previous SCD2 run (the fixture replays two runs)
    prev_batch_ts: str = "2025-11-01 00:00:00"
    # stamps of the two loads of the stored warehouse (inside the fixture's order dates)
    first_load_ts: str = "1994-07-01 00:00:00"
    second_load_ts: str = "1996-07-01 00:00:00"
    # "current month" of the price-summary mart
    as_of: dt.date = dt.date(2000, 6, 15)
    # calendar dimension range, inclusive
    calendar_start: dt.date = dt.date(1995, 1, 1)
    calendar_end: dt.date = dt.date(2000, 12, 31)
    # thresholds of the quality report
    min_success_pct: float = 90.0
    max_valid_price: int = 1_000_000
    # largest dimension (rows) we hand to a broadcast join; larger ones
    # are joined by shuffle
    broadcast_max_rows: int = 2_000_000
    # fixture knobs (driver tables -> flights)
    fixture_missing_airport_nations: tuple = (23, 24)
    fixture_known_brands: int = 18
    fixture_prev_known_brands: int = 20
    fixture_snapshot_brands: int = 10

    @property
    def calendar_days(self) -> int:
        return (self.calendar_end - self.calendar_start).days + 1


DEFAULT = RunConfig()
