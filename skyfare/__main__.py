"""Run the warehouse from the command line.

    python -m skyfare --sf-dir /root/testdata/sf0.01
    python -m skyfare --landing /data/landing/grouped_prices --as-of 2025-12-15 \\
        --calendar 2020-01-01:2025-12-31 --publish skyfare
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt

from .config import DEFAULT
from .operators.reports import table_counts
from .plans.warehouse import MARTS, Warehouse, run_pipeline
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="skyfare", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder with the driver's parquet tables")
    src.add_argument("--landing", help="folder with grouped-prices landing files")
    ap.add_argument("--master", default=None)
    ap.add_argument("--as-of", type=dt.date.fromisoformat, help="month of the price summary")
    ap.add_argument("--calendar", help="calendar range start:end (ISO dates)")
    ap.add_argument("--batch-ts", help="load stamp, 'YYYY-MM-DD HH:MM:SS'")
    ap.add_argument("--publish", metavar="DATABASE", help="register catalog tables")
    a = ap.parse_args(argv)

    cfg = DEFAULT
    if a.as_of:
        cfg = dataclasses.replace(cfg, as_of=a.as_of)
    if a.calendar:
        start, end = (dt.date.fromisoformat(x) for x in a.calendar.split(":"))
        cfg = dataclasses.replace(cfg, calendar_start=start, calendar_end=end)
    if a.batch_ts:
        cfg = dataclasses.replace(cfg, batch_ts=a.batch_ts)

    spark = build_session(a.master)
    if a.landing:
        w = Warehouse.from_landing(spark, a.landing, cfg).build_all()
    else:
        w = run_pipeline(spark, a.sf_dir, cfg)
    names = ["ods_cheap_tickets", "dim_date", "dim_airport", "dim_route", "dim_flight_type",
             "dim_airline", "fact_flights"] + MARTS
    table_counts({n: w.read(n) for n in names}).show(len(names), truncate=False)
    if a.publish:
        for t in w.publish(a.publish, names):
            print(t)


if __name__ == "__main__":
    main()
