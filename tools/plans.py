"""Write PLANS.md: the physical plans of the headline steps (sf0.01)."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from skyfare.operators import fact, keyed, marts  # noqa: E402
from skyfare.plans.registry import QUERIES  # noqa: E402
from skyfare.plans.warehouse import warehouse  # noqa: E402
from skyfare.session import build_session  # noqa: E402
from skyfare.sources import landing  # noqa: E402

SF = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    spark = build_session("local[8]", app="skyfare-plans", shuffle_partitions=16)
    w = warehouse(spark, SF)
    w.build_all()
    cfg = w.cfg
    steps = {
        "Fact load (stage + one aggregate per flight_id)": fact.outcomes(w.staged()),
        "Fact cube": marts.fact_cube(w.read("fact_flights")),
        "Route mart (from the cube)": marts.route_analysis(
            w.read("fact_cube"), w.read("dim_route"), w.read("dim_airport"),
            hint=w.hint("dim_route", "dim_airport")),
        "Price summary (one month, one row)": marts.price_summary(
            w.read("fact_cube"), w.read("dim_date"), cfg.as_of, hint=w.hint("dim_date")),
        "Top 10 dearest flights": QUERIES["top_expensive"](spark, SF),
        "Broken links check": QUERIES["dq_broken_links"](spark, SF),
        "Feed extract (grouped prices)": landing.extract_grouped_prices(
            w.landing("grouped_prices"), cfg.batch_ts),
        "Key-value upsert (latest write per key)": keyed.kv_upsert(
            None, keyed.kv_encode(landing.normalize_tickets(w.extract("grouped_prices"),
                                                            cfg.batch_ts), *keyed.TICKET_KEY)
            .withColumn("_dep", F.col("fields")["departure_at"])
            .withColumn("_org", F.col("fields")["origin"]),
            F.col("fields")["extracted_at"], ["_dep", "_org"]),
        "Range filter + count": QUERIES["bench_price_filter"](spark, SF),
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/plans.py` at `{SF}` (local[8], AQE on; the final",
           "plans may differ after AQE re-optimisation at run time).", ""]
    for title, df in steps.items():
        out += [f"## {title}", "", "```", plan(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
