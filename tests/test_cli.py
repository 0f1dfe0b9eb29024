"""The command-line entry runs the warehouse and prints row counts."""

import contextlib
import io

from tests.conftest import SF_SMALL


def test_cli_runs_pipeline(spark):
    from skyfare.__main__ import main
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        main(["--sf-dir", SF_SMALL])
    text = out.getvalue()
    assert "fact_flights" in text and "mart_price_summary" in text
