"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL)


def test_all_queries_match_oracle(results):
    bad = {k: v for k, v in results.items() if v[0] not in ("OK", "NO_ORACLE")}
    assert not bad, bad


def test_every_query_has_an_oracle(results):
    no_oracle = [k for k, v in results.items() if v[0] == "NO_ORACLE"]
    assert not no_oracle, no_oracle


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["type_category", "flight_type_id", "flights", "avg_price"]
    assert len(rows) == 3


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def test_every_flight_lands_once(spark):
    """Every lineitem is an entry of some object of each feed, at two sizes:
    loaded entries plus those of skipped requests."""
    from skyfare.plans.warehouse import warehouse
    for folder in (SF_SMALL, "/root/testdata/sf0.01"):
        w = warehouse(spark, folder)
        lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
        polled = w.read("landing_polls")
        assert polled.count() == lines
        for feed, skipped in (("grouped_prices", "o = d OR o + d IN (5, 7, 9, 11)"),
                              ("calendar", "o = d OR o + d IN (5, 7, 9, 11)"),
                              ("directions", "o IN (5, 7, 9, 11, 13)")):
            assert w.extract(feed).count() + polled.where(skipped).count() == lines


def test_column_types_match_oracle(spark):
    import __spark_entry__ as E
    from tests.oracle_compare import duck
    con = duck(SF_SMALL)
    bad = []
    from skyfare.plans.registry import SQL
    for name, sql in SQL.items():
        schema = E.queries()[name](spark, SF_SMALL).schema
        desc = {d[0]: str(d[1]) for d in con.execute(sql).description}
        for f in schema.fields:
            t = f.dataType.simpleString()
            if desc.get(f.name) != SPARK_TO_DUCK.get(t, t.upper()):
                bad.append((name, f.name, t, desc.get(f.name)))
    assert not bad, bad
