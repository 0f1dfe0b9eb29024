"""parse_ts on generated texts whose meaning is fixed while they are made."""

import datetime as dt
import random

from pyspark.sql import functions as F

from skyfare.functions.dates import parse_ts


def case(rnd):
    """(text, what it means): a moment is drawn, written in some shape, and
    perhaps spoilt in a way whose effect is known."""
    t = dt.datetime(rnd.choice([1999, 2000, 2024, 2025]), rnd.randint(1, 12), rnd.randint(1, 28),
                    rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59))
    day = dt.datetime(t.year, t.month, t.day)
    pad = rnd.random() < 0.6
    m, d = (f"{t.month:02d}", f"{t.day:02d}") if pad else (str(t.month), str(t.day))
    full = len(m) == len(d) == 2
    if rnd.random() < 0.1 and t.day < 10:
        d, full = f" {t.day}", False
    clock = f"{t.hour:02d}:{t.minute:02d}:{t.second:02d}" if rnd.random() < 0.8 else f"{t.hour}:{t.minute}:{t.second}"
    gap = rnd.choice(["T", " ", "  ", "\t", "t"])
    iso, dotted = f"{t.year}-{m}-{d}", f"{d}.{m}.{t.year}"
    kind = rnd.randrange(12)
    if kind == 0:
        return iso, day
    if kind in (1, 2):
        return f"{iso}{gap}{clock}", t
    if kind == 3:
        return dotted, day
    if kind == 4:
        return f"{dotted} {clock}", t
    if kind == 5:  # something after the time: only a full ISO day is still found, without its time
        return f"{iso}T{clock}{rnd.choice(['+03:00', '.123456', 'Z', ' x'])}", day if full else None
    if kind == 6:  # something before it
        return f"{rnd.choice(['x ', 'at ', '#'])}{iso}", day if full else None
    if kind == 7:  # no such clock time
        return f"{iso} {rnd.choice(['24:00:00', '10:60:00', '10:00'])}", day if full else None
    if kind == 8:  # no such day
        return f"{t.year}-{rnd.choice(['02-30', '13-01', '00-10', '04-31', '01-32', '06-00'])}", None
    if kind == 9:
        return f"{dotted}{rnd.choice(['x', ' 10', '+1', ' 25:00:00'])}", None
    if kind == 10:
        return rnd.choice([f"{d}/{m}/{t.year}", f"{t.year}-{t.year % 1000:03d}-{t.day}", f"{t.month}.{t.year}"]), None
    return rnd.choice([("", None), ("abc", None), ("2025", None), ("--", None),
                       ("2025-12-01junk", dt.datetime(2025, 12, 1)),
                       ("2025-02-30 2025-03-01", None)])


def cases(n=2000, seed=7):
    rnd = random.Random(seed)
    return [case(rnd) for _ in range(n)]


def test_spark_parse(spark):
    data = cases()
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(data)], "i int, t string")
    got = {r.i: r.p for r in df.select("i", parse_ts(F.col("t")).alias("p")).collect()}
    bad = [(t, got[i], want) for i, (t, want) in enumerate(data) if got[i] != want]
    assert not bad, bad[:10]


def test_oracle_parse():
    import duckdb

    from skyfare.plans.oracle_base import parse_ts_sql
    data = cases()
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, t) for i, (t, _) in enumerate(data)])
    got = dict(con.execute("SELECT i, " + parse_ts_sql("s") + " FROM t").fetchall())
    bad = [(t, got[i], want) for i, (t, want) in enumerate(data) if got[i] != want]
    assert not bad, bad[:10]
