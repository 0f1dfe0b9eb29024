"""SCD2 invariants over a random sequence of source batches."""

import datetime as dt
import random

from skyfare.operators import scd2


def test_random_batches_keep_invariants(spark):
    rnd = random.Random(5)
    codes = [f"A{i}" for i in range(8)]
    dim = scd2.empty_dim(spark)
    last = {}                      # code -> (name, country) as last loaded
    for b in range(6):
        ts = f"2025-0{b + 1}-01 00:00:00"
        batch = {}
        for c in rnd.sample(codes, rnd.randint(2, len(codes))):
            batch[c] = (rnd.choice(["N1", "N2", None]), rnd.choice(["X", "Y"]))
        src = spark.createDataFrame([(c, n, k) for c, (n, k) in batch.items()],
                                    "airline_bk string, airline_name string, country string")
        if b == 0:
            dim = scd2.scd2_initial(dim, src, ts, dim_rows=0)
        else:
            dim = scd2.scd2_merge(dim, src, ts)
        dim = spark.createDataFrame(dim.collect(), dim.schema)   # small: keep plans short
        last.update(batch)
        rows = dim.collect()
        cur = [r for r in rows if r.is_current == 1]
        assert sorted(r.airline_bk for r in cur) == sorted(last)          # one current per key
        assert {r.airline_bk: (r.airline_name, r.country) for r in cur} == last
        assert len({r.airline_sk for r in rows}) == len(rows)            # unique keys
        by_key = {}
        for r in rows:
            by_key.setdefault(r.airline_bk, []).append(r)
        for versions in by_key.values():
            versions.sort(key=lambda r: r.valid_from)
            for older, newer in zip(versions, versions[1:]):
                assert older.is_current == 0 and older.valid_to == newer.valid_from
            assert versions[-1].valid_to is None
        assert all(isinstance(r.valid_from, dt.datetime) for r in rows)
