"""Small fixtures for the training-data operators."""

import os

import duckdb
from pyspark.sql import functions as F

from skyfare.llm.common import Workspace

SF_TINY, SF_SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def ws(spark):
    return Workspace(spark, "test")


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
             len(r[1]) if r[1] else None) for r in rows]
    return spark.createDataFrame(full, DOCS)


CLASHING = ("fp", "key", "n", "score", "weight", "block", "pivot", "term", "entity", "host", "rest", "bit",
            "shard", "first", "epochs", "leaf", "y", "a", "b", "node", "root", "share", "s", "e")


def clashing(df):
    """The same rows with extra columns named like ones an operator may use inside."""
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(folder, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def rows_of(df, columns=None):
    columns = columns or sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def oracle_rows(folder, sql, columns):
    got = duck(folder).execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(columns), (names, columns)
    return sorted((tuple(r[names.index(c)] for c in columns) for r in got.fetchall()), key=repr)


def same_as_oracle(spark, query, sql, folder):
    df = query(spark, folder)
    columns = sorted(df.columns)
    assert rows_of(df, columns) == oracle_rows(folder, sql, columns)
