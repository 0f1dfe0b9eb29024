from collections import Counter

import duckdb
import pytest

from skyfare.llm import quality
from skyfare.llm.queries import QUERIES, SQL

from .helpers import SF_SMALL, SF_TINY, clashing, documents, oracle_rows, rows_of, same_as_oracle, ws

WORDS = " \t\n\x0b\x0c\r"


def plain(text):
    """The contract's counts, word by word."""
    text = text or ""
    for c in WORDS[1:]:
        if c != "\n":
            text = text.replace(c, " ")
    lines = text.split("\n")
    words = [w for x in lines for w in x.split(" ") if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    told = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(told)


def test_query_equals_its_sql(spark):
    for folder in (SF_TINY, SF_SMALL):
        same_as_oracle(spark, QUERIES["op13_quality_rules"], SQL["op13_quality_rules"], folder)


EIGHT = "a b c d e f g h"
ODD = [None, "", " \n\t ", "one", EIGHT, f"{EIGHT} {EIGHT}", f"{EIGHT} x {EIGHT} a b c", "x " * 5000,
       "a b " * 7, f"{EIGHT}\n{EIGHT}\n\n{EIGHT} ", "été \U0001f600 x #*$ %&|<>" * 9, "same line\nsame line\n" * 40,
       "\x0b".join("k l m n o p q r s".split()), "a\rb\x0cc", "w " * 7 + "w", " ".join(f"t{i % 11}" for i in range(400))]


def test_counts_equal_plain_ones(spark):
    d = documents(spark, list(enumerate(ODD)))
    got = {r["doc_id"]: r for r in quality.measure(d).collect()}
    for i, text in enumerate(ODD):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_repeat_words"]) == plain(text), (i, text)
    assert got[11]["n_dup_lines"] == 79 and got[9]["n_dup_lines"] == 1


def test_edges_equal_the_sql(spark, tmp_path):
    rows = [(i, t, ["en", "de", None][i % 3], ["src0", None, "x"][i % 2]) for i, t in enumerate(ODD)]
    rows += [(None, "null id " * 15, "en", "src0"), (3, "one", "en", "src0"), (3, "one", "en", "src0"),
             (900, " ".join(f"v{i}" for i in range(200_000)), "en", "src0")]
    rows += [(1000 + i, " ".join(f"w{j * (i % 5 + 1)}" for j in range(20 + i % 40)), "en", "src0") for i in range(300)]
    clashing(documents(spark, rows)).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_quality_rules"](spark, str(tmp_path))
    cols = sorted(got.columns)
    assert rows_of(got, cols) == oracle_rows(str(tmp_path), SQL["op13_quality_rules"], cols)
    assert got.count() == len(rows)


def test_empty_table(spark):
    assert quality.judge(documents(spark, []), ws(spark)).count() == 0


@pytest.mark.parametrize("v", [0, 1, 255, 256, 257, 511, 512, 1000, 123_456, 2**40 + 12345, 2**62])
def test_a_bin_holds_its_value_within_one_part_in_128(spark, v):
    b = spark.sql(f"SELECT {quality.bin_sql(f'cast({v} as bigint)')} AS b")
    low, high = b.select(*[e.alias(n) for n, e in zip(("low", "high"), quality._ends(b["b"]))]).first()
    assert low <= v <= high and high - low <= v / 128


def test_merged_sketches_equal_a_sketch_of_all(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    m = quality.measure(docs)
    parts = quality.merged(quality.sketch(m), ["lang"])
    whole = quality.sketch(m.drop("source").selectExpr("*", "cast(null as string) as source")).drop("source")
    cols = ["lang", "measure", "bin", "n"]
    assert rows_of(parts, cols) == rows_of(whole, cols)


def test_thresholds_follow_their_source(spark):
    """Code-like sources keep their symbols; the same text elsewhere is an outlier."""
    code = "x = 1 ; # note y <- 2 | z & a < b > c $ d % e * f "
    rows = [(i, code * 3 + f"end{i}", "en", "code") for i in range(2000)]
    prose = " ".join(f"word{j}" for j in range(30))
    rows += [(5000 + i, f"{prose} tail{i}", "en", "prose") for i in range(2000)]
    rows += [(9000, "a# b* c$ d% e& f| g< h> " + " ".join(f"k{i}#" for i in range(20)), "en", "prose")]
    cfg = quality.Quality(max_repeat_pct=100)
    got = {r["doc_id"]: r for r in quality.judge(documents(spark, rows), ws(spark), cfg).collect()}
    assert got[9000]["outside"].startswith("word_size,symbols") or "symbols" in got[9000]["outside"]
    assert not got[9000]["kept"] and got[5000]["kept"]
    assert "symbols" not in got[0]["outside"]


def test_no_python_on_the_path(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = quality.judge(docs, ws(spark))._jdf.queryExecution().executedPlan().toString()
    plan += quality.measure(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
