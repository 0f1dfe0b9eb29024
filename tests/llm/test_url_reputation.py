from skyfare.llm import url_reputation as U
from skyfare.llm.queries import QUERIES, SQL

from .helpers import SF_SMALL, clashing, oracle_rows, rows_of, same_as_oracle, ws


def test_query_equals_its_sql(spark):
    same_as_oracle(spark, QUERIES["op10_url_reputation"], SQL["op10_url_reputation"], SF_SMALL)


def test_edges_equal_the_sql(spark, tmp_path):
    urls = [None, "", "no scheme", "http://", "http://A.Example.ORG", "http://a.example.org/es/x", "ftp://org/x?y#z",
            "https://x.com/fr/1#a?b", "https://com/de/?q", "https://com:80/de/", "http://a.b.co.uk/x", "://h/p",
            "http://example.org/en/1", "http://notexample.org/en/1", "http://h/a\nb", "http://bad.net/x",
            "http://10.0.0.1/x", "http://10.0.0.1:8080/x", "http://me:pw@10.0.0.1/", "http://[::1]:80/x", "http://u@a.b.co.uk:1/",
            "http://1.2.3.4.5/", "http://h.bad.net:99/", "http://long.net/" + "p/" * 100_000]
    pages = clashing(spark.createDataFrame([(i, u) for i, u in enumerate(urls * 2)] + [(None, "http://bad.net/y")] +
                                           [(1000 + i, "http://bad.net/z") for i in range(60)] +
                                           [(2000 + i, f"http://h{i % 7}.good.net/z") for i in range(80)],
                                           "page_id long, url string"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2000, 2070)] + [(i, 0, 0) for i in range(1000, 1050)] +
                                   [(1, None, 1), (2, 1, None), (2, 0, 0), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op10_url_reputation"](spark, str(tmp_path))
    cols = sorted(got.columns)
    assert rows_of(got, cols) == oracle_rows(str(tmp_path), SQL["op10_url_reputation"], cols)
    verdict = {r["host"]: r["verdict"] for r in got.where("rule IS NULL").collect()}
    assert verdict["bad.net"] == "block" and verdict["h1.good.net"] == "allow"
    by_id = {r["page_id"]: r for r in got.collect()}
    assert (by_id[0]["host"], by_id[0]["path"]) == ("", "")
    assert (by_id[5]["rule"], by_id[5]["verdict"]) == ("example.org/es/", "block")
    assert (by_id[4]["host"], by_id[4]["rule"]) == ("a.example.org", None)
    assert by_id[9]["rule"] is None and by_id[13]["rule"] == "org/"


def test_small_hosts_are_shrunk_to_their_domain(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 40}.a.net/") for i in range(2000)] + [(9999, "http://new.a.net/")],
                                  "page_id long, url string")
    out = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(2000)], "page_id long, good int")
    rep = {r["host"]: r["mean"] for r in U.host_reputation(pages, out, ws(spark)).collect()}
    assert abs(rep["new.a.net"] - 0.9) < 0.02


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    out = spark.createDataFrame([], "page_id long, good int")
    assert U.judge_pages(pages, out, ws(spark)).count() == 1
    assert U.judge_pages(pages.where("page_id < 0"), out, ws(spark)).count() == 0


def test_addresses_ports_and_listed_suffixes(spark, tmp_path):
    (tmp_path / "list.txt").write_text("// comment\ncom\nco.uk\n\n*.ck\nK12.ma.us // schools\nco.uk\n")
    listed = U.suffixes_in(spark, str(tmp_path / "list.txt"))
    assert listed == ("co.uk", "k12.ma.us")
    hosts = {"10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]:80": ("[::1]", "[::1]"), "u@x.a.com:1": ("a.com", "com"),
             "x.a.co.uk": ("a.co.uk", "co.uk"), "w.s.k12.ma.us": ("s.k12.ma.us", "k12.ma.us"), "a.ma.us": ("ma.us", "us"),
             "1.2.3": ("2.3", "3"), "": ("", "")}
    from pyspark.sql import functions as F
    name = U.named_host(F.col("h"))
    rows = (spark.createDataFrame([(h,) for h in hosts], "h string")
            .select("h", U.domain_of(name, listed).alias("d"), U.suffix_of(name, listed).alias("s")).collect())
    assert {r["h"]: (r["d"], r["s"]) for r in rows} == hosts
