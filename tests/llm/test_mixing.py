from skyfare.llm import mixing
from skyfare.llm.queries import QUERIES, SQL

from .helpers import SF_SMALL, SF_TINY, clashing, documents, oracle_rows, rows_of, same_as_oracle, ws


def test_query_equals_its_sql(spark):
    for folder in (SF_TINY, SF_SMALL):
        same_as_oracle(spark, QUERIES["op5_mix_sources"], SQL["op5_mix_sources"], folder)


def test_edges_equal_the_sql(spark, tmp_path):
    rows = [(i, "w " * (i % 7), ["en", "de", None, "fr"][i % 4], ["src0", "src1", "src10", None, "x"][i % 5])
            for i in range(200)]
    rows += [(3, "w w w", "en", "src0"), (None, "null id words", "en", "src0"), (None, None, "en", "src0"),
             (500, "a b c " * 20_000, "en", "src0"), (501, "", "es", "only-empty"), (7, "w", "de", "src1")]
    clashing(documents(spark, rows)).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_mix_sources"](spark, str(tmp_path))
    cols = sorted(got.columns)
    assert rows_of(got, cols) == oracle_rows(str(tmp_path), SQL["op5_mix_sources"], cols)


def _budgets(spark, leaves, cfg):
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()],
                               "__domain string, __lang string, __source string, supply long")
    return {(r["__domain"], r["__lang"], r["__source"]): r["budget"]
            for r in mixing.leaf_budgets(df, ws(spark), cfg).collect()}


def test_shortage_stays_with_siblings_first(spark):
    """Domain a's short source gives to its sibling; b gets no more than its weight until a is full."""
    cfg = mixing.Mix(budget_share=0.5, max_epochs=1, lang_weights={})
    got = _budgets(spark, {("a", "en", "s1"): 100, ("a", "en", "s2"): 900, ("b", "en", "s3"): 1000}, cfg)
    assert got == {("a", "en", "s1"): 100, ("a", "en", "s2"): 400, ("b", "en", "s3"): 500}
    got = _budgets(spark, {("a", "en", "s1"): 100, ("a", "en", "s2"): 200, ("b", "en", "s3"): 1700}, cfg)
    assert got == {("a", "en", "s1"): 100, ("a", "en", "s2"): 200, ("b", "en", "s3"): 700}


def test_prefix_is_the_longest_that_fits(spark):
    cfg = mixing.Mix(budget_share=0.37, max_epochs=1)
    d = documents(spark, [(i, "w " * (1 + i * 7 % 13)) for i in range(400)])
    got = mixing.mix(d, ws(spark), cfg).collect()
    total = sum(1 + i * 7 % 13 for i in range(400))
    import hashlib
    order = sorted(range(400), key=lambda i: hashlib.md5(f"mix|0|{i}".encode()).hexdigest())
    used, expected = 0, set()
    for i in order:
        if used + 1 + i * 7 % 13 > int(total * 0.37):
            break
        used += 1 + i * 7 % 13
        expected.add(i)
    assert {r["doc_id"] for r in got} == expected


def test_documents_keep_their_columns(spark):
    d = clashing(documents(spark, [(i, "some words " * 5, "en", f"src{i % 3}") for i in range(60)]))
    cfg = mixing.Mix(budget_share=0.5, max_epochs=1)
    kept = mixing.mix_documents(d, ws(spark), cfg)
    assert kept.columns == d.columns
    assert sorted(rows_of(kept, ["doc_id"])) == sorted(rows_of(mixing.mix(d, ws(spark), cfg), ["doc_id"]))
    twice = mixing.mix_documents(d, ws(spark), mixing.Mix(budget_share=1.5, max_epochs=2))
    assert 60 < twice.count() <= 120
    assert mixing.mix_documents(d.where("doc_id < 0"), ws(spark), cfg).count() == 0
    assert mixing.mix(d.where("doc_id < 0"), ws(spark), cfg).count() == 0
