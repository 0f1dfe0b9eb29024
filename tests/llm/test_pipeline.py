import pytest

import corpus_pipeline as P
from skyfare.llm import toxicity as T
from skyfare.llm import mixing
from skyfare.llm.common import read
from skyfare.llm.queries import word_bpe

from .helpers import SF_SMALL, SF_TINY, clashing, ws
from .test_packing import expected
from .test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the documents at sf0.01."""
    docs, out, w = read(spark, SF_SMALL, "documents"), [], ws(spark)
    for i, (name, stage) in enumerate(P.STAGES):
        result = w.table(stage(spark, docs, SF_SMALL), f"s{i}")
        out.append((name, docs, result))
        docs = result
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stage_order_and_columns(spark, stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
    columns = read(spark, SF_SMALL, "documents").columns
    assert all(out.columns == columns for _, _, out in stages[:-1])


def test_toxicity_stage(spark, stages):
    _, docs, out = stages[0]
    scored = T.toxicity(docs, read(spark, SF_SMALL, "labels"), ws(spark))
    assert ids(out) == ids(scored.where("predicted = 0"))
    assert len(ids(out)) < len(ids(docs))


def test_near_duplicate_stage_keeps_the_smallest_of_each_group(stages):
    _, docs, out = stages[1]
    items = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    by = {}
    for i, f in items:
        by.setdefault(f, []).append(i)
    comp = plain_components([(min(v), f) for f, v in by.items()])
    assert ids(out) == sorted(set(comp.values()))


def test_decontamination_stage(spark, stages):
    """Documents that hold a whole benchmark item word by word go; all without a shared run of 8 words stay."""
    import re
    _, docs, out = stages[2]
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [split(r["text"]) for r in read(spark, SF_SMALL, "benchmark").collect()]
    runs = {tuple(w[i:i + 8]) for w in items for i in range(len(w) - 7)}
    kept = set(ids(out))
    for r in docs.collect():
        w = split(r["text"])
        text = " " + " ".join(w) + " "
        if any(f" {' '.join(it)} " in text for it in items):
            assert r["doc_id"] not in kept
        elif runs.isdisjoint(tuple(w[i:i + 8]) for i in range(len(w) - 7)):
            assert r["doc_id"] in kept


def test_mixing_stage(spark, stages):
    _, docs, out = stages[3]
    picked = mixing.mix(docs, ws(spark), mixing.Mix(max_epochs=1))
    assert ids(out) == ids(picked) and 0 < len(ids(out)) < len(ids(docs))


def test_token_stage(stages):
    from tokenizers import Tokenizer
    _, docs, out = stages[4]
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert [tuple(r) for r in out.orderBy("start").collect()] == expected(Tokenizer.from_file(word_bpe()), rows)


def test_run_and_edges(spark):
    assert P.run(spark, SF_TINY).count() > 0
    docs = read(spark, SF_TINY, "documents")
    odd = clashing(docs.limit(20).unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (5000, "", "en", None, 0), (5000, "", "en", None, 0)], docs.schema)))
    for data in (odd, docs.where("doc_id < 0")):
        for name, stage in P.STAGES:
            result = stage(spark, data, SF_TINY)
            assert result.count() <= data.count()
            if name != "token_output":
                assert result.columns == data.columns
