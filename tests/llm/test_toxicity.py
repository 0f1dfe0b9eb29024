import numpy as np
from pyspark.sql import functions as F

from skyfare.llm import toxicity as T
from skyfare.llm.queries import QUERIES

from .helpers import SF_SMALL, clashing, documents, ws


def test_held_out_documents(spark):
    got = QUERIES["op9_toxicity"](spark, SF_SMALL)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.7 * len(toxic)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.01 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_label_model_estimates_voters_and_ties():
    """Three voters of known accuracy; a copy of one must not count as a further voter."""
    rng = np.random.default_rng(1)
    n = 4000
    y = rng.random(n) < 0.3
    def voter(acc):
        right = rng.random(n) < acc
        return np.where(right == y, T.TOXIC, T.CLEAN)
    weak = voter(0.65)
    seen = np.where(rng.random(n) < 0.1, np.where(y, T.TOXIC, T.CLEAN), T.ABSTAIN)
    v = np.stack([seen, voter(0.9), voter(0.85), weak, weak, weak], axis=1)
    q, parent = T.label_model(v, np.ones(n), 30)
    assert ((q > 0.5) == y).mean() > 0.9
    assert sum(parent[k] >= 3 for k in (3, 4, 5)) >= 2  # the copies hang together


def test_edges(spark):
    mean = "you are an idiot and a moron"
    rows = [(i, f"a plain text number {i} about {'cats' if i % 2 else 'dogs'}") for i in range(200)]
    rows += [(i, f"text {i} {mean}") for i in range(200, 260)]
    rows += [(900, None), (901, ""), (None, mean), (902, "fine " * 60_000), (903, "fine " * 60_000 + mean),
             (903, "fine " * 60_000 + mean)]
    d = clashing(documents(spark, rows))
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(0, 260, 2)] + [(None, 1), (5, None), (6, 0), (6, 0)],
                                   "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in T.toxicity(d, labels, ws(spark)).collect()}
    assert [got[k]["predicted"] for k in (900, 901, None, 902, 903, 1, 201)] == [0, 0, 1, 0, 1, 0, 1]
    kept = T.drop_toxic(d, labels, ws(spark))
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {*range(200), 900, 901, 902}
    none = labels.where(F.col("doc_id") < 0)
    alone = {r["doc_id"]: r["score"] for r in T.toxicity(d, none, ws(spark)).collect()}
    assert alone[201] > alone[1]
    assert T.toxicity(d.where("doc_id < 0"), labels, ws(spark)).count() == 0


def test_wide_vocabulary_outside_the_seeds(spark):
    """Several hundred insults that no seed group knows are learned from the labels."""
    rng = np.random.default_rng(3)
    def word():
        return "".join(rng.choice(list("bcdfghjklmnprstvwz")) + rng.choice(list("aeiou")) for _ in range(4))
    vocabulary = [word() for _ in range(1300)]
    insults, plain = vocabulary[:300], vocabulary[300:]
    rows = []
    for i in range(5000):
        text = list(rng.choice(plain, 20)) + (list(rng.choice(insults, 3)) if i % 3 == 0 else [])
        rows.append((i, " ".join(rng.permutation(text))))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(5000)], "doc_id long, toxic int")
    got = T.toxicity(documents(spark, rows), labels, ws(spark)).where("held_out").collect()
    toxic = [r["predicted"] for r in got if r["doc_id"] % 3 == 0]
    clean = [r["predicted"] for r in got if r["doc_id"] % 3]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean), (sum(toxic), len(toxic), sum(clean))
