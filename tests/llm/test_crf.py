import numpy as np
import pytest

from skyfare.llm import crf
from skyfare.llm.queries import QUERIES

from .helpers import SF_SMALL, clashing, documents


def chain_posteriors(prob, t):
    """Plain forward-backward over one chain."""
    m = prob.shape[1]
    a, alphas = np.full(m, 1.0 / m), []
    for p in prob:
        a = (a @ t) * p
        a /= a.sum()
        alphas.append(a)
    b, out = np.ones(m), np.zeros((len(prob), m))
    for i in range(len(prob) - 1, -1, -1):
        g = alphas[i] * b
        out[i] = g / g.sum()
        b = t @ (prob[i] * b)
        b /= b.sum()
    return out


def test_chunked_inference_is_exact():
    rng = np.random.default_rng(2)
    prob, t = rng.random((500, 3)) ** 4 + 1e-9, rng.random((3, 3)) ** 3 + 1e-6
    sizes = np.array([1, 64, 65, 7, 128, 1000, 3])
    ids = rng.integers(0, 500, sizes.sum())
    got, at = crf.label_sums(ids, sizes, prob, t), 0
    for k, n in enumerate(sizes):
        assert np.allclose(got[k], chain_posteriors(prob[ids[at:at + n]], t).sum(axis=0), atol=1e-9)
        at += n


def test_training_posteriors_are_exact():
    rng = np.random.default_rng(3)
    p, t, size = rng.random((9, 3, 4)) + 1e-3, rng.random((4, 4)) + 1e-3, np.array([9, 5, 1])
    gamma, pairs = crf._posteriors(p, size, t)
    for k, n in enumerate(size):
        assert np.allclose(gamma[:n, k], chain_posteriors(p[:n, k], t))
    assert pairs.sum() == pytest.approx((size - 1).sum())


def test_held_out_accuracy(spark):
    got = QUERIES["op1_language_id"](spark, SF_SMALL)
    lang = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(lang, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def train_rows():
    en, fr = "the house and this water is with that", "la maison et cette eau est avec leur"
    return [(i, " ".join([en, fr][i % 2].split()[k:] + [en, fr][i % 2].split()[:k])[:200], ["en", "fr"][i % 2])
            for i in range(120) for k in [i % 7]]


def test_switched_words_get_their_own_labels():
    rows = [(lang, text.split()) for _, text, lang in train_rows()]
    model = crf.fit(rows, crf.CRFConfig())
    words = "the house and this water la maison et cette eau".split()
    e = crf.emissions(words, model)
    post = chain_posteriors(np.exp(e - e.max(axis=1, keepdims=True)), np.exp(model.trans))
    assert [model.langs[i] for i in post.argmax(axis=1)] == ["en"] * 5 + ["fr"] * 5
    assert model.trans[0, 0] > model.trans[0, 1]


def test_edges(spark):
    rows = train_rows() + [(900, None, "en"), (901, "", "fr"), (902, "123 !!! 4", "en"), (None, "the house", None),
                           (903, "la maison " * 30_000, None), (903, "la maison " * 30_000, None), (904, "x" * 50_000, "en")]
    d = clashing(documents(spark, [(*r, "s") for r in rows]))
    got = [tuple(r) for r in crf.identify(d).select("doc_id", "lang_pred", "score").collect()]
    assert len(got) == len(rows)
    by = {r[0]: r for r in got}
    assert all(by[k][1:] == ("und", 0.0) for k in (900, 901, 902))
    assert by[903][1] == "fr" and by[None][1] == "en" and got.count(by[903]) == 2
    unlabelled = d.withColumn("lang", d["lang"].substr(9, 1).cast("string")).selectExpr("*").drop("lang")
    import pyspark.sql.functions as F
    none = unlabelled.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in crf.identify(none).collect()} == {"und"}
    assert crf.identify(d.where("doc_id < 0")).count() == 0


def test_only_the_training_fold_is_learned_from(spark):
    import zlib
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1][:40]
    d = documents(spark, train_rows()[:0] + [(i, "zz yy xx", "xx") for i in held] +
                  [(r[0] + 1000, r[1], r[2]) for r in train_rows()])
    assert "xx" not in {r["lang_pred"] for r in crf.identify(d).collect()}


def test_number_signs_are_no_letters(spark):
    assert crf.words_of("½ ² Ⅷ ① ٣ 3 _ x² été①b") == ["x", "été", "b"]
    d = documents(spark, [(*r, "s") for r in train_rows()] + [(900 + i, t, None) for i, t in enumerate(["½ ²", "Ⅷ", "①", "½ the house"])])
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in crf.identify(d).where("doc_id >= 900").collect()}
    assert all(by[k] == ("und", 0.0) for k in (900, 901, 902)) and by[903][0] == "en"


def test_words_met_in_several_runs_keep_their_scores():
    """A grown and a cleared cache give what a fresh one gives."""
    rows = [(lang, text.split()) for _, text, lang in train_rows()]
    model = crf.fit(rows, crf.CRFConfig())
    texts = [" ".join(f"{w}{chr(97 + i % 26)}{chr(97 + j)}" for j, w in enumerate("the maison eau with".split())) for i in range(400)]
    used = crf.Labeller(model)
    parts = [used.sums(texts[i:i + 7])[0] for i in range(0, len(texts), 7)]
    assert np.allclose(np.concatenate(parts), crf.Labeller(model).sums(texts)[0])
