"""Toxicity by weak supervision.

1. Voters.  Fixed word groups, patterns (shouting, runs of exclamation marks,
   address plus insult) and lexicons mined from the labelled training rows
   (words and word beginnings that toxic rows hold far more often) each vote on
   a document or abstain; the row's own label, where it has one, is one more
   noisy voter.
2. Label model.  A generative model gives every voter its own vote
   probabilities per class, conditioned on the one other voter it depends on
   most (a maximum spanning tree over conditional mutual information), so that
   overlapping lexicons are not counted twice.  Expectation maximisation
   estimates all of it and a posterior label for every sampled row.
3. A linear classifier is trained on the posteriors of all sampled rows,
   unlabelled ones too; it alone scores documents.  It has two parts over one
   intercept: the voters' features with the patterns, and hashed words, word
   beginnings and letter 4-grams of the whole sample.  The second is fitted
   without the first, so that insults which stand beside a voter's word get
   their weight too; its weights are not negative, and an L1 penalty keeps
   features that explain less than ``l1`` toxic rows at zero.

There are as many mined voters as the likelihood-ratio test finds.  One more
voter is learned: the second part fitted to the labels of two thirds of the rows
votes on the others, so that a row whose insults are no voter's is not taken for
clean.

The sample is bounded: about ``per_class`` labelled rows of each class and as
many unlabelled rows, chosen by hash, all from the training fold.  Every
document is scored over its whole text.

Defined cases: null and empty texts score the intercept; rows without label
only enter as unlabelled; null ids belong to the training fold; with no usable
label the fixed voters alone make the posteriors; an empty table gives an empty
result; repeated label rows of an id count as toxic if any is; other columns
are ignored (``drop_toxic`` keeps them).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, bounded_sample_share, held_out, in_share, train_fold

#: General English insults and threats, by group.
SEED_GROUPS = {
    "dumb": ("idiot", "moron", "stupid", "imbecile", "fool", "dumb", "clown"),
    "worth": ("worthless", "pathetic", "loser", "useless", "failure"),
    "filth": ("scum", "trash", "garbage", "filth", "vermin", "disgusting"),
    "hate": ("hate", "kill", "die", "despise"),
}
BEGINNINGS = (3, 4, 5, 6)
PATTERNS = ("shouting", "exclaiming", "addressed")
_WORD = re.compile(r"[^\W\d_]+")
_ADDRESS = re.compile(r"\byou(?:'re| are|r)?(?: an?| such an?)? ")
PIECE = 1 << 20
CACHE = 400_000


@dataclass(frozen=True)
class WeakSupervision:
    per_class: int = 1500
    min_support: int = 3
    min_lift: float = 8.0
    min_ratio: float = 12.0
    em_rounds: int = 30
    l2: float = 0.02
    fit_steps: int = 1000
    slots: int = 1 << 18
    l1: float = 0.5
    wide_steps: int = 200
    threshold: float = 0.7


@dataclass
class Model:
    weights: dict = field(default_factory=dict)
    slots: int = 1 << 18
    patterns: tuple = (0.0,) * len(PATTERNS)
    bias: float = 0.0


# ---- features --------------------------------------------------------------


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case letter runs of the whole text."""
    found: set[str] = set()
    at, text = 0, (text or "").lower()
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        found.update(_WORD.findall(text, at, min(end, len(text))))
        at = end
    return found


def features_of(word: str) -> list[str]:
    """The word, its beginnings (``^``) and its seed group (``@``)."""
    own = [word] + ["^" + word[:k] for k in BEGINNINGS if len(word) >= k]
    return own + ["@" + g for g, words in SEED_GROUPS.items() if word in words]


def slots_of(word: str, slots: int) -> list[int]:
    """Hashed word, word beginnings and letter 4-grams."""
    own = features_of(word) + ["~" + word[i:i + 4] for i in range(len(word) - 3)]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % slots for x in own]


def patterns_of(text: str | None) -> tuple[int, ...]:
    t = text or ""
    b = np.frombuffer(t.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    upper, lower = int(((b >= 65) & (b <= 90)).sum()), int(((b >= 97) & (b <= 122)).sum())
    return (int(upper >= 20 and upper > lower), int(t.count("!!") >= 3),
            int(bool(_ADDRESS.search(t.lower())) if "you" in t or "You" in t or "YOU" in t else 0))


# ---- bounded training sample -----------------------------------------------


def training_sample(docs: DataFrame, labels: DataFrame, ws: Workspace, cfg: WeakSupervision) -> DataFrame:
    """(text, y, weight): y is null for unlabelled rows; weight undoes the sampling."""
    lab = ws.table(labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                                & train_fold(F.col("doc_id")))
                   .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")), "labels")
    n = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {y: bounded_sample_share(n.get(y, 0), cfg.per_class) for y in (0, 1)}
    share = F.when(F.col("y") == 1, F.lit(shares[1])).otherwise(F.lit(shares[0]))
    picked = lab.where(in_share(F.col("doc_id"), share)).withColumn("__picked", F.lit(1))
    free_share = bounded_sample_share(docs.count(), cfg.per_class)
    known = lab.select("doc_id").withColumn("__known", F.lit(1))
    fold = docs.select("doc_id", "text").where(train_fold(F.col("doc_id")))
    free = (fold.where(in_share(F.coalesce(F.col("doc_id").cast("string"), F.col("text")),
                                F.lit(free_share), seed=23))
            .join(known, "doc_id", "left_anti")
            .select("text", F.lit(None).cast("int").alias("y"), F.lit(1.0 / free_share).alias("weight")))
    # ``picked`` holds about 2 * per_class ids
    given = (fold.join(F.broadcast(picked), "doc_id")
             .select("text", "y", (1.0 / share).alias("weight")))
    return ws.table(given.union(free), "sample")


def feature_counts(sample: DataFrame, ws: Workspace) -> DataFrame:
    """(feature, n_pos, n_neg) over the labelled sample rows."""

    def counted(frames):
        pos, neg = Counter(), Counter()
        for f in frames:
            for text, y in zip(f["text"], f["y"]):
                own = {x for w in words_of(text) for x in features_of(w)}
                (pos if y == 1 else neg).update(own)
        names = list(pos.keys() | neg.keys())
        for i in range(0, len(names), 50_000):
            part = names[i:i + 50_000]
            yield pd.DataFrame({"feature": part, "p": [pos[x] for x in part], "n": [neg[x] for x in part]})

    return ws.table(
        sample.where("y IS NOT NULL").select("text", "y").mapInPandas(counted, "feature string, p long, n long")
        .groupBy("feature").agg(F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg")), "feature_counts")


def mined_features(counts: DataFrame, n_pos: int, n_neg: int, cfg: WeakSupervision) -> list[str]:
    """Features that toxic rows hold at least ``min_lift`` times as often, by likelihood ratio."""
    a, b = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    share = n_pos / (n_pos + n_neg)
    lift = ((a + 0.5) / (n_pos + 1.0)) / ((b + 0.5) / (n_neg + 1.0))
    ratio = 2.0 * (a * F.log(a / ((a + b) * share))
                   + F.when(b > 0, b * F.log(b / ((a + b) * (1.0 - share) + 1e-9))).otherwise(0.0))
    top = (counts.where((F.col("n_pos") >= cfg.min_support) & (lift >= cfg.min_lift)
                         & ~F.col("feature").startswith("@"))
           .select("feature", ratio.alias("ratio")).where(F.col("ratio") >= cfg.min_ratio)
           .orderBy(F.desc("ratio"), "feature"))
    return [r["feature"] for r in top.collect()]


def design(sample: DataFrame, names: list[str], cfg: WeakSupervision) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
    """(binary feature matrix with patterns last, hashed features of every row, labels with -1 for
    none, weights) of the sample."""
    column = {x: i for i, x in enumerate(names)}
    slots = cfg.slots

    def rows(frames):
        for f in frames:
            words = [words_of(t) for t in f["text"]]
            ids = [sorted({column[x] for w in ws for x in features_of(w) if x in column}) for ws in words]
            wide = [np.array(sorted({x for w in ws for x in slots_of(w, slots)}), dtype="<i4").tobytes()
                    for ws in words]
            yield pd.DataFrame({"ids": ids, "pat": [list(patterns_of(t)) for t in f["text"]], "wide": wide,
                                "y": f["y"].fillna(-1).astype("int32"), "weight": f["weight"]})

    got = sample.mapInPandas(rows, "ids array<int>, pat array<int>, wide binary, y int, weight double").collect()
    x = np.zeros((len(got), len(names) + len(PATTERNS)), dtype=np.uint8)
    for i, r in enumerate(got):
        x[i, r["ids"]] = 1
        x[i, len(names):] = r["pat"]
    return (x, [np.frombuffer(r["wide"], dtype="<i4") for r in got], np.array([r["y"] for r in got], dtype=np.int64),
            np.array([r["weight"] for r in got], dtype=np.float64))


def covering_features(x: np.ndarray, y: np.ndarray, names: list[str], cfg: WeakSupervision) -> list[str]:
    """The mined lexicons that become voters: again and again the feature that explains the
    toxic rows not yet covered best.  Words that only accompany a covered insult (all the
    words of a document copied many times) gain nothing and stay out."""
    neg = x[y == 0][:, :len(names)].sum(axis=0, dtype=np.int64).astype(float)
    open_rows = x[y == 1][:, :len(names)]
    pos = open_rows.sum(axis=0, dtype=np.int64).astype(float)
    n_neg, n_pos, chosen = float((y == 0).sum()), float((y == 1).sum()), []
    while len(open_rows):
        share = n_pos / (n_pos + n_neg)
        ratio = 2 * (pos * np.log(np.maximum(pos, 1e-9) / np.maximum((pos + neg) * share, 1e-9))
                     + neg * np.log(np.maximum(neg, 1e-9) / np.maximum((pos + neg) * (1 - share), 1e-9)))
        lift = ((pos + 0.5) / (n_pos + 1)) / ((neg + 0.5) / (n_neg + 1))
        ratio[(pos < cfg.min_support) | (lift < cfg.min_lift)] = 0
        if not len(ratio) or ratio.max() < cfg.min_ratio:
            break
        best = max(np.flatnonzero(ratio >= ratio.max() - 1e-9), key=lambda i: (len(names[i]), names[i]))
        chosen.append(names[best])
        covered = open_rows[:, best] > 0
        pos = pos - open_rows[covered].sum(axis=0, dtype=np.int64)
        open_rows = open_rows[~covered]
    return chosen


# ---- generative label model --------------------------------------------------

ABSTAIN, CLEAN, TOXIC = 0, 1, 2


def votes(x: np.ndarray, y: np.ndarray, names: list[str], mined: list[str], learned: np.ndarray) -> np.ndarray:
    """Vote matrix; the label voter is the first column; ``learned`` rows have the learned voter's vote."""
    column = {n: i for i, n in enumerate(names)}
    cols = [np.where(y < 0, ABSTAIN, np.where(y == 1, TOXIC, CLEAN))]
    cols += [np.where(x[:, column["@" + g]] > 0, TOXIC, ABSTAIN) for g in SEED_GROUPS]
    cols += [np.where(x[:, column[m]] > 0, TOXIC, ABSTAIN) for m in mined]
    cols.append(np.where(learned, TOXIC, ABSTAIN))
    cols += [np.where(x[:, len(names) + k] > 0, TOXIC, ABSTAIN) for k in range(len(PATTERNS))]
    lexicon = np.stack(cols[1:-len(PATTERNS)], axis=1)
    cols.append(np.where((lexicon == ABSTAIN).all(axis=1), CLEAN, ABSTAIN))
    return np.stack(cols, axis=1).astype(np.int64)


def label_model(v: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of toxic per row, parent of every voter or -1) by EM with a dependency tree."""
    n, m = v.shape
    onehot = np.zeros((n, m, 3))
    onehot[np.arange(n)[:, None], np.arange(m)[None, :], v] = 1
    toxic, clean = (v[:, 1:] == TOXIC).sum(axis=1), (v[:, 1:] == CLEAN).sum(axis=1)
    q = np.where(v[:, 0] == TOXIC, 0.9, np.where(v[:, 0] == CLEAN, 0.05, (toxic + 0.25) / (toxic + clean + 1.0)))
    scaled = weight / max(weight.sum(), 1e-9) * n
    parent = _tree(onehot, np.stack([scaled, np.zeros(n)]))  # copies of a voter hang together from the start
    toxic, clean = (v[:, 1:] == TOXIC).sum(axis=1), (v[:, 1:] == CLEAN).sum(axis=1)
    q = np.where(v[:, 0] == TOXIC, 0.9, np.where(v[:, 0] == CLEAN, 0.05, (toxic + 0.25) / (toxic + clean + 1.0)))
    scaled = weight / max(weight.sum(), 1e-9) * n
    parent = _tree(onehot, np.stack([scaled, np.zeros(n)]))  # copies of a voter hang together from the start
    # before any row is seen every voter is taken to be better than chance, the label voter most
    first = np.full((2, 3), 0.5)
    first[0, CLEAN] += 0.05 * n
    first[1, TOXIC] += 0.05 * n
    # before any row is seen a voter votes as often in either class, and rather rightly: a tenth
    # of the rows' weight says so (abstaining tells nothing), for the label voter half of it
    lean = np.array([[1.0, 1.6, 0.4], [1.0, 0.4, 1.6]])
    rates = np.einsum("n,njk->jk", scaled, onehot) / n
    share = float((q * scaled).sum() / n)
    for step in range(rounds):
        w = np.stack([(1 - q) * weight, q * weight])
        w = w / max(w.sum(), 1e-9) * n
        prior = (w.sum(axis=1) / n + 0.1 * np.array([1 - share, share])) / 1.1
        if step == rounds // 2:
            parent = _tree(onehot, w)
        log = np.log(prior)[None, :].repeat(n, axis=0)
        for j in range(m):
            p = parent[j]
            if p < 0:
                t = np.einsum("cn,nk->ck", w, onehot[:, j])
                t += (0.5 if j == 0 else 0.1) * n / 2 * lean * rates[j] + 0.01
                t /= t.sum(axis=1, keepdims=True)
                log += np.log(t)[:, v[:, j]].T
            else:
                t = np.einsum("cn,nk,nl->clk", w, onehot[:, j], onehot[:, p], optimize=True) + 0.5
                t /= t.sum(axis=2, keepdims=True)
                log += np.log(t)[:, v[:, p], v[:, j]].T
        log -= log.max(axis=1, keepdims=True)
        e = np.exp(log)
        q = e[:, 1] / e.sum(axis=1)
    return q, parent


def _tree(onehot: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Maximum spanning forest over the voters' mutual information given the class;
    the label voter stays independent, links under one hundredth of a bit are left out."""
    n, m, _ = onehot.shape
    flat = onehot.reshape(n, m * 3)
    cmi = np.zeros((m, m))
    for c in range(2):
        joint = ((flat * w[c][:, None]).T @ flat).reshape(m, 3, m, 3).transpose(0, 2, 1, 3) + 1e-3
        share = joint.sum(axis=(2, 3), keepdims=True)
        joint = joint / share
        cmi += (w[c].sum() / max(w.sum(), 1e-9)) * (joint * np.log2(
            joint / (joint.sum(axis=3, keepdims=True) * joint.sum(axis=2, keepdims=True)))).sum(axis=(2, 3))
    parent, inside = np.full(m, -1), np.zeros(m, dtype=bool)
    best, to = np.full(m, -1.0), np.full(m, -1)
    for _ in range(m - 1):
        j = 1 + int(np.argmax(np.where(inside[1:], -2.0, best[1:])))
        inside[j] = True
        parent[j] = to[j] if best[j] > 0.01 else -1
        closer = (cmi[j] > best) & ~inside
        best[closer], to[closer] = cmi[j][closer], j
    return parent


# ---- linear classifier -------------------------------------------------------


def fit_linear(x: np.ndarray, q: np.ndarray, weight: np.ndarray, cfg: WeakSupervision) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels (Adam, L2); the intercept is not penalised."""
    if not len(x):
        return np.zeros(x.shape[1]), -2.0
    scale = len(x)
    wt = weight / weight.sum() * scale
    w, b = np.zeros(x.shape[1]), float(np.log((q * wt).sum() + 1) - np.log(((1 - q) * wt).sum() + 1))
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, cfg.fit_steps + 1):
        z = (x @ w.astype(np.float32)).astype(np.float64) + b
        err = wt * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - q)
        gw = ((err.astype(np.float32) @ x).astype(np.float64) + cfg.l2 * w) / scale
        gb = err.sum() / scale
        mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.1 * (1 - t / (cfg.fit_steps + 1))
        w -= rate * (mw / (1 - 0.9 ** t)) / (np.sqrt(vw / (1 - 0.999 ** t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    return w, float(b)


def fit_wide(wide: list, b: float, q: np.ndarray, weight: np.ndarray, cfg: WeakSupervision) -> dict:
    """Weights of the hashed features that speak for toxic, over the intercept ``b``: logistic
    regression on soft labels by AdaGrad steps with an L1 penalty."""
    n = len(wide)
    wt = weight / weight.sum() * n
    penalty = cfg.l1 * float((wt * q).sum() / max(q.sum(), 1e-9))
    used, what = np.unique(np.concatenate(wide), return_inverse=True)
    who = np.repeat(np.arange(n), [len(o) for o in wide])
    w, gw = np.zeros(len(used)), np.full(len(used), 1e-8)
    for _ in range(cfg.wide_steps):
        z = b + np.bincount(who, weights=w[what], minlength=n)
        err = wt * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - q)
        g = np.bincount(what, weights=err[who], minlength=len(used))
        gw += g * g
        rate = 0.3 / np.sqrt(gw)
        w = np.maximum(w - rate * (g + penalty), 0.0)
    return {int(k): float(c) for k, c in zip(used, w) if c}


def learned_votes(wide: list, y: np.ndarray, weight: np.ndarray, cfg: WeakSupervision) -> np.ndarray:
    """Rows that the hashed features call toxic, each judged by a fit to the labels of other rows."""
    out = np.zeros(len(y), dtype=bool)
    fold = np.array([zlib.crc32(w.tobytes()) % 3 for w in wide])  # equal texts are in one fold
    for k in range(3):
        own = np.flatnonzero((y >= 0) & (fold != k))
        if not (y[own] == 1).any():
            continue
        share = weight[own][y[own] == 1].sum() / weight[own].sum()
        b = float(min(-1.0, np.log(share / max(1 - share, 1e-9))))
        w = fit_wide([wide[i] for i in own], b, np.where(y[own] == 1, 0.95, 0.05), weight[own], cfg)
        for i in np.flatnonzero(fold == k):
            z = b + sum(w.get(int(f), 0.0) for f in wide[i])
            out[i] = z >= 0
    return out


def train(docs: DataFrame, labels: DataFrame, ws: Workspace, cfg: WeakSupervision = WeakSupervision()) -> Model:
    sample = training_sample(docs, labels, ws, cfg)
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    mined = (mined_features(feature_counts(sample, ws), n[1], n.get(0, 0), cfg) if n.get(1) else [])
    seeds = ["@" + g for g in SEED_GROUPS]
    names = list(dict.fromkeys(seeds + mined))
    x, wide, y, weight = design(sample, names, cfg)
    if not len(x):
        return Model()
    column = {f: i for i, f in enumerate(names)}
    candidates = [column[f] for f in mined]
    chosen = covering_features(x[:, candidates], y, mined, cfg) if mined else []
    names = list(dict.fromkeys(seeds + chosen))
    x = np.concatenate([x[:, [column[f] for f in names]], x[:, len(column):]], axis=1)
    if (y >= 0).any():  # an unlabelled row says no more than a labelled one
        weight = np.where(y < 0, weight[y >= 0].mean(), weight)
    v = votes(x, y, names, chosen, learned_votes(wide, y, weight, cfg))
    q, _ = label_model(v, weight, cfg.em_rounds)
    x = x.astype(np.float32)
    w, b = fit_linear(x, q, weight, cfg)
    weights = {f: float(c) for f, c in zip(names, w)} | fit_wide(wide, b, q, weight, cfg)
    return Model(weights, cfg.slots, tuple(float(c) for c in w[len(names):]), b)


def score_texts(texts, model: Model, cache: dict) -> np.ndarray:
    """Scores of texts; ``cache`` maps words to the model features they hold."""
    weights, out = model.weights, np.empty(len(texts))
    for i, text in enumerate(texts):
        hit: set = set()
        for w in words_of(text):
            own = cache.get(w)
            if own is None:
                if len(cache) >= CACHE:
                    cache.clear()
                own = cache[w] = tuple(
                    f for f in (*features_of(w), *slots_of(w, model.slots)) if f in weights)
            if own:
                hit.update(own)
        s = model.bias + sum(sorted(weights[f] for f in hit))
        s += sum(c * p for c, p in zip(model.patterns, patterns_of(text)))
        out[i] = 1.0 / (1.0 + np.exp(-np.clip(s, -30, 30)))
    return out


def score(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict = {}
        for texts in batches:
            yield pd.Series(score_texts(texts.tolist(), model, cache))

    return scored(text)


def toxicity(docs: DataFrame, labels: DataFrame, ws: Workspace,
             cfg: WeakSupervision = WeakSupervision()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, ws, cfg)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cfg.threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, ws: Workspace,
               cfg: WeakSupervision = WeakSupervision()) -> DataFrame:
    """The documents that score under the threshold, all columns kept."""
    model = train(docs, labels, ws, cfg)
    return docs.where(score(docs["text"], model) < cfg.threshold)
