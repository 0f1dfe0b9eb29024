"""Language identification with a linear-chain conditional random field.

The words of a text (letter runs, lower case) form a chain; each gets a
language label.  Word scores come from affixes (1 to 4 characters), character
bigrams and trigrams with word boundaries, and lexicons (the most frequent
words of each language in the sample); label-to-label transitions are learned,
so a switched passage keeps its own labels and a single shared word does not.
Forward-backward gives every word its label probabilities; a document's score
per language is their mean, the prediction the best.

Training: from documents with a language outside the held-out fold, about
``per_language`` of each language chosen by hash give ``windows`` word windows
spread over the whole text; shuffled windows of different documents are chained
to code-switched sequences, and penalised log-likelihood is climbed with Adam.

Inference is exact at any length: a text is cut into chunks, chunk transfer
matrices carry the messages across, and all chunks of a batch run side by side.

Defined cases: null text and text without a letter: 'und', score 0; no usable
label at all: every text is 'und', score 0; rows that repeat are predicted
alike; ties go to the first language in order; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbered, bounded_sample_share, held_out, in_share, train_fold



def _numbers() -> str:
    """Signs that count as word characters but are no letters (fractions, raised digits,
    Roman numerals, circled numbers), as ranges of a character class."""
    odd = [i for i in range(sys.maxunicode + 1) if chr(i).isalnum() and not chr(i).isalpha()]
    runs: list[list[int]] = []
    for i in odd:
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


_WORD = re.compile(rf"[^\W\d_{_numbers()}]+")
PIECE = 1 << 20
AT_ONCE = 50_000     # new words scored together
CHUNK = 64
CHUNKS_AT_ONCE = 8192
CACHE = 400_000


@dataclass(frozen=True)
class CRFConfig:
    per_language: int = 400
    windows: int = 6
    window_words: int = 12
    chain: int = 4
    lexicon: int = 150
    slots: int = 1 << 16
    l2: float = 0.5
    steps: int = 60
    seed: int = 5


@dataclass
class Model:
    langs: list
    weights: np.ndarray   # slots x languages
    trans: np.ndarray     # languages x languages, log scale
    lexicon: dict         # word -> bit set of languages


def words_of(text: str | None) -> list[str]:
    """Lower-case letter runs of the whole text, in order."""
    found: list[str] = []
    at, text = 0, (text or "").lower()
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        found += _WORD.findall(text, at, min(end, len(text)))
        at = end
    return found


# ---- features ----------------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slot(kind: int, parts: list[np.ndarray], slots: int) -> np.ndarray:
    """Hashed feature numbers of code-point tuples."""
    h = np.full(len(parts[0]), kind + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p.astype(np.uint64)) * _MIX
            h ^= h >> np.uint64(29)
    return (h >> np.uint64(20)).astype(np.int64) % slots


def word_features(words: list[str], lexicon: dict, n_langs: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature number) of every feature of every word."""
    n = len(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n) + 2
    c = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    start = np.cumsum(size) - size
    of = np.repeat(np.arange(n), size)
    left = np.repeat(start + size, size) - np.arange(len(c))  # characters from here to the word's end
    who, what = [], []
    for k in (2, 3):
        at = np.flatnonzero(left >= k)
        who.append(of[at])
        what.append(_slot(k, [c[at + j] for j in range(k)], slots))
    for k in range(1, 5):
        own = np.flatnonzero(size - 2 >= k)
        first, last = start[own] + 1, start[own] + size[own] - 2
        who += [own, own]
        what.append(_slot(10 + k, [c[first + j] for j in range(k)], slots))
        what.append(_slot(20 + k, [c[last - j] for j in range(k)], slots))
    known = [(i, lang) for i, w in enumerate(words) if w in lexicon
             for lang in range(n_langs) if lexicon[w] >> lang & 1]
    if known:
        pairs = np.array(known, dtype=np.int64)
        who.append(pairs[:, 0])
        what.append(_slot(30, [pairs[:, 1]], slots))
    return np.concatenate(who), np.concatenate(what)


def emissions(words: list[str], model: Model) -> np.ndarray:
    """Log scores, words x languages."""
    who, what = word_features(words, model.lexicon, len(model.langs), len(model.weights))
    return np.stack([np.bincount(who, weights=model.weights[what, k], minlength=len(words))
                     for k in range(len(model.langs))], axis=1)


# ---- training ------------------------------------------------------------------


def training_windows(docs: DataFrame, cfg: CRFConfig) -> list[tuple[str, list[str]]]:
    """(language, words) windows of the bounded sample, in a fixed order."""
    fold = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & train_fold(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in fold.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(bounded_sample_share(n, cfg.per_language))).otherwise(share)
    row = F.coalesce(F.col("doc_id").cast("string"), F.col("text"))
    picked = fold.where(in_share(row, share, seed=31)).select("text", "lang")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            langs, out = [], []
            for text, lang in zip(f["text"], f["lang"]):
                w = words_of(text)
                starts = np.linspace(0, max(len(w) - cfg.window_words, 0), cfg.windows).astype(int)
                for s in sorted(set(starts.tolist())):
                    if w[s:s + cfg.window_words]:
                        langs.append(lang)
                        out.append(" ".join(w[s:s + cfg.window_words]))
            yield pd.DataFrame({"lang": langs, "words": out}, dtype=str)

    rows = picked.mapInPandas(cut, "lang string, words string").collect()
    return sorted((r["lang"], r["words"].split(" ")) for r in rows)


def train(docs: DataFrame, cfg: CRFConfig = CRFConfig()) -> Model | None:
    return fit(training_windows(docs, cfg), cfg)


def fit(windows: list[tuple[str, list[str]]], cfg: CRFConfig) -> Model | None:
    if not windows:
        return None
    langs = sorted({lang for lang, _ in windows})
    number = {lang: i for i, lang in enumerate(langs)}
    lexicon: dict[str, int] = {}
    for lang in langs:
        seen = Counter(w for own, ws in windows if own == lang for w in ws)
        for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:cfg.lexicon]:
            lexicon[w] = lexicon.get(w, 0) | 1 << number[lang]
    rng = np.random.default_rng(cfg.seed)
    order = rng.permutation(len(windows))
    chains = [[(w, number[windows[i][0]]) for i in order[k:k + cfg.chain] for w in windows[i][1]]
              for k in range(0, len(order), cfg.chain)]
    chains.sort(key=len, reverse=True)
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for ch in chains for w, _ in ch))}
    n, longest, m = len(chains), len(chains[0]), len(langs)
    ids, gold = np.zeros((longest, n), dtype=np.int64), np.zeros((longest, n), dtype=np.int64)
    size = np.array([len(ch) for ch in chains])
    for k, ch in enumerate(chains):
        ids[:len(ch), k] = [vocabulary[w] for w, _ in ch]
        gold[:len(ch), k] = [g for _, g in ch]
    who, what = word_features(list(vocabulary), lexicon, m, cfg.slots)
    model = Model(langs, np.zeros((cfg.slots, m)), np.zeros((m, m)), lexicon)
    live = np.arange(longest)[:, None] < size[None, :]
    total = float(size.sum())
    moments = [np.zeros_like(model.weights), np.zeros_like(model.weights),
               np.zeros_like(model.trans), np.zeros_like(model.trans)]
    eye = np.eye(m)
    gold_trans = np.zeros((m, m))
    np.add.at(gold_trans, (gold[:-1][live[1:]], gold[1:][live[1:]]), 1)
    for step in range(1, cfg.steps + 1):
        e = np.stack([np.bincount(who, weights=model.weights[what, k], minlength=len(vocabulary))
                      for k in range(m)], axis=1)
        p = np.exp(e - e.max(axis=1, keepdims=True))[ids]
        gamma, pairs = _posteriors(p, size, np.exp(model.trans))
        diff = (eye[gold] - gamma)[live]
        per_word = np.stack([np.bincount(ids[live], weights=diff[:, k], minlength=len(vocabulary))
                             for k in range(m)], axis=1)
        gw = np.stack([np.bincount(what, weights=per_word[who, k], minlength=cfg.slots) for k in range(m)], axis=1)
        gw, gt = (gw - cfg.l2 * model.weights) / total, (gold_trans - pairs - cfg.l2 * model.trans) / total
        rate = 0.1 * (1 - (step - 1) / cfg.steps)
        for value, grad, a, b in ((model.weights, gw, *moments[:2]), (model.trans, gt, *moments[2:])):
            a *= 0.9
            a += 0.1 * grad
            b *= 0.999
            b += 0.001 * grad * grad
            value += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    model.weights = model.weights.astype(np.float32)
    return model


def _posteriors(p: np.ndarray, size: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities and expected transitions of chains sorted by falling length."""
    longest, n, m = p.shape
    alpha, gamma, pairs = np.zeros_like(p), np.zeros_like(p), np.zeros((m, m))
    before = np.full((n, m), 1.0 / m)
    for i in range(longest):
        k = int((size > i).sum())
        a = (before[:k] @ t) * p[i, :k]
        alpha[i, :k] = before[:k] = a / a.sum(axis=1, keepdims=True)
    beta = np.full((n, m), 1.0)
    for i in range(longest - 1, -1, -1):
        k = int((size > i).sum())
        g = alpha[i, :k] * beta[:k]
        gamma[i, :k] = g / g.sum(axis=1, keepdims=True)
        onward = p[i, :k] * beta[:k]
        if i:
            joint = alpha[i - 1, :k, :, None] * t[None] * onward[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = onward @ t.T
        beta[:k] = b / b.sum(axis=1, keepdims=True)
    return gamma, pairs


# ---- inference ------------------------------------------------------------------


def label_sums(ids: np.ndarray, sizes: np.ndarray, prob: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Summed label probabilities (documents x labels) of word chains laid end to end.

    ``ids`` are rows of ``prob`` (positive word scores), ``sizes`` words per document (all > 0)."""
    m, n_docs = prob.shape[1], len(sizes)
    per_doc = -(-sizes // CHUNK)
    doc = np.repeat(np.arange(n_docs), per_doc)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    start = np.repeat(np.cumsum(sizes) - sizes, per_doc) + nth * CHUNK
    size = np.minimum(CHUNK, np.repeat(sizes, per_doc) - nth * CHUNK)
    enter, leave = np.full((len(doc), m), 1.0 / m), np.ones((len(doc), m))
    several = per_doc > 1
    if several.any():
        cut = several[doc]
        enter[cut], leave[cut] = _messages(ids, start[cut], size[cut], per_doc[several], prob, t)
    out = np.zeros((n_docs, m))
    for low in range(0, len(doc), CHUNKS_AT_ONCE):
        block = np.arange(low, min(low + CHUNKS_AT_ONCE, len(doc)))
        block = block[np.argsort(-size[block], kind="stable")]
        own, longest = size[block], int(size[block[0]])
        live = [int(np.searchsorted(-own, -i, side="left")) for i in range(longest)]  # chunks longer than i
        alpha, a, total = [], enter[block], np.zeros((len(block), m))
        for i in range(longest):
            k = live[i]
            a = (a[:k] @ t) * prob[ids[start[block[:k]] + i]]
            a /= a.sum(axis=1, keepdims=True)
            alpha.append(a)
        b = leave[block]
        for i in range(longest - 1, -1, -1):
            k = live[i]
            g = alpha[i] * b[:k]
            total[:k] += g / g.sum(axis=1, keepdims=True)
            s = (prob[ids[start[block[:k]] + i]] * b[:k]) @ t.T
            b[:k] = s / s.sum(axis=1, keepdims=True)
        np.add.at(out, doc[block], total)
    return out


def _messages(ids, start, size, per_doc, prob, t) -> tuple[np.ndarray, np.ndarray]:
    """Forward messages into and backward messages out of every chunk."""
    m, n = prob.shape[1], len(start)
    matrix = np.zeros((n, m, m))
    for low in range(0, n, CHUNKS_AT_ONCE):
        block = np.arange(low, min(low + CHUNKS_AT_ONCE, n))
        block = block[np.argsort(-size[block], kind="stable")]
        own, x = size[block], np.tile(np.eye(m), (len(block), 1, 1))
        for i in range(int(own[0])):
            k = int(np.searchsorted(-own, -i, side="left"))
            y = (x[:k].reshape(-1, m) @ t).reshape(k, m, m) * prob[ids[start[block[:k]] + i]][:, None, :]
            x[:k] = y / y.sum(axis=(1, 2), keepdims=True)
        matrix[block] = x
    enter, leave = np.full((n, m), 1.0 / m), np.ones((n, m))
    first = np.cumsum(per_doc) - per_doc
    for i in range(int(per_doc.max()) - 1):
        at = first[per_doc > i + 1] + i
        a = np.einsum("nk,nkl->nl", enter[at], matrix[at])
        enter[at + 1] = a / a.sum(axis=1, keepdims=True)
    for i in range(int(per_doc.max()) - 1, 0, -1):
        at = first[per_doc > i] + i
        b = np.einsum("nkl,nl->nk", matrix[at], leave[at])
        leave[at - 1] = b / b.sum(axis=1, keepdims=True)
    return enter, leave


class Labeller:
    """Applies a model; keeps the scores of words it has seen."""

    def __init__(self, model: Model):
        self.model, self.t = model, np.exp(model.trans)
        self._forget()

    def _forget(self) -> None:
        self.known, self.scored = Numbered(), 0
        self.prob = np.zeros((1024, len(self.model.langs)))   # rows of known words first, then room

    def _learn(self, words: list[str]) -> None:
        e = emissions(words, self.model)
        e = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -60.0))
        n = self.scored
        if n + len(words) > len(self.prob):
            self.prob = np.concatenate([self.prob[:n], np.zeros((n + 2 * len(words), e.shape[1]))])
        self.prob[n:n + len(words)] = e
        self.scored += len(words)

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(summed label probabilities, word counts) of texts."""
        if len(self.known) > CACHE:
            self._forget()
        split = [words_of(x) for x in texts]
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        ids = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(sizes.sum()))
        new, self.known.new = self.known.new, []
        for at in range(0, len(new), AT_ONCE):
            self._learn(new[at:at + AT_ONCE])
        out = np.zeros((len(texts), len(self.model.langs)))
        full = sizes > 0
        if full.any():
            out[full] = label_sums(ids, sizes[full], self.prob, self.t)
        return out, sizes


def _runs(texts: list, size: int = 3 << 20) -> Iterator[list]:
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t or "")
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def identify(docs: DataFrame, cfg: CRFConfig = CRFConfig(), model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = model or train(docs, cfg)
    d = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    id_type = d.schema["doc_id"].dataType.simpleString()

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(model) if model else None
        for f in frames:
            pred, score = [], []
            for run in _runs(f["text"].tolist()):
                if labeller is None:
                    pred += ["und"] * len(run)
                    score += [0.0] * len(run)
                    continue
                sums, sizes = labeller.sums(run)
                best = sums.argmax(axis=1)
                mean = sums[np.arange(len(run)), best] / np.maximum(sizes, 1)
                pred += [model.langs[b] if s else "und" for b, s in zip(best, sizes)]
                score += np.clip(mean, 0.0, 1.0).tolist()
            yield pd.DataFrame({"doc_id": f["doc_id"], "held_out": f["held_out"],
                                "lang_pred": pred, "score": score})

    return d.mapInPandas(label, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
