"""Licence scans: a trained paragraph classifier, confirmed by templates.

Paragraphs are runs of lines up to a blank line; how their words are wrapped does
not matter.  A multinomial logistic regression over hashed word 1-, 2- and 3-grams
judges overlapping word windows of every paragraph (``sizes`` words, a third of that
apart, from the paragraph's first word on), so a notice in a long line counts as one
that stands alone.  A window whose family is at least as probable as the calibrated
probability names that family; all others are unknown.  Around the windows that
name it the family's templates are then looked for: a stretch with at most ``slack``
words more than the template must hold at least ``min_template`` of its word pairs,
which confirms the notice and gives its place.  Every family confirmed so is
reported; only a stretch whose word pairs all belong to an overlapping stretch as
well (CC BY within CC BY-NC) says nothing of its own and does not count.

The classifier is trained here on windows over the family templates (cut, thinned
and set between words of the corpus, seeded) against windows of a bounded sample of
the corpus as the unknown class: ``background_docs`` documents by hash, from each
``windows_per_doc`` stretches of ``window_words`` words spread over its whole text.
A second part of both is kept aside to calibrate: a temperature, and the least
probability at which a family is named, so that at most ``max_false`` of the
kept-aside corpus windows are.

Defined cases: null and empty texts hold no licence; repeated rows are judged
alike; equal scores go to the first family in order; an empty table gives an
empty result (and trains on templates alone); null ids are carried through;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbered, bounded_sample_share, in_share

#: Short public notices of each licence family.
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License. You may obtain a copy of the "
               "License at http://www.apache.org/licenses/LICENSE-2.0",
               "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met",
            "Released under the BSD 3-Clause License", "Licensed under the BSD License",
            "SPDX-License-Identifier: BSD-3-Clause"),
    "cc-by": ("Licensed under CC BY 4.0",
              "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc0": ("Released under CC0 1.0 Universal", "dedicated to the public domain under CC0"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-3.0-or-later"),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted", "Licensed under the ISC License"),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License, version 3",
             "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
             "published by the Free Software Foundation"),
    "mit": ("Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", "SPDX-License-Identifier: MIT"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
            "Licensed under the Mozilla Public License, version 2.0"),
}
UNKNOWN = "unknown"
_WORD = re.compile(r"[^\W\d_]+")
CACHE = 400_000      # words


@dataclass(frozen=True)
class LicenceConfig:
    background_docs: int = 400
    windows_per_doc: int = 6
    window_words: int = 60
    sizes: tuple = (6, 12, 24)
    variants: int = 24
    slots: int = 1 << 15
    l2: float = 0.1
    steps: int = 120
    max_false: float = 0.002
    min_template: float = 0.5
    slack: int = 24
    seed: int = 11


def tokens(text: str) -> list[str]:
    """Lower-case words; numbers and punctuation do not matter."""
    return _WORD.findall(text.lower())


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


#: (family, words, word pairs) of every template, the templates of a family and of a word pair.
_TEMPLATE_PAIRS = [(f, len(tokens(t)), _pairs(tokens(t))) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
_HOLDERS: dict = {}
for _k, (_, _, _need) in enumerate(_TEMPLATE_PAIRS):
    for _pair in _need:
        _HOLDERS.setdefault(_pair, []).append(_k)


_OF_FAMILY = {f: [k for k, t in enumerate(_TEMPLATE_PAIRS) if t[0] == f] for f in TEMPLATES}


def stretches(words: list[str], templates: list[int], cfg: LicenceConfig) -> list[tuple[int, float, frozenset]]:
    """(template, share, places of its word pairs) of every stretch that holds enough of a template;
    of those of one template that overlap the fullest, then the shortest, then the first."""
    places: dict[int, list[int]] = {k: [] for k in templates}
    for i, pair in enumerate(zip(words, words[1:])):
        for k in _HOLDERS.get(pair, ()):
            if k in places:
                places[k].append(i)
    out = []
    for k, at in places.items():
        _, size, need = _TEMPLATE_PAIRS[k]
        full = []
        for a, first in enumerate(at):
            seen: dict = {}
            for i in at[a:a + size + cfg.slack]:
                if i + 1 >= first + size + cfg.slack or len(seen) == len(need):
                    break
                seen.setdefault((words[i], words[i + 1]), i)
            if len(seen) >= cfg.min_template * len(need):
                full.append((-len(seen), max(seen.values()) - first, first, frozenset(seen.values())))
        used = bytearray(len(words) + 1)
        for n, length, first, hits in sorted(full, key=lambda c: c[:3]):
            if not any(used[first:first + length + 1]):
                used[first:first + length + 1] = b"\1" * (length + 1)
                out.append((k, -n / len(need), hits))
    return out


def template_match(words: list[str], family: str) -> float:
    """Largest share of a family template's word pairs that stand in the paragraph."""
    have, best = _pairs(words), 0.0
    for t in TEMPLATES[family]:
        need = _pairs(tokens(t))
        if need:
            best = max(best, len(need & have) / len(need))
    return best


_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def gram_slots(h: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the 1-, 2- and 3-grams that start at each word, by the words' hashes."""
    def slot(x: np.ndarray) -> np.ndarray:
        return ((x ^ (x >> np.uint64(31))) % np.uint64(slots)).astype(np.int64)

    with np.errstate(over="ignore"):
        one = (h + np.uint64(1)) * _M1
        two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * _M2 + one[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint64(27))) * _M3 + one[2:] if len(h) > 2 else two[:0]
    return slot(one), slot(two * _M3), slot(three * _M1)


def hashes(words: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)


def windows(of: np.ndarray, begin: np.ndarray, end: np.ndarray, sizes: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word behind the last) of the windows of paragraphs laid end to end; ``of`` is
    the paragraph of every word, ``begin`` and ``end`` its words."""
    at = np.arange(len(of))
    low, high = [], []
    for size in sizes:
        own = at[(at - begin[of]) % max(1, size // 3) == 0]
        low.append(own)
        high.append(np.minimum(own + size, end[of[own]]))
    return np.concatenate(low), np.concatenate(high)


@dataclass
class Model:
    classes: list
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float
    slots: int

    def window_probabilities(self, h: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Class probabilities of windows over the words with hashes ``h``, by running sums."""
        z = np.zeros((len(low), len(self.classes)))
        for k, slot in enumerate(gram_slots(h, self.slots)):
            upto = np.zeros((len(slot) + 1, len(self.classes)))
            np.cumsum(self.weights[slot], axis=0, dtype=np.float64, out=upto[1:])
            z += upto[np.clip(np.maximum(high - k, low), 0, len(slot))] - upto[np.clip(low, 0, len(slot))]
        z = (z / np.sqrt(_grams(high - low))[:, None] + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def named(self, h: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(first word, word behind the last, family, probability) of the windows that name a family."""
        p = self.window_probabilities(h, low, high)
        best = p.argmax(axis=1)
        score = p[np.arange(len(p)), best]
        hit = np.flatnonzero((score >= self.least) & (best != self.classes.index(UNKNOWN)))
        return [(int(low[i]), int(high[i]), self.classes[best[i]], float(score[i])) for i in hit]

    def find(self, words: list[str], cfg: LicenceConfig) -> list[tuple[str, float, float, int, int]]:
        """(family, probability, template share, first word, last word) of the notices in a paragraph."""
        if not words:
            return []
        n = np.array([len(words)])
        low, high = windows(np.zeros(len(words), dtype=np.int64), n * 0, n, cfg.sizes)
        return confirmed(words, self.named(hashes(words), low, high), cfg)

    def judge(self, paragraph: str, cfg: LicenceConfig = LicenceConfig()) -> tuple[str, float, float]:
        """(family or unknown, probability, template share) of a paragraph's most probable notice."""
        found = self.find(tokens(paragraph), cfg)
        if found:
            return max(found, key=lambda c: c[1])[:3]
        return UNKNOWN, 1.0, max(template_match(tokens(paragraph), f) for f in TEMPLATES)


def _grams(n: np.ndarray) -> np.ndarray:
    """1-, 2- and 3-grams of n words."""
    return np.maximum(n, 1) + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)


def confirmed(words: list[str], named: list[tuple[int, int, str, float]], cfg: LicenceConfig) -> list:
    """Notices of a paragraph: families that windows name, where a template confirms them."""
    regions: dict[str, list[list]] = {}
    for low, high, family, score in sorted(named):
        low, high = max(0, low - cfg.slack), min(len(words), high + cfg.slack)
        own = regions.setdefault(family, [])
        if own and low <= own[-1][1]:
            own[-1][1] = max(own[-1][1], high)
            own[-1][2].append((low + cfg.slack, high - cfg.slack, score))
        else:
            own.append([low, high, [(low + cfg.slack, high - cfg.slack, score)]])
    found = []
    for family, own in regions.items():
        for low, high, scores in own:
            for _, share, hits in stretches(words[low:high], _OF_FAMILY[family], cfg):
                first, last = low + min(hits), low + max(hits) + 1
                near = [s for x, y, s in scores if x - cfg.slack <= last and first <= y + cfg.slack]
                pairs = frozenset((words[low + i], words[low + i + 1]) for i in hits)
                found.append((first, last, pairs, family, max(near, default=max(s for _, _, s in scores)), share))
    found.sort(key=lambda c: (c[:2], c[3]))
    widest = max((c[1] - c[0] for c in found), default=0)
    out = []
    for i, (first, last, pairs, family, score, share) in enumerate(found):
        near = []
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(found) and first - widest <= found[j][0] <= last:
                near.append(found[j])
                j += step
        if not any(c[1] >= first and c[3] != family and (pairs < c[2] or pairs == c[2] and (score, c[3]) < (c[4], family))
                   for c in near):
            out.append((family, score, share, first, last))
    return out


def paragraphs(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """(words, number of the line of every word) of each run of lines up to a blank one."""
    words: list[str] = []
    lines: list[int] = []
    for i, line in enumerate(text.split("\n")):
        if not line.strip() and words:
            yield words, lines
            words, lines = [], []
        own = tokens(line)
        words += own
        lines += [i] * len(own)
    if words:
        yield words, lines


def background(docs: DataFrame, cfg: LicenceConfig) -> list[str]:
    """Bounded sample of corpus stretches, spread over whole texts, in a fixed order."""
    share = bounded_sample_share(docs.count(), cfg.background_docs)
    row = F.coalesce(F.col("doc_id").cast("string"), F.col("text"))
    picked = docs.where(F.col("text").isNotNull() & in_share(row, F.lit(share), seed=41)).select("text")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for text in f["text"]:
                w = tokens(text)
                starts = np.linspace(0, max(len(w) - cfg.window_words, 0), cfg.windows_per_doc).astype(int)
                out += [" ".join(w[i:i + cfg.window_words]) for i in sorted(set(starts.tolist())) if w]
            yield pd.DataFrame({"words": out}, dtype=str)

    found = sorted(r["words"] for r in picked.mapInPandas(cut, "words string").collect())
    return [x for x in found if max(template_match(tokens(x), f) for f in TEMPLATES) < 0.4]


def _examples(cfg: LicenceConfig, filler: list[list[str]], rng: np.random.Generator) -> list[tuple[list[str], str]]:
    """(words, class) of training windows."""
    out = []
    for family in sorted(TEMPLATES):
        for t in TEMPLATES[family]:
            base = tokens(t)
            for i in range(cfg.variants):
                w = list(base)
                if i and len(w) > 8:    # some words are lost or others
                    w = [x if r > 0.07 else None if r < 0.04 else filler[rng.integers(len(filler))][0] if filler else None
                         for x, r in zip(w, rng.random(len(w)))]
                    w = [x for x in w if x]
                before, after = ([], []) if not i or not filler else (filler[rng.integers(len(filler))] for _ in range(2))
                words, first = before + w + after, len(before)
                for size in cfg.sizes:
                    whole = min(size, len(w))
                    # most of the window, or of the notice, is seen
                    least = -(-3 * whole // 4)
                    low = rng.integers(max(0, first + least - size), max(1, first + len(w) - least + 1))
                    own = words[low:low + size]
                    seen = min(low + size, first + len(w)) - max(low, first)
                    out.append((own, family if seen >= least else UNKNOWN))
    for w in filler:
        for size in cfg.sizes:
            low = rng.integers(max(1, len(w) - size + 1))
            out.append((w[low:low + size], UNKNOWN))
    return out


def fit(paragraphs: list[str], cfg: LicenceConfig = LicenceConfig()) -> Model:
    rng = np.random.default_rng(cfg.seed)
    classes = sorted([*TEMPLATES, UNKNOWN])
    filler = [w for w in map(tokens, paragraphs) if w]
    rows = _examples(cfg, filler, rng)
    # sentences that speak of licences without granting one
    rows += [(tokens(x), UNKNOWN) for x in (
        "the driver must carry a license", "permission to enter was refused", "this work is a study of public law",
        "a version of the general story", "the library is public", "she has a fishing licence", "free software",
        "the licence to use a version of software", "general public library", "license")] * 12
    rng.shuffle(rows)
    aside = np.arange(len(rows)) % 4 == 0
    grams = [np.concatenate(gram_slots(hashes(w), cfg.slots)) if w else np.zeros(0, dtype=np.int64) for w, _ in rows]
    y = np.array([classes.index(c) for _, c in rows])
    train = np.flatnonzero(~aside)
    who = np.repeat(np.arange(len(train)), [len(grams[i]) for i in train])
    what = np.concatenate([grams[i] for i in train]) if len(train) else np.zeros(0, dtype=np.int64)
    scale = 1.0 / np.sqrt(_grams(np.array([len(rows[i][0]) for i in train])))
    m, n = len(classes), len(train)
    w, b = np.zeros((cfg.slots, m)), np.zeros(m)
    a1, a2, eye = np.zeros_like(w), np.zeros_like(w), np.eye(m)

    def logits() -> np.ndarray:
        return np.stack([np.bincount(who, weights=w[what, k], minlength=n) for k in range(m)], axis=1) \
            * scale[:, None] + b

    for step in range(1, cfg.steps + 1):
        z = logits()
        e = np.exp(z - z.max(axis=1, keepdims=True))
        err = e / e.sum(axis=1, keepdims=True) - eye[y[train]]
        g = np.stack([np.bincount(what, weights=(err[:, k] * scale)[who], minlength=cfg.slots)
                      for k in range(m)], axis=1)
        g = (g + cfg.l2 * w) / n
        a1, a2 = 0.9 * a1 + 0.1 * g, 0.999 * a2 + 0.001 * g * g
        w -= 0.2 * (a1 / (1 - 0.9 ** step)) / (np.sqrt(a2 / (1 - 0.999 ** step)) + 1e-8)
        b -= 0.5 * err.mean(axis=0)
    model = Model(classes, w.astype(np.float32), b, 1.0, 0.5, cfg.slots)
    return _calibrate(model, [rows[i][0] for i in np.flatnonzero(aside)], y[aside], cfg)


def _calibrate(model: Model, words: list[list[str]], y: np.ndarray, cfg: LicenceConfig) -> Model:
    """Temperature by held-aside likelihood; the least probability by the false rate of unknowns."""
    if not len(y):
        return model

    size = np.array([len(w) for w in words])
    h, high = hashes([x for w in words for x in [*w, "", ""]]), np.cumsum(size + 2) - 2

    def at(t: float) -> np.ndarray:
        model.temperature = t
        return model.window_probabilities(h, high - size, high)

    grid = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0]
    loss = [-np.log(at(t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    p = at(grid[int(np.argmin(loss))])
    unknown = model.classes.index(UNKNOWN)
    false = np.delete(p[y == unknown], unknown, axis=1).max(axis=1, initial=0)
    model.least = float(max(0.5, np.quantile(false, 1 - cfg.max_false))) if len(false) else 0.5
    model.least = min(model.least, 0.9)
    return model


def _runs(texts: list[str], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Texts in runs of about ``size`` characters."""
    low = held = 0
    for i, t in enumerate(texts, 1):
        held += len(t)
        if held >= size or i == len(texts):
            yield low, i
            low, held = i, 0


class Scanner:
    """Judges the windows of many texts together; keeps the hashes of words it has seen."""

    def __init__(self, model: Model, cfg: LicenceConfig):
        self.model, self.cfg = model, cfg
        self.known, self.hash = Numbered(), np.zeros(0, dtype=np.uint64)

    def notices(self, texts: list[str]) -> list[list[tuple[list, list]]]:
        """Per text the paragraphs with notices: (notices, number of the line of every word)."""
        if len(self.known) > CACHE:
            self.known, self.hash = Numbered(), self.hash[:0]
        parts = [(i, words, lines) for i, t in enumerate(texts) for words, lines in paragraphs(t)]
        out: list[list] = [[] for _ in texts]
        if not parts:
            return out
        size = np.array([len(w) for _, w, _ in parts])
        ids = np.fromiter(map(self.known.__getitem__, chain.from_iterable(w for _, w, _ in parts)),
                          dtype=np.int64, count=int(size.sum()))
        new, self.known.new = self.known.new, []
        self.hash = np.concatenate([self.hash, hashes(new)])
        end = np.cumsum(size)
        low, high = windows(np.repeat(np.arange(len(parts)), size), end - size, end, self.cfg.sizes)
        by: dict[int, list] = {}
        for x, y, family, score in self.model.named(self.hash[ids], low, high):
            k = int(np.searchsorted(end, x, side="right"))
            by.setdefault(k, []).append((x - int(end[k] - size[k]), y - int(end[k] - size[k]), family, score))
        for k in sorted(by):
            i, words, lines = parts[k]
            if found := confirmed(words, by[k], self.cfg):
                out[i].append((found, lines))
        return out


def scan(docs: DataFrame, cfg: LicenceConfig = LicenceConfig(), model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, found: array of (paragraph, start, end, family, score, template);
    paragraph is the number of the notice's first line, start and end (of its whole lines) are code points."""
    model = model or fit(background(docs, cfg), cfg)
    d = docs.select("doc_id", "text")
    id_type = d.schema["doc_id"].dataType.simpleString()

    def spans(text: str, found: list[tuple[list, list]]) -> list[dict]:
        """Notices of a text as lines; ``found``: (notices, number of the line of every word) per paragraph."""
        at = [0]
        for line in text.split("\n"):
            at.append(at[-1] + len(line) + 1)
        out: list[dict] = []
        for notices, lines in found:
            last: dict = {}
            for family, score, share, first, end in notices:
                have = last.get(family)
                if have and lines[first] <= have["to"]:  # notices of a family that share a line are one
                    have |= {"to": max(have["to"], lines[end]), "score": max(have["score"], score),
                             "template": max(have["template"], share)}
                else:
                    last[family] = {"paragraph": lines[first], "to": lines[end], "family": family,
                                    "score": score, "template": share}
                    out.append(last[family])
        return [{"paragraph": x["paragraph"], "start": at[x["paragraph"]], "end": at[x["to"] + 1] - 1,
                 "family": x["family"], "score": x["score"], "template": x["template"]} for x in out]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(model, cfg)
        for f in frames:
            texts = [t or "" for t in f["text"]]
            out: list[list] = []
            for low, high in _runs(texts):
                out += [spans(t, x) if x else [] for t, x in zip(texts[low:high], scanner.notices(texts[low:high]))]
            yield pd.DataFrame({"doc_id": f["doc_id"], "found": out})

    return d.mapInPandas(run, f"doc_id {id_type}, found array<struct<paragraph:long,start:long,end:long,"
                              "family:string,score:double,template:double>>")


def licence_report(docs: DataFrame, cfg: LicenceConfig = LicenceConfig()) -> DataFrame:
    """One row per document: doc_id, n_licences, families (comma-joined, sorted), score (of the best)."""
    found = F.col("found")
    return scan(docs, cfg).select(
        "doc_id", F.size(found).cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["family"]))), ",").alias("families"),
        F.coalesce(F.array_max(F.transform(found, lambda x: x["score"])), F.lit(0.0)).alias("score"))
