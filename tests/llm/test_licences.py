import random

import numpy as np
import pytest

from skyfare.llm import licences as L
from skyfare.llm.queries import QUERIES

from .helpers import SF_SMALL, clashing, documents

FILLER = ["er then the ounor eshth of and", "the version of this general work is public", "onst hathe eringed"] * 30


@pytest.fixture(scope="module")
def model():
    return L.fit(FILLER)


def test_every_template_is_named(model):
    for family, texts in L.TEMPLATES.items():
        for t in texts:
            assert model.judge(t)[0] == family, t
            assert model.judge(f"er then {t.upper()} onst hathe")[0] == family, t


def test_unknown_stays_unknown(model):
    for t in FILLER[:3] + ["", "!!!", "the licence to use a version of software", "General Public Library", "License",
                           "permission is granted to use the public library"]:
        assert model.judge(t)[0] == L.UNKNOWN, t


def test_documents(spark):
    """Every planted licence line is found with its family; nothing else is."""
    planted = {"apache": "licensed under the apache license", "mit": "released under the mit license",
               "cc-by-nc": "licensed under cc by-nc", "gpl": "licensed under the gnu general public license"}
    text = {r["doc_id"]: r["text"].lower() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in QUERIES["op7_licences"](spark, SF_SMALL).collect():
        assert r["families"] == ",".join(sorted(k for k, p in planted.items() if p in text[r["doc_id"]]))


def test_edges(spark):
    mit = "Released under the MIT License."
    d = clashing(documents(spark, [(1, None), (2, ""), (3, f"x\n{mit}\ny"), (3, f"x\n{mit}\ny"), (None, mit),
                                   (4, "words go on " * 60_000 + f"\n{mit}"), (5, f"{mit}\nLicensed under CC BY 4.0")]))
    got = sorted(((r["doc_id"], r["n_licences"], r["families"]) for r in L.licence_report(d).collect()), key=repr)
    assert got == sorted([(1, 0, ""), (2, 0, ""), (3, 1, "mit"), (3, 1, "mit"), (None, 1, "mit"), (4, 1, "mit"),
                          (5, 2, "cc-by,mit")], key=repr)
    span = L.scan(d).where("doc_id = 3").first()["found"][0]
    assert (span["paragraph"], span["start"], span["end"]) == (1, 2, 2 + len(mit))
    assert L.licence_report(d.where("doc_id < 0")).count() == 0


WRAPPED = {
    "mit": "MIT License\n\nCopyright (c) 2020 Somebody\n\n"
           "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\n"
           "in the Software without restriction, including without limitation the rights",
    "bsd": "Redistribution and use in source and binary forms, with or without\n"
           "modification, are permitted provided that the following conditions\nare met:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\n"
           "purpose with or without fee is hereby granted, provided that the above",
    "gpl": " * This program is free software: you can redistribute it and/or modify\n"
           " * it under the terms of the GNU General Public License as published by\n"
           " * the Free Software Foundation, either version 3 of the License, or",
    "lgpl": "# This library is free software; you can redistribute it and/or\r\n"
            "# modify it under the terms of the GNU Lesser General Public\r\n"
            "# License as published by the Free Software Foundation; either",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public\n"
           "License, v. 2.0. If a copy of the MPL was not distributed with this",
}


def test_wrapped_notices(spark, model):
    """Line ends inside a notice do not matter, with blank lines around it or without; blank lines part paragraphs."""
    texts = {}
    for family, t in WRAPPED.items():
        texts[f"{family} a"] = f"er then the ounor\n\n{t}\n\nonst hathe"
        texts[f"{family} b"] = "er then the ounor\n" * 300 + t + "\nonst hathe eringed" * 300
    keys = sorted(texts)
    d = documents(spark, [(i, texts[k]) for i, k in enumerate(keys)]
                  + [(99, "Released under\n\nthe ounor\n\nthe MIT\n\nLicense")])
    got = {r["doc_id"]: r["found"] for r in L.scan(d, model=model).collect()}
    for i, k in enumerate(keys):
        assert [x["family"] for x in got[i]] == [k.split()[0]], k
        span = texts[k][got[i][0]["start"]:got[i][0]["end"]]
        assert "\n" in span and "ounor" not in span and "hathe" not in span
    assert got[99] == []


def test_all_families_of_a_paragraph(spark, model):
    """Dual licences give both families; a licence named within a longer one's name does not count beside it."""
    lines = {"Licensed under the MIT License or the Apache License, Version 2.0": "apache,mit",
             "Licensed under the Apache License, Version 2.0, or released under the MIT License, at your option":
                 "apache,mit",
             "Licensed under CC BY-NC 4.0": "cc-by-nc", "Licensed under CC BY-SA 4.0": "cc-by-sa",
             "Licensed under CC BY 4.0": "cc-by",
             "This library is licensed under the GNU Lesser General Public License, version 3": "lgpl"}
    notices = {t: f for f, ts in L.TEMPLATES.items() for t in ts}
    long = [(t, "er then the ounor eshth of and " * 400 + t + " onst hathe eringed" * 400) for t in notices]
    rows = [(i, t) for i, t in enumerate([*lines, *[x for _, x in long]])]
    got = {r["doc_id"]: r["found"] for r in L.scan(documents(spark, rows), model=model).collect()}
    for i, expected in enumerate(lines.values()):
        assert ",".join(sorted(x["family"] for x in got[i])) == expected, rows[i]
    for i, (t, _) in enumerate(long, len(lines)):
        assert [x["family"] for x in got[i]] == [notices[t]], t


def plain_notices(model, text, cfg):
    """Every window of every paragraph on its own, then the templates around the named ones."""
    out = []
    for words, lines in L.paragraphs(text):
        named = []
        for size in cfg.sizes:
            for low in range(0, len(words), max(1, size // 3)):
                own = words[low:low + size]
                grams = np.concatenate(L.gram_slots(L.hashes(own), cfg.slots))
                z = (model.weights[grams].astype(float).sum(axis=0) / np.sqrt(len(grams)) + model.bias) / model.temperature
                p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
                best = int(p.argmax())
                if p[best] >= model.least and model.classes[best] != L.UNKNOWN:
                    named.append((low, min(low + size, len(words)), model.classes[best], float(p[best])))
        found = L.confirmed(words, named, cfg)
        if found:
            out.append((found, lines))
    return out


def test_scan_equals_every_window_on_its_own(spark, model):
    """Texts judged together, by running sums, give what each window gives alone."""
    cfg = L.LicenceConfig()
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()]
    notices = [t for ts in L.TEMPLATES.values() for t in ts]
    texts += [f"er then {x}\n\n{y} the ounor\nonst {x} eshth" for x, y in zip(notices, notices[5:])] + ["", "one", "a b"]
    got = L.Scanner(model, cfg).notices(texts)
    assert sum(map(bool, got)) > 15
    for t, g in zip(texts, got):
        expected = plain_notices(model, t, cfg)
        assert [lines for _, lines in g] == [lines for _, lines in expected]
        for (a, _), (b, _) in zip(g, expected):
            assert [(x[0], *x[2:]) for x in a] == [(x[0], *x[2:]) for x in b]
            assert all(abs(x[1] - y[1]) < 1e-6 for x, y in zip(a, b))


def test_reworded_and_cut_notices_are_found(model):
    """Notices that lost words, got others, or were cut off: nine in ten are named, half of their pairs confirm them."""
    rng, cfg = random.Random(6), L.LicenceConfig()
    seen = found = 0
    for family, texts in sorted(L.TEMPLATES.items()):
        for t in texts:
            w = L.tokens(t)
            if len(w) < 10:
                continue
            for k in range(12):
                own = list(w)
                for i in sorted(rng.sample(range(len(own)), len(own) // 8), reverse=True):
                    own[i:i + 1] = [] if k % 2 else ["ounor"]
                if k % 3 == 0:
                    own = own[:-(len(own) // 5)]
                if L.template_match(own, family) < cfg.min_template:
                    continue
                seen += 1
                text = ["er", "then", "the", "ounor"] * 10 + own + ["onst", "hathe"] * 20
                found += family in {x[0] for x in model.find(text, cfg)}
    assert seen > 80 and found >= 0.9 * seen, (found, seen)


def test_the_classifier_decides(model):
    """A paragraph that no window names is not reported, whatever template it holds."""
    quiet = L.Model(model.classes, model.weights * 0, model.bias * 0, 1.0, 0.5, model.slots)
    assert quiet.find(L.tokens("Released under the MIT License"), L.LicenceConfig()) == []
    assert model.find(L.tokens("Released under the MIT License"), L.LicenceConfig())


def test_background_is_spread_over_whole_texts(spark):
    cfg = L.LicenceConfig(windows_per_doc=3, window_words=2)
    text = "alpha beta " + "filler words " * 400 + "mid point " + "filler words " * 400 + "near end"
    assert {"alpha beta", "near end"} <= set(L.background(documents(spark, [(1, text), (2, None), (3, "")]), cfg))
