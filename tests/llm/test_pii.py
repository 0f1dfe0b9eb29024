import hashlib
import random
import re

from pyspark.sql import functions as F

from skyfare.llm import pii

from .helpers import clashing, documents, ws

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    counts, spans = [], []
    for kind, pattern in PLAIN.items():
        n = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            n += 1
            spans.append(f"{kind}:{m.start()}:{m.end()}")
        counts.append(n)
    return counts, ",".join(spans)


def noisy(rng):
    bits = ["a@b.co", "x.y%z@q-r.s.t", "@", ".", "a@b", "_d@e.f", "1.2.3.4", "300.1.1.1", "0001.02.3.255", "1.2.3.4.5",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "+1 (555) 010-9999", "+1", "+12)-",
            "+49 30 1234567 ", " ", " ", "é", "😀", "\n", "word", "-", "+", "%", "12345678901234567890", "a@b.c_d@e.f"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(4)
    texts = [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "x" * 40_000 + "@", "9" * 40_000, "1." * 20_000,
             "a@b.co " * 2500] + [noisy(rng) for _ in range(400)]
    got = pii.report(clashing(documents(spark, list(enumerate(texts)))), ws(spark)).collect()
    assert len(got) == len(texts)
    for r in got:
        counts, spans = plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == counts, texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert r["spans"].split(",")[:len(spans.split(","))] == spans.split(",")


def telling(spark):
    """'zanzibarite' stands only with one entity, 'the' with everything."""
    rows = [(i, f"the quick fox number{chr(97 + i % 26)} walks home the end") for i in range(40)]
    rows += [(100 + i, f"the note by zanzibarite says {'abcd'[i]}xy write to hidden.one@mail.org or the desk") for i in range(4)]
    rows += [(200, "the desk again other@mail.org"), (201, None), (202, ""),
             (100, "the note by zanzibarite says axy write to hidden.one@mail.org or the desk")]
    return documents(spark, rows)


def test_terms_that_reveal_an_entity(spark):
    d = telling(spark)
    got = {r["doc_id"]: r["spans"] for r in pii.report(d, ws(spark)).collect()}
    text = {r["doc_id"]: r["text"] for r in d.collect()}
    terms = {text[100][int(s.split(":")[1]):int(s.split(":")[2])] for s in got[100].split(",") if s.startswith("term")}
    assert "zanzibarite" in terms and "the" not in terms
    assert "term" not in got[200] and got[201] == got[202] == "" and "term" not in got[3]


def test_disclosure_share_is_pmi_over_information(spark):
    import math
    d, w, cfg = telling(spark), ws(spark), pii.Disclosure(generalise_at=-9.0)
    base = pii.find_base(d, w, cfg)
    terms = w.table(pii._terms_around(base), "t")
    got = {(r["entity"], r["term"]): r["share"] for r in pii.disclosures(d, base, terms, w, cfg).collect()}
    n, df_e, c = 48, 5, 5
    df_the = 46
    expected = math.log2(c * n / (df_the * df_e)) / math.log2(n / df_e)
    assert abs(got["email:hidden.one@mail.org", "the"] - expected) < 1e-9
    assert abs(got["email:hidden.one@mail.org", "zanzibarite"] - 1.0) < 1e-9
    far = pii.disclosures(d, base, terms, ws(spark), pii.Disclosure(generalise_at=-9.0, max_broadcast=0))
    assert {(r["entity"], r["term"]): r["share"] for r in far.collect()} == got


def test_sanitise(spark):
    d = clashing(telling(spark))
    out = pii.sanitise(d, ws(spark))
    assert out.columns == d.columns and out.count() == d.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[100] == "the  by   axy  to [EMAIL] or the [TERM]"
    assert text[200] == "the desk again [EMAIL]" and text[201] is None and text[202] == ""


def marked(spark, d):
    """doc_id -> words of its term spans."""
    text = {r["doc_id"]: r["text"] for r in d.collect()}
    return {r["doc_id"]: [text[r["doc_id"]][int(x.split(":")[1]):int(x.split(":")[2])]
                          for x in r["spans"].split(",") if x.startswith("term")]
            for r in pii.report(d, ws(spark)).collect()}


def test_entities_in_one_and_in_two_texts(spark):
    """A name that stands with an entity alone gives it away, however few texts hold the entity."""
    rows = [(i, f"the quick fox number{chr(97 + i % 26)} walks home the end") for i in range(2000)]
    rows += [(3000, "the fox of oncelia walks to one@mail.org home"),
             (3001, "the fox of twicelia walks to two@mail.org home"), (3002, "walks twicelia the quick two@mail.org")]
    got = marked(spark, documents(spark, rows))
    assert got[3000] == ["oncelia"] and got[3001] == got[3002] == ["twicelia"]
    assert not any(got[i] for i in range(2000))


def test_terms_far_from_the_entity(spark):
    """A telling word counts and is marked all over the texts that hold the entity."""
    far = "the quick fox walks home " * 20
    rows = [(i, f"the quick fox number{chr(97 + i % 26)} walks home the end") for i in range(2000)]
    rows += [(3000 + i, f"Farcelia {far} {w} far@mail.org the {far} farcelia") for i, w in enumerate(("end", "fox"))]
    rows += [(None, f"Farcelia {far} end 4111 1111 1111 1111"), (3003, "the farcelia@mail.org fox")]
    got = marked(spark, documents(spark, rows))
    assert got[3000] == got[3001] == ["Farcelia", "farcelia"]
    assert got[None] == ["Farcelia"] and got[3003] == []


def test_empty(spark):
    d = documents(spark, [(1, "x")]).where(F.col("doc_id") < 0)
    assert pii.report(d, ws(spark)).count() == 0 and pii.sanitise(d, ws(spark)).count() == 0
