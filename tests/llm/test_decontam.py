import itertools
import random

import pytest

from skyfare.llm import decontam

from .helpers import clashing, documents, ws

CFG = decontam.Seeds()


def words(rng, n):
    return [f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.randint(0, 400)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    items = [(i, words(rng, 16 + 4 * i)) for i in range(6)]
    docs = []
    for k in range(60):
        body = words(rng, 80)
        if k % 3 == 0:
            leak = list(items[k // 3 % 6][1])
            if k % 2:  # substitute every eighth word
                leak = [w if i % 8 != 5 else "changed" for i, w in enumerate(leak)]
            body[20:20] = leak
        if k % 3 == 1:  # eight equal words in a row are no leak
            body[10:10] = items[k % 6][1][:8]
        docs.append((k, " ".join(body)))
    return items, docs


def plain(items, text):
    """Items with an aligned stretch of at least 80 % equal tokens (all alignments, no hashing)."""
    t = (text or "").lower().split()
    found = {}
    for item, w in items:
        v = min(CFG.verify_tokens, len(w))
        for d in range(-len(w) + 1, len(t)):
            eq = [0 <= d + i < len(t) and t[d + i] == w[i] for i in range(len(w))]
            best = max(sum(eq[i:i + v]) for i in range(len(w) - v + 1))
            if best / v >= CFG.min_match:
                found[item] = max(found.get(item, 0), best / v)
    return found


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_against_all_alignments(spark, corpus, limit):
    """Both ways (index sent to executors, shuffled join) equal the plain alignment search."""
    items, docs = corpus
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = decontam.decontaminate(documents(spark, docs), bench, ws(spark), decontam.Seeds(max_broadcast=limit))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == len(docs)
    for k, text in docs:
        expected = plain(items, text)
        assert rows[k]["contaminated"] == bool(expected) == (k % 3 == 0), k
        assert rows[k]["n_items"] == len(expected)
        if expected:
            assert rows[k]["first_item"] == min(expected)
            assert rows[k]["best_match"] == pytest.approx(max(expected.values()))


def test_edges(spark, corpus):
    items, docs = corpus
    leak = " ".join(items[5][1])
    loud = leak.upper().replace(" ", ", ")
    d = clashing(documents(spark, [(1, None), (2, ""), (3, leak), (3, leak), (None, loud), (4, "x " * 50_000 + leak),
                                   (5, leak[: len(leak) // 6]), (6, "clean words only")]))
    bench = spark.createDataFrame([(0, leak), (0, leak), (None, leak), (1, None), (2, "too short"), (3, "")],
                                  "item_id long, text string")
    got = sorted(((r["doc_id"], r["contaminated"]) for r in
                  decontam.decontaminate(d, bench, ws(spark)).collect()), key=repr)
    assert got == sorted([(1, False), (2, False), (3, True), (3, True), (None, True), (4, True), (5, False),
                          (6, False)], key=repr)
    kept = decontam.remove_contaminated(d, bench, ws(spark))
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5, 6]
    assert decontam.remove_contaminated(d, bench.where("item_id < 0"), ws(spark)).count() == 8
    assert decontam.decontaminate(d.where("doc_id < 0"), bench, ws(spark)).count() == 0


@pytest.mark.parametrize("n", range(CFG.span, CFG.verify_tokens + 1))
def test_every_alignment_at_the_threshold_has_a_hit(n):
    ones = [[o for o, bit in enumerate(m) if bit == "1"] for m in CFG.masks]
    laid = [{at + o for o in m} for m, text in zip(ones, CFG.masks) for at in range(n - len(text) + 1)]
    for changed in itertools.combinations(range(n), n - -(-4 * n // 5)):
        assert any(m.isdisjoint(changed) for m in laid), changed


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_random_substitutions_at_the_threshold(spark, limit):
    rng = random.Random(8)
    items = [(i, words(rng, n)) for i, n in enumerate((11, 12, 15, 16, 20, 27))]
    docs = []
    for k in range(240):
        i, w = items[k % 6]
        leak = list(w)
        over = k // 6 % 2  # every other one has a token too few
        for j in rng.sample(range(min(len(w), 20)), min(len(w), 20) - -(-4 * min(len(w), 20) // 5) + over):
            leak[j] = "changed"
        docs.append((k, " ".join(words(rng, rng.randint(0, 30)) + leak + words(rng, rng.randint(0, 30)))))
    docs += [(900, " ".join(["changed" if i in (0, 4, 8, 9) else x for i, x in enumerate(items[4][1])]))]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = decontam.decontaminate(documents(spark, docs), bench, ws(spark), decontam.Seeds(max_broadcast=limit))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[900]["contaminated"]
    for k, text in docs:
        expected = plain(items, text)
        assert rows[k]["n_items"] == len(expected), (k, text)
        if expected:
            assert rows[k]["best_match"] == pytest.approx(max(expected.values()))


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_short_items_and_scripts_without_spaces(spark, limit):
    """Items of fewer tokens than a mask are found too; Chinese, Japanese and Thai letter by letter."""
    rng = random.Random(5)
    items = [(n, " ".join(words(rng, n))) for n in range(1, 11)]
    chinese = "中华人民共和国的首都是哪一座城市请选择正确答案"
    thai = "กรงเทพเปนเมองหลวงของประเทศไทย"
    items += [(50, chinese), (51, "東京は日本の首都ですか"), (52, "首都在哪"), (53, thai)]
    docs = [(i, f"{' '.join(words(rng, 9))} {t.upper()}, {' '.join(words(rng, 9))}") for i, t in items]
    docs += [(100 + i, t) for i, t in items]
    docs += [(250, "前言" + chinese.replace("都", "市").replace("确", "常") + "后记"), (251, "他说首都在北京哪里"),
             (210, " ".join(items[9][1].split()[:9] + ["changed"]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(documents(spark, docs), bench, ws(spark), decontam.Seeds(max_broadcast=limit))
    rows = {r["doc_id"]: (r["contaminated"], r["first_item"], r["best_match"]) for r in got.collect()}
    for i, _ in items:
        assert rows[i] == rows[100 + i] == (True, i, 1.0), i
    assert rows[250][:2] == (True, 50) and not rows[251][0] and rows[210] == (True, 10, 0.9)


@pytest.mark.parametrize("n", range(1, 11))
def test_short_masks_miss_no_allowed_substitution(n):
    allowed = int(n * 0.2 + 1e-9)
    zeros = [{i for i, bit in enumerate(m) if bit == "0"} for m in decontam.short_masks(n, 0.8)]
    assert all(len(m) == n and m.count("1") >= min(n - allowed, 4) for m in decontam.short_masks(n, 0.8))
    for changed in itertools.combinations(range(n), allowed):
        assert any(z.issuperset(changed) for z in zeros)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_short_items_with_substitutions(spark, limit):
    """Five to ten tokens, as many changed as may be or one more, inside texts and across their ends."""
    rng = random.Random(12)
    items = [(i, words(rng, n)) for i, n in enumerate((3, 5, 6, 7, 8, 9, 10))]
    docs = []
    for k in range(280):
        leak = list(items[k % 7][1])
        for j in rng.sample(range(len(leak)), min(len(leak), len(leak) // 5 + k // 7 % 2)):
            leak[j] = "changed"
        cut = rng.randint(0, 2)
        body = [leak[cut:] + words(rng, 5), words(rng, 5) + leak[:len(leak) - cut], words(rng, 3) + leak + words(rng, 3), leak]
        docs.append((k, " ".join(body[k % 4])))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = decontam.decontaminate(documents(spark, docs), bench, ws(spark), decontam.Seeds(max_broadcast=limit))
    rows = {r["doc_id"]: r for r in got.collect()}
    for k, text in docs:
        expected = plain(items, text)
        assert rows[k]["n_items"] == len(expected), (k, text)
        if expected:
            assert rows[k]["best_match"] == pytest.approx(max(expected.values()))


def test_a_text_under_many_ids_is_looked_for_once(spark):
    rng = random.Random(2)
    leak = " ".join(words(rng, 24))
    bench = spark.createDataFrame([(i, leak) for i in range(50)], "item_id long, text string")
    one = decontam.decontaminate(documents(spark, [(1, leak)]), bench.where("item_id = 7"), ws(spark)).first()
    many = decontam.decontaminate(documents(spark, [(1, leak)]), bench, ws(spark)).first()
    assert (one["n_items"], many["n_items"], many["first_item"]) == (1, 50, 0)
    assert many["n_hits"] == 50 * one["n_hits"]
    _, _, index, _ = decontam._index(bench, CFG, ws(spark))
    _, _, single, _ = decontam._index(bench.where("item_id = 7"), CFG, ws(spark))
    assert index.count() == single.count()
