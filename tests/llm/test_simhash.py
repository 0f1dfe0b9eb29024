import itertools
import random

import xxhash
from pyspark.sql import functions as F

from skyfare.llm import simhash
from skyfare.llm.common import Workspace
from skyfare.llm.components import connected
from skyfare.llm.queries import QUERIES

from .helpers import SF_SMALL, clashing, documents, rows_of, ws


def plain_fingerprint(text, n=4):
    words = []
    for w in (text or "").encode().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split():
        words.append(bytes(c + 32 if 65 <= c <= 90 else c for c in w))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items):
    """items: (id, fingerprint) -> id -> smallest id reachable."""
    comp = {i: i for i, _ in items}
    changed = True
    while changed:
        changed = False
        for (i, f), (j, g) in itertools.combinations(items, 2):
            if (f ^ g).bit_count() <= 4 and comp[i] != comp[j]:
                comp[i] = comp[j] = min(comp[i], comp[j])
                changed = True
    return comp


class Planned(Workspace):
    """Keeps the physical plan of every table that it writes."""

    def __init__(self, spark):
        super().__init__(spark, "planned")
        self.plans = {}

    def table(self, df, name, partition_by=None):
        self.plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return super().table(df, name, partition_by)


def test_tables_that_grow_with_the_documents_are_never_broadcast(spark):
    """However small Spark takes them to be: an explode is not counted in its sizes."""
    rows = [(i, f"{'one two three four five six seven ' * (i % 3)} eight {i // 4}") for i in range(40)]
    w = Planned(spark)
    kept = simhash.drop_near_duplicates(documents(spark, rows), w)
    for name in ("members", "links_0", "out", "twice"):
        assert "Join" in w.plans[name] and "Broadcast" not in w.plans[name], (name, w.plans[name])
    items = [(i, simhash.fingerprint(t)) for i, t in rows]
    component = plain_components(items)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(component.values()))


def test_fingerprint_is_the_plain_one():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "two Words", "ÄB \x0bc\x0c d É", "a b c d", "A a A a A a a"]
    texts += [" ".join(rng.choice(["x", "Yy", "zé", "the"]) for _ in range(rng.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t), t


def test_pieces_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(f"w{i % 97}{'q' * (i % 5)}" for i in range(900))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 50)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_links_connect_every_close_pair(spark):
    """Random near groups, dense and chained, against all pairs."""
    rng = random.Random(7)
    fps = set()
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                f ^= 1 << b
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    w = ws(spark)
    got = connected(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), w), w)
    root = {r["node"]: r["root"] for r in got.collect()}
    expected = plain_components(list(enumerate(fps)))
    for (i, f), (j, g) in itertools.combinations(list(enumerate(signed)), 2):
        assert (expected[i] == expected[j]) == (root.get(f, f) == root.get(g, g))


def test_components_of_a_long_chain(spark):
    w = ws(spark)
    got = connected(spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")), w)
    assert got.count() == 401 and got.select("root").distinct().count() == 1


def test_whole_query_against_all_pairs(spark):
    got = QUERIES["op3_simhash"](spark, SF_SMALL).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = [(i, plain_fingerprint(t)) for i, t in text.items()]
    by = {}
    for i, f in items:
        by.setdefault(f, []).append(i)
    comp = plain_components([(min(ids), f) for f, ids in by.items()])
    expected = {i: (f"{f:016x}", comp[min(by[f])]) for i, f in items}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == expected


def test_edges_and_dropping(spark):
    long = "lorem ipsum dolor " * 30_000
    d = clashing(documents(spark, [(5, None), (4, ""), (3, "same words here now"), (2, "same words here now"),
                                   (2, "same words here now"), (None, "same words here now"), (9, long),
                                   (7, "quite another text it is"), (None, None), (None, "alone without any id")]))
    rows = simhash.near_duplicates(d, ws(spark))
    comp = {(r["doc_id"], r["component_id"]) for r in rows.collect()}
    assert comp == {(5, 4), (4, 4), (None, 4), (3, 2), (2, 2), (None, 2), (9, 9), (7, 7), (None, None)}
    kept = simhash.drop_near_duplicates(d, ws(spark))
    assert kept.columns == d.columns
    assert sorted(rows_of(kept, ["doc_id"]), key=repr) == [(2,), (4,), (7,), (9,), (None,)]
    none = d.where("doc_id = -1")
    assert simhash.near_duplicates(none, ws(spark)).count() == 0
    assert simhash.drop_near_duplicates(none, ws(spark)).count() == 0
