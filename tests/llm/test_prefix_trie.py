import hashlib
import random
import re
import zlib

import pytest

from skyfare.llm import prefix_trie
from skyfare.llm.queries import QUERIES, SQL

from .helpers import SF_SMALL, SF_TINY, clashing, oracle_rows, rows_of, same_as_oracle, ws

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(paths):
    """Nodes of {conv_id: [(role, text), ...]}, prefix by prefix."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, cs in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(cs) - 1) * words
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(paths[c]) == len(p)).encode()).hexdigest())
                  for p, cs in members.items())


def rebuilt(rows):
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "")):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + path[h:]
    return out


def nodes_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[0], r[1]))


def plain_rows(rows):
    return sorted(plain_nodes(rebuilt(rows)), key=lambda r: (r[0], r[1]))


def test_query_equals_its_sql(spark):
    for folder in (SF_TINY, SF_SMALL):
        same_as_oracle(spark, QUERIES["op11_prefix_trie"], SQL["op11_prefix_trie"], folder)


@pytest.mark.parametrize("block", [1, 3, 8])
def test_nodes_equal_plain_ones(spark, block):
    rng = random.Random(block)
    rows = []
    for c in range(60):
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c * 3, t, "ua"[t % 2], rng.choice(["a", "a", "a b", "c  d\te"]) if t < 11 else f"x{t}"))
    # copies whose shared path is longer than several blocks
    rows += [(1000 + 20 * i, t, "u", f"long {t}") for i in range(5) for t in range(11 + (i > 2))]
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), ws(spark), prefix_trie.Trie(block=block))
    assert nodes_of(got) == plain_rows(rows)


EDGES = [(None, 0, "u", "nobody"), (5, None, "u", "null turn first"), (5, 0, None, None), (5, 1, "", ""), (5, 1, "", ""),
         (20, 0, "u", "x"), (20, 1, "a", "y"), (21, 0, "u", "own"), (39, 0, "u", "1"), (39, 1, "a", "2"), (39, 2, "u", "3"),
         (39, 3, "a", "4"), (-7, 0, "u", "negative"), (400, 0, "u", "w " * 100_000), (41, 0, "u", "base is absent"),
         (2**62, 0, "u", "large id"), (44, 0, "a:", "b"), (45, 0, "a", ":b")]


def test_edges(spark):
    rows = EDGES + [(7 + 20 * i, t, "u", ["same", "copy"][t]) for i in range(40) for t in range(2)]
    d = clashing(spark.createDataFrame(rows, SCHEMA))
    got = nodes_of(prefix_trie.conversation_trie(d, ws(spark)))
    # Python's % takes the sign of the divisor, SQL's that of the dividend: -7's base is 0 in both tables (absent)
    assert got == plain_rows(rows)
    assert any(r[1] == 0 and r[3] == len({c for c, *_ in rows if c is not None}) for r in got)


def test_edges_equal_the_sql(spark, tmp_path):
    clashing(spark.createDataFrame(EDGES, SCHEMA)).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_prefix_trie"](spark, str(tmp_path))
    assert rows_of(got) == oracle_rows(str(tmp_path), SQL["op11_prefix_trie"], sorted(got.columns))


def test_hot_copies_and_chunks(spark):
    n = 3 * prefix_trie.CHUNK + 5
    turns = spark.range(n).selectExpr("id * 20 as conv_id", "1L as pos", "'t:1' as turn")
    convs = turns.selectExpr("conv_id", "1L as n")
    got = nodes_of(prefix_trie.prefix_nodes(turns, convs, ws(spark)))
    sha = hashlib.sha256(",".join(str(20 * i) for i in range(n)).encode()).hexdigest()
    assert got == [(0, 0, None, n, 1, 1, n - 1, prefix_trie.NOBODY), (0, 1, 0, n, 0, 1, n - 1, sha)]


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA), ws(spark)).count() == 0
