"""Conversation prefix trie by ROLLUP over positional turn columns.

Turns become ids (a 128-bit hash of role and text, with the text's word count).
A conversation is laid out in blocks of ``block`` turn columns; one
``GROUP BY prior, ROLLUP (t1, ..., tK)`` aggregates all prefixes of a block
together, ``grouping_id`` telling a prefix's length.  A conversation that goes on
enters the next block under the node it left the last one at (its smallest member
names that node); one that is alone in its node has the rest of its path for
itself, which needs no grouping.  So rounds follow the longest *shared* prefix.
A second ROLLUP over the nodes, last block first, sums subtrees: what a deeper
block sums up under a prior node is added to that node's row.

Nodes carry: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
n_leaves and saved_tokens of the subtree, and a digest of the conversations that
end there.  Digests stream: ids are joined in chunks where they are sorted, the
chunks of a node are hashed one after another, no group is held in memory.

Defined cases: null role or text is empty; rows without conv_id belong to no
conversation; turns with equal numbers are ordered by role, then by their id;
repeated rows are turns of their own; a conversation without turns is a member of
the root only; an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import dense_number
from .common import Workspace

WORD = r"[^\x20\x09-\x0D]+"
NOBODY = hashlib.sha256(b"").hexdigest()
CHUNK = 512   # ids joined in one text


@dataclass(frozen=True)
class Trie:
    block: int = 8


def turn_id(role: Column, text: Column) -> Column:
    """Hash of a turn and the words of its text: ``<md5>:<words>``."""
    return F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")), F.lit(":"),
                    F.regexp_count(text, F.lit(WORD)).cast("string"))


def words_of(turn: Column) -> Column:
    return F.substring_index(turn, ":", -1).cast("long")


# ---- sequences -----------------------------------------------------------------


def ordered_turns(conversations: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos from 1, turn) and conversations (conv_id, n)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"),
                    turn_id(role, text).alias("turn")))
    numbered = dense_number(rows, ["conv_id", "at", "role", "turn"], lambda df: ws.table(df, "placed"))
    numbered = ws.table(numbered.select("conv_id", "turn", "number"), "numbered")
    convs = ws.table(numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first")),
                     "conversations")
    turns = (numbered.join(convs.select("conv_id", "first"), "conv_id")
             .select("conv_id", (F.col("number") - F.col("first") + 1).alias("pos"), "turn"))
    return ws.table(turns, "turns"), convs.select("conv_id", "n")


def with_shared_heads(turns: DataFrame, convs: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first ``h`` turns of conversation ``c - c % 20``,
    h being crc32 of the decimal id modulo 4; their own first ``h`` turns go."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    c = (convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
         .join(base, "base", "left")
         .withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
         .select("conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")))
    c = ws.table(c, "rebuilt")
    own = (turns.join(c.select("conv_id", "h", "k"), "conv_id").where("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "turn"))
    heads = turns.where("pos <= 3").select(F.col("conv_id").alias("base"), "pos", "turn")  # at most 20 conversations a base
    head = c.where("k > 0").join(heads, "base").where("pos <= k").select("conv_id", "pos", "turn")
    return ws.table(own.unionByName(head), "sequences"), c.select("conv_id", "n")


# ---- trie ----------------------------------------------------------------------


def _key(block: int, columns: list[Column]) -> Column:
    """Name of a path within a block; nulls beyond its end do not count."""
    return F.md5(F.concat_ws("/", F.lit(str(block)), F.col("p").cast("string"), *columns).cast("binary"))


def _rollup(rows: DataFrame, k: int, aggregates: str) -> DataFrame:
    """All prefixes of the block's columns: p, t1..tK, level (columns not rolled up), aggregates."""
    t = ", ".join(f"t{i}" for i in range(1, k + 1))
    return rows.sparkSession.sql(
        f"SELECT p, {t}, cast({k} - bit_count(grouping_id()) as int) AS level, {aggregates} "
        f"FROM {{rows}} GROUP BY p, ROLLUP ({t})", rows=rows)


def prefix_nodes(turns: DataFrame, convs: DataFrame, ws: Workspace, cfg: Trie = Trie()) -> DataFrame:
    """Every distinct prefix of the sequences ``turns`` (conv_id, pos from 1 without gaps, turn);
    ``convs`` (conv_id, n turns) names all conversations, those without turns too."""
    k = cfg.block
    t = [F.col(f"t{i}") for i in range(1, k + 1)]
    place = F.col("pos") - 1
    slots = [F.max(F.when(place % k == i, F.col("turn"))).alias(f"t{i + 1}") for i in range(k)]
    blocks = ws.table(turns.groupBy("conv_id", F.floor(place / k).cast("long").alias("block")).agg(*slots)
                      .sortWithinPartitions("block"), "blocks")
    live = convs.select("conv_id", "n", F.lit(0).cast("long").alias("p"))
    nodes, ends, carried = [], [], []
    while True:
        j = len(nodes)
        rows = ws.table(live.join(blocks.where(F.col("block") == j).drop("block"), "conv_id", "left" if j == 0 else "inner")
                        .withColumn("stop", F.when(F.col("n") <= (j + 1) * k, F.col("n") - j * k)), f"rows_{j}")
        at = F.element_at(F.array(*t), F.greatest(F.col("level"), F.lit(1)))
        real = (F.col("level") == 0) if j == 0 else F.lit(False)
        stops = ", ".join(f"count_if(stop = {i})" for i in range(k + 1))
        found = _rollup(rows, k, f"min(conv_id) AS conv_id, count(*) AS n_convs, array({stops}) AS stops")
        found = (found.where(real | ((F.col("level") > 0) & at.isNotNull()))
                 .withColumn("leaf", (F.element_at("stops", F.col("level") + 1) == F.col("n_convs")).cast("long"))
                 .withColumn("words", F.when(F.col("level") > 0, words_of(at)).otherwise(F.lit(0).cast("long")))
                 .withColumn("key", _key(j, t)).drop("stops"))
        nodes.append(ws.table(found, f"nodes_{j}"))
        ends.append(rows.where("stop IS NOT NULL").select(_key(j, t).alias("key"), "conv_id"))
        left_at = nodes[j].where(F.col("level") == k).select("key", F.col("conv_id").alias("p"), "n_convs")
        on = ws.table(rows.where("stop IS NULL").select("conv_id", "n", _key(j, t).alias("key"))
                      .join(left_at, "key").drop("key"), f"on_{j}")
        carried.append(on.where("n_convs = 1").select("conv_id", "n"))
        live = on.where("n_convs > 1").select("conv_id", "n", "p")
        if live.isEmpty():
            break
    digests = ws.table(members_digest(ends, ws), "digests")
    out, deeper = [], None
    for j in reversed(range(len(nodes))):
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        carry = carried[j].select(F.col("conv_id").alias("c"), one.alias("c_children"), one.alias("c_leaves"), none.alias("c_saved"))
        if deeper is not None:
            carry = carry.unionByName(deeper)
        rows = (nodes[j].join(carry, (F.col("conv_id") == F.col("c")) & (F.col("level") == k), "left")
                .withColumnRenamed("level", "own").na.fill(0, ["c_children", "c_leaves", "c_saved"]))
        deep = ", ".join(f"count_if(own = {i})" for i in range(1, k + 1))
        sums = _rollup(rows, k, "min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaf + c_leaves) AS n_leaves, "
                       f"sum((n_convs - 1) * words + c_saved) AS saved_tokens, array({deep}, sum(c_children)) AS below")
        at = F.element_at(F.array(*t), F.greatest(F.col("level"), F.lit(1)))
        sums = ws.table(sums.where((F.col("level") == 0) | at.isNotNull())
                        .withColumn("n_children", F.element_at("below", F.col("level") + 1)).drop("below"), f"sums_{j}")
        deeper = sums.where("level = 0").select(F.col("p").alias("c"), F.col("n_children").alias("c_children"),
                                                F.col("n_leaves").alias("c_leaves"), F.col("saved_tokens").alias("c_saved"))
        own = sums if j == 0 else sums.where("level > 0")
        path = F.slice(F.array(*t), F.lit(1), F.greatest(F.col("level") - 1, F.lit(0)))
        own = own.withColumn("key", _key(j, t)).withColumn("up", F.when(F.col("level") > 1, _key(j, [path])))
        above = own.where(F.col("level").between(1, k - 1)).select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
        # the top node of a block is known without a join: the prior node, or the root
        top = sums.where("level = 0").select("conv_id").scalar() if j == 0 else F.col("p")
        out.append(own.where("level <= 1").withColumn("up_conv", F.when(F.col("level") == 1, top))
                   .unionByName(own.where("level > 1").join(above, "up"))
                   .join(digests, "key", "left")
                   .select("conv_id", (F.col("level") + F.lit(j * k)).cast("long").alias("depth"),
                           F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                           F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256")))
    for j, alone in enumerate(carried):
        last = F.col("pos") == F.col("n")
        out.append(turns.select("conv_id", "pos").join(alone, "conv_id").where(F.col("pos") > (j + 1) * k)
                   .select("conv_id", F.col("pos").alias("depth"), F.col("conv_id").alias("parent_conv_id"),
                           F.lit(1).cast("long").alias("n_convs"), (~last).cast("long").alias("n_children"),
                           F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                           F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
                           .otherwise(F.lit(NOBODY)).alias("ends_sha256")))
    result = out[0]
    for x in out[1:]:
        result = result.unionByName(x)
    return result


# ---- digests of the members that end at a node ------------------------------------


def members_digest(ends: list[DataFrame], ws: Workspace) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's conv_ids, ascending, comma-joined.

    A key's ids are cut into chunks where the range partitioning put them, so a hot key
    is sorted by many tasks; one task then hashes its few chunks in order."""
    rows = ends[0]
    for x in ends[1:]:
        rows = rows.unionByName(x)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": [key], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (k != key or len(ids) >= CHUNK):
                    yield close()
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield close()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [sha.hexdigest()]})

        for b in batches:
            for k, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if sha is not None and k == key:
                    sha.update(b"," + part.encode())
                    continue
                if sha is not None:
                    yield close()
                key, sha = k, hashlib.sha256(part.encode())
        if sha is not None:
            yield close()

    cut = (rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
           .mapInArrow(chunks, "key string, first long, ids string"))
    return (cut.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
            .mapInArrow(digest, "key string, ends_sha256 string"))


def conversation_trie(conversations: DataFrame, ws: Workspace, cfg: Trie = Trie()) -> DataFrame:
    """The prefix trie of ``conversations`` (conv_id, turn, role, text), rebuilt on shared heads."""
    turns, convs = with_shared_heads(*ordered_turns(conversations, ws), ws)
    return prefix_nodes(turns, convs, ws, cfg)


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text in DuckDB, bit by bit."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), "
            "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), "
            "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)")


def conversation_trie_sql() -> str:
    """The same in DuckDB SQL: every prefix of every conversation, then every ancestor of every node."""
    return f"""
WITH raw AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
ids AS (SELECT *, md5(length(role) || ':' || role || text) || ':' ||
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS id FROM raw),
own AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, role, id) AS ts FROM ids GROUP BY conv_id),
h AS (SELECT conv_id, ts, ({crc32_sql('conv_id::VARCHAR')} % 4)::INTEGER AS h FROM own),
c AS (SELECT h.conv_id, list_concat(list_slice(COALESCE(b.ts, []), 1, h.h), list_slice(h.ts, h.h + 1, len(h.ts))) AS ts
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, d, list_slice(ts, 1, d) AS path, len(ts) = d AS ends FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM c)),
n AS (SELECT path, d, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, COUNT(*) FILTER (WHERE ends) AS n_ends,
  sha256(COALESCE(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
  CASE WHEN d = 0 THEN 0 ELSE split_part(path[d], ':', 2)::BIGINT END AS words FROM p GROUP BY path, d),
up AS (SELECT *, list_slice(path, 1, d - 1) AS parent FROM n),
kids AS (SELECT parent, COUNT(*) AS n_children FROM up WHERE d > 0 GROUP BY parent),
anc AS (SELECT list_slice(path, 1, a) AS path, SUM(CASE WHEN n_ends = n_convs THEN 1 ELSE 0 END) AS n_leaves,
  SUM((n_convs - 1) * words) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM n) GROUP BY 1)
SELECT up.conv_id, up.d AS depth, q.conv_id AS parent_conv_id, up.n_convs, COALESCE(kids.n_children, 0) AS n_children,
  anc.n_leaves::BIGINT AS n_leaves, anc.saved_tokens::BIGINT AS saved_tokens, up.ends_sha256
FROM up LEFT JOIN n q ON up.d > 0 AND q.path = up.parent LEFT JOIN kids ON kids.parent = up.path
JOIN anc ON anc.path = up.path"""
