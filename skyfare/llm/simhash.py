"""SimHash near-duplicates with deletion-variant signatures.

Fingerprint: 64 majority bits over the XXH64 hashes of all word shingles.  Two
fingerprints that differ in at most d bits, cut into d // 2 + 1 segments,
differ by at most one bit in some segment.  So each segment is indexed once per
bit with that bit left out, and an equality join on (bit, rest of the segment)
finds every pair; candidates are verified by their whole distance.

Inside one index bucket, everything within d bits of the bucket's smallest
fingerprint is linked to it alone (a star); only pairs with a member outside
the star are compared, each at the one bucket that is canonical for the pair.
Dense groups of near copies so cost their size, not its square, and no
connection is lost.  Exact copies share a fingerprint and are collapsed first.

Defined cases: null and empty texts have fingerprint 0 and are linked like any
other; fewer words than a shingle: the whole sequence is the shingle; null ids
never are a component id unless the whole component has none; repeated rows are
in one component; an empty table gives an empty result; very long texts are
hashed piece by piece; other columns are ignored (``drop_near_duplicates``
keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, spread
from .components import connected

BITS = 64
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class SimHash:
    words: int = 4
    seed: int = 42
    max_distance: int = 4

    def segments(self) -> list[tuple[int, int]]:
        """Bit ranges [low, high) of the segments."""
        m = self.max_distance // 2 + 1
        cuts = [BITS * i // m for i in range(m + 1)]
        return list(zip(cuts, cuts[1:]))


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces that end at white space."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            cut = _SPACE.search(data, end)
            end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def fingerprint(text: str | None, cfg: SimHash = SimHash()) -> int:
    ones, total, carry = np.zeros(BITS, dtype=np.int64), 0, []
    digest, n, seed = xxhash.xxh64_intdigest, cfg.words, cfg.seed
    for piece in _pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        words = carry + piece.split()
        if len(words) < n:
            carry = words
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h = np.array([digest(line[s:e], seed) for s, e in
                      zip(starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())], dtype="<u8")
        ones += _bit_counts(h)
        total += len(h)
        carry = words[len(words) - n + 1:] if n > 1 else []
    if total == 0 and carry:
        ones, total = _bit_counts(np.array([digest(b" ".join(carry), seed)], dtype="<u8")), 1
    return int(np.packbits((2 * ones > total).astype(np.uint8), bitorder="little").view("<u8")[0])


def _bit_counts(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, cfg: SimHash = SimHash()) -> DataFrame:
    """(doc_id, __text, fp): one row per document; __text is a hash of the text, fp a signed long."""
    d = docs.select("doc_id", F.xxhash64("text").alias("__text"), F.col("text").alias("__body"))
    out = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, __text long, fp long"

    def hashed(batches):
        for b in batches:
            f = np.array([fingerprint(t, cfg) for t in b.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(f.view(np.int64))],
                                             names=["doc_id", "__text", "fp"])

    return d.mapInArrow(hashed, out)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _by_bit(values: list[int]) -> Column:
    return F.array(*[F.lit(_signed(v)).cast("long") for v in values])


def _index(fps: DataFrame, cfg: SimHash) -> DataFrame:
    """(fp, bit, rest): every segment with one bit left out."""
    keep = [((1 << hi) - (1 << lo)) & ~(1 << b) for lo, hi in cfg.segments() for b in range(lo, hi)]
    at = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    return at.select("fp", "bit", F.col("fp").bitwiseAND(_by_bit(keep)[F.col("bit")]).alias("rest"))


def _canonical(x: Column, bit: Column, cfg: SimHash) -> Column:
    """True in exactly one of the buckets that hold a pair with difference ``x``."""
    segs = cfg.segments()
    own = _by_bit([(1 << hi) - (1 << lo) for lo, hi in segs for _ in range(lo, hi)])[bit]
    first = F.array(*[F.lit(lo) for lo, hi in segs for _ in range(lo, hi)])[bit]
    ok = (x.bitwiseAND(own) != 0) | (bit == first)
    for lo, hi in segs[:-1]:
        mask = F.lit(_signed((1 << hi) - (1 << lo))).cast("long")
        ok = ok & ((bit < hi) | (F.bit_count(x.bitwiseAND(mask)) > 1))
    return ok


def links(fps: DataFrame, ws: Workspace, cfg: SimHash = SimHash()) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all pairs within the distance."""
    fps = spread(ws.table(fps.select("fp").distinct(), "fps"))
    centres = ws.table(_index(fps, cfg).groupBy("bit", "rest")
                       .agg(F.min("fp").alias("centre")), "centres")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= cfg.max_distance
    # Spark sizes an index as if its explode kept the number of rows, 64 times too low, and a table
    # by its compressed files: both joins are by a shuffle at every size, never broadcast
    members = ws.table(_index(fps, cfg).hint("merge").join(centres, ["bit", "rest"])
                       .select("bit", "rest", "fp", "centre", near.alias("near")), "members")
    star = members.where("near AND fp <> centre").select(F.col("centre").alias("a"), F.col("fp").alias("b"))
    m = members.select(F.col("bit").alias("mbit"), F.col("rest").alias("mrest"),
                       F.col("fp").alias("b"), F.col("near").alias("mnear"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (members.where("NOT near").select("bit", "rest", F.col("fp").alias("a"))
             .join(m.hint("merge"), (F.col("bit") == F.col("mbit")) & (F.col("rest") == F.col("mrest"))
                   & (F.bit_count(x) <= cfg.max_distance) & (F.col("mnear") | (F.col("a") < F.col("b")))
                   & _canonical(x, F.col("bit"), cfg)))
    return star.union(pairs.select("a", "b"))


def near_duplicates(docs: DataFrame, ws: Workspace, cfg: SimHash = SimHash()) -> DataFrame:
    """(doc_id, __text, fp, component_id): component_id is the smallest id reachable over links."""
    f = ws.table(fingerprints(docs, cfg), "fingerprints")
    roots = connected(links(f, ws, cfg), ws)
    per_fp = f.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = ws.table(per_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                      .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    first = ws.table(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "first")
    ids = ws.table(rooted.join(first, "root").select("fp", "component_id"), "component_ids")
    return f.join(ids, "fp").select("doc_id", "__text", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, ws: Workspace, cfg: SimHash = SimHash()) -> DataFrame:
    """One document of each component stays, the one with the smallest id (of rows
    that repeat an id: the one whose text hashes lowest); all columns are kept."""
    rows = ws.table(near_duplicates(docs, ws, cfg), "rows")
    by = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                  F.col("__text").alias("text"))
    # components without any id are told apart by their fingerprints
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("anon")]
    keys = rows.groupBy("doc_id", "__text", "component_id",
                        F.when(F.col("component_id").isNull(), F.col("fp")).alias("anon")) \
               .agg(F.count(F.lit(1)).alias("n"))
    keys = ws.table(keys, "keys")
    best = ws.table(rows.groupBy(*group).agg(F.min(by).alias("best")), "best")
    # the lists grow with the documents: joined by a shuffle at every size, never broadcast
    kept = best.select(F.col("best.id").alias("kid"), F.col("best.text").alias("ktext")).hint("merge")
    same = F.col("kid").eqNullSafe(F.col("doc_id")) & (F.col("ktext") == F.col("__text"))
    out = ws.table(keys.join(kept, same, "left_anti").select(
        F.col("doc_id").alias("__id"), F.col("__text").alias("__t")), "out")
    twice = ws.table(keys.where("n > 1").join(kept, same, "left_semi").select(
        F.col("doc_id").alias("__id"), F.col("__text").alias("__t")), "twice")
    mine = F.col("__id").eqNullSafe(docs["doc_id"]) & (F.col("__t") == F.xxhash64(docs["text"]))
    left = docs.join(out.hint("merge"), mine, "left_anti")
    if twice.isEmpty():
        return left
    mine = F.col("__id").eqNullSafe(left["doc_id"]) & (F.col("__t") == F.xxhash64(left["text"]))
    once = (left.join(twice, mine, "left_semi").withColumn("__t", F.xxhash64("text"))
            .dropDuplicates(["doc_id", "__t"]).drop("__t"))
    return left.join(twice, mine, "left_anti").unionByName(once)
