"""Benchmark decontamination: spaced-seed hashing.

Texts become tokens (lower case, runs of letters and digits; in scripts without
spaces every letter is a token).  A mask is a
fixed 0/1 pattern over consecutive tokens; the tokens at its 1s are hashed, so
a substituted word under a 0 does not change the hash.  Every mask is laid at
every token of every benchmark item (the index) and of every document; equal
hashes are hits.  The masks are chosen so that every alignment with at least
``min_match`` equal tokens has a hit, by enumeration of all places of the unequal
tokens (2 of 11, 3 of 15 and 4 of 20; the other lengths hold one of these).  A hit fixes how document and item align; it counts when some
aligned stretch of ``verify_tokens`` tokens (the whole item if shorter) that
holds the hit has at least ``min_match`` equal tokens.  Items with fewer tokens
than the longest mask get masks over their whole length, chosen greedily so that
any allowed number of unequal tokens falls under the 0s of one of them
(``short_masks``; up to four tokens none may differ).  They are laid at every token
of a document, for the lengths that such items have.

Defined cases: null and empty texts match nothing; repeated rows
each get their verdict, repeated items add nothing, a text under several ids is
looked for once and reported for each; items without an id count
like others; an empty benchmark leaves every document clean; null ids of
documents are carried through; other columns are ignored
(``remove_contaminated`` keeps them).

Plan: masks are hashed inside one generated stage over (document, position), no
text or token leaves the scan.  The index goes to every executor only while
its counted rows stay within ``max_broadcast``; beyond that positions and index
are joined by a shuffle on the hash and only hits go back to their documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

#: Four spaced masks of weight 6 that leave no alignment of 11 tokens or more without a hit.
MASKS = ("1111011", "110010111", "11000100111", "11111000001")


@dataclass(frozen=True)
class Seeds:
    masks: tuple = MASKS
    verify_tokens: int = 20
    min_match: float = 0.8
    max_broadcast: int = 1_000_000

    @property
    def span(self) -> int:
        return max(len(m) for m in self.masks)

    @property
    def shortest(self) -> int:
        return min(len(m) for m in self.masks)


#: Letters of scripts that set no spaces between words.
UNSPACED = (r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
            "\u30fc\uff70]")


def token_hashes(text: Column) -> Column:
    """Array of 64-bit token hashes of a text; empty for null."""
    body = F.lower(F.coalesce(text, F.lit("")))
    body = F.when(body.rlike(UNSPACED), F.regexp_replace(body, f"({UNSPACED})", " $1 ")).otherwise(body)
    words = F.array_remove(F.split(body, r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


@lru_cache(maxsize=None)
def short_masks(length: int, min_match: float, weight: int = 6) -> tuple:
    """Masks over all ``length`` tokens of a short item, of at most ``weight`` 1s where
    that many may be left out, that together miss no allowed set of unequal tokens."""
    allowed = int(length * (1 - min_match) + 1e-9)
    if not allowed:
        return ("1" * length,)
    left = set(combinations(range(length), allowed))
    choices = [frozenset(c) for c in combinations(range(length), max(allowed, length - weight))]
    masks = []
    while left:
        zeros = max(choices, key=lambda z: sum(z.issuperset(c) for c in left))
        left = {c for c in left if not zeros.issuperset(c)}
        masks.append("".join("0" if i in zeros else "1" for i in range(length)))
    return tuple(masks)


def _short_keys(pos: Column, length: int, cfg: Seeds) -> list[Column]:
    """Hashes of a short item's masks at ``pos``."""
    return [F.xxhash64(F.lit(-length), F.lit(i), *[F.get("__h", pos + F.lit(o)) for o, bit in enumerate(m) if bit == "1"])
            for i, m in enumerate(short_masks(length, cfg.min_match))]


def masked_positions(df: DataFrame, keep: list[str], cfg: Seeds, lengths: tuple = ()) -> DataFrame:
    """One row per mask, those of short items of ``lengths`` tokens too, and token position: ``keep``, __pos, __key."""
    # a short item may reach over a text's ends by as many tokens as may differ
    over = max((int(k * (1 - cfg.min_match) + 1e-9) for k in lengths), default=0)
    n, least = F.size("__h"), min([cfg.shortest, *lengths])
    last = n - F.lit(least) + over
    at = df.withColumn("__pos", F.explode(F.when(last >= -over, F.sequence(F.lit(-over), last))
                                          .otherwise(F.array().cast("array<int>"))))
    pos = F.col("__pos")
    keys = [F.when((pos >= 0) & (pos + len(m) <= n), F.xxhash64(F.lit(i), *[F.get("__h", pos + o)
                                                                            for o, bit in enumerate(m) if bit == "1"]))
            for i, m in enumerate(cfg.masks)]
    keys += [F.when(pos + k <= n + over, key) for k in lengths for key in _short_keys(pos, k, cfg)]
    return (at.select(*keep, "__pos", F.explode(F.array(*keys)).alias("__key"))
            .where(F.col("__key").isNotNull()))


def _overlap(doc: Column, item: Column, item_at: Column, cfg: Seeds) -> Column:
    """Most equal tokens in an aligned stretch that holds the hit, over its length.

    ``doc[i]`` is the document token that faces ``item[i]``; entries before the
    document are null, those after it are missing."""
    v = F.least(F.lit(cfg.verify_tokens), F.size(item))
    first = F.greatest(F.lit(0), F.least(item_at + F.lit(cfg.shortest), F.size(item)) - v)
    last = F.least(item_at, F.size(item) - v)

    def equal(w: Column) -> Column:
        same = F.zip_with(F.slice(item, w + 1, v), F.slice(doc, w + 1, v),
                          lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
        return F.aggregate(same, F.lit(0), lambda s, x: s + x)

    best = F.aggregate(F.transform(F.sequence(first, F.greatest(first, last)), equal),
                       F.lit(0), lambda s, x: F.greatest(s, x))
    return best / v


def _aligned(doc: Column, start: Column, length: Column) -> Column:
    """``length`` document tokens from (possibly negative) ``start``; nulls before the document."""
    pad = F.greatest(F.lit(0), -start)
    body = F.slice(doc, F.greatest(start, F.lit(0)) + 1, F.greatest(length - pad, F.lit(0)))
    return F.when(pad > 0, F.concat(F.array_repeat(F.lit(None).cast("long"), pad), body)).otherwise(body)


def _index(benchmark: DataFrame, cfg: Seeds, ws: Workspace) -> tuple[DataFrame, DataFrame, DataFrame, tuple]:
    """(distinct token sequences (__ikey, __h), their ids (__ikey, __item), index rows (__key, __ikey,
    __ipos, __ilen), token counts of the items too short for the masks)."""
    named = ws.table(
        benchmark.select(F.col("item_id").alias("__item"), token_hashes(F.col("text")).alias("__h"))
        .where(F.size("__h") > 0).select("__item", "__h", F.xxhash64("__h").alias("__ikey"))
        .dropDuplicates(["__item", "__ikey"]), "items")
    items = ws.table(named.select("__ikey", "__h").dropDuplicates(["__ikey"]), "sequences")
    sized = items.withColumn("__ilen", F.size("__h"))
    brief = sized.where(F.col("__ilen") < cfg.span)
    lengths = tuple(sorted(r["__ilen"] for r in brief.select("__ilen").distinct().collect()))
    columns = ["__key", "__ikey", "__ilen", F.col("__pos").alias("__ipos")]
    index = masked_positions(sized.where(F.col("__ilen") >= cfg.span), ["__ikey", "__ilen", "__h"], cfg).select(columns)
    for k in lengths:
        index = index.union(brief.where(F.col("__ilen") == k).withColumn("__pos", F.lit(0))
                            .withColumn("__key", F.explode(F.array(*_short_keys(F.lit(0), k, cfg)))).select(columns))
    return items, named.select("__ikey", "__item"), index, lengths


def find_leaks(docs: DataFrame, benchmark: DataFrame, ws: Workspace,
               cfg: Seeds = Seeds()) -> DataFrame:
    """Verified (document, item) overlaps: __doc, __text (hash), __item, __match, __hits."""
    items, ids, index, lengths = _index(benchmark, cfg, ws)
    index = ws.table(index, "index")
    d = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text"),
                    token_hashes(F.col("text")).alias("__h"))
    small = index.count() <= cfg.max_broadcast
    if small:
        at = masked_positions(d, ["__doc", "__text", "__h"], cfg, lengths)
        hits = (at.join(F.broadcast(index), "__key")
                .select("__doc", "__text", "__ikey", "__ipos",
                        _aligned(F.col("__h"), F.col("__pos") - F.col("__ipos"), F.col("__ilen"))
                        .alias("__d"))
                .join(F.broadcast(items.select("__ikey", F.col("__h").alias("__i"))), "__ikey"))
    else:
        at = masked_positions(d, ["__doc", "__text"], cfg, lengths)
        found = ws.table(at.join(index, "__key")
                         .select("__doc", "__text", "__ikey", "__ilen", "__ipos",
                                 (F.col("__pos") - F.col("__ipos")).alias("__start")), "found")
        back = (d.dropDuplicates(["__doc", "__text"])
                .withColumnRenamed("__doc", "__doc2").withColumnRenamed("__text", "__text2"))
        hits = (found.join(back, (F.col("__text") == F.col("__text2"))
                           & F.col("__doc").eqNullSafe(F.col("__doc2")))
                .select("__doc", "__text", "__ikey", "__ipos",
                        _aligned(F.col("__h"), F.col("__start"), F.col("__ilen")).alias("__d"))
                .join(items.select("__ikey", F.col("__h").alias("__i")), "__ikey"))
    scored = hits.select("__doc", "__text", "__ikey",
                         _overlap(F.col("__d"), F.col("__i"), F.col("__ipos"), cfg)
                         .alias("__match"))
    found = (scored.where(F.col("__match") >= cfg.min_match).groupBy("__doc", "__text", "__ikey")
             .agg(F.max("__match").alias("__match"), F.count(F.lit(1)).alias("__hits")))
    return ws.table(found.join(ids, "__ikey").drop("__ikey"), "leaks")


def _per_document(leaks: DataFrame, ws: Workspace) -> DataFrame:
    return ws.table(leaks.groupBy("__doc", "__text").agg(
        F.count(F.lit(1)).alias("__items"), F.min("__item").alias("__first"),
        F.max("__match").alias("__match"), F.sum("__hits").alias("__hits")), "per_document")


def _same_row(doc: Column, text: Column) -> Column:
    return F.col("__doc").eqNullSafe(doc) & (F.col("__text") == F.xxhash64(text))


def decontaminate(docs: DataFrame, benchmark: DataFrame, ws: Workspace,
                  cfg: Seeds = Seeds()) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, first_item, best_match, n_hits."""
    per = _per_document(find_leaks(docs, benchmark, ws, cfg), ws)
    d = docs.select("doc_id", F.xxhash64("text").alias("__t"))
    return (d.join(per, F.col("__doc").eqNullSafe(F.col("doc_id")) & (F.col("__text") == F.col("__t")),
                   "left")
            .select("doc_id", F.col("__items").isNotNull().alias("contaminated"),
                    F.coalesce("__items", F.lit(0)).cast("long").alias("n_items"),
                    F.col("__first").alias("first_item"),
                    F.coalesce("__match", F.lit(0.0)).alias("best_match"),
                    F.coalesce("__hits", F.lit(0)).cast("long").alias("n_hits")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, ws: Workspace,
                        cfg: Seeds = Seeds()) -> DataFrame:
    """The documents without a verified overlap, all columns kept."""
    per = _per_document(find_leaks(docs, benchmark, ws, cfg), ws)
    return docs.join(per.select("__doc", "__text"),
                     _same_row(docs["doc_id"], docs["text"]), "left_anti")
