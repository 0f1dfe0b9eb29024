"""Exact top-k inner-product search with a dual cover tree.

Queries and data are indexed together.  Level 1: pivots, picked farthest-first
from a bounded sample (so they are apart and cover the sample), own the vectors
nearest to them.  Level 2: the vectors of a pivot are dealt to blocks of bounded
size.  Level 3: inside a block, centres picked farthest-first own leaves.
Every node keeps its centre c and covering radius r, and no pair of a query
node (c, r) and a data node (d, s) can score more than

    <c, d> + r |d| + s |c| + r s.

Search: each query block is first scored against the data blocks of its own
pivot; that gives every query a kth score, and the block its worst.  Then block
pairs, found by joining the node tables over the pivots, are pruned against
that worst score, the rest is descended leaf by leaf with the same test, and
the best k per query remain.  Scores are whole numbers and exact; a pruned node
cannot hold a result or a tie.

Only node centres are paired; vectors move once, and query blocks move to the
data blocks they survive at, in bounded groups (a block meets its query blocks
``queries_at_once`` at a time).

Defined cases: vectors that are null, or hold null or non-finite components,
and rows without an id take no part; vectors of different length count missing
components as 0; rows that repeat id and vector count once; an id that repeats
with another vector is a candidate for each, and a query by its smallest; fewer
than k candidates give fewer rows; ties go to the smaller id; an empty table
gives an empty result; other columns are ignored.  Components of up to 2**53
after scaling and scores of up to 2**63 are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Workspace, bounded_sample_share, in_share, spread


@dataclass(frozen=True)
class CoverTree:
    k: int = 5
    pivots: int = 32
    sample: int = 2000
    block_rows: int = 2048
    leaf_rows: int = 128
    query_rows: int = 128
    queries_at_once: int = 64


def scaled(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component; null unless all components are finite."""
    x = F.transform(vector, lambda v: v.cast("double") * F.lit(float(factor)))
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v.cast("double"))
                   | (F.abs(v.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v)))


def farthest_first(points: np.ndarray, count: int) -> list[int]:
    """Positions of centres, each the point farthest from those before it."""
    if not len(points):
        return []
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return chosen


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (centres ** 2).sum(axis=1)[None, :] - 2.0 * points @ centres.T
    return d.argmin(axis=1)


def bound(qc: np.ndarray, qr: float, dc: np.ndarray, dr: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores between a query node and data nodes (rows of ``dc``)."""
    qn, dn = np.sqrt((qc ** 2).sum()), np.sqrt((dc ** 2).sum(axis=1))
    top = dc @ qc + qr * dn + dr * qn + qr * dr
    return top + 1.0 + 1e-9 * (qn + qr) * (dn + dr)  # rounding never prunes


# ---- index -------------------------------------------------------------------

NODE = "pivot int, block long, n int, centre array<double>, radius double"


def _blocks(vectors: DataFrame, rows: int, leaf_rows: int, ws: Workspace, name: str) -> DataFrame:
    """One row per block of ``vectors`` (pivot, vec_id, v): node columns, ids, vectors, leaves."""
    sizes = vectors.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("long").alias("parts"))
    sizes = ws.table(sizes, f"{name}_sizes")
    dealt = (vectors.join(sizes, "pivot")
             .withColumn("block", F.col("pivot") * F.lit(1 << 32).cast("long")
                         + F.pmod(F.xxhash64("vec_id"), F.col("parts"))))

    def build(f: pd.DataFrame) -> pd.DataFrame:
        f = f.assign(raw=[np.asarray(v, dtype="<i8").tobytes() for v in f["v"]])
        f = f.drop_duplicates(["vec_id", "raw"]).sort_values(["vec_id", "raw"])
        ids = f["vec_id"].to_numpy(dtype="<i8")
        v = np.frombuffer(b"".join(f["raw"]), dtype="<i8").reshape(len(f), -1)
        x = v.astype(np.float64)
        centre = x.mean(axis=0)
        picks = farthest_first(x, -(-len(x) // leaf_rows))
        leaf = _nearest(x, x[picks])
        order = np.argsort(leaf, kind="stable")
        ids, v, x, leaf = ids[order], v[order], x[order], leaf[order]
        cuts = np.searchsorted(leaf, np.arange(len(picks) + 1)).astype("<i4")
        centres = np.stack([x[a:b].mean(axis=0) if b > a else centre for a, b in zip(cuts, cuts[1:])])
        radii = np.array([np.sqrt(((x[a:b] - c) ** 2).sum(axis=1).max()) if b > a else 0.0
                          for a, b, c in zip(cuts, cuts[1:], centres)])
        return pd.DataFrame({
            "pivot": [int(f["pivot"].iloc[0])], "block": [int(f["block"].iloc[0])], "n": [len(ids)],
            "centre": [centre.tolist()], "radius": [float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))],
            "ids": [ids.tobytes()], "vectors": [v.tobytes()], "cuts": [cuts.tobytes()],
            "centres": [centres.astype("<f8").tobytes()], "radii": [radii.astype("<f8").tobytes()]})

    out = NODE + ", ids binary, vectors binary, cuts binary, centres binary, radii binary"
    return ws.table(dealt.select("pivot", "block", "vec_id", "v").groupBy("block").applyInPandas(build, out), name)


def _pivots(vectors: DataFrame, cfg: CoverTree) -> np.ndarray:
    share = bounded_sample_share(vectors.count(), cfg.sample)
    rows = vectors.where(in_share(F.col("vec_id"), F.lit(share))).select("vec_id", "v").collect()
    if not rows:
        rows = vectors.select("vec_id", "v").limit(1).collect()
    points = np.array([r["v"] for r in sorted(rows)], dtype=np.float64)
    return points[farthest_first(points, cfg.pivots)] if len(points) else points


def _owned(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot."""
    def own(frames):
        for f in frames:
            x = np.array(f["v"].tolist(), dtype=np.float64).reshape(len(f), -1)
            yield pd.DataFrame({"pivot": _nearest(x, pivots).astype("int32"), "vec_id": f["vec_id"], "v": f["v"]})

    return vectors.mapInPandas(own, "pivot int, vec_id long, v array<long>")


# ---- search ------------------------------------------------------------------


def _unpack(row) -> dict:
    n = int(row.n)
    radii = np.frombuffer(row.radii, dtype="<f8")
    return {"ids": np.frombuffer(row.ids, dtype="<i8"),
            "v": np.frombuffer(row.vectors, dtype="<i8").reshape(n, -1),
            "cuts": np.frombuffer(row.cuts, dtype="<i4"), "radii": radii,
            "centres": np.frombuffer(row.centres, dtype="<f8").reshape(len(radii), -1)}


def scores_of(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Exact whole inner products, queries x data."""
    most = (float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0))) * max(1, q.shape[1])
    if most < 2.0 ** 53:
        return (q.astype(np.float64) @ d.T.astype(np.float64)).astype(np.int64)
    return np.einsum("qk,dk->qd", q, d)


LEAST = -(1 << 63)


def _best(ids: np.ndarray, s: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of every row; the row's own id never counts (score LEAST)."""
    s = np.where(ids == own[:, None], LEAST, s)
    order = _order(ids, s)[:, :k]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(s, order, axis=1)


def _order(ids: np.ndarray, s: np.ndarray) -> np.ndarray:
    by_id = np.argsort(ids, axis=1, kind="stable")
    down = ~np.take_along_axis(s, by_id, axis=1)  # ~s reverses the order of whole numbers
    return np.take_along_axis(by_id, np.argsort(down, axis=1, kind="stable"), axis=1)


def descend(q: dict, qc: np.ndarray, qr: float, floor: np.ndarray, d: dict, k: int):
    """The best k of data block ``d`` for every query of ``q`` that can matter.

    ``floor``: a score that each query already reaches k times (LEAST if none).
    Leaves are taken best bound first, until no bound reaches the worst kth score."""
    m = len(q["ids"])
    ids, s = np.full((m, k), -1, dtype=np.int64), np.full((m, k), LEAST, dtype=np.int64)
    tops = bound(qc, qr, d["centres"], d["radii"])
    for leaf in np.argsort(-tops, kind="stable"):
        worst = np.maximum(floor, s[:, -1]).min()
        if tops[leaf] < worst:
            break
        a, b = d["cuts"][leaf], d["cuts"][leaf + 1]
        if a == b:
            continue
        new = scores_of(q["v"], d["v"][a:b])
        both = np.concatenate([ids, np.broadcast_to(d["ids"][a:b], new.shape)], axis=1)
        ids, s = _best(both, np.concatenate([s, new], axis=1), q["ids"], k)
    return ids, s


def _search(pairs: DataFrame, queries: DataFrame, data: DataFrame, ws: Workspace, name: str,
            cfg: CoverTree) -> DataFrame:
    """Best rows of every (query block, data block) pair: qblock, query_id, vec_id, score.

    ``queries`` carries ``floor`` (binary, a score per query)."""
    part = F.pmod(F.xxhash64("qblock"), F.col("parts"))
    load = ws.table(pairs.groupBy("dblock").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(cfg.queries_at_once)).cast("long").alias("parts")), f"{name}_load")
    left = (pairs.join(load, "dblock").join(queries.withColumnRenamed("block", "qblock"), "qblock")
            .select("dblock", part.alias("part"), "qblock", "n", "centre", "radius", "floor",
                    "ids", "vectors", "cuts", "centres", "radii"))
    right = (data.withColumnRenamed("block", "dblock").join(load, "dblock")
             .select("dblock", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                     "n", "ids", "vectors", "cuts", "centres", "radii"))
    k = cfg.k

    def meet(qs: pd.DataFrame, ds: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 4), dtype=np.int64)]
        for d in map(_unpack, ds.itertuples()):
            for row in qs.itertuples():
                q = _unpack(row)
                floor = np.frombuffer(row.floor, dtype="<i8")
                ids, s = descend(q, np.array(row.centre), float(row.radius), floor, d, k)
                ok = (s > LEAST) & (s >= floor[:, None])
                out.append(np.stack([np.full(ok.sum(), row.qblock, dtype=np.int64),
                                     np.repeat(q["ids"], ok.sum(axis=1)), ids[ok], s[ok]], axis=1))
        return pd.DataFrame(np.concatenate(out), columns=["qblock", "query_id", "vec_id", "score"])

    found = (left.groupBy("dblock", "part").cogroup(right.groupBy("dblock", "part"))
             .applyInPandas(meet, "qblock long, query_id long, vec_id long, score long"))
    return ws.table(found, name)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, ws: Workspace, cfg: CoverTree = CoverTree()) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query.

    ``vectors``: vec_id, v (array of whole numbers, null to leave the row out);
    ``queries``: condition that marks the query rows.  Candidates are all rows but
    those with the query's id."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v", queries.alias("q")) \
               .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    v = ws.table(spread(v), "vectors")
    dims = v.agg(F.max(F.size("v"))).first()[0]
    empty = "query_id long, rank int, vec_id long, score long"
    if dims is None:
        return v.sparkSession.createDataFrame([], empty)
    dims = max(1, dims)
    pad = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v")))
    v = v.withColumn("v", pad)
    pivots = _pivots(v, cfg)
    owned = ws.table(_owned(v.select("vec_id", "v"), pivots), "owned")
    data = _blocks(owned, cfg.block_rows, cfg.leaf_rows, ws, "data")
    asked = v.where("q").groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = _owned(asked, pivots)
    asked = _blocks(ws.table(asked, "asked"), cfg.query_rows, cfg.query_rows, ws, "query_blocks")

    @F.pandas_udf("binary")
    def none(n: pd.Series) -> pd.Series:
        return n.map(lambda x: np.full(x, LEAST, dtype="<i8").tobytes())

    qnode = asked.select(F.col("pivot").alias("qpivot"), F.col("block").alias("qblock"),
                         F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    dnode = data.select(F.col("pivot").alias("dpivot"), F.col("block").alias("dblock"),
                        F.col("centre").alias("dc"), F.col("radius").alias("dr"))
    near = qnode.join(dnode, F.col("qpivot") == F.col("dpivot")).select("qblock", "dblock")
    first = _search(near, asked.withColumn("floor", none("n")), data, ws, "near", cfg)
    kth = (_ranked(first, cfg.k).groupBy("query_id").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n"))
           .select("query_id", F.when(F.col("n") >= cfg.k, F.col("s")).otherwise(F.lit(LEAST)).alias("s")))
    floors = _with_floors(asked, first, kth, ws)

    # node pairs: every pivot with every pivot, then the blocks under them
    count = len(pivots)
    pairs = v.sparkSession.range(count * count).select(
        (F.col("id") / count).cast("int").alias("qpivot"), (F.col("id") % count).cast("int").alias("dpivot"))
    worst = floors.select(F.col("block").alias("qblock"), "worst")
    dot = F.aggregate(F.zip_with("qc", "dc", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)

    def norm(c: str) -> Column:
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))

    top = (dot + F.col("qr") * norm("dc") + F.col("dr") * norm("qc") + F.col("qr") * F.col("dr")
           + 1.0 + F.lit(1e-9) * (norm("qc") + F.col("qr")) * (norm("dc") + F.col("dr")))
    open_pairs = (pairs.where("qpivot <> dpivot").join(qnode, "qpivot").join(dnode, "dpivot")
                  .join(worst, "qblock").where(top >= F.col("worst")).select("qblock", "dblock"))
    rest = _search(ws.table(open_pairs, "open_pairs"), floors.drop("worst"), data, ws, "rest", cfg)
    return _ranked(first.union(rest), cfg.k).select("query_id", "rank", "vec_id", "score")


def _with_floors(asked: DataFrame, first: DataFrame, kth: DataFrame, ws: Workspace) -> DataFrame:
    """Query blocks with ``floor`` (kth score so far of every query) and ``worst`` (their least)."""
    of = first.select("qblock", "query_id").distinct().join(kth, "query_id")
    per = of.groupBy(F.col("qblock").alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct("query_id", "s"))).alias("known"))

    @F.pandas_udf("binary")
    def lay(ids: pd.Series, known: pd.Series) -> pd.Series:
        out = []
        for i, have in zip(ids, known):
            have = dict(have) if have is not None else {}
            out.append(np.array([have.get(x, LEAST) for x in np.frombuffer(i, dtype="<i8").tolist()],
                                dtype="<i8").tobytes())
        return pd.Series(out)

    @F.pandas_udf("double")
    def least(floor: pd.Series) -> pd.Series:
        return pd.Series([float(np.frombuffer(f, dtype="<i8").min()) for f in floor])

    held = ws.table(asked.join(per, "block", "left").withColumn("floor", lay("ids", "known")).drop("known"),
                    "floored")
    return ws.table(held.withColumn("worst", least("floor")), "floors")
