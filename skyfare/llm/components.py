"""Connected components of a link table by contraction.

Each round every node hooks to its first neighbour in a hashed order, parents
are followed twice, and links are rewritten between the roots reached; only
local minima remain, so the table shrinks geometrically.  Everything stays in
written tables: no links or components reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def connected(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b, both long); one root per component."""
    e = ws.table(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                              F.greatest("a", "b").alias("b")).distinct(), "links_0")
    found: DataFrame | None = None
    step = 0
    while not e.isEmpty():
        step += 1
        both = e.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
            e.select(F.col("b").alias("node"), F.col("a").alias("to")))

        def rank(c: str, step=step):
            return F.struct(F.xxhash64(F.col(c), F.lit(step)).alias("h"), F.col(c).alias("id"))

        hook = ws.table(both.groupBy("node").agg(F.min(rank("to")).alias("to"))
                        .select("node", F.least(rank("node"), F.col("to"))["id"].alias("parent")),
                        f"hook_{step}")
        for jump in (1, 2):
            up = hook.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
            hook = ws.table(hook.join(up, "parent").select("node", F.col("next").alias("parent")),
                            f"hook_{step}_{jump}")
        if found is None:
            found = hook.withColumnRenamed("parent", "root")
        else:
            found = ws.table(found.join(hook.select(F.col("node").alias("root"), "parent"), "root", "left")
                             .select("node", F.coalesce("parent", "root").alias("root")),
                             f"found_{step}")
        a = hook.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = hook.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        e = ws.table(e.join(a, "a").join(b, "b").where("pa <> pb")
                     .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                     .distinct(), f"links_{step}")
    return found if found is not None else e.select(F.col("a").alias("node"), F.col("b").alias("root"))
