"""Mixing sources to target weights: hierarchical token budgets.

Documents hang in a tree domain > language > source.  The total budget is
poured from the root: every node gets its share by weight among its siblings,
but never more than its subtree can give (its tokens times ``max_epochs``).
What a short node cannot use goes to its siblings first, by their weights;
only what a whole subtree cannot use reaches the parent's siblings, because a
subtree's capacity is the sum of its leaves.  All shares are whole tokens.

A leaf with budget b and s tokens takes b div s whole epochs and, from one more
epoch, the documents in seeded order (md5 of seed, epoch and id) up to b mod s
tokens: the prefix ends before the document that would exceed it.  The end of
the prefix is found by descending the hexadecimal digits of the order key with
partial sums, so no task ever sorts a leaf.

Defined cases: null language or source is a node of its own ('(none)'); null
text has 0 tokens, and a leaf without tokens gives nothing; null ids are
ordered by the md5 of their text; rows that repeat an id stand or fall
together; an empty table gives an empty result; other columns are ignored
(``mix_documents`` keeps them).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Workspace

LEAF = ["__domain", "__lang", "__source"]


@dataclass(frozen=True)
class Mix:
    """Whole-number target weights by node name; nodes without one weigh ``default_weight``."""

    budget_share: float = 0.8
    max_epochs: int = 2
    seed: str = "mix"
    default_weight: int = 1
    domain_weights: dict = field(default_factory=dict)
    lang_weights: dict = field(default_factory=lambda: {"en": 4, "de": 2, "fr": 2, "es": 2})
    source_weights: dict = field(default_factory=dict)
    domain_chars: int = 4

    def weights(self, level: int) -> dict:
        return (self.domain_weights, self.lang_weights, self.source_weights)[level]


def n_tokens(text: Column) -> Column:
    """Words of a text: runs without ASCII white space."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def tree_columns(cfg: Mix) -> list[Column]:
    """Domain (the first characters of the source name), language and source of a row."""
    source = F.coalesce("source", F.lit("(none)"))
    return [F.substring(source, 1, cfg.domain_chars).alias("__domain"),
            F.coalesce("lang", F.lit("(none)")).alias("__lang"), source.alias("__source")]


def _id(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def order_key(row_id: Column, epoch: Column, cfg: Mix) -> Column:
    return F.md5(F.concat_ws("|", F.lit(cfg.seed), epoch.cast("string"), row_id).cast("binary"))


def _weight(name: Column, weights: dict, default: int) -> Column:
    w = F.lit(default)
    for k, v in weights.items():
        w = F.when(name == k, F.lit(v)).otherwise(w)
    return w.cast("decimal(38,0)")


def _pour(nodes: DataFrame, parents: list[str], child: str, weights: dict, default: int) -> DataFrame:
    """``nodes``: parents, child, cap, total (budget of the parent); adds the child's ``budget``."""
    part = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    order = part.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), child)
    dec = "decimal(38,0)"
    n = (nodes.withColumn("w", _weight(F.col(child), weights, default))
         .withColumn("used", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)),
                                        F.lit(0)).cast(dec))
         .withColumn("w_rest", F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)).cast(dec))
         .withColumn("full", F.expr("cap * w_rest <= w * (total - used)")))
    n = (n.withColumn("spent", F.coalesce(F.sum(F.expr("CASE WHEN full THEN cap END")).over(part),
                                          F.lit(0)).cast(dec))
         .withColumn("w_open", F.sum(F.expr("CASE WHEN NOT full THEN w END")).over(part).cast(dec)))
    return n.withColumn("budget", F.expr(
        "CASE WHEN full THEN CAST(cap AS BIGINT) ELSE w * (total - spent) div w_open END"))


def leaf_budgets(leaves: DataFrame, ws: Workspace, cfg: Mix) -> DataFrame:
    """``leaves``: the tree columns and ``supply``; adds epochs (whole) and rest (tokens of one more)."""
    dec = "decimal(38,0)"
    leaves = leaves.withColumn("cap", (F.col("supply") * cfg.max_epochs).cast(dec))
    total = leaves.agg(F.floor(F.coalesce(F.sum("supply"), F.lit(0)) * F.lit(cfg.budget_share))
                       .cast(dec).alias("t")).scalar()
    budget: DataFrame | None = None
    for level, child in enumerate(LEAF):
        up = LEAF[:level]
        nodes = leaves.groupBy(*LEAF[:level + 1]).agg(F.sum("cap").cast(dec).alias("cap"))
        nodes = (nodes.withColumn("total", F.least(F.sum("cap").over(W.partitionBy(F.lit(0))), total).cast(dec))
                 if budget is None else
                 nodes.join(budget.select(*up, F.col("budget").cast(dec).alias("total")), up))
        budget = ws.table(_pour(nodes, up, child, cfg.weights(level), cfg.default_weight)
                          .select(*LEAF[:level + 1], "budget"), f"budget_{level}")
    return (leaves.join(budget, LEAF).where("supply > 0")
            .select(*LEAF, "supply", "budget", F.expr("budget div supply").alias("epochs"),
                    F.expr("budget % supply").alias("rest")))


def selection_plan(rows: DataFrame, ws: Workspace, cfg: Mix) -> DataFrame:
    """One row per leaf: tree columns, __epochs, __last_key (end of the partial epoch, null without one).

    ``rows``: tree columns, __id, __tokens."""
    leaves = ws.table(rows.groupBy(*LEAF).agg(F.sum("__tokens").alias("supply")), "leaves")
    budgets = ws.table(leaf_budgets(leaves, ws, cfg), "budgets")
    at = budgets.where("rest > 0").select(*LEAF, "epochs", "rest", F.lit(0).cast("long").alias("before"),
                                          F.lit("").alias("prefix"))
    keyed = order_key(F.col("__id"), F.col("epochs"), cfg)

    def inside(plan: DataFrame) -> DataFrame:
        return (rows.join(plan, LEAF).withColumn("key", keyed)
                .where(F.col("key").startswith(F.col("prefix"))))

    part = W.partitionBy(*LEAF)
    for digits in (2, 4):
        sums = (inside(at).groupBy(*LEAF, "epochs", "rest", "before",
                                   F.substring("key", 1, digits).alias("next"))
                .agg(F.sum("__tokens").alias("t")))
        sums = sums.withColumn("upto", F.col("before") + F.sum("t").over(part.orderBy("next")))
        at = ws.table(sums.where("upto > rest AND upto - t <= rest")
                      .select(*LEAF, "epochs", "rest", (F.col("upto") - F.col("t")).alias("before"),
                              F.col("next").alias("prefix")), f"prefix_{digits}")
    upto = F.col("before") + F.sum("__tokens").over(
        part.orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow))
    last = (inside(at).withColumn("upto", upto).where("upto <= rest")
            .groupBy(*LEAF).agg(F.max("key").alias("last")))
    ends = at.join(last, LEAF, "left").select(*LEAF, F.coalesce("last", "prefix").alias("last_key"))
    return ws.table(budgets.join(ends, LEAF, "left").select(
        *LEAF, F.col("epochs").alias("__epochs"), F.col("last_key").alias("__last_key")), "plan")


def _copies(cfg: Mix) -> Column:
    """How many epochs take the row, given its leaf's plan."""
    partial = F.coalesce(order_key(F.col("__id"), F.col("__epochs"), cfg) <= F.col("__last_key"), F.lit(False))
    return (F.col("__epochs") + partial.cast("int")).cast("int")


def mix(docs: DataFrame, ws: Workspace, cfg: Mix = Mix()) -> DataFrame:
    """One row per selected document and epoch: doc_id, domain, lang, source, epoch, n_tokens."""
    rows = ws.table(docs.select("doc_id", *tree_columns(cfg), _id(F.col("doc_id"), F.col("text")).alias("__id"),
                                n_tokens(F.col("text")).alias("__tokens")), "rows")
    plan = selection_plan(rows, ws, cfg)
    return (rows.join(plan, LEAF).withColumn("__n", _copies(cfg)).where("__n > 0")
            .select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"),
                    F.col("__source").alias("source"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n").cast("long") - 1)).alias("epoch"),
                    F.col("__tokens").alias("n_tokens")))


def mix_documents(docs: DataFrame, ws: Workspace, cfg: Mix) -> DataFrame:
    """The selected documents with all their columns, repeated once per epoch that takes them."""
    tree = docs.withColumns(dict(zip(LEAF, tree_columns(cfg)))).withColumn(
        "__id", _id(F.col("doc_id"), F.col("text")))
    rows = ws.table(tree.select(*LEAF, "__id", n_tokens(F.col("text")).alias("__tokens")), "rows")
    plan = selection_plan(rows, ws, cfg)
    mine = [tree[c] == plan[c] for c in LEAF]
    chosen = tree.join(plan, mine).withColumn("__n", _copies(cfg)).where("__n > 0")
    if cfg.max_epochs > 1:
        chosen = chosen.withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return chosen.select(*[docs[c] for c in docs.columns])


def _pour_sql(name: str, nodes: str, up: list[str], child: str, weights: dict, default: int) -> str:
    part = f"PARTITION BY {', '.join(up)}" if up else ""
    w = "CASE " + " ".join(f"WHEN {child} = '{k}' THEN {v}" for k, v in weights.items()) + \
        f" ELSE {default} END" if weights else f"{default}"
    cols = ", ".join([*up, child])
    return f"""
{name}_w AS (SELECT *, CAST({w} AS HUGEINT) AS w FROM ({nodes})),
{name}_u AS (SELECT *, COALESCE(SUM(cap) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / w, {child}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS used,
  SUM(w) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / w, {child}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS w_rest FROM {name}_w),
{name}_f AS (SELECT *, cap * w_rest <= w * (total - used) AS full_ FROM {name}_u),
{name} AS (SELECT {cols}, CASE WHEN full_ THEN cap ELSE w * (total
    - COALESCE(SUM(CASE WHEN full_ THEN cap END) OVER ({part}), 0)::HUGEINT)
    // (SUM(CASE WHEN NOT full_ THEN w END) OVER ({part}))::HUGEINT END AS budget FROM {name}_f)"""


def mix_sql(cfg: Mix = Mix()) -> str:
    d, la, s = "domain", "lang", "source"
    weights = [cfg.weights(i) for i in range(3)]
    return f"""
WITH t AS (SELECT doc_id, substr(COALESCE(source, '(none)'), 1, {cfg.domain_chars}) AS domain,
    COALESCE(lang, '(none)') AS lang, COALESCE(source, '(none)') AS source,
    COALESCE(CAST(doc_id AS VARCHAR), md5(COALESCE(text, ''))) AS id,
    CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, SUM(n_tokens)::HUGEINT AS supply,
    SUM(n_tokens)::HUGEINT * {cfg.max_epochs} AS cap FROM t GROUP BY ALL),
tot AS (SELECT FLOOR(COALESCE(SUM(supply), 0)::BIGINT * {cfg.budget_share}::DOUBLE)::HUGEINT AS total FROM leaf),
{_pour_sql('b0', "SELECT domain, SUM(cap)::HUGEINT AS cap, LEAST(ANY_VALUE(total), SUM(SUM(cap)) OVER ())::HUGEINT AS total FROM leaf, tot GROUP BY domain", [], d, weights[0], cfg.default_weight)},
{_pour_sql('b1', "SELECT domain, lang, SUM(cap)::HUGEINT AS cap, ANY_VALUE(budget)::HUGEINT AS total FROM leaf JOIN b0 USING (domain) GROUP BY domain, lang", [d], la, weights[1], cfg.default_weight)},
{_pour_sql('b2', "SELECT domain, lang, source, cap, budget::HUGEINT AS total FROM leaf JOIN b1 USING (domain, lang)", [d, la], s, weights[2], cfg.default_weight)},
p AS (SELECT domain, lang, source, CAST(budget // supply AS BIGINT) AS epochs, budget % supply AS rest
  FROM leaf JOIN b2 USING (domain, lang, source) WHERE supply > 0),
k AS (SELECT t.*, epochs, rest, md5('{cfg.seed}|' || epochs || '|' || id) AS key FROM t JOIN p USING (domain, lang, source)),
c AS (SELECT *, epochs + CASE WHEN rest > 0 AND SUM(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) <= rest
  THEN 1 ELSE 0 END AS n FROM k)
SELECT doc_id, domain, lang, source, unnest(range(0, n)) AS epoch, n_tokens FROM c WHERE n > 0"""
