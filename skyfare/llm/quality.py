"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document is measured once (words, word size, symbols, repeated lines,
words in repeated eight-word windows).  Each measure feeds a quantile sketch per
language and source: a histogram whose bins keep the top eight bits of an
integer, so a quantile is off by less than 1/128 of its value and two sketches
merge by adding counts.  Merging over sources gives the language's sketch,
merging over languages the corpus's.  Fences follow from the 10th, 50th and
90th percentile (``high = q90 + spread * (q90 - q50) + slack``, likewise low);
a group's fence is drawn towards its language's, and that towards the corpus's,
as if ``prior`` documents of the parent had been seen, so small groups need no
switch.  Documents then meet their group's fences by one join.

The base verdict is fixed: fewer than ``min_words`` words, or over
``max_repeat_pct`` percent of the words in repeated windows.

Defined cases: null text counts as empty (no words, base failed); a null
language or source is a group of its own; documents without a word are in no
sketch; repeated rows are measured, counted and returned each; a fence is met by
equality (ties pass); an empty table gives an empty result; other columns are
ignored.  Two different windows of one text are told apart by a 64-bit hash.

Everything is DataFrame expressions.  Texts never move: only counts per bin
leave the scan, partially aggregated, so a hot source costs its bins.  The
fences have one row per language and source and are joined as Spark sees fit by
their written size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Workspace

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8

#: measure -> (low fence used, high fence used, slack); ratios are per thousand
#: words or lines, word_size in hundredths of a code point.  The slack is the room left
#: where most documents of a group measure alike (half a symbol a word, three lines in
#: ten, one word in ten, one code point).
MEASURES = {
    "words": (True, False, 0),
    "word_size": (True, True, 100),
    "symbols": (False, True, 500),
    "dup_lines": (False, True, 300),
    "repeats": (False, True, 100),
}


@dataclass(frozen=True)
class Quality:
    min_words: int = 20
    max_repeat_pct: int = 30
    spread: int = 4
    prior: int = 100


# ---- measures ----------------------------------------------------------------


def _chained(hashes: Column, step: int) -> Column:
    """Hashes of twice the length: each with the one ``step`` places on."""
    return F.zip_with(hashes, F.slice(hashes, F.lit(step + 1), F.size(hashes)),
                      lambda a, b: F.xxhash64(a, b))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every document's whole text."""
    t = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                    F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    d = (t.select("doc_id", "lang", "source",
                  F.array_remove(F.split("text", BLANK), "").alias("w"), lines.alias("lines"),
                  F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"))
         .select("doc_id", "lang", "source", "n_symbols", F.size("w").cast("long").alias("n_words"),
                 F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("w", lambda x: F.xxhash64(x)).alias("h")))
    for step in (1, 2, 4):
        d = d.withColumn("h", _chained(F.col("h"), step))
    d = d.withColumn("h", F.slice("h", F.lit(1), F.greatest(F.size("h") - (WINDOW - 1), F.lit(0))))
    # most texts repeat no window: only the others sort theirs
    d = d.withColumn("h", F.when(F.size("h") > F.size(F.array_distinct("h")), F.col("h")))
    d = d.withColumn("s", F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).drop("h")
    twice = F.zip_with("s", F.slice("s", F.lit(2), F.greatest(F.size("s"), F.lit(0))),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    d = d.withColumn("p", F.sort_array(F.array_distinct(F.flatten(twice)))).drop("s")
    gaps = F.zip_with("p", F.slice("p", F.lit(2), F.greatest(F.size("p"), F.lit(0))),
                      lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                    F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def ratios() -> dict[str, str]:
    """The measures that are sketched, as SQL over the counts."""
    return {"words": "n_words", "word_size": "word_chars * 100 div n_words",
            "symbols": "n_symbols * 1000 div n_words", "dup_lines": "n_dup_lines * 1000 div greatest(n_lines, 1)",
            "repeats": "n_repeat_words * 1000 div n_words"}


# ---- sketches ----------------------------------------------------------------


def bin_sql(v: str) -> str:
    """Bin of a non-negative integer: itself below 256, else its top eight bits and their place."""
    shift = f"greatest(length(bin({v})) - 8, 0)"
    return f"({shift} * 128 + shiftright({v}, {shift}))"


def _ends(b: Column) -> tuple[Column, Column]:
    """Smallest and largest value of a bin."""
    shift = F.when(b < 256, F.lit(0)).otherwise(F.floor(b / 128).cast("int") - 1)
    low = F.call_function("shiftleft", (b - shift * 128).cast("long"), shift)
    return low, low + F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): one quantile sketch per language, source and measure."""
    pairs = ", ".join(f"'{k}', cast({v} as bigint)" for k, v in ratios().items())
    return (measured.where("n_words > 0")
            .selectExpr("lang", "source", f"stack({len(MEASURES)}, {pairs}) as (measure, v)")
            .selectExpr("lang", "source", "measure", f"cast({bin_sql('v')} as int) as bin")
            .groupBy("lang", "source", "measure", "bin").agg(F.count(F.lit(1)).alias("n")))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, by: list[str], cfg: Quality) -> DataFrame:
    """(by, measure, n, low, high) of every sketch."""
    key = W.partitionBy(*by, "measure")
    q = (sketches.withColumn("upto", F.sum("n").over(key.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)))
         .withColumn("total", F.sum("n").over(key)))
    at = {p: F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, F.col("bin"))) for p in (10, 50, 90)}
    q = q.groupBy(*by, "measure").agg(F.first("total").alias("n"), *[v.alias(f"b{p}") for p, v in at.items()])
    low10, low50, high50, high90 = (_ends(F.col("b10"))[0], _ends(F.col("b50"))[0],
                                    _ends(F.col("b50"))[1], _ends(F.col("b90"))[1])
    slack = F.lit(0)
    for name, (_, _, s) in MEASURES.items():
        slack = F.when(F.col("measure") == name, F.lit(s)).otherwise(slack)
    return q.select(*by, "measure", "n",
                    F.greatest(low10 - (low50 - low10) * cfg.spread - slack, F.lit(0)).cast("long").alias("low"),
                    (high90 + (high90 - high50) * cfg.spread + slack).cast("long").alias("high"))


def _drawn(own: str, parent: str, cfg: Quality) -> Column:
    """Weighted mean of a fence and its parent's, in whole numbers."""
    return F.expr(f"cast((cast(n as decimal(20,0)) * {own} + {cfg.prior} * {parent}) div "
                  f"(cast(n as decimal(20,0)) + {cfg.prior}) as bigint)")


def group_fences(sketches: DataFrame, cfg: Quality) -> DataFrame:
    """One row per language and source: low_<measure>, high_<measure>."""
    top = fences(merged(sketches, []), [], cfg).select("measure", F.col("low").alias("plow"), F.col("high").alias("phigh"))
    lang = (fences(merged(sketches, ["lang"]), ["lang"], cfg).join(top, "measure")
            .select(F.col("lang").alias("plang"), F.col("measure").alias("pmeasure"),
                    _drawn("low", "plow", cfg).alias("plow"), _drawn("high", "phigh", cfg).alias("phigh")))
    own = fences(sketches, ["lang", "source"], cfg)
    own = (own.join(lang, F.col("lang").eqNullSafe(F.col("plang")) & (F.col("measure") == F.col("pmeasure")))
           .select("lang", "source", "measure", _drawn("low", "plow", cfg).alias("low"),
                   _drawn("high", "phigh", cfg).alias("high")))
    cells = [F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{side}_{m}")
             for m, (lo, hi, _) in MEASURES.items() for side, used in (("low", lo), ("high", hi)) if used]
    return own.groupBy("lang", "source").agg(*cells)


# ---- verdict -----------------------------------------------------------------


def judge(docs: DataFrame, ws: Workspace, cfg: Quality = Quality()) -> DataFrame:
    """doc_id, counts, base_failed, kept and the measures outside their fences (``outside``)."""
    m = ws.table(measure(docs), "measured")
    fence = ws.table(group_fences(ws.table(sketch(m), "sketches"), cfg), "fences")
    fence = fence.withColumnsRenamed({"lang": "flang", "source": "fsource"})
    j = m.join(fence, F.col("lang").eqNullSafe(F.col("flang")) & F.col("source").eqNullSafe(F.col("fsource")), "left")
    value = {k: F.when(F.col("n_words") > 0, F.expr(v)) for k, v in ratios().items()}
    out = []
    for name, (lo, hi, _) in MEASURES.items():
        off = F.lit(False)
        if lo:
            off = off | (value[name] < F.col(f"low_{name}"))
        if hi:
            off = off | (value[name] > F.col(f"high_{name}"))
        out.append(F.when(off, F.lit(name)))
    failed = ((F.col("n_words") < cfg.min_words)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * cfg.max_repeat_pct))
    return (j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"), F.concat_ws(",", *out).alias("outside"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("outside") == "")).alias("kept"), "outside"))


def judge_sql(cfg: Quality = Quality()) -> str:
    """The same in DuckDB SQL, from word lists and exploded windows."""
    v = {k: x.replace(" div ", " // ") for k, x in ratios().items()}
    values = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS measure, ({x})::BIGINT AS v FROM m WHERE n_words > 0"
                                for k, x in v.items())
    slack = "CASE measure " + " ".join(f"WHEN '{k}' THEN {s}" for k, (_, _, s) in MEASURES.items()) + " END"

    def fence(name: str, table: str, by: str) -> str:
        cols = f"{by}, " if by else ""
        return f"""
{name}_c AS (SELECT {cols}measure, bin, SUM(n)::BIGINT AS n FROM {table} GROUP BY ALL),
{name}_q AS (SELECT *, SUM(n) OVER (PARTITION BY {cols}measure ORDER BY bin ROWS UNBOUNDED PRECEDING) AS upto,
  SUM(n) OVER (PARTITION BY {cols}measure) AS total FROM {name}_c),
{name}_b AS (SELECT {cols}measure, MAX(total)::BIGINT AS n, {', '.join(
            f'MIN(CASE WHEN upto * 100 >= total * {p} THEN bin END) AS b{p}' for p in (10, 50, 90))}
  FROM {name}_q GROUP BY ALL),
{name} AS (SELECT {cols}measure, n, GREATEST(l10 - (l50 - l10) * {cfg.spread} - {slack}, 0) AS low,
  h90 + (h90 - h50) * {cfg.spread} + {slack} AS high FROM (SELECT *, {', '.join(
            f"CASE WHEN b{p} < 256 THEN b{p} ELSE (b{p} - (b{p} // 128 - 1) * 128) << (b{p} // 128 - 1) END AS l{p}, "
            f"CASE WHEN b{p} < 256 THEN b{p} ELSE ((b{p} - (b{p} // 128 - 1) * 128 + 1) << (b{p} // 128 - 1)) - 1 END AS h{p}"
            for p in (10, 50, 90))} FROM {name}_b))"""

    def drawn(a: str, b: str) -> str:
        return f"(({a}.n::HUGEINT * {a}.%s + {cfg.prior} * {b}.%s) // ({a}.n + {cfg.prior}))::BIGINT AS %s"

    def both(a: str, b: str) -> str:
        return ", ".join(drawn(a, b).replace("%s", side) for side in ("low", "high"))

    off = []
    for name, (lo, hi, _) in MEASURES.items():
        tests = [f"({v[name]}) < low_{name}"] * lo + [f"({v[name]}) > high_{name}"] * hi
        off.append(f"CASE WHEN n_words > 0 AND ({' OR '.join(tests)}) THEN '{name}' END")
    cells = ", ".join(f"MAX(CASE WHEN measure = '{m}' THEN {side} END) AS {side}_{m}"
                      for m in MEASURES for side in ("low", "high"))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, COALESCE(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
wr AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
grams AS (SELECT * FROM (SELECT rid, i, concat_ws(' ', x, {', '.join(f'lead(x, {k}) OVER p' for k in range(1, WINDOW))}) AS g,
  lead(x, {WINDOW - 1}) OVER p AS ending FROM wr WINDOW p AS (PARTITION BY rid ORDER BY i)) WHERE ending IS NOT NULL),
twice AS (SELECT rid, i FROM (SELECT rid, i, COUNT(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT rid, SUM(LEAST({WINDOW}, COALESCE(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words FROM
  (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
m AS (SELECT rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '{SYMBOL}'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, COALESCE(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)),
vals AS ({values}),
binned AS (SELECT lang, source, measure, CASE WHEN v < 256 THEN v
  ELSE (length(bin(v)) - 8) * 128 + (v >> (length(bin(v)) - 8)::INTEGER) END AS bin, 1 AS n FROM vals),
{fence('fa', 'binned', '')}, {fence('fl', 'binned', 'lang')}, {fence('fg', 'binned', 'lang, source')},
dl AS (SELECT fl.lang, fl.measure, {both('fl', 'fa')} FROM fl JOIN fa USING (measure)),
dg AS (SELECT fg.lang, fg.source, fg.measure, {both('fg', 'dl')}
  FROM fg JOIN dl ON fg.lang IS NOT DISTINCT FROM dl.lang AND fg.measure = dl.measure),
f AS (SELECT lang, source, {cells} FROM dg GROUP BY lang, source),
j AS (SELECT m.*, concat_ws(',', {', '.join(off)}) AS outside,
  n_words < {cfg.min_words} OR 100 * n_repeat_words > {cfg.max_repeat_pct} * n_words AS base_failed
  FROM m LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND outside = '' AS kept, outside FROM j"""
