"""URL filters: empirical-Bayes host reputation.

A page outcome is good or bad.  Good rates are shrunk top-down through
beta-binomial priors: the suffix towards the global rate, the registered
domain towards its suffix, the host towards its domain.  The strength of each
prior (its pseudo-count) is fitted from all counts by moments: the more the
children of one level differ beyond binomial noise, the weaker the prior.
A page passes when the lower posterior bound of its host's good rate
(mean - z * sd of the beta posterior) reaches ``min_rate``; explicit rules win.

User names and ports are no part of a domain or suffix; a host that is an address
(four numbers, or in brackets) is its own domain and suffix.

Defined cases: a null url or one without ``://`` has host and path ``''`` and
is judged like any other host (``''`` is its domain and suffix too); pages or
hosts without outcomes take their parent's prior; with no outcome at all every
rate is 0.5; repeated pages count once per row; repeated outcome rows of a page
are merged (good only if all are good); empty tables give an empty result;
other columns of the inputs are ignored.

Everything is DataFrame expressions.  The hot host costs nothing: counts are
partially aggregated before the shuffle, and pages join a written
one-row-per-host table (AQE splits the page side).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path prefix): a rule fits its host and all subdomains.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: User name and port around a host's name, and hosts that are addresses.
NOT_NAME = r"^.*@|:[0-9]*$"
ADDRESS = r"^[0-9]+(\.[0-9]+){3}$|^\["

#: Public suffixes of several labels (a parameter; ``suffixes_in`` reads a list file).
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za")


@dataclass(frozen=True)
class Reputation:
    min_rate: float = 0.7
    z: float = 1.645
    min_strength: int = 1
    max_strength: int = 1000
    suffixes: tuple = TWO_LABEL_SUFFIXES


def url_host(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")),
                  F.substr(url, F.locate("://", url) + F.lit(3))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")),
                  F.substr(url, F.locate("://", url) + F.lit(3))).otherwise(F.lit(""))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def suffixes_in(spark: SparkSession, path: str) -> tuple:
    """Suffixes of several labels in a list file, one a line; ``//`` starts a comment, lines
    with other signs than letters, digits, dots and hyphens (wildcards) are left out."""
    line = F.lower(F.trim(F.split("value", "//")[0]))
    rows = spark.read.text(path).select(line.alias("s")).where(F.rlike("s", F.lit(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$"))).distinct()
    return tuple(sorted(r["s"] for r in rows.collect()))


def named_host(host: Column) -> Column:
    """The host without user name and port."""
    return F.regexp_replace(host, NOT_NAME, "")


def _labels(suffixes: tuple) -> dict[int, list[str]]:
    """Suffixes of several labels by their length, longest first."""
    by: dict[int, list[str]] = {}
    for s in suffixes:
        by.setdefault(s.count(".") + 1, []).append(s)
    return dict(sorted(by.items(), reverse=True))


def suffix_of(host: Column, suffixes: tuple = TWO_LABEL_SUFFIXES) -> Column:
    """Public suffix of a named host: the longest listed one, else the last label; an address is its own."""
    out = F.when(F.rlike(host, F.lit(ADDRESS)), host)
    for n, own in _labels(suffixes).items():
        out = out.when(F.substring_index(host, ".", -n).isin(*own), F.substring_index(host, ".", -n))
    return out.otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: tuple = TWO_LABEL_SUFFIXES) -> Column:
    """Registered domain of a named host: one label more than its suffix; an address is its own."""
    out = F.when(F.rlike(host, F.lit(ADDRESS)), host)
    for n, own in _labels(suffixes).items():
        out = out.when(F.substring_index(host, ".", -n).isin(*own), F.substring_index(host, ".", -n - 1))
    return out.otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, the first on ties; nulls if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _strength(level: DataFrame, child: str, parent: str, cfg: Reputation) -> DataFrame:
    """One row ``k``: prior pseudo-count of the children of one level, by moments."""
    fam = level.groupBy(parent).agg(
        F.sum("n").alias("pn"), F.sum("good").alias("pg"), F.count(F.lit(1)).alias("m"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("gg"))
    rate = F.col("pg") / F.col("pn")
    noise = rate * (F.lit(1.0) - rate)
    fam = fam.select(
        (F.col("gg") - F.col("pg") * rate).alias("spread"),
        ((F.col("m") - 1) * noise).alias("within"),
        (F.col("pn") - F.col("nn") / F.col("pn")).alias("scale"), "pn", "pg")
    tot = fam.agg(F.sum("spread").alias("spread"), F.sum("within").alias("within"),
                  F.sum("scale").alias("scale"), F.sum("pn").alias("n"), F.sum("pg").alias("g"))
    p = F.col("g") / F.col("n")
    between = F.when(F.col("scale") > 0, (F.col("spread") - F.col("within")) / F.col("scale"))
    k = F.floor(p * (F.lit(1.0) - p) / F.greatest(between, F.lit(1e-6)) - F.lit(1.0))
    return tot.select(F.coalesce(F.least(F.greatest(k, F.lit(cfg.min_strength)),
                                         F.lit(cfg.max_strength)),
                                 F.lit(cfg.max_strength)).cast("double").alias("k"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, ws: Workspace,
                    cfg: Reputation = Reputation()) -> DataFrame:
    """One row per host of ``pages`` (page_id, url): host, host_n, host_good,
    mean, bound.  ``outcomes``: (page_id, good 0/1 or null)."""
    per_page = (outcomes.where(F.col("good").isNotNull() & F.col("page_id").isNotNull())
                .groupBy("page_id").agg(F.min("good").alias("good")))
    seen = pages.select("page_id", url_host(F.col("url")).alias("host"))
    hosts = ws.table(
        seen.join(per_page, "page_id", "left")
        .groupBy("host").agg(F.count("good").alias("n"),
                             F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"))
        .select("host", named_host(F.col("host")).alias("name"), "n", "good")
        .select("host", domain_of(F.col("name"), cfg.suffixes).alias("domain"),
                suffix_of(F.col("name"), cfg.suffixes).alias("suffix"), "n", "good"), "hosts")
    h = hosts.where("n > 0")
    domains = ws.table(h.groupBy("domain", "suffix").agg(F.sum("n").alias("n"),
                                                         F.sum("good").alias("good")), "domains")
    suffixes = ws.table(domains.groupBy("suffix").agg(F.sum("n").alias("n"),
                                                      F.sum("good").alias("good")), "suffixes")
    top = suffixes.withColumn("root", F.lit("."))
    k_host = _strength(h, "host", "domain", cfg).select(F.col("k")).scalar()
    k_dom = _strength(domains, "domain", "suffix", cfg).select(F.col("k")).scalar()
    k_suf = _strength(top, "suffix", "root", cfg).select(F.col("k")).scalar()
    mean0 = (suffixes.agg(((F.coalesce(F.sum("good"), F.lit(0)) + F.lit(1.0))
                           / (F.coalesce(F.sum("n"), F.lit(0)) + F.lit(2.0))).alias("m"))
             .scalar())
    s = suffixes.select("suffix", ((F.col("good") + k_suf * mean0) / (F.col("n") + k_suf))
                        .alias("s_mean"))
    d = (domains.join(s, "suffix")
         .select("domain", ((F.col("good") + k_dom * F.col("s_mean")) / (F.col("n") + k_dom))
                 .alias("d_mean")))
    prior = F.coalesce(F.col("d_mean"), F.col("s_mean"), mean0)
    out = (hosts.join(d, "domain", "left").join(s, "suffix", "left")
           .select("host", "n", "good", ((F.col("good") + k_host * prior)
                                         / (F.col("n") + k_host)).alias("mean"),
                   (F.col("n") + k_host).alias("strength")))
    sd = F.sqrt(F.col("mean") * (F.lit(1.0) - F.col("mean")) / (F.col("strength") + F.lit(1.0)))
    return ws.table(out.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good"),
                               "mean", (F.col("mean") - F.lit(cfg.z) * sd).alias("bound")),
                    "reputation")


def judge_pages(pages: DataFrame, outcomes: DataFrame, ws: Workspace,
                cfg: Reputation = Reputation(), rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, host_n, host_good."""
    p = pages.select("page_id", "url")
    rep = host_reputation(p, outcomes, ws, cfg)
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= cfg.min_rate, F.lit("allow")).otherwise(F.lit("block"))
    return (p.select("page_id", host.alias("host"), path.alias("path"))
            .join(rep, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(ruled, own).alias("verdict"), "host_n", "host_good"))


def label_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes from the label table: its ids name the pages; good means quality 1 and not toxic."""
    return labels.select(F.col("doc_id").alias("page_id"),
                         F.when(F.col("quality").isNotNull(),
                                ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
                                .cast("int")).alias("good"))


def _strength_sql(table: str, parent: str, name: str, cfg: Reputation) -> str:
    return f"""
{name}_f AS (SELECT {parent} AS par, SUM(n) AS pn, SUM(good) AS pg, COUNT(*) AS m,
  SUM(n * n) AS nn, SUM(CAST(good * good AS DOUBLE) / n) AS gg FROM {table} WHERE n > 0 GROUP BY 1),
{name} AS (SELECT CAST(COALESCE(LEAST(GREATEST(FLOOR(p * (1.0::DOUBLE - p) / GREATEST(
    CASE WHEN scale > 0 THEN (spread - within) / scale ELSE 0.000001::DOUBLE END, 0.000001::DOUBLE) - 1.0::DOUBLE),
    {cfg.min_strength}), {cfg.max_strength}), {cfg.max_strength}) AS DOUBLE) AS k
  FROM (SELECT SUM(gg - pg * (CAST(pg AS DOUBLE) / pn)) AS spread,
    SUM((m - 1) * ((CAST(pg AS DOUBLE) / pn) * (1.0::DOUBLE - CAST(pg AS DOUBLE) / pn))) AS within,
    SUM(pn - CAST(nn AS DOUBLE) / pn) AS scale,
    CAST(SUM(pg) AS DOUBLE) / SUM(pn) AS p FROM {name}_f))"""


def judge_pages_sql(cfg: Reputation = Reputation(), rules=RULES) -> str:
    domain, suffix = f"CASE WHEN regexp_matches(name, '{ADDRESS}') THEN name", f"CASE WHEN regexp_matches(name, '{ADDRESS}') THEN name"
    for n, own in _labels(cfg.suffixes).items():
        listed = f" WHEN array_to_string(ls[-{n}:], '.') IN ({', '.join(f"'{s}'" for s in own)}) THEN "
        domain += f"{listed}array_to_string(ls[-{n + 1}:], '.')"
        suffix += f"{listed}array_to_string(ls[-{n}:], '.')"
    cases, verdicts = "", ""
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        cases += f" WHEN {fits} THEN '{h + p}'"
        verdicts += f" WHEN {fits} THEN '{v}'"
    return f"""
WITH url_parts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
seen AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM url_parts),
parts AS (SELECT *, string_split(name, '.') AS ls
  FROM (SELECT *, regexp_replace(host, '{NOT_NAME}', '', 'g') AS name FROM seen)),
outc AS (SELECT doc_id AS page_id, MIN(CASE WHEN quality = 1 AND COALESCE(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good
  FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1),
hosts AS (SELECT host, {domain} ELSE array_to_string(ls[-2:], '.') END AS domain, {suffix} ELSE ls[-1] END AS suffix,
  COUNT(good) AS n, COALESCE(SUM(good), 0)::BIGINT AS good
  FROM parts LEFT JOIN outc USING (page_id) GROUP BY 1, 2, 3),
domains AS (SELECT domain, suffix, SUM(n)::BIGINT AS n, SUM(good)::BIGINT AS good FROM hosts WHERE n > 0 GROUP BY 1, 2),
suffixes AS (SELECT suffix, '.' AS root, SUM(n)::BIGINT AS n, SUM(good)::BIGINT AS good FROM domains GROUP BY 1),
{_strength_sql('hosts', 'domain', 'kh', cfg)}, {_strength_sql('domains', 'suffix', 'kd', cfg)},
{_strength_sql('suffixes', 'root', 'ks', cfg)},
g AS (SELECT (COALESCE(SUM(good), 0) + 1.0::DOUBLE) / (COALESCE(SUM(n), 0) + 2.0::DOUBLE) AS m FROM suffixes),
s AS (SELECT suffix, (good + ks.k * g.m) / (n + ks.k) AS s_mean FROM suffixes, ks, g),
d AS (SELECT domain, (good + kd.k * s_mean) / (n + kd.k) AS d_mean FROM domains JOIN s USING (suffix), kd),
rep AS (SELECT host, n, good, (good + kh.k * COALESCE(d_mean, s_mean, g.m)) / (n + kh.k) AS mean, n + kh.k AS strength
  FROM hosts LEFT JOIN d USING (domain) LEFT JOIN s USING (suffix), kh, g)
SELECT page_id, host, path, CASE{cases} ELSE NULL END AS rule,
  CASE{verdicts} WHEN mean - {cfg.z}::DOUBLE * sqrt(mean * (1.0::DOUBLE - mean) / (strength + 1.0::DOUBLE))
    >= {cfg.min_rate}::DOUBLE THEN 'allow' ELSE 'block' END AS verdict,
  n AS host_n, good AS host_good
FROM seen LEFT JOIN rep USING (host)"""
