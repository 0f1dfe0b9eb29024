"""Personal data: base patterns plus information-theoretic sanitisation.

Base: e-mail, IP, card and phone texts are found by pattern, leftmost and
non-overlapping per kind, and checked (parts, digits, Luhn).  Each valid text is
a protected entity.

Disclosure: words of a document can give an entity away even when the entity
itself is masked.  Over the whole corpus, with N documents, df(e) and df(t)
documents holding entity and term, and c(e, t) documents holding both, wherever
they stand (words inside e-mails are no terms; other kinds hold no letters),

    PMI(t; e) = log2(c * N / (df(t) * df(e))),   IC(e) = log2(N / df(e)),

and PMI / IC is the share of the entity's information that the term reveals: 1
if the term occurs with this entity alone.  Few texts prove little, so a term is
judged by its sure share: P(e | t) = c / df(t) is drawn towards P(e) = df(e) / N
as if ``prior`` further texts with t held e at the corpus rate.  An entity that
stands in a single text thus has terms as soon as N is large enough for one
text to tell something; no number of texts is asked for.  Terms whose sure share
reaches ``generalise_at`` become ``term`` spans; ``sanitise`` replaces base spans
and generalised terms by a class name and removes terms whose share reaches
``remove_at``.  Every occurrence of such a term is a span in all documents that
hold the entity; a document without the entity has nothing to give away.

Defined cases: null text is empty; repeated rows each get the same spans and
count as documents, but only different texts count as evidence; spans are code points, end exclusive;
null ids are carried through; an empty table gives an empty result; other
columns are ignored (``sanitise`` keeps them).

All expressions are Spark's.  The patterns are written without overlapping
repeats (possessive, anchored at the start of a run), so a text costs time in
proportion to its length.  Texts are kept only of documents that hold an
entity, and only their words are shuffled, besides partial counts.  Entities
that stand in the same documents are counted as one, so a document costs its
words times the different sets of documents its entities stand in; the
document's own span list is the largest group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: The same matches as the plain patterns of the contract, found in linear time.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this can hold no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
TERM = r"\p{L}{3,}+"
BLOCK = 1000


@dataclass(frozen=True)
class Disclosure:
    prior: float = 1.5
    generalise_at: float = 0.8
    remove_at: float = 0.95
    max_broadcast: int = 200_000


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _starts(gaps: Column, sizes: Column) -> Column:
    """Start of every match, given the lengths of the texts before and of the matches.

    Summed in blocks, so the work grows with the number of matches, not its square."""
    def block(a: Column, b: Column) -> Column:
        return F.slice(a, b * BLOCK + 1, BLOCK)

    blocks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: _sum(block(gaps, b)) + _sum(block(sizes, b)))
    none = F.array().cast("array<int>")
    bases = F.aggregate(totals, F.struct(F.lit(0).alias("at"), none.alias("all")),
                        lambda s, t: F.struct((s["at"] + t).alias("at"),
                                              F.array_append(s["all"], s["at"]).alias("all")))["all"]

    def inside(b: Column) -> Column:
        moves = F.zip_with(block(gaps, b), block(sizes, b), lambda g, n: F.struct(g.alias("g"), n.alias("n")))
        return F.aggregate(moves, F.struct(F.element_at(bases, b + 1).alias("at"), none.alias("all")),
                           lambda s, x: F.struct((s["at"] + x["g"] + x["n"]).alias("at"),
                                                 F.array_append(s["all"], s["at"] + x["g"]).alias("all")))["all"]

    return F.when(F.size(sizes) > 0, F.flatten(F.transform(blocks, inside))).otherwise(none)


def matches(text: Column, pattern: str) -> tuple[Column, Column, Column]:
    """(texts between, matched texts, their starts)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    gaps = F.slice(F.transform(between, lambda x: F.length(x)), 1, F.size(found))
    return between, found, _starts(gaps, F.transform(found, lambda x: F.length(x)))


def _valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        return v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _entity(kind: str, v: Column) -> Column:
    plain = F.lower(v) if kind == "email" else v if kind == "ip" else F.regexp_replace(v, "[^0-9]", "")
    return F.concat(F.lit(kind + ":"), plain)


SPANS = "array<struct<s:int,e:int,entity:string>>"


def base_spans(text: Column, kind: str) -> Column:
    """Valid spans of one kind."""
    _, found, starts = matches(text, PATTERNS[kind])
    rows = F.arrays_zip(starts.alias("s"), found.alias("v"))

    def span(r: Column) -> Column:
        return F.struct(r["s"].alias("s"), (r["s"] + F.length(r["v"])).alias("e"),
                        _entity(kind, r["v"]).alias("entity"))

    spans = F.transform(F.filter(rows, lambda r: _valid(kind, r["v"])), span).cast(SPANS)
    if NEEDS[kind]:
        spans = F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(F.array().cast(SPANS))
    return spans


def find_base(docs: DataFrame, ws: Workspace, cfg: Disclosure) -> DataFrame:
    """One row per document: doc_id, __text (hash), one span array per kind, and __body,
    the text of documents that hold an entity."""
    body = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", F.xxhash64(body).alias("__text"), body.alias("__all"),
                        *[base_spans(body, k).alias(k) for k in KINDS])
    holds = F.size(F.concat(*KINDS)) > 0
    return ws.table(found.select("doc_id", "__text", *KINDS, F.when(holds, F.col("__all")).alias("__body")), "base")


def _terms_around(base: DataFrame) -> DataFrame:
    """One row per word outside e-mails, in documents that hold an entity: doc_id, __text, term, s, e."""
    between, found, starts = matches(F.col("__body"), PATTERNS["email"])
    ends = F.zip_with(starts, F.transform(found, lambda x: F.length(x)), lambda s, n: s + n)
    pieces = base.where(F.col("__body").isNotNull()).select(
        "doc_id", "__text", F.explode(F.arrays_zip(
            F.concat(F.array(F.lit(0)), ends).alias("at"), between.alias("t"))).alias("w"))
    _, found, starts = matches(F.col("w.t"), TERM)
    words = pieces.select("doc_id", "__text", F.col("w.at").alias("at"),
                          F.explode(F.arrays_zip(starts.alias("s"), found.alias("v"))).alias("m"))
    s = F.col("at") + F.col("m.s")
    return words.select("doc_id", "__text", F.lower("m.v").alias("term"),
                        s.alias("s"), (s + F.length("m.v")).alias("e"))


def together(base: DataFrame, terms: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """((doc_id, __text, entity, copies, term) of all entities and terms of a document,
    (entity, df_e)).  Of entities that stand in the same documents the first by name
    stands for all: their counts are the same with every term."""
    # rows that repeat an id and text are documents of their own in every count
    held = ws.table(base.select("doc_id", "__text", F.explode(F.array_distinct(F.transform(
        F.concat(*KINDS), lambda x: x["entity"]))).alias("entity"))
        .groupBy("doc_id", "__text", "entity").agg(F.count(F.lit(1)).alias("copies")), "held")
    sums = [F.sum(F.xxhash64("doc_id", "__text", F.lit(i)).cast("decimal(20,0)")).alias(f"set{i}") for i in (1, 2)]
    entities = ws.table(held.groupBy("entity").agg(F.sum("copies").alias("df_e"), *sums)
                        .groupBy("df_e", "set1", "set2").agg(F.min("entity").alias("entity"))
                        .select("entity", "df_e"), "entities")
    mine = held.join(entities.select("entity"), "entity", "left_semi").select(
        F.col("doc_id").alias("__doc"), F.col("__text").alias("__t"), "entity", "copies")
    words = terms.select("doc_id", "__text", "term").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__t"))
    return ws.table(words.join(mine, same).drop("__doc", "__t"), "near"), entities


def _telling(docs: DataFrame, near: DataFrame, entities: DataFrame, ws: Workspace,
             cfg: Disclosure) -> DataFrame:
    pairs = ws.table(near.groupBy("entity", "term", "__text").agg(F.sum("copies").alias("n"))
                     .groupBy("entity", "term").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("texts")),
                     "pairs")
    wanted = ws.table(pairs.select("term").distinct(), "wanted")
    body = F.coalesce(F.col("text"), F.lit(""))
    plain = F.when(F.contains(body, F.lit("@")), F.regexp_replace(body, PATTERNS["email"], " ")).otherwise(body)
    words = docs.select(F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all(plain, F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))).alias("term"))
    if wanted.count() <= cfg.max_broadcast:
        words = words.join(F.broadcast(wanted), "term", "left_semi")
    frequency = words.groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    frequency = ws.table(frequency.join(wanted, "term", "left_semi"), "frequency")
    n = F.lit(docs.count()).cast("double")
    told = F.least(F.lit(1.0), F.col("c") / F.col("df_t"))
    sure = (F.col("texts") + cfg.prior * F.col("df_e") / n) / (F.col("texts") / told + cfg.prior)

    def share(p: Column) -> Column:
        return F.when(n > F.col("df_e"), 1.0 + F.log2(p) / F.log2(n / F.col("df_e"))).otherwise(0.0)

    return ws.table(pairs.join(entities, "entity").join(frequency, "term")
                    .where(share(sure) >= cfg.generalise_at)
                    .select("entity", "term", share(told).alias("share")), "disclosures")


def disclosures(docs: DataFrame, base: DataFrame, terms: DataFrame, ws: Workspace,
                cfg: Disclosure) -> DataFrame:
    """(entity, term, share) of all terms that reveal at least ``generalise_at`` of an entity;
    the entity stands for all of the same documents."""
    return _telling(docs, *together(base, terms, ws), ws, cfg)


def find_personal_data(docs: DataFrame, ws: Workspace, cfg: Disclosure = Disclosure()) -> DataFrame:
    """One row per document: doc_id, __text, span arrays of the four kinds, and ``term``:
    array of (s, e, share), ascending."""
    base = find_base(docs, ws, cfg)
    terms = ws.table(_terms_around(base), "terms")
    near, entities = together(base, terms, ws)
    told = (near.join(_telling(docs, near, entities, ws, cfg), ["entity", "term"])
            .groupBy(F.col("doc_id").alias("__doc"), F.col("__text").alias("__t"), F.col("term").alias("__term"))
            .agg(F.max("share").alias("share")))
    spot = (terms["doc_id"].eqNullSafe(F.col("__doc")) & (terms["__text"] == F.col("__t"))
            & (terms["term"] == F.col("__term")))
    per_span = terms.join(told, spot).select("doc_id", "__text", "s", "e", "share").distinct()
    per_doc = ws.table(per_span.groupBy(F.col("doc_id").alias("__doc"), F.col("__text").alias("__t"))
                       .agg(F.sort_array(F.collect_list(F.struct("s", "e", "share"))).alias("term")),
                       "term_spans")
    mine = base["doc_id"].eqNullSafe(per_doc["__doc"]) & (base["__text"] == per_doc["__t"])
    plain = [F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS]
    return (base.join(per_doc, mine, "left")
            .select("doc_id", "__text", *plain,
                    F.coalesce("term", F.array().cast("array<struct<s:int,e:int,share:double>>")).alias("term")))


def _each(kind: str, what, prefix: str = "") -> Column:
    """``what(kind, span)`` of every span of the kind."""
    return F.transform(prefix + kind, lambda x: what(kind, x))


def _joined(kinds) -> Column:
    return F.concat_ws(",", *[_each(k, lambda kind, x: F.concat_ws(":", F.lit(kind), x["s"], x["e"]))
                              for k in kinds])


def report(docs: DataFrame, ws: Workspace, cfg: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term."""
    found = find_personal_data(docs, ws, cfg)
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(KINDS).cast("binary"), 256).alias("base_sha256"),
        _joined([*KINDS, "term"]).alias("spans"), F.size("term").cast("long").alias("n_term"))


def sanitise(docs: DataFrame, ws: Workspace, cfg: Disclosure = Disclosure()) -> DataFrame:
    """The documents with personal data replaced by class names and telling terms generalised
    or removed; of overlapping spans the first, then the longer one counts."""
    found = find_personal_data(docs, ws, cfg).dropDuplicates(["doc_id", "__text"])
    found = ws.table(found.select(F.col("doc_id").alias("__doc"), "__text",
                                  *[F.col(k).alias(f"__{k}") for k in (*KINDS, "term")]), "found")
    marks = [_each(k, lambda kind, x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"),
                                               F.lit(f"[{kind.upper()}]").alias("r")), "__") for k in KINDS]
    marks.append(F.transform("__term", lambda x: F.struct(
        x["s"].alias("s"), (-x["e"]).alias("e"),
        F.when(x["share"] >= cfg.remove_at, F.lit("")).otherwise(F.lit("[TERM]")).alias("r"))))
    ordered = F.sort_array(F.concat(*marks))
    body = F.coalesce(docs["text"], F.lit(""))
    done = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, m: F.when(m["s"] < a["at"], a).otherwise(F.struct(
            (-m["e"]).alias("at"),
            F.concat(a["out"], F.array(F.substr(body, a["at"] + 1, m["s"] - a["at"]), m["r"])).alias("out"))),
        lambda a: F.concat(F.concat_ws("", a["out"]), F.substr(body, a["at"] + 1)))
    same = F.col("__doc").eqNullSafe(docs["doc_id"]) & (F.col("__text") == F.xxhash64(
        F.coalesce(docs["text"], F.lit(""))))
    joined = docs.join(found, same, "left")
    return joined.select(*[F.when(docs["text"].isNotNull(), done).alias("text") if c == "text" else docs[c]
                           for c in docs.columns])
