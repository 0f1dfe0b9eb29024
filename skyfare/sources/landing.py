"""Landing JSON -> extracted rows -> normalised ODS rows (+ quarantine).

Parsing uses VARIANT so a *missing* field and an explicit ``null`` stay
apart: a missing field takes its default (price 0, transfers 0, text ''),
an explicit null or a value that does not cast is quarantined with a reason,
as the source transform dropped such rows.  Objects that are empty, broken,
unsuccessful, without ``data`` or whose ``data`` is not an object are
skipped as a whole and recorded in the quarantine (the source skipped that
request and carried on).  All of it is per-row expressions plus one
``explode`` of the ``data`` map; no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scalar import empty_as_null, popularity_bucket, price_bucket

OBJECT_STATUS = ["empty_body", "broken_json", "not_success", "no_data", "data_not_object",
                 "bad_entry"]

# fields read from a ticket object, per feed (other keys are ignored)
FIELDS = {
    "grouped_prices": ["origin", "airline", "flight_number", "departure_at", "origin_airport",
                       "destination_airport", "link", "price", "transfers", "duration"],
    "calendar": ["price", "airline", "flight_number", "departure_at", "return_at",
                 "transfers", "expires_at"],
    "directions": ["price", "airline", "flight_number", "departure_at", "return_at",
                   "expires_at", "transfers"],
}


# the envelope is read as a map of raw member texts: one parse per body,
# members looked up by key (struct field access on a JSON parse would be
# rewritten into one pruned parse per accessed field)
ENVELOPE = "map<string,string>"


def parse_objects(landing: DataFrame, fields: list[str]) -> DataFrame:
    """Split each response into its envelope and ``data`` entries.

    The envelope is a map of member texts (NULL for a body that is not a
    JSON object); ``data`` is split into a map of entry texts (JSON order
    kept), so each ticket is later parsed as its own small VARIANT rather
    than as a slice of the whole document.  ``_bad`` is the 1-based position
    of the first entry that is not an object (0 if none)."""
    env = F.from_json(F.col("body"), ENVELOPE)
    not_object = F.transform(F.map_values(F.col("_m")),
                             lambda x: F.coalesce(~F.ltrim(x).startswith("{"), F.lit(True)))
    if "poll" not in landing.columns:  # a feed that is asked once per request
        landing = landing.withColumn("poll", F.lit(None).cast("int"))
    return (landing.withColumn("_o", env)
                   .withColumn("_m", F.from_json(F.col("_o")["data"], "map<string,string>"))
                   .withColumn("_bad", F.coalesce(F.array_position(not_object, True), F.lit(0)))
                   .withColumn("status", object_status(F.col("body"), F.col("_o"), F.col("_m"),
                                                       F.col("_bad"))))


# member texts that are false as JSON values (as a text of its own, "0" is true)
FALSE_TEXTS = ["", "false", "0", "0.0", "-0", "-0.0", "[]", "{}"]


def _truthy(member: Column, body: Column) -> Column:
    """Truth of the ``success`` member: every value but null, false, zero and
    empty ones.  The member map has texts without their quotes, so in the rare
    case that one reads like a false value the member itself is read again."""
    value = F.to_json(F.try_variant_get(F.try_parse_json(body), "$.success", "variant"))
    return (F.when(member.isNull(), False)
             .when(member.isin(*FALSE_TEXTS), F.coalesce(value.startswith('"') & (value != '""'), F.lit(False)))
             .otherwise(True))


def object_status(body: Column, env: Column, entries_: Column, bad: Column) -> Column:
    """Why a response object is skipped ('ok' if it is not).

    An entry that is not an object stops the source's loop over ``data``:
    the entries before it were already taken, the rest of that request is
    lost ('bad_entry', partially loaded)."""
    return (F.when(body.isNull() | (F.trim(body) == ""), "empty_body")
             .when(env.isNull(), "broken_json")
             .when(~_truthy(env["success"], body), "not_success")
             .when(env["data"].isNull(), "no_data")
             .when(entries_.isNull(), "data_not_object")
             .when(bad > 0, "bad_entry")
             .otherwise("ok"))


def entries(parsed: DataFrame, key_name: str, fields: list[str], skips: bool = False) -> DataFrame:
    """One row per taken ``data`` entry: (key, ticket as a text and as a VARIANT).

    Skipped objects explode a NULL map (no rows) rather than being filtered:
    a filter on ``status`` would be pushed below the projections and repeat
    the JSON parses inside its condition.  With ``skips`` an object that is not
    fully loaded gives one more row, without a ticket, whose ``_skip`` says why:
    loaded and skipped objects then come out of a single parse."""
    taken = F.when(F.col("status").isin("ok", "bad_entry"), F.col("_m"))
    cur = F.coalesce(F.col("_o")["currency"], F.lit(fixed.DEFAULT_CURRENCY))
    cols = ["origin", "destination", "month", "poll", cur.alias("currency"), "_bad"]
    if skips:
        e = parsed.select(*cols, "status", F.posexplode_outer(taken).alias("_pos", "_key", "_entry"))
        bad = (F.col("_bad") > 0) & (F.col("_pos") == F.col("_bad") - 1)
        # an object without any entry to take has one row, as has the entry that stopped the loop
        e = e.where((F.col("_pos").isNull() & (F.col("status") != "ok")) | (F.col("_pos") >= 0) &
                    ((F.col("_bad") == 0) | (F.col("_pos") < F.col("_bad"))))
        e = e.withColumn("_skip", F.when(F.col("_pos").isNull() | bad, F.col("status")))
        e = e.withColumns({key_name: F.when(F.col("_skip").isNull(), F.col("_key")),
                           "_txt": F.when(F.col("_skip").isNull(), F.col("_entry"))})
        e = e.drop("_bad", "status", "_pos", "_key", "_entry")
    else:
        e = (parsed.select(*cols, F.posexplode(taken).alias("_pos", key_name, "_txt"))
                   .where((F.col("_bad") == 0) | (F.col("_pos") < F.col("_bad") - 1)).drop("_pos", "_bad"))
    return e.withColumn("_t", F.try_parse_json(F.col("_txt")))


# ---- per-field helpers ---------------------------------------------------
#
# Extraction runs in four projections.  The first reads all fields in one go:
# texts, doubles and bigints (NULL for a missing field, an explicit null and a
# value that does not cast).  The second tells numbers apart: fields with a value
# that the ticket's text does not show as a JSON text.  The third adds the JSON
# type of a value (NULL when the field is missing, VOID for an explicit null),
# asked of the VARIANT only where it is not known yet.  The fourth derives every
# output column from those primitive columns.

TEXT = "text"
NUM = "num"
WHOLE = "whole"
KINDS = {TEXT: "string", NUM: "double", WHOLE: "bigint"}


def prepare(e: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The columns ``_<field>_type`` and ``_<field>_s`` of a text, ``_d`` of a number, ``_i``
    and ``_zero`` (is the value, read as a double, zero) of a whole number."""
    keep = [c for c in e.columns if c not in ("_t", "_txt")]
    nums = [f for f, kind_ in fields.items() if kind_ != TEXT]
    # texts and numbers apart: a query that needs no text has none read
    read = {"_s": [f for f in fields if f not in nums], "_v": nums}
    e = e.withColumns({c: F.try_variant_get("_t", "$", "struct<" + ", ".join(f"`{f}`: {KINDS[fields[f]]}" for f in own) + ">")
                       for c, own in read.items() if own})
    # a ticket's text was written by the JSON parser: names as they are, no blank after the colon
    e = e.withColumns({f"_{f}_n": F.col("_v")[f].isNotNull() & ~F.col("_txt").contains(f'"{f}":"') for f in nums})
    cols = [F.col(c) for c in keep]
    for f, kind_ in fields.items():
        value, type_ = F.col("_s" if kind_ == TEXT else "_v")[f], F.schema_of_variant(F.try_variant_get("_t", f"$.{f}", "variant"))
        if kind_ == TEXT:
            cols.append(F.when(value.isNull(), type_).otherwise("TEXT").alias(f"_{f}_type"))
            cols.append(value.alias(f"_{f}_s"))
            continue
        cols.append(F.when(F.col(f"_{f}_n"), "NUMBER").otherwise(type_).alias(f"_{f}_type"))
        if kind_ == NUM:
            cols.append(value.alias(f"_{f}_d"))
        else:  # 0.5 is 0 as a whole number, and one too large has none
            cols.append(value.alias(f"_{f}_i"))
            cols.append(F.when(value != 0, False).otherwise(F.try_variant_get("_t", f"$.{f}", "double") == 0)
                         .alias(f"_{f}_zero"))
    return e.select(*cols)


def _type(name: str) -> Column:
    return F.col(f"_{name}_type")


def _missing(name: str) -> Column:
    return _type(name).isNull()


def _null(name: str) -> Column:
    return _type(name) == "VOID"


def _is_text(name: str) -> Column:
    return _type(name) == "STRING"


def kind(name: str) -> Column:
    """missing / null / text / number, as the raw JSON value was."""
    return (F.when(_missing(name), "missing").when(_null(name), "null")
             .when(_is_text(name), "text").otherwise("number"))


def text(name: str, default: Column | str = "") -> Column:
    """``d.get(name, default)`` as text; explicit null stays NULL."""
    dflt = default if isinstance(default, Column) else F.lit(default)
    return (F.when(_missing(name), dflt).when(_null(name), F.lit(None).cast("string"))
             .otherwise(F.col(f"_{name}_s")))


def key_part(name: str, default: str = "") -> Column:
    """The value as an f-string renders it: missing -> default, null -> 'None'."""
    return (F.when(_missing(name), F.lit(default)).when(_null(name), F.lit("None"))
             .otherwise(F.col(f"_{name}_s")))


def as_double(name: str, default: float = 0.0) -> Column:
    """``float(d.get(name, default))``: NULL when it would raise, and for texts
    like 'nan' and 'inf', which no money column can hold."""
    d = F.col(f"_{name}_d")
    return (F.when(_missing(name), F.lit(default).cast("double"))
             .when(_null(name) | F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double"))
             .otherwise(d))


def as_int(name: str, default: int = 0) -> Column:
    """``int(d.get(name, default))``: numbers truncate, '3' parses, '3.5' fails."""
    return (F.when(_missing(name), F.lit(default).cast("bigint"))
             .when(_null(name), F.lit(None).cast("bigint"))
             .otherwise(F.col(f"_{name}_i")))


def equals_zero(name: str) -> Column:
    """``d.get(name, 0) == 0`` on the raw value: text '0' is not zero."""
    return (F.when(_missing(name), F.lit(True))
             .when(_null(name) | _is_text(name), F.lit(False))
             .otherwise(F.coalesce(F.col(f"_{name}_zero"), F.lit(False))))


# beyond these the store's columns (decimal(18,2), int) cannot hold a value
MONEY_LIMIT = 1e16
INT_LIMITS = (-(1 << 31), (1 << 31) - 1)


def cast_reason(fields: list[tuple[str, str]]) -> Column:
    """First failing cast, in the order the transform evaluates them; a value
    that casts but does not fit its store column fails as ``range_<field>``."""
    reasons = []
    for name, typ in fields:
        value = as_double(name) if typ == "double" else as_int(name)
        fits = F.abs(value) < MONEY_LIMIT if typ == "double" else value.between(*INT_LIMITS)
        reason = (F.when(value.isNull() & _null(name), F.lit(f"null_{name}"))
                   .when(value.isNull(), F.lit(f"bad_{name}"))
                   .when(~fits, F.lit(f"range_{name}")))
        reasons.append(reason)
    # an array function in place of coalesce: it keeps this wide projection out of the
    # fused stage, whose one method would be too large for the JVM to compile
    return F.get(F.array_compact(F.array(*reasons)), 0)


def _fields(feed: str) -> dict[str, str]:
    kinds = {"price": NUM, "transfers": WHOLE, "duration": WHOLE}
    return {f: kinds.get(f, TEXT) for f in FIELDS[feed]}


def _skip(e: DataFrame) -> list[Column]:
    """Why an object was not (fully) loaded, on the rows that say so."""
    return [F.col("_skip").alias("object_status")] if "_skip" in e.columns else []


# ---- the three feeds -------------------------------------------------------

def extract_grouped_prices(landing: DataFrame, batch_ts: str,
                           data_source: str = "grouped_prices_api",
                           skips: bool = False) -> DataFrame:
    """17-field extract (raw values described by kind + cast value)."""
    f = FIELDS["grouped_prices"]
    e = prepare(entries(parse_objects(landing, f), "departure_date", f, skips), _fields("grouped_prices"))
    req_origin = F.col("origin")
    return e.select(
        F.concat_ws("_", key_part("airline"), key_part("flight_number"), F.col("destination"))
         .alias("ticket_id"),
        text("origin", req_origin).alias("origin"),
        F.col("destination"),
        text("departure_at").alias("departure_at"),
        kind("price").alias("price_kind"), as_double("price").alias("price"),
        F.col("currency"),
        text("airline").alias("airline"), text("flight_number").alias("flight_number"),
        kind("transfers").alias("transfers_kind"), as_int("transfers").alias("transfers"),
        kind("duration").alias("duration_kind"), as_int("duration").alias("duration"),
        text("origin_airport").alias("origin_airport"),
        text("destination_airport").alias("destination_airport"),
        text("link").alias("link"),
        F.lit(batch_ts.replace(" ", "T")).alias("extracted_at"),
        F.concat_ws("-", req_origin, F.col("destination")).alias("route"),
        F.col("departure_date"),
        F.lit(data_source).alias("data_source"),
        equals_zero("transfers").alias("is_direct"),
        cast_reason([("price", "double"), ("transfers", "int"), ("duration", "int")])
         .alias("reject_reason"),
        F.col("month"), F.col("poll"), req_origin.alias("request_origin"), *_skip(e))


def extract_calendar(landing: DataFrame, batch_ts: str,
                     data_source: str = "price_calendar_api",
                     skips: bool = False) -> DataFrame:
    f = FIELDS["calendar"]
    e = prepare(entries(parse_objects(landing, f), "date", f, skips), _fields("calendar"))
    return e.select(
        F.concat_ws("_", key_part("airline"), key_part("flight_number"), F.col("origin"),
                    F.col("destination"), F.col("date")).alias("ticket_id"),
        F.col("origin"), F.col("destination"),
        text("departure_at").alias("departure_at"), text("return_at").alias("return_at"),
        kind("price").alias("price_kind"), as_double("price").alias("price"),
        text("airline").alias("airline"), text("flight_number").alias("flight_number"),
        kind("transfers").alias("transfers_kind"), as_int("transfers").alias("transfers"),
        text("expires_at").alias("expires_at"),
        F.lit(batch_ts.replace(" ", "T")).alias("extracted_at"),
        F.concat_ws("-", F.col("origin"), F.col("destination")).alias("route"),
        F.col("date"), F.lit(data_source).alias("data_source"),
        equals_zero("transfers").alias("is_direct"),
        cast_reason([("price", "double"), ("transfers", "int")]).alias("reject_reason"),
        F.col("month"), F.col("poll"), *_skip(e))


def extract_directions(landing: DataFrame, batch_ts: str,
                       data_source: str = "city_directions_api",
                       skips: bool = False) -> DataFrame:
    f = FIELDS["directions"]
    e = prepare(entries(parse_objects(landing, f), "dest_key", f, skips), _fields("directions"))
    return e.select(
        F.col("origin"), F.col("dest_key").alias("destination"),
        kind("price").alias("price_kind"), as_double("price").alias("price"),
        text("airline").alias("airline"), text("flight_number").alias("flight_number"),
        text("departure_at").alias("departure_at"), text("return_at").alias("return_at"),
        text("expires_at").alias("expires_at"),
        kind("transfers").alias("transfers_kind"), as_int("transfers").alias("transfers"),
        F.lit(batch_ts.replace(" ", "T")).alias("extracted_at"),
        F.lit(data_source).alias("data_source"),
        equals_zero("transfers").alias("is_direct"),
        cast_reason([("price", "double"), ("transfers", "int")]).alias("reject_reason"),
        F.col("month"), F.col("poll"), *_skip(e))


def _stamp(batch_ts: str) -> Column:
    return F.lit(batch_ts.replace(" ", "T"))


def accepted(ext: DataFrame) -> DataFrame:
    """Good rows of an extract that is not stored.  A generator rather than a filter,
    which would be pushed below the projections and parse every ticket once more."""
    one = F.explode(F.when(F.col("reject_reason").isNull(), F.array(F.lit(1))))
    return ext.select("*", one.alias("_one")).drop("_one")


def normalize_tickets(ext: DataFrame, batch_ts: str) -> DataFrame:
    """Good rows -> the 14 cheap-ticket columns."""
    return ticket_columns(ext.where(F.col("reject_reason").isNull()), batch_ts)


def ticket_columns(good: DataFrame, batch_ts: str) -> DataFrame:
    return good.select("ticket_id", "origin", "destination", "departure_at", "price", "airline",
                       "flight_number", F.col("transfers").cast("int").alias("transfers"),
                       F.col("duration").cast("int").alias("duration"), "is_direct",
                       price_bucket(F.col("price")).alias("price_category"), "extracted_at",
                       _stamp(batch_ts).alias("processed_at"), "route")


def normalize_directions(ext: DataFrame, batch_ts: str) -> DataFrame:
    g = ext.where(F.col("reject_reason").isNull())
    return g.select("origin", "destination", "price", "airline", "flight_number",
                    "departure_at", "return_at", "expires_at",
                    F.col("transfers").cast("int").alias("transfers"), "is_direct",
                    popularity_bucket(F.col("price")).alias("popularity_category"),
                    "extracted_at", _stamp(batch_ts).alias("processed_at"))


def normalize_trends(ext: DataFrame, batch_ts: str) -> DataFrame:
    g = ext.where(F.col("reject_reason").isNull())
    return g.select("ticket_id", "origin", "destination", "departure_at", "return_at", "price",
                    "airline", "flight_number", F.col("transfers").cast("int").alias("transfers"),
                    "is_direct", "expires_at",
                    price_bucket(F.col("price")).alias("trend_category"),
                    _stamp(batch_ts).alias("processed_at"), "route")


def to_store(norm: DataFrame) -> DataFrame:
    """Store edge: '' is NULL, booleans are 0/1, money is decimal(18,2)."""
    cols = []
    for f in norm.schema.fields:
        c = F.col(f.name)
        t = f.dataType.simpleString()
        if t == "string":
            c = empty_as_null(c)
        elif t == "boolean":
            c = c.cast("int")
        elif f.name == "price":
            c = c.cast("decimal(18,2)")
        cols.append(c.alias(f.name))
    return norm.select(*cols)


def quarantine(feed: str, landing_parsed: DataFrame, extracted: DataFrame,
               key_col: str) -> DataFrame:
    """Object-level skips and row-level cast failures of one feed."""
    # one row per object not fully loaded; a generator rather than a filter
    # on ``status`` keeps the JSON parses out of a pushed-down condition
    skipped = F.when(F.col("status") != "ok", F.array(F.col("status")))
    objs = landing_parsed.select(F.lit(feed).alias("feed"), "origin", "destination", "month", "poll",
                                 F.lit(None).cast("string").alias("entry_key"),
                                 F.explode(skipped).alias("reason"))
    dest = F.col("destination")
    origin = F.col("request_origin" if "request_origin" in extracted.columns else "origin")
    rows = (extracted.where(F.col("reject_reason").isNotNull())
            .select(F.lit(feed).alias("feed"), origin.alias("origin"), dest.alias("destination"),
                    "month", "poll", F.col(key_col).alias("entry_key"),
                    F.col("reject_reason").alias("reason")))
    return objs.unionByName(rows)


def quarantine_of(feed: str, extracted: DataFrame, key_col: str, stored: bool = True) -> DataFrame:
    """The quarantine of an extract made with ``skips``, without parsing again.  One that is
    not ``stored`` is cut by a generator, as in ``accepted``."""
    origin = F.col("request_origin" if "request_origin" in extracted.columns else "origin")
    skipped = F.col("object_status").isNotNull()
    out = skipped | F.col("reject_reason").isNotNull()
    rows = extracted.where(out) if stored else extracted.select("*", F.explode(F.when(out, F.array(F.lit(1)))).alias("_one"))
    return (rows.select(F.lit(feed).alias("feed"), origin.alias("origin"), "destination", "month", "poll",
                    F.when(~skipped, F.col(key_col)).alias("entry_key"),
                    F.coalesce("object_status", "reject_reason").alias("reason")))
