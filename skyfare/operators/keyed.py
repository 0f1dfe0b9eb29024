"""Document and key-value views of the ODS.

* documents: one JSON document per row (``to_json(struct(*))``), appended
  as JSON-lines files; queries are filters / counts / group counts.
* documents of any shape: one VARIANT per row in parquet; a query names the paths it
  needs, and only those are read (no schema is fixed, nothing is parsed again).
* key-value: a hash per key (``ticket:{id}``, ``direction:{o}:{d}``,
  ``price_trend:{id}``) whose fields are the row's values as text (booleans
  as 0/1, NULL as '').  Writes are upserts, last write wins; on immutable
  files an upsert is ``union`` + one aggregate per key taking the latest
  write, written as the next version of the table.  The aggregate is
  partial map-side, so a hot key is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, FractionalType, NumericType

TICKET_KEY = ("ticket:", ["ticket_id"])
DIRECTION_KEY = ("direction:", ["origin", "destination"])
TREND_KEY = ("price_trend:", ["ticket_id"])


def plain_double(c: Column) -> Column:
    """A double as text with as few digits as name it: written out between 1e-4
    and 1e16 (``10000000.0``), with an exponent beyond (``1e+16``, ``1e-05``)."""
    short = c.cast("string")
    size = F.abs(c)
    digits = F.regexp_replace(short.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    written = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    base = F.regexp_replace(F.regexp_extract(short, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(short, r"E(-?[0-9]+)$", 1)
    sign = F.when(power.startswith("-"), F.lit("-")).otherwise(F.lit("+"))
    raised = F.concat(base, F.lit("e"), sign, F.lpad(F.regexp_replace(power, "^-", ""), 2, "0"))
    return (F.when(~short.contains("E"), short)
             .when((size >= 1e-4) & (size < 1e16), written)
             .otherwise(raised))


def field_text(df: DataFrame, name: str) -> Column:
    """A value as the key-value store keeps it: bool -> 0/1, number -> text,
    NULL -> ''."""
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, BooleanType):
        c = c.cast("int")
    if isinstance(t, FractionalType) and not isinstance(t, DecimalType):
        c = plain_double(c)
    elif isinstance(t, (BooleanType, NumericType)):
        c = c.cast("string")
    return F.coalesce(c.cast("string"), F.lit(""))


def kv_key(prefix: str, cols: list[str], sep: str = ":") -> Column:
    return F.concat(F.lit(prefix), F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"),
                                                                 F.lit("")) for c in cols]))


def kv_encode(df: DataFrame, prefix: str, key_cols: list[str]) -> DataFrame:
    """(key, fields map<string,string>) per row."""
    pairs = []
    for f in df.columns:
        pairs += [F.lit(f), field_text(df, f)]
    return df.select(kv_key(prefix, key_cols).alias("key"), F.create_map(*pairs).alias("fields"))


def _write(seq: Column, order: list[Column], names: list[str] | None = None) -> Column:
    """A write as one struct that orders like the writes and holds the fields: the stamp, the
    place inside its load, then the field texts, which tell equal stamps and places apart, so
    the same writes leave the same store however they are partitioned.  Field names that all
    writes share (``names``) are left out; ``_named`` adds them once the latest are found."""
    keys = [] if names else [F.map_keys("fields").alias("_keys")]
    return F.struct(seq.alias("_seq"), *order, F.map_values("fields").alias("_values"), *keys)


def _named(merged: DataFrame, names: list[str] | None) -> DataFrame:
    """Merged writes with the field names that they were merged without."""
    if not names:
        return merged
    return merged.withColumn("write", F.struct("write.*", F.array(*[F.lit(n) for n in names]).alias("_keys")))


def kv_writes(batch: DataFrame, seq: Column, order: list[str], names: list[str] | None = None) -> DataFrame:
    """(key, write): per key the latest write of a load, to be appended to a store that
    keeps all loads' rows of a key together.  ``names``: the fields, if all hashes have the same."""
    w = batch.select("key", _write(seq, [F.col(c).cast("string").alias(c) for c in order], names).alias("write"))
    return _named(kv_merged(w), names)


def kv_merged(writes: DataFrame) -> DataFrame:
    """(key, write): the latest write of every key.  On a table bucketed by key this is
    one aggregate without a shuffle."""
    return writes.groupBy("key").agg(F.max("write").alias("write"))


def kv_fields(merged: DataFrame) -> DataFrame:
    """(key, fields) of merged writes."""
    return merged.select("key", F.map_from_arrays("write._keys", "write._values").alias("fields"))


def kv_upsert(store: DataFrame | None, batch: DataFrame, seq: Column,
              order: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """Next store version: per key the fields of the latest write.

    ``seq`` orders writes (the load stamp); ``order`` are batch columns
    giving the write order inside one load (e.g. the feed's entry order);
    what is left is ordered by the field texts.  ``names``: the fields, if all hashes
    of a first batch have the same.
    """
    order, names = order or [], names if store is None else None
    w = batch.select("key", _write(seq, [F.col(c) for c in order], names).alias("write"))
    if store is not None:
        nulls = [F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in order]
        w = store.select("key", _write(F.col("_seq"), nulls).alias("write")).unionByName(w)
    return _store(_named(kv_merged(w), names))


def _store(merged: DataFrame) -> DataFrame:
    return merged.select("key", F.col("write._seq").alias("_seq"),
                         F.map_from_arrays("write._keys", "write._values").alias("fields"))


def kv_store(df: DataFrame, prefix: str, key_cols: list[str], seq: str, order: list[str]) -> DataFrame:
    """The first store of rows: ``kv_upsert`` of their hashes, ordered by the texts of the
    columns ``seq`` and ``order``.  The hashes of one table have the same fields, so their
    texts are merged as an array, and only the latest of a key become a map."""
    text = {c: field_text(df, c) for c in df.columns}
    write = F.struct(text[seq].alias("_seq"), *[text[c].alias(f"_{c}") for c in order],
                     F.array(*text.values()).alias("_values"))
    w = df.select(kv_key(prefix, key_cols).alias("key"), write.alias("write"))
    return _store(_named(kv_merged(w), df.columns))


def kv_lookup(store: DataFrame, keys: DataFrame) -> DataFrame:
    """HGETALL for a list of keys: a semi join on the key."""
    return store.join(keys.select("key").distinct(), "key", "left_semi")


def kv_prefix_scan(store: DataFrame, prefix: str) -> DataFrame:
    """KEYS prefix*: the predicate is a plain ``startswith`` on the key."""
    return store.where(F.col("key").startswith(prefix)).select("key")


def kv_field_count(store: DataFrame) -> DataFrame:
    """HLEN per key."""
    return store.select("key", F.size("fields").alias("n_fields"))


def kv_size(store: DataFrame) -> DataFrame:
    """DBSIZE."""
    return store.agg(F.count(F.lit(1)).alias("n_keys"))


# ---- documents ---------------------------------------------------------------

def write_documents(df: DataFrame, path: str, mode: str = "append") -> str:
    (df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).option("compression", "gzip")
     .option("maxRecordsPerFile", "200000").option("zlib.compress.level", "BEST_SPEED").text(path))
    return path


def read_documents(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def doc_find_eq_count(docs: DataFrame, field: str, value) -> DataFrame:
    return docs.where(F.col(field) == F.lit(value)).agg(F.count(F.lit(1)).alias("matches"))


def doc_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("documents"))


def doc_group_count(docs: DataFrame, field: str) -> DataFrame:
    return docs.groupBy(field).agg(F.count(F.lit(1)).alias("documents"))


# ---- documents of any shape ------------------------------------------------------

def write_variants(df: DataFrame, path: str, mode: str = "append") -> str:
    """Append each row as one document; later rows may have other fields."""
    df.select(F.parse_json(F.to_json(F.struct(*df.columns))).alias("doc")).write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc variant").parquet(path)


def at_path(path: str, type_: str = "string") -> Column:
    """The value at a JSON path (``$.airports.origin``) as a type; NULL where a document
    has no such field, or one that does not cast."""
    return F.try_variant_get("doc", path, type_)


def path_find(docs: DataFrame, where: dict[str, str], *paths: str) -> DataFrame:
    """The named paths of the documents whose values equal ``where``."""
    cond = F.lit(True)
    for p, v in where.items():
        cond = cond & (at_path(p) == F.lit(v))
    return docs.where(cond).select(*[at_path(p).alias(p.split(".")[-1]) for p in paths])


def path_group(docs: DataFrame, path: str, name: str) -> DataFrame:
    """Documents per value at a path."""
    return docs.groupBy(at_path(path).alias(name)).agg(F.count(F.lit(1)).alias("documents"))
