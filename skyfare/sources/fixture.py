"""Maps the driver's TPC-H-like tables onto flight tickets.

One ticket per ``lineitem`` row:

* ticket_id      ``l_orderkey || '_' || l_linenumber`` (collides on purpose:
                 the business key omits the date, like the source feed)
* origin         supplier's nation name; destination: customer's nation name
* departure_at   ship date rendered as text in one of eight shapes chosen by
                 ``l_orderkey % 8`` (one shape is unparsable on purpose)
* price          ``l_extendedprice`` as decimal(18,2)
* airline        ``p_brand``; flight_number ``'FL' || l_partkey``
* transfers      ``l_linenumber - 1``; duration ``l_quantity * 10`` minutes
* extracted_at   order date as ISO text

Airports are nations (city = region); the airline lookup is a rule over the
brands.  All of it is derived from the tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..functions.scalar import price_bucket
from .tables import read_table, spread

ODS_COLUMNS = ["ticket_id", "origin", "destination", "departure_at", "price",
               "airline", "flight_number", "transfers", "duration",
               "is_direct", "price_category", "extracted_at", "processed_at",
               "route"]


def departure_text(ship: Column, orderkey: Column, linenumber: Column) -> Column:
    hh = F.lpad(linenumber.cast("string"), 2, "0")
    iso = F.date_format(ship, "yyyy-MM-dd")
    ru = F.date_format(ship, "dd.MM.yyyy")
    shape = orderkey % 8
    return (F.when(shape == 0, F.concat(iso, F.lit("T"), hh, F.lit(":30:00")))
             .when(shape == 1, F.concat(iso, F.lit(" "), hh, F.lit(":30:00")))
             .when(shape == 2, iso)
             .when(shape == 3, F.concat(ru, F.lit(" "), hh, F.lit(":30:00")))
             .when(shape == 4, ru)
             .when(shape == 5, F.concat(iso, F.lit("T"), hh, F.lit(":30:00+03:00")))
             .when(shape == 6, F.date_format(ship, "yyyy-M-d"))
             .otherwise(F.date_format(ship, "dd/MM/yyyy")))


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order, part, and both nations: the one wide
    join every fixture table (ODS tickets, feed flights) is projected from.

    Join strategy is left to Catalyst/AQE: nation is tiny (broadcast by
    statistics); supplier/customer/part/orders join by shuffle when large.
    """
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    nat = nation_names(spark, sf_dir)
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("o"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("d"))
    # destination onto orders first (an orders-sized join), so the lineitem side
    # meets one table per key: orders, part, supplier.  The nations' names come
    # last, so that the shuffles move keys only
    orders = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "o_orderdate", "d")
    from_, to = (nat.select(F.col("n_nationkey").alias(f"{k}_key"), F.col("n_name").alias(name))
                 for k, name in (("o", "origin"), ("d", "destination")))
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey)
           .join(supp, li.l_suppkey == supp.s_suppkey)
           .join(from_, F.col("o") == F.col("o_key")).join(to, F.col("d") == F.col("d_key")))
    return j.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_shipdate", "o_orderdate", "p_brand",
                    "o", "d", "origin", "destination")


def ods_tickets(spark: SparkSession, sf_dir: str, cfg: RunConfig,
                lines: DataFrame | None = None) -> DataFrame:
    """The cheap-tickets ODS rows (14 columns) built from the driver tables
    (or from already joined ``lines``)."""
    j = lines if lines is not None else joined_lines(spark, sf_dir)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    transfers = (F.col("l_linenumber") - 1).cast("int")
    return j.select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("ticket_id"),
        F.col("origin"),
        F.col("destination"),
        departure_text(F.col("l_shipdate"), F.col("l_orderkey"),
                       F.col("l_linenumber")).alias("departure_at"),
        price.alias("price"),
        F.col("p_brand").alias("airline"),
        F.concat(F.lit("FL"), F.col("l_partkey").cast("string")).alias("flight_number"),
        transfers.alias("transfers"),
        (F.col("l_quantity").cast("int") * 10).alias("duration"),
        F.when(transfers == 0, 1).otherwise(0).alias("is_direct"),
        price_bucket(price).alias("price_category"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss").alias("extracted_at"),
        F.lit(cfg.batch_ts.replace(" ", "T")).alias("processed_at"),
        F.concat_ws("-", F.col("origin"), F.col("destination")).alias("route"),
    )


def airports(spark: SparkSession, sf_dir: str, cfg: RunConfig) -> DataFrame:
    """Airport dimension: one airport per nation, city = its region.

    Several airports share a city.  The nations listed in
    ``cfg.fixture_missing_airport_nations`` are left out, so tickets touching
    them meet the unknown-route path.
    """
    nat = read_table(spark, sf_dir, "nation")
    reg = read_table(spark, sf_dir, "region")
    return (nat.join(reg, nat.n_regionkey == reg.r_regionkey)
               .where(~F.col("n_nationkey").isin(list(cfg.fixture_missing_airport_nations)))
               .select((F.col("n_nationkey") + 1).cast("int").alias("airport_id"),
                       F.col("n_name").alias("airport_code"),
                       F.col("r_name").alias("city"),
                       F.col("r_name").alias("country")))


def _brand_no(c: Column) -> Column:
    return F.regexp_extract(c, r"(\d+)$", 1).cast("int")


def airline_lookup(spark: SparkSession, sf_dir: str, cfg: RunConfig,
                   previous: bool = False) -> DataFrame:
    """Airline code lookup (code, name, country) for the brands.

    Current release: ``Brand#n`` for n <= 18 -> ('Airline n', 'C' || n % 4).
    Previous release (replayed as the earlier SCD2 run): n <= 20 with
    country 'C' || n % 5.  Other codes fall to the (code, 'Unknown') default.
    """
    known = cfg.fixture_prev_known_brands if previous else cfg.fixture_known_brands
    mod = 5 if previous else 4
    n = _brand_no(F.col("p_brand"))
    return (read_table(spark, sf_dir, "part").select("p_brand").distinct()
            .where(n <= known)
            .select(F.col("p_brand").alias("code"),
                    F.concat(F.lit("Airline "), n.cast("string")).alias("name"),
                    F.concat(F.lit("C"), (n % mod).cast("string")).alias("country")))


def airline_snapshot(spark: SparkSession, sf_dir: str, cfg: RunConfig) -> DataFrame:
    """The non-versioned airline table: the first ten brands."""
    n = _brand_no(F.col("p_brand"))
    return (read_table(spark, sf_dir, "part").select("p_brand").distinct()
            .where(n <= cfg.fixture_snapshot_brands)
            .select(n.alias("airline_id"), F.col("p_brand").alias("airline_code"),
                    F.concat(F.lit("Airline "), n.cast("string")).alias("airline_name"),
                    F.concat(F.lit("C"), (n % 4).cast("string")).alias("country")))
