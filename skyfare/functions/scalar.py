"""Small scalar expressions shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed


def price_bucket(price: Column, below: int = fixed.CHEAP_PRICE_BELOW,
                 low: str = "cheap", high: str = "normal") -> Column:
    return F.when(price < below, F.lit(low)).otherwise(F.lit(high))


def popularity_bucket(price: Column) -> Column:
    return price_bucket(price, fixed.POPULAR_PRICE_BELOW, "popular", "normal")


def flight_type_id(transfers: Column) -> Column:
    """0 -> 1 (direct), 1 -> 2 (one stop), anything else incl. NULL -> 3."""
    return (F.when(transfers == 0, 1).when(transfers == 1, 2)
            .otherwise(3).cast("int"))


def key_join(*parts: Column, sep: str = "_") -> Column:
    """Composite key; NULL parts count as '' (as an f-string of defaults)."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def oracle_concat(*parts: Column) -> Column:
    """Oracle ``a || b``: NULL behaves as the empty string."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def empty_as_null(c: Column) -> Column:
    """The store keeps '' as NULL."""
    return F.nullif(c, F.lit(""))


def round_avg(total: Column, n: Column, scale: int = 2) -> Column:
    """ROUND(sum/n, scale) done in exact decimal arithmetic, half away from
    zero, returned as DOUBLE.  ``total`` is a decimal sum."""
    return F.round(total / F.nullif(n, F.lit(0)), scale).cast("double")


def round_ratio_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """ROUND(part * 100.0 / whole, scale) exactly, as DOUBLE; NULL when whole=0."""
    # a decimal(28,2) numerator over a bigint keeps 12 digits of scale in
    # the quotient, so the final half-up rounding is exact for any count
    num = (part * F.lit(100)).cast("decimal(28,2)")
    return F.round(num / F.nullif(whole, F.lit(0)), scale).cast("double")
