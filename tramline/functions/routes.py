"""Route types and the names of lines, agencies and feeds, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Basic types 0 to 12, and the hundreds groups of the extended types.
EXTENDED_GROUPS = [1, 2, 4, 7, 8, 9, 10, 11, 12, 13, 14, 15, 17]
BUS_FERRY_BASIC = [3, 4]
BUS_FERRY_GROUPS = [2, 7, 10, 11, 12, 13, 15, 17]


def is_route_type(x: Column) -> Column:
    """Whether a number is a known route type; null is not."""
    n = x.cast("double")
    known = (n == F.floor(n)) & (n.between(0, 12) | F.floor(n / 100).cast("int").isin(EXTENDED_GROUPS))
    return F.coalesce(known, F.lit(False))


def is_bus_or_ferry_route_type(x: Column, strict: bool = False) -> Column:
    """Whether it is a bus or ferry; an unknown type is an error if ``strict``, else false."""
    n = x.cast("double")
    yes = is_route_type(x) & (n.isin(BUS_FERRY_BASIC) | F.floor(n / 100).cast("int").isin(BUS_FERRY_GROUPS))
    if strict:
        return F.when(is_route_type(x), yes).otherwise(F.raise_error(F.concat(F.lit("unknown route type "), F.coalesce(x.cast("string"), F.lit("null")))).cast("boolean"))
    return yes


def blank(text: Column) -> Column:
    """Null for a blank text, else the text."""
    return F.when(F.trim(text) != "", text)


def route_type_or_zero(x: Column) -> Column:
    return F.coalesce(x.try_cast("double").try_cast("int"), F.lit(0))


def line_name(short: Column, long: Column) -> Column:
    return F.coalesce(F.nullif(short, F.lit("")), F.nullif(long, F.lit("")), F.lit(""))


def agency_key(feed: Column, agency: Column) -> Column:
    return F.concat(feed, F.lit(":"), F.coalesce(blank(agency), F.lit("default")))


def color_index(name: Column, line_id: Column) -> Column:
    """0 to 255 by the name's hash; a nameless line uses its id."""
    text = F.coalesce(F.nullif(name, F.lit("")), line_id.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long"), F.lit(256)).cast("int")


def safe_file_name(feed: Column) -> Column:
    return F.regexp_replace(feed, r"(?U)[^\w\-.]", "_")


def safe_double(x: Column) -> Column:
    """The number, or null where there is none (NaN counts as none)."""
    n = F.trim(x.cast("string")).try_cast("double")
    return F.when(~F.isnan(n), n)
