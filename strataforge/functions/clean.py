"""Cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import DEVICE_ALIASES, EMAIL, EVENT_CATEGORIES, IPV4, IPV6, NULL_LIKE


def collapse(c: Column) -> Column:
    """Trimmed text; null for tokens that mean no value."""
    t = F.trim(c)
    return F.when(F.lower(t).isin(*NULL_LIKE), None).otherwise(t)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))


def nonblank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def snake(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s-]+", "_")


def device(c: Column) -> Column:
    """Device with aliases resolved; no value is ``unknown``."""
    t = F.lower(collapse(c))
    mapped = F.coalesce(*[F.when(t == a, F.lit(b)) for a, b in DEVICE_ALIASES.items()], t)
    return F.coalesce(mapped, F.lit("unknown"))


def event_category(c: Column) -> Column:
    out = None
    for name, types in EVENT_CATEGORIES.items():
        out = F.when(c.isin(*types), name) if out is None else out.when(c.isin(*types), name)
    return out.otherwise("other")


def good_email(c: Column) -> Column:
    return F.trim(c).rlike(EMAIL)


def good_ip(c: Column) -> Column:
    t = F.trim(c)
    return t.rlike(IPV4) | t.rlike(IPV6)


#: Formats of event times, tried in order.
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss")


def event_time(c: Column) -> Column:
    """A timestamp by any known format or null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in TIMESTAMP_FORMATS], c.try_cast("timestamp"))
