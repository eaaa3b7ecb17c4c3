"""Small value expressions, all safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """Timestamp of ISO text, null when it does not parse. Text without a zone is in UTC,
    whatever the session's zone is."""
    day = text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$")
    zoned = text.rlike(r"([zZ]|UTC|GMT|UT|[+-]\d{1,2}(:?\d{2}){0,2})\s*$")
    complete = F.when(day, F.concat(F.trim(text), F.lit("T00:00:00Z"))).when(zoned, text)
    return F.try_to_timestamp(complete.otherwise(F.concat(F.trim(text), F.lit("Z"))))


def utc_wall_time(moment: Column) -> Column:
    """What a clock in UTC shows at an instant, without a zone."""
    seconds = (F.unix_micros(moment) / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01T00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def first_entry(array: Column) -> Column:
    """First element, null for an empty or absent array."""
    return F.get(array, 0)


def without_zone(moment: Column) -> Column:
    """A stored instant as zone-free timestamp, in the zone of the plan."""
    return moment.cast("timestamp_ntz")


def percent_of(found: Column, expected: Column) -> Column:
    share = F.round(found / expected * 100, 2)
    return F.when(expected > 0, share).otherwise(F.lit(0.0))


def named(column: Column, excluded: list[str]) -> Column:
    """True when a name is present and none of the placeholder texts (exact match)."""
    return column.isNotNull() & ~column.isin(excluded)
