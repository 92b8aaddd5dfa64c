"""Calendar and time-zone expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS_PER_DAY = 96


def quarter_hour(ts: Column) -> Column:
    """Hour plus 0, .25, .5 or .75."""
    return F.hour(ts) + F.floor(F.minute(ts) / F.lit(15)) * F.lit(0.25)


def hour_fraction(ts: Column) -> Column:
    return F.floor(F.minute(ts) / F.lit(15)) * F.lit(0.25)


def day_of_week(ts: Column) -> Column:
    """Sunday = 0."""
    return F.dayofweek(ts) - F.lit(1)


def monday_first(dow: Column) -> Column:
    """Sunday-0 numbering to Monday-0 numbering."""
    return F.pmod(dow + F.lit(6), F.lit(7))


def to_local(ts: Column, zone: Column) -> Column:
    """UTC wall clock to the row's zone, as a zone-less timestamp."""
    return F.convert_timezone(F.lit("UTC"), zone, ts)


def utc_offset(utc: Column, local: Column) -> Column:
    """Whole hours between local and UTC wall clock."""
    return F.timestamp_diff("HOUR", utc, local).cast("int")


def eastern_standard_date(ts: Column) -> Column:
    """Date five hours behind UTC all year (no daylight saving)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("-05:00"), ts))
