"""Coordinates: both or neither, six decimals, within range."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgmetrics.functions.text import strip


def coordinates(latitude: Column, longitude: Column) -> Column:
    """``struct(latitude, longitude)`` from texts; one unreadable value voids the pair."""
    lat = F.round(strip(latitude).try_cast("double"), 6).try_cast("decimal(9,6)")
    lng = F.round(strip(longitude).try_cast("double"), 6).try_cast("decimal(9,6)")
    both = lat.isNotNull() & lng.isNotNull()
    return F.struct(F.when(both, lat).alias("latitude"), F.when(both, lng).alias("longitude"))


def latitude_valid(c: Column) -> Column:
    return c.isNull() | c.between(-90, 90)


def longitude_valid(c: Column) -> Column:
    return c.isNull() | c.between(-180, 180)
