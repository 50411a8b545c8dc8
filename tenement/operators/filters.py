"""Listing filters."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def should_be_house(p: str = "property_type", per_ping: str = "per_ping_price", total: str = "total_floor", floor: str = "floor", ping: str = "floor_ping", building: str = "building_type") -> Column:
    """Strict preset: residential types, plausible floors, size and price (15000 kept)."""
    c = F.col
    return c(building).isin(0, 1, 2) & c(p).isin(0, 1, 2, 3) & (c(total) < 90) & (c(floor) < 90) & (c(floor) <= c(total) + 2) & (c(ping) < 500) & (c(per_ping) <= 15000)


def release_house(p: str = "property_type", per_ping: str = "per_ping_price", total: str = "total_floor", floor: str = "floor", ping: str = "floor_ping", building: str = "building_type") -> Column:
    """Release preset: parking kept, 15000 dropped, no floor-to-total rule."""
    c = F.col
    return c(building).isin(0, 1, 2) & c(p).isin(0, 1, 2, 3, 4) & (c(total) < 90) & (c(floor) < 90) & (c(ping) < 500) & (c(per_ping) < 15000)


def overlaps(first: str, last: str, start, end) -> Column:
    """Lifetime [first, last] meets the period."""
    return (F.col(first) <= end) & (F.col(last) >= start)


def period(start: date, end: date, created: str = "created", crawled: str = "crawled_at", told: str = "additional_fee") -> Column:
    """Listings with details whose life meets the days from ``start`` to ``end``, both included, in either order."""
    start, end = sorted((start, end))
    return F.col(told).isNotNull() & overlaps(created, crawled, F.lit(start), F.lit(end + timedelta(days=1)))


def worklist(append: bool = False, status: str = "deal_status", price: str = "monthly_price") -> Column:
    """Listings whose page is to be read: open ones; in append mode only those of which no price is known yet."""
    opened = F.col(status) == 0
    return opened & F.col(price).isNull() if append else opened
