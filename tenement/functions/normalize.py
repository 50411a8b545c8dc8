"""Normalisation of scraped text as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_number(s: Column) -> Column:
    """Digits, dot and minus only; null when nothing is left or a minus stands inside."""
    kept = F.regexp_replace(s, r"[^\d.-]", "")
    return F.when((kept == "") | (F.locate("-", F.substring(kept, 2, 1 << 20)) > 0), None).otherwise(kept.try_cast("double"))


def clean_strings(a: Column) -> Column:
    """Without no-break spaces and blanks around; empty ones go."""
    return F.filter(F.transform(a, lambda s: F.regexp_replace(F.replace(s, F.lit("\u00a0"), F.lit("")), r"^\s+|\s+$", "")), lambda s: s != "")


def price_range(s: Column) -> tuple[Column, Column]:
    """monthly_price is the first number, min_monthly_price the second (names as published)."""
    p = F.split(s, "~")
    return clean_number(F.get(p, 0)), clean_number(F.get(p, 1))


def per_ping_price(price: Column, ping: Column, *fees: Column) -> Column:
    total = price
    for f in fees:
        total = total + F.coalesce(f, F.lit(0))
    return F.try_divide(total, ping)


def id_from_url(url: Column) -> Column:
    return F.element_at(F.split(F.split_part(url, F.lit("?"), F.lit(1)), "/"), -1)


def render_human(c: Column, kind: str, letters: bool = True) -> Column:
    """Text for people: ``-`` for null or empty, T/F or 1/0 for booleans and the texts ``true`` and ``false``, times with their zone."""
    yes, no = ("T", "F") if letters else ("1", "0")
    if kind == "boolean":
        return F.when(c.isNull(), "-").when(c, yes).otherwise(no)
    if kind == "time":
        return F.coalesce(F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss z"), F.lit("-"))
    s = c.cast("string")
    return F.when(s.isNull() | (s == ""), "-").when(s == "true", yes).when(s == "false", no).otherwise(s)


def render_machine(c: Column, kind: str) -> Column:
    """The typed value: null for null or empty text, booleans for the texts ``true`` and ``false``; times stay."""
    if kind in ("boolean", "time", "number"):
        return c
    if kind == "flag":
        return F.when(c == "true", True).when(c == "false", False)
    return F.nullif(c, F.lit(""))


def feature_mark(c: Column) -> Column:
    return F.when(F.length(c) > 0, F.concat(F.lit("_"), c))


# Chinese numerals of deposit months.
NUMERALS = "零一二三四五六七八九十"


def page_count(link: Column) -> Column:
    return F.coalesce(F.regexp_extract(link, r"page=(\d+)", 1).try_cast("long"), F.lit(1).cast("long"))


def timestamp_slot(ts: Column, told: date | None = None, hours: bool = False) -> Column:
    """Struct year, month, day, hour of the slot that a row is counted in. A day is one slot, hour 0, unless ``hours``; ``told`` is the day that a run stands for whatever the time says."""
    at = F.lit(told).cast("timestamp") if told else ts
    return F.struct(F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"), (F.hour(at) if hours else F.lit(0)).alias("hour"))


def period_label(day: Column, period: str) -> Column:
    """``YYYYMM``, ``YYYYQn`` or ``YYYY``."""
    year = F.year(day).cast("string")
    return {"month": F.date_format(day, "yyyyMM"), "quarter": F.concat(year, F.lit("Q"), F.quarter(day).cast("string")), "year": year}[period]


def author_key(truth: Column, secret: str) -> Column:
    """Stable pseudonym; the secret is a parameter kept outside the repository."""
    return F.sha2(F.concat(F.lit(secret), truth).cast("binary"), 256)


def within(v: Column, low: float, high: float) -> Column:
    """The value if strictly inside, else null."""
    return F.when((v > low) & (v < high), v)


def split_flags(m: Column) -> tuple[Column, Column]:
    """Keys that are true, keys that are false."""
    return F.map_keys(F.map_filter(m, lambda k, v: v)), F.map_keys(F.map_filter(m, lambda k, v: ~v))


def membership(a: Column, names: dict[str, str]) -> Column:
    """Struct of flags by name (is its word in the array), ``every`` (all words stand in an array of that many) and ``joined``; a null array has none and is joined to an empty text."""
    has = [F.coalesce(F.array_contains(a, word), F.lit(False)).alias(name) for name, word in names.items()]
    every = F.coalesce((F.size(a) == len(names)) & (F.size(F.array_intersect(a, F.array(*map(F.lit, names.values())))) == len(names)), F.lit(False))
    return F.struct(*has, every.alias("every"), F.coalesce(F.array_join(a, "/"), F.lit("")).alias("joined"))


def counted(counts: Column, *names: str) -> Column:
    """Struct of flags: is the count of that name over zero; false for null."""
    return F.struct(*[F.coalesce(counts[n] > 0, F.lit(False)).alias(n) for n in names])
