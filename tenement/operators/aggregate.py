"""Release and audit aggregations with column-name parameters."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_mode(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key; every column takes its most frequent value (null skipped, ties: the least)."""
    return df.groupBy(*key).agg(*[F.mode(c, True).alias(c) for c in columns])


def top_values(df: DataFrame, keys: Sequence[str], column: str, k: int = 3) -> DataFrame:
    """keys, place (1 to k), value, n: the k most frequent values of a column per key, null skipped, ties to the least; exact.

    No task holds the values of a key: pairs of key and value are counted by both (partial counts first, then a spilling aggregate, so a hot key is dealt over all tasks by its values), and of
    each partition only the k best rows of a key go on to the ranking.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "value"))
    return counts.select(*keys, place.cast("long").alias("place"), "value", "n").where(F.col("place") <= k)


def mode_by_count(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """merge_mode for keys with very many values: column by column through counts, without a map of a key's values in memory; a join per column instead."""
    out = df.select(*key).distinct()
    for c in columns:
        top = top_values(df, key, c, 1).select(*[F.col(x).alias(f"_{x}") for x in key], F.col("value").alias(c))
        same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in key]
        out = out.join(top, functools.reduce(lambda a, b: a & b, same), "left").drop(*[f"_{x}" for x in key])
    return out


def dedup_extent(df: DataFrame, keys: Sequence[str], id_col: str, x: str, y: str, author: str) -> DataFrame:
    """The older form of de-duplication: rows of equal attributes with their number, the greatest id and author as text, and the bounding box of their places; by the greatest id."""
    return df.groupBy(*keys).agg(F.count(id_col).alias("n_dup"), F.max(id_col).alias("max_id"), *extent(x, y), F.max(F.col(author).cast("string")).alias("author")).orderBy("max_id")


def loss_estimate(df: DataFrame, period: str, old: Column, id_col: str, baseline: Column) -> DataFrame:
    """Per period: n_rows, the share of rows of the old form, listings told, and what they would be if the share were as in the baseline periods on average: expected, and loss, the part that
    is missing. ``baseline`` is a condition on the period. One row per period is broadcast."""
    of = df.groupBy(period).agg(F.count(F.lit(1)).alias("n_rows"), (F.count_if(old) / F.count(F.lit(1))).alias("share"), F.count_distinct(id_col).alias("told"))
    base = of.where(baseline).agg(F.avg("share").alias("_base"))
    out = of.join(F.broadcast(base), F.col("_base").isNotNull(), "left").withColumn("expected", F.try_divide(F.col("told") * F.col("_base"), F.col("share")))
    return out.select(period, "n_rows", "share", "told", "expected", F.try_divide(F.col("expected") - F.col("told"), F.col("expected")).alias("loss"))


def dedup_listings(df: DataFrame, keys: Sequence[str], id_col: str, modes: Sequence[str] = (), maxima: Sequence[str] = (), minima: Sequence[str] = (), ordered: bool = False) -> DataFrame:
    """One row per set of equal attributes, with the number of rows and the id range; null attributes group together. ``ordered`` lists the
    most repeated first, then by id."""
    out = df.groupBy(*keys).agg(F.count(id_col).alias("n_dup"), F.max(id_col).alias("max_id"), F.min(id_col).alias("min_id"), *[F.mode(c, True).alias(f"mode_{c}") for c in modes],
                                *[F.max(c).alias(f"max_{c}") for c in maxima], *[F.min(c).alias(f"min_{c}") for c in minima])
    return out.orderBy(F.desc("n_dup"), F.desc("max_id")) if ordered else out


def extent(x: str, y: str) -> list:
    """Bounding box of points as four aggregates."""
    return [f(c).alias(f"{n}_{c}") for c in (x, y) for n, f in (("min", F.min), ("max", F.max))]


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def audit_static(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys that appear with more than one combination of attributes that should not change."""
    combos = df.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("rows"))
    return combos.groupBy(key).agg(F.count(F.lit(1)).alias("n_combos"), F.max("rows").alias("top_rows")).where("n_combos > 1")


def audit_small_diff(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Keys of which some field's largest value is over twice the least, not negative one: each once, with its fields."""
    bounds = df.groupBy(key).agg(*[F.struct(F.lit(c).alias("field"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c) for c in fields])
    wide = F.filter(F.array(*fields), lambda b: (b["high"] / 2 > b["low"]) & (b["low"] >= 0))
    return bounds.select(key, wide.alias("fields")).where(F.size("fields") > 0)


def daily_stats(history: DataFrame, requests: DataFrame, items: DataFrame, vendor: str = "vendor", status: str = "status", kind: str = "kind", listing: str = "list") -> DataFrame:
    """Per vendor of one slot: remaining list and detail requests, crawled, closed and dealt rows, new items, and what was expected. Missing is 0.

    Each table is summed up on its own, so what is shuffled and united are rows per vendor.
    """
    parts = [
        requests.groupBy(vendor).agg(F.count_if(F.col(kind) == listing).alias("n_list_fail"), F.count_if(F.col(kind) != listing).alias("n_fail")),
        history.groupBy(vendor).agg(F.count_if(F.col(status).isin(0, 1, 2)).alias("n_crawled"), F.count_if(F.col(status) == 1).alias("n_closed"), F.count_if(F.col(status) == 2).alias("n_dealt")),
        items.groupBy(vendor).agg(F.count(F.lit(1)).alias("n_new_item")),
    ]
    every = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    names = ("n_list_fail", "n_fail", "n_crawled", "n_closed", "n_dealt", "n_new_item")
    out = every.groupBy(vendor).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return out.withColumn("n_expected", F.col("n_crawled") + F.col("n_fail"))


def failure_alerts(stats: DataFrame, vendor: str = "vendor") -> DataFrame:
    """Vendors with failed requests, with the message to send."""
    message = F.format_string("%s get failed list/detail (%d/%d) requests", vendor, "n_list_fail", "n_fail")
    return stats.where("n_fail > 0 or n_list_fail > 0").select(vendor, message.alias("message"))


def export_manifest(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and in total (``_total``)."""
    return df.rollup(key).agg(F.count(F.lit(1)).alias("n"), F.grouping(key).alias("g")).select(F.when(F.col("g") == 1, "_total").otherwise(F.col(key)).alias(key), "n")
