"""Patch-style upserts and work-list clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.keyed import KeyedTable
from .history import DEAL, NOT_FOUND


def upsert_patches(base: DataFrame, items: DataFrame, key: Sequence[str], seq: str, status: str, fields: Sequence[str], present: str | None = None, keep_deal: bool = True) -> DataFrame:
    """``base`` (one row per key) with the items of a batch: new keys come in, fields that an item carries replace what is held (a carried null too),
    in the order of ``seq``. With ``keep_deal`` a NOT_FOUND after a DEAL leaves the DEAL, as in the table of latest states; history takes it.

    One shuffle by key: items fold to one row per key first, with partial aggregation, then meet the base in a full outer join.
    """
    def last(c: str):
        carried = F.array_contains(present, c) if present else F.lit(True)
        return F.max_by(F.struct(F.col(c).alias("value")), F.when(carried, F.col(seq))).alias(f"_new_{c}")

    real = F.max_by(status, F.when(F.col(status) != NOT_FOUND, F.col(seq))).alias("_real")
    new = items.groupBy(*key).agg(F.max_by(status, seq).alias("_last"), real, *map(last, fields), F.max(seq).alias("_seq"))
    both = base.select(*key, status, *fields, seq).join(new, list(key), "full_outer")
    kept = (F.col("_last") == NOT_FOUND) & (F.coalesce("_real", status) == DEAL) & F.lit(keep_deal)
    values = [F.when(F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}.value")).otherwise(F.col(c)).alias(c) for c in fields]
    return both.select(*key, F.when(kept, DEAL).otherwise(F.coalesce("_last", status)).alias(status), *values, F.coalesce("_seq", seq).alias(seq))


def update_join(base: DataFrame, derived: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Write derived columns back where there is a derived value."""
    d = derived.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = base.join(d, key, "left")
    return out.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else c for c in base.columns])


def delete_first_duplicates(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Drop the least id of every group of several rows (one row per run)."""
    first = df.groupBy(*keys).agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col)
    return df.join(first, id_col, "left_anti")


RAW = ("list_raw", "detail_raw", "detail_dict")


def raw_table(spark, path: str, key: str = "house_id string", buckets: int = 64) -> KeyedTable:
    """What was read of every listing: the raw text of its list card and of its detail page, what the detail parser found, and a hash of each."""
    return KeyedTable(spark, path, ", ".join([key, *[f"{c} string, {c}_sha string" for c in RAW], "seq bigint"]), [key.split()[0]], buckets)


def upsert_raw(table: KeyedTable, items: DataFrame, token: str) -> int:
    """Merge items (the key, is_list, raw, dict, seq) into the raw table: the last raw text of either kind that an item carries, and the last dict, which only detail items may bring.

    Items whose texts are what is stored, by hash, do not count: a bucket in which nothing changed is not written again. For the comparison only hashes of the touched buckets are read.
    """
    key = table.key[0]
    listed = F.coalesce("is_list", F.lit(False))
    last = lambda value, when: F.max_by(value, F.when(when & F.col(value).isNotNull(), F.col("seq")))
    new = items.groupBy(key).agg(last("raw", listed).alias("list_raw"), last("raw", ~listed).alias("detail_raw"), last("dict", ~listed).alias("detail_dict"), F.max("seq").alias("seq"))
    new = new.withColumns({f"{c}_sha": F.sha2(F.col(c).cast("binary"), 256) for c in RAW}).persist()
    try:
        touched = [r.b for r in new.select(table.bucket().alias("b")).distinct().collect()]
        held = table.read(only=touched).select(F.col(key).alias("_key"), *[F.col(f"{c}_sha").alias(f"_{c}") for c in RAW])
        same = [F.col(f"{c}_sha").isNull() | F.coalesce(F.col(f"{c}_sha") == F.col(f"_{c}"), F.lit(False)) for c in RAW]
        changed = new.join(held, F.col(key) == F.col("_key"), "left").where(F.col("_key").isNull() | ~(same[0] & same[1] & same[2])).select(*new.columns)

        def fold(base: DataFrame, add: DataFrame) -> DataFrame:
            both = base.join(add.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in new.columns if c != key]), F.col(key) == F.col("_key"), "full_outer")
            kept = [F.coalesce(f"_{c}{end}", f"{c}{end}").alias(f"{c}{end}") for c in RAW for end in ("", "_sha")]
            return both.select(F.coalesce(key, "_key").alias(key), *kept, F.coalesce("_seq", "seq").alias("seq"))

        return table.merge(token, changed, fold)
    finally:
        new.unpersist()
