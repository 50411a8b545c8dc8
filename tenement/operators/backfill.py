"""Read stored pages again, range by range of their ids, with a ledger of what is done."""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..extract.listing_page import raw_listings
from ..functions.listing import NOT_FOUND, PROPERTY, normalize_listings
from ..sources.files import children, landed, write_small
from ..sources.keyed import KeyedTable
from .upsert import upsert_patches

#: What a listing tells whatever it is, and what only with a phone.
ALWAYS = ("top_region", "sub_region", "rough_address", "property_type", "monthly_price")
CONTACT = ("contact", "author", "agent_org")
ID, STATUS, SEQ = "vendor_house_id", "deal_status", "seq"


def listing_fields(normalized: DataFrame) -> list[str]:
    """Fields of a listing that an item may carry."""
    return [c for c in normalized.columns if c not in (ID, STATUS, SEQ, "present", "parse_errors")]


def listing_items(normalized: DataFrame) -> DataFrame:
    """Items for an upsert: ``present`` names what each listing carries. One that is gone carries its status alone, a parking lot the first fields, a second price only where there is
    one, the contact only with a phone."""
    rest = [c for c in listing_fields(normalized) if c not in (*ALWAYS, *CONTACT, "min_monthly_price")]
    names = lambda cs: F.array(*map(F.lit, cs))
    second = F.when(F.col("min_monthly_price").isNotNull(), names(["min_monthly_price"])).otherwise(F.expr("cast(array() as array<string>)"))
    lot = F.coalesce(F.col("property_type") == PROPERTY.index("車位"), F.lit(False))
    present = F.when(F.col(STATUS) == NOT_FOUND, F.expr("cast(array() as array<string>)")).when(lot, F.concat(names(ALWAYS), second)).otherwise(F.concat(names(ALWAYS), second, names(rest), F.coalesce("present", F.expr("cast(array() as array<string>)"))))
    return normalized.withColumn("present", present)


def listing_schema(normalized: DataFrame) -> str:
    """Columns of the table that holds the listings."""
    kinds = {f.name: f.dataType.simpleString() for f in normalized.schema}
    return ", ".join(f"`{c}` {kinds[c]}" for c in (ID, STATUS, *listing_fields(normalized))) + f", {SEQ} bigint"


def parsed_items(pages: DataFrame, regions: DataFrame, key: str, raw: str, seq: int) -> DataFrame:
    return listing_items(normalize_listings(raw_listings(pages, key, raw), regions)).withColumn(SEQ, F.lit(seq).cast("long"))


def listing_table(pages: DataFrame, regions: DataFrame, path: str, key: str = "house_id", raw: str = "raw", buckets: int = 64) -> KeyedTable:
    """The keyed table of listings that pages of this kind fill."""
    return KeyedTable(pages.sparkSession, path, listing_schema(parsed_items(pages, regions, key, raw, 0)), [ID], buckets)


def reparse_ranges(pages: DataFrame, regions: DataFrame, target: KeyedTable, ledger: str, key: str = "house_id", raw: str = "raw", size: int = 30_000, seq: int = 1, limit: int | None = None, parts: int | None = None) -> list[int]:
    """Parse the stored pages again and upsert what they tell into ``target``; the ranges of ``size`` ids that were done now.

    ``pages`` has one page per whole-number key; null pages and keys are left out, and so are pages that cannot be parsed (a range's ledger entry counts them). A range is read by a filter on
    the key, parsed, normalised and merged as one batch, then noted in ``ledger``, a folder of one small file per range. A run that dies goes on at the first range without a note; if that one was merged, it is
    not merged again. ``parts`` deals a range's pages out over so many tasks by key, where few files hold them. ``limit`` stops after so many ranges. ``seq`` orders this run's items after those of earlier ones. The driver gets the range numbers, one per ``size`` ids.
    """
    spark = pages.sparkSession
    number = F.floor(F.col(key) / size)
    stored = landed(pages, raw).where(F.col(key).isNotNull())
    due = sorted({r.k for r in stored.select(number.alias("k")).distinct().collect()} - {int(n) for n in children(spark, ledger) if n.lstrip("-").isdigit()})
    done = []
    for k in due[:limit]:
        rows = stored.where(F.col(key).between(k * size, (k + 1) * size - 1))
        rows = rows.repartition(parts, key) if parts else rows
        items = parsed_items(rows, regions, key, raw, seq).persist(StorageLevel.DISK_ONLY)
        try:
            fields = [c for c in listing_fields(items) if c != SEQ]
            target.merge(f"{ledger}#{k}", items, lambda base, new: upsert_patches(base, new, [ID], SEQ, STATUS, fields, "present"))  # noqa: B023  called at once
            write_small(spark, f"{ledger}/{k}", json.dumps({"pages": rows.count(), "items": items.count()}))
        finally:
            items.unpersist()
        done.append(k)
    return done
