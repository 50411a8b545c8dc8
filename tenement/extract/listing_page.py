"""What a stored page of one rental listing tells, as one struct of fixed fields, texts as they stand on the page."""

from __future__ import annotations

import re
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.listing import PROPERTY
from .html import extract_details
from .tree import find, has, inside, texts, tree

LISTING = ("title string, deal_time array<string>, breadcrumb array<string>, tags array<string>, property_type string, floor_ping string, floor string, building_type string, price string, deposit string, "
           "rough_address string, rough_coordinate string, services map<string,string>, supported_facility array<string>, unsupported_facility array<string>, promotion array<string>, description array<string>, "
           "misc map<string,array<string>>, author_name string, agent_org string, author_phone string, error boolean, parse_errors array<string>")
#: Plausible latitudes and longitudes of the islands, as the map's address has them.
PLACE = re.compile(r"(2\d\.\d+),(1[12]\d\.\d+)")
PARKING = PROPERTY[4]
#: Fixed value: the label of the house rules.
RULE = "房屋守則"


def first(found: list[str]) -> str | None:
    return found[0] if found else None


def pattern(breadcrumb: list[str], items: list[str]) -> dict[str, str | None]:
    """Property type, size, floor and building type by their number: parking lots tell none, and a size and a floor stand only among four."""
    if breadcrumb[2:3] == [PARKING]:
        return {"property_type": PARKING}
    out = {"property_type": first(items)}
    if len(items) >= 4:
        return out | dict(zip(("floor_ping", "floor", "building_type"), items[1:4], strict=True))
    return out | {"building_type": items[1] if len(items) >= 2 else None}


def coordinate(href: str | None) -> str | None:
    """``lat,lng`` of a map link's query."""
    found = PLACE.search(parse_qs(urlparse(href or "").query).get("q", [""])[0])
    return f"{found.group(1)},{found.group(2)}" if found else None


def labelled(items: list, label, value) -> dict[str, list[str]]:
    """Contents by their label; the last one of equal labels stays."""
    pairs = [(texts(find(i, label)), texts(find(i, value))) for i in items]
    return {k[0]: v for k, v in pairs if k and v}


def parse_listing(html: str) -> tuple:
    """What LISTING names. ``parse_errors`` names fields that a found page must tell and does not. Where no deposit stands beside the price, the price is read as the deposit (which makes
    its kind "other"), as in the data published so far."""
    page = tree(html)
    at = lambda *steps: texts(find(page, *steps))
    title = find(page, has("title"), has(tag="h1"))
    breadcrumb = at(has("crumbs"), has("t5-link", tag="a"))
    house_price = find(page, has("house-price"))
    services = {k: v[0] for k, v in labelled(inside(find(page, has("service"), has("service-cate")), has(tag="div")), has(tag="p"), has(tag="span")).items()}
    facilities = find(page, has("service"), has("service-facility"))
    promotion = find(page, has("preference-item"), lambda e: e.tag == "p" and next(e.parent.children()) is e)
    map_link = next((e.attrs.get("href") for e in find(page, has("google-maps-link"))), None)
    card = find(page, has("contact-card"))
    got = {
        "title": next((e.own_text() for e in title), None), "deal_time": at(has("title"), has("tag-deal")), "breadcrumb": breadcrumb,
        "tags": texts(inside(find(page, has("house-label")), has(tag="span"))), **pattern(breadcrumb, texts(inside(find(page, has("pattern")), has(tag="span", without="line")))),
        "price": first(texts(find(house_price, has("c-price"), has("inline-flex-row")))), "deposit": first(texts(house_price)), "rough_address": first(at(has("address"), has("load-map"))), "rough_coordinate": coordinate(map_link),
        "services": services, "supported_facility": texts(find(facilities, has(tag="dl", without="del"), has(tag="dd"))), "unsupported_facility": texts(find(facilities, has("del", tag="dl"), has(tag="dd"))),
        "promotion": texts(promotion), "description": [t for t in (e.text().replace("\xa0", "").strip() for e in find(page, has("house-condition"), has("house-condition-content"), has("article"))) if t],
        "misc": labelled([*find(page, has("house-detail"), has("content", "left"), has("item")), *find(page, has("house-detail"), has("content", "right"), has("item"))], has("label"), has("value")),
        "author_name": first(texts(find(card, has("name")))), "agent_org": first(texts(find(card, has("econ-name")))),
        "author_phone": first(texts(inside(find(card, has("phone"), has("contact-action-lg"), has(tag="button"), has(tag="span")), has(tag="span")))),
        "error": bool(find(page, has("error-info"))),
    }
    missing = [] if got["error"] else [k for k in ("title", "breadcrumb", "price", "author_name") if not got[k]]
    return (*[got.get(c.split()[0]) for c in LISTING.split(", ")[:-1]], missing)


def listing_details(pages: DataFrame, key: str = "house_id", raw: str = "raw") -> DataFrame:
    """key and the fields of LISTING of every stored page; a page on which the parser fails gives nulls and the error's name, null pages give no row.

    Map only. Pages come in Arrow batches; a page is read whole, its tree takes some tens of times its size.
    """
    return extract_details(pages, key, raw, parse_listing, LISTING)


def raw_listings(pages: DataFrame, key: str = "house_id", raw: str = "raw") -> DataFrame:
    """Rows that ``normalize_listings`` takes, of the pages that could be parsed: what they tell, with the key as house_id, answered with 200, ``rule`` from the house rules."""
    rows = listing_details(pages, key, raw).where("error is not null")
    told = [c for c in rows.columns if c not in (key, "services", "parse_errors")]
    return rows.select(F.col(key).cast("string").alias("house_id"), F.lit(200).alias("http"), F.lit(None).cast("string").alias("url"), *told, F.col("services")[RULE].alias("rule"))
