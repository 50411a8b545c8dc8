"""Cards of stored list pages as rows of a table function, and the listing items that they tell."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.listing import OPENED, PROPERTY, _holds, card_contact, code_of, floors, list_region_key, region_code, tag_facilities
from ..functions.normalize import clean_number, price_range
from .tree import Element, clean, find, has, texts, tree

CARDS = ("pos int, kind string, house_id string, link string, title string, tags array<string>, property_type string, room_hall_info string, area string, floor string, community string, location string, "
         "nearby_landmark string, distance_to_landmark string, contact_info string, update_time string, view_count string, price string, images array<string>, is_featured boolean, is_preferred boolean, parse_errors array<string>")
NAMES = [c.split()[0] for c in CARDS.split(", ")]


def pieces(elements: list[Element]) -> list[str]:
    """Texts that stand right in the elements, each by itself."""
    return clean([p for e in elements for p in e.parts if isinstance(p, str)])


def _at(found: list[str], i: int) -> str | None:
    return found[i] if i < len(found) else None


def _landmark(name: list[str], distance: list[str]) -> dict:
    return {"nearby_landmark": name[0], "distance_to_landmark": distance[0]} if name and distance and "距" in name[0] else {}


def _shared(card: Element) -> dict:
    images = [e.attrs.get("data-src") for e in find(card, has("image-slider"), has(tag="img"))]
    return {"images": [i for i in images if i is not None] or None}


def promoted(card: Element) -> dict:
    """A card of the strip of recommended homes."""
    address, info = find(card, has("address-info")), pieces(find(card, has("address-info"), has(tag="span")))
    own = info[:1] if info and "-" not in info[0] else []
    return _shared(card) | {"title": _at(pieces(find(card, has("title", tag="a"))), 0), "community": _at(own, 0), "location": _at(info, len(own)), "area": _at(pieces(find(address, has("area"))), 0),
                            "price": _at(pieces(find(card, has("price-info"), has("price"))), 0), **_landmark(pieces(find(card, has("distance-info"), has("desc"))), pieces(find(card, has("distance-info"), has("distance"))))}


def regular(card: Element) -> dict:
    """A card of the list: lines of type and size, of place, of a landmark if there is one, of contact."""
    lines = find(card, has("item-info-txt"))
    span = lambda i: pieces(find(lines[i], has(tag="span"))) if i < len(lines) else []
    rows = lambda i: texts(find(lines[i], has(tag="span"), has("inline-flex-row"))) if i < len(lines) else []
    kind, place, third, sizes = span(0), span(1), span(2), rows(0)
    out = _shared(card) | {
        "title": _at(pieces(find(card, has("item-info-title"), has(tag="a"))), 0), "tags": pieces(find(card, has("item-info-tag"), has("tag"))) or None, "property_type": _at(kind, 0),
        "room_hall_info": next((t for t in kind[1:2] if "房" in t), None), "area": next((t for t in sizes if "坪" in t), None), "floor": next((t for t in sizes if "F" in t), None),
        "community": _at(place, 0), "location": _at(rows(1), 0), "price": _at(texts(find(card, has("item-info-price"), has(tag="strong"), has("inline-flex-row"))), 0),
        "is_featured": bool(find(card, has("tag", "recom"))) or None, "is_preferred": bool(find(card, has("tag", "preferred"))) or None}
    mark = _landmark(third, pieces(find(lines[2], has(tag="strong")))) if len(lines) > 2 else {}
    return out | mark | dict(zip(("contact_info", "update_time", "view_count"), span(3) if mark or not third else third, strict=False))


#: Class of a card, where its link stands, and what reads it.
KINDS: dict[str, tuple[str, Callable[[Element], list[Element]], Callable[[Element], dict]]] = {
    "promoted": ("recommend-ware", lambda c: find(c, has("title", tag="a")), promoted),
    "regular": ("item", lambda c: find(c, has("item-info-title"), has(tag="a")), regular),
}


def parse_list(html: str) -> Iterator[tuple]:
    """What CARDS names, once per card with a link, in the order of the page. A card that cannot be read gives its place and the error's name."""
    page, pos = tree(html), 0
    for card in page.listed(sorted({n for cls, *_ in KINDS.values() for n in page.page.named.get(cls, ())})):
        kind = next(k for k, (cls, *_) in KINDS.items() if cls in card.classes)
        _, link_of, read = KINDS[kind]
        link = next((a.attrs["href"] for a in link_of(card) if a.attrs.get("href")), None)
        if link is None:
            continue
        pos += 1
        got = {"pos": pos, "kind": kind, "house_id": link.split("/")[-1].split("?")[0], "link": link, "parse_errors": []}
        try:
            got |= read(card)
        except Exception as e:  # noqa: BLE001  whatever a card does to its reader stays with the card
            got["parse_errors"] = [type(e).__name__]
        yield tuple(got.get(n) for n in NAMES)


class ListCards:
    """Table function: the cards of a page. A page that cannot be read at all gives one row with the error's name; a null one gives none."""

    def eval(self, html: str):
        try:
            yield from parse_list(html) if html is not None else ()
        except Exception as e:  # noqa: BLE001
            yield (*[None] * (len(NAMES) - 1), [type(e).__name__])


def list_cards(pages: DataFrame, key: str = "page_id", raw: str = "raw", *keep: str, parts: int | None = None) -> DataFrame:
    """key, ``keep`` and the columns of CARDS, once per card: a lateral join of each page with its cards.

    ``parts`` deals the pages out by their key first, where few files hold many pages; a page is read by one task.
    """
    cards = F.udtf(ListCards, returnType=CARDS)
    rows = pages.select(key, *keep, F.col(raw).alias("_raw"))
    rows = rows.repartition(parts, F.xxhash64(key)) if parts else rows  # by a hash of its own, which no shuffle before it makes needless
    return rows.lateralJoin(cards(F.col("_raw").outer())).drop("_raw")


def card_items(cards: DataFrame, regions: DataFrame, city: str = "city", seq: Column | None = None) -> DataFrame:
    """Listing items of the cards: typed columns and ``present``, the names of those that a card tells, so that an upsert keeps what only a detail page tells.

    ``city`` names the column of the region that a page lists; ``regions`` (name, code) is a dimension of some hundred rows. Parking lots tell place, price and type only. Unread cards give no item.
    """
    c = F.col
    top, low = c(city), list_region_key(c(city), c("location"))
    price, least = price_range(F.replace("price", F.lit(","), F.lit("")))
    names = F.broadcast(regions.select("name", "code"))
    df = cards.where("size(parse_errors) = 0").withColumns({"_top": top, "_sub": low})
    df = region_code(region_code(df, names, "_top", "top_region"), names, "_sub", "sub_region")
    df = df.withColumns({"code": code_of(c("property_type"), PROPERTY), "price_n": price, "least_n": least, "ping": F.nullif(clean_number(F.replace("area", F.lit("坪"), F.lit(""))), F.lit(0.0)), "f": floors(c("floor"), card=True)})
    df = df.withColumn("home", F.coalesce(c("code"), F.lit(-1)) != PROPERTY.index("車位"))
    told = lambda x: F.when(c("home"), x)
    digits = F.regexp_extract_all("room_hall_info", F.lit(r"(\d)\D+"), F.lit(1))
    bed, living, bath = (F.get(digits, i).try_cast("int") for i in range(3))
    two = lambda x: F.lpad(F.coalesce(x, F.lit(0)).cast("string"), 2, "0")
    fields = {
        "top_region": c("top_region"), "sub_region": c("sub_region"), "rough_address": c("location"), "property_type": c("code"), "monthly_price": c("price_n"), "min_monthly_price": c("least_n"),
        "floor_ping": told(c("ping")), "floor": told(c("f.floor")), "total_floor": told(c("f.total")), "is_rooftop": told(c("f.is_rooftop")), "dist_to_highest_floor": told(c("f.dist")),
        "n_bed_room": told(bed), "n_living_room": told(living), "n_bath_room": told(bath), "apt_feature_code": told(F.when(bed.isNotNull(), F.concat(F.lit("00"), two(bath), two(bed), two(living)))),
        "contact": told(card_contact(c("contact_info"))), "can_cook": told(F.when(_holds(c("tags"), "可開伙"), True)), "allow_pet": told(F.when(_holds(c("tags"), "可養寵物"), True)),
        "facilities": told(tag_facilities(c("tags"))), "per_ping_price": told(F.try_divide(F.nullif(c("price_n"), F.lit(0.0)), c("ping"))),
    }
    made = df.select(c("house_id").alias("vendor_house_id"), F.lit(OPENED).alias("deal_status"), *[v.alias(k) for k, v in fields.items()], (seq if seq is not None else F.lit(0)).cast("long").alias("seq"))
    return made.withColumn("present", F.array_compact(F.array(*[F.when(c(k).isNotNull(), F.lit(k)) for k in fields])))
