"""Rules that turn scraped listing attributes into typed columns, and the job that applies them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import NUMERALS, clean_number, per_ping_price, price_range, within

UNKNOWN = 65535
# Names of the published codes, in the order of the codes.
BUILDING = ("公寓", "透天", "電梯大樓", "華廈", "辦公商業大樓", "倉庫", "店面（店鋪）", "廠辦", "工廠", "農舍")
PROPERTY = ("整層住家", "獨立套房", "分租套房", "雅房", "車位", "其他", "倉庫", "場地", "攤位")
CONTACT = ("屋主", "代理人", "房仲")
DEPOSIT = ("月", "定額", "面議", "其他")
GENDER = ("不限", "女", "男", "其他")
# Fees that a rent may include, tags that name facilities, tags that say nothing of the home.
FEES = {"eletricity": "電費", "water": "水費", "gas": "瓦斯費", "internet": "網路", "cable_tv": "第四台"}
TAG_FACILITIES = {"有電梯": "電梯", "有陽台": "陽台", "有車位": "車位", "有冷氣": "冷氣", "近捷運": "近捷運", "近商圈": "近商圈"}
SILENT_TAGS = ("新上架", "拎包入住", "可開伙", "可養寵物", "精選", "優選好屋")
OPENED, NOT_FOUND, DEAL = 0, 1, 2


def _texts(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def _holds(array: Column, value: str) -> Column:
    return F.coalesce(F.array_contains(array, value), F.lit(False))


def code_of(name: Column, names: Sequence[str]) -> Column:
    """Place of the name in the list; 65535 for others, null for null."""
    at = F.array_position(_texts(names), name).cast("int")
    return F.when(at > 0, at - 1).when(name.isNotNull(), UNKNOWN)


def deposit(text: Column, price: Column) -> Column:
    """Struct type, months, amount: ``押金X個月`` with one numeral, a plain number, ``面議``, or anything else."""
    parts = F.split(text, "個月")
    numeral = F.replace(F.get(parts, 0), F.lit("押金"), F.lit(""))
    by_month, plain = F.size(parts) == 2, F.replace(text, F.lit(","), F.lit(""))
    months = F.when(F.char_length(numeral) == 1, F.nullif(F.instr(F.lit(NUMERALS), numeral), F.lit(0)) - 1).cast("double")
    number = F.when(plain.rlike("^[0-9]+$"), clean_number(plain))
    kind = F.when(by_month, 0).when(number.isNotNull(), 1).when(text == "面議", 2).when(text.isNotNull(), 3)
    return F.struct(kind.alias("type"), F.when(by_month, months).otherwise(F.try_divide(number, price)).alias("months"),
                    F.when(by_month, months * price).otherwise(number).alias("amount"))


def management_fee(includes: Column, fee: Column) -> Column:
    """Struct required, monthly: nothing to pay where the rent includes it; a fee counts only with the unit ``元/月`` as a part of its own."""
    by_month = F.array_contains(fee, "元/月")
    free = _holds(includes, "管理費")
    return F.struct(F.when(free, False).when(fee.isNotNull(), F.coalesce(by_month, F.lit(False))).alias("required"),
                    F.when(free, 0.0).when(by_month, clean_number(F.array_join(fee, ""))).when(fee.isNotNull(), 0.0).alias("monthly"))


def parking(includes: Column, fee: Column) -> Column:
    """Struct has, required, monthly."""
    number = clean_number(F.array_join(fee, ""))
    free, paid, held, apart, none = _holds(includes, "車位費"), number != 0, _holds(fee, "已含"), _holds(fee, "費用另計"), fee == F.array(F.lit("無"))
    return F.struct(F.when(free, True).when(fee.isNotNull(), F.coalesce(paid, F.lit(False)) | ~none).alias("has"),
                    F.when(free, False).when(paid, True).when(held, False).when(apart, True).alias("required"),
                    F.when(free, 0.0).when(paid, number).when(held | apart, 0.0).alias("monthly"))


def region_keys(breadcrumb: Column) -> tuple[Column, Column]:
    """Names to look the region and its part up by."""
    return F.get(breadcrumb, 0), F.concat(F.get(breadcrumb, 0), F.get(breadcrumb, 1))


def region_code(df: DataFrame, names: DataFrame, key: str, out: str) -> DataFrame:
    """df with the code of the region that ``key`` names as ``out``: 65535 for a name that is not in ``names`` (name, code), null for null."""
    df = df.join(names.withColumnsRenamed({"name": f"{out}_name", "code": f"{out}_code"}), F.col(key) == F.col(f"{out}_name"), "left")
    return df.withColumn(out, F.when(F.col(key).isNotNull(), F.coalesce(f"{out}_code", F.lit(UNKNOWN)))).drop(f"{out}_name", f"{out}_code")


def list_region_key(city: Column, location: Column) -> Column:
    """Of a list card the part of the region is what stands before the first ``-`` of the location."""
    return F.when(F.contains(location, F.lit("-")), F.concat(city, F.split_part(location, F.lit("-"), F.lit(1))))


def deal_status(http: Column, url: Column, error: Column, deal_time: Column) -> Column:
    """Status of an answer, null for a blocked request, which gives no row."""
    blocked = F.coalesce(http == 400, F.lit(False)) | F.coalesce(url == "about:blank", F.lit(False))
    dealt = F.coalesce(clean_number(F.get(deal_time, 0)) > 0, F.lit(False))
    return F.when(blocked, None).when((http != 200) | error, NOT_FOUND).when(dealt, DEAL).otherwise(OPENED)


def property_type(name: Column, fallback: Column) -> Column:
    return code_of(F.when(name == "__UNKNOWN__", fallback).otherwise(name), PROPERTY)


def building_type(name: Column) -> Column:
    return code_of(F.when(name.isin("別墅", "透天厝"), "透天").when(name == "住宅大樓", "電梯大樓").otherwise(name), BUILDING)


def floors(text: Column, card: bool = False) -> Column:
    """Struct floor, total, is_rooftop, dist of ``1F/2F``, ``1F~3F/3F``, ``B1/5F``, ``頂樓加蓋/3F`` or ``整棟/3F``; of a list card only with a ``/``."""
    parts = F.split(text, "/")
    head, both = F.get(parts, 0), F.size(parts) >= 2
    first = clean_number(F.get(F.split(head, "~"), 0)).cast("int")
    total = F.when(both, clean_number(F.get(parts, 1)).cast("int")).otherwise(F.lit(None if card else 0))
    known = text.isNotNull() & (both if card else F.lit(True))
    roof = head == "頂樓加蓋"
    if card:
        total = F.nullif(total, F.lit(0))
        roof = roof & total.isNotNull()
    floor = F.when(roof, total + 1).when(F.contains(head, F.lit("B")), -first).otherwise(first)
    floor = F.when(known, F.coalesce(floor, F.when(roof, None).otherwise(F.lit(0))))
    return F.struct(floor.alias("floor"), F.when(known, total).alias("total"), F.when(known, roof).alias("is_rooftop"), (total - floor).alias("dist"))


def rooms(text: Column, facilities: Column, is_home: Column) -> Column:
    """Struct balcony, bed, living, bath, code. Rooms by position, one digit each, of whole homes only; the last facility that ends in
    ``陽台`` tells the balconies."""
    named = F.filter(facilities, lambda x: x.endswith("陽台"))
    balcony = F.when(F.coalesce(F.size(named), F.lit(0)) > 0, clean_number(F.try_element_at(named, F.lit(-1))).cast("int")).otherwise(0)
    digits = F.regexp_extract_all(text, F.lit(r"(\d)\D+"), F.lit(1))
    bed, living, bath = (F.when(is_home, F.coalesce(F.get(digits, i).try_cast("int"), F.lit(0))) for i in range(3))
    code = F.concat(*[F.lpad(c.cast("string"), 2, "0") for c in (balcony, bath, bed, living)])
    return F.struct(balcony.alias("balcony"), bed.alias("bed"), living.alias("living"), bath.alias("bath"), F.when(is_home, code).alias("code"))


def additional_fees(includes: Column) -> Column:
    """map<string,boolean>: fees that the rent does not include."""
    return F.create_map(*[x for key, name in FEES.items() for x in (F.lit(key), ~_holds(includes, name))])


def tenant_rules(rule: Column, tags: Column, registration: Column) -> Column:
    """Struct of restrictions told by the house rule, the tags and the registration text."""
    rule, registration = F.coalesce(rule, F.lit("")), F.coalesce(registration, F.lit(""))
    has = lambda c, s: F.contains(c, F.lit(s))
    gender = F.when(has(rule, "此房屋限") & has(rule, "女生"), 1).when(has(rule, "此房屋限") & has(rule, "男生"), 2).otherwise(0)
    return F.struct(has(rule, "適合").alias("has_tenant_restriction"), (gender > 0).alias("has_gender_restriction"), gender.alias("gender_restriction"),
                    F.when(has(rule, "不可開伙"), False).when(_holds(tags, "可開伙"), True).alias("can_cook"),
                    F.when(has(rule, "不可養寵物"), False).when(_holds(tags, "可養寵物"), True).alias("allow_pet"), has(registration, "已辦理").alias("has_registration"))


def contact(author: Column, phone: Column, agent: Column) -> Column:
    """Struct contact, author, agent_org, present. Without a phone none of them is told, and ``present`` is empty: an upsert keeps what it has."""
    told = F.coalesce(phone, F.lit("")) != ""
    role = F.split_part(author, F.lit(": "), F.lit(1))
    kind = code_of(F.when(role == "仲介", "房仲").otherwise(role), CONTACT)
    org = F.when(agent == "經紀業: 不動產經紀業", "未認證").otherwise(agent)
    present = F.when(told & (kind == 2), _texts(["contact", "author", "agent_org"])).when(told, _texts(["contact", "author"])).otherwise(F.expr("cast(array() as array<string>)"))
    return F.struct(F.when(told, kind).alias("contact"), F.when(told, F.replace(phone, F.lit("-"), F.lit(""))).alias("author"), F.when(told & (kind == 2), org).alias("agent_org"), present.alias("present"))


def card_contact(text: Column) -> Column:
    """Contact of a list card by the role word it holds."""
    return F.when(F.contains(text, F.lit("仲介")), 2).when(F.contains(text, F.lit("屋主")), 0).when(F.contains(text, F.lit("代理人")), 1)


def tag_facilities(tags: Column) -> Column:
    """map<string,boolean> of the facilities that the tags name; null if none."""
    names = F.create_map(*[F.lit(x) for pair in TAG_FACILITIES.items() for x in pair])
    kept = F.array_distinct(F.transform(F.filter(tags, lambda t: ~t.isin(*SILENT_TAGS)), lambda t: F.coalesce(names[t], t)))
    return F.when(F.size(kept) > 0, F.map_from_arrays(kept, F.transform(kept, lambda _: F.lit(True))))


def facility_union(supported: Column, unsupported: Column) -> Column:
    """map<string,boolean>; balconies are counted elsewhere. A name on both lists is not there."""
    inside = lambda a: F.array_distinct(F.filter(F.coalesce(a, F.expr("cast(array() as array<string>)")), lambda x: ~F.contains(x, F.lit("陽台"))))
    no = inside(unsupported)
    yes = F.array_except(inside(supported), no)
    return F.map_from_arrays(F.concat(yes, no), F.concat(F.transform(yes, lambda _: F.lit(True)), F.transform(no, lambda _: F.lit(False))))


def path_get(json: Column, path: str, default: str) -> Column:
    """Text at a dotted path, or the default."""
    return F.coalesce(F.get_json_object(json, f"$.{path}"), F.lit(default))


def coordinate(text: Column) -> Column:
    """Struct x (latitude), y of ``lat,lng``, null outside the plausible latitudes."""
    x, y = (F.split_part(text, F.lit(","), F.lit(i)).try_cast("double") for i in (1, 2))
    return F.when(within(x, 20, 30).isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def normalize_listings(raw: DataFrame, regions: DataFrame, strict: bool = True) -> DataFrame:
    """Typed listings of scraped details, one row each, with ``parse_errors`` where a value that must be told cannot be read.

    ``raw``: house_id, http, url, error, breadcrumb, rough_address, deal_time, property_type, building_type, floor, floor_ping, price, deposit, misc (map of text to
    array of text), rule, tags, supported_facility, unsupported_facility, rough_coordinate, author_name, author_phone, agent_org.
    ``regions``: name, code; a dimension of some hundred rows. ``strict`` leaves the house rule out, as published so far. Parking lots keep the first
    fields only; blocked requests give no row.
    """
    c, misc = F.col, lambda k: F.col("misc")[k]
    includes = misc("租金含")
    price, least = price_range(c("price"))
    top, sub = region_keys(c("breadcrumb"))
    names = F.broadcast(regions.select(c("name"), c("code")))
    df = raw.withColumn("deal_status", deal_status(c("http"), c("url"), c("error"), c("deal_time"))).where("deal_status is not null")
    df = df.withColumn("_top", top).withColumn("_sub", sub)
    for key, out in (("_top", "top_region"), ("_sub", "sub_region")):
        df = region_code(df, names, key, out)
    df = df.withColumns({"price": price, "min_monthly_price": least, "property_code": property_type(F.get("breadcrumb", 2), c("property_type"))})
    df = df.withColumn("found", c("deal_status") != NOT_FOUND).withColumn("home", c("found") & (F.coalesce(c("property_code"), F.lit(UNKNOWN)) != PROPERTY.index("車位")))
    df = df.withColumn("floor_ping", clean_number(c("floor_ping")))
    parts = {
        "d": deposit(c("deposit"), c("price")), "m": management_fee(includes, misc("管理費")), "k": parking(includes, misc("車位費")), "f": floors(c("floor")),
        "r": rooms(c("property_type"), c("supported_facility"), c("property_code") == 0), "t": tenant_rules(F.lit("") if strict else c("rule"), c("tags"), F.array_join(misc("產權登記"), "")),
        "a": contact(c("author_name"), c("author_phone"), c("agent_org")),
    }
    df = df.withColumns({k: F.when(c("home"), x) for k, x in parts.items()})
    errors = F.array_compact(F.array(*[F.when(c("found") & bad, F.lit(name)) for name, bad in (
        ("price", c("price").isNull()), ("breadcrumb", F.get("breadcrumb", 2).isNull()), ("deposit", c("home") & (c("d.type") == 0) & c("d.months").isNull()),
        ("floor", c("home") & c("floor").isNotNull() & c("f.total").isNull()), ("author_name", c("home") & ~F.contains("author_name", F.lit(": "))))]))
    told = lambda x: F.when(c("home"), x)
    first = [c("house_id").alias("vendor_house_id"), c("deal_status"), *[F.when(c("found"), c(k)).alias(k) for k in ("top_region", "sub_region", "rough_address")],
             F.when(c("found"), c("property_code")).alias("property_type"), F.when(c("found"), c("price")).alias("monthly_price"), F.when(c("found"), c("min_monthly_price")).alias("min_monthly_price")]
    return df.select(
        *first, told(building_type(c("building_type"))).alias("building_type"), c("d.type").alias("deposit_type"), c("d.months").alias("n_month_deposit"), c("d.amount").alias("deposit"),
        c("m.required").alias("is_require_management_fee"), c("m.monthly").alias("monthly_management_fee"), c("k.has").alias("has_parking"), c("k.required").alias("is_require_parking_fee"),
        c("k.monthly").alias("monthly_parking_fee"), told(per_ping_price(c("price"), c("floor_ping"), c("m.monthly"), c("k.monthly"))).alias("per_ping_price"),
        "f.floor", c("f.total").alias("total_floor"), "f.is_rooftop", c("f.dist").alias("dist_to_highest_floor"), told(c("floor_ping")).alias("floor_ping"),
        c("r.balcony").alias("n_balcony"), c("r.bed").alias("n_bed_room"), c("r.living").alias("n_living_room"), c("r.bath").alias("n_bath_room"), c("r.code").alias("apt_feature_code"),
        told(additional_fees(includes)).alias("additional_fee"), "t.*", told(facility_union(c("supported_facility"), c("unsupported_facility"))).alias("facilities"),
        told(coordinate(c("rough_coordinate"))).alias("rough_coordinate"), "a.contact", "a.author", "a.agent_org", "a.present", errors.alias("parse_errors"))


# Words of Python literals and what JSON calls them.
WORDS = {"None": "null", "True": "true", "False": "false"}
#: A text in single quotes, one in double quotes, or what stands between texts.
TOKEN = r"""([urb]*'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+)"""


def literal_json(text: Column) -> Column:
    """A Python literal of dicts, lists, tuples and plain values as JSON text; JSON stays as it is. Words inside quotes are not touched."""
    def one(t: Column) -> Column:
        inner = F.regexp_replace(t, "^[urb]*'|'$", "")
        inner = F.replace(F.replace(inner, F.lit(r"\'"), F.lit("'")), F.lit('"'), F.lit(r"\""))
        inner = F.regexp_replace(inner, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
        plain = F.regexp_replace(F.regexp_replace(F.translate(t, "()", "[]"), r",(\s*[\]}])", "$1"), r"\b[urb]+$", "")
        for word, name in WORDS.items():
            plain = F.regexp_replace(plain, rf"\b{word}\b", name)
        return F.when(t.rlike("^[urb]*'"), F.concat(F.lit('"'), inner, F.lit('"'))).when(t.startswith('"'), t).otherwise(plain)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), one), "")


def region_names(detail: Column, card: Column) -> Column:
    """Struct region, part, source of a listing: from what the detail parser found, else from the list card's raw text as JSON, else from that text as a Python literal."""
    def read(text: Column, region: str, part: str, source: str) -> Column:
        got = F.from_json(text, f"{region} string, {part} string")
        return F.when(F.coalesce(got[region], F.lit("")) != "", F.struct(got[region].alias("region"), got[part].alias("part"), F.lit(source).alias("source")))

    json = card.rlike(r'^\s*[{\[]\s*"')
    return F.coalesce(read(detail, "top_region", "sub_region", "detail"), read(F.when(json, card), "region_name", "section_name", "card"), read(literal_json(card), "region_name", "section_name", "literal"))


def unknown_counts(codes: dict[str, Column]) -> list[Column]:
    """Aggregates for ``DataFrame.observe``: by field, rows whose name had no code, so that the pass that writes the codes also counts what it could not read."""
    return [F.count(F.when(c == UNKNOWN, F.lit(1))).alias(name) for name, c in codes.items()]
