"""Queries of the page jobs, over pages that the rows of a table fill, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..extract import list_page, listing_page
from ..functions.listing import normalize_listings
from ..operators.backfill import ID, listing_table, reparse_ranges
from ..sources import files
from ..sources.files import table
from .catalog import query

K, Z = "p_partkey", "p_size"
REGIONS = [("A市", 1), ("B縣", 2), ("A市甲區", 10), ("B縣甲區", 20)]
KINDS = "case p_partkey % 5 when 0 then '整層住家' when 1 then '獨立套房' when 2 then '分租套房' when 3 then '雅房' else '車位' end"
CITY = "case p_partkey % 3 when 0 then 'A市' when 1 then 'B縣' else 'C市' end"
PART = "case p_partkey % 2 when 0 then '甲區' else '乙區' end"
PRICE = "p_size || ',' || lpad('' || p_partkey % 1000, 3, '0') || case p_partkey % 13 when 0 then '~' || (p_size + 1) || ',000' else '' end || '元/月'"
DEPOSIT = "case p_partkey % 4 when 0 then '押金二個月' when 1 then '30,000' when 2 then '面議' end"
ROOMS = "case p_partkey % 5 when 0 then (p_partkey % 4 + 1) || '房' || p_partkey % 3 || '廳' || (p_partkey % 2 + 1) || '衛' else " + KINDS + " end"
FLOOR = "case p_partkey % 8 when 0 then '頂樓加蓋' when 1 then 'B1' else (p_partkey % 9 + 1) || 'F' end || '/' || (p_partkey % 5 + 8) || 'F'"
BUILDING = "case p_partkey % 3 when 0 then '公寓' when 1 then '別墅' else '木屋' end"
WHO = "case p_partkey % 3 when 0 then '屋主: 陳' when 1 then '仲介: 林' else '代理人: 王' end"
AGENT = "case p_partkey % 2 when 0 then '經紀業: 不動產經紀業' else 'X 經紀' end"
FOUND, LOT = "p_partkey % 11 <> 0", "p_partkey % 5 = 4"
HOME = f"{FOUND} and p_partkey % 5 <> 4"
FOUR = "p_partkey % 4 <> 3"


def pages(spark, d, parts: int | None = None):
    """house_id, raw: a page of the listing site's markup for every part; some are gone, some null, parts of a price stand out of order. ``parts`` deals the rows out before they grow to pages."""
    spaced = F.transform(F.split(F.expr(PRICE), ""), lambda c, i: F.format_string('<i style="order:%d;font-style:normal;">%s</i>', i, c))
    price = F.array_join(F.concat(F.slice(spaced, 4, 99), F.slice(spaced, 1, 3)), "")
    row = F.concat(F.lit('<span class="inline-flex-row"><span style="display:inline-flex;flex-direction: row;">'), price, F.lit("</span></span>"))
    items = F.expr(f"case when {FOUR} then array({ROOMS}, p_size || '坪', {FLOOR}, {BUILDING}) else array({ROOMS}, {BUILDING}) end")
    spans = F.array_join(F.transform(items, lambda x: F.concat(F.lit("<span>"), x, F.lit("</span>"))), '<span class="line">|</span>')
    misc = F.expr("""concat(
        case when p_partkey % 2 = 0 then '<div class="item"><span class="label">租金含</span><span class="value">水費</span></div>' else '' end,
        case p_partkey % 3 when 0 then '<div class="item"><p class="label">管理費</p><b class="value">' || p_size * 10 || '</b><b class="value">元/月</b></div>' when 1 then '<div class="item"><p class="label">管理費</p><b class="value">--</b></div>' else '' end,
        '</div><div class="content right">',
        case p_partkey % 4 when 0 then '<div class="item"><p class="label">車位費</p><p class="value">500</p></div>' when 1 then '<div class="item"><p class="label">車位費</p><p class="value">&nbsp;無 </p></div>' else '' end,
        '<div class="item"><p class="label">產權登記</p><p class="value">', case p_partkey % 2 when 0 then '已辦理' else '未辦理' end, '</p></div>')""")
    whole = F.concat(
        F.lit('<html><body><div class="crumbs"><a class="t5-link">'), F.expr(CITY), F.lit('</a>&gt;<a class="t5-link" href="#">'), F.expr(PART), F.lit('</a><a class="x t5-link">'), F.expr(KINDS),
        F.lit('</a></div><section class="title"><h1>'), F.col("p_name"), F.lit("</h1>"), F.expr("case when p_partkey % 7 = 0 then '<span class=tag-deal>' || (p_partkey % 5 + 1) || '天成交</span>' else '' end"),
        F.lit('</section><div class="house-label"><span>新上架</span>'), F.expr("case when p_partkey % 2 = 0 then '<span>可開伙</span>' else '' end || case when p_partkey % 3 = 0 then '<span> 可養寵物</span>' else '' end"),
        F.lit('</div><div class="pattern">'), spans, F.lit('</div><div class="house-price">'), F.coalesce(F.expr(DEPOSIT), F.lit("")), F.lit('<p class="c-price">'), row,
        F.lit('</p></div><div class="address"><span class="load-map">'), F.col("p_brand"), F.lit(" 路</span>"),
        F.expr("case when p_partkey % 9 > 0 then '<a class=\"google-maps-link\" href=\"https://maps.example/?f=q&amp;q=2' || p_partkey % 5 || '.5,121.25&amp;z=16\">map</a>' else '' end"),
        F.lit('</div><div class="service"><div class="service-cate"><div><p>房屋守則</p><span>此房屋限女生</span></div></div><div class="service-facility"><dl><dt></dt><dd>床</dd></dl>'),
        F.expr("case when p_partkey % 2 = 0 then '<dl><dd>1陽台</dd></dl>' else '' end"), F.lit('<dl class="del"><dd>冷氣</dd></dl></div></div><ul class="preference-item"><li><p>屋主直租</p><p>x</p></li></ul>'
        '<div class="house-condition"><div class="house-condition-content"><div class="article">some <b>bold</b> words</div></div></div><div class="house-detail"><div class="content left">'), misc,
        F.lit('</div></div><div class="contact-card"><span class="name">'), F.expr(WHO), F.lit("</span>"), F.expr(f"case when p_partkey % 3 = 1 then '<span class=\"econ-name\">' || {AGENT} || '</span>' else '' end"),
        F.expr("case when p_partkey % 6 > 0 then '<div class=\"phone\"><div class=\"contact-action-lg\"><button><span><span>09-' || p_partkey || '</span></span></button></div></div>' else '' end"), F.lit("</div></body></html>"))
    gone = F.lit('<html><div class="error-info">gone</div></html>')
    raw = F.when(F.expr(f"not ({FOUND})"), gone).when(F.expr("p_partkey % 101 <> 1"), whole)
    rows = table(spark, d, "part").select(K, Z, "p_name", "p_brand")
    rows = rows.repartition(parts, F.xxhash64(K)) if parts else rows
    return rows.select(F.col(K).alias("house_id"), raw.alias("raw"))


def _if(test: str, then: str, kind: str = "") -> str:
    return f"case when {test} then {then} end{kind}"


NUMBER = "(p_size * 1000 + p_partkey % 1000)"
MONTHLY = "case p_partkey % 3 when 0 then p_size * 10 when 1 then 0 end"
LAST_FLOOR = "(p_partkey % 5 + 8)"
FLOORS = f"case p_partkey % 8 when 0 then {LAST_FLOOR} + 1 when 1 then -1 else p_partkey % 9 + 1 end"
FLAT = f"{HOME} and p_partkey % 5 = 0"
TOLD = f"{HOME} and p_partkey % 6 > 0"
# Every column of a normalised listing, from the row that filled its page.
COLUMNS = {
    "deal_status": f"case when not ({FOUND}) then 1 when p_partkey % 7 = 0 then 2 else 0 end",
    "top_region": _if(FOUND, "case p_partkey % 3 when 0 then 1 when 1 then 2 else 65535 end"),
    "sub_region": _if(FOUND, "case when p_partkey % 6 = 0 then 10 when p_partkey % 6 = 4 then 20 else 65535 end"),
    "rough_address": _if(FOUND, "p_brand || ' 路'"), "property_type": _if(FOUND, "p_partkey % 5", "::int"), "monthly_price": _if(FOUND, NUMBER, "::double"),
    "min_monthly_price": _if(f"{FOUND} and p_partkey % 13 = 0", "(p_size + 1) * 1000", "::double"), "building_type": _if(HOME, "case p_partkey % 3 when 0 then 0 when 1 then 1 else 65535 end"),
    "deposit_type": _if(HOME, "p_partkey % 4", "::int"), "n_month_deposit": _if(HOME, f"case p_partkey % 4 when 0 then 2 when 1 then 30000 / {NUMBER}::double end", "::double"),
    "deposit": _if(HOME, f"case p_partkey % 4 when 0 then 2 * {NUMBER} when 1 then 30000 end", "::double"), "is_require_management_fee": _if(f"{HOME} and p_partkey % 3 < 2", "p_partkey % 3 = 0"),
    "monthly_management_fee": _if(HOME, MONTHLY, "::double"), "has_parking": _if(HOME, "case p_partkey % 4 when 0 then true when 1 then false end"),
    "is_require_parking_fee": _if(f"{HOME} and p_partkey % 4 = 0", "true"), "monthly_parking_fee": _if(f"{HOME} and p_partkey % 4 = 0", "500", "::double"),
    "per_ping_price": _if(f"{HOME} and {FOUR}", f"({NUMBER} + coalesce({MONTHLY}, 0) + case when p_partkey % 4 = 0 then 500 else 0 end)::double / p_size"),
    "floor": _if(f"{HOME} and {FOUR}", FLOORS, "::int"), "total_floor": _if(f"{HOME} and {FOUR}", LAST_FLOOR, "::int"), "is_rooftop": _if(f"{HOME} and {FOUR}", "p_partkey % 8 = 0"),
    "dist_to_highest_floor": _if(f"{HOME} and {FOUR}", f"{LAST_FLOOR} - ({FLOORS})", "::int"), "floor_ping": _if(f"{HOME} and {FOUR}", "p_size", "::double"),
    "n_balcony": _if(HOME, "1 - p_partkey % 2", "::int"), "n_bed_room": _if(FLAT, "p_partkey % 4 + 1", "::int"), "n_living_room": _if(FLAT, "p_partkey % 3", "::int"), "n_bath_room": _if(FLAT, "p_partkey % 2 + 1", "::int"),
    "apt_feature_code": _if(FLAT, "'0' || (1 - p_partkey % 2) || '0' || (p_partkey % 2 + 1) || '0' || (p_partkey % 4 + 1) || '0' || p_partkey % 3"),
    "fee_water": _if(HOME, "p_partkey % 2 <> 0"), "fee_gas": _if(HOME, "true"), "has_tenant_restriction": _if(HOME, "false"), "has_gender_restriction": _if(HOME, "false"), "gender_restriction": _if(HOME, "0"),
    "can_cook": _if(f"{HOME} and p_partkey % 2 = 0", "true"), "allow_pet": _if(f"{HOME} and p_partkey % 3 = 0", "true"), "has_registration": _if(HOME, "p_partkey % 2 = 0"),
    "bed": _if(HOME, "true"), "air_conditioner": _if(HOME, "false"), "x": _if(f"{HOME} and p_partkey % 9 > 0 and p_partkey % 5 > 0 or {HOME} and p_partkey % 9 > 0 and p_partkey % 5 = 0", "20.5 + p_partkey % 5", "::double"),
    "y": _if(f"{HOME} and p_partkey % 9 > 0", "121.25", "::double"), "contact": _if(TOLD, "case p_partkey % 3 when 0 then 0 when 1 then 2 else 1 end"), "author": _if(TOLD, "'09' || p_partkey"),
    "agent_org": _if(f"{TOLD} and p_partkey % 3 = 1", "case p_partkey % 2 when 0 then '未認證' else 'X 經紀' end"),
}
HELD = "(case when p_partkey % 101 <> 1 or p_partkey % 11 = 0 then 1 end) = 1"
LISTINGS_SQL = f"select p_partkey::varchar as vendor_house_id, {', '.join(f'{v} as {k}' for k, v in COLUMNS.items())} from part where {HELD}"


def flat(listings):
    """The columns of COLUMNS of normalised listings."""
    at = {"fee_water": "additional_fee['water']", "fee_gas": "additional_fee['gas']", "bed": "facilities['床']", "air_conditioner": "facilities['冷氣']", "x": "rough_coordinate.x", "y": "rough_coordinate.y"}
    return listings.selectExpr(ID, *[f"{at.get(k, k)} as {k}" for k in COLUMNS])


def dealt(spark, d):
    """The pages, over all cores: the table that fills them is one file."""
    return pages(spark, d, spark.sparkContext.defaultParallelism)


def regions(spark):
    return spark.createDataFrame(REGIONS, "name string, code int")


@query(f"""select p_partkey as house_id, {_if(FOUND, 'p_name')} as title, {_if(FOUND, f"{CITY} || '/' || {PART} || '/' || {KINDS}")} as breadcrumb, {_if(f"{FOUND} and p_partkey % 7 = 0", "(p_partkey % 5 + 1) || '天成交'")} as deal_time,
{_if(FOUND, "'新上架' || case when p_partkey % 2 = 0 then '/可開伙' else '' end || case when p_partkey % 3 = 0 then '/可養寵物' else '' end")} as tags, {_if(FOUND, f"case when {LOT} then '車位' else {ROOMS} end")} as property_type,
{_if(f"{HOME} and {FOUR}", "p_size || '坪'")} as floor_ping, {_if(f"{HOME} and {FOUR}", FLOOR)} as floor, {_if(HOME, BUILDING)} as building_type, {_if(FOUND, PRICE)} as price, {_if(FOUND, f"coalesce({DEPOSIT}, {PRICE})")} as deposit,
{_if(FOUND, "p_brand || ' 路'")} as rough_address, {_if(f"{FOUND} and p_partkey % 9 > 0", "'2' || p_partkey % 5 || '.5,121.25'")} as rough_coordinate, {_if(FOUND, "'此房屋限女生'")} as rule,
{_if(FOUND, "'床' || case when p_partkey % 2 = 0 then '/1陽台' else '' end")} as supported, {_if(FOUND, "'冷氣'")} as unsupported, {_if(FOUND, "'屋主直租'")} as promotion, {_if(FOUND, "'some bold words'")} as description,
{_if(FOUND, "case p_partkey % 3 when 0 then p_size * 10 || '/元/月' when 1 then '--' end")} as management_fee, {_if(FOUND, "case p_partkey % 2 when 0 then '已辦理' else '未辦理' end")} as registration, {_if(FOUND, WHO)} as author_name,
{_if(f"{FOUND} and p_partkey % 3 = 1", AGENT)} as agent_org, {_if(f"{FOUND} and p_partkey % 6 > 0", "'09-' || p_partkey")} as author_phone, not ({FOUND}) as error, '' as parse_errors from part where {HELD}""")
def h1_listing_detail(spark, d):
    """Every field of the pages of listings."""
    joined = lambda c: f"nullif(array_join({c}, '/'), '')"
    return listing_page.listing_details(dealt(spark, d)).selectExpr(
        "house_id", "title", f"{joined('breadcrumb')} as breadcrumb", f"{joined('deal_time')} as deal_time", f"{joined('tags')} as tags", "property_type", "floor_ping", "floor", "building_type", "price", "deposit", "rough_address", "rough_coordinate",
        "services['房屋守則'] as rule", f"{joined('supported_facility')} as supported", f"{joined('unsupported_facility')} as unsupported", f"{joined('promotion')} as promotion", f"{joined('description')} as description",
        "array_join(misc['管理費'], '/') as management_fee", "array_join(misc['產權登記'], '/') as registration", "author_name", "agent_org", "author_phone", "error", "array_join(parse_errors, ',') as parse_errors")


@query(LISTINGS_SQL)
def n0_normalize_listings(spark, d):
    """All listing rules as one job over what the pages tell."""
    return flat(normalize_listings(listing_page.raw_listings(dealt(spark, d)), regions(spark)))


@query(f"select *, 2 as runs from ({LISTINGS_SQL})")
def h4_reparse_ranges(spark, d):
    """Pages stored, read again in ranges by two runs of which the first stops on its way, parsed, normalised and upserted."""
    path = files.scratch(spark, "reparse")
    dealt(spark, d).write.parquet(f"{path}/pages")
    stored = spark.read.parquet(f"{path}/pages")
    top = stored.agg(F.max("house_id")).first()[0] or 0
    target, size = listing_table(stored, regions(spark), f"{path}/listings", buckets=8), top // 4 + 1
    runs = [reparse_ranges(stored, regions(spark), target, f"{path}/ledger", size=size, limit=limit, parts=spark.sparkContext.defaultParallelism) for limit in (2, None)]
    return flat(target.read()).withColumn("runs", F.lit(sum(map(bool, runs))))


CARD_PRICE = "case p_partkey % 6 when 0 then p_size || ',000~' || (p_size + 1) || ',500' else p_size || ',000' end"
PLACE = "case p_partkey % 5 when 1 then '車站旁' else '甲區-' || p_brand end"
MARK, LINKED, OFFERED = "p_partkey % 3 = 0", "p_partkey % 17 <> 3", "p_partkey % 4 = 0"
SEEN = "case p_partkey % 3 when 0 then '屋主 ' when 1 then '仲介 ' else '代理人 ' end || p_brand"
CARD_ROOMS = "(p_partkey % 4 + 1) || '房' || p_partkey % 3 || '廳'"


def list_pages(spark, d):
    """page_id, city, raw: list pages of ten cards each, one in four promoted; some cards have no link. The rows are dealt out by page, over all cores, before they grow to cards."""
    row = lambda x: f"'<span><div class=\"inline-flex-row\">' || {x} || '</div></span>'"
    link = f"case when {LINKED} then ' href=\"https://rent.example/' || p_partkey || case p_partkey % 2 when 0 then '?ai=1' else '' end || '\"' else '' end"
    tags = "'<span class=\"tag recom\">精選</span><span class=\"tag\">' || case p_partkey % 2 when 0 then '可開伙' else '近捷運' end || '</span><span class=\"tag\">有電梯</span>'"
    offered = f"""'<div class="recommend-ware"><a class="title"' || {link} || '>' || p_name || '</a><div class="address-info">' || case p_partkey % 8 when 0 then '<span>社區</span>' else '' end || '<span>' || '甲區-' || p_brand
        || '</span><b class="area">' || p_size || '坪</b></div><div class="distance-info"><i class="desc">距公園</i><i class="distance">9公尺</i></div><div class="price-info"><b class="price">' || {CARD_PRICE} || '</b></div></div>'"""
    usual = f"""'<div class="item big"><div class="image-slider"><img data-src="a' || p_partkey || '"><img data-src="b"></div><div class="item-info-title"><a' || {link} || '>' || p_name || '</a></div><div class="item-info-tag">' || {tags}
        || '</div><div class="item-info-txt"><span>' || {KINDS} || '</span>' || case p_partkey % 5 when 0 then '<span>' || {CARD_ROOMS} || '</span>' else '' end || {row("p_size || '坪'")} || {row(FLOOR)}
        || '</div><div class="item-info-txt"><span>社區</span>' || {row(PLACE)} || '</div>' || case when {MARK} then '<div class="item-info-txt"><span>距公園</span><strong>9公尺</strong></div>' else '' end
        || '<div class="item-info-txt"><span>' || {SEEN} || '</span><span>3天前</span></div><div class="item-info-price"><strong>' || {row(CARD_PRICE)} || '</strong></div></div>'"""
    rows = table(spark, d, "part").selectExpr(K, Z, "p_name", "p_brand", "(p_partkey - 1) div 10 as page_id").repartition(spark.sparkContext.defaultParallelism, "page_id")
    cards = rows.selectExpr("p_partkey", "page_id", f"case when {OFFERED} then {offered} else {usual} end as card")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda x: x["card"]), "\n")
    return cards.groupBy("page_id").agg(F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("raw")).withColumn("city", F.expr("case page_id % 3 when 0 then 'A市' when 1 then 'B縣' else 'C市' end"))


CARD = f"(select *, (p_partkey - 1) // 10 as page_id, row_number() over (partition by (p_partkey - 1) // 10 order by p_partkey)::int as pos, {OFFERED} as offered from part where {LINKED})"


@query(f"""select page_id, pos, case when offered then 'promoted' else 'regular' end as kind, p_partkey::varchar as house_id, p_name as title, case when not offered then '精選/' || case p_partkey % 2 when 0 then '可開伙' else '近捷運' end || '/有電梯' end as tags,
case when not offered then {KINDS} end as property_type, case when not offered and p_partkey % 5 = 0 then {CARD_ROOMS} end as room_hall_info, p_size || '坪' as area, case when not offered then {FLOOR} end as floor,
case when not offered or p_partkey % 8 = 0 then '社區' end as community, case when offered then '甲區-' || p_brand else {PLACE} end as location, case when offered or {MARK} then '距公園' end as nearby_landmark,
case when offered or {MARK} then '9公尺' end as distance_to_landmark, case when not offered then {SEEN} end as contact_info, case when not offered then '3天前' end as update_time, {CARD_PRICE} as price,
case when not offered then 'a' || p_partkey || '/b' end as images, case when not offered then true end as is_featured, null::boolean as is_preferred from {CARD}""")
def h2_listing_cards(spark, d):
    """Promoted and regular cards with all of their fields."""
    cards = list_page.list_cards(list_pages(spark, d))
    return cards.selectExpr("page_id", "pos", "kind", "house_id", "title", "array_join(tags, '/') as tags", "property_type", "room_hall_info", "area", "floor", "community", "location", "nearby_landmark", "distance_to_landmark",
                            "contact_info", "update_time", "price", "array_join(images, '/') as images", "is_featured", "is_preferred")


CARD_HOME = "not offered and p_partkey % 5 <> 4"
CARD_NUMBER = "(p_size * 1000)::double"


@query(f"""select p_partkey::varchar as vendor_house_id, 0 as deal_status, case page_id % 3 when 0 then 1 when 1 then 2 else 65535 end as top_region,
case when offered or p_partkey % 5 <> 1 then case page_id % 3 when 0 then 10 when 1 then 20 else 65535 end end as sub_region, case when offered then '甲區-' || p_brand else {PLACE} end as rough_address,
case when not offered then p_partkey % 5 end::int as property_type, {CARD_NUMBER} as monthly_price, case p_partkey % 6 when 0 then (p_size + 1) * 1000 + 500 end::double as min_monthly_price,
case when offered or {CARD_HOME} then p_size end::double as floor_ping, case when {CARD_HOME} then {FLOORS} end::int as floor, case when {CARD_HOME} then {LAST_FLOOR} end::int as total_floor,
case when {CARD_HOME} then p_partkey % 8 = 0 end as is_rooftop, case when {CARD_HOME} then {LAST_FLOOR} - ({FLOORS}) end::int as dist_to_highest_floor,
case when not offered and p_partkey % 5 = 0 then p_partkey % 4 + 1 end::int as n_bed_room, case when not offered and p_partkey % 5 = 0 then p_partkey % 3 end::int as n_living_room, null::int as n_bath_room,
case when not offered and p_partkey % 5 = 0 then '00000' || (p_partkey % 4 + 1) || '0' || p_partkey % 3 end as apt_feature_code, case when {CARD_HOME} then case p_partkey % 3 when 0 then 0 when 1 then 2 else 1 end end::int as contact,
case when {CARD_HOME} and p_partkey % 2 = 0 then true end as can_cook, null::boolean as allow_pet, case when {CARD_HOME} then true end as elevator, case when {CARD_HOME} and p_partkey % 2 = 1 then true end as metro,
case when offered or {CARD_HOME} then {CARD_NUMBER} / p_size end as per_ping_price from {CARD}""")
def h2_card_items(spark, d):
    """What list cards tell as typed items."""
    items = list_page.card_items(list_page.list_cards(list_pages(spark, d), "page_id", "raw", "city"), regions(spark))
    return items.withColumns({"elevator": F.col("facilities")["電梯"], "metro": F.col("facilities")["近捷運"]}).drop("facilities", "present", "seq")
