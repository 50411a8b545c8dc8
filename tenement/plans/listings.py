"""Queries of the listing rules, every input shape dealt over the rows of a table, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import listing as L
from ..functions import normalize as N
from ..operators import filters
from ..operators.fields import Field, project
from ..sources.files import table
from .catalog import query


def shapes(key: str, *texts: str) -> str:
    """One of the SQL expressions by the key's remainder; the same text for both engines."""
    return f"case {key} % {len(texts)} " + " ".join(f"when {i} then {t}" for i, t in enumerate(texts)) + " end"


NUMBERS = shapes("c_custkey", "'NT$ 1,234 per month'", "'-5.5 m'", "'12-3'", "'none'", "''", "null", "c_name", "'' || c_nationkey || '.50'")


@query(f"""select c_custkey, case c_custkey % 8 when 0 then 1234.0 when 1 then -5.5 when 7 then c_nationkey + 0.5
when 6 then case when regexp_replace(c_name, '[^0-9.-]', '', 'g') like '_%-%' then null else try_cast(regexp_replace(c_name, '[^0-9.-]', '', 'g') as double) end end::double as n from (select *, {NUMBERS} as t from customer)""")
def n1_clean_number(spark, d):
    return table(spark, d, "customer").select("c_custkey", N.clean_number(F.expr(NUMBERS)).alias("n"))


@query("""select p_partkey, p_name || '|x' as kept from part""")
def n2_clean_strings(spark, d):
    dirty = F.array(F.lit("  "), F.concat(F.lit("  "), "p_name", F.lit(" \n")), F.lit(""), F.lit("x"))
    return table(spark, d, "part").select("p_partkey", F.array_join(N.clean_strings(dirty), "|").alias("kept"))


@query("""select p_partkey, (p_size * 1000)::double as monthly_price, case p_partkey % 3 when 0 then p_size * 1000 + 500 end::double as min_monthly_price from part""")
def n3_price_range(spark, d):
    text = F.expr(shapes("p_partkey", "'' || p_size || ',000~' || p_size || ',500元'", "'' || p_size || '000元/月'", "'$' || p_size || ',000'"))
    high, low = N.price_range(text)
    return table(spark, d, "part").select("p_partkey", high.alias("monthly_price"), low.alias("min_monthly_price"))


@query("""select o_orderkey, case o_orderkey % 7 when 0 then 0 when 1 then 0 when 2 then 1 when 3 then 2 when 4 then 3 when 5 then 0 end as type,
case o_orderkey % 7 when 0 then 2 when 1 then 10 when 2 then 30000 / o_totalprice end::double as months,
case o_orderkey % 7 when 0 then 2 * o_totalprice when 1 then 10 * o_totalprice when 2 then 30000 end::double as amount from orders""")
def n4_deposit(spark, d):
    text = F.expr(shapes("o_orderkey", "'押金二個月'", "'十個月'", "'30,000'", "'面議'", "'洽談'", "'押金十二個月'", "null"))
    return table(spark, d, "orders").select("o_orderkey", L.deposit(text, F.col("o_totalprice").cast("double")).alias("x")).select("o_orderkey", "x.*")


@query("""select p_partkey, case p_partkey % 4 when 0 then false when 1 then true when 2 then false end as required,
case p_partkey % 4 when 0 then 0 when 1 then p_size * 100 when 2 then 0 end::double as monthly from part""")
def n5_management_fee(spark, d):
    includes = F.when(F.expr("p_partkey % 4 = 0"), F.array(F.lit("水費"), F.lit("管理費")))
    fee = F.expr("case p_partkey % 4 when 0 then array('900', '元/月') when 1 then array(p_size || ',00', '元/月') when 2 then array('--') end")
    return table(spark, d, "part").select("p_partkey", L.management_fee(includes, fee).alias("x")).select("p_partkey", "x.*")


@query("""select p_partkey, case p_partkey % 7 when 0 then true when 1 then true when 2 then true when 3 then true when 4 then false when 5 then true end as has,
case p_partkey % 7 when 0 then false when 1 then true when 2 then false when 3 then true end as required,
case p_partkey % 7 when 0 then 0 when 1 then p_size * 10 when 2 then 0 when 3 then 0 end::double as monthly from part""")
def n6_parking(spark, d):
    fee = F.expr("case p_partkey % 7 when 0 then array('500') when 1 then array(p_size || '0元') when 2 then array('已含') when 3 then array('費用另計') when 4 then array('無') when 5 then array('?') end")
    return table(spark, d, "part").select("p_partkey", L.parking(F.when(F.expr("p_partkey % 7 = 0"), F.array(F.lit("車位費"))), fee).alias("x")).select("p_partkey", "x.*")


@query("""select l_orderkey, l_linenumber, case when l_quantity > 5 then (l_extendedprice + case when l_linenumber = 1 then 0 else l_tax end) / (l_quantity - 6 + case when l_quantity = 6 then null else 0 end) end as per_ping from lineitem""")
def n7_per_ping_price(spark, d):
    ping = F.when(F.col("l_quantity") > 5, F.col("l_quantity") - 6)
    fee = F.when(F.col("l_linenumber") != 1, F.col("l_tax"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", N.per_ping_price(F.col("l_extendedprice"), ping, fee).alias("per_ping"))


@query("""select n_nationkey, r_regionkey as top, case when n_nationkey % 5 = 4 then 65535 else n_regionkey * 100 + n_nationkey end as sub, r_name || split_part(n_name || '-road', '-', 1) as card_key
from nation join region on n_regionkey = r_regionkey""")
def n8_region_codes(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    rows = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    tops = r.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("top"))
    subs = rows.where("n_nationkey % 5 <> 4").select(F.concat("r_name", "n_name").alias("name"), (F.col("n_regionkey") * 100 + F.col("n_nationkey")).alias("sub"))
    top, sub = L.region_keys(F.array("r_name", "n_name"))
    keyed = rows.select("n_nationkey", top.alias("t"), sub.alias("s"), L.list_region_key(F.col("r_name"), F.concat("n_name", F.lit("-road"))).alias("card_key"))
    # Both dimensions have one row per region.
    out = keyed.join(F.broadcast(tops), F.col("t") == F.col("name"), "left").drop("name").join(F.broadcast(subs), F.col("s") == F.col("name"), "left")
    return out.select("n_nationkey", "top", F.coalesce("sub", F.lit(65535)).alias("sub"), "card_key")


@query("""select event_id, case event_id % 6 when 1 then 1 when 2 then 1 when 3 then 2 when 4 then 0 when 5 then 0 end as status from events where event_id % 6 <> 0""")
def n9_deal_status(spark, d):
    http = F.expr("case event_id % 6 when 0 then case when event_id % 12 = 0 then 400 else 200 end when 1 then 404 else 200 end")
    url = F.when(F.expr("event_id % 6 = 0"), "about:blank")
    tag = F.expr("case event_id % 6 when 3 then array('12天前成交') when 4 then array('0天') end")
    return table(spark, d, "events").select("event_id", L.deal_status(http, url, F.expr("event_id % 6 = 2"), tag).alias("status")).where("status is not null")


@query("""select p_partkey, case p_partkey % 5 when 0 then 0 when 1 then 4 when 2 then 3 when 3 then 65535 end as code from part""")
def n10_property_type(spark, d):
    name = F.expr(shapes("p_partkey", "'整層住家'", "'車位'", "'__UNKNOWN__'", "p_name", "null"))
    return table(spark, d, "part").select("p_partkey", L.property_type(name, F.lit("雅房")).alias("code"))


@query("""select p_partkey, case p_partkey % 7 when 0 then 1 when 1 then 1 when 2 then 2 when 3 then 2 when 4 then 9 when 5 then 65535 end as code from part""")
def n11_building_type(spark, d):
    name = F.expr(shapes("p_partkey", "'別墅'", "'透天厝'", "'住宅大樓'", "'電梯大樓'", "'農舍'", "p_name", "null"))
    return table(spark, d, "part").select("p_partkey", L.building_type(name).alias("code"))


FLOORS = shapes("p_partkey", "p_size || 'F/' || (p_size + 12) || 'F'", "p_size || 'F~' || (p_size + 1) || 'F/' || (p_size + 2) || 'F'", "'B' || p_size || '/5F'", "'頂樓加蓋/' || p_size || 'F'",
                "'整棟/' || p_size || 'F'", "'平面式'", "p_size || 'F'", "null", "'--/--'")


@query("""with x as (select p_partkey, p_partkey % 9 as k, p_size as s from part), y as (select p_partkey, k,
case k when 0 then s when 1 then s when 2 then -s when 3 then s + 1 when 4 then 0 when 5 then 0 when 6 then s when 8 then 0 end as floor,
case k when 0 then s + 12 when 1 then s + 2 when 2 then 5 when 3 then s when 4 then s when 5 then 0 when 6 then 0 end as total, case k when 7 then null else k = 3 end as is_rooftop from x)
select p_partkey, floor, total, is_rooftop, total - floor as dist, case when k < 5 or k = 8 then floor end as card_floor, case when k < 5 then total end as card_total from y""")
def n12_floors(spark, d):
    rows = table(spark, d, "part").withColumn("t", F.expr(FLOORS))
    return rows.select("p_partkey", L.floors(F.col("t")).alias("x"), L.floors(F.col("t"), card=True).alias("c")).select("p_partkey", "x.*", F.col("c.floor").alias("card_floor"), F.col("c.total").alias("card_total"))


@query("""with x as (select p_partkey, p_partkey % 4 as k, p_size % 10 as s from part) select p_partkey, case when k = 1 then 0 when k = 2 then null else 3 end as balcony,
case when k < 3 then s end as bed, case when k < 3 then case k when 1 then 0 else 2 end end as living, case when k < 3 then case k when 0 then 1 else 0 end end as bath,
case when k = 0 then '0301' || lpad(s::varchar, 2, '0') || '02' when k = 1 then '0000' || lpad(s::varchar, 2, '0') || '00' end as code from x""")
def n13_rooms(spark, d):
    text = F.expr(shapes("p_partkey", "'' || (p_size % 10) || '房2廳1衛'", "'' || (p_size % 10) || '房'", "'' || (p_size % 10) || '房2廳'", "'套房'"))
    facilities = F.expr("case p_partkey % 4 when 0 then array('1陽台', '冷氣', '3陽台') when 1 then array('床') when 2 then array('陽台') else array('3陽台') end")
    return table(spark, d, "part").select("p_partkey", L.rooms(text, facilities, F.expr("p_partkey % 4 < 3")).alias("x")).select("p_partkey", "x.*")


@query("""select event_id, event_id % 2 = 1 as eletricity, true as water, event_id % 3 > 0 as internet, (select count(*) from (values (event_id % 2 = 1), (true), (true), (event_id % 3 > 0), (true)) v(b) where b)::int as n_extra from events""")
def n14_additional_fees(spark, d):
    includes = F.array_compact(F.array(F.when(F.expr("event_id % 2 = 0"), "電費"), F.when(F.expr("event_id % 3 = 0"), "網路"), F.lit("管理費")))
    rows = table(spark, d, "events").select("event_id", L.additional_fees(includes).alias("m"))
    return rows.select("event_id", *[F.col("m")[k].alias(k) for k in ("eletricity", "water", "internet")], F.size(F.map_filter("m", lambda k, v: v)).alias("n_extra"))


@query("""select event_id, event_id % 4 = 0 as has_tenant_restriction, event_id % 4 in (0, 1) as has_gender_restriction, case event_id % 4 when 0 then 1 when 1 then 2 else 0 end as gender_restriction,
case when event_id % 4 = 2 then false when event_id % 3 = 0 then true end as can_cook, case when event_id % 3 = 0 then true end as allow_pet, event_id % 5 = 0 as has_registration from events""")
def n15_tenant_rules(spark, d):
    rule = F.expr(shapes("event_id", "'適合學生，此房屋限女生租住'", "'此房屋限男生租住'", "'男女皆可，不可開伙'", "null"))
    tags = F.when(F.expr("event_id % 3 = 0"), F.array(F.lit("可開伙"), F.lit("可養寵物"))).otherwise(F.array(F.lit("近捷運")))
    registration = F.when(F.expr("event_id % 5 = 0"), "已辦理").when(F.expr("event_id % 5 = 1"), "未辦理")
    return table(spark, d, "events").select("event_id", L.tenant_rules(rule, tags, registration).alias("x")).select("event_id", "x.*")


@query("""select c_custkey, case c_custkey % 5 when 0 then 2 when 1 then 2 when 2 then 0 when 3 then 65535 end as contact, case when c_custkey % 5 < 4 then '09' || c_custkey end as author,
case c_custkey % 5 when 0 then '未認證' when 1 then c_name end as agent_org, case when c_custkey % 5 < 2 then 3 when c_custkey % 5 < 4 then 2 else 0 end as n_present,
case c_custkey % 5 when 2 then 0 when 3 then null when 4 then 1 else 2 end as card from customer""")
def n16_contact(spark, d):
    role = F.expr(shapes("c_custkey", "'仲介'", "'仲介'", "'屋主'", "'房東'", "'代理人'"))
    agent = F.when(F.expr("c_custkey % 5 = 0"), "經紀業: 不動產經紀業").otherwise(F.col("c_name"))
    phone = F.when(F.expr("c_custkey % 5 < 4"), F.concat(F.lit("0-9-"), F.col("c_custkey").cast("string"))).otherwise("")
    x = L.contact(F.concat(role, F.lit(": "), F.col("c_name")), phone, agent)
    return table(spark, d, "customer").select("c_custkey", x.alias("x"), L.card_contact(F.concat(role, F.lit(" "), F.col("c_custkey").cast("string"))).alias("card")).select("c_custkey", "x.contact", "x.author", "x.agent_org", F.size("x.present").alias("n_present"), "card")


@query("""select p_partkey, case p_partkey % 3 when 0 then '冷氣|電梯' when 1 then list_aggregate(list_sort(list_distinct(string_split(p_name, ' '))), 'string_agg', '|') end as facilities from part""")
def n17_tag_facilities(spark, d):
    tags = F.when(F.expr("p_partkey % 3 = 0"), F.array(*map(F.lit, ("有電梯", "新上架", "有冷氣", "可開伙")))).when(F.expr("p_partkey % 3 = 1"), F.split("p_name", " ")).otherwise(F.array(F.lit("精選")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(F.map_keys(L.tag_facilities(tags))), "|").alias("facilities"))


@query("""select event_id, coalesce(json_extract_string(props, '$.k'), '-') as k, '-' as none from events""")
def n18_safe_path(spark, d):
    return table(spark, d, "events").select("event_id", L.path_get(F.col("props"), "k", "-").alias("k"), L.path_get(F.col("props"), "k.x.y", "-").alias("none"))


@query("""select page_id, coalesce(try_cast(nullif(regexp_extract(list_extract(regexp_extract_all(html, '<a href="([^"]+)"', 1), -1), 'page=([0-9]+)', 1), '') as bigint), 1) as pages from pages""")
def n20_page_count(spark, d):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), F.lit(1))
    return table(spark, d, "pages").select("page_id", N.page_count(F.try_element_at(links, F.lit(-1))).alias("pages"))


@query("""select l_orderkey, l_linenumber, concat_ws('|', case when l_tax > 0.04 then 'taxed:true' else 'taxed:false' end, case when l_discount > 0.05 then 'cheap:true' else 'cheap:false' end) as facilities from lineitem""")
def u2_facility_union(spark, d):
    flag = lambda c, n, yes: F.when(c if yes else ~c, n)
    tests = [(F.col("l_tax") > 0.04, "taxed"), (F.col("l_discount") > 0.05, "cheap")]
    yes, no = (F.array_compact(F.array(F.lit("2陽台" if side else "陽台"), *[flag(c, n, side) for c, n in tests])) for side in (True, False))
    m = L.facility_union(yes, no)
    text = F.array_join(F.array(*[F.concat(F.lit(f"{n}:"), m[n].cast("string")) for _, n in tests]), "|")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.alias("facilities"))


@query("""select o_orderkey, case o_orderkey % 4 when 0 then 24.5 when 1 then null when 2 then null else null end::double as x, case o_orderkey % 4 when 0 then 121.5 end::double as y from orders""")
def f8_map_coordinate(spark, d):
    text = F.expr(shapes("o_orderkey", "'24.5,121.5'", "'0,0'", "'abc'", "null"))
    return table(spark, d, "orders").select("o_orderkey", L.coordinate(text).alias("p")).select("o_orderkey", "p.x", "p.y")


HOUSES = ("l_linenumber % 4 as building_type", "cast(l_quantity as int) % 6 as property_type", "p_size + 50 as total_floor", "case when l_linenumber = 7 then null else cast(l_quantity * 2 as int) end as floor",
          "l_quantity * 11 as floor_ping", "l_extendedprice / 4 as per_ping_price")
JOINED = f"(select l_orderkey, l_linenumber, {', '.join(HOUSES)} from lineitem join part on l_partkey = p_partkey)"


def _houses(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr("l_orderkey", "l_linenumber", *HOUSES)


@query(f"""select l_orderkey, l_linenumber from {JOINED} where building_type in (0, 1, 2) and property_type in (0, 1, 2, 3) and total_floor < 90 and floor < 90 and floor <= total_floor + 2
and floor_ping < 500 and per_ping_price <= 15000""")
def f3_should_be_house(spark, d):
    return _houses(spark, d).where(filters.should_be_house()).select("l_orderkey", "l_linenumber")


@query(f"""select l_orderkey, l_linenumber from {JOINED} where building_type in (0, 1, 2) and property_type in (0, 1, 2, 3, 4) and total_floor < 90 and floor < 90 and floor_ping < 500 and per_ping_price < 15000""")
def f4_release_house(spark, d):
    return _houses(spark, d).where(filters.release_house()).select("l_orderkey", "l_linenumber")


@query("""select o_orderkey, nullif(case o_orderkey % 3 when 0 then '' else o_orderpriority end, '') as priority, case o_orderkey % 3 when 0 then true when 1 then false end as flag, o_orderdate as seen from orders""")
def p4_render_machine(spark, d):
    text = F.when(F.expr("o_orderkey % 3 = 0"), "").otherwise(F.col("o_orderpriority"))
    flag = F.expr(shapes("o_orderkey", "'true'", "'false'", "''"))
    return table(spark, d, "orders").select("o_orderkey", N.render_machine(text, "text").alias("priority"), N.render_machine(flag, "flag").alias("flag"), N.render_machine(F.col("o_orderdate"), "time").alias("seen"))


@query("""select o_orderkey, case when o_orderkey % 5 = 0 then '-' when o_orderstatus = 'F' then 'T' else 'F' end as closed, case when o_orderstatus = 'F' then '1' else '0' end as closed_number,
case when o_orderkey % 7 = 0 then '-' else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC' end as seen, case o_orderkey % 4 when 0 then '-' when 1 then 'T' when 2 then 'F' else o_orderpriority end as text,
case when length(o_orderpriority) > 0 then '_' || o_orderpriority end as mark from orders""")
def p3_render(spark, d):
    closed = F.col("o_orderstatus") == "F"
    text = F.expr(shapes("o_orderkey", "''", "'true'", "'false'", "o_orderpriority"))
    return table(spark, d, "orders").select(
        "o_orderkey", N.render_human(F.when(F.expr("o_orderkey % 5 <> 0"), closed), "boolean").alias("closed"), N.render_human(closed, "boolean", letters=False).alias("closed_number"),
        N.render_human(F.when(F.expr("o_orderkey % 7 <> 0"), F.col("o_orderdate")), "time").alias("seen"), N.render_human(text, "text").alias("text"), N.feature_mark(F.col("o_orderpriority")).alias("mark"))


@query("""select p_partkey, coalesce(list_contains(w, 'cold'), false) as cold, coalesce(list_contains(w, 'hot'), false) as hot, coalesce(list_contains(w, 'small'), false) as small,
coalesce(len(w) = 3 and list_contains(w, 'cold') and list_contains(w, 'hot') and list_contains(w, 'small'), false) as every, coalesce(array_to_string(w, '/'), '') as joined,
p_partkey % 4 <> 0 and p_size % 3 > 0 as school, p_partkey % 4 <> 0 and p_size % 2 > 0 as park
from (select *, case p_partkey % 4 when 1 then string_split(p_name, ' ') when 2 then ['small', 'hot', 'cold'] when 3 then ['cold', 'cold', 'hot'] end as w from part)""")
def p9_tenant_membership(spark, d):
    """Flags of words in an array, of all of them, and of counts over zero."""
    words = F.expr("case p_partkey % 4 when 1 then split(p_name, ' ') when 2 then array('small', 'hot', 'cold') when 3 then array('cold', 'cold', 'hot') end")
    near = F.expr("case when p_partkey % 4 <> 0 then map('school', p_size % 3, 'park', p_size % 2) end")
    rows = table(spark, d, "part").select("p_partkey", N.membership(words, {"cold": "cold", "hot": "hot", "small": "small"}).alias("w"), N.counted(near, "school", "park").alias("n"))
    return rows.select("p_partkey", "w.*", "n.*")


@query("""select s_suppkey::varchar as id, s_name as supplier_name, case when s_suppkey % 3 > 0 then s_acctbal::varchar else '-' end as supplier_balance from supplier""")
def p10_expand_children(spark, d):
    """The parts of a struct as columns of an export, rendered one by one."""
    parts = F.struct(F.col("s_name").alias("name"), F.expr("case when s_suppkey % 3 > 0 then s_acctbal end").alias("balance"))
    return project(table(spark, d, "supplier").select("s_suppkey", parts.alias("supplier")), [Field("s_suppkey", "id", kind="number"), Field("supplier", "supplier", children=("name", "balance"), kind="text")])
