"""Queries of the release, archive, extraction and streaming jobs, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..extract import html
from ..functions import listing as L
from ..functions import normalize as N
from ..operators import aggregate as A
from ..operators import filters
from ..operators import upsert as U
from ..operators.dimension import get_or_create, id_table
from ..operators.fields import Field, grouped
from ..sources import files
from ..sources.archive import add_hot, archive_days, read_hot
from ..sources.files import table
from ..sources.keyed import KeyedTable
from ..streaming import jobs
from .catalog import query
from .export import Export, Job, options, register_export, run_export, run_periodic

LINE = ("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def modes(rows: str, keys: tuple, columns: tuple) -> tuple[str, str]:
    """SQL of a mode per column, ties to the least: tables and the joins to them."""
    by = ", ".join(keys)
    tables = ", ".join(f"m{i} as (select * from (select {by}, {c} as v, row_number() over (partition by {by} order by count(*) desc, {c}) as r from {rows} where {c} is not null group by {by}, {c}) where r = 1)" for i, c in enumerate(columns))
    joins = " ".join(f"left join m{i} on " + " and ".join(f"k.{k} is not distinct from m{i}.{k}" for k in keys) for i in range(len(columns)))
    return tables, joins


_T, _J = modes("lineitem", ("l_partkey",), LINE)


@query(f"with {_T} select k.l_partkey, " + ", ".join(f"m{i}.v as {c}" for i, c in enumerate(LINE)) + f" from (select distinct l_partkey from lineitem) k {_J}")
def a1_merge_months_mode(spark, d):
    return A.merge_mode(table(spark, d, "lineitem"), ["l_partkey"], LINE)


@query("""select l_returnflag, value, n, place from (select *, row_number() over (partition by l_returnflag order by n desc, value) as place from (select l_returnflag, l_partkey as value, count(*) as n from lineitem where l_partkey is not null group by 1, 2)) where place <= 5""")
def a1_top_values(spark, d):
    """The five most frequent parts of each of few keys, which hold a third of all rows each."""
    return A.top_values(table(spark, d, "lineitem"), ["l_returnflag"], "l_partkey", 5)


@query(f"with {_T} select k.l_partkey, m3.v as l_quantity, m7.v as l_returnflag from (select distinct l_partkey from lineitem) k {_J}")
def a1_mode_by_count(spark, d):
    """The modes of two columns by counting."""
    return A.mode_by_count(table(spark, d, "lineitem"), ["l_partkey"], ["l_quantity", "l_returnflag"])


KEYS = ("p_brand", "p_type", "p_size", "l_returnflag", "l_linestatus", "l_quantity", "o_orderstatus", "o_orderpriority")
LISTED = """(select *, l_orderkey * 10 + l_linenumber as id, l_linenumber % 4 as building_type, l_suppkey % 6 as property_type, p_size + 45 as total_floor, p_size as floor, l_quantity * 11 as floor_ping, l_extendedprice / 4 as per_ping_price
from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey)"""
_T2, _J2 = modes("z", KEYS, ("l_tax", "l_discount", "o_custkey"))


@query(f"""with z as (select * from {LISTED} where building_type in (0, 1, 2) and property_type in (0, 1, 2, 3, 4) and total_floor < 90 and floor < 90 and floor_ping < 500 and per_ping_price < 15000), {_T2},
k as (select {', '.join(KEYS)}, count(id) as n_dup, max(id) as max_id, min(id) as min_id, max(l_shipdate) as max_l_shipdate, max(o_orderdate) as max_o_orderdate, max(o_totalprice) as max_o_totalprice, min(l_shipdate) as min_l_shipdate from z group by all)
select k.*, m0.v as mode_l_tax, m1.v as mode_l_discount, m2.v as mode_o_custkey from k {_J2}""")
def a2_dedup_listings(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.selectExpr("*", "l_orderkey * 10 + l_linenumber as id", "l_linenumber % 4 as building_type", "l_suppkey % 6 as property_type", "p_size + 45 as total_floor", "p_size as floor",
                           "l_quantity * 11 as floor_ping", "l_extendedprice / 4 as per_ping_price")
    return A.dedup_listings(rows.where(filters.release_house()), KEYS, "id", modes=["l_tax", "l_discount", "o_custkey"], maxima=["l_shipdate", "o_orderdate", "o_totalprice"], minima=["l_shipdate"], ordered=True)


@query("""with b as (select l_partkey, min(l_quantity) q0, max(l_quantity) q1, min(l_extendedprice) p0, max(l_extendedprice) p1 from lineitem group by 1)
select l_partkey, concat_ws(',', case when q1 / 2 > q0 and q0 >= 0 then 'l_quantity' end, case when p1 / 2 > p0 and p0 >= 0 then 'l_extendedprice' end) as fields from b where (q1 / 2 > q0 and q0 >= 0) or (p1 / 2 > p0 and p0 >= 0)""")
def a6_audit_small_diff(spark, d):
    found = A.audit_small_diff(table(spark, d, "lineitem"), "l_partkey", ["l_quantity", "l_extendedprice"])
    return found.select("l_partkey", F.array_join(F.col("fields.field"), ",").alias("fields"))


STATS = """with s as (select v as vendor, sum(n_list_fail)::bigint as n_list_fail, sum(n_fail)::bigint as n_fail, sum(n_crawled)::bigint as n_crawled, sum(n_closed)::bigint as n_closed, sum(n_dealt)::bigint as n_dealt, sum(n_new_item)::bigint as n_new_item from (
select o_custkey % 7 as v, (o_orderstatus = 'O')::int as n_list_fail, (o_orderstatus <> 'O')::int as n_fail, 0 as n_crawled, 0 as n_closed, 0 as n_dealt, 0 as n_new_item from orders
union all select user_id % 9, 0, 0, 1, (event_type = 'error')::int, (event_type = 'purchase')::int, 0 from events where cast(ts as date) = date '2024-01-02'
union all select c_custkey % 5, 0, 0, 0, 0, 0, 1 from customer) group by 1)"""


def _stats(spark, d):
    status = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 1).otherwise(0)
    history = table(spark, d, "events").where("ts >= '2024-01-02' and ts < '2024-01-03'").select((F.col("user_id") % 9).alias("vendor"), status.alias("status"))
    requests = table(spark, d, "orders").select((F.col("o_custkey") % 7).alias("vendor"), F.when(F.col("o_orderstatus") == "O", "list").otherwise("detail").alias("kind"))
    return A.daily_stats(history, requests, table(spark, d, "customer").select((F.col("c_custkey") % 5).alias("vendor")))


@query(STATS + " select *, n_crawled + n_fail as n_expected from s")
def a7_daily_stats(spark, d):
    return _stats(spark, d)


@query(STATS + " select vendor, vendor || ' get failed list/detail (' || n_list_fail || '/' || n_fail || ') requests' as message from s where n_fail > 0 or n_list_fail > 0")
def a8_failure_alerts(spark, d):
    return A.failure_alerts(_stats(spark, d).withColumn("vendor", F.col("vendor").cast("string"))).withColumn("vendor", F.col("vendor").cast("long"))


def _first_seen(df, ts):
    """Rows per file and month of first sight."""
    file = F.regexp_extract("_metadata.file_path", r"([^/]+)\.parquet", 1)
    return df.groupBy(file.alias("file"), F.year(ts).alias("y"), F.month(ts).alias("m")).agg(F.count(F.lit(1)).alias("n"))


@query("select 'orders' as file, year(o_orderdate) as y, month(o_orderdate) as m, count(*) as n from orders group by all")
def a9_monthly_first_seen(spark, d):
    return _first_seen(table(spark, d, "orders"), "o_orderdate")


@query("""with a as (select year(f) as y, month(f) as m, count(*) as n from (select o_custkey, year(o_orderdate), min(o_orderdate) as f from orders group by 1, 2) group by all),
b as (select year(o_orderdate) as y, month(o_orderdate) as m, count(*) as n from orders group by all) select b.y, b.m, coalesce(a.n, 0)::double / b.n as ratio from b left join a on a.y = b.y and a.m = b.m""")
def a10_annual_monthly_ratio(spark, d):
    orders = table(spark, d, "orders")
    annual = orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.min("o_orderdate").alias("first")).groupBy("y", F.month("first").alias("m")).agg(F.count(F.lit(1)).alias("a"))
    monthly = _first_seen(orders, "o_orderdate").groupBy("y", "m").agg(F.sum("n").alias("n"))
    return monthly.join(annual, ["y", "m"], "left").select("y", "m", (F.coalesce("a", F.lit(0)) / F.col("n")).alias("ratio"))


@query("select source, 1 - count(distinct text) * 1.0::double / count(*) as dup_share from documents group by source")
def a15_dup_rate(spark, d):
    """Texts are told apart by two 64-bit hashes, so none is shuffled."""
    docs = table(spark, d, "documents").select("source", F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))).alias("h"))
    return docs.groupBy("source").agg((1 - F.count_distinct("h") / F.count(F.lit(1))).alias("dup_share"))


@query("select n_regionkey, c_nationkey, count(*) as n from customer join nation on c_nationkey = n_nationkey group by rollup(n_regionkey, c_nationkey)")
def a15_region_counts(spark, d):
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("k"))
    rows = c.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.rollup("n_regionkey", "c_nationkey").agg(F.sum("k").alias("n"))


@query("""select o_custkey, created, crawled_at, additional_fee from (select o_custkey, min(o_orderdate) as created, max(o_orderdate) as crawled_at, max(case when o_orderstatus = 'F' then o_orderpriority end) as additional_fee from orders group by 1)
where additional_fee is not null and created <= timestamp '1996-03-02' and crawled_at >= timestamp '1996-01-01'""")
def f1_period_filter(spark, d):
    life = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("created"), F.max("o_orderdate").alias("crawled_at"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("additional_fee"))
    return life.where(filters.period(date(1996, 3, 1), date(1996, 1, 1)))


def _items(spark, d):
    s = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 1).otherwise(0)
    e = table(spark, d, "events").withColumn("seq", F.col("event_id")).withColumn("present", F.when(F.expr("event_id % 2 = 0"), F.array(F.lit("value"))).otherwise(F.array(F.lit("props"))))
    return e.select("user_id", F.to_date("ts").alias("day"), "seq", s.alias("status"), "value", "props", "present")


E = "select *, cast(ts as date) as day, case event_type when 'purchase' then 2 when 'error' then 1 else 0 end as s from events"
FOLD = "arg_max(s, event_id) as l, arg_max(s, event_id) filter (where s <> 1) as r, arg_max({'v': value}, event_id) filter (where event_id % 2 = 0) as v, arg_max({'v': props}, event_id) filter (where event_id % 2 = 1) as p, max(event_id) as q"
BASE, NEW = (f"(select user_id, {FOLD} from ({E}) where event_id % 3 {op} 0 group by user_id)" for op in ("=", "<>"))
EMPTY = "user_id bigint, day date, status int, value double, props string, seq bigint"


@query(f"""with b as (select user_id, case when l = 1 and r = 2 then 2 else l end as status, v.v as value, p.v as props, q as seq from {BASE}), i as {NEW}
select coalesce(i.user_id, b.user_id) as user_id, case when i.l is null then b.status when i.l = 1 and coalesce(i.r, b.status) = 2 then 2 else i.l end as status,
case when i.v is not null then i.v.v else b.value end as value, case when i.p is not null then i.p.v else b.props end as props, coalesce(i.q, b.seq) as seq from b full join i on b.user_id = i.user_id""")
def j2_patch_upsert(spark, d):
    items = _items(spark, d)
    none = spark.createDataFrame([], EMPTY)
    base = U.upsert_patches(none, items.where("seq % 3 = 0"), ["user_id"], "seq", "status", ["value", "props"], "present")
    return U.upsert_patches(base, items.where("seq % 3 <> 0"), ["user_id"], "seq", "status", ["value", "props"], "present")


@query("""select c_name as truth, case when c_custkey % 3 <> 0 then 'first' else 'second' end as since, true as kept, true as own from customer""")
def n23_author_dimension(spark, d):
    """Ids of authors after two batches of which the second holds the first, and a run of the second again: the first ones keep their ids, no id is given twice."""
    ids = id_table(spark, files.scratch(spark, "authors"), 16)
    names = table(spark, d, "customer").select("c_custkey", "c_name")
    before = ids.read(get_or_create(ids, names.where("c_custkey % 3 <> 0"), "c_name", "first")).select("truth", F.col("id").alias("before"))
    for _ in range(2):
        get_or_create(ids, names, "c_name", "second")
    now = ids.read()
    uses = now.groupBy("id").agg(F.count(F.lit(1)).alias("uses"))
    return now.join(before, "truth", "left").join(uses, "id").select("truth", "since", F.coalesce(F.col("id") == F.col("before"), F.col("since") == "second").alias("kept"), (F.col("uses") == 1).alias("own"))


@query(f"select user_id, day, l as status, v.v as value, p.v as props, q as seq from (select user_id, day, {FOLD} from ({E}) group by user_id, day)")
def j2_history_upsert(spark, d):
    return U.upsert_patches(spark.createDataFrame([], EMPTY), _items(spark, d), ["user_id", "day"], "seq", "status", ["value", "props"], "present", keep_deal=False)


@query("select c_custkey, max(o_orderdate) as crawled_at, count(o_orderkey) = 0 as missed from customer left join orders on c_custkey = o_custkey group by 1")
def j5_backfill(spark, d):
    last = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("crawled_at"))
    return table(spark, d, "customer").select("c_custkey").join(last, "c_custkey", "left").withColumn("missed", F.col("crawled_at").isNull())


@query("""select o_orderkey, o_orderstatus as status, o_orderkey % 3 as status_code, case o_orderkey % 3 when 0 then 'none' when 1 then 'one' else 'two' end as status_code_coding, '_' || o_orderpriority as mark from orders""")
def p7_field_project(spark, d):
    from ..operators.fields import project

    rows = table(spark, d, "orders").withColumn("code", (F.col("o_orderkey") % 3).cast("int"))
    spec = [Field("o_orderkey", "o_orderkey"), Field("o_orderstatus", "status"), Field("code", "status_code", enum=("none", "one", "two")), Field("o_orderpriority", "mark", fn=N.feature_mark)]
    return project(rows, spec)


@query("""select event_type as kind, json_extract_string(props, '$.k') as k, count(event_id) as n_dup, max(value) as top from events group by all""")
def p7_field_spec(spark, d):
    return grouped(table(spark, d, "events"), [Field("event_type", "kind"), Field("props", "k", key="k"), Field("event_id", "n_dup", F.count), Field("value", "top", F.max)])


@query("select l_returnflag, count(*) as n, sum(l_linenumber)::bigint as lines, count(l_quantity) as told, min(l_quantity) as low from (select l_returnflag, l_linenumber, case when l_quantity > 40 then null when l_quantity > 30 then -5 else l_quantity end as l_quantity from lineitem) group by 1")
def s1_csv_glob(spark, d):
    """Written as one folder of CSV per year, with ``-`` for null, and read again by glob."""
    rows = table(spark, d, "lineitem").selectExpr("year(l_shipdate) as year", "l_returnflag", "l_linenumber", "case when l_quantity > 40 then null when l_quantity > 30 then -5 else l_quantity end as l_quantity")
    path = files.scratch(spark, "csv")
    rows.write.partitionBy("year").csv(path, header=True, nullValue="-")
    back = files.read_csvs(spark, f"{path}/year=*", "l_returnflag string, l_linenumber int, l_quantity double")
    return back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"), F.count("l_quantity").alias("told"), F.min("l_quantity").alias("low"))


STATUS = ("none", "one", "two")
# Listings of the orders: a life of thirty days, details for most, a house by its numbers.
LIVES = ["o_orderkey", "o_orderstatus = 'F' as closed", "case when o_orderkey % 5 > 0 then o_orderpriority end as priority", "o_orderdate as seen", "date_add(cast(o_orderdate as date), 30) as left", "case when o_custkey % 7 > 0 then 'x' end as told",
         "cast(o_orderkey % 4 as int) as code", "case when o_custkey % 4 > 0 then o_orderstatus end as city", "cast(o_orderkey % 5 as int) as building_type", "cast(o_orderkey % 6 as int) as property_type", "o_orderkey % 100 as total_floor",
         "o_orderkey % 20 as floor", "o_orderkey % 600 as floor_ping", "o_orderkey * 37 % 20000 as per_ping_price"]
SPEC = [Field("o_orderkey", "編號", kind="number", name="id"), Field("closed", "已結？", kind="boolean"), Field("priority", "順序", kind="text"), Field("seen", "時間", kind="time"), Field("code", "代碼", kind="number", enum=STATUS), Field("city", "縣市", kind="text")]
UNIQUE = [Field("city", "縣市", kind="text"), Field("closed", "已結？", kind="boolean"), Field("o_orderkey", "最大編號", F.max, kind="number", name="max_id"), Field("o_custkey", "重複", F.count, kind="number", name="n_dup")]
register_export("orders", Export(SPEC, source=lambda df, job: df.selectExpr(*LIVES, "o_custkey"), unique=UNIQUE, house=filters.should_be_house, lifetime=("seen", "left", "told"), region="city"))
YEAR = Job(date(1996, 12, 31), date(1996, 1, 1))
LIVED = """(select *, o_orderstatus = 'F' as closed, case when o_custkey % 4 > 0 then o_orderstatus end as city, case when o_orderkey % 5 > 0 then o_orderpriority end as priority, case o_orderkey % 4 when 0 then 'none' when 1 then 'one' when 2 then 'two' end as coded
from orders where o_custkey % 7 > 0 and o_orderdate <= timestamp '1997-01-01' and cast(o_orderdate as date) + 30 >= date '1996-01-01')"""
HOUSE_SQL = "o_orderkey % 5 < 3 and o_orderkey % 6 < 4 and o_orderkey % 100 < 90 and o_orderkey % 20 <= o_orderkey % 100 + 2 and o_orderkey % 600 < 500 and o_orderkey * 37 % 20000 <= 15000"
HUMAN = "o_orderkey::varchar as \"編號\", case when closed then {yes} else {no} end as \"已結？\", priority as \"順序\", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC' as \"時間\", (o_orderkey % 4)::varchar as \"代碼\""
CSV = "`編號` string, `已結？` string, `順序` string, `時間` string, `代碼` string, "


ATTRIBUTES = ("city", "closed", "code", "priority", "building_type", "property_type")


@query(f"""select city, closed, (o_orderkey % 4)::int as code, priority, (o_orderkey % 5)::int as building_type, (o_orderkey % 6)::int as property_type, count(o_orderkey) as n_dup, max(o_orderkey) as max_id, min(o_totalprice) as min_x, max(o_totalprice) as max_x,
min(o_custkey) as min_y, max(o_custkey) as max_y, max(o_custkey::varchar) as author from {LIVED} where {HOUSE_SQL} group by all""")
def a3_dedup_extent(spark, d):
    """Listings with details that lived in a year and may be homes, by their attributes, with the box of their places."""
    rows = table(spark, d, "orders").selectExpr(*LIVES, "o_custkey", "o_totalprice as x", "o_custkey as y")
    rows = rows.where(filters.period(YEAR.start, YEAR.end, "seen", "left", "told") & filters.should_be_house())
    return A.dedup_extent(rows, ATTRIBUTES, "o_orderkey", "x", "y", "o_custkey")


@query(f"select {HUMAN.format(yes=chr(39) + 'T' + chr(39), no=chr(39) + 'F' + chr(39))}, city as \"縣市\" from {LIVED}")
def k1_csv_export(spark, d):
    """Listings that lived in a year, given the wrong way round, for people: ``-`` for null, letters for booleans."""
    path = files.scratch(spark, "export")
    run_export("orders", table(spark, d, "orders"), YEAR, path)
    return files.read_csvs(spark, path, CSV + "`縣市` string")


@query(f"select {HUMAN.format(yes=chr(39) + '1' + chr(39), no=chr(39) + '0' + chr(39))}, coded as \"代碼_coding\", city as \"縣市\" from {LIVED} where city in ('F', 'O')")
def k1_digits_codes_regions(spark, d):
    """The same from command-line words: digits for booleans, names beside the codes, two regions."""
    path = files.scratch(spark, "export")
    name, job = options(["orders", "--start", "1996-01-01", "--end", "1996-12-31", "--digits", "--enum", "--regions", "F,O"])
    run_export(name, table(spark, d, "orders"), job, path)
    return files.read_csvs(spark, path, CSV + "`代碼_coding` string, `縣市` string")


@query(f"""select city as "縣市", case when closed then 'T' else 'F' end as "已結？", max(o_orderkey)::varchar as "最大編號", count(o_custkey)::varchar as "重複" from {LIVED}
where {HOUSE_SQL} group by 1, 2""")
def k1_unique_export(spark, d):
    """The grouped form, of rows that may be homes."""
    path = files.scratch(spark, "export")
    run_export("orders", table(spark, d, "orders"), Job(YEAR.start, YEAR.end, unique=True), path)
    return files.read_csvs(spark, path, "`縣市` string, `已結？` string, `最大編號` string, `重複` string")


@query(f"select coalesce(city, 'default') as filed_by, city, closed, coalesce(coded, '3') as code, o_orderkey as id, priority, o_orderdate as seen from {LIVED}")
def k2_json_by_region(spark, d):
    """The same listings for machines: typed values under short names, names in place of codes, nulls as nulls, filed by region, the region told in each."""
    path = files.scratch(spark, "json")
    run_export("orders", table(spark, d, "orders"), Job(YEAR.start, YEAR.end, enum=True, json="city"), path)
    return spark.read.schema("city string, closed boolean, code string, id bigint, priority string, seen timestamp_ntz, filed_by string").json(path)


def _due(start: str, last: str) -> str:
    return f"(select o_orderkey, o_custkey, case when o_custkey % 4 > 0 then o_orderstatus end as city from orders where o_custkey % 7 > 0 and o_orderdate <= date '{last}' + 1 and cast(o_orderdate as date) + 30 >= date '{start}')"


@query(" union all ".join(f"select '{label}' as label, count(*) as lines, count(city) as told, max(o_orderkey) as last, count(*) as objects from {_due(start, '1996-03-31')}" for label, start in (("199603", "1996-03-01"), ("1996Q1", "1996-01-01"))))
def export_periodic(spark, d):
    """What is due on the last day of March: a month and a quarter, each as CSV and JSON."""
    path, name = files.scratch(spark, "periodic"), "orders"
    labels = run_periodic(name, table(spark, d, "orders"), Job(periodic=True), path, date(1996, 3, 31))
    assert run_periodic(name, table(spark, d, "orders"), Job(periodic=True), path, date(1996, 3, 30)) == []
    out = None
    for label in labels:
        lines = files.read_csvs(spark, f"{path}/{label}/csv", CSV + "`縣市` string").agg(F.count(F.lit(1)).alias("lines"), F.count("縣市").alias("told"))
        objects = spark.read.schema("id bigint").json(f"{path}/{label}/json").agg(F.max("id").alias("last"), F.count("id").alias("objects"))
        one = lines.join(objects, F.col("lines").isNotNull()).select(F.lit(label).alias("label"), "*")  # one row each
        out = one if out is None else out.unionByName(one)
    return out


@query("select cast(ts as date) as day, count_if(ts < timestamp '2024-01-11') as archived, count_if(ts >= timestamp '2024-01-11') as kept, count_if(ts < timestamp '2024-01-11' and event_id % 7 = 0) as late from events group by 1")
def k4_history_archive(spark, d):
    """Days up to the tenth leave the hot table, the run goes again, then late rows of those days come and a second run takes them."""
    path, events = files.scratch(spark, "archive"), table(spark, d, "events").select("event_id", "ts")
    hot, kind = f"{path}/hot", "event_id bigint, ts timestamp_ntz"
    for run, some in (("first", "event_id % 7 > 0"), ("first", "false"), ("second", "event_id % 7 = 0")):
        add_hot(events.where(some), "ts", hot)
        archive_days(spark, hot, kind, date(2024, 1, 10), f"{path}/cold", run)
    old = spark.read.schema("event_id bigint, y int, m int, d int, run string").json(f"{path}/cold").select(F.make_date("y", "m", "d").alias("day"), F.lit(1).alias("a"), F.lit(0).alias("k"), (F.col("run") == "second").cast("int").alias("l"))
    new = read_hot(spark, hot, kind).select("day", F.lit(0).alias("a"), F.lit(1).alias("k"), F.lit(0).alias("l"))
    return old.union(new).groupBy("day").agg(F.sum("a").alias("archived"), F.sum("k").alias("kept"), F.sum("l").alias("late"))


@query("select c_custkey::varchar as c_custkey, c_name, printf('%.2f', c_acctbal) as c_acctbal from customer")
def k5_item_csv(spark, d):
    path = files.scratch(spark, "items")
    files.write_csv(table(spark, d, "customer").select("c_custkey", "c_name", F.format_string("%.2f", "c_acctbal").alias("c_acctbal")), path)
    return files.read_csvs(spark, path, "c_custkey string, c_name string, c_acctbal string")


@query("select count(*) as n_rows, count(*) as in_manifest, true as agrees, true as has_bytes from orders")
def k6_release_reconcile(spark, d):
    path = files.scratch(spark, "release")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    files.write_csv(rows, path)
    manifest = A.export_manifest(rows, "o_orderstatus").where("o_orderstatus = '_total'").select(F.col("n").alias("in_manifest"))
    found = files.release_files(spark, path).agg(F.sum("rows").alias("n_rows"), F.min("bytes").alias("bytes"))
    both = found.join(manifest, F.col("n_rows").isNotNull())  # one row each
    return both.select("n_rows", "in_manifest", (F.col("n_rows") == F.col("in_manifest")).alias("agrees"), (F.col("bytes") > 0).alias("has_bytes"))


@query("select case when n_regionkey < 3 then 'top' else 'sub' end as kind, n_name as name, n_nationkey as code from nation")
def s3_json_dim(spark, d):
    path = files.scratch(spark, "codes")
    kind = F.when(F.col("n_regionkey") < 3, "top").otherwise("sub")
    kinds = table(spark, d, "nation").groupBy(kind.alias("kind")).agg(F.collect_list(F.array("n_name", F.col("n_nationkey").cast("string"))).alias("pairs"))
    doc = kinds.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("kind", "pairs")))).alias("value"))
    doc.coalesce(1).write.text(path)
    return files.read_codes(spark, path)


@query("select page_id, length(html) as n from pages where html is not null and length(html) > 0")
def s4_raw_landing(spark, d):
    return files.landed(table(spark, d, "pages"), "html").select("page_id", F.char_length("html").cast("long").alias("n")).where("n > 0")


def _plain(text: str) -> str:
    """SQL of a text with its entities read."""
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#x27", "''"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{sign}')"
    return f"nullif(trim({text}), '')"


TITLE = _plain("regexp_extract(html, '<title>([^<]*)</title>', 1)")
HEAD = _plain("regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')")
LANG = "nullif(regexp_extract(html, '<html lang=\"([a-z]+)\"', 1), '')"
ANCHOR = "regexp_extract_all(html, '<a href=\"[^\"]+\">[^<]*</a>')"


@query(f"select page_id, {TITLE} as title, {LANG} as lang, {HEAD} as heading, len({ANCHOR})::int as n_links, concat_ws(',', case when {TITLE} is null then 'title' end, case when {HEAD} is null then 'heading' end) as parse_errors from pages where html is not null")
def h1_extract_detail(spark, d):
    return html.extract_details(table(spark, d, "pages")).select("page_id", "title", "lang", "heading", "n_links", F.array_join("parse_errors", ",").alias("parse_errors"))


@query(f"""select page_id, pos::int as pos, regexp_extract(a, '"([^"]+)"', 1) as link, coalesce({_plain("regexp_extract(a, '>([^<]*)<', 1)")}, '') as text from (select page_id, unnest({ANCHOR}) as a, unnest(range(1, len({ANCHOR}) + 1)) as pos from pages)""")
def h2_list_cards(spark, d):
    return html.extract_cards(table(spark, d, "pages"))


@query("select p_partkey, case when p_partkey % 2 = 0 then p_brand else reverse(p_brand) end as shown from part")
def h3_reordered_text(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_brand").repartition(spark.sparkContext.defaultParallelism, F.xxhash64("p_partkey"))  # one file fills one task
    letters = F.transform(F.split("p_brand", ""), lambda c, i: F.format_string('<i style="order:%d;font-style:normal;">%s</i>', i, c))
    shuffled = F.array_join(F.concat(F.slice(letters, 3, 99), F.slice(letters, 1, 2)), "")
    way = F.when(F.expr("p_partkey % 2 = 0"), "row").otherwise("row-reverse")
    text = F.concat(F.lit('<span style="display:inline-flex;flex-direction: row; flex-direction: '), way, F.lit(';">'), shuffled, F.lit("</span>"))
    return rows.select("p_partkey", html.reordered(text).alias("shown"))


@query(f"select page_id, {TITLE} as title, {LANG} as lang, {HEAD} as heading from pages")
def h4_reparse_raw(spark, d):
    pages = table(spark, d, "pages")
    base = pages.where("page_id % 2 = 0").selectExpr("page_id", "0 as status", "'old' as title", "cast(null as string) as lang", "cast(null as string) as heading", "0L as seq").distinct()
    return html.reparse(base, pages).select("page_id", "title", "lang", "heading")


@query("select page_id, case when page_id % 4 < 2 then 20.5 + page_id % 8 end::double as x, case when page_id % 4 < 2 then 121.25 end::double as y from pages")
def h5_map_coordinate(spark, d):
    lat = F.when(F.expr("page_id % 4 < 2"), F.col("page_id") % 8 + 20.5).otherwise(F.lit(35.5))
    url = F.concat(F.col("url"), F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("q="), lat.cast("string"), F.lit(",121.25"))
    return table(spark, d, "pages").select("page_id", L.coordinate(F.regexp_extract(url, r"[?&]q=(-?[0-9.]+,-?[0-9.]+)", 1)).alias("p")).select("page_id", "p.x", "p.y")


SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(spark, d):
    return _events(spark.readStream.schema(SCHEMA).parquet(f"{d}/events.parquet*"))


def _events(e):
    s = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 1).otherwise(0)
    return e.select("user_id", F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), "event_type", s.alias("status"), "value", "props", F.get_json_object("props", "$.k").alias("k"))


def _appended(spark, df, name, schema):
    path = files.scratch(spark, name)
    jobs.run(df, f"{path}-state", jobs.append_to(path)).awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/batch=*")


BATCHES = 4
LATEST = "user_id, case when l = 1 and r = 2 then 2 else l end as status, v.v as value, q as seq"
ALL = "arg_max(s, event_id) as l, arg_max(s, event_id) filter (where s <> 1) as r, arg_max({'v': value}, event_id) as v, max(event_id) as q"


def _upserted(spark, d):
    """Both tables after the events, by their ids, have come in BATCHES runs of one stream."""
    path = files.scratch(spark, "stream")
    latest = KeyedTable(spark, f"{path}/latest", "user_id bigint, status int, value double, seq bigint", ["user_id"], 16)
    history = KeyedTable(spark, f"{path}/history", "user_id bigint, day date, status int, value double, seq bigint", ["user_id", "day"], 2, by=["day"])
    events = table(spark, d, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    for k in range(BATCHES if low is not None else 0):
        start, end = (low + (high + 1 - low) * i // BATCHES for i in (k, k + 1))
        events.where(f"event_id >= {start} and event_id < {end}").write.mode("append").parquet(f"{path}/in")
        items = _events(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"))
        jobs.stream_upsert(items, f"{path}/state", latest, history, "user_id", "day", "seq", "status", ["value"]).awaitTermination()
    return latest, history


@query(f"select {LATEST} from (select user_id, {ALL} from ({E}) group by user_id)")
def t1_stream_upsert(spark, d):
    return _upserted(spark, d)[0].read()


@query(f"select user_id, day, l as status, v.v as value, q as seq from (select user_id, day, {ALL} from ({E}) group by user_id, day)")
def t1_stream_history(spark, d):
    return _upserted(spark, d)[1].read()


@query("select * from (select cast(ts as date) as day, event_type, count(*) as n from events group by 1, 2) where day + interval 1 day <= (select max(ts) from events) - interval 1 day")
def t2_stream_slot_counts(spark, d):
    return _appended(spark, jobs.slot_counts(_stream(spark, d), "ts", "event_type"), "slots", "day date, event_type string, n bigint")


@query("select distinct cast(ts as date) as day, json_extract_string(props, '$.k') as k from events")
def t3_stream_request_dedup(spark, d):
    return _appended(spark, jobs.request_dedup(_stream(spark, d), "ts", ["day", "k"]).select("day", "k"), "requests", "day date, k string")


@query("select user_id, cast(ts as date) as day, arg_min(event_id, (ts, event_id)) as first_event from events group by 1, 2")
def t4_seen_before(spark, d):
    """The first event of every user in each daily run."""
    items = _stream(spark, d).select("user_id", "ts", "seq", F.unix_date("day").cast("long").alias("run")).withColumn("at", F.col("ts"))
    with jobs.rocksdb_state(spark):
        seen = _appended(spark, jobs.unseen(items, "user_id", "run", "ts").select("user_id", F.date_from_unix_date(F.col("run").cast("int")).alias("day"), F.col("seq").alias("first_event")), "seen", "user_id bigint, day date, first_event bigint")
    return seen


@query("select s_nationkey, count(s_suppkey) as n, max(s_acctbal) as best from supplier where s_nationkey in (1, 2, 3) group by 1")
def export_registry(spark, d):
    """A grouped export of one's own, by name, with a region option."""
    from .export import REGISTRY, in_regions

    register_export("suppliers", Export([Field("s_nationkey", "s_nationkey"), Field("s_suppkey", "n", F.count), Field("s_acctbal", "best", F.max)], source=lambda df, job: in_regions(df, job, "s_nationkey")))
    return REGISTRY["suppliers"].rows(table(spark, d, "supplier"), Job(regions=("1", "2", "3")))


@query("""select id::varchar as id, n_dup::varchar as n_dup, seen, row_number() over (order by n_dup desc, id desc) as place from
(select max(o_orderkey) as id, count(*) as n_dup, strftime(max(o_orderdate), '%Y-%m-%d') as seen from orders group by o_custkey)""")
def o1_ordered_export(spark, d):
    """An export by number of duplicates, then id, both falling; ``place`` is the line's place in the files as they are read back."""
    path = files.scratch(spark, "ordered")
    kept = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("id"), F.count(F.lit(1)).alias("n_dup"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("seen"))
    files.write_csv(kept.select("id", "n_dup", "seen"), path, [F.desc("n_dup"), F.desc("id")])
    # The name of a part file, the split and the row's place within it are the order of the export.
    lines = files.read_csvs(spark, path, "id string, n_dup string, seen string").select("*", F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    sizes = lines.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a file
    place = F.row_number().over(Window.partitionBy("part").orderBy("split", "line")) + F.col("before")
    return lines.join(before, "part").select("id", "n_dup", "seen", place.cast("long").alias("place"))
