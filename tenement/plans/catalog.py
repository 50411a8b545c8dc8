"""Queries over the given tables and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import aggregate as A
from ..operators import history as H
from ..operators import upsert as U
from ..operators.dimension import extended_codes, spellings
from ..operators.filters import overlaps, worklist
from ..sources.files import scratch, table

QUERIES, ORACLE = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f
    return add


def daily(spark: SparkSession, d: str) -> DataFrame:
    """One row per user and day: the status of the last event (purchase: deal, error: not found)."""
    status = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 1).otherwise(0)
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", status.alias("status"))
    return e.groupBy("user_id", "day").agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"))


DAILY = """h as (select user_id, day, arg_max(status, (ts, event_id)) as status from (select user_id, cast(ts as date) as day, ts, event_id,
 case event_type when 'purchase' then 2 when 'error' then 1 else 0 end as status from events) group by all)"""


@query("select event_type, count(*) as n from events group by event_type")
def a4_count_by_vendor(spark, d):
    return A.count_by(table(spark, d, "events"), "event_type")


@query("""select o_custkey, count(*) as n_combos, max(r) as top_rows from (select o_custkey, o_orderstatus, o_orderpriority, count(*) r from orders group by all)
group by o_custkey having count(*) > 1""")
def a5_audit_static_fields(spark, d):
    return A.audit_static(table(spark, d, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


@query("select month(ts) as m, min(case when event_type = 'view' then event_id end) as low_old, max(case when event_type <> 'view' then event_id end) as high_new from events group by 1")
def a12_id_range(spark, d):
    return table(spark, d, "events").groupBy(F.month("ts").alias("m")).agg(F.min(F.when(F.col("event_type") == "view", F.col("event_id"))).alias("low_old"),
                                                                           F.max(F.when(F.col("event_type") != "view", F.col("event_id"))).alias("high_new"))


@query("""with u as (select user_id, min(cast(ts as date)) a, max(cast(ts as date)) b from events group by 1), x as (select a as day, 1 n, 0 c from u union all select b, 0, 1 from u)
select day, sum(n)::bigint as n_new, sum(c)::bigint as n_last, dayofweek(day) = 0 as sunday from x group by day""")
def a14_daily_flow(spark, d):
    user = table(spark, d, "events").groupBy("user_id").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    ends = user.select(F.explode(F.array(F.struct(F.col("a").alias("day"), F.lit(1).alias("n"), F.lit(0).alias("c")), F.struct(F.col("b").alias("day"), F.lit(0).alias("n"), F.lit(1).alias("c")))).alias("e"))
    return ends.groupBy("e.day").agg(F.sum("e.n").alias("n_new"), F.sum("e.c").alias("n_last")).withColumn("sunday", F.dayofweek("day") == 1)


@query("select coalesce(event_type, '_total') as event_type, count(*) as n from events group by rollup(event_type)")
def k3_export_manifest(spark, d):
    return A.export_manifest(table(spark, d, "events"), "event_type")


@query("select n_name, s_name, sum(l_quantity) as qty from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by all")
def j1_dim_lookup(spark, d):
    qty = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return qty.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("n_name", "s_name").agg(F.sum("qty").alias("qty"))


@query("""select conv_id::varchar as house_id, arg_max(text, turn) filter (where turn % 3 = 0) as list_raw, arg_max(text, turn) filter (where turn % 3 <> 0) as detail_raw,
arg_max(role || turn, turn) filter (where turn % 3 = 1) as detail_dict, max(turn)::bigint as seq from conversations group by conv_id""")
def j3_raw_upsert(spark, d):
    """The turns of conversations as items of three batches: every third is a list item, and its dict does not count; the last batch brings nothing new."""
    table_of_raw = U.raw_table(spark, scratch(spark, "raw"), buckets=8)
    turns = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("house_id"), (F.col("turn") % 3 == 0).alias("is_list"), F.col("text").alias("raw"), F.when(F.expr("turn % 3 <> 2"), F.concat("role", F.col("turn").cast("string"))).alias("dict"), F.col("turn").cast("long").alias("seq"))
    for token, some in (("early", "seq < 2"), ("late", "seq >= 2"), ("again", "seq < 0")):
        U.upsert_raw(table_of_raw, turns.where(some), token)
    return table_of_raw.read().select("house_id", *U.RAW, "seq")


@query("select c_custkey, coalesce(m, c_acctbal) as c_acctbal from customer left join (select o_custkey, max(o_totalprice) m from orders group by 1) on c_custkey = o_custkey")
def j4_update_join(spark, d):
    best = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return U.update_join(table(spark, d, "customer").select("c_custkey", "c_acctbal"), best, "c_custkey", ["c_acctbal"])


@query("""select event_id from events where event_id not in (select min(event_id) from events group by cast(ts as date), json_extract_string(props, '$.k') having count(*) > 1)""")
def j6_delete_duplicates(spark, d):
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), F.get_json_object("props", "$.k").alias("k"))
    return U.delete_first_duplicates(e, ["day", "k"], "event_id").select("event_id")


@query("select cast(ts as date) as day, count(*) as n from events where user_id in (select distinct user_id from events order by user_id desc limit 10) group by 1")
def j7_topk_semi(spark, d):
    e = table(spark, d, "events")
    return e.join(e.select("user_id").distinct().orderBy(F.desc("user_id")).limit(10), "user_id", "left_semi").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {DAILY}, g as (select *, coalesce(sum(case when nxt - day <> 1 then 1 else 0 end) over (partition by user_id order by day desc), 0) as gaps
from (select *, lag(day) over (partition by user_id order by day desc) as nxt from h)) select user_id, day, status from g where gaps = 0""")
def w1_last_run(spark, d):
    return H.last_run(daily(spark, d), "user_id", "day")


@query(f"""with {DAILY}, g as (select *, coalesce(sum(case when nxt - day <> 1 then 1 else 0 end) over (partition by user_id order by day desc), 0) as gaps
from (select *, lag(day) over (partition by user_id order by day desc) as nxt from h)),
r as (select user_id, day, status, row_number() over w as i, lead(status) over w as older, count(*) over (partition by user_id) as n from g where gaps = 0 window w as (partition by user_id order by day desc)),
t as (select *, min(case when status = 2 and (older <> 2 or n = 1) then i end) over (partition by user_id) as tail from r),
b as (select *, min(case when status = 2 and i > tail then i end) over (partition by user_id) as bef from t)
select user_id, case when max(tail) is not null then 2 else arg_min(status, i) end as deal_status, max(case when i = tail then day end) as deal_day,
case when max(tail) is not null then coalesce(max(bef) - 1, max(n)) - max(tail) + 1 end as n_day_deal from b group by user_id""")
def w2_deal_inference(spark, d):
    return H.infer_deal(daily(spark, d), "user_id", "day", "status")


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) r from events) where r = 1")
def w5_latest_snapshot(spark, d):
    return H.latest_snapshot(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id").drop("ts")


@query(f"with {DAILY} select * from (select user_id, day, status, lag(status) over (partition by user_id order by day) as previous from h) where previous <> status")
def w6_transitions(spark, d):
    return H.transitions(daily(spark, d), "user_id", "day", "status")


FIRST_CODES = "select n_regionkey as parent, n_name as name, n_regionkey * 100 + row_number() over (partition by n_regionkey order by n_name) - 1 as code from nation where n_nationkey % 3 <> 1"


@query(f"""with f as ({FIRST_CODES}), l as (select n_regionkey as parent, n_name as name, coalesce((select max(code) from f where parent = n_regionkey) + 1, n_regionkey * 100) + row_number() over (partition by n_regionkey order by n_name) - 1 as code
from nation where n_nationkey % 3 = 1), c as (select r_name || '/' as region, name, code from (select * from f union all select * from l) join region on parent = r_regionkey)
select distinct unnest([region, replace(region, 'A', '4')]) || spelling as name, code from (select *, unnest([name, replace(name, 'I', '1')]) as spelling from c)""")
def w4_region_codes(spark, d):
    """Codes of parts of regions in two steps, the second with names that stand among those of the first, and every spelling of region and part with its code."""
    names = table(spark, d, "nation").select(F.col("n_regionkey").cast("long").alias("parent"), F.col("n_name").alias("name"), "n_nationkey")
    none = spark.createDataFrame([], "parent long, name string, code long")
    codes = extended_codes(extended_codes(none, names.where("n_nationkey % 3 <> 1")), names)
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("parent"), F.concat("r_name", F.lit("/")).alias("region"))
    said = spellings(spellings(codes.join(F.broadcast(regions), "parent"), {"A": "4"}, "region"), {"I": "1"}, "name")
    return said.select(F.concat("region", "name").alias("name"), "code").distinct()


@query("select c_nationkey, c_custkey from (select *, row_number() over (partition by c_nationkey order by c_custkey) r from customer) where r <= 90")
def o3_first_n(spark, d):
    return table(spark, d, "customer").withColumn("r", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))).where("r <= 90").select("c_nationkey", "c_custkey")


@query("""select o_orderkey, o_orderstatus = 'O' as opened, o_orderstatus = 'O' and o_orderkey % 4 = 0 as appended from orders where o_orderstatus = 'O'""")
def f10_worklist(spark, d):
    """Open listings to be read again, and in append mode those without a price only."""
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", 0).otherwise(1).alias("deal_status"), F.when(F.expr("o_orderkey % 4 <> 0"), F.col("o_totalprice")).alias("monthly_price"))
    some = rows.where(worklist(append=True)).select(F.col("o_orderkey").alias("_key"))
    return rows.where(worklist()).join(some, F.col("o_orderkey") == F.col("_key"), "left").select("o_orderkey", (F.col("deal_status") == 0).alias("opened"), F.col("_key").isNotNull().alias("appended"))


@query("select event_id, cast(json_extract_string(props, '$.k') as varchar) as k from events")
def p2_json_project(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("select page_id, list_extract(string_split(split_part(url, '?', 1), '/'), -1) as id from pages")
def n19_id_from_url(spark, d):
    return table(spark, d, "pages").select("page_id", N.id_from_url(F.col("url")).alias("id"))


@query("select c_custkey, c_name from customer where c_nationkey in (1, 3, 5) order by c_custkey desc")
def f2_region_in(spark, d):
    return table(spark, d, "customer").where(F.col("c_nationkey").isin(1, 3, 5)).select("c_custkey", "c_name").orderBy(F.desc("c_custkey"))
