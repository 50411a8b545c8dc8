"""Queries of field rendering, normalisation, extraction and set operations, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from ..functions import listing as L
from ..functions import normalize as N
from ..operators.aggregate import loss_estimate
from ..operators.fields import Field, grouped
from ..sources.files import scratch, table
from .catalog import query


def rows():
    return F.count(F.lit(1))


@query("""with m as (select date_trunc('week', ts)::date as week, count(*) as n_rows, count_if(event_type = 'view')::double / count(*) as share, count(distinct user_id) as told from events group by 1),
x as (select avg(share) as base from m where week < date '2024-01-15') select week, n_rows, share, told, told * base / share as expected, (told * base / share - told) / (told * base / share) as loss from m, x""")
def a11_loss_estimate(spark, d):
    """Weeks against the average of the first two."""
    rows = table(spark, d, "events").withColumn("week", F.to_date(F.date_trunc("week", "ts")))
    return loss_estimate(rows, "week", F.col("event_type") == "view", "user_id", F.col("week") < date(2024, 1, 15))


@query("select year(ts) as y, month(ts) as m, day(ts) as d, count(*) as n from events group by all")
def a13_daily_rows(spark, d):
    return table(spark, d, "events").groupBy(F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d")).agg(rows().alias("n"))


@query("select d.doc_id from documents d left join labels l on d.doc_id = l.doc_id where quality is not null and toxic is not null")
def f5_could_be_house(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").where("quality is not null and toxic is not null").select("doc_id")


@query("select event_id from events where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-03' and event_type <> 'view'")
def f6_slot_filter(spark, d):
    return table(spark, d, "events").where("ts >= '2024-01-02' and ts < '2024-01-03' and event_type <> 'view'").select("event_id")


@query("select d.doc_id, l.quality from documents d left join labels l on d.doc_id = l.doc_id where l.quality is not null")
def f7_with_coordinate(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").where("quality is not null").select("doc_id", "quality")


@query("select page_id, case when v > 20 and v < 60 then v end as coordinate from (select page_id, try_cast(regexp_extract(url, '/([0-9]+)', 1) as double) as v from pages)")
def f8_coordinate_valid(spark, d):
    return table(spark, d, "pages").select("page_id", N.within(F.regexp_extract("url", "/([0-9]+)", 1).try_cast("double"), 20, 60).alias("coordinate"))


@query("select d.doc_id from documents d left join labels l on d.doc_id = l.doc_id where l.toxic is null and d.n_chars is not null")
def f9_new_format_rows(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id", "left").where("toxic is null and n_chars is not null").select("doc_id")


QUOTED = "replace(c_name, '#', chr(39))"


@query(f"""select c_custkey, case c_custkey % 6 when 0 then 'A市' when 1 then c_name when 2 then {QUOTED} || ' None' when 3 then c_name end as region, case c_custkey % 6 when 0 then c_name when 1 then '南區' when 2 then '"x" \u00a0區' when 3 then null end as part,
case c_custkey % 6 when 0 then 'detail' when 1 then 'card' when 2 then 'literal' when 3 then 'literal' end as source from customer""")
def j8_region_fallback(spark, d):
    """Regions from what details tell, from list cards in JSON, from list cards in Python literals; malformed texts and nulls tell none."""
    name = F.col("c_name")
    detail = F.when(F.expr("c_custkey % 6 = 0"), F.to_json(F.struct(F.lit("A市").alias("top_region"), name.alias("sub_region")))).when(F.expr("c_custkey % 6 = 1"), '{"top_region": "", "title": "x"}').when(F.expr("c_custkey % 6 = 4"), '{"top_region": ')
    literal = F.concat(F.lit("{'ok': True, 'seen': (1, 2,), 'none': None, u'region_name': '"), F.replace(F.replace(name, F.lit("#"), F.lit("'")), F.lit("'"), F.lit("\\'")), F.lit(" None', 'section_name': '\"x\" \\xa0區', }"))
    card = (F.when(F.expr("c_custkey % 6 = 1"), F.to_json(F.struct(name.alias("region_name"), F.lit("南區").alias("section_name")))).when(F.expr("c_custkey % 6 = 2"), literal)
            .when(F.expr("c_custkey % 6 = 3"), F.concat(F.lit("{'region_name': \""), name, F.lit("\", 'section_name': None}"))).when(F.expr("c_custkey % 6 = 4"), "{'region_name': 'x"))
    return table(spark, d, "customer").select("c_custkey", L.region_names(detail, card).alias("r")).select("c_custkey", "r.region", "r.part", "r.source")


@query("""select p_partkey, case p_type when 'ECONOMY' then 0 when 'STANDARD' then 1 else 65535 end as code, case p_brand when 'Brand#11' then 0 else 65535 end as brand,
(select count(*) from part where p_type not in ('ECONOMY', 'STANDARD')) as unknown_codes, (select count(*) from part where p_brand <> 'Brand#11') as unknown_brands from part""")
def j9_enum_or_unknown(spark, d):
    """Codes of names; the job that writes them also counts, by field, the names that have none."""
    rows = table(spark, d, "part").select("p_partkey", L.code_of(F.col("p_type"), ("ECONOMY", "STANDARD")).alias("code"), L.code_of(F.col("p_brand"), ("Brand#11",)).alias("brand"))
    seen, path = Observation("unknown names"), scratch(spark, "codes")
    rows.observe(seen, *L.unknown_counts({"unknown_codes": F.col("code"), "unknown_brands": F.col("brand")})).write.parquet(path)
    return spark.read.parquet(path).select("*", *[F.lit(n).cast("long").alias(k) for k, n in seen.get.items()])


@query("""select o_orderkey, year(o_orderdate) as year, month(o_orderdate) as month, day(o_orderdate) as day, hour(o_orderdate) as hour, 2024 as as_year, 2 as as_month, 29 as as_day, 0 as as_hour from orders""")
def n21_timestamp_slot(spark, d):
    """The slot of a time, and the slot of a date that a run is told to stand for."""
    slot, told = N.timestamp_slot(F.col("o_orderdate"), hours=True), N.timestamp_slot(F.col("o_orderdate"), date(2024, 2, 29))
    return table(spark, d, "orders").select("o_orderkey", slot.alias("s"), told.alias("t")).select("o_orderkey", "s.*", *[F.col(f"t.{c}").alias(f"as_{c}") for c in ("year", "month", "day", "hour")])


@query("""select o_orderkey, strftime(o_orderdate, '%Y%m') as month, year(o_orderdate)::varchar || 'Q' || quarter(o_orderdate) as quarter, year(o_orderdate)::varchar as year,
cast(last_day(o_orderdate) as date) = cast(o_orderdate as date) as closes from orders""")
def n22_period_label(spark, d):
    day = F.col("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", *[N.period_label(day, p).alias(p) for p in ("month", "quarter", "year")], (F.last_day(day) == F.to_date(day)).alias("closes"))


@query("select c_custkey, sha256('pepper' || c_name) as author from customer")
def n23_author_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", N.author_key(F.col("c_name"), "pepper").alias("author"))


@query("select user_id, max(event_id) as last from events group by user_id order by user_id desc limit 10")
def o2_top_n(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("last")).orderBy(F.desc("user_id")).limit(10)


@query("select o_orderkey, o_orderstatus as status, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else 'partial' end as status_coding from orders")
def p1_enum_decode(spark, d):
    names = F.create_map(*map(F.lit, ("F", "finished", "O", "open")))
    return table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.coalesce(names[F.col("o_orderstatus")], F.lit("partial")).alias("status_coding"))


@query("""select l_orderkey, l_linenumber, concat_ws('/', case when l_discount > 0.05 then 'cheap' end, case when l_tax > 0.04 then 'taxed' end) as supported,
concat_ws('/', case when l_discount <= 0.05 then 'cheap' end, case when l_tax <= 0.04 then 'taxed' end) as unsupported from lineitem""")
def p8_facility_split(spark, d):
    has, hasnt = N.split_flags(F.create_map(F.lit("cheap"), F.col("l_discount") > 0.05, F.lit("taxed"), F.col("l_tax") > 0.04))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(has, "/").alias("supported"), F.array_join(hasnt, "/").alias("unsupported"))


@query("select o_orderstatus, count(*) as n, max(late) as late from (select o_orderstatus, null as late from orders where o_orderkey % 2 = 0 union all select o_orderstatus, o_orderkey from orders where o_orderkey % 2 = 1) group by 1")
def u1_union_months(spark, d):
    o = table(spark, d, "orders")
    both = o.where("o_orderkey % 2 = 0").select("o_orderstatus").unionByName(o.where("o_orderkey % 2 = 1").select("o_orderstatus", F.col("o_orderkey").alias("late")), allowMissingColumns=True)
    return both.groupBy("o_orderstatus").agg(rows().alias("n"), F.max("late").alias("late"))


@query("select event_id, k from (select event_id, row_number() over w as r, count(*) over (partition by cast(ts as date), k) as n, k from (select *, json_extract_string(props, '$.k') as k from events) window w as (partition by cast(ts as date), k order by event_id)) where r = 1 and n > 1")
def w3_duplicate_rank(spark, d):
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), F.get_json_object("props", "$.k").alias("k"))
    w = Window.partitionBy("day", "k")
    return e.withColumn("r", F.row_number().over(w.orderBy("event_id"))).withColumn("n", rows().over(w)).where("r = 1 and n > 1").select("event_id", "k")


@query("select vec_id, embedding[1]::double as x, embedding[2]::double as y from embeddings")
def p5_point_xy(spark, d):
    point = F.struct(F.get("embedding", 0).cast("double").alias("x"), F.get("embedding", 1).cast("double").alias("y"))
    return table(spark, d, "embeddings").select("vec_id", point.alias("p")).select("vec_id", "p.x", "p.y")


@query("select p_partkey, case when length(b) > 0 then '_' || b end as code from (select p_partkey, case p_partkey % 4 when 0 then '' when 1 then null else p_brand end as b from part)")
def p6_feature_code(spark, d):
    brand = F.expr("case p_partkey % 4 when 0 then '' when 1 then null else p_brand end")
    return table(spark, d, "part").select("p_partkey", N.feature_mark(brand).alias("code"))


@query("select c_custkey, c_name, c_nationkey, c_acctbal from customer")
def s2_table_scan(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
